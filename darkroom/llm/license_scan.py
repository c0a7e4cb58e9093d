"""License scans: TF-IDF cosine of lines, windows and licence files to licence
templates, then the nearest licence file above.

Terms are lower-cased runs of letters and digits. Weights come from the whole
corpus: one aggregation counts the files that hold each template term. A line
is compared with every template by the cosine of their sparse vectors; a term
that no template has weighs as one that no file has. Only lines that could
reach `threshold` are scored: each template's heaviest terms are taken until
the rest of its vector alone is too short for that cosine, so a line without
any of them is out by the Cauchy-Schwarz inequality.

Notices are also wrapped, commented and set in longer lines. So every run of as
many terms as a template has, across lines and without comment marks, is
compared with it too, and the whole text of a licence file with each template.
Files whose terms cannot reach `threshold` are out by the same inequality; in
the others running sums bound every window's cosine, and windows are scored
from the highest bound down until none can be better.

A line with an SPDX identifier is compared as such: the licence of that name, of
the first known one where two are joined by OR or AND, of none where no template
has it. A template that several licences share (`SHARED`) decides only where no
other is found.

A file's own licence is that of its best line, window or whole text. A licence file (by base name) gives
its own to its directory. A file without one inherits from its nearest ancestor
directory: its ancestors, one row each, are joined to directories by path and
the deepest match wins. The only table sent to tasks is the templates.

Defined results: null texts have no lines; a null path has no ancestors;
ties between templates go to the first by name, between lines to the first
line's better cosine, and several licence files of one directory to the best
cosine, then the first name. Repeated rows are judged one by one. An empty table
gives an empty result; very long texts cost time in their length for each
template that they can reach; columns are renamed inside, so none clashes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from darkroom.llm.store import stored

MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor
the names of its contributors may be used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public
License along with this program. If not, see <https://www.gnu.org/licenses/>."""
def gnu_header(work: str, name: str, version: str, colon: str) -> str:
    """The notice of a GNU licence up to its first paragraph's end: they differ in these words."""
    return (f"This {work} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
            f"Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


def gnu_notice(work: str, name: str, version: str, colon: str) -> str:
    return (f"{gnu_header(work, name, version, colon)} This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")


#: The conditions that BSD licences share, and the opening of each.
BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_2_TEXT = BSD_TEXT[:BSD_TEXT.index("3. Neither")] + BSD_TEXT[BSD_TEXT.index("THIS SOFTWARE"):]
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
#: Notices and headers of common licences, whole texts of the short ones and titles of the long ones (whose texts end with
#: their notice): fixed texts.
TEMPLATES = {
    "AGPL-3.0": (
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        gnu_header("program", AGPL, "3", ":"),
        gnu_notice("program", AGPL, "3", ":"),
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        APACHE_HEADER,
    ),
    "BSD-2-Clause": (
        "SPDX-License-Identifier: BSD-2-Clause",
        BSD_2_TEXT,
    ),
    "BSD-3-Clause": (
        BSD_OPENING,
        "SPDX-License-Identifier: BSD-3-Clause",
        BSD_TEXT,
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Creative Commons Attribution 4.0 International Public License",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    ),
    "GPL-2.0": (
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        gnu_header("program", GPL, "2", ";"),
        gnu_notice("program", GPL, "2", ";"),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        GPL_HEADER,
    ),
    "ISC": (
        "SPDX-License-Identifier: ISC",
        ISC_TEXT,
    ),
    "LGPL-2.1": (
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        gnu_header("library", LGPL, "2.1", ";"),
        gnu_notice("library", LGPL, "2.1", ";"),
    ),
    "LGPL-3.0": (
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        gnu_header("program", LGPL, "3", ":"),
        gnu_notice("program", LGPL, "3", ":"),
        gnu_header("library", LGPL, "3", ":"),
        gnu_notice("library", LGPL, "3", ":"),
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction,",
        "SPDX-License-Identifier: MIT",
        MIT_TEXT,
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License Version 2.0",
        MPL_HEADER,
    ),
}
#: Templates that other licences hold too: they decide only where no other is found.
SHARED = frozenset([BSD_OPENING])
THRESHOLD = 0.8
#: An identifier's line, and what an identifier may end with.
SPDX = re.compile(r"SPDX-License-Identifier:[ \t(]*([A-Za-z0-9.+-]+)(?:[ \t]+(?:OR|AND)[ \t]+([A-Za-z0-9.+-]+))?", re.I)
SPDX_END = re.compile(r"(?:-only|-or-later|\+)$", re.I)
TERM = re.compile("[a-z0-9]+")
#: Comment marks that are words, at the start of a line.
COMMENT_WORD = re.compile(r"^[ \t]*(?:dnl|rem)\b", re.M | re.I)
#: Base names of licence files, without suffix and case.
LICENSE_NAMES = ("license", "licence", "copying", "notice")


def terms_of(text: str) -> Counter:
    return Counter(TERM.findall(text.lower()))


def term_weights(docs: DataFrame, text: str, templates: dict[str, tuple[str, ...]]) -> tuple[dict[str, float], float]:
    """(idf of each template term, idf of any other term) over all files."""
    vocabulary = sorted({t for lines in templates.values() for line in lines for t in terms_of(line)})
    known = F.array(*[F.lit(t) for t in vocabulary])
    found = F.array_intersect(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9]+"), known)
    counts = docs.select(F.explode(F.array_append(found, F.lit(""))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["t"]: r["n"] for r in counts}
    files = n.get("", 0)
    idf = lambda df: math.log((1 + files) / (1 + df)) + 1
    return {t: idf(n.get(t, 0)) for t in vocabulary}, idf(0)


def spdx_names(templates: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Licence by identifier, without case and without -only and -or-later."""
    return {SPDX_END.sub("", m[1]).lower(): name for name in sorted(templates) for line in templates[name] if (m := SPDX.match(line))}


def needed_terms(vector: dict[str, float], threshold: float) -> list[str]:
    """The heaviest terms of a unit vector whose absence bounds the cosine below `threshold`."""
    rest, out = 1.0, []
    for term, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if rest < threshold ** 2 - 1e-9:
            break
        out.append(term)
        rest -= w * w
    return out


def scorers(docs: DataFrame, text: str, templates: dict[str, tuple[str, ...]], threshold: float) -> tuple[Callable, Callable, Callable]:
    """(column of the lines worth scoring, task that scores rows (key, line),
    column of the best window of (text, whether it is also scored whole))."""
    idf, other = term_weights(docs, text, templates)
    vectors, lengths, shared = [], [], []
    names = spdx_names(templates)
    for name in sorted(templates):
        for line in templates[name]:
            if SPDX.match(line):  # compared as an identifier
                continue
            lengths.append(terms_of(line).total())
            shared.append(line in SHARED)
            v = {t: c * idf[t] for t, c in terms_of(line).items()}
            size = math.sqrt(sum(w * w for w in v.values()))
            vectors.append((name, {t: w / size for t, w in v.items()}))
    needed = sorted({t for _, v in vectors for t in needed_terms(v, threshold)})
    wanted = "(^|[^a-z0-9])(" + "|".join([*needed, "spdx"]) + ")([^a-z0-9]|$)"

    def candidates(text: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda line: F.lower(line).rlike(wanted))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, line in zip(batch["key"], batch["line"], strict=True):
                if m := SPDX.search(line):
                    known = [names[i] for i in (SPDX_END.sub("", x).lower() for x in m.groups() if x) if i in names]
                    if known:
                        out.append((k, known[0], 1.0, False))
                    continue
                counts = terms_of(line)
                size = math.sqrt(sum((c * idf.get(t, other)) ** 2 for t, c in counts.items()))
                best = max(((sum(w * counts[t] * idf[t] for t, w in v.items() if t in counts) / size, i) for i, (_, v) in enumerate(vectors)), key=lambda x: (x[0], -x[1]))
                if best[0] >= threshold:
                    out.append((k, vectors[best[1]][0], min(1.0, round(best[0], 12)), shared[best[1]]))
            yield pd.DataFrame(out, columns=["key", "licence", "cosine", "shared"])

    shares: dict[str, list[tuple[int, float]]] = {}
    for i, (_, v) in enumerate(vectors):
        for t, w in v.items():
            shares.setdefault(t, []).append((i, w * w))

    def best_window(terms: list[str], whole: bool) -> tuple[float, int] | None:
        mass = [0.0] * len(vectors)
        for t in shares.keys() & set(terms):
            for i, share in shares[t]:
                mass[i] += share
        live = sorted((i for i, share in enumerate(mass) if share >= threshold ** 2 - 1e-9), key=lambda i: shared[i])
        if not live:
            return None
        weight = np.array([idf.get(t, other) for t in terms])
        norm = np.concatenate([[0.0], np.cumsum(weight * weight)])
        best = None
        for i in live:
            if shared[i] and best is not None and not shared[best[1]]:
                break
            v = vectors[i][1]
            dot = np.concatenate([[0.0], np.cumsum(weight * np.array([v.get(t, 0.0) for t in terms]))])
            for size in {min(lengths[i], len(terms)), *([len(terms)] if whole else [])}:
                # a term that a window repeats only makes its vector longer than this
                bound = (dot[size:] - dot[:-size]) / np.sqrt(norm[size:] - norm[:-size])
                at = np.flatnonzero(bound >= threshold - 1e-9)
                for k in at[np.argsort(-bound[at], kind="stable")].tolist():
                    if best is not None and bound[k] <= best[0] + 1e-9:
                        break
                    counts = Counter(terms[k:k + size])
                    length = math.sqrt(sum((c * idf.get(t, other)) ** 2 for t, c in counts.items()))
                    cosine = sum(w * counts[t] * idf[t] for t, w in v.items() if t in counts) / length
                    if cosine >= threshold and (best is None or cosine > best[0]):
                        best = (cosine, i)
        return best

    @F.pandas_udf("licence string, cosine double, shared boolean")
    def score_windows(texts: pd.Series, whole: pd.Series) -> pd.DataFrame:
        out = []
        for body, is_file in zip(texts, whole, strict=True):
            found = best_window(TERM.findall(COMMENT_WORD.sub("", body).lower()), bool(is_file))
            out.append((vectors[found[1]][0], min(1.0, round(found[0], 12)), shared[found[1]]) if found else (None, None, None))
        return pd.DataFrame(out, columns=["licence", "cosine", "shared"])

    return candidates, score, score_windows


def ancestors(directory: Column) -> Column:
    """A directory and all above it, the root as ''."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def scan_licences(
    files: DataFrame, path: Column, keep: list[str], text: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `files`: the columns `keep`, path, own_licence,
    own_cosine, licence and licence_dir (where an inherited one comes from)."""
    templates = TEMPLATES if templates is None else templates
    candidates, score, score_windows = scorers(files, text, templates, threshold)
    is_file = lambda path: F.regexp_replace(F.lower(F.regexp_extract(path, "([^/]*)$", 1)), r"\..*$", "").isin(*LICENSE_NAMES)
    rows = files.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
        path.alias("path"), candidates(F.col(text)).alias("lines"),
        score_windows(F.coalesce(F.col(text), F.lit("")), F.coalesce(is_file(path), F.lit(False))).alias("window"),
    )
    rows = stored(rows.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")), "licence-rows")
    hits = rows.select(F.col("row").alias("key"), F.explode("lines").alias("line")).mapInPandas(score, "key long, licence string, cosine double, shared boolean")
    hits = hits.unionByName(rows.where("window.licence IS NOT NULL").select(F.col("row").alias("key"), "window.licence", "window.cosine", "window.shared"))
    own = hits.groupBy(F.col("key").alias("_key")).agg(F.min(F.struct("shared", (-F.col("cosine")).alias("c"), F.col("licence").alias("l"))).alias("_best"))
    own = own.select("_key", F.col("_best.l").alias("own_licence"), (-F.col("_best.c")).alias("own_cosine"))
    judged = stored(rows.drop("lines", "window").join(own, F.col("row") == F.col("_key"), "left").drop("_key"), "licence-files")
    dirs = judged.where(F.col("own_licence").isNotNull() & is_file(F.col("path")))
    dirs = stored(dirs.groupBy(F.col("dir").alias("_dir")).agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), F.col("path").alias("p"), F.col("own_licence").alias("l"))).alias("_b")).select("_dir", F.col("_b.l").alias("_licence")), "licence-dirs")
    wanting = judged.where(F.col("own_licence").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    up = wanting.withColumn("_up", F.explode(ancestors(F.col("dir"))))
    inherited = up.join(dirs, F.col("_up") == F.col("_dir")).groupBy(F.col("dir").alias("_for")).agg(F.max(F.struct(F.length("_up").alias("n"), F.col("_up").alias("from"), F.col("_licence").alias("l"))).alias("_in"))
    out = judged.join(inherited, (F.col("dir") == F.col("_for")) & F.col("own_licence").isNull(), "left")
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "path", "own_licence", "own_cosine",
        F.coalesce("own_licence", F.col("_in.l")).alias("licence"), F.col("_in.from").alias("licence_dir"),
    )
