"""HTML extraction with site template removal.

Each page is parsed once, inside the task that reads it, into blocks of text
and hashes of its element subtrees (an element's bytes between its children,
chained with their hashes, so a page costs time in its length, however deep).
Spark counts the subtrees per host, once per distinct text of a page, so copies
of a page count as one and what recurs has different text around it. Template is
what stands on `min_pages` such pages (on a smaller host: on all of them,
`few_pages` at least) and on a share of the host's pages: `container_share` for
containers (`CONTAINERS`), `min_share` for other elements, since a short
paragraph, heading or cell recurs by chance. The text inside template goes. An
element with more than two thirds of a page's text is neither counted nor removed
there.

What a page marks as its article (`article`, else `main`) is protected: its
paragraphs, headings and list items are never template, and a container inside
it only where it stands on `article_share` of the host's pages, so a list or a
quotation that several articles share stays. Articles without an `h1` whose text
together is shorter than one block beside them are cards; the page is then taken
as if they were no articles, without losing their text. Elements that are
furniture by their tag, role, id or a whole class token (menus, forms, adverts,
comments, ...) go whether they recur or not, so pages of small hosts come out
clean too; ids of headings and sections inside an article mark nothing. Such an
element stays if it holds an article or main, or most of the page's text: a page
with one is parsed a second time. Comments, asides and menus go all the same
where the page has an article outside of furniture. The longest article-free
page keeps all its other blocks.

The parsed pages are stored once with a row number; only pages whose text
depends on the counts are joined to them, through pairs (host, hash).

Defined results: a null or empty html gives an empty text; unclosed elements
end with their parent; bytes that are no UTF-8 become U+FFFD; repeated pages
are extracted one by one; a null url counts as host ''. An empty table gives an
empty result. Unclosed or deeply nested elements and a page without any `>` take
time and memory in the page's length. Other columns of `pages` are not read, so
none clashes.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.store import discard, stored
from darkroom.llm.url_cascade import host_and_path

MIN_PAGES = 10
FEW_PAGES = 3
MIN_SHARE = 0.2
CONTAINER_SHARE = 0.05
ARTICLE_SHARE = 0.5

#: Fixed values of the HTML standard, and furniture by tag, role and class word.
VOID = frozenset(b"area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(b"script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    b"address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    b"form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset(b"body caption dd dt html legend li summary tbody td tfoot th thead tr".split())
#: An opening tag ends an open element of these kinds, up to the named boundaries.
ENDS = {
    b"li": (frozenset([b"li"]), frozenset(b"ul ol menu".split())),
    b"dt": (frozenset(b"dt dd".split()), frozenset([b"dl"])), b"dd": (frozenset(b"dt dd".split()), frozenset([b"dl"])),
    b"tr": (frozenset(b"tr td th".split()), frozenset([b"table"])),
    b"td": (frozenset(b"td th".split()), frozenset(b"tr table".split())), b"th": (frozenset(b"td th".split()), frozenset(b"tr table".split())),
    b"option": (frozenset([b"option"]), frozenset([b"select"])),
}
FURNITURE = frozenset(b"head nav footer aside form button select textarea input svg canvas object embed dialog menu map audio video".split()) | RAW
ROLES = frozenset(b"navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
CLASS_WORDS = frozenset(
    b"ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    b"disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup "
    b"promo promotion reply replies respond related share sharing sidebar social sponsor sponsored subscribe toolbar widget disqus".split())
#: Never text of the page, and furniture that may be larger than the page's own text.
NEVER = RAW | frozenset(b"head button select textarea input svg canvas object embed map audio video".split())
MENUS = frozenset(b"nav footer menu".split())
BESIDE = frozenset(b"comment comments disqus navigation nav navbar related replies reply respond sidebar".split())
#: Class words that are no furniture inside an article (its own heading).
ARTICLE_WORDS = frozenset(b"header masthead banner".split())
CONTAINERS = frozenset(b"div section ul ol dl table figure fieldset details center".split())

TOKEN = re.compile(
    rb"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(rb"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
UNMARKED_IDS = frozenset(b"h1 h2 h3 h4 h5 h6 section".split())
KEEP_OPEN = frozenset(b"html body".split())


#: What an element is: no furniture, or furniture by a word or form, beside an article, a menu, or never text.
BY_WORD, BY_ARTICLE, MENU, NO_TEXT = 1, 2, 3, 4


def furniture_kind(tag: bytes, attributes: bytes, in_article: bool) -> int:
    if tag in NEVER:
        return NO_TEXT
    if tag in MENUS:
        return MENU
    if tag == b"aside":
        return BY_ARTICLE
    kind = BY_WORD if tag in FURNITURE or (tag == b"header" and not in_article) else 0
    if not attributes or tag in KEEP_OPEN or tag in (b"article", b"main") and not in_article and b"comment" not in attributes.lower():
        return kind
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or b"").lower()
        if name == b"role":
            if value.strip() in ROLES:
                kind = max(kind, BY_WORD)
        elif name == b"class" or not (in_article and tag in UNMARKED_IDS):
            found = CLASS_WORDS.intersection(value.split())
            if found and (not in_article or found - ARTICLE_WORDS):
                kind = max(kind, BY_ARTICLE if found & BESIDE else BY_WORD)
    return kind


class Furniture:
    """An element that is dropped unless it turns out to hold the page."""

    __slots__ = ("start", "kind", "outer", "article", "chars", "silent", "by_word")

    def __init__(self, start: int, kind: int, outer: Furniture | None):
        self.start, self.kind, self.outer = start, kind, outer
        self.article = False  # the page's article or main lies inside
        self.chars = 0
        self.silent = kind >= MENU or outer is not None and outer.silent  # its text is not counted
        self.by_word = kind == BY_WORD and (outer is None or outer.by_word)


def held_back(marked: list[Furniture], total: int, article_outside: bool) -> frozenset[int]:
    """Where the furniture starts that is not to be dropped."""
    return frozenset(
        f.start for f in marked
        if not (article_outside and f.kind > BY_WORD) and (f.article or f.kind < MENU and 2 * f.chars > total))


class Element:
    __slots__ = ("tag", "parent", "article", "in_article", "in_main", "dropped", "holds", "bytes", "hash", "chars", "mark", "furniture")

    def __init__(self, tag: bytes, parent: Element | None, dropped: bool, furniture: Furniture | None):
        self.tag, self.parent, self.dropped, self.furniture = tag, parent, dropped, furniture
        self.in_article = tag == b"article" or parent is not None and parent.in_article
        self.in_main = tag == b"main" or parent is not None and parent.in_main
        self.article = self.in_article or self.in_main
        self.holds = False  # an article or main lies inside
        self.bytes = 0  # hash of its bytes so far
        self.hash: int | None = None
        self.chars = 0  # of the main text
        self.mark = -1


class Page(NamedTuple):
    """Main text of a page: blocks, each with the innermost element (an index of
    `nodes`, or -1) whose removal takes it; distinct hashes of the subtrees; per
    node the hash, the node around it and whether it lies in an article."""

    blocks: list[tuple[str, int]]
    hashes: list[int]
    nodes: list[int]
    parents: list[int]
    inside: list[bool]


def parse(html: bytes, spared: frozenset[int] | None = None) -> Page:
    """Furniture that starts at `spared` is no furniture; by default that is
    found out first."""
    stack: list[Element] = [Element(b"", None, False, None)]
    places: defaultdict[bytes, list[int]] = defaultdict(list)  # where each tag is open in the stack
    blocks_open: list[int] = []
    elements: list[Element] = []
    blocks: list[tuple[str, Element]] = []
    pieces: list[str] = []
    seen_article = seen_main = article_title = False
    furniture: list[Furniture] = []
    total_chars, article_outside = 0, False
    pos, size, hashed_to = 0, len(html), 0
    tags_end = html.rfind(b">") + 1

    def flush() -> None:
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                blocks.append((text, stack[-1]))

    def hash_to(end: int) -> None:
        nonlocal hashed_to
        if end > hashed_to:
            stack[-1].bytes = xxhash.xxh3_64_intdigest(html[hashed_to:end], stack[-1].bytes)
            hashed_to = end

    def close(upto: int, end: int) -> None:
        """Close the elements from `upto`, the last of which ends at `end`."""
        for i in range(len(stack) - 1, upto - 1, -1):
            e = stack[i]
            if e.tag in BLOCKS:
                flush()
                blocks_open.pop()
            if i == upto:
                hash_to(end)
            if e.tag not in KEEP_OPEN and not e.holds and (not e.article or e.tag in CONTAINERS):
                # the last bit says whether it is a container
                e.hash = (e.bytes - (1 << 63)) & ~1 | (e.tag in CONTAINERS)
            places[e.tag].pop()
            stack.pop()
            stack[-1].bytes = xxhash.xxh3_64_intdigest(e.bytes.to_bytes(8, "little"), stack[-1].bytes)

    def nearest(tags: frozenset[bytes]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    while pos < size:
        m = TOKEN.search(html, pos, tags_end) if pos < tags_end else None
        at = m.start() if m else html.find(b"<!--", max(pos, tags_end))
        at = size if at < 0 else at
        if at > pos:
            inner = stack[-1].furniture
            if spared is None and not (inner and inner.silent):
                chars = sum(map(len, html[pos:at].split()))
                total_chars += chars
                if inner:
                    inner.chars += chars
            if not stack[-1].dropped:
                pieces.append(html[pos:at].decode("utf-8", "replace"))
        if not m:
            break
        pos = m.end()
        tag = (m[2] or m[5] or b"").lower()
        if not tag:
            if pos == tags_end and m[0].startswith(b"<!--") and not m[0].endswith(b"-->"):
                break  # a comment that does not end
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or b""
        if closing:
            if tag == b"br":
                pieces.append(" ")
            elif places[tag]:
                hash_to(at)
                close(places[tag][-1], pos)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in VOID:
            if tag == b"hr":
                flush()
            elif not stack[-1].dropped:
                pieces.append(" " if tag == b"br" else "")
            continue
        hash_to(at)
        if tag in CLOSES_P and blocks_open and stack[blocks_open[-1]].tag == b"p":
            close(blocks_open[-1], at)
        if tag in ENDS:
            ended, bound = (nearest(tags) for tags in ENDS[tag])
            if ended > bound:
                close(ended, at)
        if tag in BLOCKS:
            flush()
        parent = stack[-1]
        kind = furniture_kind(tag, attributes, parent.article)
        around = parent.furniture
        if kind:
            around = Furniture(at, kind, around)
            furniture.append(around)
        elif tag in (b"article", b"main") and not parent.in_article:
            # furniture by a word that holds an article stays, so it does not hide it
            article_outside |= around is None or around.by_word
            f = around
            while f is not None and not f.article:
                f.article, f = True, f.outer
        element = Element(tag, parent, parent.dropped or kind == NO_TEXT or kind > 0 and at not in (spared or ()), around)
        if not element.dropped:
            seen_article |= tag == b"article"
            seen_main |= tag == b"main"
            article_title |= tag == b"h1" and element.in_article
            if tag in (b"article", b"main"):
                e = element
                while e is not None and not e.holds:
                    e.holds, e = True, e.parent
        if attributes.endswith(b"/") and tag not in BLOCKS:
            continue
        places[tag].append(len(stack))
        if tag in BLOCKS:
            blocks_open.append(len(stack))
        stack.append(element)
        elements.append(element)
        if tag in RAW:
            end = re.compile(rb"</" + re.escape(tag) + rb"(?=[\s/>])", re.I).search(html, pos)
            pos = end.start() if end else size
    hash_to(size)
    if len(stack) > 1:
        close(1, size)
    flush()
    for f in reversed(furniture):
        if f.outer:
            f.outer.chars += f.chars
    if spared is None and (back := held_back([f for f in furniture if f.kind < NO_TEXT], total_chars, article_outside)):
        return parse(html, back)
    if seen_article and not article_title:
        beside = max((len(text) for text, e in blocks if not e.in_article), default=0)
        seen_article = beside <= sum(len(text) for text, e in blocks if e.in_article)
    taken = [(text, e) for text, e in blocks if (e.in_article if seen_article else e.in_main if seen_main else True)]
    return marked_page(taken, elements)


def marked_page(taken: list[tuple[str, Element]], elements: list[Element]) -> Page:
    total = sum(len(text) for text, _ in taken)
    for text, e in taken:
        e.chars += len(text)
    for e in reversed(elements):  # children come after their parents
        e.parent.chars += e.chars
    hashes, nodes, parents, inside = set(), [], [], []
    for e in elements:
        e.mark = e.parent.mark
        if e.hash is not None and 3 * e.chars <= 2 * total:
            hashes.add(e.hash)
            if e.chars:
                nodes.append(e.hash)
                parents.append(e.mark)
                inside.append(e.article)
                e.mark = len(nodes) - 1
    return Page([(text, e.mark) for text, e in taken], sorted(hashes), nodes, parents, inside)


def text_left(texts: list[str], marks: list[int], nodes: list[int], parents: list[int], inside: list[bool], gone: set[int], most: set[int]) -> str:
    """The blocks in no removed element: hashes of `gone`, in an article of `most`."""
    dead: list[bool] = []
    for node, parent, within in zip(nodes, parents, inside, strict=True):
        dead.append(parent >= 0 and dead[parent] or node in (most if within else gone))
    return "\n".join(text for text, mark in zip(texts, marks, strict=True) if mark < 0 or not dead[mark])


PARSED = T.StructType([
    T.StructField("row", T.LongType()),
    T.StructField("host", T.StringType()),
    T.StructField("page", T.StructType([])),
    T.StructField("body", T.LongType()),
    T.StructField("hashes", T.ArrayType(T.LongType())),
    T.StructField("text", T.StringType()),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("marks", T.ArrayType(T.IntegerType())),
    T.StructField("nodes", T.ArrayType(T.LongType())),
    T.StructField("parents", T.ArrayType(T.IntegerType())),
    T.StructField("inside", T.ArrayType(T.BooleanType())),
])


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, few_pages: int = FEW_PAGES,
    container_share: float = CONTAINER_SHARE, article_share: float = ARTICLE_SHARE,
) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of `pages`."""
    host, _ = host_and_path(F.col(url))
    source = pages.select(
        F.monotonically_increasing_id().alias("row"), host.alias("host"),
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"),
    )
    carried = [f for f in source.schema if f.name in ("page_id", "url")]
    schema = T.StructType([f for f in PARSED if f.name != "page"] + carried)
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch["html"]:
                page = parse(value or b"")
                texts = [t for t, _ in page.blocks]
                text = "\n".join(texts)
                body = xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)
                if page.nodes:
                    rows.append((body, page.hashes, None, texts, [m for _, m in page.blocks], page.nodes, page.parents, page.inside))
                else:
                    rows.append((body, page.hashes, text, None, None, [], None, None))
            done = pd.DataFrame(rows, columns=names[2:-2], index=batch.index, dtype=object)
            yield pd.concat([batch.drop(columns="html"), done], axis=1)[names]

    parsed = stored(source.mapInPandas(run, schema), "pages-parsed")
    # pages of a host with equal text count once
    bodies = stored(parsed.groupBy("host", "body").agg(F.min("hashes").alias("hashes")).drop("body"), "pages-bodies")
    sizes = bodies.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("_pages"))
    counts = bodies.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(min_pages, few_pages))
    enough = F.col("n") >= F.least(F.lit(min_pages), F.greatest(F.lit(few_pages), F.col("_pages")))
    container = F.col("hash").bitwiseAND(F.lit(1)) == 1
    shared = F.col("n") >= F.col("_pages") * F.when(container, container_share).otherwise(min_share)
    template = stored(
        counts.join(sizes, F.col("host") == F.col("_host")).where(enough & shared)
        .select(F.col("host").alias("_host"), F.col("hash").alias("_hash"), (F.col("n") >= F.col("_pages") * article_share).alias("_most")),
        "pages-template")
    discard(bodies)
    open_pages = parsed.where(F.size("nodes") > 0)
    gone = (
        open_pages.select("row", "host", F.explode(F.array_distinct("nodes")).alias("hash"))
        .join(template, (F.col("host") == F.col("_host")) & (F.col("hash") == F.col("_hash")))
        .groupBy(F.col("row").alias("_row")).agg(F.collect_list("hash").alias("gone"), F.collect_list(F.when(F.col("_most"), F.col("hash"))).alias("most"))
    )
    columns = ["texts", "marks", "nodes", "parents", "inside", "gone", "most"]
    decided = open_pages.join(gone, F.col("row") == F.col("_row"), "left").select("page_id", "url", *columns)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                text_left(*parts, set() if gone is None else set(gone), set() if most is None else set(most))
                for *parts, gone, most in zip(*[batch[c] for c in columns], strict=True)]
            yield batch[["page_id", "url"]].assign(text=pd.Series(texts, index=batch.index, dtype=object))

    decided = decided.mapInPandas(decide, T.StructType([*carried, T.StructField("text", T.StringType())]))
    settled = parsed.where(F.size("nodes") == 0).select("page_id", "url", "text")
    return settled.unionByName(decided).select(
        F.col("page_id").alias(page_id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
