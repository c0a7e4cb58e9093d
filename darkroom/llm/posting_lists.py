"""Approximate nearest neighbours by balanced posting lists.

Centroids come from balanced k-means on a bounded sample. They are few enough
to hold in every task. A row to be placed searches them as a graph (each linked
to its nearest centroids; best-first with a beam); it goes to the posting lists
of its nearest centroid and, if it lies near a boundary, of the next ones whose
distance is within `closure` of the nearest. A query opens every list whose
centroid distance is within `prune` of its nearest one, found from its distances
to all centroids.

How many copies a row has and how far a query opens lists follow from each
corpus: up to `CALIBRATE` queries, chosen by hash, are scored against all rows,
and for each way of placing (`PLACINGS`) `prune` is the least ratio at which the
share `recall` of their true neighbours lies in an opened list, and `PRUNE` at
least. The placing that
then takes the least work is used. Vectors without structure need a large share
of the lists for that; the work grows then, not the misses.

Largest inner product becomes least distance by one extra coordinate
sqrt(M**2 - |x|**2). A list is scored by matrix product; what comes within
rounding of its k best is scored again as an inner product in double precision,
summed in component order, so equal vectors score alike wherever they lie.

Scale: every row is indexed. Of rows with equal vectors only the k + 1 with the
least ids can be in any answer, so posting lists hold these (a rank limit that
Spark applies before its shuffle), and a very common vector makes no long list.
Lists longer than `part_rows` are split into parts that each meet the list's
queries; queries come in blocks, and a query is sent once to the lists that are
scored together. Sample, centroids and calibration are bounded by `sample_rows`,
`max_lists` and `CALIBRATE` * k.

Defined results: vectors that are null, zero, hold a null or non-finite
component or have another length than most take no part, neither as query nor
candidate; null ids take no part; repeated rows are candidates one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from darkroom.llm.store import stored

K = 20
QUERY_EVERY = 20
#: Vectors that the centroids are fitted on, chosen by hash of their id.
SAMPLE_ROWS = 20_000
#: Rows per posting list aimed at, and the most lists.
LIST_ROWS = 256
MAX_LISTS = 2_000
#: Share of the calibration queries' true neighbours that opened lists must hold.
RECALL = 0.98
#: Lists up to (1 + prune) times the least centroid distance are opened in any case.
PRUNE = 0.13
#: Queries scored against all rows, and sampled vectors that list sizes are estimated from.
CALIBRATE = 256
SIZED = 4_000
#: Ways of placing: the most lists of a vector, and (1 + closure) times its least centroid distance as their bound.
PLACINGS = ((1, 0.0), (2, 0.012), (2, 0.05), (4, 0.05), (4, 0.15))
#: A row written and read again costs about as much as so many scored pairs.
ROW_COST = 300
#: Beam of the graph search for a row to be placed.
PLACE_BEAM = 16
DEGREE = 24
PART_ROWS = 4_096
QUERY_BLOCK = 512
#: So many lists are scored in one task, which then returns a query's best of all of them.
LISTS_TOGETHER = 16


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0))


def balanced_centroids(sample: np.ndarray, n: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means in which a cluster's squared distances grow with its excess size."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), n, replace=False)].copy()
    penalty = np.zeros(n)
    for _ in range(rounds):
        d = distances(sample, centres) ** 2
        owner = (d + penalty).argmin(1)
        size = np.bincount(owner, minlength=n)
        scale = float(d[np.arange(len(sample)), owner].mean())
        penalty += 0.2 * scale * (size / (len(sample) / n) - 1)
        penalty -= penalty.min()
        total = np.zeros_like(centres)
        np.add.at(total, owner, sample)
        full = size > 0
        centres[full] = total[full] / size[full, None]
    return centres


class CentroidGraph:
    """Centroids, each linked to its nearest ones and to a few spread ones."""

    def __init__(self, centres: np.ndarray, degree: int = DEGREE):
        self.centres = centres
        d = distances(centres, centres)
        self.links = np.argsort(d, axis=1, kind="stable")[:, 1:degree + 1] if len(centres) > 1 else np.zeros((1, 0), int)
        self.entry = np.linspace(0, len(centres) - 1, min(len(centres), 32)).astype(int)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the beam for each row, nearest first."""
        n, k = len(x), len(self.centres)
        width = min(beam, k)
        dist = np.full((n, k), np.inf)
        dist[:, self.entry] = distances(x, self.centres[self.entry])
        opened = np.zeros((n, k), bool)
        rows = np.arange(n)
        while len(rows):
            near_ones = np.argpartition(dist[rows], width - 1, axis=1)[:, :width] if width < k else np.tile(np.arange(k), (len(rows), 1))
            near = np.take_along_axis(dist[rows], near_ones, 1)
            near[np.take_along_axis(opened[rows], near_ones, 1)] = np.inf
            best = near.argmin(1)
            go = np.isfinite(near[np.arange(len(rows)), best])
            rows, best = rows[go], near_ones[go, best[go]]
            if not len(rows):
                break
            opened[rows, best] = True
            reach = self.links[best]
            row, col = np.repeat(rows, reach.shape[1]), reach.ravel()
            new = ~np.isfinite(dist[row, col])
            row, col = row[new], col[new]
            diff = x[row] - self.centres[col]
            dist[row, col] = np.sqrt((diff * diff).sum(1))
        order = np.argsort(dist, axis=1, kind="stable")[:, :width]
        return order, np.take_along_axis(dist, order, 1)


def best_of_list(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of every row within rounding of a query's k best in
    a list; scores are inner products added up component by component."""
    rough = queries @ rows.T
    if len(rows) > k:
        least = np.partition(rough, len(rows) - k, axis=1)[:, len(rows) - k]
        slack = 1e-9 * np.sqrt((queries * queries).sum(1) * (rows * rows).sum(1).max())
        q, r = np.nonzero(rough >= (least - slack)[:, None])
    else:
        q, r = (x.ravel() for x in np.indices(rough.shape))
    score = np.zeros(len(q))
    for d in range(queries.shape[1]):
        score += queries[q, d] * rows[r, d]
    return q, r, score


def exact_neighbours(rows: DataFrame, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the query, vector) of the k best of all rows for a few queries."""
    def first(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["q", "score", "id"], ascending=[True, False, True])
        return found[found.groupby("q").cumcount() < k].copy()

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for at in range(0, len(batch), PART_ROWS):
                part = batch.iloc[at:at + PART_ROWS]
                data, own = np.stack(part["v"].to_numpy()), part["id"].to_numpy()
                q, r, s = best_of_list(x, data, k + 1)
                other = ids[q] != own[r]
                new = first(pd.DataFrame({"q": q[other], "id": own[r[other]], "score": s[other], "r": r[other]}))
                new["v"] = pd.Series(list(data[new.pop("r").to_numpy(int)]), new.index, object)
                held = new if held is None else first(pd.concat([held, new]))
        if held is not None:
            yield held

    found = rows.mapInPandas(best, "q long, id long, score double, v array<double>")
    rank = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    got = found.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= k).select("q", "v").collect()
    return np.array([r["q"] for r in got], int), np.array([r["v"] for r in got]).reshape(len(got), x.shape[1])


def placed_in(near: np.ndarray, dist: np.ndarray, copies: int, closure: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of each copy, of what the graph search found."""
    row, col = np.nonzero(dist[:, :copies] <= (1 + closure) * dist[:, :1])
    return row, near[row, col]


def calibrated(
    graph: CentroidGraph, queries: np.ndarray, number: np.ndarray, neighbours: np.ndarray, sample: np.ndarray,
    n: int, n_queries: int, recall: float,
) -> tuple[int, float, float]:
    """(copies, closure, prune) of the least work at which the opened lists
    hold the share `recall` of the queries' true neighbours."""
    lists = len(graph.centres)
    if not len(number):
        return (*PLACINGS[0], 0.0)
    dist = distances(queries, graph.centres)
    ratio = dist / np.maximum(dist.min(1)[:, None], 1e-300)
    near, near_dist = graph.search(neighbours, PLACE_BEAM)
    some, some_dist = graph.search(sample, PLACE_BEAM)
    choices = []
    for copies, closure in PLACINGS:
        row, where = placed_in(near, near_dist, copies, closure)
        least = np.full(len(number), np.inf)
        np.minimum.at(least, row, ratio[number[row], where])
        bound = max(1 + PRUNE, np.sort(least)[min(len(least), math.ceil(recall * len(least))) - 1])
        _, taken = placed_in(some, some_dist, copies, closure)
        size = np.bincount(taken, minlength=lists) * (n / len(sample))
        opened = ratio <= bound
        lots = np.add.reduceat(opened, np.arange(0, lists, LISTS_TOGETHER), axis=1).astype(bool).sum(1).mean()
        work = n_queries * (opened @ size).mean() + ROW_COST * (n * len(taken) / len(sample) + n_queries * lots)
        choices.append((work, copies, closure, float(bound) - 1 + 1e-9))
    return min(choices)[1:]


def valid_vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = F.col(embedding).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = table.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    return rows.where(F.coalesce(fine, F.lit(False)))


def nearest_neighbours(
    table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", is_query: Column | None = None, k: int = K,
    sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS,
    recall: float = RECALL, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row (by default ids
    divisible by `QUERY_EVERY`) its k nearest rows but itself."""
    query = F.pmod(F.col("id"), F.lit(QUERY_EVERY)) == 0 if is_query is None else is_query
    rows = valid_vectors(table, vec_id, embedding)
    size = rows.agg(F.mode(F.size("v")).alias("d"))
    width = size.first()["d"]
    result = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return table.sparkSession.createDataFrame([], result)
    rows = stored(rows.where(F.size("v") == width), "vectors")
    asking = rows.where(query)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, longest, n_queries = rows.agg(F.count(F.lit(1)), F.max(norm), F.count_if(query)).first()
    if not n_queries:
        return table.sparkSession.createDataFrame([], result)
    sample = rows.select("v").orderBy(F.xxhash64("id", "v"), "id").limit(sample_rows)
    sample = np.array([r["v"] for r in sample.collect()])
    lists = int(max(1, min(max_lists, len(sample) // 8, n // list_rows)))
    lifted = lambda x: np.concatenate([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))[:, None]], axis=1)
    graph = CentroidGraph(balanced_centroids(lifted(sample), lists))

    by_vector = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1).drop("_n")
    # a query's own extra coordinate is 0; its distances order rows by inner product
    raised = lambda x: np.concatenate([x * np.sqrt(longest / np.maximum((x * x).sum(1), 1e-300))[:, None], np.zeros((len(x), 1))], axis=1)
    tried = asking.select("id", "v").orderBy(F.xxhash64("id", "v", F.lit(1)), "id").limit(CALIBRATE).collect()
    tried_ids, tried_v = np.array([r["id"] for r in tried], int), np.array([r["v"] for r in tried]).reshape(len(tried), width)
    number, true_ones = exact_neighbours(rows, tried_ids, tried_v, k)
    copies, closure, prune = calibrated(graph, raised(tried_v), number, lifted(true_ones), lifted(sample[:SIZED]), n, n_queries, recall)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at:at + 1000]
                if not len(part):
                    continue
                near, dist = graph.search(lifted(np.stack(part["v"].to_numpy())), PLACE_BEAM)
                row, where = placed_in(near, dist, copies, closure)
                yield pd.DataFrame({"list": where, "id": part["id"].to_numpy()[row], "v": part["v"].to_numpy()[row]})

    postings = stored(kept.mapInPandas(assign, "list long, id long, v array<double>"), "postings")
    sizes = {r["list"]: r["n"] for r in postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = {c: -(-m // part_rows) for c, m in sizes.items()}
    size_of = np.array([sizes.get(c, 0) for c in range(lists)])
    part_of = np.array([parts.get(c, 1) for c in range(lists)])
    lots = -(-lists // LISTS_TOGETHER)
    lot_parts = np.concatenate([part_of, np.zeros(lots * LISTS_TOGETHER - lists, int)]).reshape(lots, LISTS_TOGETHER)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at:at + 1000]
                if not len(part):
                    continue
                x = np.stack(part["v"].to_numpy())
                dist = distances(raised(x), graph.centres)
                near = np.argsort(dist, axis=1, kind="stable")
                dist = np.take_along_axis(dist, near, 1)
                seen = np.cumsum(size_of[near], axis=1) - size_of[near]
                row, col = np.nonzero((dist <= (1 + prune) * dist[:, :1]) | (seen < 10 * (k + 1)))
                opened = np.zeros((len(x), lots * LISTS_TOGETHER), bool)
                opened[row, near[row, col]] = True
                opened = opened.reshape(len(x), lots, LISTS_TOGETHER)
                row, lot = np.nonzero(opened.any(2))
                times = (opened[row, lot] * lot_parts[lot]).max(1)
                row, lot = np.repeat(row, times), np.repeat(lot, times)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                yield pd.DataFrame({"lot": lot, "part": piece, "id": part["id"].to_numpy()[row], "v": part["v"].to_numpy()[row], "open": opened[row, lot] @ (1 << np.arange(LISTS_TOGETHER))})

    asked = asking.mapInPandas(route, "lot long, part long, id long, v array<double>, open long")
    of_list = F.element_at(F.from_json(F.lit("[" + ",".join(map(str, part_of)) + "]"), "array<bigint>"), (F.col("list") + 1).cast("int"))
    placed = postings.withColumn("part", F.pmod(F.xxhash64("id"), of_list))

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        own = [(c % LISTS_TOGETHER, np.stack(r["v"].to_numpy()), r["id"].to_numpy()) for c, r in right.groupby("list")]
        for at in range(0, len(left), QUERY_BLOCK):
            some = left.iloc[at:at + QUERY_BLOCK]
            asked_ids, x, opened = some["id"].to_numpy(), np.stack(some["v"].to_numpy()), some["open"].to_numpy()
            found = []
            for c, data, ids in own:
                here = np.flatnonzero(opened >> c & 1)
                if not len(here):
                    continue
                q, r, s = best_of_list(x[here], data, k + 1)
                who = asked_ids[here[q]]
                other = who != ids[r]
                found.append(pd.DataFrame({"query_id": who[other], "vec_id": ids[r[other]], "score": s[other]}))
            if found:
                # a row that is in several lists is found alike in each
                every = pd.concat(found).drop_duplicates(["query_id", "vec_id"]).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                out.append(every[every.groupby("query_id").cumcount() < k])
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    placed = placed.withColumn("lot", F.floor(F.col("list") / LISTS_TOGETHER))
    found = asked.groupBy("lot", "part").cogroup(placed.groupBy("lot", "part")).applyInPandas(best, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
