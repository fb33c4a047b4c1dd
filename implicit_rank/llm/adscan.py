"""Nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm
(0 for queries), so that the largest inner product is the least distance; then
all are turned by one random rotation. An inverted index deals them to lists
around k-means centroids that are fitted on a bounded sample. A query probes
its nearest lists; inside a list the rotated coordinates are read in column
blocks, and after each block a hypothesis test on the partial distance
abandons candidates that are unlikely to be nearer than the query's current
k-th: with d of D coordinates read, one is dropped if its partial squared
distance times D / d exceeds (1 + EPSILON / sqrt(d))^2 times the k-th. What
survives all blocks is scored exactly on the original vectors.

The first round scans each query's nearest list and gives the threshold of
the second, which scans the others. How many lists are probed is chosen by
measurement: up to ``TRIAL_QUERIES`` queries are answered exactly by one pass
over all vectors, and the least number of lists that holds ``RECALL`` of their
neighbours is taken. A query goes on to further lists until those it probes
hold k + 1 ids.

Equal vectors are indexed once, with the k + 1 least ids; equal queries are
searched once. Lists are cut into cells of about ``CELL`` vectors and at most
about ``CELL`` queries, so a dense region is many even cells.

Defined cases: vectors that are null, empty or zero, hold null or non-finite
components, or have another length than most, and rows without an id take no
part; repeated rows count once; of several vectors under one id all are
candidates (but not for a query of that id) and the least is the query; ties
go to the smaller id; fewer than k candidates are all returned; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.llm import common

LIST = 512              # vectors a list holds on average
MOST_LISTS = 1024
SAMPLE = 16_384         # at most so many vectors fit the centroids
CELL = 512
BLOCK = 16              # coordinates in a column block
PAIRS = 1 << 16         # surviving pairs scored at once
EPSILON = 2.1           # of the hypothesis test
TRIAL_QUERIES = 64
RECALL = 0.97           # aim of the measurement that picks the number of probes


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, without repeats."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    rows = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(~bad & some))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("vec") == (size["d"] if size else 0)).distinct()


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column or a pandas column of lists as a matrix."""
    if isinstance(column, pd.Series):
        return np.array(column.tolist(), float)
    array = column if isinstance(column, pa.Array) else column.combine_chunks()
    return array.flatten().to_numpy().reshape(len(array), -1)


@dataclass
class Index:
    """What every task needs: bounded by MOST_LISTS centroids of one vector's length."""
    top: float                # largest norm
    rotation: np.ndarray      # (D, D), D = length + 1
    centroids: np.ndarray     # (lists, D), rotated

    def turn(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, last[:, None]]) @ self.rotation

    def order(self, turned: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        c = self.centroids
        return (turned * turned).sum(axis=1)[:, None] - 2 * turned @ c.T + (c * c).sum(axis=1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


def fit(distinct: DataFrame, seed: int = 5) -> Index | None:
    """Fit the index on at most SAMPLE of the distinct vectors, taken by hash order."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, top = distinct.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return None
    picked = distinct.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(SAMPLE).select("vec").toArrow()
    x = _matrix(picked.column("vec"))
    d = x.shape[1] + 1
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    index = Index(float(top), rotation, np.zeros((1, d)))
    index.centroids = _kmeans(index.turn(x), max(1, min(MOST_LISTS, n // LIST, len(x))), seed=seed)
    return index


def _assign(distinct: DataFrame, shared) -> DataFrame:
    """(vec, ids, list) of every distinct vector."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near = shared.value.order(shared.value.turn(_matrix(batch.column("vec")))).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("vec"), batch.column("ids"), pa.array(near.astype(np.int32))],
                                                 names=["vec", "ids", "list"])

    return distinct.select("vec", "ids").mapInArrow(run, "vec array<double>, ids array<long>, list int")


def _held(assigned: DataFrame, lists: int) -> np.ndarray:
    """Number of ids of each list, without those that are in other lists too."""
    of_id = assigned.select(F.explode("ids").alias("id"), "list").groupBy("id").agg(F.min("list").alias("list"), F.max("list").alias("most"))
    counts = of_id.filter("list = most").groupBy("list").count().toArrow()  # <= MOST_LISTS rows
    out = np.zeros(lists, np.int64)
    out[counts.column("list").to_numpy()] = counts.column("count").to_numpy()
    return out


def _probes(queries: DataFrame, shared, n_probe: int, held: np.ndarray, k: int) -> DataFrame:
    """(qkey, vec, list, turn): the lists a query probes, nearest first.

    n_probe lists, and as many more as it takes to hold k + 1 ids.
    """

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                far = shared.value.order(shared.value.turn(_matrix(batch.column("vec")), query=True))
                lists = np.argsort(far, axis=1, kind="stable").astype(np.int32)
                enough = 1 + (np.cumsum(held[lists], axis=1) <= k).sum(axis=1)
                rows, turns = np.nonzero(np.arange(lists.shape[1]) < np.maximum(enough, n_probe)[:, None])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("qkey").take(take), batch.column("vec").take(take), pa.array(lists[rows, turns]),
                     pa.array(turns.astype(np.int32))], names=["qkey", "vec", "list", "turn"])

    return queries.select("qkey", "vec").mapInArrow(run, "qkey long, vec array<double>, list int, turn int")


def choose_probes(assigned: DataFrame, queries: DataFrame, index: Index, k: int) -> int:
    """The least number of lists that holds RECALL of the trial queries' neighbours."""
    trial = (queries.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(TRIAL_QUERIES).select("vec")).toArrow()
    if not trial.num_rows or len(index.centroids) == 1:
        return 1
    q = _matrix(trial.column("vec"))
    shared = assigned.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                scores = shared.value @ _matrix(batch.column("vec")).T
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
                rows = np.repeat(np.arange(len(best)), best.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), batch.column("list").take(pa.array(best.ravel())), pa.array(scores[rows, best.ravel()])],
                    names=["q", "list", "score"])

    best = Window.partitionBy("q").orderBy(F.desc("score"))
    truth = (assigned.select("vec", "list").mapInArrow(run, "q long, list int, score double")
             .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).toPandas())  # TRIAL_QUERIES * (k + 1) rows
    place = np.argsort(np.argsort(index.order(index.turn(q, query=True)), axis=1, kind="stable"), axis=1)
    found = np.sort(place[truth["q"], truth["list"]])
    return int(found[min(len(found) - 1, int(np.ceil(RECALL * len(found))) - 1)]) + 1


def scan_cell(index: Index, x: np.ndarray, q: np.ndarray, tau: np.ndarray, k: int):
    """Scan one cell for several queries: (query row, vector row, score) of the k + 1 best of each.

    ``tau`` is a score that a candidate has to reach, -inf if there is none
    yet. The block of columns is read for all queries at once, of the queries
    and vectors that are still in some live pair.
    """
    turned, asked = index.turn(x), index.turn(q, query=True)
    d = turned.shape[1]
    # squared distance that belongs to a score of tau; rounding gets a little room
    limit = ((asked * asked).sum(axis=1) + index.top ** 2 - 2 * tau) * (1 + 1e-9) + 1e-12
    rows, columns = np.arange(len(q)), np.arange(len(x))
    live, partial = np.ones((len(q), len(x)), bool), np.zeros((len(q), len(x)))
    for start in range(0, d, BLOCK):
        stop = min(start + BLOCK, d)
        a, b = asked[rows, start:stop], turned[columns, start:stop]
        partial += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
        if stop == d:
            break
        # infinite limits keep everything
        live &= partial * d <= (limit[rows] * stop * (1 + EPSILON / np.sqrt(stop)) ** 2)[:, None]
        keep_rows, keep_columns = live.any(axis=1), live.any(axis=0)
        if not keep_rows.all() or not keep_columns.all():
            rows, columns = rows[keep_rows], columns[keep_columns]
            live, partial = (m[np.ix_(keep_rows, keep_columns)] for m in (live, partial))
    r, c = np.nonzero(live & (partial <= limit[rows][:, None] + 1e-6 * (1 + index.top ** 2)))
    r, c = rows[r], columns[c]
    scores = np.concatenate([np.einsum("ij,ij->i", x[c[at:at + PAIRS]], q[r[at:at + PAIRS]]) for at in range(0, len(r), PAIRS)]
                            or [np.zeros(0)])
    good = scores >= tau[r]
    r, c, scores = r[good], c[good], scores[good]
    order = np.lexsort([-scores, r])
    r, c, scores = r[order], c[order], scores[order]
    first = np.searchsorted(r, r)  # where each query's candidates begin
    best = np.arange(len(r)) - first
    last = scores[np.minimum(first + k, len(r) - 1)]  # ties with the last one stay: ids decide later
    keep = (best <= k) | ((scores == last) & (r[np.minimum(first + k, len(r) - 1)] == r))
    return r[keep], c[keep], scores[keep]


def best_ids(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k + 1 best (scores, ids): score descending, then id."""
    order = np.lexsort([ids, -scores])
    first = np.sort(np.unique(ids[order], return_index=True)[1])  # an id under two vectors counts once, at its best
    order = order[first][:k + 1]
    return scores[order], ids[order]


FOUND = "qkey long, scores array<double>, ids array<long>"


def _merge(found: DataFrame, k: int) -> DataFrame:
    """One row per query: the k + 1 best of its cells (a group: the query's probed cells)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        scores, ids = best_ids(np.concatenate(group["scores"].tolist()), np.concatenate(group["ids"].tolist()), k)
        return pd.DataFrame({"qkey": [key[0]], "scores": [scores], "ids": [ids]})

    return found.groupBy("qkey").applyInPandas(run, FOUND)


def _round(cells: DataFrame, probes: DataFrame, sizes: dict[int, int], shared, k: int) -> DataFrame:
    """Scan the probed lists of (qkey, vec, list, tau) rows; a row per query and cell with a find.

    A list is cut into ``sizes[list]`` cells of vectors, and the queries of a
    list into groups of about CELL: every pair of both is one task's group.
    """
    asked = {r["list"]: -(-r["count"] // CELL) for r in probes.groupBy("list").count().collect()}  # <= MOST_LISTS rows
    spark = cells.sparkSession
    plan = spark.createDataFrame([(k_, sizes.get(k_, 1), q) for k_, q in asked.items()] or [(-1, 1, 1)],
                                 "list int, v_cells int, q_cells int")
    plan = F.broadcast(plan)  # <= MOST_LISTS rows
    left = (cells.join(plan, "list").select(
        "list", F.pmod(F.xxhash64("vec"), F.col("v_cells")).cast("int").alias("v"),
        F.explode(F.sequence(F.lit(0), F.col("q_cells") - 1)).alias("q"), "vec", "ids"))
    right = (probes.join(plan, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("v_cells") - 1)).alias("v"),
        F.pmod(F.xxhash64("qkey"), F.col("q_cells")).cast("int").alias("q"), "qkey", "vec", "tau"))

    nothing = pd.DataFrame({"qkey": [], "scores": [], "ids": []}, dtype=object)  # empty float columns are no lists

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return nothing
        row, column, scores = scan_cell(shared.value, _matrix(vectors["vec"]), _matrix(queries["vec"]),
                                        queries["tau"].to_numpy(float), k)
        ids = vectors["ids"].to_numpy()
        counts = np.fromiter(map(len, ids), np.int64, len(ids))[column]
        flat = np.concatenate(list(ids[column])) if len(column) else np.zeros(0, np.int64)
        asked, begins = np.unique(row, return_index=True)
        ends = np.concatenate([[0], np.cumsum(counts)])[begins[1:]] if len(begins) else []
        return pd.DataFrame({"qkey": queries["qkey"].to_numpy()[asked], "scores": np.split(np.repeat(scores, counts), ends),
                             "ids": np.split(flat, ends)}) if len(asked) else nothing

    by = ["list", "v", "q"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, FOUND)


def search(candidates: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product of each query.

    A candidate with the query's own id is left out.
    """
    spark = candidates.sparkSession
    rows = common.save(usable(candidates, id_col, vec_col), "ann-rows")
    least = Window.partitionBy("vec").orderBy("id")  # a group limit of k + 1 before the shuffle
    distinct = common.save(rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
                           .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ann-distinct")
    asked = common.save(usable(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec")), "ann-queries")
    keys = common.save(asked.groupBy("vec").agg(F.min("id").alias("qkey")), "ann-keys")
    index = fit(distinct)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if index is None:
        return empty
    shared = spark.sparkContext.broadcast(index)
    assigned = common.save(_assign(distinct, shared), "ann-lists")
    sizes = {r["list"]: -(-r["count"] // CELL) for r in assigned.groupBy("list").count().collect()}  # <= MOST_LISTS rows
    probes = common.save(_probes(keys, shared, choose_probes(assigned, keys, index, k),
                                 _held(assigned, len(index.centroids)), k), "ann-probes")
    first = common.save(_merge(_round(assigned, probes.filter("turn = 0").withColumn("tau", F.lit(float("-inf"))), sizes,
                                      shared, k), k), "ann-first")
    tau = first.select(F.col("qkey").alias("key"), F.when(F.size("scores") > k, F.element_at("scores", -1)).alias("tau"))
    others = (probes.filter("turn > 0").join(tau, F.col("qkey") == F.col("key"), "left")
              .select("qkey", "vec", "list", F.coalesce("tau", F.lit(float("-inf"))).alias("tau")))
    second = _round(assigned, common.save(others, "ann-others"), sizes, shared, k)
    best = common.save(_merge(first.unionByName(second), k), "ann-best")
    named = asked.join(keys, "vec").select(F.col("id").alias("query_id"), "qkey")
    pairs = F.slice(F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id")), 1, k)
    return (common.save(named, "ann-named").join(best, "qkey").select("query_id", F.posexplode(pairs).alias("pos", "hit"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.ids").alias("vec_id"),
                    F.col("hit.scores").alias("score")))
