"""Embedding near-duplicates: all cosines above a threshold by PCA-ordered tiles.

Vectors are turned to the principal axes of a bounded sample, which changes no
cosine but puts most of the variation into the leading coordinates. Distinct
vectors are ordered by the signs of their leading coordinates, cut into blocks
and packed, a block a row. Two blocks meet in one task unless the boxes around
their leading coordinates are too far apart. Inside, tiles of both are compared:
products are accumulated over the leading coordinates first; what the others can
still add is at most the product of the vectors' suffix norms (Cauchy-Schwarz).
Once no pair of the tile can reach the threshold it is left; rows and columns
without a live pair go. What remains is decided by the cosine of the original
vectors in double precision. The bounds are exact, so no pair is missed, and the
sample and the order only change how much is left out.

A task returns one row per linked vector of its two blocks: the number of its
links and one vector of its group there, found by union of the tile's links. So a
dense group of vectors costs rows in proportion to vectors and blocks, not to
its pairs. Components are joined from these rows by alternating stars.

The work is at worst the square of the number of distinct vectors, in block
pairs of ``BLOCK`` rows: nearly isotropic vectors leave no block pair out, and
then every pair is looked at in its leading coordinates.

Defined cases: vectors that are null, empty or zero or hold null or non-finite
components link with nothing and are returned with no links and as their own
component; vectors of different lengths do not link; rows are vertices, so
repeated rows link with each other and rows that share an id are counted each;
a component's id is its least non-null id, and a row without an id is kept
where its component has none; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common, graph

BLOCK_BYTES = 2 << 20   # of packed vectors in a block
BLOCK = 8192            # at most so many vectors in a block
TILE = 512
SAMPLE = 16_384         # at most so many vectors fit the axes (their choice affects speed only)
SIGNS = 16              # leading coordinates whose signs order the vectors and that boxes cover
LEAD = 16               # coordinates accumulated before the first bound; the next steps double
SLACK = 1e-4            # room for single-precision rounding in bounds
LENGTHS = 1 << 40       # vector numbers of one length


def usable(column):
    """Whether a vector can link: there, finite and not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(column.isNotNull() & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def _units(flat: np.ndarray, d: int) -> np.ndarray:
    x = flat.astype(float).reshape(-1, d)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(distinct: DataFrame) -> np.ndarray | None:
    """Principal axes (columns, widest first) of a sample of the most common length."""
    common_length = distinct.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    if common_length is None:
        return None
    d = common_length["d"]
    picked = (distinct.filter(F.col("d") == d).select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(SAMPLE)
              .select("vec").toArrow())
    u = _units(np.concatenate([c.flatten().to_numpy() for c in picked.column("vec").chunks]), d)
    return np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()


def _turned(u: np.ndarray, turn: np.ndarray | None) -> np.ndarray:
    return u @ turn if turn is not None and len(turn) == u.shape[1] else u


def _coded(distinct: DataFrame, shared) -> DataFrame:
    """``distinct`` (vec, d, copies, first_id) with code: the signs of the leading coordinates."""

    def run(batches):
        for batch in batches:
            sizes, vecs = batch.column("d").to_numpy(), batch.column("vec")
            code = np.zeros(len(sizes), np.int64)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                lead = _turned(_units(vecs.take(pa.array(at)).flatten().to_numpy(), int(d)), shared.value)[:, :SIGNS]
                code[at] = ((lead > 0) * (1 << np.arange(lead.shape[1])[::-1])).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    schema = ", ".join(f"{n} {t}" for n, t in distinct.dtypes)
    return distinct.mapInArrow(run, f"{schema}, code long")


def block_rows(d: int, width: int, most: int) -> int:
    return max(64, min(most, BLOCK_BYTES // (d * width)))


def _packed(placed: DataFrame, shared, kind: str) -> DataFrame:
    """(d, block, n, data, copies, low, high): a block a row, with the box of its leading coordinates."""
    width = np.dtype(kind).itemsize

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        d, block = key[0].as_py(), key[1].as_py()
        flat = common.one_array(group.column("vec")).flatten().to_numpy()
        lead = _turned(_units(flat, d), shared.value)[:, :SIGNS]
        return pa.table({"d": pa.array([d], pa.int32()), "block": pa.array([block], pa.int64()), "n": pa.array([group.num_rows], pa.int64()),
                         "data": pa.array([flat.astype(kind).tobytes()], pa.binary()),
                         "copies": pa.array([group.column("copies").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                         "low": pa.array([lead.min(axis=0).tolist()], pa.list_(pa.float64())),
                         "high": pa.array([lead.max(axis=0).tolist()], pa.list_(pa.float64()))})

    rows = F.greatest(F.lit(64), F.least(F.lit(BLOCK), F.expr(f"{BLOCK_BYTES} div (d * {width})")))
    return (placed.select("d", F.floor(F.col("pos") / rows).cast("long").alias("block"), "pos", "vec", "copies").groupBy("d", "block")
            .applyInArrow(pack, "d int, block long, n long, data binary, copies binary, low array<double>, high array<double>"))


class Side:
    """One block in a task: unit vectors, turned coordinates, suffix norms."""

    def __init__(self, row: dict, kind: str, turn: np.ndarray | None):
        d = row["d"]
        self.unit = _units(np.frombuffer(row["data"], kind), d)
        self.copies = np.frombuffer(row["copies"], np.int64)
        turned = _turned(self.unit, turn)
        self.stops = [0]
        while self.stops[-1] < d:
            self.stops.append(min(d, max(LEAD, 2 * self.stops[-1])))
        tails = np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = [np.sqrt(tails[:, s]).astype(np.float32) if s < d else np.zeros(len(turned), np.float32) for s in self.stops]
        self.turned = turned.astype(np.float32)
        self.tiles = [slice(s, min(s + TILE, len(turned))) for s in range(0, len(turned), TILE)]
        self.boxes = [(turned[t, :SIGNS].min(axis=0), turned[t, :SIGNS].max(axis=0)) for t in self.tiles]
        self.links = np.zeros(len(turned), np.int64)


def box_gap(a: tuple, b: tuple) -> float:
    """Least squared distance of two boxes."""
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float((gap * gap).sum())


def tile_links(a: Side, ta: slice, b: Side, tb: slice, threshold: float):
    """(rows, columns, links): the part of the tile that can hold links, and which of its pairs are."""
    rows, columns = np.arange(ta.start, ta.stop), np.arange(tb.start, tb.stop)
    partial = np.zeros((len(rows), len(columns)), np.float32)
    for step, (start, stop) in enumerate(zip(a.stops, a.stops[1:]), 1):
        partial += a.turned[rows, start:stop] @ b.turned[columns, start:stop].T
        live = partial + np.multiply.outer(a.suffix[step][rows], b.suffix[step][columns]) >= threshold - SLACK
        keep_rows, keep_columns = live.any(axis=1), live.any(axis=0)
        if not keep_rows.any():
            return rows[:0], columns[:0], live[:0, :0]
        if not keep_rows.all() or not keep_columns.all():
            partial = partial[np.ix_(keep_rows, keep_columns)]
            rows, columns = rows[keep_rows], columns[keep_columns]
    return rows, columns, a.unit[rows] @ b.unit[columns].T >= threshold


def merge(label: np.ndarray, rows: np.ndarray, columns: np.ndarray, links: np.ndarray) -> None:
    """Union of each row with its linked columns in ``label`` (least number of each group)."""
    for i in np.flatnonzero(links.any(axis=1)):
        met = label[columns[links[i]]]
        least = min(int(met.min()), int(label[rows[i]]))
        if label[rows[i]] != least or (met != least).any():
            old = np.unique(np.append(met, label[rows[i]]))
            label[np.isin(label, old)] = least


def compare(a: Side, b: Side | None, threshold: float) -> np.ndarray:
    """Labels of the vectors of ``a``, then ``b`` (None: ``a`` with itself); counts links in both sides.

    Links are weighed by copies; a vector's own copies are not counted here.
    """
    same = b is None
    b = a if same else b
    far = 2 - 2 * threshold + SLACK
    shift = 0 if same else len(a.unit)
    label = np.arange(shift + len(b.unit))
    for p, (ta, box_a) in enumerate(zip(a.tiles, a.boxes)):
        for q, (tb, box_b) in enumerate(zip(b.tiles, b.boxes)):
            if same and q < p or box_gap(box_a, box_b) > far:
                continue
            rows, columns, links = tile_links(a, ta, b, tb, threshold)
            if same and p == q and len(rows):
                links &= rows[:, None] != columns
            if not links.any():
                continue
            a.links[rows] += links @ b.copies[columns]
            if not same or p != q:
                b.links[columns] += a.copies[rows] @ links
            merge(label, rows, columns + shift, links)
    return label


def _linked(blocks: DataFrame, shared, kind: str, threshold: float) -> DataFrame:
    """(key, links, root): a row per block pair and vector that has links in it; root: a vector of its group."""
    far = 2 - 2 * threshold + SLACK
    width = np.dtype(kind).itemsize
    boxes = blocks.select("d", "block", "low", "high")
    ends = F.expr("max(block) OVER (PARTITION BY d)")  # a row per block
    pairs = boxes.withColumn("last", ends).select("d", F.col("block").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"),
                                                  F.explode(F.sequence("block", "last")).alias("j"))
    other = boxes.select("d", F.col("block").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    gaps = F.expr("aggregate(zip_with(zip_with(low_i, high_j, (a, b) -> a - b), zip_with(low_j, high_i, (a, b) -> a - b),"
                  " (a, b) -> greatest(a, b, 0D)), 0D, (s, g) -> s + g * g)")
    pairs = common.save(pairs.join(other, ["d", "j"]).filter(gaps <= far).select("d", "i", "j"), "near-pairs")
    packed = blocks.select("d", "block", "data", "copies")
    columns = [F.col(c).alias(c) for c in ("d", "i", "j", "data", "copies")]  # aliased anew: both sides read one table
    left, right = (pairs.join(packed.withColumnRenamed("block", side), ["d", side]).select(columns) for side in ("i", "j"))

    def run(key: tuple, one: pa.Table, two: pa.Table) -> pa.Table:
        d, i, j = (k.as_py() for k in key)
        a = Side(one.to_pylist()[0], kind, shared.value)
        b = None if i == j else Side(two.to_pylist()[0], kind, shared.value)
        label = compare(a, b, threshold)
        size = block_rows(d, width, BLOCK)
        keys = d * LENGTHS + i * size + np.arange(len(a.unit))
        links = a.links
        if b is not None:
            keys = np.concatenate([keys, d * LENGTHS + j * size + np.arange(len(b.unit))])
            links = np.concatenate([links, b.links])
        some = links > 0
        return pa.table({"key": keys[some], "links": links[some], "root": keys[label[some]]})

    by = ["d", "i", "j"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "key long, links long, root long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links at a cosine of ``threshold`` or more.

    ``kept`` marks the row that stands for its component.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("raw"))
    if dict(plain.dtypes)["raw"] != "array<float>":
        plain = plain.withColumn("raw", F.col("raw").cast("array<double>"))
    kind = "f4" if dict(plain.dtypes)["raw"] == "array<float>" else "f8"
    plain = plain.select("id", F.when(usable(F.col("raw")), F.col("raw")).alias("vec"))
    distinct = common.save(plain.filter("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
                           .withColumn("d", F.size("vec")), "near-distinct")
    turn = axes(distinct)
    alone = plain.filter("vec IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if turn is None:
        return _named(alone, id_col)
    shared = spark.sparkContext.broadcast(turn)
    coded = _coded(distinct.select("vec", "d", "copies", "first_id"), shared).withColumn("h", F.xxhash64("vec"))
    placed = common.save(common.placed(coded, "d", ["code", "h"], "near").select("vec", "d", "copies", "first_id", "pos"), "near-placed")
    blocks = common.save(_packed(placed, shared, kind), "near-blocks")
    linked = common.save(_linked(blocks, shared, kind, threshold), "near-links")
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    edges = linked.filter("key <> root").select(F.col("key").alias("u"), F.col("root").alias("v"))
    labels = graph.components(edges).select(F.col("node").alias("key"), "label")
    key = (F.col("d").cast("long") * LENGTHS + F.col("pos")).alias("key")
    grouped = common.save(placed.select(key, "vec", "copies", "first_id").join(counts, "key", "left").join(labels, "key", "left").select(
        "vec", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("label", "key").alias("label")), "near-groups")
    least = common.save(grouped.groupBy("label").agg(F.min("first_id").alias("component_id")), "near-least")
    found = common.save(grouped.join(least, "label").select("vec", "n_links", "component_id"), "near-found")
    return _named(plain.filter("vec IS NOT NULL").join(found, "vec").select("id", "n_links", "component_id").unionByName(alone), id_col)


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
