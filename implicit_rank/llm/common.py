"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from implicit_rank.session import shared_folder

# Text gathered before a vectorised step runs; bounds a Python worker's memory.
TEXT_BATCH_BYTES = 8 << 20
ROW_BYTES = 32  # what a row counts besides its text, so that empty texts do not pile up


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For local sessions and shared file systems; elsewhere ship the package with
    ``spark-submit --py-files``.
    """
    import implicit_rank

    root = os.path.dirname(os.path.dirname(os.path.abspath(implicit_rank.__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage at files that every executor can read again.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def prefix_totals(totals: DataFrame, part: str, value: str) -> DataFrame:
    """(part, base): exclusive prefix sums over a table of one row per partition."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(value).over(before), F.lit(0)).alias("base"))


def placed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with pos, the place among the rows of the same ``tree`` (not null) in ``order``, and n, their number.

    A sort by ranges; equal rows and frequent trees are spread over ranges. Rows
    have no columns salt, at, part, first, base, pos or n.
    """
    kept = rows.columns
    # equal rows are told apart by a number, so that they need not share a range
    salted = save(rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), f"{name}-salted")
    by = [tree, *order, "salt"]
    ranged = save(salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
                  .withColumn("at", F.monotonically_increasing_id()), f"{name}-ranged")
    part = F.shiftright("at", 33)
    here = ranged.groupBy(tree, part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    earlier = Window.partitionBy(tree).orderBy("part")  # one row a partition
    base = here.select(tree, "part", "first", (F.sum("rows").over(earlier) - F.col("rows")).alias("base"),
                       F.sum("rows").over(Window.partitionBy(tree)).alias("n"))
    return (ranged.withColumn("part", part).join(base, [tree, "part"])
            .select(*kept, (F.col("base") + F.col("at") - F.col("first")).alias("pos"), "n"))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = TEXT_BATCH_BYTES, size_column: str | None = None) -> Iterator[pa.Table]:
    """Regroup batches so that each table holds about ``limit`` bytes of ``column``.

    ``size_column`` holds the sizes if ``column`` itself does not show them. A
    row is never cut: one text above the limit is a table of its own.
    """
    held, size = [], 0
    for batch in batches:
        sizes = batch.column(size_column) if size_column else pc.binary_length(batch.column(column))
        lengths = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
        start, n = 0, batch.num_rows
        while start < n:
            ends = np.cumsum(lengths[start:], dtype=np.int64)
            take = max(1, int(np.searchsorted(ends, limit - size, side="right")))
            if size and ends[0] > limit - size:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                continue
            held.append(batch.slice(start, take))
            size += int(ends[min(take, len(ends)) - 1])
            start += take
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def texts_of(chunk: pa.Table, column: str = "text") -> pa.Array:
    """The text column as one array, null as the empty text."""
    return pc.fill_null(chunk.column(column).combine_chunks(), "")


def packed(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(texts compressed one by one, their sizes in bytes), for a shuffle of whole texts."""
    data = [t.encode("utf-8") for t in strings(texts)]
    return (pa.array([pa.compress(t, codec="zstd", asbytes=True) for t in data], pa.binary()),
            pa.array([len(t) for t in data], pa.int64()))


def unpacked(cells: pa.Array, sizes: pa.Array) -> pa.Array:
    return pa.array([pa.decompress(c.as_buffer(), n, codec="zstd", asbytes=True).decode("utf-8")
                     for c, n in zip(cells, sizes.to_pylist())], pa.large_string())


def strings(array: pa.Array) -> list[str]:
    """A text array without nulls as Python strings (much faster than to_pylist)."""
    return array.to_numpy(zero_copy_only=False).tolist()


def one_array(column) -> pa.Array:
    """A chunk's column as one contiguous array."""
    array = column.combine_chunks()
    return array if isinstance(array, pa.Array) else pa.concat_arrays(array.chunks)


def crc_fold(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def labelled_ids(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` ids with their label, by hash order; fold 2 of 4 is held out.

    ``bound`` limits only what a model is fitted on. Labels other than 0 and 1
    and null ids are left out; an id that is labelled twice takes the larger.
    """
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (crc_fold("doc_id", 4) != 2))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, y) of the bounded sample; a repeated id gives one row."""
    picked = F.broadcast(labelled_ids(labels, label, bound))  # <= bound ids
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(picked, "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
