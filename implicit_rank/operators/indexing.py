"""Dense ids without a single-task window and without the driver.

``row_number()`` over an un-partitioned window moves every row into one
task, and ``StringIndexer`` collects every label to the driver. Here a
global rank is a range-partitioned sort: each row keeps its partition id and
position, the sorted keys are checkpointed (so a lost executor cannot
re-sample different range bounds), and a table with one row per partition
(size bounded by the partition count) gives the offsets.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from implicit_rank.session import ensure_checkpoint_dir, materialize, publish, published


def global_row_number(df: DataFrame, order_cols: list, out_col: str = "rn",
                      start: int = 1) -> DataFrame:
    """Rows of ``df`` numbered ``start, start+1, ...`` in ``order_cols`` order.

    ``order_cols`` must give a total order (end with a unique key) so that
    the numbering is deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (
        df.orderBy(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (
        ordered.join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, (F.col("_off") + local + F.lit(start)).cast("bigint"))
        .drop("_pid", "_pos", "_off")
    )


def frequency_index(df: DataFrame, id_col: str, out_col: str | None = None) -> DataFrame:
    """``(id, index BIGINT)`` ordered by frequency desc, then id as string asc, from 0.

    Same numbering as ``StringIndexer(stringOrderType='frequencyDesc')``
    (H1b). Counting is a partial aggregation, so a hot id costs one row per
    map task, not one task for all its rows.
    """
    out_col = out_col or f"{id_col}_index"
    counts = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_freq"))
    order: list[Column] = [F.col("_freq").desc(), F.col(id_col).cast("string").asc()]
    # BIGINT: more than 2^31 distinct ids can be indexed; ALS (int ids)
    # checks the range itself
    return global_row_number(counts, order, out_col, start=0).select(id_col, out_col)


HANDLE = ("skip", "error", "keep")


@dataclass
class IdIndex:
    """A fitted id index (H1, H2): ``table`` is ``(id_col, out_col)``, one row per known id.

    The numbers of known ids never change: ``extend`` numbers new ids after the
    last one. With ``reserve`` they start at 1 and 0 is the slot of unseen ids,
    which no extension moves; without it the slot is the number of known ids, as
    ``StringIndexer``'s "keep" has it.
    """

    table: DataFrame
    id_col: str
    out_col: str
    reserve: bool = False

    @classmethod
    def fit(cls, df: DataFrame, id_col: str, out_col: str | None = None, reserve: bool = False) -> "IdIndex":
        out_col = out_col or f"{id_col}_index"
        table = frequency_index(df, id_col, out_col).withColumn(out_col, F.col(out_col) + F.lit(int(reserve)))
        return cls(materialize(table, "id-index"), id_col, out_col, reserve)

    def slot(self) -> Column:
        """The number of unseen and null ids under "keep"."""
        if self.reserve:
            return F.lit(0).cast("bigint")
        return self.table.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()

    def extend(self, df: DataFrame) -> "IdIndex":
        """The index with the ids of ``df`` it lacks, numbered after the last by frequency, then id.

        Ids are counted before the anti-join, so it meets one row per distinct id.
        """
        counts = df.where(F.col(self.id_col).isNotNull()).groupBy(self.id_col).agg(F.count(F.lit(1)).alias("_freq"))
        fresh = counts.join(self.table, self.id_col, "left_anti")
        order = [F.col("_freq").desc(), F.col(self.id_col).cast("string").asc()]
        last = self.table.agg(F.coalesce(F.max(self.out_col), F.lit(int(self.reserve) - 1)).alias("n")).select("n").scalar()
        numbered = global_row_number(fresh, order, self.out_col).withColumn(self.out_col, F.col(self.out_col) + last)
        both = self.table.unionByName(numbered.select(self.id_col, self.out_col))
        return IdIndex(materialize(both, "id-index"), self.id_col, self.out_col, self.reserve)

    def transform(self, df: DataFrame, handle: str = "skip") -> DataFrame:
        """Add ``out_col``. Rows with unseen or null ids are dropped ("skip"), fail the
        job that reads the column ("error"), or get the slot's number ("keep")."""
        if handle not in HANDLE:
            raise ValueError(f"handle must be one of {HANDLE}, not {handle!r}")
        if handle == "skip":
            return df.join(self.table, self.id_col)
        found = df.join(self.table.withColumnRenamed(self.out_col, "_index"), self.id_col, "left")
        if handle == "keep":
            number = F.coalesce("_index", self.slot())
        else:
            told = F.concat(F.lit(f"{self.id_col} is not in the index: "), F.coalesce(F.col(self.id_col).cast("string"), F.lit("null")))
            number = F.when(F.col("_index").isNull(), F.raise_error(told).cast("bigint")).otherwise(F.col("_index"))
        return found.withColumn(self.out_col, number).drop("_index")

    def save(self, path: str, mode: str = "overwrite") -> str:
        """A version under ``path``, published by its last row; an index can be saved onto its own path."""
        path, part = path.rstrip("/"), f"save-{uuid.uuid4().hex[:12]}"
        self.table.write.parquet(f"{path}/{part}")
        publish(self.table.sparkSession, path, json.dumps(
            {"part": part, "id_col": self.id_col, "out_col": self.out_col, "reserve": self.reserve}), mode)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IdIndex":
        meta = published(spark, path.rstrip("/"))
        return cls(spark.read.parquet(f"{path.rstrip('/')}/{meta['part']}"), meta["id_col"], meta["out_col"], meta["reserve"])


def index_ids(df: DataFrame, fitted_on: DataFrame | None = None,
              user_col: str = "user_id", item_col: str = "item_id",
              user_out: str = "user_idx", item_out: str = "item_idx", handle: str = "skip") -> DataFrame:
    """Add int indexes of users and items (H1, H2), fitted jointly on ``fitted_on``.

    Rows with unknown or null ids are treated as ``IdIndex.transform`` does; the
    index tables are joined by key, so the planner broadcasts them only when it
    measures them small.
    """
    base = fitted_on if fitted_on is not None else df
    for id_col, out_col in ((user_col, user_out), (item_col, item_out)):
        df = IdIndex.fit(base, id_col, out_col).transform(df, handle)
    return df
