"""Preparation of interaction tables (B1-B6, F1, F2, AG2, AG7, AG8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.operators.indexing import index_ids


def tag_split(df: DataFrame, name: str) -> DataFrame:
    """Tag every row with its split (B1); a literal, folded by the optimizer."""
    return df.withColumn("split", F.lit(name))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of n frames by column name (F1, F2)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def drop_low_counts(df: DataFrame, min_count: float, col: str = "cnt") -> DataFrame:
    """Keep rows with ``cnt >= min_count`` (B2); pushed into the parquet scan."""
    return df.where(F.col(col) >= F.lit(min_count))


def route(df: DataFrame, split: str) -> DataFrame:
    """Rows of one split (B3); with a partitioned table this prunes folders."""
    return df.where(F.col("split") == F.lit(split))


def split_counts(df: DataFrame, by: str = "split") -> DataFrame:
    """Row counts per split (AG7) in one aggregation instead of one job each."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename (B6), e.g. ``{'count': 'cnt', 'track_id': 'item_id'}``."""
    for old, new in mapping.items():
        df = df.withColumnRenamed(old, new)
    return df


def indexed_columns(df: DataFrame, user_out: str = "user_idx", item_out: str = "item_idx") -> DataFrame:
    """Keep what the models need, ids as int."""
    return df.select(F.col(user_out).cast("int"), "cnt", F.col(item_out).cast("int"), *(
        ["split"] if "split" in df.columns else []))


def preprocess(splits: dict[str, DataFrame], min_count: float = 2) -> DataFrame:
    """Tag, union, threshold and jointly index given splits (the N5 job).

    Returns one frame with a ``split`` column; write it with
    ``partitionBy('split')`` instead of one file per split.
    """
    tagged = union_all([tag_split(df.select("user_id", "item_id", "cnt"), name) for name, df in splits.items()])
    kept = drop_low_counts(tagged, min_count)
    return indexed_columns(index_ids(kept))
