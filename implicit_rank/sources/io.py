"""Sources and sinks: parquet, CSV with a DDL schema, JSON, temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INTERACTION_COLUMNS = ("user_id", "item_id", "cnt")


class SchemaError(ValueError):
    """A table lacks a column the operator needs."""


def require_columns(df: DataFrame, columns, what: str = "table") -> DataFrame:
    """Validate on read: fail early, with the missing names, not deep in a plan."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"{what} lacks column(s) {missing}; has {df.columns}")
    return df


def read_interactions(
    spark: SparkSession,
    path: str,
    user_col: str = "user_id",
    item_col: str = "item_id",
    count_col: str = "cnt",
) -> DataFrame:
    """Interaction fact table (A1) under canonical names; null ids are skipped.

    Only the three columns are selected, so the scan prunes every other
    column and later filters on ids or counts are pushed into it.
    """
    df = require_columns(spark.read.parquet(path), [user_col, item_col, count_col], path)
    return df.select(
        F.col(user_col).alias("user_id"),
        F.col(item_col).alias("item_id"),
        F.col(count_col).alias("cnt"),
    ).where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())


def read_csv(spark: SparkSession, path: str, ddl: str, header: bool = False) -> DataFrame:
    """CSV with an explicit DDL schema (A2), e.g. ``'bid INT, bname STRING'``."""
    return spark.read.csv(path, schema=ddl, header=header)


def read_json(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """JSON lines (A3); the schema is inferred unless a DDL string is given."""
    reader = spark.read
    if ddl:
        reader = reader.schema(ddl)
    return reader.json(path)


def register_views(spark: SparkSession, **frames: DataFrame) -> list[str]:
    """Temp views (A4) so that SQL text (A5) can be run with ``spark.sql``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Row preview (A6) as a bounded frame; ``df.schema.simpleString()`` for the schema."""
    return df.limit(n)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | tuple[str, ...] | None = None,
) -> str:
    """Parquet sink: ``overwrite`` (A7) or ``errorifexists``.

    ``partition_by`` (e.g. ``split`` or ``run_id``) lets later reads prune
    whole folders instead of filtering rows.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def output_name(prefix: str, k: int, seed: int | None) -> str:
    """Output naming by k and seed (A9): ``<prefix>_top<k>_<seed|unseeded>``."""
    return f"{prefix}_top{k}_{seed if seed is not None else 'unseeded'}"
