"""Count-to-rating transform (G1) and the column summary behind it (AG6).

rating = 5 * (clamp(c, m - 2s, m + 2s) - (m - 2s)) / 4s with m the mean and s
the sample standard deviation of the counts; a result <= 0 becomes 0.05.
When s is 0 or undefined (one row) every rating is 2.5 (the midpoint).
The statistics come from the frame the model is fitted on and are applied
unchanged to validation and test rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from implicit_rank.session import materialize

# Fixed values of the transform.
RATING_SCALE = 5.0
RATING_FLOOR = 0.05
RATING_IF_CONSTANT = 2.5
CLAMP_SIGMAS = 2.0

# Counts as exact decimals (below 1e13), and their sums (below 1e26), with 12 places.
MOMENT_TYPE = "decimal(25,12)"
SUM_TYPE = "decimal(38,12)"
# Sums of squares up to here lose less in double than in products of decimals (6 places).
SMALL_SQUARES = 1_000_000_000


def moments(df: DataFrame, col: str = "cnt", by=()) -> DataFrame:
    """``(by..., n, sx, sxx, lo, hi)``: rows, sum, sum of squares, least and largest value.

    The sums are decimals of rows rounded one by one, so they do not depend on
    the order or the layout of the rows, and those of parts add up exactly
    (``merge_moments``). Values that the decimals cannot hold (NaN, infinite, 1e13 or more) count as null.
    """
    x = F.col(col).try_cast(MOMENT_TYPE)
    whole = F.floor(x).cast("decimal(13,0)")
    part = (x - whole).cast("double")  # the whole part is squared exactly, so that large values lose nothing
    square = (whole * whole).cast(SUM_TYPE) + (part * (2 * whole.cast("double") + part)).cast(SUM_TYPE)
    return df.groupBy(*by).agg(F.count(x).alias("n"), F.sum(x.cast(SUM_TYPE)).cast(SUM_TYPE).alias("sx"),
                               F.sum(square).cast(SUM_TYPE).alias("sxx"), F.min(x).alias("lo"), F.max(x).alias("hi"))


def merge_moments(parts: DataFrame, by=()) -> DataFrame:
    """The moments of tables put together, from the moments of each."""
    return parts.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("sx").cast(SUM_TYPE).alias("sx"),
                                  F.sum("sxx").cast(SUM_TYPE).alias("sxx"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def mean_and_deviation(table: DataFrame, by=()) -> DataFrame:
    """``(by..., n, m, s)``: mean and sample standard deviation of moments.

    Small sums are combined in double, exactly so for whole numbers; beyond
    that squares are taken about the mean rounded to 6 places, in decimals, where
    nothing cancels. Which of the two depends on the values alone. Equal values
    deviate by exactly 0.
    """
    n, sx, sxx = F.col("n"), F.col("sx"), F.col("sxx")
    plain = (n * sxx.cast("double") - sx.cast("double") * sx.cast("double")) / n
    q, count = (sx / n).cast("decimal(19,6)"), n.cast("decimal(20,0)")
    rest = (sx - count * q).cast("double")
    about = (sxx - 2 * (q * sx) + count * (q * q).cast(SUM_TYPE)).cast("double") - rest * rest / n
    squares = F.greatest(F.when(sxx < SMALL_SQUARES, plain).otherwise(about), F.lit(0.0))
    return table.select(
        *by, "n", F.when(F.col("n") > 0, F.col("sx").cast("double") / F.col("n")).alias("m"),
        F.when(F.col("n") > 1, F.when(F.col("lo") == F.col("hi"), F.lit(0.0)).otherwise(
            F.sqrt(squares / (F.col("n") - 1)))).alias("s"))


def rating_stats(df: DataFrame, col: str = "cnt", by: str | None = None) -> DataFrame:
    """Mean and sample stddev of a column (AG6), globally or per ``by`` key."""
    keys = [by] if by else []
    return mean_and_deviation(moments(df, col, keys), keys).drop("n")


def rating_expr(c: Column, m: Column, s: Column) -> Column:
    lo = m - F.lit(CLAMP_SIGMAS) * s
    hi = m + F.lit(CLAMP_SIGMAS) * s
    clamped = F.least(F.greatest(c.cast("double"), lo), hi)
    scaled = F.lit(RATING_SCALE) * (clamped - lo) / (hi - lo)
    return (
        F.when(s.isNull() | (s == 0), F.lit(RATING_IF_CONSTANT))
        .when(scaled <= 0, F.lit(RATING_FLOOR))
        .otherwise(scaled)
    )


def to_rating(
    df: DataFrame,
    fitted_on: DataFrame | None = None,
    col: str = "cnt",
    per_item: bool = False,
    item_col: str = "item_id",
) -> DataFrame:
    """Replace ``col`` by its rating; statistics from ``fitted_on`` (default ``df``).

    Global statistics are one row, attached as a scalar subquery (computed
    once, no join). Per-item statistics are an aggregate keyed by item, written
    out and joined back (so a hot item's rows can be split over tasks); an item
    unknown to ``fitted_on`` gets the constant rating.
    """
    base = fitted_on if fitted_on is not None else df
    if per_item:
        stats = materialize(rating_stats(base, col, by=item_col), "rating-stats")
        joined = df.join(stats, item_col, "left")
        return joined.withColumn(col, rating_expr(F.col(col), F.col("m"), F.col("s"))).drop("m", "s")
    packed = rating_stats(base, col).select(F.struct("m", "s").alias("st")).scalar()
    return df.withColumn(col, rating_expr(F.col(col), packed.getField("m"), packed.getField("s")))
