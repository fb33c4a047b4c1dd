"""Bias model at every count threshold in one pass.

Dropping counts below N, for each N of an ascending list, gives nested tables:
a pair belongs to the first ``level`` of them, where level is the number of
thresholds its count reaches. So the pairs are aggregated once, by (item,
level); suffix sums over the levels are the item sums at every threshold, and
the same rows summed over the items give every mean. The threshold is then a key
of the item order, of the top-k lists and of the metrics.

An item's statistics change only at levels at which it has rows, so a suffix sum
is kept once per such level and spread over the thresholds down to the next
lower one. Null counts reach no threshold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.operators.bias import BiasConfig, exact_count
from implicit_rank.operators.indexing import global_row_number
from implicit_rank.operators.metrics import METRIC_COLUMNS, ranking_metrics
from implicit_rank.operators.rank import HEAD_ROWS, resolve_unseen
from implicit_rank.session import materialize


def level_of(col: Column, thresholds: list[float]) -> Column:
    """Number of thresholds that a count reaches; 0 for null."""
    return reduce(add, [F.when(F.lit(t) <= col, F.lit(1)).otherwise(F.lit(0)) for t in thresholds], F.lit(0)).cast("bigint")


def up_to(level: Column) -> Column:
    """One row per threshold number 1..level, none for level 0."""
    return F.explode(F.when(level > 0, F.sequence(F.lit(1).cast("bigint"), level)))


def suffix_sums(cells: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """``(keys..., level, sums...)`` at every level 1..highest from sums of single levels.

    A window group has one row per level at which the key occurs.
    """
    down = Window.partitionBy(*keys).orderBy(F.desc("level"))
    whole = down.rowsBetween(Window.unboundedPreceding, 0)
    lower = F.lead("level", 1, 0).over(down)
    spans = cells.select(*keys, "level", lower.alias("_lower"), *[F.sum(c).over(whole).alias(c) for c in sums])
    return spans.select(*keys, *sums, F.explode(F.sequence(F.col("_lower") + 1, F.col("level"))).alias("level"))


@dataclass
class ThresholdBias:
    """Bias models of nested tables: column ``level`` counts the thresholds from 1."""

    thresholds: list[float]  # ascending
    config: BiasConfig
    pairs: DataFrame   # user_id, item_id, _r, level (> 0)
    stats: DataFrame   # level, mu, n: one row per threshold that any pair reaches
    items: DataFrame   # level, item_id, b_i, n_i

    def item_order(self) -> DataFrame:
        """``(level, item_id, _r)``: every threshold's catalogue in its model's order, r from 1."""
        order = [F.asc("level"), F.desc("b_i"), F.asc("item_id")]
        numbered = global_row_number(self.items.select("level", "item_id", "b_i"), order, "_at")
        numbered = materialize(numbered, "threshold-order")
        first = numbered.groupBy("level").agg(F.min("_at").alias("_first"))  # one row per threshold
        return numbered.join(F.broadcast(first), "level").select(
            "level", "item_id", (F.col("_at") - F.col("_first") + 1).alias("_r"))

    def user_offsets(self) -> DataFrame:
        """``(level, user_id, b_u, n_u)``: the pairs meet each item's offsets once, as a map by level."""
        by_level = self.items.groupBy("item_id").agg(
            F.map_from_entries(F.collect_list(F.struct("level", "b_i"))).alias("_b"))  # one entry per threshold
        mus = self.stats.agg(F.map_from_entries(F.collect_list(F.struct("level", "mu"))).alias("mu")).scalar()
        met = self.pairs.join(by_level, "item_id")
        parts = []
        for j in range(1, len(self.thresholds) + 1):
            within, level = F.col("level") >= j, F.lit(j).cast("bigint")
            parts += [F.sum(F.when(within, F.col("_r"))).cast("double").alias(f"s{j}"),
                      F.count(F.when(within, F.lit(1))).alias(f"n{j}"),
                      F.sum(F.when(within, F.col("_b")[level] if self.config.item else F.lit(0.0))).alias(f"b{j}")]
        rows = F.explode(F.array(*[F.struct(
            F.lit(j).cast("bigint").alias("level"), F.col(f"s{j}").alias("s"), F.col(f"n{j}").alias("n_u"),
            F.col(f"b{j}").alias("b")) for j in range(1, len(self.thresholds) + 1)]))
        sums = met.groupBy("user_id").agg(*parts).select("user_id", rows.alias("x")).select("user_id", "x.*").where("n_u > 0")
        return sums.select("level", "user_id", (
            (F.col("s") - F.col("n_u") * mus[F.col("level")] - F.col("b"))
            / (F.col("n_u") + F.lit(self.config.user_damping))).alias("b_u"), "n_u")

    def recommend(self, users: DataFrame, k: int) -> DataFrame:
        """Top-k unseen items ``(level, user_id, item_id, rnk)`` of ``(user_id, level)`` targets.

        A target stands for its thresholds 1..level. The pairs are spread over
        their thresholds where they are read; they meet the head of each order
        there, before any of them is shuffled.
        """
        most = users.groupBy("user_id").agg(F.max("level").alias("_most"))
        targets = most.select("user_id", up_to(F.col("_most")).alias("level"))
        seen = self.pairs.select("user_id", "item_id", up_to(F.col("level")).alias("level"))
        return resolve_unseen(self.item_order(), seen, targets, k, ["level"],
                              head_rows=max(k, HEAD_ROWS // len(self.thresholds)))


def fit_by_threshold(ratings: DataFrame, thresholds, config: BiasConfig | None = None, col: str = "cnt") -> ThresholdBias:
    """The bias models of ``ratings`` with counts below each threshold dropped, from one aggregation by (item, level)."""
    config, steps = config or BiasConfig(), sorted({float(t) for t in thresholds})
    pairs = ratings.select("user_id", "item_id", exact_count(ratings, col).alias("_r"),
                           level_of(F.col(col), steps).alias("level")).where("level > 0")
    cells = materialize(pairs.groupBy("item_id", "level").agg(F.sum("_r").alias("s"), F.count(F.lit(1)).alias("n")),
                        "threshold-cells")
    overall = cells.groupBy("level").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))  # one row per threshold
    stats = materialize(suffix_sums(overall, [], ["s", "n"]).select(
        "level", (F.col("s").cast("double") / F.col("n")).alias("mu"), "n"), "threshold-stats")
    residual = (F.col("s").cast("double") - F.col("n_i") * F.col("mu")) / (F.col("n_i") + F.lit(config.item_damping))
    items = (suffix_sums(cells.withColumnRenamed("n", "n_i"), ["item_id"], ["s", "n_i"])
             .join(F.broadcast(stats.select("level", "mu")), "level")
             .select("level", "item_id", (residual if config.item else F.lit(0.0)).alias("b_i"), "n_i"))
    return ThresholdBias(steps, config, pairs, stats, materialize(items, "threshold-items"))


def metrics_by_threshold(train: DataFrame, test: DataFrame, thresholds, k: int, config: BiasConfig | None = None) -> DataFrame:
    """Ranking metrics of the models fitted and tested on the counts that reach each threshold.

    One row per threshold; one that no test pair reaches has no users and null metrics.
    """
    model = fit_by_threshold(train, thresholds, config)
    held = test.select("user_id", "item_id", level_of(F.col("cnt"), model.thresholds).alias("level")).where("level > 0")
    truth = held.select("user_id", "item_id", up_to(F.col("level")).alias("level"))
    found = ranking_metrics(model.recommend(held, k), truth, k, by=["level"])
    spark = train.sparkSession
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(model.thresholds)], "level bigint, threshold double")
    return grid.join(found, "level", "left").select(
        "threshold", F.coalesce("n_users", F.lit(0)).alias("n_users"), *METRIC_COLUMNS)
