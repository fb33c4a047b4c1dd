"""Damped popularity (bias) model s(u,i) = mu + b_i + b_u.

    mu  = mean count
    b_i = sum over users of (r - mu)        / (n_i + damping_item)
    b_u = sum over items of (r - mu - b_i)  / (n_u + damping_user)

Damping 0 gives plain means. ``item=False`` makes every b_i zero,
``users=False`` every b_u. The sums are written as ``S - n*mu`` with S the
sum of counts: S is an exact sum (BIGINT, or DECIMAL for other types), so b_i does
not depend on the order of the rows and the item order is reproducible.

mu is a one-row table attached as a scalar subquery: it is never collected
into Python and needs no join. mu and the item sums are written to the shared
folder when the model is fitted, the user offsets when they are first asked for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from implicit_rank.operators.indexing import global_row_number
from implicit_rank.operators.rank import catalogue_topk, top_k_per_user
from implicit_rank.session import large, materialize, publish, published

# Counts of other than integer types are summed as decimals of this scale, so
# that a sum does not depend on the order of its rows.
SUM_TYPE = "decimal(28,12)"


def exact_count(ratings: DataFrame, col: str) -> Column:
    """A count column in a type whose sums do not depend on the order of the rows."""
    whole = dict(ratings.dtypes)[col] in ("tinyint", "smallint", "int", "bigint")
    return F.col(col).cast("bigint" if whole else SUM_TYPE)


@dataclass(frozen=True)
class BiasConfig:
    """``damping`` is a number for both parts or a ``(user, item)`` pair."""

    item: bool = True
    users: bool = True
    damping: float | tuple[float, float] = 0.0

    def __post_init__(self):
        below = [f"{part} {value}" for part, value in (("user", self.user_damping), ("item", self.item_damping))
                 if not value >= 0]
        if below:
            raise ValueError(f"damping below zero: {', '.join(below)}")

    @property
    def user_damping(self) -> float:
        return float(self.damping[0] if isinstance(self.damping, tuple) else self.damping)

    @property
    def item_damping(self) -> float:
        return float(self.damping[1] if isinstance(self.damping, tuple) else self.damping)


@dataclass
class BiasModel:
    config: BiasConfig
    stats: DataFrame  # one row: mu DOUBLE, n BIGINT
    catalogue: DataFrame  # item_id, b_i (0 without an item part), n_i
    users: DataFrame | Callable[[], DataFrame] | None  # user_id, b_u, n_u, or how to fit them

    @property
    def user_offsets(self) -> DataFrame | None:
        """(user_id, b_u, n_u), fitted when first asked for: the item order does not need them."""
        if callable(self.users):
            self.users = self.users()
        return self.users

    @property
    def item_offsets(self) -> DataFrame | None:
        return self.catalogue if self.config.item else None

    # -- scalars -------------------------------------------------------
    def mu(self) -> Column:
        return self.stats.select("mu").scalar()

    # -- scoring -------------------------------------------------------
    def _attach(self, pairs: DataFrame) -> DataFrame:
        out = pairs
        if self.item_offsets is not None:
            out = out.join(large(self.item_offsets.select("item_id", "b_i")), "item_id", "left")
        else:
            out = out.withColumn("b_i", F.lit(0.0))
        if self.user_offsets is not None:
            out = out.join(large(self.user_offsets.select("user_id", "b_u")), "user_id", "left")
        else:
            out = out.withColumn("b_u", F.lit(0.0))
        return out.withColumn("b_i", F.coalesce("b_i", F.lit(0.0))).withColumn(
            "b_u", F.coalesce("b_u", F.lit(0.0)))

    def predict(self, pairs: DataFrame) -> DataFrame:
        """``prediction = mu + b_i + b_u`` for every given pair.

        The pairs are on the left of both joins, so unseen users and items
        keep their rows with offset 0.
        """
        scored = self._attach(pairs)
        return scored.withColumn("prediction", self.mu() + F.col("b_i") + F.col("b_u")).drop("b_i", "b_u")

    def rank_observed(self, pairs: DataFrame, k: int, by=()) -> DataFrame:
        """Rank each user's given pairs by predicted score, keep k.

        The coded behaviour: only the pairs passed in are ranked. Order is
        score desc, then item desc; within a user the score order is the
        b_i order, which is what is sorted on.
        """
        scored = self._attach(pairs.select(*by, "user_id", "item_id"))
        ranked = top_k_per_user(
            scored, k, [F.col("b_i").desc(), F.col("item_id").desc()], by=by)
        return ranked.select(*by, "user_id", "item_id", "rnk",
                             (self.mu() + F.col("b_i") + F.col("b_u")).alias("score"))

    def item_order(self) -> DataFrame:
        """``(item_id, r, b_i)``: the catalogue in model order, r from 1.

        The catalogue is the set of items seen in fitting; without item
        offsets all of them tie and the id decides. Numbered by a
        range-partitioned sort, not a one-task window.
        """
        order = [F.col("b_i").desc(), F.col("item_id").asc()]
        return global_row_number(self.catalogue.select("item_id", "b_i"), order, "r")

    def recommend(self, users: DataFrame, seen: DataFrame, k: int, scores: bool = True) -> DataFrame:
        """Top-k unseen catalogue items per user (J9): ``(user_id, item_id, rnk, score)``.

        All users share the b_i order (b_u only shifts a user's scores), so
        the catalogue is ranked once and each user takes the first k items
        of it that they have not seen. Without ``scores`` (as metrics need it)
        the user part is neither fitted nor joined.
        """
        if not scores:
            return catalogue_topk(self.item_order(), seen, users, k)
        return self.with_scores(catalogue_topk(self.item_order(), seen, users, k, carry=("b_i",)))

    def with_scores(self, recs: DataFrame) -> DataFrame:
        """Scores of ``(user_id, item_id, rnk, b_i)`` rows: b_i comes with the item order,
        so only b_u is joined."""
        if self.user_offsets is not None:
            recs = recs.join(large(self.user_offsets.select("user_id", "b_u")), "user_id", "left")
        else:
            recs = recs.withColumn("b_u", F.lit(0.0))
        return recs.select("user_id", "item_id", "rnk",
                           (self.mu() + F.col("b_i") + F.coalesce(F.col("b_u"), F.lit(0.0))).alias("score"))

    # -- persistence (A10, A11) -----------------------------------------
    def save(self, path: str, mode: str = "overwrite") -> str:
        """A version of the model under ``path``; replaces a saved model unless told otherwise.

        The parts go to a folder of their own; then one row, written last, points
        to it. So a loaded model can be saved onto its own path, and a save that
        fails leaves the last one as it was. ``remove_old`` clears what no row
        points to.
        """
        path, part = path.rstrip("/"), f"save-{uuid.uuid4().hex[:12]}"
        meta = json.dumps({"item": self.config.item, "users": self.config.users, "part": part,
                           "damping": [self.config.user_damping, self.config.item_damping]})
        self.catalogue.write.parquet(f"{path}/{part}/item_offsets")
        if self.user_offsets is not None:
            self.user_offsets.write.parquet(f"{path}/{part}/user_offsets")
        self.stats.select("mu", "n").write.parquet(f"{path}/{part}/stats")
        publish(self.stats.sparkSession, path, meta, mode)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BiasModel":
        path = path.rstrip("/")
        meta = published(spark, path)
        base = f"{path}/{meta['part']}"
        config = BiasConfig(meta["item"], meta["users"], tuple(meta["damping"]))
        users = spark.read.parquet(f"{base}/user_offsets") if config.users else None
        return cls(config, spark.read.parquet(f"{base}/stats"), spark.read.parquet(f"{base}/item_offsets"), users)


def fit_bias(ratings: DataFrame, config: BiasConfig | None = None, col: str = "cnt") -> BiasModel:
    """Fit mu, b_i, b_u (J2, J3) on ``(user_id, item_id, <col>)``.

    Plan: one groupBy on item (partial aggregation first, so a popular item is
    not one task) gives exact sums, written to the shared folder; mu is their
    total. b_u joins the offsets on item and groups by user, when it is first
    asked for. Both sides of the join, and later of ``predict``, are then plain
    shuffles that AQE can split where a key is hot.

    A null count has no residual; it still counts as a row of its item and
    user in the damped denominators (n_i, n_u).
    """
    config = config or BiasConfig()
    r = ratings.select("user_id", "item_id", exact_count(ratings, col).alias("_r"))
    total, known, n = F.sum("_r"), F.count("_r"), F.count(F.lit(1))
    sums = materialize(r.groupBy("item_id").agg(total.alias("_s"), known.alias("_known"), n.alias("n_i")), "bias-sums")
    stats = materialize(sums.agg((F.sum("_s").cast("double") / F.sum("_known")).alias("mu"),
                                 F.coalesce(F.sum("n_i"), F.lit(0)).alias("n")), "bias-stats")
    mu = stats.select("mu").scalar()

    residual = F.coalesce((F.col("_s").cast("double") - F.col("_known") * mu) / (F.col("n_i") + F.lit(config.item_damping)),
                          F.lit(0.0))
    items = sums.select("item_id", (residual if config.item else F.lit(0.0)).alias("b_i"), "n_i")

    def fit_users() -> DataFrame:
        with_bi = r.join(large(items.select("item_id", "b_i")), "item_id", "left") if config.item else r.withColumn("b_i", F.lit(0.0))
        taken = F.sum(F.when(F.col("_r").isNotNull(), F.col("b_i")))
        users = (
            with_bi.groupBy("user_id")
            .agg(total.cast("double").alias("_s"), known.alias("_known"), n.alias("n_u"), taken.alias("_sb"))
            .select("user_id",
                    F.coalesce((F.col("_s") - F.col("_known") * mu - F.col("_sb"))
                               / (F.col("n_u") + F.lit(config.user_damping)), F.lit(0.0)).alias("b_u"),
                    "n_u")
        )
        return materialize(users, "bias-users")

    return BiasModel(config, stats, items, fit_users if config.users else None)
