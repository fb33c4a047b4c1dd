"""Ranking metrics as aggregations over recs joined to truth.

``recs`` is long form ``(by..., user_id, item_id, rnk)``, ``truth`` is
``(by..., user_id, item_id[, gain])``. ``by`` names extra keys (split, run,
fold, k) so that any number of evaluations run as one aggregation.

Definitions (Spark's ranking metrics, binary relevance; users are those
with truth):

* precision@k = hits in the first k / k
* recall@k    = hits in the first k / |truth|
* AP          = sum over hits of (hits so far / rank) / |truth|, over the
                list as produced (cut at k);   MAP = mean
* AP@k        = the same over the first k / min(|truth|, k)
* NDCG@k      = sum over hits of 1/log2(rank+1) / sum_{i<=min(|truth|,k)} 1/log2(i+1)

Lenient variants (per-list conventions of common single-machine toolkits):

* precision   = hits / min(list length, k)
* recall      = hits / min(|truth|, k)
* NDCG        = sum over hits of gain / max(log2(rank), 1), over the same for
  the truth sorted by gain (top k)
* "manual MAP" = mean over t=1..k of mean precision@t, in one pass: a hit at
  rank j of a list of length n <= k adds H(n) - H(j-1) + (k - n)/n, with H
  the harmonic numbers, and the sum is divided by k.

Every per-user window holds at most k rows; lookup tables (ideal DCG,
harmonic numbers) have k+1 rows and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from implicit_rank.session import materialize

METRIC_COLUMNS = ("precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k")
LENIENT_COLUMNS = ("precision_lk", "recall_lk", "ndcg_lk", "map_manual")


def _k_col(k) -> Column:
    return F.lit(k).cast("bigint") if isinstance(k, int) else F.col(k).cast("bigint")


def _prefix_table(spark: SparkSession, max_k: int, term: Column, name: str) -> DataFrame:
    """``(m, <name>)`` for m = 0..max_k with <name>(m) = sum_{i=1..m} term(i).

    max_k + 1 rows: built in one small task and broadcast."""
    upto = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    rows = spark.range(0, max_k + 1).select(F.col("id").alias("m"))
    return rows.select(
        "m", F.sum(F.when(F.col("m") > 0, term).otherwise(F.lit(0.0))).over(upto).alias(name))


def ideal_dcg_table(spark: SparkSession, max_k: int) -> DataFrame:
    return _prefix_table(spark, max_k, F.lit(1.0) / F.log2(F.col("m") + 1), "idcg")


def harmonic_table(spark: SparkSession, max_k: int) -> DataFrame:
    return _prefix_table(spark, max_k, F.lit(1.0) / F.col("m"), "harm")


def per_user_metrics(recs: DataFrame, truth: DataFrame, k, by=(), include_missing: bool = True,
                     max_k: int | None = None) -> DataFrame:
    """One row per (by..., user) with truth (K9): hit counts and the metrics.

    ``k`` is an int, or the name of a ``by`` column holding each row's k
    (then ``max_k`` bounds it). Users with truth and no recommendations
    count as 0 when ``include_missing`` (K10), else they are dropped.
    """
    return _per_user(recs, truth, k, by, include_missing, max_k)


def _per_user(recs: DataFrame, truth: DataFrame, k, by, include_missing: bool, max_k: int | None, sizes: bool = True) -> DataFrame:
    """``per_user_metrics``; without ``sizes`` the lists are not counted where nothing asks for it, so that they are
    produced once."""
    by = list(by)
    keys = by + ["user_id"]
    kc = _k_col(k)
    max_k = max_k if max_k is not None else int(k)
    spark = recs.sparkSession
    r = recs.select(*keys, "item_id", "rnk").where(F.col("rnk") <= kc)
    t = truth.select(*keys, "item_id").distinct()  # relevance is a set
    users = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_truth"))
    if sizes or not include_missing:
        n_recs = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_recs"))
        users = users.join(n_recs, keys, "left" if include_missing else "inner")
    else:
        users = users.withColumn("n_recs", F.lit(None).cast("bigint"))
    hits = r.join(t, keys + ["item_id"], "left_semi")
    so_far = Window.partitionBy(*keys).orderBy("rnk")
    hit_agg = (
        hits.withColumn("_h", F.row_number().over(so_far))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_hits"),
             F.sum(F.col("_h") / F.col("rnk")).alias("_prec_sum"),
             F.sum(F.lit(1.0) / F.log2(F.col("rnk") + 1)).alias("_dcg"))
    )
    users = users.join(hit_agg, keys, "left").fillna(0, subset=["n_recs", "n_hits", "_prec_sum", "_dcg"])
    if "k" not in users.columns:
        users = users.withColumn("k", kc)
    users = users.withColumn("m", F.least(F.col("n_truth"), F.col("k")))
    users = users.join(F.broadcast(ideal_dcg_table(spark, max_k)), "m", "left")
    return users.select(
        *keys, "n_truth", "n_recs", "n_hits",
        (F.col("n_hits") / F.col("k")).alias("precision_at_k"),
        (F.col("n_hits") / F.col("n_truth")).alias("recall_at_k"),
        (F.col("_prec_sum") / F.col("n_truth")).alias("map"),
        (F.col("_prec_sum") / F.col("m")).alias("map_at_k"),
        F.when(F.col("idcg") > 0, F.col("_dcg") / F.col("idcg")).otherwise(F.lit(0.0)).alias("ndcg_at_k"),
    )


def ranking_metrics(recs: DataFrame, truth: DataFrame, k, by=(), include_missing: bool = True,
                    max_k: int | None = None) -> DataFrame:
    """Mean metrics per ``by`` group (K1-K4, K13): one aggregation for all."""
    per_user = _per_user(recs, truth, k, by, include_missing, max_k, sizes=False)
    return per_user.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(c) for c in METRIC_COLUMNS])


def lenient_per_user(recs: DataFrame, truth: DataFrame, k: int, by=(), gain_col: str = "cnt") -> DataFrame:
    """Per-user lenient metrics (K5-K8) for users with truth and a list."""
    by = list(by)
    keys = by + ["user_id"]
    spark = recs.sparkSession
    r = recs.select(*keys, "item_id", "rnk").where(F.col("rnk") <= k)
    # a repeated truth row adds its gain to the item's, once
    t = truth.groupBy(*keys, "item_id").agg(F.coalesce(F.sum(F.col(gain_col).cast("double")), F.lit(0.0)).alias("_gain"))
    n_truth = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_truth"))
    n_recs = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_recs"))
    harm = harmonic_table(spark, k)
    hits = (
        r.join(t, keys + ["item_id"])
        .join(n_recs, keys)
        .join(F.broadcast(harm.select(F.col("m").alias("n_recs"), F.col("harm").alias("_hn"))), "n_recs")
        .join(F.broadcast(harm.select((F.col("m") + 1).alias("rnk"), F.col("harm").alias("_hj"))), "rnk")
    )
    discount = F.greatest(F.log2(F.col("rnk").cast("double")), F.lit(1.0))
    hit_agg = hits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.sum(F.col("_gain") / discount).alias("_dcg"),
        F.sum(F.col("_hn") - F.col("_hj") + (F.lit(k) - F.col("n_recs")) / F.col("n_recs")).alias("_ap_sum"),
    )
    by_gain = Window.partitionBy(*keys).orderBy(F.col("_gain").desc(), F.col("item_id"))
    ideal = (
        t.withColumn("_pos", F.row_number().over(by_gain))
        .where(F.col("_pos") <= k)
        .groupBy(*keys)
        .agg(F.sum(F.col("_gain") / F.greatest(F.log2(F.col("_pos").cast("double")), F.lit(1.0))).alias("_idcg"))
    )
    users = (
        n_recs.join(n_truth, keys).join(hit_agg, keys, "left").join(ideal, keys, "left")
        .fillna(0, subset=["n_hits", "_dcg", "_ap_sum"])
    )
    return users.select(
        *keys, "n_truth", "n_recs", "n_hits",
        (F.col("n_hits") / F.least(F.col("n_recs"), F.lit(k))).alias("precision_lk"),
        (F.col("n_hits") / F.least(F.col("n_truth"), F.lit(k))).alias("recall_lk"),
        F.when(F.col("_idcg") > 0, F.col("_dcg") / F.col("_idcg")).otherwise(F.lit(0.0)).alias("ndcg_lk"),
        (F.col("_ap_sum") / F.lit(k)).alias("map_manual"),
    )


def lenient_metrics(recs: DataFrame, truth: DataFrame, k: int, by=(), gain_col: str = "cnt") -> DataFrame:
    per_user = lenient_per_user(recs, truth, k, by, gain_col)
    return per_user.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(c) for c in LENIENT_COLUMNS])


def metrics_long(wide: DataFrame, by=(), columns=METRIC_COLUMNS) -> DataFrame:
    """``(by..., metric, value)`` from the wide table (K13's report layout)."""
    return wide.unpivot(list(by), list(columns), "metric", "value")


def metrics_by_k(recs: DataFrame, truth: DataFrame, max_k: int, by=()) -> DataFrame:
    """Mean metrics at every k = 1..max_k from lists of length max_k, in one pass.

    Hits are numbered once. A user's metrics at k depend on its hits of rank
    <= k and on m = min(|truth|, max_k), so the hits are summed by (rank, m):
    at most max_k^2 rows per ``by`` group, whatever the number of users, and
    prefix sums over the ranks give every k. Neither lists nor truth are
    repeated per k.
    """
    by = list(by)
    keys = by + ["user_id"]
    spark = recs.sparkSession
    t = truth.select(*keys, "item_id").distinct()
    sizes = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_truth")).withColumn("m", F.least("n_truth", F.lit(max_k)))
    r = recs.select(*keys, "item_id", "rnk").where(F.col("rnk") <= max_k)
    so_far = Window.partitionBy(*keys).orderBy("rnk")  # at most max_k rows
    hits = r.join(t, keys + ["item_id"], "left_semi").withColumn("_h", F.row_number().over(so_far)).join(sizes, keys)
    prec = F.col("_h") / F.col("rnk")
    by_rank = hits.groupBy(*by, "m", F.col("rnk").cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("_hits"), F.sum(F.lit(1.0) / F.col("n_truth")).alias("_rec"),
        F.sum(prec / F.col("n_truth")).alias("_ap"), F.sum(prec).alias("_prec"),
        F.sum(F.lit(1.0) / F.log2(F.col("rnk") + 1)).alias("_dcg"))
    users = sizes.groupBy(*by, "m").agg(F.count(F.lit(1)).alias("_users"))
    every_k = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(max_k).cast("bigint")))
    cells = users.withColumn("k", every_k).join(by_rank, [*by, "m", "k"], "left")  # <= max_k^2 rows a group
    upto = Window.partitionBy(*by, "m").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    sums = ["_hits", "_rec", "_ap", "_prec", "_dcg"]
    cells = cells.select(*by, "m", "k", "_users", *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto).alias(c) for c in sums])
    cells = (cells.withColumn("_ideal", F.least("m", "k"))
             .join(F.broadcast(ideal_dcg_table(spark, max_k).withColumnRenamed("m", "_ideal")), "_ideal"))
    n = F.sum("_users")
    return cells.groupBy(*by, "k").agg(
        n.alias("n_users"), (F.sum(F.col("_hits") / F.col("k")) / n).alias("precision_at_k"),
        (F.sum("_rec") / n).alias("recall_at_k"), (F.sum("_ap") / n).alias("map"),
        (F.sum(F.col("_prec") / F.col("_ideal")) / n).alias("map_at_k"),
        (F.sum(F.col("_dcg") / F.col("idcg")) / n).alias("ndcg_at_k"))


def lenient_by_k(recs: DataFrame, truth: DataFrame, max_k: int, by=(), gain_col: str = "cnt") -> DataFrame:
    """Mean lenient metrics (K5-K8) at every k = 1..max_k from lists of length max_k, in one pass.

    Precision and recall at k need the hits of rank <= k by list length and by
    truth size: hits are summed by (rank, size) and prefix sums over the ranks
    give every k. The manual MAP at k is the running mean of the precision
    curve. NDCG is a ratio per user that changes only where the user has a hit or
    one more truth item in gain order: its steps there, summed by k over all
    users, are a difference array whose prefix sum is the curve. So rows follow
    the hits and the truth, and neither is repeated per k. The lists, the sizes and
    the hits, which several branches read, are written once.
    """
    by = list(by)
    keys = by + ["user_id"]
    r = materialize(recs.select(*keys, "item_id", "rnk").where(F.col("rnk") <= max_k), "curve-lists")
    t = truth.groupBy(*keys, "item_id").agg(F.coalesce(F.sum(F.col(gain_col).cast("double")), F.lit(0.0)).alias("_gain"))
    sizes = (r.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .join(t.groupBy(*keys).agg(F.least(F.count(F.lit(1)), F.lit(max_k)).alias("_m")), keys))
    sizes = materialize(sizes, "curve-sizes")
    hits = materialize(r.join(t, keys + ["item_id"]).join(sizes, keys).select(
        *keys, "_n", "_m", "_gain", F.col("rnk").cast("bigint").alias("k")), "curve-hits")
    every_k = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(max_k).cast("bigint"))).alias("k")

    def curve(size: str, name: str) -> DataFrame:
        """Sum over users of hits up to k / min(size, k)."""
        counts = hits.groupBy(*by, size, "k").agg(F.count(F.lit(1)).alias("_hits"))
        classes = sizes.select(*by, size).distinct().select("*", every_k)  # <= max_k^2 rows a group
        upto = Window.partitionBy(*by, size).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        cells = classes.join(counts, [*by, size, "k"], "left").withColumn("_hits", F.sum(F.coalesce("_hits", F.lit(0))).over(upto))
        return cells.groupBy(*by, "k").agg(F.sum(F.col("_hits") / F.least(size, "k")).alias(name))

    by_gain = Window.partitionBy(*keys).orderBy(F.col("_gain").desc(), F.col("item_id"))
    ideal = (t.withColumn("k", F.row_number().over(by_gain)).where(F.col("k") <= max_k)
             .join(sizes, keys, "left_semi").select(*keys, F.col("k").cast("bigint").alias("k"), "_gain"))
    discount = F.greatest(F.log2(F.col("k").cast("double")), F.lit(1.0))
    events = (hits.select(*keys, "k", (F.col("_gain") / discount).alias("_dcg"), F.lit(0.0).alias("_idcg"))
              .unionByName(ideal.select(*keys, "k", F.lit(0.0).alias("_dcg"), (F.col("_gain") / discount).alias("_idcg")))
              .groupBy(*keys, "k").agg(F.sum("_dcg").alias("_dcg"), F.sum("_idcg").alias("_idcg")))
    of_user = Window.partitionBy(*keys).orderBy("k")  # at most 2 max_k rows
    so_far = of_user.rowsBetween(Window.unboundedPreceding, 0)
    ratio = events.select(*keys, "k", F.sum("_dcg").over(so_far).alias("_dcg"), F.sum("_idcg").over(so_far).alias("_idcg")).withColumn(
        "_ratio", F.when(F.col("_idcg") > 0, F.col("_dcg") / F.col("_idcg")).otherwise(F.lit(0.0)))
    steps = (ratio.withColumn("_step", F.col("_ratio") - F.lag("_ratio", 1, 0.0).over(of_user))
             .groupBy(*by, "k").agg(F.sum("_step").alias("_step")))
    grid = sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("n_users")).select("*", every_k)
    keyed = [*by, "k"]
    grid = grid.join(curve("_n", "_prec"), keyed).join(curve("_m", "_rec"), keyed).join(steps, keyed, "left")
    upto = Window.partitionBy(*by).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # max_k rows
    n = F.col("n_users")
    return grid.select(*keyed, "n_users", (F.col("_prec") / n).alias("precision_lk"), (F.col("_rec") / n).alias("recall_lk"),
                       (F.sum(F.coalesce("_step", F.lit(0.0))).over(upto) / n).alias("ndcg_lk"),
                       (F.sum("_prec").over(upto) / F.col("k") / n).alias("map_manual"))
