"""Scale properties of the physical plans, checked on the plan text."""

from pyspark.sql import functions as F

from implicit_rank.operators.metrics import ranking_metrics
from implicit_rank.operators.rank import catalogue_topk, top_k_per_user
from implicit_rank.operators.sample import top_user_interactions, user_folds
from implicit_rank.sources.fixtures import purchases


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _plan_logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_per_user_top_k_limits_before_the_shuffle(spark, sf_small):
    p = purchases(spark, sf_small)
    plan = _plan(top_k_per_user(p, 5, [F.col("cnt").desc(), F.col("item_id")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    folds = _plan(user_folds(p))
    assert "Partial" in folds and "WindowGroupLimit" in folds


def test_catalogue_windows_are_bucketed_for_large_catalogues(spark):
    ranks = spark.range(1, 1001).select(F.col("id").alias("item_id"), F.col("id").alias("r"))
    seen = spark.range(0, 3000).select((F.col("id") % 3).alias("user_id"), (F.col("id") % 1000 + 1).alias("item_id")).distinct()
    users = spark.range(0, 3).select(F.col("id").alias("user_id"))
    import re

    plan = _plan_logical(catalogue_topk(ranks, seen, users, 5, bucket_rows=100, head_rows=50))
    # seen items are numbered inside (user, rank bucket) groups ...
    assert re.search(r"\[user_id#\d+L, _b#\d+L\], \[_r#\d+L ASC", plan), plan
    # ... with a prefix over the per-bucket counts of each user
    assert "sum(_nb" in plan


def test_one_plan_for_every_size(spark):
    """The same operators whatever the catalogue and the number of users."""
    import re

    def operators(n):
        ranks = spark.range(1, n).select(F.col("id").alias("item_id"), F.col("id").alias("r"))
        seen = spark.range(0, n).select((F.col("id") % 3).alias("user_id"), (F.col("id") + 1).alias("item_id"))
        users = spark.range(0, n).select(F.col("id").alias("user_id"))
        return re.findall(r"^[\s:+\-]*(\w+)", _plan_logical(catalogue_topk(ranks, seen, users, 5)), re.M)

    assert operators(50) == operators(3_000_000)


def _hot(spark, n=30_000):
    """Half of the rows on one item and on one user."""
    row = F.col("id")
    return spark.range(n).select(
        F.when(row % 2 == 0, row).otherwise(F.lit(7)).alias("user_id"),
        F.when(row % 2 == 0, F.lit(3)).otherwise(row).alias("item_id"), (row % 5).cast("double").alias("cnt"))


def test_hot_keys_are_split_in_bias_joins(spark):
    from implicit_rank.functions.rating import to_rating
    from implicit_rank.operators.bias import BiasConfig, fit_bias
    from implicit_rank.session import materialize

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.files.maxPartitionBytes": "32k",
            "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        data = materialize(_hot(spark).repartition(8), "hot")
        model = fit_bias(data, BiasConfig(damping=5))
        for df in (model.predict(data.select("user_id", "item_id")), to_rating(data, per_item=True)):
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            assert "skew=true" in _plan(df), _plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_als_topk_has_no_cartesian_product(spark, sf_small):
    from implicit_rank.operators import als, topk
    from implicit_rank.operators.sample import hash_split
    s = hash_split(purchases(spark, sf_small), 42).checkpoint()
    train = s.where("split = 'train'").select("user_id", "item_id", "cnt")
    plans = []
    keep = topk.materialize
    topk.materialize = lambda df, *a: (plans.append(_plan(df)), keep(df, *a))[1]
    try:
        als.recommend(als.fit_als(train, als.AlsParams(rank=3, max_iter=1, ids="raw")), train.select("user_id"), train, 5)
    finally:
        topk.materialize = keep
    assert plans and not any("Cartesian" in p or "NestedLoop" in p for p in plans)


def test_every_k_needs_no_repeated_lists(spark, sf_small):
    from implicit_rank.operators.metrics import metrics_by_k
    p = purchases(spark, sf_small)
    recs = p.select("user_id", "item_id", F.lit(1).cast("bigint").alias("rnk"))
    plan = _plan_logical(metrics_by_k(recs, p, 500))
    # the one Generate stands above the counts of users by |truth|, not above lists or truth
    assert plan.count("Generate explode") == 1
    above = plan[plan.index("Generate explode"):].splitlines()
    assert any("Aggregate [m#" in line for line in above[:3]), plan


def test_broadcasts_have_bounds(spark, sf_small):
    p = purchases(spark, sf_small)
    plan = _plan(top_user_interactions(p, 10))
    assert "TakeOrderedAndProject" in plan and "LeftSemi" in plan
    recs = p.select("user_id", "item_id", F.lit(1).cast("bigint").alias("rnk"))
    mplan = _plan(ranking_metrics(recs, p, 5))
    assert "BroadcastExchange" in mplan  # the (k+1)-row ideal-DCG table


def test_scans_are_pruned_and_pushed(spark, sf_small):
    plan = _plan(purchases(spark, sf_small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_partkey)" in plan


def test_tables_with_a_row_per_user_or_item_are_not_broadcast(spark, sf_small):
    """Whatever the size of their files says: several runs of a sweep would hold them on the driver together."""
    import re

    from implicit_rank.operators.bias import BiasConfig, fit_bias
    train = purchases(spark, sf_small)
    model = fit_bias(train, BiasConfig(damping=5))
    for df in (model.recommend(train.select("user_id"), train, 5), model.predict(train)):
        joins = re.findall(r"BroadcastHashJoin \[(\w+)#", _plan(df))
        assert set(joins) <= {"l_orderkey", "_r", "_pid"}, joins  # the source's own join, the head of the order, partitions
