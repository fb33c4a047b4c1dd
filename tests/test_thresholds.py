import pytest
from pyspark.sql import functions as F

from implicit_rank.operators.bias import BiasConfig, fit_bias
from implicit_rank.operators.metrics import ranking_metrics
from implicit_rank.operators.prep import drop_low_counts
from implicit_rank.operators.thresholds import fit_by_threshold, level_of, metrics_by_threshold, suffix_sums

ROWS = [(u, i, float((u * 7 + i * 13) % 11)) for u in range(12) for i in range(9) if (u + i) % 3] + [(1, 20, None), (50, 21, 2.0)]
TEST = [(u, (u * 2) % 9, float(u % 7)) for u in range(14)] + [(60, 3, 9.0), (2, 5, None)]
SCHEMA = "user_id bigint, item_id bigint, cnt double"
STEPS = (2, 5, 5, 9, 40)


@pytest.mark.parametrize("config", [BiasConfig(damping=(2.0, 3.0)), BiasConfig(), BiasConfig(item=False, damping=1.0)])
def test_equals_a_fit_per_threshold(spark, config):
    ratings = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    model = fit_by_threshold(ratings, STEPS, config)
    items = {(r.level, r.item_id): (r.b_i, r.n_i) for r in model.items.collect()}
    users = {(r.level, r.user_id): (r.b_u, r.n_u) for r in model.user_offsets().collect()}
    mus = {r.level: r.mu for r in model.stats.collect()}
    assert model.thresholds == [2.0, 5.0, 9.0, 40.0] and set(mus) == {1, 2, 3}
    want_items, want_users = {}, {}
    for level, n in enumerate(model.thresholds, 1):
        one = fit_bias(drop_low_counts(ratings, n), config)
        want_items |= {(level, r.item_id): (r.b_i, r.n_i) for r in one.catalogue.collect()}
        want_users |= {(level, r.user_id): (r.b_u, r.n_u) for r in one.user_offsets.collect()}
        if level in mus:
            assert mus[level] == one.stats.first().mu
    assert items == want_items
    assert set(users) == set(want_users)
    for key, (b_u, n_u) in want_users.items():
        assert users[key][0] == pytest.approx(b_u, abs=1e-12) and users[key][1] == n_u


def test_lists_and_metrics_equal_a_run_per_threshold(spark):
    train, test = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(TEST, SCHEMA)
    config = BiasConfig(damping=(2.0, 3.0))
    model = fit_by_threshold(train, STEPS, config)
    held = test.withColumn("level", level_of(F.col("cnt"), model.thresholds)).where("level > 0")
    lists = {(r.level, r.user_id, r.rnk): r.item_id for r in model.recommend(held, 4).collect()}
    found = {r.threshold: r for r in metrics_by_threshold(train, test, STEPS, 4, config).collect()}
    want = {}
    for level, n in enumerate(model.thresholds, 1):
        kept, truth = drop_low_counts(train, n), drop_low_counts(test, n)
        recs = fit_bias(kept, config).recommend(truth.select("user_id"), kept, 4)
        want |= {(level, r.user_id, r.rnk): r.item_id for r in recs.collect()}
        one = ranking_metrics(recs, truth, 4).first()
        assert found[n].n_users == one.n_users
        for name in ("precision_at_k", "map", "ndcg_at_k"):
            assert found[n][name] == (None if one[name] is None else pytest.approx(one[name]))
    assert lists == want and found[40.0].n_users == 0 and found[40.0].map is None


def test_empty_tables_and_null_counts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(1, 1, None)], SCHEMA)
    for train in (empty, nulls):
        rows = metrics_by_threshold(train, nulls, (1, 2), 3).collect()
        assert sorted((r.threshold, r.n_users) for r in rows) == [(1.0, 0), (2.0, 0)]


def test_suffix_sums_fill_levels_without_rows(spark):
    cells = spark.createDataFrame([("a", 2, 5), ("a", 4, 7), ("b", 1, 1)], "k string, level bigint, s bigint")
    got = sorted(tuple(r) for r in suffix_sums(cells, ["k"], ["s"]).select("k", "level", "s").collect())
    assert got == [("a", 1, 12), ("a", 2, 12), ("a", 3, 7), ("a", 4, 7), ("b", 1, 1)]


def test_item_rows_are_those_of_the_single_thresholds(spark, sf_small):
    from implicit_rank.sources.fixtures import purchases
    from implicit_rank.session import materialize
    train = materialize(purchases(spark, sf_small), "pairs")
    model = fit_by_threshold(train, (1, 10, 20, 30), BiasConfig())
    assert model.items.count() == sum(drop_low_counts(train, n).select("item_id").distinct().count() for n in (1, 10, 20, 30))
