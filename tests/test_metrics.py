import math
import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from implicit_rank.functions.arrays import empty_if_null, ranked_lists
from implicit_rank.operators.metrics import (lenient_per_user, metrics_by_k, metrics_long, per_user_metrics,
                                             ranking_metrics)

# user -> (ranked list, truth set)
CASES = {
    1: ([10, 11, 12, 13, 14], {11, 14, 99}),   # hits at 2 and 5
    2: ([20, 21], {20, 21, 22, 23}),          # list shorter than k, k > truth? no
    3: ([30, 31, 32], {39}),                  # no hits
    4: ([], {40, 41}),                        # empty recommendations
    5: ([50, 51, 52, 53, 54, 55], {50}),      # k < list length, single truth
}


def _frames(spark):
    recs = [(u, i, r + 1) for u, (lst, _) in CASES.items() for r, i in enumerate(lst)]
    truth = [(u, i, 1.0) for u, (_, t) in CASES.items() for i in t]
    return (spark.createDataFrame(recs, "user_id bigint, item_id bigint, rnk bigint"),
            spark.createDataFrame(truth, "user_id bigint, item_id bigint, cnt double"))


@pytest.mark.parametrize("k", [2, 5])
def test_matches_spark_ranking_evaluator(spark, k):
    recs, truth = _frames(spark)
    ours = ranking_metrics(recs, truth, k).first().asDict()
    lists = spark.createDataFrame(
        [(u, [float(x) for x in lst], [float(x) for x in sorted(t)]) for u, (lst, t) in CASES.items()],
        "user_id bigint, prediction array<double>, label array<double>")
    names = {"precision_at_k": "precisionAtK", "recall_at_k": "recallAtK", "map": "meanAveragePrecision",
             "map_at_k": "meanAveragePrecisionAtK", "ndcg_at_k": "ndcgAtK"}
    # MAP is defined on the list as produced, i.e. cut at k
    cut = lists.withColumn("prediction", F.slice("prediction", 1, k))
    for ours_name, spark_name in names.items():
        ev = RankingEvaluator(metricName=spark_name, k=k, predictionCol="prediction", labelCol="label")
        assert ours[ours_name] == pytest.approx(ev.evaluate(cut), abs=1e-12), ours_name
    assert ours["n_users"] == len(CASES)


def test_include_missing_drops_users_without_recs(spark):
    recs, truth = _frames(spark)
    kept = {r.user_id for r in per_user_metrics(recs, truth, 5, include_missing=False).collect()}
    assert kept == {1, 2, 3, 5}


def test_metrics_at_every_k_in_one_pass(spark):
    recs, truth = _frames(spark)
    rows = {r.k: r for r in metrics_by_k(recs, truth, 7).collect()}
    assert sorted(rows) == list(range(1, 8))
    for k in rows:
        alone = ranking_metrics(recs, truth, k).first()
        assert rows[k].n_users == alone.n_users
        for name in ("precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k"):
            assert rows[k][name] == pytest.approx(alone[name]), (k, name)


def test_repeated_truth_is_a_set(spark):
    recs = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "user_id bigint, item_id bigint, rnk bigint")
    truth = spark.createDataFrame([(1, 10, 1.0), (1, 10, 1.0), (1, 12, 1.0)], "user_id bigint, item_id bigint, cnt double")
    row = ranking_metrics(recs, truth, 5).first()
    assert row.recall_at_k == 0.5 and row.map == 0.5
    lenient = lenient_per_user(recs, truth, 5).first()
    assert lenient.n_hits == 1 and lenient.recall_lk == 0.5
    assert metrics_by_k(recs, truth, 5).where("k = 5").first().recall_at_k == 0.5


def _lenient_reference(lst, truth_gain, k):
    lst = lst[:k]
    n = len(lst)
    hits = [i for i in lst if i in truth_gain]
    prec = len(hits) / min(n, k)
    rec = len(hits) / min(len(truth_gain), k)

    def dcg(gains):
        return sum(g / max(math.log2(r), 1.0) for r, g in enumerate(gains, start=1))

    ndcg = dcg([truth_gain.get(i, 0.0) for i in lst]) / dcg(sorted(truth_gain.values(), reverse=True)[:k])
    manual = sum(sum(1 for i in lst[:t] if i in truth_gain) / min(t, n) for t in range(1, k + 1)) / k
    return prec, rec, ndcg, manual


def test_lenient_metrics_and_one_pass_manual_map(spark):
    rnd = random.Random(7)
    k = 6
    cases = {}
    for u in range(40):
        items = rnd.sample(range(30), rnd.randint(1, 10))
        truth = {i: float(rnd.randint(1, 5)) for i in rnd.sample(range(30), rnd.randint(1, 8))}
        cases[u] = (items, truth)
    recs = spark.createDataFrame([(u, i, r + 1) for u, (lst, _) in cases.items() for r, i in enumerate(lst)],
                                 "user_id bigint, item_id bigint, rnk bigint")
    truth = spark.createDataFrame([(u, i, g) for u, (_, t) in cases.items() for i, g in t.items()],
                                  "user_id bigint, item_id bigint, cnt double")
    got = {r.user_id: r for r in lenient_per_user(recs, truth, k).collect()}
    for u, (lst, t) in cases.items():
        prec, rec, ndcg, manual = _lenient_reference(lst, t, k)
        assert got[u].precision_lk == pytest.approx(prec)
        assert got[u].recall_lk == pytest.approx(rec)
        assert got[u].ndcg_lk == pytest.approx(ndcg)
        assert got[u].map_manual == pytest.approx(manual)


def test_long_form_and_lists(spark):
    recs, truth = _frames(spark)
    wide = ranking_metrics(recs, truth, 5).drop("n_users")
    assert {r.metric for r in metrics_long(wide).collect()} == {
        "precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k"}
    lists = {r.user_id: r.items for r in ranked_lists(recs).collect()}
    assert lists[1] == [10, 11, 12, 13, 14]
    filled = spark.createDataFrame([(1, None)], "u int, xs array<bigint>").select(empty_if_null("xs").alias("xs"))
    assert filled.first().xs == []


def test_lenient_curve_is_the_metrics_at_every_k(spark):
    """Short lists, truths of many sizes, ties and zero gains; the plan repeats neither lists nor truth."""
    from implicit_rank.operators.metrics import lenient_by_k, lenient_metrics
    rng = random.Random(4)
    recs = [(u, i, r + 1) for u in range(12) for r, i in enumerate(rng.sample(range(15), rng.randint(1, 9)))]
    truth = [(u, i, float(rng.choice([0, 1, 1, 3]))) for u in range(13) if u != 5 for i in rng.sample(range(15), rng.randint(1, 11))]
    truth += [(3, truth[0][1], 0.0), (14, 1, 0.0)]
    recs_t = spark.createDataFrame(recs + [(14, 1, 1)], "user_id long, item_id long, rnk long")
    truth_t = spark.createDataFrame(truth, "user_id long, item_id long, cnt double")
    curve = lenient_by_k(recs_t, truth_t, 9)
    got = {r["k"]: r for r in curve.collect()}
    for k in range(1, 10):
        want = lenient_metrics(recs_t, truth_t, k).first().asDict()
        assert {n: pytest.approx(v) for n, v in want.items()} == {n: got[k][n] for n in want}
