"""What the top-k, curve and search steps read, send and produce as their tables grow."""

from pyspark.sql import functions as F

from implicit_rank.operators import rank
from implicit_rank.operators.rank import catalogue_topk


def _written(monkeypatch):
    tables, write = {}, rank.materialize
    monkeypatch.setattr(rank, "materialize", lambda df, name, *a: tables.setdefault(name, write(df, name, *a)))
    return tables


def _lists(df):
    out = {}
    for r in df.orderBy("user_id", "rnk").collect():
        out.setdefault(r.user_id, []).append(r.item_id)
    return out


def test_only_seen_pairs_of_the_head_are_counted(spark, monkeypatch):
    """Users who have seen items far below the head, one who has seen nearly all of it, and one without history."""
    ranks = spark.range(1, 2001).select(F.col("id").alias("item_id"), F.col("id").alias("r"))
    seen = {1: {1, 3, *range(900, 1900)}, 2: set(range(500, 1500)), 3: {*range(1, 19), 21, 24, 1999}}
    pairs = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id long, item_id long")
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    tables = _written(monkeypatch)
    got = _lists(catalogue_topk(ranks, pairs, users, 5, head_rows=20))
    assert got == {u: [i for i in range(1, 2001) if i not in seen.get(u, ())][:5] for u in range(1, 5)}
    assert tables["unseen-head"].groupBy("user_id").count().rdd.collectAsMap() == {1: 2, 3: 18}
    assert [r.user_id for r in tables["unseen-beyond"].collect()] == [3]


def test_slots_end_with_the_catalogue(spark):
    """A list longer than any catalogue costs the rows that it can hold."""
    ranks = spark.range(1, 41).select((F.col("id") + 100).alias("item_id"), F.col("id").alias("r"))
    seen = spark.createDataFrame([(1, 101), (1, 140), (2, 120)], "user_id long, item_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = _lists(catalogue_topk(ranks, seen, users, 1 << 40))
    assert got == {1: list(range(102, 140)), 2: [i for i in range(101, 141) if i != 120], 3: list(range(101, 141))}


def test_curve_produces_the_lists_once(spark):
    """The curve's plan reads the written lists, not what made them."""
    from implicit_rank.operators.metrics import lenient_by_k
    recs = spark.range(60).select((F.col("id") % 6).alias("user_id"), F.col("id").alias("item_id"), (F.floor(F.col("id") / 6) + 1).alias("rnk"))
    truth = spark.createDataFrame([(u, u + 6 * j, 1.0) for u in range(6) for j in (0, 2)], "user_id long, item_id long, cnt double")
    curve = lenient_by_k(recs, truth, 10)
    assert "Range" not in curve._jdf.queryExecution().optimizedPlan().toString()
    assert [r.recall_lk for r in curve.orderBy("k").collect()][:3] == [1.0, 0.5, 1.0]


def test_ratio_search_splits_written_pairs(spark, monkeypatch):
    """Both halves and the refit read one table of indexed pairs; settings fitted side by side give the same metrics."""
    from pyspark.ml.tuning import TrainValidationSplit

    from implicit_rank.operators.als import AlsParams
    from implicit_rank.plans.tune import build_grid, train_ratio_search
    plans, fit = [], TrainValidationSplit.fit

    def spy(self, dataset, *a):
        plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, dataset, *a)

    monkeypatch.setattr(TrainValidationSplit, "fit", spy)
    rows = [(f"u{u}", 7 * i, float((u * i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    train, val = (spark.createDataFrame(r, "user_id string, item_id long, cnt double") for r in (rows[::2], rows[1::2]))
    grid = build_grid([2, 3], [1.0], [10.0], AlsParams(max_iter=1))
    one, best = train_ratio_search(train, val, grid, 5)
    two, best_two = train_ratio_search(train, val, grid, 5, parallelism=2)
    assert one == two and best == best_two and len(one) == 2 and all(m > 0 for m in one)
    assert not any("Join" in p for p in plans)
