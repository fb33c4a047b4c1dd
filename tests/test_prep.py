import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from implicit_rank.functions.rating import to_rating
from implicit_rank.operators.indexing import frequency_index, global_row_number
from implicit_rank.operators.prep import drop_low_counts, preprocess, split_counts
from implicit_rank.operators.sample import (fold_test, fold_train, hash_split, top_user_interactions,
                                            top_users, user_folds)
from implicit_rank.sources.fixtures import purchases


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 1000).repartition(13)
    out = global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "rn").orderBy("rn").collect()
    assert [r.rn for r in out] == list(range(1, 5001))
    keys = [(-r.v, r.id) for r in out]
    assert keys == sorted(keys)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_frequency_index_equals_string_indexer(spark, kind):
    rows = [(str(x) if kind == "string" else x,) for x in [5, 3, 3, 12, 12, 12, 7, 7, 100, 2, 2]]
    df = spark.createDataFrame(rows, f"u {kind}")
    ours = {r.u: r.u_index for r in frequency_index(df, "u").collect()}
    si = StringIndexer(inputCol="u", outputCol="idx", stringOrderType="frequencyDesc").fit(df)
    theirs = {r.u: int(r.idx) for r in si.transform(df).distinct().collect()}
    assert ours == theirs


def test_hash_split_is_stable_under_repartition(spark, sf_small):
    p = purchases(spark, sf_small)
    a = {(r.user_id, r.item_id): r.split for r in hash_split(p, 42).collect()}
    b = {(r.user_id, r.item_id): r.split for r in hash_split(p.repartition(7), 42).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.75 < share < 0.85


def test_user_folds_are_disjoint_and_complete(spark, sf_small):
    p = purchases(spark, sf_small)
    f = user_folds(p, 5, 5, 42)
    rows = f.collect()
    assert len(rows) == p.count()
    per_user_fold = {}
    held = {}
    for r in rows:
        per_user_fold.setdefault(r.user_id, set()).add(r.fold)
        held[r.user_id] = held.get(r.user_id, 0) + r.holdout
    assert all(len(v) == 1 for v in per_user_fold.values())
    assert all(0 <= n <= 5 for n in held.values())
    for fold in range(5):
        tr, te = fold_train(f, fold).count(), fold_test(f, fold).count()
        assert tr + te == len(rows)
    assert fold_test(f).count() == sum(held.values())


def test_top_users_break_ties_by_id(spark):
    rows = [(u, i, 1.0) for u, n in ((5, 3), (2, 3), (9, 1), (1, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, cnt double")
    assert [r.user_id for r in top_users(df, 2).collect()] == [2, 5]
    assert {r.user_id for r in top_user_interactions(df, 3).collect()} == {1, 2, 5}


def test_threshold_and_counts(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 3)], "user_id bigint, item_id bigint, cnt bigint")
    assert drop_low_counts(df, 2).count() == 2
    pre = preprocess({"train": df, "test": df}, min_count=2)
    got = {r.split: r.n_rows for r in split_counts(pre).collect()}
    assert got == {"train": 2, "test": 2}
    assert dict(pre.dtypes)["user_idx"] == "int"


def test_rating_transform_edges(spark):
    one = spark.createDataFrame([(1, 1, 4.0)], "user_id bigint, item_id bigint, cnt double")
    assert to_rating(one).first().cnt == 2.5
    same = spark.createDataFrame([(1, i, 4.0) for i in range(3)], "user_id bigint, item_id bigint, cnt double")
    assert {r.cnt for r in to_rating(same).collect()} == {2.5}
    vals = [1.0, 2.0, 2.0, 3.0, 3.0, 3.0, 50.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "user_id bigint, item_id bigint, cnt double")
    out = [r.cnt for r in to_rating(df).orderBy("item_id").collect()]
    assert all(0.05 <= x <= 5.0 for x in out)
    assert out == sorted(out)


def test_csv_with_ddl_json_views_and_route(spark, sf_small):
    import tempfile

    from implicit_rank.operators.prep import route
    from implicit_rank.sources.io import preview, read_csv, read_json, register_views
    d = tempfile.mkdtemp(prefix="ir-io-", dir="/tmp")
    cust = spark.read.parquet(f"{sf_small}/customer.parquet").select("c_custkey", "c_name", "c_nationkey")
    cust.write.csv(f"{d}/customer_csv")
    back = read_csv(spark, f"{d}/customer_csv", "c_custkey BIGINT, c_name STRING, c_nationkey INT")
    assert back.schema.simpleString() == "struct<c_custkey:bigint,c_name:string,c_nationkey:int>"
    assert back.count() == cust.count()
    cust.write.json(f"{d}/customer_json")
    inferred = read_json(spark, f"{d}/customer_json")
    assert set(inferred.columns) == {"c_custkey", "c_name", "c_nationkey"}
    register_views(spark, sailors=inferred)
    n = spark.sql("SELECT c_custkey, c_name FROM sailors WHERE c_nationkey > 6").count()
    assert n == cust.where("c_nationkey > 6").count()
    assert preview(inferred, 3).count() == 3
    tagged = hash_split(purchases(spark, sf_small), 42)
    assert route(tagged, "test").where("split != 'test'").count() == 0


def test_null_ids_are_skipped_on_read(spark):
    import tempfile

    from implicit_rank.sources.io import SchemaError, read_interactions
    d = tempfile.mkdtemp(prefix="ir-nulls-", dir="/tmp")
    spark.createDataFrame([("a", 1, "t1"), (None, 2, "t2"), ("b", 3, None), ("c", 4, "t3")],
                          "user_id string, count int, track_id string").write.parquet(f"{d}/x")
    df = read_interactions(spark, f"{d}/x", "user_id", "track_id", "count")
    assert df.columns == ["user_id", "item_id", "cnt"] and df.count() == 2
    with pytest.raises(SchemaError):
        read_interactions(spark, f"{d}/x", "uid", "track_id", "count")


def test_even_folds(spark):
    """Fold sizes differ by at most one user; repeated rows stay single; facts are shuffled by user alone."""
    from implicit_rank.operators.sample import user_folds
    rows = [(u, i, 1.0) for u in range(23) for i in range(3 + u % 4)] + [(1, 0, 1.0), (None, 4, 1.0), (2, None, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, cnt double")
    for even in (True, False):
        folds = user_folds(df, 5, 2, even=even)
        assert folds.columns == [*df.columns, "holdout", "fold"] and folds.count() == len(rows)
        held = {r["user_id"]: r["n"] for r in folds.where("holdout = 1").groupBy("user_id").agg(F.countDistinct("item_id").alias("n")).collect()}
        assert set(held) == set(range(23)) and all(1 <= n <= 2 for n in held.values())
        plan = folds._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(user_id" in plan and "hashpartitioning(user_id#" in plan and ", item_id" not in "".join(
            line.split("hashpartitioning")[1] for line in plan.splitlines() if "hashpartitioning" in line)
    users = user_folds(df, 5, 2, even=True).where("user_id IS NOT NULL").select("user_id", "fold").distinct().groupBy("fold").count().collect()
    sizes = [r["count"] for r in users]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
