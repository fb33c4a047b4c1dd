import pandas as pd
import pytest
from pyspark.sql import functions as F

from implicit_rank.operators.bias import BiasConfig, BiasModel, fit_bias
from implicit_rank.operators.rank import catalogue_topk
from implicit_rank.session import shared_folder

ROWS = [(1, 10, 5.0), (1, 11, 3.0), (2, 10, 4.0), (2, 12, 1.0), (3, 11, 2.0), (3, 12, 2.0), (3, 13, 6.0)]


def _df(spark, rows=ROWS):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, cnt double")


def test_config_checks():
    with pytest.raises(ValueError):
        BiasConfig(damping=-1)
    with pytest.raises(ValueError):
        BiasConfig(damping=(1.0, -2.0))
    c = BiasConfig(damping=(100, 300))
    assert (c.user_damping, c.item_damping) == (100.0, 300.0)
    assert BiasConfig(damping=5).user_damping == 5.0


def test_undamped_offsets_are_means(spark):
    m = fit_bias(_df(spark), BiasConfig(damping=0))
    pdf = pd.DataFrame(ROWS, columns=["u", "i", "r"])
    mu = pdf.r.mean()
    bi = (pdf.r - mu).groupby(pdf.i).mean()
    got_i = {r.item_id: r.b_i for r in m.item_offsets.collect()}
    for i, v in bi.items():
        assert got_i[i] == pytest.approx(v)
    pdf["res"] = pdf.r - mu - pdf.i.map(bi)
    bu = pdf.res.groupby(pdf.u).mean()
    got_u = {r.user_id: r.b_u for r in m.user_offsets.collect()}
    for u, v in bu.items():
        assert got_u[u] == pytest.approx(v)


def test_damped_offsets(spark):
    m = fit_bias(_df(spark), BiasConfig(damping=(2.0, 3.0)))
    pdf = pd.DataFrame(ROWS, columns=["u", "i", "r"])
    mu = pdf.r.mean()
    g = (pdf.r - mu).groupby(pdf.i)
    bi = g.sum() / (g.count() + 3.0)
    got = {r.item_id: r.b_i for r in m.item_offsets.collect()}
    assert all(got[i] == pytest.approx(v) for i, v in bi.items())
    pdf["res"] = pdf.r - mu - pdf.i.map(bi)
    gu = pdf.res.groupby(pdf.u)
    bu = gu.sum() / (gu.count() + 2.0)
    got_u = {r.user_id: r.b_u for r in m.user_offsets.collect()}
    assert all(got_u[u] == pytest.approx(v) for u, v in bu.items())


def test_predict_keeps_unseen_pairs(spark):
    m = fit_bias(_df(spark), BiasConfig(damping=0))
    mu = sum(r[2] for r in ROWS) / len(ROWS)
    pairs = spark.createDataFrame([(1, 99), (99, 10), (99, 98)], "user_id bigint, item_id bigint")
    got = {(r.user_id, r.item_id): r.prediction for r in m.predict(pairs).collect()}
    assert len(got) == 3
    assert got[(99, 98)] == pytest.approx(mu)
    b10 = {r.item_id: r.b_i for r in m.item_offsets.collect()}[10]
    assert got[(99, 10)] == pytest.approx(mu + b10)


def test_flags_switch_parts_off(spark):
    item_only = fit_bias(_df(spark), BiasConfig(item=True, users=False))
    assert item_only.user_offsets is None
    user_only = fit_bias(_df(spark), BiasConfig(item=False, users=True, damping=0))
    mu = sum(r[2] for r in ROWS) / len(ROWS)
    got = {r.user_id: r.b_u for r in user_only.user_offsets.collect()}
    assert got[1] == pytest.approx((5 + 3) / 2 - mu)


def test_equal_counts_give_zero_offsets(spark):
    rows = [(u, i, 3.0) for u in range(3) for i in range(4)]
    m = fit_bias(_df(spark, rows), BiasConfig(damping=1))
    assert all(r.b_i == 0 for r in m.item_offsets.collect())


def test_save_load_round_trip(spark):
    m = fit_bias(_df(spark), BiasConfig(damping=(1.0, 2.0)))
    path = m.save(shared_folder(spark, "test-bias"))
    back = BiasModel.load(spark, path)
    assert back.config == m.config
    pairs = _df(spark).select("user_id", "item_id")
    a = {(r.user_id, r.item_id): r.prediction for r in m.predict(pairs).collect()}
    b = {(r.user_id, r.item_id): r.prediction for r in back.predict(pairs).collect()}
    assert a == pytest.approx(b)


def _brute(order, seen, users, k):
    out = {}
    for u in users:
        s = seen.get(u, set())
        out[u] = [i for i in order if i not in s][:k]
    return out


@pytest.mark.parametrize("bucket_rows,head_rows", [(4, 5), (64, 64), (3, 1000)])
def test_catalogue_topk_equals_brute_force(spark, bucket_rows, head_rows):
    import random
    rnd = random.Random(3)
    n_items, k = 40, 7
    order = list(range(100, 100 + n_items))
    rnd.shuffle(order)
    seen = {u: set(rnd.sample(order, rnd.randint(0, 20))) for u in range(25)}
    seen[25] = set(order)            # has seen every item
    seen[26] = set(order[:-3])       # fewer than k unseen left
    users = list(range(28))          # user 27 has no history
    item_rank = spark.createDataFrame([(i, r + 1) for r, i in enumerate(order)], "item_id bigint, r bigint")
    pairs = [(u, i) for u, s in seen.items() for i in s]
    seen_df = spark.createDataFrame(pairs + pairs[::3], "user_id bigint, item_id bigint")  # with repeats
    users_df = spark.createDataFrame([(u,) for u in users], "user_id bigint")
    users_df = users_df.where("user_id != 5")  # user 5 has history but is not a target
    users = [u for u in users if u != 5]
    got = catalogue_topk(item_rank, seen_df, users_df, k, bucket_rows=bucket_rows, head_rows=head_rows)
    lists = {}
    for r in got.orderBy("user_id", "rnk").collect():
        lists.setdefault(r.user_id, []).append(r.item_id)
    want = _brute(order, seen, users, k)
    assert {u: v for u, v in want.items() if v} == lists


def test_rank_observed_is_all_hits(spark):
    """Ranking only held-out pairs makes MAP and NDCG 1 (the coded behaviour)."""
    from implicit_rank.operators.metrics import ranking_metrics
    df = _df(spark)
    m = fit_bias(df, BiasConfig(damping=0))
    recs = m.rank_observed(df, 10)
    row = ranking_metrics(recs, df, 10).first()
    assert row.map == pytest.approx(1.0) and row.ndcg_at_k == pytest.approx(1.0)


def test_ties_are_broken_by_item_id(spark):
    # items 7, 3, 5 have identical counts -> identical b_i; order must be by id
    rows = [(u, i, 2.0) for u in (1, 2) for i in (7, 3, 5)] + [(3, 9, 9.0)]
    m = fit_bias(_df(spark, rows), BiasConfig(damping=0))
    order = [r.item_id for r in m.item_order().orderBy("r").collect()]
    assert order == [9, 3, 5, 7]
    users = spark.createDataFrame([(3,)], "user_id bigint")
    recs = m.recommend(users, _df(spark, rows).select("user_id", "item_id"), 2).orderBy("rnk").collect()
    assert [r.item_id for r in recs] == [3, 5]


def test_one_interaction(spark):
    m = fit_bias(_df(spark, [(1, 1, 4.0)]), BiasConfig(damping=0))
    assert m.item_offsets.first().b_i == 0.0 and m.user_offsets.first().b_u == 0.0
    assert m.stats.first().mu == 4.0


def test_users_without_truth_are_not_scored(spark):
    from implicit_rank.operators.metrics import ranking_metrics
    recs = spark.createDataFrame([(1, 10, 1), (2, 20, 1)], "user_id bigint, item_id bigint, rnk bigint")
    truth = spark.createDataFrame([(1, 10, 1.0)], "user_id bigint, item_id bigint, cnt double")
    row = ranking_metrics(recs, truth, 1).first()
    assert row.n_users == 1 and row.precision_at_k == 1.0


def test_null_counts_have_no_residual(spark):
    rows = [(1, 10, 2.0), (1, 11, None), (2, 10, 4.0), (2, 12, None)]
    m = fit_bias(_df(spark, rows), BiasConfig(damping=(1.0, 2.0)))
    assert m.stats.first().mu == 3.0
    items = {r.item_id: (r.b_i, r.n_i) for r in m.item_offsets.collect()}
    assert items == {10: (0.0, 2), 11: (0.0, 1), 12: (0.0, 1)}
    users = {r.user_id: (r.b_u, r.n_u) for r in m.user_offsets.collect()}
    assert users == {1: (pytest.approx(-1 / 3), 2), 2: (pytest.approx(1 / 3), 2)}


def test_close_scores_are_not_ties(spark):
    """Offsets that differ by less than 1e-9 keep their order."""
    rows = [(1, 5, 1.0), (1, 4, 1.0000000001), (1, 6, 1.0)]
    m = fit_bias(_df(spark, rows), BiasConfig(damping=0))
    assert [r.item_id for r in m.item_order().orderBy("r").collect()] == [4, 5, 6]


def test_recommend_without_item_offsets(spark):
    m = fit_bias(_df(spark), BiasConfig(item=False))
    users = spark.createDataFrame([(1,)], "user_id bigint")
    recs = m.recommend(users, _df(spark).select("user_id", "item_id"), 5).orderBy("rnk").collect()
    assert [r.item_id for r in recs] == [12, 13]


def test_saving_again_replaces_the_model(spark):
    path = shared_folder(spark, "test-bias")
    fit_bias(_df(spark), BiasConfig(damping=1)).save(path)
    with pytest.raises(Exception):
        fit_bias(_df(spark), BiasConfig(damping=2)).save(path, mode="errorifexists")
    fit_bias(_df(spark), BiasConfig(damping=2)).save(path)
    assert BiasModel.load(spark, path).config.user_damping == 2.0


def test_save_onto_its_own_path(spark):
    """A loaded model survives being saved where it lies; a save that stops before its row changes nothing."""
    from implicit_rank.session import remove_old, shared_folder
    path = shared_folder(spark, "test-bias-own")
    train = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (2, 1, 3.0)], "user_id long, item_id long, cnt double")
    fit_bias(train, BiasConfig(damping=(1.0, 2.0))).save(path)
    loaded = BiasModel.load(spark, path)
    want = sorted(map(tuple, loaded.predict(train).collect()))
    loaded.save(path)
    again = BiasModel.load(spark, path)
    assert sorted(map(tuple, again.predict(train).collect())) == want
    with pytest.raises(FileExistsError):
        again.save(path, mode="error")
    other = fit_bias(train, BiasConfig(users=False))
    other.catalogue.write.parquet(f"{path}/save-dead/item_offsets")  # a save that died before its row
    assert sorted(map(tuple, BiasModel.load(spark, path).predict(train).collect())) == want
    other.save(path)
    assert not BiasModel.load(spark, path).config.users
    assert remove_old(spark, path) == 4 and BiasModel.load(spark, path).user_offsets is None
