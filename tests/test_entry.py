import __spark_entry__ as entry

from implicit_rank.plans.tune import build_grid


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_users > 0
    assert df.columns == ["n_users", "precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_grid_is_the_product():
    grid = build_grid([5, 10], [0.1, 1.0], [10.0, 20.0])
    assert len(grid) == 8
    assert {(g.rank, g.reg, g.alpha) for g in grid} == {
        (r, l, a) for r in (5, 10) for l in (0.1, 1.0) for a in (10.0, 20.0)}


def test_sweep_run_log_round_trip(spark, sf_small):
    from pyspark.sql import functions as F

    from implicit_rank.operators.bias import BiasConfig
    from implicit_rank.operators.sample import hash_split
    from implicit_rank.plans.tune import (Algorithm, bias_fitter, mean_by, read_recs, read_run_log,
                                          run_metrics, sweep, write_run_log)
    from implicit_rank.session import shared_folder
    from implicit_rank.sources.fixtures import purchases

    s = hash_split(purchases(spark, sf_small), 42).checkpoint()
    train = s.where("split = 'train'").select("user_id", "item_id", "cnt")
    test = s.where("split = 'test'").select("user_id", "item_id", "cnt")
    algs = [Algorithm("Bias", {"damping": d}, bias_fitter(BiasConfig(damping=d))) for d in (0.0, 10.0)]
    out = shared_folder(spark, "test-sweep")
    run_log, recs = sweep(spark, {"d": (train, test)}, algs, 5, out_dir=out, parallelism=2)
    path = write_run_log(run_log, f"{out}/runs.csv")
    back = read_run_log(spark, path)
    assert back.count() == 2 and set(back.columns) == set(run_log.columns)
    assert read_recs(spark, f"{out}/recs", [1]).select("run_id").distinct().count() == 1
    table = mean_by(run_metrics(run_log, recs, {"d": test}, 5), ["damping"])
    assert {r.damping for r in table.collect()} == {0.0, 10.0}


def test_sweep_keeps_only_its_results(spark, sf_small, tmp_path, monkeypatch):
    """What a run writes on the way is deleted with it; the tables of the caller stay."""
    import os

    from implicit_rank import session
    from implicit_rank.operators.als import AlsParams
    from implicit_rank.plans.tune import Algorithm, als_fitter, sweep
    from implicit_rank.sources.fixtures import purchases

    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    train = session.materialize(purchases(spark, sf_small), "train")
    algs = [Algorithm("als", {"rank": 2}, als_fitter(AlsParams(rank=2, max_iter=1)))] * 2
    log, recs = sweep(spark, {"d": (train, train)}, algs, 3, parallelism=2)
    assert recs.count() > 0 and train.count() > 0 and log.count() == 2
    assert sorted(n.split("-")[0] for n in os.listdir(tmp_path)) == ["sweep", "train"], os.listdir(tmp_path)
