"""The spark-submit jobs, run in-process on files in a fresh scratch folder."""

import json
import tempfile

import pytest

from pyspark.sql import functions as F

from implicit_rank.jobs import als_train, bias_train, preprocess, subsample
from implicit_rank.operators.sample import hash_split
from implicit_rank.sources.fixtures import purchases


def _inputs(spark, sf_small):
    d = tempfile.mkdtemp(prefix="ir-jobs-", dir="/tmp")
    s = hash_split(purchases(spark, sf_small), 42)
    paths = {}
    for name in ("train", "val", "test"):
        paths[name] = f"{d}/cf_{name}.parquet"
        (s.where(F.col("split") == name)
         .select("user_id", F.col("cnt").cast("int").alias("count"), F.col("item_id").alias("track_id"))
         .write.parquet(paths[name]))
    return d, paths


def test_jobs_run_end_to_end(spark, sf_small, capsys):
    d, p = _inputs(spark, sf_small)
    subsample.main(["-i", p["train"], "-o", d, "-k", "20", "-s", "1004"])
    sub = spark.read.parquet(f"{d}/cf_train_sub_top20_1004.parquet")
    assert sub.select("user_id").distinct().count() == 20
    preprocess.main(["--train", p["train"], "--val", p["val"], "--test", p["test"], "-o", d])
    pre = spark.read.parquet(f"{d}/interactions_processed.parquet")
    assert {r.split for r in pre.select("split").distinct().collect()} == {"train", "val", "test"}
    capsys.readouterr()
    bias_train.main(["-tr", p["train"], "-te", p["test"], "-du", "100", "-di", "300", "-k", "20",
                     "-s", f"{d}/bias_model"])
    out = capsys.readouterr().out
    report = json.loads(out[out.index("{"):])
    assert set(report) >= {"test/precision_at_k", "test/ndcg_at_k"}
    assert not any(k.startswith("train/") for k in report)
    bias_train.main(["-tr", p["train"], "-te", p["test"], "-k", "20", "-l", f"{d}/bias_model",
                     "--mode", "observed"])
    out = capsys.readouterr().out
    observed = json.loads(out[out.index("{"):])
    # only the held pairs are ranked, so every listed item is relevant
    assert observed["train/map_at_k"] == pytest.approx(1.0)
    assert observed["train/ndcg_at_k"] == pytest.approx(1.0)
    als_train.main(["--train-file", p["train"], "--test-file", p["test"], "--rank", "4", "--epochs", "2",
                    "--k", "10", "--save-dir", f"{d}/als"])
    assert "test/map" in capsys.readouterr().out


def test_als_job_grid_search(spark, sf_small, capsys):
    d, p = _inputs(spark, sf_small)
    als_train.main(["--train-file", p["train"], "--val-file", p["val"], "--test-file", p["test"],
                    "--grid-search", "--ranks", "2", "--lambdas", "0.1", "--alphas", "1,2",
                    "--epochs", "2", "--k", "5"])
    out = capsys.readouterr().out
    assert "best" in out and "test/precision_at_k" in out


def test_subsample_job_splits_80_20_and_logs_its_seed(spark, sf_small, capsys):
    d, p = _inputs(spark, sf_small)
    subsample.main(["-i", p["train"], "-o", d, "-k", "60"])
    out = capsys.readouterr().out
    assert "seed: " in out
    counts = {r["split"]: r["n"] for r in spark.read.parquet(f"{d}/cf_train_sub_top60_unseeded.parquet")
              .groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(counts) == {"train", "val"}
    assert 0.75 < counts["train"] / sum(counts.values()) < 0.85


def test_bias_job_train_only_and_saved_twice(spark, sf_small, capsys):
    d, p = _inputs(spark, sf_small)
    for _ in range(2):  # the second save replaces the first
        bias_train.main(["-tr", p["train"], "-k", "20", "-s", f"{d}/model"])
        assert "no split to score" in capsys.readouterr().out
    bias_train.main(["-tr", p["train"], "-k", "20", "--mode", "observed"])
    out = capsys.readouterr().out
    assert set(k.split("/")[0] for k in json.loads(out[out.index("{"):])) == {"train"}
    with pytest.raises(Exception):
        bias_train.main(["-tr", p["train"], "-s", f"{d}/model", "--keep"])


def test_als_job_observed_and_ratio_search_with_string_ids(spark, sf_small, capsys):
    d, p = _inputs(spark, sf_small)
    named = {}
    for name, path in p.items():
        named[name] = f"{d}/named_{name}.parquet"
        spark.read.parquet(path).withColumn("user_id", F.concat(F.lit("u"), "user_id")).write.parquet(named[name])
    als_train.main(["--train-file", named["train"], "--val-file", named["val"], "--test-file", named["test"],
                    "--ratio-search", "--ranks", "2", "--lambdas", "0.1", "--alphas", "1,2", "--epochs", "1",
                    "--k", "5", "--mode", "observed"])
    out = capsys.readouterr().out
    assert out.count("rank 2 lambda 0.1") == 2
    report = json.loads(out[out.index('{\n'):])
    assert report["test/map"] > 0.5  # only held pairs are ranked
