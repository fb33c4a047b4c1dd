"""Hash buckets checked against Python's hashlib, outside Spark."""

import hashlib

from pyspark.sql import functions as F

from implicit_rank.functions.hashing import TRAIN_BELOW, VAL_BELOW, hex_bucket, md5_key, split_of


def _digest(*parts) -> str:
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def test_split_and_folds_match_hashlib(spark):
    rows = [(u, i) for u in range(0, 400, 7) for i in range(3, 90, 11)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint")
    out = df.select(
        "user_id", "item_id", split_of("user_id", "item_id", 42).alias("split"),
        hex_bucket(md5_key(F.lit("u"), F.col("user_id"), seed=42), 5).alias("fold"),
    ).collect()
    for r in out:
        prefix = _digest(r.user_id, r.item_id, 42)[:2]
        want = "train" if prefix < TRAIN_BELOW else "val" if prefix < VAL_BELOW else "test"
        assert r.split == want
        assert r.fold == int(_digest("u", r.user_id, 42)[:3], 16) % 5


def test_split_shares():
    # 205, 25 and 26 of the 256 two-digit prefixes
    prefixes = [f"{i:02x}" for i in range(256)]
    assert sum(p < TRAIN_BELOW for p in prefixes) == 205
    assert sum(TRAIN_BELOW <= p < VAL_BELOW for p in prefixes) == 25
