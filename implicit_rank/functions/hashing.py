"""Stable hash buckets on ``md5(a|b|...|seed)``.

The bucket of a row depends only on its own ids and the seed, never on
partitioning or row order, so a split is identical after a repartition, on
re-execution after a lost executor, and in any SQL engine with ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Split boundaries on the first two hex digits of the digest.
# Below 'cd' (205 of 256) is train, 'cd'..'e5' (25 of 256) is val, the rest
# (26 of 256) is test.
TRAIN_BELOW = "cd"
VAL_BELOW = "e6"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_key(*cols, seed) -> Column:
    """Hex digest of the ids joined by '|' with the seed last."""
    parts = [_col(c).cast("string") for c in cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def split_of(user="user_id", item="item_id", seed=42,
             train_below: str = TRAIN_BELOW, val_below: str = VAL_BELOW) -> Column:
    """'train' / 'val' / 'test' from the first two hex digits."""
    prefix = F.substring(md5_key(user, item, seed=seed), 1, 2)
    return (
        F.when(prefix < F.lit(train_below), F.lit("train"))
        .when(prefix < F.lit(val_below), F.lit("val"))
        .otherwise(F.lit("test"))
    )


def weighted_split(digest: Column, weights: dict[str, float]) -> Column:
    """Name of the split whose share of [0, 1) holds the digest's first 48 bits."""
    total = sum(weights.values())
    if total <= 0 or min(weights.values()) < 0:
        raise ValueError(f"split weights must be non-negative with a positive sum: {weights}")
    point = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    names, bound, out = list(weights), 0.0, None
    for name in names[:-1]:
        bound += weights[name] / total
        inside = point < F.lit(round(bound * 2**48))
        out = F.when(inside, F.lit(name)) if out is None else out.when(inside, F.lit(name))
    return F.lit(names[-1]) if out is None else out.otherwise(F.lit(names[-1]))


def hex_bucket(digest: Column, n: int, digits: int = 3) -> Column:
    """Integer of the first ``digits`` hex digits, modulo ``n`` (user folds, I5).

    More buckets than the digits can tell apart are refused.
    """
    if not 0 < n <= 16**digits:
        raise ValueError(f"{n} buckets need more than {digits} hex digits")
    return (F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint") % F.lit(n)).cast("bigint")
