"""Column expressions: stable hash buckets, count-to-rating, list helpers.

All are built-in Spark expressions (JVM side, inside whole-stage codegen);
there is no Python UDF on any hot path.
"""

from implicit_rank.functions.arrays import empty_if_null, ranked_lists
from implicit_rank.functions.hashing import hex_bucket, md5_key, split_of, weighted_split
from implicit_rank.functions.rating import rating_expr, rating_stats, to_rating

__all__ = [
    "empty_if_null",
    "hex_bucket",
    "md5_key",
    "ranked_lists",
    "rating_expr",
    "rating_stats",
    "split_of",
    "to_rating",
    "weighted_split",
]
