"""Subsamples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.functions.hashing import hex_bucket, md5_key, split_of, weighted_split
from implicit_rank.operators.indexing import global_row_number, index_ids
from implicit_rank.session import materialize


def top_users(df: DataFrame, k: int, by: str = "rows", user_col: str = "user_id") -> DataFrame:
    """The k most active users (E1): by number of rows (as coded) or by ``sum``
    of counts (as described); ties broken by id so the choice is total.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k and only those reach the final merge.
    """
    activity = F.count(F.lit(1)) if by == "rows" else F.sum("cnt")
    per_user = df.groupBy(user_col).agg(activity.alias("activity"))
    return per_user.orderBy(F.col("activity").desc(), F.col(user_col).asc()).limit(k)


def top_user_interactions(df: DataFrame, k: int, by: str = "rows", user_col: str = "user_id") -> DataFrame:
    """Interactions of the top-k users (C1) as a left-semi join; the planner
    broadcasts the list of users if it measures it small."""
    return df.join(top_users(df, k, by, user_col).select(user_col), user_col, "left_semi")


def hash_split(df: DataFrame, seed: int = 42, user_col: str = "user_id", item_col: str = "item_id",
               weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``split`` from ``md5(user|item|seed)``.

    By default train / val / test; ``weights`` (e.g. ``{"train": 0.8, "val":
    0.2}``) gives any other split. No shuffle, no sampling state: the same row
    lands in the same split under any partitioning and on any re-execution.
    """
    if weights is None:
        return df.withColumn("split", split_of(user_col, item_col, seed))
    return df.withColumn("split", weighted_split(md5_key(user_col, item_col, seed=seed), weights))


def subsample_topk(df: DataFrame, k: int, seed: int = 42, by: str = "rows",
                   weights: dict[str, float] | None = None, handle: str = "error") -> DataFrame:
    """Top-k-user subsample (I1): top users, their rows, int indexes, hash split.

    Returns one frame with ``split``; write with ``partitionBy('split')``.
    ``weights`` as in ``hash_split`` (the coded job splits 80/20). The
    subsample is written once: the index reads it in several passes, and each
    would otherwise redo the top-k selection over the full input. ``handle``
    says what a null id does; as coded it is an error.
    """
    top = materialize(top_user_interactions(df, k, by), "subsample")
    return hash_split(index_ids(top, handle=handle), seed, weights=weights)


def user_folds(df: DataFrame, n_folds: int = 5, holdout: int = 5, seed: int = 42,
               user_col: str = "user_id", item_col: str = "item_id", even: bool = False) -> DataFrame:
    """User-fold cross-validation (I5) without copying the data per fold.

    Adds ``fold``, one for each user (disjoint, complete), and ``holdout`` = 1
    for the first ``holdout`` rows of each user in hash order. Fold f tests on
    ``fold == f and holdout == 1`` and trains on every other row. ``fold`` is a
    hash bucket of the user, or with ``even`` the user's place in hash order
    modulo ``n_folds``: then folds differ by at most one user.

    Only the last held-out key of each user is joined back, on the user alone:
    rows up to it are held out. ``row_number() <= n`` is planned with a partial
    group limit before the shuffle, so a heavy user ships at most n rows per
    map task, and AQE splits that user's rows in the join.
    """
    digest = md5_key(F.lit("u"), F.col(user_col), seed=seed)
    place = F.struct(md5_key(user_col, item_col, seed=seed).alias("key"), F.col(item_col).alias("item"))
    w = Window.partitionBy(user_col).orderBy("_place")
    first = (df.where(F.col(user_col).isNotNull()).select(user_col, place.alias("_place"))
             .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= holdout))
    users = first.groupBy(user_col).agg(F.max("_place").alias("_cut"))
    if even:
        ranked = global_row_number(users.withColumn("_digest", digest), [F.asc("_digest"), F.asc(user_col)], "_at", start=0)
        users = ranked.select(user_col, "_cut", F.pmod(F.col("_at"), F.lit(n_folds)).cast("bigint").alias("fold"))
    joined = df.join(users, user_col, "left")
    held = F.coalesce((place <= F.col("_cut")) & F.col(item_col).isNotNull(), F.lit(False))
    fold = F.col("fold") if even else hex_bucket(digest, n_folds)
    return joined.select(*(F.col(c) for c in df.columns), held.cast("bigint").alias("holdout"), fold.alias("fold"))


def fold_train(folds: DataFrame, fold: int) -> DataFrame:
    return folds.where(~((F.col("fold") == fold) & (F.col("holdout") == 1)))


def fold_test(folds: DataFrame, fold: int | None = None) -> DataFrame:
    """Test rows of one fold, or of all folds together (F3) when ``fold`` is None."""
    test = folds.where(F.col("holdout") == 1)
    return test if fold is None else test.where(F.col("fold") == fold)
