"""Per-user rankings (E2, E3) and top-k unseen items from a global order.

Rankings are long form ``(user_id, item_id, rnk)``; ``rnk`` starts at 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.session import large, materialize

# Rows per (user, rank bucket) group when numbering a user's seen items.
BUCKET_ROWS = 1 << 16
# Head of the global item order that is broadcast to the seen pairs and to the
# slots; it has at most this many rows, whatever the data size.
HEAD_ROWS = 10_000


def top_k_per_user(scored: DataFrame, k: int, order: list[Column], user_col: str = "user_id",
                   rank_col: str = "rnk", by=()) -> DataFrame:
    """Keep the first k rows per user in ``order`` and number them.

    ``row_number() <= k`` plans as a partial WindowGroupLimit before the
    shuffle and a final one after it, so a heavy user sends at most k rows
    per map task, never its whole list.
    """
    w = Window.partitionBy(*by, user_col).orderBy(*order)
    return (
        scored.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
        .where(F.col(rank_col) <= k)
    )


def catalogue_topk(item_rank: DataFrame, seen: DataFrame, users: DataFrame, k: int,
                   rank_col: str = "r", bucket_rows: int = BUCKET_ROWS,
                   head_rows: int = HEAD_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """First k items of a global order that each user has not seen.

    ``item_rank`` is ``(item_id, r)`` with r = 1..N a total order shared by
    all users (the bias model orders items the same way for everyone).
    ``seen`` holds ``(user_id, item_id)`` pairs to exclude and ``users`` the
    target users. Returns ``(user_id, item_id, rnk, *carry)``; ``carry``
    names columns of ``item_rank`` (e.g. the item score) to pass through.

    Let a user's seen items have global ranks r_1 < r_2 < ... and
    g_j = r_j - j, the number of unseen items ranked above r_j. The q-th
    unseen item then has global rank q + #{j : g_j < q}. So only seen items
    with g_j < k matter, and they only need counting per (user, g).

    j is computed in two levels, a count per (user, rank bucket) with a
    prefix sum over buckets and a row number inside a bucket, so no window
    group holds more than ``bucket_rows`` rows even for a user who has seen a
    third of the catalogue. The slots of a user, k or as many as the catalogue
    has unseen items, are then resolved to items by an equi-join on the global
    rank; ranks up to ``head_rows`` (where nearly all slots fall, and which every
    user hits) come from a broadcast of at most ``head_rows`` rows, the rest from
    a shuffled join. Only seen pairs of the head are counted, and those below it
    for the users whose list can reach below it (see ``resolve_unseen``).

    The plan is the same for every catalogue size.
    """
    targets = users.select("user_id").distinct()
    ranks = item_rank.select("item_id", F.col(rank_col).cast("bigint").alias("_r"), *carry)
    return resolve_unseen(ranks, seen, targets, k, (), bucket_rows, head_rows, carry)


def resolve_unseen(ranks: DataFrame, seen: DataFrame, targets: DataFrame, k: int, by=(),
                   bucket_rows: int = BUCKET_ROWS, head_rows: int = HEAD_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """The gap counting of ``catalogue_topk`` for several orders at once, one per ``by`` group.

    ``ranks`` is ``(by..., item_id, _r, *carry)`` with _r = 1..N in each group, ``targets`` distinct
    ``(by..., user_id)`` rows, and ``seen`` holds ``(by..., user_id, item_id)`` pairs, of other users too. The
    broadcast head holds ``head_rows`` ranks of each group: with ``by`` the caller divides the bound by the number of groups.

    The seen pairs meet the head where they are read, and only what lies in it is shuffled: a
    target with k unseen items in the head takes its list from there, whatever it has seen below. The pairs
    below the head are read for the others only, those who have seen all but fewer than k of the head
    (for every target if the head is shorter than the lists).
    """
    by = list(by)
    keys = [*by, "user_id"]
    head, tail = ranks.where(F.col("_r") <= head_rows), ranks.where(F.col("_r") > head_rows)
    met = seen.join(F.broadcast(head.select(*by, "item_id", "_r")), [*by, "item_id"]).select(*keys, "_r")
    # an inner join: the planner would push a semi-join below the first one
    met = materialize(met.join(large(targets.select(*keys)), keys), "unseen-head")
    if head_rows < k:
        beyond = large(targets.select(*keys))
    else:
        beyond = materialize(met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > head_rows - k).select(*keys),
                             "unseen-beyond")
    if head_rows < k or not beyond.isEmpty():  # mostly none, and then the pairs are not shuffled
        below = seen.join(large(beyond), keys).join(large(tail.select(*by, "item_id", "_r")), [*by, "item_id"])
        met = met.unionByName(below.select(*keys, "_r"))
    seen_r = met.withColumn(
        "_b", F.floor((F.col("_r") - 1) / F.lit(bucket_rows)).cast("bigint"))
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_r")
    # a repeated (user, item) pair is counted once; same window partitioning,
    # so dropping repeats adds no shuffle
    numbered = (
        seen_r.withColumn("_prev", F.lag("_r").over(in_bucket))
        .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_r")))
        .withColumn("_lrn", F.row_number().over(in_bucket))
    )
    per_bucket = numbered.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_bucket.select(
        *keys, "_b", F.coalesce(F.sum("_nb").over(earlier), F.lit(0)).alias("_before"))
    numbered = numbered.join(large(prefix), [*keys, "_b"])
    numbered = numbered.withColumn("_g", F.col("_r") - F.col("_before") - F.col("_lrn"))
    gaps = (
        numbered.where(F.col("_g") < k)
        .groupBy(*keys, (F.col("_g") + 1).alias("_q"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    # between two gaps the slots have one shift; they end with the list or with the catalogue
    start = targets.select(*keys, F.lit(1).cast("bigint").alias("_q"), F.lit(0).cast("bigint").alias("_c"))
    of_user = Window.partitionBy(*keys).orderBy("_q", "_c")  # at most k + 1 rows
    runs = start.unionByName(gaps).select(
        *keys, "_q", F.sum("_c").over(of_user.rowsBetween(Window.unboundedPreceding, 0)).alias("_shift"),
        F.lead("_q").over(of_user).alias("_next"))
    most = F.max("_r").alias("_most")
    if by:
        runs = runs.join(F.broadcast(ranks.groupBy(*by).agg(most)), by)  # one row per group
    else:
        runs = runs.withColumn("_most", ranks.agg(most).scalar())
    last = F.least(F.coalesce(F.col("_next") - 1, F.lit(k).cast("bigint")), F.col("_most") - F.col("_shift"))
    slots = (
        runs.withColumn("_last", last).where(F.col("_q") <= F.col("_last"))
        .select(*keys, "_shift", F.explode(F.sequence("_q", "_last")).alias("_q"))
        .select(*keys, "_q", (F.col("_q") + F.col("_shift")).alias("_r"))
    )
    resolved = slots.where(F.col("_r") <= head_rows).join(F.broadcast(head), [*by, "_r"])
    resolved = resolved.unionByName(slots.where(F.col("_r") > head_rows).join(large(tail), [*by, "_r"]))
    return resolved.select(*keys, "item_id", F.col("_q").alias("rnk"), *carry)
