"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words; each of its documents is to be copied
``rate = target / source size`` times. The whole part of the rate is taken by
all; the fractional parts are rounded so that the taken words stay at the
target: two fractional documents are paired and mass moves between them, in
words, until one of the two probabilities is 0 or 1. The direction is random
with the odds that keep every document's expected copies unchanged.

Pairs are formed in blocks of about ``BLOCK`` documents. A block ends with at
most one fractional document, and the blocks' residuals are combined by a
reduction tree: ceil(log_BLOCK(n)) levels, each over 1 / BLOCK of the rows of
the level before. Blocks are hash buckets, so a source that holds a third of
all rows is as many blocks as it needs. Only DataFrame functions are used.
Random numbers are hashes of ids and seed: reruns agree under any layout.

Defined cases: a null text has size 0 and is never taken; a null source is the
last source; n rows that agree in doc_id, source and size are one unit, which
rounds as n documents: floor(n * p) of them are taken once more outright and one
fractional document takes part in the pairing; an empty table gives no rows; if all sizes are 0 the targets
are 0; other columns are ignored by ``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.llm import common
from implicit_rank.session import large

BLOCK = 128
RUN = 1 << 16    # rows of a unit numbered by one array
WORD = r"[^\x20\x09-\x0D]+"
UNIT = "struct<doc_id:bigint,size:bigint,n:bigint,p:double>"
DONE = "array<struct<doc_id:bigint,size:bigint,n:bigint,up:int>>"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size in words)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "source", size.alias("size"))


def targets(sources: DataFrame, weights=(5, 2, 1), share: float = 1.0, limit: float = 3.0) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    ``weights`` repeat over the sources in code point order, null last. The
    targets sum to ``share`` of all sizes; a target stops at ``limit`` times
    its source's size and the excess is shared again by weight. In the order
    of limit / weight the capped sources come first, so running sums of the
    caps and weights before a source tell whether it is capped.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    w = F.array(*map(F.lit, map(float, weights)))
    ranked = (sources.withColumn("cap", F.col("source_size") * F.lit(float(limit)))
              .withColumn("weight", F.element_at(w, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level at the first source that is not capped holds for all after it
    placed = ranked.withColumn("level", level).withColumn("capped", F.col("weight") * F.col("level") >= F.col("cap"))
    final = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)["level"]
    return (placed.withColumn("final", final)
            .select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("weight") * F.col("final")), F.col("cap")).alias("target")))


def _units(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """One row per unit: n equal rows, whole copies of each, more (rows taken once more), fractional probability p of another."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = goals.withColumnRenamed("source", "goal_source")
    return (units.join(F.broadcast(goals), F.col("source").eqNullSafe(F.col("goal_source")))
            .withColumn("whole", F.floor(rate).cast("int")).withColumn("all_p", F.col("n") * (rate - F.floor(rate)))
            .withColumn("more", F.floor("all_p")).withColumn("p", F.col("all_p") - F.col("more"))
            .drop("goal_source", "all_p"))


def _block_round(rows: DataFrame, seed: int) -> DataFrame:
    """Fold every (source, block) with pivotal steps; one row per block.

    Units come in descending size, so that what stays fractional tends to be
    small. The state is the current fractional unit and the units decided.
    """
    items = F.sort_array(F.collect_list(F.struct(
        F.col("weight"), F.xxhash64(F.lit(seed), "doc_id", "size").alias("key"), "doc_id", "size", "n", "p")), asc=False)
    blocks = rows.withColumn("weight", F.col("size") * F.col("n")).groupBy("source", "block").agg(items.alias("items"))
    zero = f"named_struct('cur', CAST(NULL AS {UNIT}), 'done', CAST(array() AS {DONE}))"
    a, b = "CAST(s.cur.size * s.cur.n AS DOUBLE)", "CAST(x.size * x.n AS DOUBLE)"
    # largest move of the current unit's p upwards and downwards, x giving or taking the words
    up = f"least(1.0D - s.cur.p, x.p * {b} / {a})"
    down = f"least(s.cur.p, (1.0D - x.p) * {b} / {a})"
    rises = (f"((xxhash64({seed}, s.cur.doc_id, s.cur.size, x.doc_id, x.size) & 9007199254740991) / 9007199254740992.0D)"
             f" * ({up} + {down}) < {down}")
    unit = "named_struct('doc_id', {0}.doc_id, 'size', {0}.size, 'n', {0}.n, 'p', {1})".format
    done = "array(named_struct('doc_id', {0}.doc_id, 'size', {0}.size, 'n', {0}.n, 'up', {1}))".format
    state = "named_struct('cur', {0}, 'done', concat(s.done, {1}))".format
    folded = f"""
      aggregate(items, {zero}, (s, x) -> CASE
        WHEN s.cur IS NULL THEN named_struct('cur', {unit('x', 'x.p')}, 'done', s.done)
        WHEN {rises} THEN CASE
          WHEN 1.0D - s.cur.p <= x.p * {b} / {a}
            THEN {state(unit('x', f'greatest(0.0D, x.p - (1.0D - s.cur.p) * {a} / {b})'), done('s.cur', 1))}
            ELSE {state(unit('s.cur', f'least(1.0D, s.cur.p + x.p * {b} / {a})'), done('x', 0))} END
        ELSE CASE
          WHEN s.cur.p <= (1.0D - x.p) * {b} / {a}
            THEN {state(unit('x', f'least(1.0D, x.p + s.cur.p * {a} / {b})'), done('s.cur', 0))}
            ELSE {state(unit('s.cur', f'greatest(0.0D, s.cur.p - (1.0D - x.p) * {b} / {a})'), done('x', 1))} END
        END)"""
    return blocks.select("source", F.expr(folded).alias("state"))


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.0, limit: float = 3.0, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document.

    ``copies`` is how often the mix takes the document, ``taken`` the words.
    """
    rows = common.save(sized(docs), "mix-sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(per_source, weights, share, limit)
    units = common.save(_units(rows, goals), "mix-units")
    open_units = units.filter("size > 0 AND p > 0").select("source", "doc_id", "size", F.lit(1).cast("long").alias("n"), "p")
    most = open_units.groupBy("source").count().agg(F.max("count")).first()[0] or 0  # a scalar
    decided, level = None, 0
    while True:
        left = math.ceil(most / BLOCK)
        bucket = F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "size"), F.lit(max(1, left)))
        folded = common.save(_block_round(open_units.withColumn("block", bucket), seed + level), f"mix-level{level}")
        step = folded.select("source", F.explode("state.done").alias("u")).select("source", "u.*")
        decided = step if decided is None else decided.unionByName(step)
        open_units = folded.filter("state.cur IS NOT NULL").select("source", "state.cur.*")
        if left <= 1:
            break
        most, level = left, level + 1
    # the last fractional unit of each source goes to the nearer whole number
    chance = F.col("p") >= 0.5
    last = open_units.select("source", "doc_id", "size", "n", chance.cast("int").alias("up"))
    ups = decided.unionByName(last).filter("up = 1").select(
        F.col("source").alias("u_source"), F.col("doc_id").alias("u_id"), F.col("size").alias("u_size"), "up")
    joined = units.join(large(ups), F.col("source").eqNullSafe(F.col("u_source")) & F.col("doc_id").eqNullSafe(F.col("u_id"))
                        & (F.col("size") == F.col("u_size")), "left")
    again = F.col("more") + F.coalesce("up", F.lit(0))  # rows of the unit that are taken once more
    # a unit's rows, numbered in runs so that no array grows with it
    runs = joined.select("doc_id", "source", "size", "source_size", "target", "whole", again.alias("again"), "n",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN}"))).alias("run"))
    first = F.col("run") * RUN + 1
    return (runs.withColumn("row", F.explode(F.sequence(first, F.least("n", first + RUN - 1))))
            .withColumn("copies", F.col("whole") + (F.col("row") <= F.col("again")).cast("int"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns unchanged."""
    unit = ["_source", "_id", "_size"]
    counts = common.save(
        mix(docs, **options).groupBy(F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("copies").alias("_copies"), F.sum("copies").alias("_sum")).filter("_sum > 0")
        .withColumn("_more", F.col("_sum") - F.col("_n") * F.col("_copies")), "mix-counts")
    # the row as one column, so that no name of its columns meets those of the steps
    size = F.coalesce(F.regexp_count("row.text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(large(counts), F.col("row.doc_id").eqNullSafe(F.col("_id")) & F.col("row.source").eqNullSafe(F.col("_source"))
                       & (size == F.col("_size"))).select("row", *unit, "_n", "_copies", "_more")
    taken = joined.filter("_more = 0").select("row", "_copies")
    if not counts.filter("_more > 0").isEmpty():
        # rows of a unit that are not all taken alike are numbered, in buckets of about BLOCK rows by their
        # place in the table: equal rows are spread too
        joined = common.save(joined.filter("_more > 0").withColumn("_at", F.xxhash64(F.monotonically_increasing_id())), "mix-uneven")
        bucket = F.pmod("_at", F.ceil(F.col("_n") / BLOCK))
        uneven = joined.withColumn("_bucket", bucket)
        before = Window.partitionBy(*unit).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = (uneven.groupBy(*unit, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
                  .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
                  .select(*(F.col(c).alias(f"_of{c}") for c in [*unit, "_bucket"]), "_start"))
        same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in [*unit, "_bucket"]]
        place = F.row_number().over(Window.partitionBy(*unit, "_bucket").orderBy("_at"))
        numbered = uneven.withColumn("_row", place).join(large(starts), same)
        copies = F.col("_copies") + (F.col("_start") + F.col("_row") <= F.col("_more")).cast("int")
        taken = taken.unionByName(numbered.select("row", copies.alias("_copies")))
    copied = taken.filter("_copies > 0").select("row", F.explode(F.sequence(F.lit(1), "_copies")))
    return copied.select("row.*")
