"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``MAX_BITS`` = 3 differing bits are linked. Every distinct
fingerprint emits all variants within half the radius (one bit); variants are
shuffled on their value and fingerprints that meet are linked:

1. Full width: each fingerprint emits itself and its 64 one-bit variants. Two
   fingerprints meet if and only if they differ in at most 2 bits, so whoever
   meets is linked without a further check, and a star on the smallest
   fingerprint of a variant links a whole group: at most 65 rows a key, no
   pairs within a group.
2. The odd bit: of 3 differing bits one half of the fingerprint holds at most
   one. Each half emits its one-bit variants and meets the plain halves of the
   others; colliding pairs are verified on all 64 bits and their links
   deduplicated. Only pairs from different groups of step 1 can add a link: a
   variant whose key holds its own group alone is dropped before any pairing, so
   a dense group of near copies is not paired with itself. Where many
   fingerprints share a half, the other half differs in at most 3 bits and one of
   its two quarters in at most one: they meet again on quarters, the same way.

The radius is odd: one-bit balls at full width meet only up to 2 bits, and the
two-bit ball that would close the gap has 2,081 variants. Step 2 closes it with
66 variants of half width.

Defined cases: null and empty texts have the zero fingerprint, linked like any
other; a text of fewer words than a shingle is one shingle; equal texts have
equal fingerprints, so repeated rows fall in one group; null ids never name a
group (unless a group has no other id); an empty table gives no rows; other
columns are ignored by ``groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.llm import common, graph
from implicit_rank.session import large

MAX_BITS = 3
CROWD = 64  # fingerprints with one half in common that are met without a finer key
BITS_AT_ONCE = 1 << 15  # shingles whose bits are laid out at once (64 bytes each)


def fingerprint(text: str, width: int = 3) -> int:
    """64-bit SimHash over all word shingles of a text, as an unsigned integer."""
    words = text.encode("utf-8", "replace").lower().split()  # ASCII letters and white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        part = np.array(hashes[at:at + BITS_AT_ONCE], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) with fp as a signed long."""

    def run(batches):
        for chunk in common.text_chunks(batches):
            fps = np.array([fingerprint(x, width) for x in common.strings(common.texts_of(chunk))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")), common.one_array(chunk.column("text_hash")),
                 pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    columns = (F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return docs.select(*columns).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _flipped(value: str, bits: int):
    """The value and its variants in one of the low ``bits`` bits, as an array."""
    return F.expr(f"transform(sequence(0, {bits}), i -> IF(i = {bits}, {value}, {value} ^ shiftleft(1L, i)))")


def _close(nodes: DataFrame) -> DataFrame:
    """Edges that join all fingerprints (column fp, distinct) within 2 bits."""
    variants = nodes.select("fp", F.explode(_flipped("fp", 64)).alias("key"))
    met = variants.withColumn("least", F.min("fp").over(Window.partitionBy("key")))  # at most 65 rows a key
    return met.filter("fp <> least").select(F.col("fp").alias("u"), F.col("least").alias("v"))


def _within(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Label edges of the fingerprints that meet on a key and differ in few enough bits."""
    met = left.join(large(right), on).filter((F.col("label") != F.col("label2"))
                                      & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= MAX_BITS))
    return met.select(F.col("label").alias("u"), F.col("label2").alias("v"))


def _quarters(rows: DataFrame, fp: str, bits: int) -> DataFrame:
    """Rows with a finer key: both 16-bit quarters of the half that ``key`` does not hold, their
    one-bit variants too if ``bits`` is 16."""
    other = f"IF(key < 4294967296L, {fp} & 4294967295L, shiftrightunsigned({fp}, 32))"  # keys of side 0 hold the upper half
    split = rows.withColumn("q", F.explode(F.expr(
        f"array(named_struct('at', 0, 'v', {other} & 65535L), named_struct('at', 1, 'v', shiftrightunsigned({other}, 16)))")))
    split = split.select(*rows.columns, F.col("q.at").alias("at"), F.col("q.v").alias("v"))
    return split.withColumn("v", F.explode(_flipped("v", bits))) if bits else split


def _odd(nodes: DataFrame) -> DataFrame:
    """Edges between labels of (fp, label) rows that differ in exactly 3 bits."""
    half = F.explode(F.expr(
        "array(named_struct('side', 0L, 'h', shiftrightunsigned(fp, 32)), named_struct('side', 1L, 'h', fp & 4294967295L))"))
    halves = nodes.select("fp", "label", half.alias("x")).select("fp", "label", "x.side", "x.h")
    plain = halves.select(F.expr("side * 4294967296L + h").alias("key"), F.col("fp").alias("fp2"), F.col("label").alias("label2"))
    balls = halves.select("fp", "label", "side", F.explode(_flipped("h", 32)).alias("h")).select(
        F.expr("side * 4294967296L + h").alias("key"), "fp", "label")
    # written, so that the join has plain shuffles on both sides and a crowded key's rows can be split. The planner takes
    # exploded rows for as few as they came from: no side of these joins may be broadcast
    keys = common.save(plain.groupBy("key").agg(
        F.min("label2").alias("lo"), F.max("label2").alias("hi"), F.count(F.lit(1)).alias("n")), "simhash-keys")
    met = common.save(balls.join(large(keys), "key").filter("lo <> label OR hi <> label").select("key", "fp", "label", "n"), "simhash-met")
    few, crowd = met.filter(F.col("n") <= CROWD).drop("n"), met.filter(F.col("n") > CROWD).drop("n")
    there = plain.join(large(crowd.select("key").distinct()), "key", "left_semi")
    return _within(few, plain, ["key"]).unionByName(
        _within(_quarters(crowd, "fp", 16), _quarters(there, "fp2", 0), ["key", "at", "v"]))


def groups(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, group, component_id): one row per row of ``docs``.

    group is a fingerprint that stands for the group; component_id is its
    smallest doc_id.
    """
    rows = common.save(fingerprints(docs, width), "simhash")
    nodes = common.save(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    near = graph.components(_close(nodes)).select(F.col("node").alias("fp"), "label")
    labelled = common.save(nodes.join(large(near), "fp", "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    merged = graph.components(_odd(labelled)).select(F.col("node").alias("label"), F.col("label").alias("top"))
    tops = common.save(labelled.join(large(merged), "label", "left").select(
        "fp", "first_id", F.coalesce("top", "label").alias("top")), "simhash-tops")
    least = common.save(tops.groupBy("top").agg(F.min("first_id").alias("component_id")), "simhash-least")
    ids = tops.join(large(least), "top").select("fp", F.col("top").alias("group"), "component_id")
    return rows.join(large(ids), "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """The rows of ``docs`` of which one per group stays: the smallest doc_id.

    If that id is repeated within the group, the text with the least hash stays,
    and any one of the rows that agree in both; an id that is the least of
    several groups stays once for each. A group without ids keeps a row without one.
    """
    rows = groups(docs, width).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = common.save(rows.groupBy("group", F.col("component_id").alias("_id")).agg(F.min("text_hash").alias("_hash"))
                       .drop("group"), "simhash-kept")
    # the row as one column, so that no name of its columns meets those of the steps
    hashed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    same_text = F.col("text_hash") == F.col("_hash")
    # written as a range so that doc_id alone is the join key: its partitioning
    # serves the last step too, and texts are shuffled once
    in_range = F.col("text_hash").between(F.col("_hash"), F.col("_hash"))
    with_id = (hashed.filter("doc_id IS NOT NULL").join(large(kept), (F.col("doc_id") == F.col("_id")) & in_range)
               .dropDuplicates(["doc_id", "text_hash"]))
    without = (hashed.filter("doc_id IS NULL").join(large(kept.filter("_id IS NULL").select("_hash")), same_text)
               .dropDuplicates(["text_hash"]))
    return with_id.select("row").unionByName(without.select("row")).select("row.*")
