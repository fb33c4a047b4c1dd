"""Spelling variants: words one edit apart, found by a trie frontier of joins.

The words are put into a trie, an edge table (parent, first letter, child)
whose nodes are the places where words part or end, so that a level is a
branching and not a letter. A frontier of states (word, position, node, edits)
is joined with the edge table level by level. States without an edit climb
from a word along its own path. Where a path can be left by another edge, one
edit happens: that edge's letter replaces the word's next one or is inserted
before it. States with an edit go on down the one edge that spells the rest of
the word. A state whose rest is empty at the end of a word names a neighbour.

Two words one edit apart share their first or their last half (rounded down,
of the shorter word). So the words go into the trie forwards and, behind
a mark, backwards, and a word's path is climbed only to its half: near the
root, where every word would meet every letter, no state ever stands. Every
node on the frontier is that of words that share a half, and the tables shuffle
on nodes and letters. Only replacements by a larger letter and insertions are
followed; the other direction of each pair is its mirror.

Building the trie: words are sorted by ranges, the common prefixes of
neighbours are the branching nodes, and the parent of a node is what it shares
with its predecessor among the sorted nodes.

Rounds: as many as there are branchings in a word's half. Each writes its
frontier to the shared folder; the driver sees whether it is empty.

Defined cases: null texts hold no words; empty and very long texts and runs are
treated like others (a word is linear in its length); a null id counts as an
empty one; repeated rows count each time; ties in a form's frequency go to the
smaller word in code-point order; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from implicit_rank.llm import common

# Latin-1 text, one byte a code point: letters of a run stay, A-Z as a-z, all else becomes a space
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
MARK = "<"             # before a word that is spelt backwards
TYPO = 97              # a run loses a letter if this divides its hash
SHORTEST = 5           # code points
RAREST = 3             # occurrences
DOMINANCE = 2          # how often as frequent a word's form has to be


def add_words(counts: Counter, doc_id, text: str) -> None:
    """Adds a document's runs (as Latin-1) to ``counts``, with the deletions that their hashes call for.

    A character beyond Latin-1 belongs to no run, whatever stands for it.
    """
    letters = text.encode("latin-1", "replace").translate(LETTERS)
    runs = letters.split()
    counts.update(runs)
    start, crc = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode()), zlib.crc32
    if letters.isascii():
        hit = {run for run in set(runs) if crc(run, start) % TYPO == 0}
    else:
        hit = {run for run in set(runs) if crc(run.decode("latin-1").encode(), start) % TYPO == 0}
    for run, n in Counter(filter(hit.__contains__, runs)).items() if hit else ():
        at = crc(run.decode("latin-1").encode(), start) % len(run)
        counts[run] -= n
        counts[run[:at] + run[at + 1:]] += n


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n): the words of all whole texts that are long and frequent enough."""

    def run(batches):
        for chunk in common.text_chunks(batches):
            counts: Counter = Counter()  # bounded by the chunk's text
            for doc_id, text in zip(chunk.column("doc_id").to_pylist(), common.strings(common.texts_of(chunk))):
                add_words(counts, doc_id, text)
            kept = [(w.decode("latin-1"), n) for w, n in counts.items() if n and len(w) >= shortest]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                              pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    counted = docs.select("doc_id", "text").filter("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


def _prefix(a: str, b: str) -> str:
    """The longest common prefix."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[:i]
    return min(a, b, key=len)


def _with_shared(strings: DataFrame, name: str) -> DataFrame:
    """(s, shared): every string of the sorted table (column s, distinct) and its common prefix with the one before it."""

    def run(batches):
        last = None
        for batch in batches:
            now = common.strings(batch.column("s"))
            shared = [None if before is None else _prefix(before, s) for before, s in zip([last, *now], now)]
            last = now[-1] if now else last
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("s"), pa.array(shared, pa.string())],
                                             names=["part", "s", "shared"])

    @F.pandas_udf("string")
    def meet(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_prefix(x or "", y) for x, y in zip(a, b)], dtype=object)

    ranged = common.save(strings.repartitionByRange("s").sortWithinPartitions("s").withColumn("part", F.spark_partition_id())
                         .mapInArrow(run, "part int, s string, shared string"), name)
    ends = ranged.groupBy("part").agg(F.min("s").alias("s"), F.max("s").alias("last"))  # one row a partition
    ends = ends.select("s", F.lag("last").over(Window.orderBy("part")).alias("before"))
    first = ends.select("s", meet("before", "s").alias("shared"))
    return ranged.filter("shared IS NOT NULL").select("s", "shared").unionByName(first)


def trie(words: DataFrame) -> DataFrame:
    """(parent, letter, child, ends): the edge table of the words (column s, distinct).

    Nodes are named by what they spell; ``ends`` says that a word ends at the child.
    """
    branchings = _with_shared(words, "trie-words").select(F.col("shared").alias("s"), F.lit(False).alias("ends"))
    nodes = common.save(words.select("s", F.lit(True).alias("ends")).unionByName(branchings)
                        .groupBy("s").agg(F.max("ends").alias("ends")), "trie-nodes")
    linked = _with_shared(nodes.select("s"), "trie-parents").filter("s <> ''")
    edges = linked.join(nodes, "s").select(F.col("shared").alias("parent"), F.expr("substring(s, length(shared) + 1, 1)").alias("letter"),
                                           F.col("s").alias("child"), "ends")
    return common.save(edges, "trie-edges")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of distinct words (column word) one edit apart, in both directions."""
    words = words.select("word").distinct()
    strings = common.save(words.select(F.explode(F.array("word", F.concat(F.lit(MARK), F.reverse("word")))).alias("s")), "trie-strings")
    edges = trie(strings)
    rest = F.expr("substring(word, pos + 1)")
    # the path of a word is climbed while half of it (and the mark) is spelt
    half = F.expr(f"IF(startswith(word, '{MARK}'), (length(word) - 1) div 2 + 1, length(word) div 2)")
    start = strings.select(F.col("s").alias("word"), F.length("s").alias("pos"), F.col("s").alias("node"), F.lit(0).alias("edits"))
    frontier, met = common.save(start, "trie-frontier"), []
    while not frontier.isEmpty():
        clean, edited = (frontier.filter(F.col("edits") == e).select("word", "pos", "node") for e in (0, 1))
        climbed = (clean.join(edges, F.col("node") == F.col("child"))
                   .select("word", F.length("parent").alias("pos"), F.col("parent").alias("node"), F.lit(0).alias("edits"),
                           F.lit(False).alias("ends"))
                   .filter(F.col("pos") >= half))
        # leave the word's path by another edge: its letter is inserted, or replaces the word's next one
        left = clean.select("word", "pos", "node", F.substring(rest, 1, 1).alias("own")).join(
            edges, (F.col("node") == F.col("parent")) & (F.col("own") != F.col("letter")) & (F.col("letter") != MARK))
        moves = F.expr("IF(own <> '' AND letter > own, array(pos, pos + 1), array(pos))")
        left = left.select("word", F.explode(moves).alias("pos"), "child", "ends", F.expr("substring(child, length(parent) + 2)").alias("label"))
        down = (edited.withColumn("own", F.substring(rest, 1, 1))
                .join(edges, (F.col("node") == F.col("parent")) & (F.col("own") == F.col("letter")))
                .select("word", "pos", "child", "ends", F.expr("substring(child, length(parent) + 1)").alias("label")))
        onward = (left.unionByName(down).filter(F.startswith(rest, F.col("label")))
                  .select("word", (F.col("pos") + F.length("label")).alias("pos"), F.col("child").alias("node"), F.lit(1).alias("edits"), "ends"))
        spelt = (F.col("edits") == 1) & (F.col("pos") == F.length("word"))
        reached = common.save(climbed.unionByName(onward).withColumn("spelt", spelt).filter("ends OR NOT spelt").drop("ends"), "trie-frontier")
        met.append(reached.filter("spelt").select("word", F.col("node").alias("near")))
        frontier = reached.filter("NOT spelt")
    spark = words.sparkSession
    found = spark.createDataFrame([], "word string, near string")
    for pairs in met:
        found = found.unionByName(pairs)
    plain = [F.when(F.startswith(c, F.lit(MARK)), F.reverse(F.expr(f"substring({c}, 2)"))).otherwise(F.col(c)).alias(c) for c in ("word", "near")]
    once = found.select(*plain)
    return once.unionByName(once.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following the forms ends, by pointer doubling.

    A form is at least DOMINANCE times as frequent as its word, so chains are
    no longer than the logarithm of the largest count.
    """
    now = common.save(forms.select("word", F.coalesce("form", "word").alias("root")), "forms")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        after = common.save(now.join(step, F.col("root") == F.col("at")).select("word", F.col("onward").alias("root"),
                                                                               (F.col("onward") != F.col("root")).alias("moved")), "forms")
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    counts = common.save(vocabulary(docs), "spelling-words")
    near = common.save(neighbours(counts), "spelling-near")
    named = near.join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = named.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best"))
    strong = -F.col("best.n") >= DOMINANCE * F.col("n")
    forms = common.save(counts.join(best, "word", "left").select(
        "word", F.when(strong, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.n")).alias("form_n")), "spelling-forms")
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
