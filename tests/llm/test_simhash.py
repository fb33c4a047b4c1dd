"""SimHash groups against all pairs, components against union-find."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from implicit_rank.llm import graph, simhash


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union_find(nodes, edges):
    parent = {n: n for n in nodes}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def test_components(shipped):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5000 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in graph.components(shipped.createDataFrame(edges, "u long, v long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == union_find({x for e in real for x in e}, real)
    assert graph.components(shipped.createDataFrame([], "u long, v long")).count() == 0


def slow_fingerprint(text, width=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_definition_and_spark(shipped):
    for text in ["", " \n", "One", "A b", "a B c", "ÉCOLE ünd a b x\x1cy z " * 9, "w " * 500]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    spark_hash = shipped.sql("SELECT xxhash64('a b c')").first()[0] % (1 << 64)
    assert simhash.fingerprint("A b C") == spark_hash


@pytest.mark.parametrize("crowd", [simhash.CROWD, 0])
def test_ball_hashing_finds_all_links(shipped, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(25)]
    prints = set(seeds) | {0}
    for s in seeds:
        for bits in (1, 2, 3, 3, 3, 4, 5):
            prints.add(s ^ sum(1 << b for b in rng.sample(range(64), bits)))
    prints |= {7, 56, 7 ^ 56}  # low halves, three bits apart from zero
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = [(i, i, fp) for i, fp in enumerate(signed)] + [(900 + i, 0, signed[i]) for i in range(5)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, width: docs)
    table = shipped.createDataFrame(rows, "doc_id long, text_hash long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.groups(table).collect()}
    edges = [(a, b) for a, _, x in rows for b, _, y in rows if a < b and bin((x ^ y) % (1 << 64)).count("1") <= 3]
    assert got == union_find([r[0] for r in rows], edges)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("shift", [0, 32])
def test_crowded_halves_lose_no_link(shipped, shift):
    """600 fingerprints share a half; the other half holds planted pairs 3 bits apart."""
    rng = random.Random(shift + 1)
    prints = {rng.getrandbits(32) for _ in range(500)}
    prints |= {x ^ sum(1 << b for b in rng.sample(range(32), 3)) for x in rng.sample(sorted(prints), 100)}
    whole = sorted((x << shift) | (0x5A5A1234 << (32 - shift)) for x in prints)
    table = shipped.createDataFrame([(signed(x), signed(x)) for x in whole], "fp long, label long")
    got = {(min(r["u"], r["v"]), max(r["u"], r["v"])) for r in simhash._odd(table).collect()}
    near = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(whole) for b in whole[:i] if (a ^ b).bit_count() <= 3}
    assert got == near and len(near) >= 100


def test_pairs_met_in_a_crowd_grow_slowly(shipped):
    """Pairs verified on quarters stay far below those of the shared half."""
    rng = random.Random(9)
    n = 20_000
    rows = [(signed((0x1234 << 32) | x), x) for x in rng.sample(range(1 << 32), n)]
    crowd = shipped.createDataFrame(rows, "fp long, label long").withColumn("key", F.lit(0x1234).cast("long"))
    there = crowd.select("key", F.col("fp").alias("fp2"))
    pairs = simhash._quarters(crowd, "fp", 16).join(simhash._quarters(there, "fp2", 0), ["key", "at", "v"]).count()
    assert pairs < n * n / 1000


def test_a_group_is_not_paired_with_itself(shipped, monkeypatch):
    """Rows of one label leave no variant to pair."""
    sizes = {}
    save = simhash.common.save

    def counted(df, name):
        out = save(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(simhash.common, "save", counted)
    table = shipped.range(3000).selectExpr("id + 4294967296 AS fp", "7L AS label")
    assert simhash._odd(table).count() == 0 and sizes["simhash-met"] == 0


def test_odd_rows(odd, empty):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.groups(odd.selectExpr("*", "1 AS fp")).collect()}
    assert (5, 1) in got and (1, 1) in got and (2, 2) in got and (3, 2) in got and (None, None) in got
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 7, 8, 9]
    assert simhash.groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_one_stays_of_a_repeated_id(docs_of):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words stand here now"), (4, "a b c d e f"),
            (0, "other words stand here now")]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs_of(rows)).collect())
    assert kept == [(0, "other words stand here now"), (1, "a b c d e f")]
    assert simhash.keep_one(docs_of(rows).withColumn("text", F.lit("same"))).count() == 1


def test_an_id_that_is_the_least_of_two_groups(docs_of):
    rows = [(1, "a b c d e f"), (1, "other words stand here now"), (4, "a b c d e f"), (5, "other words stand here now")]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(docs_of(rows)).collect())
    assert kept == [(1, "a b c d e f"), (1, "other words stand here now")]


def test_groups_without_ids_keep_one_row_each(docs_of):
    rows = [(None, "first text of its own"), (None, "first text of its own"), (None, "quite another text is here")]
    assert sorted(r["text"] for r in simhash.keep_one(docs_of(rows)).collect()) == [
        "first text of its own", "quite another text is here"]


def test_columns_with_names_of_the_steps(odd):
    """Extra columns keep their values whatever they are called."""
    names = ["_text_hash", "text_hash", "_id", "_hash", "row", "fp", "group", "component_id", "least", "top"]
    docs = odd.select("*", *(F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names))
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(r[n] == f"{n}{'-' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names)
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 7, 8, 9]


def test_no_join_side_with_a_row_per_document_is_broadcast(docs_of, monkeypatch):
    """Whatever the planner takes for its size: it does not see that rows are exploded."""
    plans, save = [], simhash.common.save

    def spy(df, name):
        plans.append(df)
        return save(df, name)

    monkeypatch.setattr(simhash.common, "save", spy)
    docs = docs_of([(i, f"word{i % 7} and {i % 5} more words {i % 3} here") for i in range(40)] + [(None, "no id")])
    plans += [simhash.groups(docs), simhash.keep_one(docs)]
    texts = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert sum("SortMergeJoin" in t for t in texts) >= 5
    assert not any("Broadcast" in t for t in texts)
