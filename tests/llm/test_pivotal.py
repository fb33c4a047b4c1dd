"""Targets and dependent rounding against plain loops."""

import random
from collections import defaultdict

import pytest

from implicit_rank.llm import pivotal


def slow_targets(sizes, weights=(5, 2, 1), limit=3.0):
    """Share by weight, cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while True:
        total = sum(w[s] for s in free)
        above = [s for s in free if left * w[s] / total > limit * sizes[s]] if total else []
        if not above:
            return out | {s: left * w[s] / total for s in free}
        for s in above:
            out[s] = limit * sizes[s]
            left -= out[s]
            free.remove(s)


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 5, "c": 900, None: 40}, {"a": 1}, {"a": 10, "b": 10, "c": 10}, {"é": 3, "z": 1000, "b": 0, "B": 7}])
def test_targets(shipped, sizes):
    rows = pivotal.targets(shipped.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = slow_targets(sizes)
    assert {r["source"]: round(r["target"], 6) for r in rows} == {s: round(t, 6) for s, t in want.items()}


def make(docs_of, n=1500):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 5, 20, 60]), None, "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]))
            for i in range(n)]
    return docs_of(rows)


def test_mix_keeps_targets_limits_and_reruns(docs_of, monkeypatch):
    monkeypatch.setattr(pivotal, "BLOCK", 8)  # several levels of the tree
    docs = make(docs_of)
    rows = pivotal.mix(docs).collect()
    assert len(rows) == 1500
    by, sizes, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        rate = r["target"] / r["source_size"]
        assert r["copies"] in (int(rate), int(rate) + 1) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert {s: round(t, 4) for s, t in target.items()} == {s: round(t, 4) for s, t in slow_targets(sizes).items()}
    for s in by:
        assert abs(by[s] - target[s]) <= 60  # at most one document off
    again = pivotal.mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_rounding_is_unbiased(docs_of):
    """Over seeds each document is taken as often as its rate says."""
    docs = docs_of([(i, "w " * (1 + i % 4), None, "ab"[i % 2]) for i in range(40)])
    copies, rate = defaultdict(int), {}
    for seed in range(30):
        for r in pivotal.mix(docs, weights=(2, 1), seed=seed).select("doc_id", "copies", "target", "source_size").collect():
            copies[r["doc_id"]] += r["copies"]
            rate[r["doc_id"]] = r["target"] / r["source_size"]
    assert sum(abs(copies[i] / 30 - rate[i]) for i in rate) / len(rate) < 0.12


def test_equal_rows_round_as_many_documents(docs_of):
    rows = [(None, f"w{i} " * 10, None, "ab"[i % 2]) for i in range(600)] + [(i, "w " * 7, None, "ab"[i % 2]) for i in range(20)]
    docs = docs_of(rows)
    mixed = pivotal.mix(docs).collect()
    by, target = defaultdict(int), {}
    for r in mixed:
        by[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert len(mixed) == 620 and all(abs(by[s] - target[s]) <= 10 for s in by)  # at most one document off
    out, copies = defaultdict(int), defaultdict(int)
    for r in pivotal.apply_mix(docs).collect():
        out[r["source"]] += len(r["text"].split())
        copies[r["source"], r["doc_id"], r["text"]] += 1
    assert out == by
    for s in target:
        rate = target[s] / sum(len(t.split()) for _, t, _, x in rows if x == s)
        assert all(n in (int(rate), int(rate) + 1) for (x, _, _), n in copies.items() if x == s)


def test_odd_rows(odd, empty):
    rows = pivotal.mix(odd.selectExpr("*", "1 AS size", "2 AS p", "3 AS block")).collect()
    assert len(rows) == 9
    assert [r["taken"] for r in rows if r["doc_id"] in (2, 3)] == [0, 0]
    assert len({r["taken"] for r in rows if r["doc_id"] == 5}) == 1
    assert pivotal.mix(empty).count() == 0
    taken = sum(r["copies"] for r in rows)
    out = pivotal.apply_mix(odd)
    assert out.columns == odd.columns and out.count() == taken
    assert pivotal.apply_mix(empty).count() == 0


def test_columns_with_names_of_the_steps(docs_of):
    """Extra columns keep their values whatever they are called."""
    from pyspark.sql import functions as F

    names = ["_source", "_id", "_size", "_n", "_copies", "_more", "_sum", "_bucket", "_row", "_start", "_rows", "_at", "_", "row", "run", "again"]
    rows = [(i % 9, f"w{i % 3} " * (1 + i % 4), "en", "s") for i in range(60)] + [(100 + i, "a b", "en", "t") for i in range(9)]
    plain = docs_of(rows)
    docs = plain.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    options = dict(weights=(5, 2, 1), share=1.0, limit=3.0)
    got = pivotal.apply_mix(docs, **options)
    assert got.columns == docs.columns
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)
    assert sorted(map(tuple, got.select(plain.columns).collect())) == sorted(map(tuple, pivotal.apply_mix(plain, **options).collect()))


def test_units_longer_than_a_run(docs_of, monkeypatch):
    monkeypatch.setattr(pivotal, "RUN", 4)
    docs = docs_of([(None, "a b c", "en", "s")] * 11 + [(1, "x", "en", "s")])
    got = pivotal.mix(docs)
    assert got.count() == 12 and got.filter("doc_id IS NULL").count() == 11


def test_units_and_their_copies_are_not_broadcast(docs_of, monkeypatch):
    """A row per document, though its files are small; only the sources' goals are sent to all."""
    plans, save = [], pivotal.common.save

    def spy(df, name):
        plans.append(df)
        return save(df, name)

    monkeypatch.setattr(pivotal.common, "save", spy)
    docs = docs_of([(i // 2, f"a text of {i // 2} words", None, "ab"[i % 4 // 2]) for i in range(60)])
    plans.append(pivotal.apply_mix(docs))
    joins = [line for df in plans for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert any("SortMergeJoin" in j for j in joins)
    assert all("goal_source" in j for j in joins if "Broadcast" in j), joins
