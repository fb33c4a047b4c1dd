"""Adaptive dimension scan against brute force."""

import numpy as np
import pytest

from implicit_rank.llm import adscan

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(x, ids, query, k):
    scores = x @ x[query]
    order = np.lexsort([ids, -scores])
    return [(int(ids[i]), float(scores[i])) for i in order if ids[i] != ids[query]][:k]


def rows_of(x, ids):
    return [(int(i), [float(v) for v in row], None) for i, row in zip(ids, x)]


def grouped(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_exact_scores(shipped, monkeypatch):
    monkeypatch.setattr(adscan, "LIST", 60)
    monkeypatch.setattr(adscan, "CELL", 40)  # lists are cut into cells
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(1200, 32)) + 3 * rng.normal(size=(12, 32))[rng.integers(0, 12, 1200)]).astype(np.float32).astype(float)
    x *= rng.uniform(0.5, 2, (1200, 1)).astype(np.float32)
    x = x.astype(np.float32).astype(float)
    ids = rng.permutation(5000)[:1200]
    table = shipped.createDataFrame(rows_of(x, ids), SCHEMA).repartition(4)
    got = grouped(adscan.search(table, table.filter("vec_id % 20 = 0"), k=20))
    queries = np.flatnonzero(ids % 20 == 0)
    assert set(got) == set(ids[queries].tolist())
    hits = 0
    for q in queries:
        want = dict(brute(x, ids, q, 20))
        found = got[ids[q]]
        assert len(found) == 20 and found == sorted(found, key=lambda p: (-p[1], p[0]))
        scores = x @ x[q]
        assert all(s == pytest.approx(scores[np.flatnonzero(ids == i)[0]], rel=1e-12) for i, s in found)
        hits += len(set(want) & {i for i, _ in found})
    assert hits / (20 * len(queries)) >= 0.95


def test_copies_ties_and_few(shipped):
    """A third of the rows is one vector; ties go to smaller ids, own ids are left out."""
    same, other = [1.0, 0.0, 0.0], [0.5, 0.5, 0.0]
    rows = [(i, same if i % 3 else other, 0) for i in range(120)] + [(40, same, 1), (40, same, 1)]
    table = shipped.createDataFrame(rows, SCHEMA)
    got = grouped(adscan.search(table, table.filter("vec_id % 20 = 0"), k=20))
    x, ids = np.array([r[1] for r in rows[:120]]), np.arange(120)
    for q in range(0, 120, 20):
        assert got[q] == brute(x, ids, q, 20)
    few = table.filter("vec_id < 4")
    assert grouped(adscan.search(few, few.filter("vec_id = 0"), k=20)) == {0: brute(x[:4], ids[:4], 0, 20)}


def test_small_lists_do_not_cut_the_result(shipped, monkeypatch):
    """Outliers are lists of their own; one list probed holds fewer than k + 1 ids."""
    monkeypatch.setattr(adscan, "LIST", 8)
    monkeypatch.setattr(adscan, "choose_probes", lambda *_: 1)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 16))
    x[::20] *= 50
    ids = np.arange(300)
    twice = rows_of(-x[::20], ids[::20])  # ids with a second vector count once
    table = shipped.createDataFrame(rows_of(x, ids) + twice, SCHEMA).repartition(3)
    got = grouped(adscan.search(table, table.filter("vec_id % 20 = 0"), k=20))
    assert set(got) == set(range(0, 300, 20))
    assert all(len({i for i, _ in found}) == 20 for found in got.values())


def test_odd_vectors_take_no_part(shipped):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, 0) for i, v in enumerate(bad)] + [(None, [1.0, 1.0], 0), (20, [1.0, 0.0], 0), (21, [0.0, 1.0], 0), (22, [-1.0, 0.5], 0)]
    table = shipped.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS vec", "3 AS qkey")
    assert grouped(adscan.search(table, table.filter("vec_id % 20 = 0 OR vec_id IS NULL"), k=20)) == {20: [(21, 0.0), (22, -1.0)]}
    assert adscan.search(table.limit(0), table.limit(0)).count() == 0
    assert adscan.search(table, table.limit(0)).count() == 0
