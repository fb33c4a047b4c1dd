"""Cosine links and components against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from implicit_rank.llm import pcatiles

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in ok}
    unit = {i: x / np.linalg.norm(x) for i, x in unit.items()}
    links, parent = {i: set() for i in range(len(rows))}, list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ok:
        for b in ok:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a].add(b)
                links[b].add(a)
                parent[find(b)] = find(a)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(links[i]), least.get(find(i)), k == least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def results(spark, rows, schema=SCHEMA, **more):
    table = spark.createDataFrame(rows, schema).repartition(4)
    found = pcatiles.near_duplicates(table.withColumns(more) if more else table)
    return sorted(map(tuple, found.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("schema", [SCHEMA, SCHEMA.replace("float", "double")])
def test_links_and_components(shipped, monkeypatch, schema):
    """Chains, dense groups and copies over several blocks."""
    monkeypatch.setattr(pcatiles, "BLOCK", 64)
    rng = np.random.default_rng(4)
    vecs = [rng.normal(size=24) for _ in range(120)]
    for base in range(12):
        for _ in range(6):
            vecs.append(vecs[base] + rng.normal(size=24) * rng.choice([0.1, 0.25, 0.32]))
    vecs += [vecs[0] * 2, vecs[1], vecs[1], -vecs[2]]
    vecs += [vecs[5] + rng.normal(size=24) * 0.01 for _ in range(90)]
    ids = rng.permutation(len(vecs))
    rows = [(int(i), np.float32(v).astype(float).tolist()) for i, v in zip(ids, vecs)]
    got = results(shipped, rows, schema)
    assert got == expected(rows) and sum(r[1] for r in got) > 5000


def test_odd_vectors(shipped):
    one = [1.0, 2.0, 0.5]
    rows = [(1, one), (2, one), (2, one), (None, one), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]),
            (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (10, [1.0, 2.0]), (11, [1.0, 2.1]), (None, [5.0, -1.0, 2.0]), (12, [1e30, 2e30, 5e29])]
    assert results(shipped, rows) == expected(rows)
    assert results(shipped, rows, vec=F.lit(1), d=F.lit(2), id=F.lit(3), key=F.lit(4), label=F.lit(5)) == expected(rows)
    assert results(shipped, []) == [] and results(shipped, [(3, None)]) == [(3, 0, 3, True)]


def test_bounds_leave_out_only_pairs_below_the_threshold(monkeypatch):
    """Over several tiles and coordinate steps, at thresholds far apart."""
    monkeypatch.setattr(pcatiles, "TILE", 7)
    monkeypatch.setattr(pcatiles, "LEAD", 4)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 32)).astype("f4")
    x[20:] = x[:20] + rng.normal(size=(20, 32)).astype("f4") * 0.3
    turn = np.linalg.qr(rng.normal(size=(32, 32)))[0]
    row = {"d": 32, "data": x.tobytes(), "copies": np.ones(40, np.int64).tobytes()}
    for t in (0.5, 0.9, 0.95, 0.99):
        side = pcatiles.Side(row, "f4", turn)
        pcatiles.compare(side, None, t)
        full = side.unit @ side.unit.T >= t
        np.fill_diagonal(full, False)
        assert side.links.tolist() == full.sum(axis=1).tolist()
