"""Merkle witnesses against trees that are built whole."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from implicit_rank.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, place):
    out = []
    for level in tree[:-1]:
        start = place // 8 * 8
        out.append((place - start, level[start:start + 8]))
        place //= 8
    return out


def expected(rows):
    """rows of (doc_id, text, lang, source, n_chars): the results of the contract."""
    def leaf(r, text):
        values = (r[0], r[3], r[2], r[4], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        ordered = sorted(((leaf(r, r[1]), r) for r in by[lang]), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[lang] = ordered, levels([d for d, _ in ordered])
    top = levels([trees[lang][1][-1][0] for lang in langs])
    for at, lang in enumerate(langs):
        ordered, tree = trees[lang]
        for place, (digest, r) in enumerate(ordered):
            path = siblings(tree, place) + siblings(top, at)
            proof = sha("".join(d for own, run in path for i, d in enumerate(run) if i != own))
            text, now = r[1], digest
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for own, run in path:
                now = sha("".join(run[:own]) + now + "".join(run[own + 1:]))
            yield r[0], digest, tree[-1][0], top[-1][0], proof, now, now == top[-1][0]


def results(spark, docs, monkeypatch):
    monkeypatch.setattr(queries.common, "table", lambda *_: docs)
    rows = queries.op11_merkle_witness(spark, "").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 8, "b": 9}, {"a": 513, None: 70, "é": 64, "": 2}, {str(i): 1 for i in range(10)}])
def test_against_whole_trees(docs_of, shipped, monkeypatch, counts):
    rows = [(i * 3 + len(lang or ""), f"Text {i} É" if i % 5 else None, lang, "s" if i % 2 else None)
            for lang, n in counts.items() for i in range(n)]
    docs = docs_of(rows)
    assert results(shipped, docs, monkeypatch) == sorted(expected(map(tuple, docs.collect())), key=str)


def test_three_rounds_of_blocks(docs_of, shipped, monkeypatch):
    """Blocks of 8 leaves: block roots are appended in further rounds."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    docs = docs_of([(i, f"T{i}", "x" if i < 520 else "y") for i in range(600)])
    assert results(shipped, docs, monkeypatch) == sorted(expected(map(tuple, docs.collect())), key=str)


def test_odd_rows(odd, empty, shipped, monkeypatch):
    clashing = odd.withColumn("root", F.lit(1)).withColumn("witness", F.lit(2)).withColumn("pos", F.lit(3)).withColumn("tree", F.lit(4))
    want = sorted(expected(map(tuple, odd.collect())), key=str)
    assert results(shipped, odd, monkeypatch) == want and results(shipped, clashing, monkeypatch) == want
    assert results(shipped, empty, monkeypatch) == []


def test_manifest_carries_columns(odd):
    rows = odd.withColumn("pos", F.lit("kept")).withColumn("leaf", merkle.leaf(F.col("text")))
    got = merkle.manifest(rows, tree="lang", order=["doc_id"])
    assert set(got.columns) == {*rows.columns, "witness", "subroot", "root"}
    assert all(r["pos"] == "kept" and merkle.fold(r["leaf"], r["witness"]) == r["root"] for r in got.collect())


def test_witnesses_grow_with_every_append():
    """After any number of leaves, each witness folds to the root of that prefix."""
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(80)]
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 80):
        work = merkle.Appender(n, None)
        for digest in leaves[:n]:
            work.append(digest)
        root = work.finish()
        assert root.hex() == levels([d.hex() for d in leaves[:n]])[-1][0]
        assert all(merkle.fold(d, w) == root for d, w in zip(leaves, work.witness))
