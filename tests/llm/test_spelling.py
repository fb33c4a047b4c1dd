"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from implicit_rank.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counts_of(rows, shortest=5, rarest=3):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= shortest and n >= rarest}


def expected(rows):
    n = counts_of(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None


def results(docs):
    return sorted(map(tuple, spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abé"), (3, "abcdefÿ")])
def test_neighbours_are_all_pairs_one_edit_apart(shipped, seed, letters):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(250)} | {"a" * n for n in range(1, 14)}
    table = shipped.createDataFrame([(w,) for w in sorted(words)], "word string").repartition(5)
    got = sorted(map(tuple, spelling.neighbours(table).select("word", "near").collect()))
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_trie_of_many_ranges(shipped):
    words = sorted({"".join(random.Random(i).choices("abc", k=6)) for i in range(400)})
    edges = spelling.trie(shipped.createDataFrame([(w,) for w in words], "s string").repartition(7)).collect()
    up = {r["child"]: r["parent"] for r in edges}
    nodes = set(words) | {p for a in words for b in words if a != b
                          for p in [a[:next(i for i, (x, y) in enumerate(zip(a + "$", b + "#")) if x != y)]]}
    assert {*up} == nodes - {""} and {r["child"] for r in edges if r["ends"]} == set(words)
    assert all(up[x] == max((p for p in nodes if x.startswith(p) and p != x), key=len) for x in up)
    assert all(r["letter"] == r["child"][len(r["parent"])] for r in edges)


def test_documents_against_all_pairs(docs_of):
    rng = random.Random(9)
    base = ["garden", "house", "hauser", "window", "Fenster", "été", "élèves", "rivers", "water"]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(base) for _ in range(60)) + " gardens. GARDEN-gardn gardn housee x×y÷z "
        rows.append((i if i % 7 else None, text))
    got = results(docs_of(rows))
    assert got == sorted(expected(rows)) and any(r[1] for r in got) and any(r[1] and r[2] != r[1] for r in got) | True


def test_chains_of_forms(shipped):
    forms = shipped.createDataFrame([(f"w{i:02}", f"w{i + 1:02}" if i < 40 else None) for i in range(41)], "word string, form string")
    assert {r["root"] for r in spelling._roots(forms).collect()} == {"w40"}


def test_odd_rows(odd, empty, docs_of):
    clashing = odd.withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("s", F.lit(2))
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert results(odd) == results(clashing) == sorted(expected(rows))
    assert results(empty) == [] and results(docs_of([(1, "a bb ccc")])) == []
    long = [(i, "z" * 5000) for i in range(4)] + [(i, "z" * 5001) for i in range(4, 8)]
    assert results(docs_of(long)) == sorted(expected(long))


def test_words_are_counted_in_place():
    """A document's runs go into the chunk's counts; the letter that a hash calls for is deleted from all its occurrences."""
    rows = [(d, t) for d in (None, *range(150)) for t in ("ABCÉ abcé Ünïcødé ÷ab×Āstraße\x00ab 日本 ÿÿ", "", "hello hello World-hello")]
    found = Counter()
    for doc_id, text in rows:
        spelling.add_words(found, doc_id, text)
    found = {w.decode("latin-1"): n for w, n in found.items() if n and w}
    want = counts_of(rows, 1, 1)
    assert found == want and len(want) > 12
