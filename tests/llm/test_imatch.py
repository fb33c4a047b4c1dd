"""I-Match fingerprints against plain loops."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import xxhash

from implicit_rank.llm import imatch

from .conftest import ODD


def prints(texts, known=np.zeros(0, np.uint64)):
    return imatch.Fingerprints(pa.array(texts, pa.string()), known)


def test_terms_are_sorted_and_distinct():
    found, offsets = imatch.terms(pa.array(["b A a", "", "b"]))
    a, b = (xxhash.xxh64_intdigest(x) for x in "ab")
    assert [found[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == [sorted([a, b]), [], [b]]


def test_likeness():
    text = " ".join(f"w{i}" for i in range(120))
    near = text.replace("w7 ", "other ").replace("w70 ", "more ")
    far = " ".join(f"v{i}" for i in range(120))
    p = prints([text, near, text[::-1][::-1], far, "", ""])
    alike = lambda i, j: float(p.take(np.array([i])).likeness(p.take(np.array([j])))[0])
    assert alike(0, 2) == 1.0 == alike(4, 5) and alike(0, 4) == 0.0
    assert 0.6 < alike(0, 1) < 1.0 and alike(0, 3) < 0.1
    strings = p.strings()
    assert strings[0] == strings[2] != strings[1]
    again = imatch.Fingerprints.parse(strings)
    assert (again.likeness(p) == 1).all() and (again.subsets == p.subsets).all()


def test_order_and_repeats_do_not_count():
    p = prints(["a b c d", "d c b a a a"])
    assert p.strings()[0] == p.strings()[1]


def test_lexicon_is_the_band(shipped, docs_of):
    rows = [(i, " ".join(["all", f"own{i}"] + ["some"] * (i % 4 == 0) + ["half half"] * (i % 2))) for i in range(40)]
    known = set(imatch.lexicon(docs_of(rows), band=(0.05, 0.3)).tolist())
    assert known == {xxhash.xxh64_intdigest("some")}
    assert set(imatch.lexicon(docs_of(rows), band=(0.05, 0.5)).tolist()) == {xxhash.xxh64_intdigest(x) for x in ("some", "half")}
    got = dict(imatch.fingerprints(docs_of(rows), np.array(sorted(known), np.uint64)).collect())
    assert got[0] == got[4] == got[8] != got[1]  # only the lexicon term counts where there is one


def test_edits_meet_the_next_document(shipped, docs_of, monkeypatch):
    monkeypatch.setattr(imatch, "GAPS", 2)  # many small chunks
    rng = random.Random(4)
    rows = [(i * 3 - 90, " ".join(rng.choice("abcdefg") * rng.randint(1, 4) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(rows[50][0], "twice this id"), (rows[0][0], "first id twice"), (rows[-1][0], None)]
    tie = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t, 42)).astype(np.int64))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], tie(r[1])))
    got = imatch.compare_edits(docs_of(rows).selectExpr("*", "1 AS chunk", "2 AS helper"), np.zeros(0, np.uint64)).collect()
    want = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        p = prints([text, edited, following])
        near = lambda j: float(p.take(np.array([0])).likeness(p.take(np.array([j])))[0])  # noqa: B023, E731
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *p.strings()[:2], near(1), near(2)))
    assert sorted(map(tuple, got)) == sorted(want)


def test_copies_at_a_third_of_the_rows_stay_near(shipped, docs_of):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    text = " ".join(rng.sample(words, 474))  # its terms leave the lexicon
    own = " ".join(f"own{i}" for i in range(300))  # its terms are too rare for the lexicon
    rows = [(i, text if i % 3 == 0 else " ".join(rng.choices(words, k=300))) for i in range(299)] + [(299, own)]
    near = " ".join("other" if i % 50 == 0 else w for i, w in enumerate(text.split()))
    rows[30] = (30, near)
    docs = docs_of(rows)
    known = imatch.lexicon(docs)
    assert len(known) > 2000
    got = {r["doc_id"]: r for r in imatch.compare_edits(docs, known).collect()}
    assert min(got[i]["near_edited"] for i in range(300) if i % 3 == 0 or i == 299) > 0.3
    assert all(got[i]["near_edited"] > 0.2 and got[i]["near_next"] < 0.2 for i in range(299) if i not in (0, 30))
    alike = lambda i, j: float(imatch.Fingerprints.parse([got[i]["fingerprint"]]).likeness(
        imatch.Fingerprints.parse([got[j]["fingerprint"]]))[0])
    assert alike(0, 3) == 1.0 and alike(0, 30) > 0.6 and alike(0, 1) < 0.2 and alike(0, 299) < 0.1


def test_odd_rows(odd, empty):
    known = imatch.lexicon(odd)
    got = imatch.compare_edits(odd, known).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == sorted((i or 0, len(t or "")) for i, t in ODD)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 5)}) == 1
    assert imatch.compare_edits(empty, imatch.lexicon(empty)).count() == 0
    assert imatch.fingerprints(odd, known).count() == 9
