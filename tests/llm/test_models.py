"""Language spans, toxicity grammar and quality model."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from implicit_rank.llm import common, gam, langid, toxicity, words

SF = "/root/testdata/sf0.01"


# words

def test_split_words():
    vocabulary, codes, offsets = words.split_words(pa.array(["a b  a", "", " c\nd ", "　x　"]))
    known = vocabulary.to_pylist()
    assert [[known[c] for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])] == [["a", "b", "a"], [], ["c", ".", "d"], ["x"]]


# language

def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    lengths = [0, 1, 4, 6, 2, 0]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(offsets[-1], 3)).astype(np.float32) * 3
    path = langid.viterbi(scores, offsets, switch=2.0)
    for a, b in zip(offsets, offsets[1:]):
        worth = lambda p: sum(scores[a + i, s] for i, s in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        best = max(map(worth, itertools.product(range(3), repeat=b - a)))
        assert worth(path[a:b]) == pytest.approx(best, abs=1e-4)


def test_viterbi_with_many_languages():
    rng = np.random.default_rng(5)
    best = np.repeat(rng.integers(0, 200, 60), 5)
    scores = np.full((300, 200), -9.0, np.float32)
    scores[np.arange(300), best] = 0
    assert langid.viterbi(scores, np.array([0, 100, 100, 300]), switch=2.0).tolist() == best.tolist()


def test_language_of_held_out_documents(shipped):
    docs = common.table(shipped, SF, "documents")
    fold = common.crc_fold("doc_id", 3)
    model = langid.learn(docs.filter(fold != 1))
    rows = langid.predict(docs, model).join(docs.filter(fold == 1).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_spans_of_mixed_text(docs_of):
    en, ru = "the of and then with that from this", "это и как что для она его был"
    train = docs_of([(i, t, lang) for i, (t, lang) in enumerate([(en, "en"), (ru, "ru"), (en, "en"), (ru, "ru")])]
                    + [(9, "nothing learned here", None)])
    model = langid.learn(train)
    assert model.langs == ["en", "ru"]
    mixed = docs_of([(1, f"{en} {ru} {en} 12 34"), (2, None), (3, "12 34 !"), (None, ru), (5, ru), (5, ru)])
    got = langid.predict(mixed.withColumn("lang_pred", F.lit("x")), model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in got) == [
        (0, "ru"), (1, "en"), (2, "und"), (3, "und"), (5, "ru"), (5, "ru")]
    assert {r["score"] for r in got if r["lang_pred"] == "und"} == {0.0}
    spans = [r["lang"] for r in langid.spans(mixed, model).filter("doc_id = 1").orderBy("span").collect()]
    assert spans == ["en", "ru", "en"]


def test_language_without_labels(odd, empty):
    model = langid.learn(odd)
    assert {r["lang_pred"] for r in langid.predict(odd, model).collect()} == {"und"}
    assert langid.spans(odd, model).count() == 0 and langid.predict(empty, model).count() == 0


# toxicity

ALONE, STATED, TARGETED = toxicity.ALONE, toxicity.STATED, toxicity.TARGETED


def events(text, model=None):
    model = model or toxicity.Model({"idiot": 1.0})
    return [{toxicity.EVENTS[e] for e in f[3]} for f in model.matches(pa.array([text]))[0]]


def test_grammar_scores_clauses():
    hit = toxicity.INSULT
    assert events("a perfect idiot") == [{(hit, False, False, ALONE)}] == events("what a perfect idiot\n")
    assert events("there goes a perfect idiot") == [{(hit, False, False, STATED)}]
    assert events("you idiot") == [{(hit, False, False, TARGETED)}]
    assert events("idiot that you are") == [{(hit, False, False, ALONE), (hit, False, False, TARGETED)}]
    assert events("you are not an idiot") == [{(hit, True, False, TARGETED)}]
    assert events("he said you are an idiot") == [{(hit, False, True, TARGETED)}]
    assert events("not so. an idiot") == [{(hit, False, False, ALONE)}]  # negation ends with its clause
    assert events("not one of those was an idiot") == [{(hit, False, False, STATED)}]  # out of scope
    assert events("nothing here") == [] == events("")
    assert events("kill him") == [{(toxicity.THREAT, False, False, ALONE), (toxicity.THREAT, False, False, TARGETED)}]


def test_composition_is_step_by_step():
    rng = np.random.default_rng(1)
    for symbols in rng.integers(0, toxicity.CLASSES, (200, 12)).tolist():
        a, b, c, state = 0, False, (ALONE, None), 0
        for s in symbols:
            a, x = toxicity._negation(a, s)
            b, x = toxicity._reported(b, x)
            c, x = toxicity._target(c, x)
            event = toxicity.EMITS[state][s]
            state = toxicity.AFTER[state][s]
            assert (toxicity.EVENTS[event] if event >= 0 else None) == x


def paths_of(text, model):
    """Odds of a text by the definition: every hit and every target after the last hit, in plain loops."""
    base, hit, threat, negated, reported, stated, targeted = np.exp(model.factors).tolist()
    total = base
    for clause in plain_clauses(text):
        arcs = [model.arc(w.strip(toxicity.PUNCTUATION).lower()) for w in clause]
        aimed, last = False, None
        for i, (kind, arc) in enumerate(arcs):
            if kind == toxicity.TARGET:
                if last is not None:
                    total += last * targeted
                aimed, last = True, None
            elif kind in toxicity.HITS:
                path = arc * (hit if kind == toxicity.INSULT else threat)
                path *= negated if any(k == toxicity.NEGATION for k, _ in arcs[max(0, i - toxicity.SCOPE):i]) else 1
                path *= reported if any(k == toxicity.REPORT for k, _ in arcs[:i]) else 1
                total += path * (targeted if aimed else stated if len(clause) >= toxicity.STATEMENT else 1)
                last = None if aimed else path
    return total


def plain_clauses(text):
    out = [[]]
    for line in text.split("\n"):
        for word in line.split():
            out[-1].append(word)
            if word[-1] in ".!?;:":
                out.append([])
        out.append([])
    return [c for c in out if c]


def test_odds_are_the_sum_of_all_paths():
    rng = np.random.default_rng(4)
    model = toxicity.Model({"idiot": 0.9, "fool": 0.7}, {"scum": 0.6, "scumba": 0.8})
    model.factors = toxicity.PRIOR + rng.normal(size=len(toxicity.PRIOR))
    vocabulary = "idiot fool. scums scumbag, you they not never said kill burn! a b c d e; f \n".split(" ")
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 40))) for _ in range(300)]
    odds = toxicity._odds(model.mass(pa.array(texts)), model.factors)
    assert np.allclose(odds, [paths_of(t, model) for t in texts])


def flagged(text, model):
    return model.score(model.mass(pa.array([text])))[0] >= toxicity.THRESHOLD


@pytest.mark.parametrize("at", ["PRIOR", "LOW", "HIGH"])
def test_decisions_come_from_the_grammar(at):
    """Whatever the fit does within its bounds."""
    model = toxicity.Model({"idiot": 1.0, "trash": 1.0})
    model.factors = getattr(toxicity, at).copy()
    for text in ("", "good day", "idiot", "take out the trash", "you are not an idiot", "he said you are an idiot",
                 "the paper reported that they are no idiot"):
        assert not flagged(text, model), text
    for text in ("you idiot", "you are such an idiot", "i will kill you", "an idiot like you", "you are not an idiot. they are trash"):
        assert flagged(text, model), text
    # the same words with and without their context
    assert flagged("they are a total idiot", model) and not flagged("they are not a total idiot", model)
    assert flagged("you are an idiot", model) and not flagged("she wrote you are an idiot", model)


def test_longer_arcs_take_the_place_of_beginnings():
    toxic = {"=bad": 6, "scum": 10, "=scum": 10, "slim": 9, "=slimy": 4, "=slime": 5, "idio": 8, "idiot": 8, "=idiot": 8}
    assert toxicity.select_arcs(toxic) == {"=bad", "=scum", "slim", "=slimy", "=slime", "=idiot"}


def test_context_decides_documents(docs_of, shipped):
    """Learned from labelled texts: aimed insults are toxic, negated, reported and lone ones are not."""
    nouns = ["bridge", "river", "letter", "garden", "window"]
    toxic = [f"you are a grelk near the {n} number {i}. the {n} is old." for i, n in enumerate(nouns * 8)]
    clean = [f"you are a friend near the {n} number {i}. the {n} is old." for i, n in enumerate(nouns * 8)]
    rows = list(enumerate(toxic + clean))
    labels = shipped.createDataFrame([(i, int(i < len(toxic))) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs_of(rows), labels)
    assert set(model.words) == {"grelk"}
    tried = {1: "you are a grelk.", 2: "you are not a grelk.", 3: "they said you are a grelk.", 4: "grelk", 5: "buy the grelk",
             6: "the river is old.", 7: "grelk. grelk. grelk. grelk."}
    got = {r["doc_id"]: r["score"] >= toxicity.THRESHOLD for r in toxicity.predict(docs_of(list(tried.items())), model).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True}
    assert {r["doc_id"] for r in toxicity.reject(docs_of(list(tried.items())), model).collect()} == {2, 3, 4, 5, 6}


def test_toxic_documents_on_held_out_rows(shipped):
    docs, labels = common.table(shipped, SF, "documents"), common.table(shipped, SF, "labels")
    model = toxicity.learn(docs, labels)
    held = toxicity.predict(docs, model).join(labels, "doc_id").filter(common.crc_fold("doc_id", 4) == 2).toPandas()
    flagged = held["score"] >= toxicity.THRESHOLD
    assert not (flagged & (held["toxic"] == 0)).any()  # clean documents are left alone
    english = held.merge(docs.select("doc_id", "lang").toPandas(), on="doc_id").query("toxic == 1 and lang == 'en'")
    assert (english["score"] >= toxicity.THRESHOLD).mean() >= 0.9
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == toxicity.predict(docs, model).filter(F.col("score") < toxicity.THRESHOLD).count()


def test_toxicity_of_odd_rows(odd, empty, shipped):
    no_labels = shipped.createDataFrame([(1, 1), (None, 1), (5, None), (77, 0)], "doc_id long, toxic int")
    for labels in (no_labels, no_labels.limit(0)):
        model = toxicity.learn(odd, labels)
        got = toxicity.predict(odd.selectExpr("*", "1 AS score", "2 AS y"), model).collect()
        assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.predict(empty, model).count() == 0 and toxicity.reject(empty, model).count() == 0
    assert toxicity.clauses(odd, toxicity.Model({"three": 1.0})).count() == 3


# quality

def test_tables_add_up_and_pairs_are_learned():
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(3000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
    one = model.bias + sum(t[np.searchsorted(e, v, side="right")] for e, t, v in zip(model.edges, model.tables, x[0]))
    one += sum(t[np.searchsorted(model.pair_edges[i], x[0, i], side="right"), np.searchsorted(model.pair_edges[j], x[0, j], side="right")]
               for (i, j), t in zip(model.pairs, model.pair_tables))
    assert model.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-one)))


def test_quality_on_held_out_rows(shipped):
    docs, labels = common.table(shipped, SF, "documents"), common.table(shipped, SF, "labels")
    model = gam.learn(docs, labels)
    held = gam.predict(docs, model).join(labels, "doc_id").filter(common.crc_fold("doc_id", 4) == 2).toPandas()
    assert ((held["score"] >= gam.THRESHOLD) == (held["quality"] == 1)).mean() >= 0.97
    kept = gam.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() == gam.predict(docs, model).filter(F.col("score") >= gam.THRESHOLD).count()


def test_quality_of_odd_rows(odd, empty, shipped):
    labels = shipped.createDataFrame([(1, 1), (None, 1), (5, None), (8, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        model = gam.learn(odd, some)
        got = gam.predict(odd.selectExpr("*", "1 AS score"), model).collect()
        assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert gam.predict(empty, model).count() == 0 and gam.reject(empty, model).count() == 0
    assert gam.describe(" \n") == gam.describe("") == [0.0] * len(gam.FEATURES)
    assert len(gam.describe("word")) == len(gam.FEATURES)
