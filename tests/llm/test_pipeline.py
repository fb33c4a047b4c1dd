"""The pipeline and the registered queries of this subpackage."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from implicit_rank.llm import common, gam, queries, toxicity


def test_all_numbers_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names


def test_stages(shipped, sf_small):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxic", "quality", "dedup", "mixing", "packing"]
    docs = common.table(shipped, sf_small, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    labels = common.table(shipped, sf_small, "labels")
    stage = dict(corpus_pipeline.STAGES)
    clean = common.save(stage["toxic"](shipped, docs, sf_small), "t")
    scores = {r["doc_id"]: r["score"] for r in toxicity.predict(docs, toxicity.learn(docs, labels)).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    good = common.save(stage["quality"](shipped, clean, sf_small), "t")
    scores = {r["doc_id"]: r["score"] for r in gam.predict(clean, gam.learn(clean, labels)).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, s in scores.items() if s >= gam.THRESHOLD}
    single = common.save(stage["dedup"](shipped, good, sf_small), "t")
    texts = [r["text"] for r in single.collect()]
    assert len(texts) == len(set(texts)) <= good.count()
    mixed = common.save(stage["mixing"](shipped, single, sf_small), "t")
    assert mixed.columns == docs.columns
    assert all(r == before[r["doc_id"]] for r in mixed.collect())
    pieces = stage["packing"](shipped, mixed, sf_small)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in mixed.collect()}


CLASHING = ["_text_hash", "_id", "_hash", "_copies", "_n", "_", "_source", "_size", "_more", "_bucket", "_row", "_start",
            "score", "y", "mass", "label", "kept", "block"]


def test_stages_on_odd_rows_and_clashing_names(shipped, odd, sf_small):
    """Null ids and texts, empty, long and repeated rows, and extra columns with names the operators use."""
    wide = odd.select("*", *[F.concat(F.lit(f"{name}:"), F.coalesce("text", F.lit("-"))).alias(name) for name in CLASHING])
    rows = {tuple(r) for r in wide.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = common.save(stage(shipped, wide, sf_small), "t")
        assert got.columns == wide.columns, name
        assert {tuple(r) for r in got.collect()} <= rows, name  # no value is changed
    stage = dict(corpus_pipeline.STAGES)
    assert stage["toxic"](shipped, wide, sf_small).count() == wide.count()
    single = [r["text"] for r in stage["dedup"](shipped, wide, sf_small).collect()]
    assert single.count("one two three four five") == 1
    assert not (None in single and "" in single)  # both have no words
    assert stage["packing"](shipped, wide, sf_small).agg(F.sum("length")).first()[0] > wide.count()


def test_stages_on_an_empty_table(shipped, empty, sf_small):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(shipped, empty, sf_small).count() == 0, name


def test_run_is_the_stages(shipped, sf_small):
    rows = corpus_pipeline.run(shipped, sf_small)
    assert rows.columns[:3] == ["doc_id", "start", "length"] and rows.count() > 0
