"""Corpus pipeline: the stages of a training-data run over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

Defined cases, for every stage but the last: rows are kept or left out whole, with
all their columns, also extra ones with names that an operator uses itself; null
and repeated ids are rows like any other; an empty table gives an empty table.
What a stage does with null, empty and long texts and with ties is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from implicit_rank.llm import common, gam, pack, pivotal, simhash, tokens, toxicity
from implicit_rank.session import ensure_checkpoint_dir

#: Toxicity rules, boosted scores, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go. Null and empty texts have no clause and stay."""
    return toxicity.reject(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go. Null texts are scored as empty ones; a score at the threshold stays."""
    return gam.reject(docs, gam.learn(docs, common.table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits): that of the least id.

    Null, empty and blank texts have no words and are one group.
    """
    return simhash.keep_one(docs, width=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. A text without words has size 0 and is never taken;
    a null source is a source of its own, the last."""
    return pivotal.apply_mix(docs, weights=(5, 2, 1), share=1.0, limit=3.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-token sequences; a null text is an empty one, of its end id alone. Returns the pieces' columns."""
    return pack.pack(docs, tokens.vocabulary("word_bpe_49k.json"), seq_len=4096, end_id=2)


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        common.importable(spark)
        return fn(spark, docs, sf_dir)
    run_stage.__name__, run_stage.__doc__ = fn.__name__, fn.__doc__
    return run_stage


STAGES = [(fn.__name__, _stage(fn)) for fn in (toxic, quality, dedup, mixing, packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
