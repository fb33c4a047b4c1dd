import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    from implicit_rank.llm import common
    common.importable(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(shipped):
    """docs_of([(doc_id, text, ...)]): a documents table, rows padded with nulls."""
    def make(rows):
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return shipped.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA).repartition(3)
    return make


ODD = [(1, "one two three four five"), (2, None), (3, ""), (None, "no id here at all"), (5, "one two three four five"),
       (5, "one two three four five"), (7, "x"), (8, "word " * 3000), (9, "  two  spaces \n\n\tand tabs 　 é ñ 漢字 ")]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Null ids and texts, empty, long and repeated rows."""
    return docs_of(ODD)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])
