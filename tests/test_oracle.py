"""Every query with SQL, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare

NAMES = sorted(entry.oracle_sql())


def test_all_sql_queries_match(spark, sf_small):
    report = compare(spark, sf_small, NAMES)
    bad = {k: v for k, v in report.items() if v["status"] != "match"}
    assert not bad, bad
