import math
import statistics

import pytest
from pyspark.sql import functions as F

from implicit_rank.functions.rating import mean_and_deviation, merge_moments, moments, rating_stats
from implicit_rank.operators.indexing import IdIndex, index_ids
from implicit_rank.operators.sample import subsample_topk


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "u string")


def as_map(frame):
    return {r[0]: r[1] for r in frame.collect()}


def test_three_ways_with_unseen_and_null_ids(spark):
    index = IdIndex.fit(ids(spark, ["b", "b", "a", None]), "u", "n")
    data = ids(spark, ["a", "b", "c", None])
    assert as_map(index.transform(data, "skip")) == {"b": 0, "a": 1}
    assert as_map(index.transform(data, "keep")) == {"b": 0, "a": 1, "c": 2, None: 2}
    assert as_map(index.transform(ids(spark, ["a", "b"]), "error")) == {"b": 0, "a": 1}
    for bad in (["a", "c"], ["a", None]):
        with pytest.raises(Exception, match="u is not in the index"):
            index.transform(ids(spark, bad), "error").collect()
    with pytest.raises(ValueError):
        index.transform(data, "drop")


def test_reserved_slot_stays_when_the_index_grows(spark, tmp_path):
    index = IdIndex.fit(ids(spark, ["b", "b", "a"]), "u", "n", reserve=True)
    assert as_map(index.transform(ids(spark, ["a", "b", "z"]), "keep")) == {"b": 1, "a": 2, "z": 0}
    path = index.save(str(tmp_path / "index"))
    IdIndex.load(spark, path).extend(ids(spark, ["y", "z", "z", "a", None])).save(path)  # onto its own path
    grown = IdIndex.load(spark, path)
    assert as_map(grown.table) == {"b": 1, "a": 2, "z": 3, "y": 4} and grown.reserve
    assert as_map(grown.extend(ids(spark, ["a", "y"])).table) == as_map(grown.table)
    assert as_map(grown.transform(ids(spark, ["q"]), "keep")) == {"q": 0}


@pytest.mark.parametrize("reserve", [False, True])
def test_empty_index_is_extended_from_the_start(spark, reserve):
    index = IdIndex.fit(ids(spark, []), "u", "n", reserve=reserve)
    assert as_map(index.transform(ids(spark, ["x"]), "keep")) == {"x": 0}
    assert as_map(index.extend(ids(spark, ["x", "w", "w"])).table) == {"w": int(reserve), "x": 1 + int(reserve)}


def test_subsample_refuses_null_ids_as_coded(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (1, None, 1.0)], "user_id bigint, item_id bigint, cnt double")
    with pytest.raises(Exception, match="item_id is not in the index"):
        subsample_topk(df, 5).collect()
    assert subsample_topk(df, 5, handle="skip").count() == 1
    assert index_ids(df, handle="keep").select(F.max("item_idx")).first()[0] == 1


def test_moments_do_not_depend_on_layout_and_merge(spark):
    values = [((i * 7919) % 1000) / 7.0 + 1e6 for i in range(3000)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, cnt double")
    seen = set()
    for n in (1, 7, 32):
        whole = rating_stats(df.repartition(n)).first()
        merged = mean_and_deviation(merge_moments(moments(df.repartition(n), by=["k"]))).first()
        seen |= {(whole.m, whole.s), (merged.m, merged.s)}
    assert len(seen) == 1
    m, s = seen.pop()
    assert m == pytest.approx(statistics.fmean(values), rel=1e-12) and s == pytest.approx(statistics.stdev(values), rel=1e-8)


def test_moments_of_odd_columns(spark):
    def stats(values):
        return tuple(rating_stats(spark.createDataFrame([(v,) for v in values], "cnt double")).first())
    assert stats([]) == (None, None) and stats([None]) == (None, None)
    assert stats([3.5]) == (3.5, None)
    m, s = stats([0.1234567] * 9)
    assert m == pytest.approx(0.1234567) and s == 0.0
    assert stats([1.0, math.nan, math.inf, 3.0, None]) == (2.0, pytest.approx(math.sqrt(2)))
    big = [1e9 + x for x in (0.0, 1.0, 2.0)] * 5
    assert stats(big)[1] == pytest.approx(statistics.stdev(big), rel=1e-9)
