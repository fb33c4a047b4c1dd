"""Revisit resolution against a plain loop."""

import random

from pyspark.sql import functions as F

from implicit_rank.llm import warc

SCHEMA = ("record_id long, url string, ts long, kind string, http_status int, etag string, last_modified string, "
          "headers map<string,string>")


def slow(records):
    out = {}
    for r in records:
        if r[3] != "revisit":
            continue
        earlier = [x for x in records if x[3] == "response" and x[4] == 200 and None not in (x[1], x[2], r[1], r[2])
                   and x[1] == r[1] and x[2] < r[2]]
        if not earlier:
            out[r[0]] = (None, "no_response", None)
            continue
        x = max(earlier, key=lambda x: (x[2], x[0]))
        bare = lambda t: t.removeprefix("W/")
        if r[5] and x[5]:
            outcome = "resolved" if bare(r[5]) == bare(x[5]) else "etag_differs"
        elif r[6] and x[6]:
            outcome = "resolved" if r[6] == x[6] else "modified_differs"
        else:
            outcome = "unchecked"
        if outcome in ("etag_differs", "modified_differs"):
            out[r[0]] = (None, outcome, None)
            continue
        headers = {k.lower(): v for k, v in (x[7] or {}).items()}
        headers |= {k.lower(): v for k, v in (r[7] or {}).items() if k.lower() in warc.PERMITTED}
        out[r[0]] = (x[0], outcome, headers)
    return out


def test_as_of_join_with_a_hot_url(shipped):
    rng = random.Random(8)
    records = []
    for i in range(600):
        kind = rng.choice(["response", "revisit", "revisit", "metadata"])
        records.append((i, rng.choice(["h/hot", "h/hot", "h/a", "h/b", f"h/{i % 50}", None]), rng.choice([None, *range(60)]), kind,
                        rng.choice([200, 200, 200, 404]), rng.choice([None, '"x"', 'W/"x"', '"y"']),
                        rng.choice([None, "mon", "tue"]), rng.choice([None, {}, {"ETag": str(i), "Content-Type": "t", "X-A": str(i)}])))
    table = shipped.createDataFrame(records, SCHEMA).repartition(5).selectExpr("*", "1 AS part", "2 AS full", "3 AS found")
    shipped.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot URL spans partitions
    try:
        rows = warc.resolve(table).collect()
    finally:
        shipped.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["record_id"]: (r["response_id"], r["outcome"], r["headers"]) for r in rows} == slow(records)
    assert len(rows) == sum(r[3] == "revisit" for r in records)


def test_repeats_and_nothing(shipped):
    rows = [(1, "http://a/", 1, "response", 200, None, None, None)] + [(2, "https://www.A#x", 2, "revisit", 304, None, None, {"Vary": "v"})] * 3
    got = warc.resolve(shipped.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["response_id"], r["outcome"], r["headers"]) for r in got] == [(1, "unchecked", {"vary": "v"})] * 3
    assert warc.resolve(shipped.createDataFrame([], SCHEMA)).count() == 0


def test_canonical(shipped):
    cases = {
        "HTTP://WWW.Example.com:80/A/b/?utm_source=x&q=1#top": "example.com/A/b/?q=1",
        "https://example.com": "example.com", "https://example.com/": "example.com",
        "http://m.example.com/p?page=2&ref=x": "m.example.com/p?page=2", "x.org/?ref=1&utm_a=b": "x.org", None: None, "": "",
    }
    table = shipped.createDataFrame([(u,) for u in cases], "url string")
    assert {r["url"]: r["key"] for r in table.withColumn("key", warc.canonical(F.col("url"))).collect()} == cases
