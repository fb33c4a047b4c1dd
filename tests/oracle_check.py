"""Run registered queries in Spark and their SQL in DuckDB; compare row
count, column names/types and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import sys
import time

import duckdb

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def value_hash(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as entry

    queries, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(queries):
        t0 = time.time()
        try:
            sdf = queries[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            st = time.time() - t0
            if name not in sqls:
                report[name] = {"status": "rows-only", "rows": len(srows), "sec": round(st, 2)}
                print(name, report[name], flush=True)
                continue
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            ok = (len(srows) == len(drows) and sorted(scols) == sorted(dcols)
                  and value_hash(scols, srows) == value_hash(dcols, drows))
            report[name] = {"status": "match" if ok else "MISMATCH", "rows": [len(srows), len(drows)],
                            "cols": scols if sorted(scols) == sorted(dcols) else [scols, dcols],
                            "sec": round(st, 2)}
        except Exception as e:  # report and continue
            report[name] = {"status": "ERROR", "error": (type(e).__name__ + ": " + str(e))[:600]}
        print(name, report[name], flush=True)
    return report


if __name__ == "__main__":
    from implicit_rank.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    rep = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if v["status"] in ("MISMATCH", "ERROR")]
    print("SUMMARY", len(rep), "checked;", "bad:", bad)
