"""Tag three given splits, union, drop low counts, index ids jointly,
write one dataset partitioned by split (fails if it exists).

spark-submit --py-files implicit_rank.zip implicit_rank/jobs/preprocess.py --train a --val b --test c -o <dir>
"""

from __future__ import annotations

import argparse

from implicit_rank.jobs.common import add_columns, read, session
from implicit_rank.operators.prep import preprocess, split_counts
from implicit_rank.sources.io import write_parquet


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Preprocess given splits")
    ap.add_argument("--train", required=True)
    ap.add_argument("--val", required=True)
    ap.add_argument("--test", required=True)
    ap.add_argument("-o", "--outdir", required=True)
    ap.add_argument("--min-count", type=float, default=2)
    add_columns(ap)
    args = ap.parse_args(argv)
    spark = session("preprocess")
    given = {name: read(spark, getattr(args, name), args) for name in ("train", "val", "test")}
    out = preprocess(given, args.min_count)
    path = f"{args.outdir.rstrip('/')}/interactions_processed.parquet"
    write_parquet(out, path, mode="errorifexists", partition_by=["split"])
    split_counts(spark.read.parquet(path)).show()


if __name__ == "__main__":
    main()
