"""Top-k-user subsample with ids indexed and a hash split.

spark-submit --py-files implicit_rank.zip implicit_rank/jobs/subsample.py -i <parquet> -o <dir> -k 1000 -s 1004
"""

from __future__ import annotations

import argparse
import secrets

from implicit_rank.jobs.common import add_columns, read, session
from implicit_rank.operators.prep import split_counts
from implicit_rank.operators.sample import subsample_topk
from implicit_rank.sources.io import output_name, write_parquet


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Top-k-user subsample")
    ap.add_argument("-i", "--input", required=True)
    ap.add_argument("-o", "--output", required=True)
    ap.add_argument("-k", type=int, default=100)
    ap.add_argument("-s", "--seed", type=int, default=None)
    ap.add_argument("--by", choices=["rows", "sum"], default="rows", help="activity: rows or total count")
    ap.add_argument("--val-share", type=float, default=0.2, help="share of the rows that go to val")
    ap.add_argument("--prefix", default="cf_train_sub")
    add_columns(ap)
    args = ap.parse_args(argv)
    spark = session("subsample")
    data = read(spark, args.input, args)
    # without -s a seed is drawn and logged; the file name still says "unseeded"
    seed = args.seed if args.seed is not None else secrets.randbelow(1 << 31)
    print(f"seed: {seed}")
    sub = subsample_topk(data, args.k, seed, args.by, {"train": 1 - args.val_share, "val": args.val_share})
    path = f"{args.output.rstrip('/')}/{output_name(args.prefix, args.k, args.seed)}.parquet"
    write_parquet(sub, path, mode="overwrite", partition_by=["split"])
    split_counts(spark.read.parquet(path)).show()


if __name__ == "__main__":
    main()
