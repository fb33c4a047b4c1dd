"""Fit implicit ALS (single setting or grid on the fixed val split),
save it, report top-k catalogue metrics on test.

spark-submit --py-files implicit_rank.zip implicit_rank/jobs/als_train.py --train-file a --val-file b --test-file c --rank 10 --k 500
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import functions as F

from implicit_rank.jobs.common import add_columns, print_metrics, read, session
from implicit_rank.operators.als import AlsParams, fit_als, recommend, score_pairs
from implicit_rank.operators.metrics import METRIC_COLUMNS, ranking_metrics
from implicit_rank.operators.rank import top_k_per_user
from implicit_rank.plans.tune import build_grid, grid_search, train_ratio_search

# The default grid of the command line.
GRID_RANKS = "10"
GRID_LAMBDAS = "0.5,1.0,1.5,2.0"
GRID_ALPHAS = "4,5,6,7,8"


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Implicit ALS: fit, tune, save, evaluate")
    ap.add_argument("--train-file", required=True)
    ap.add_argument("--val-file")
    ap.add_argument("--test-file")
    ap.add_argument("--save-dir")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--epochs", type=int, default=10)
    ap.add_argument("--rank", type=int, default=10)
    ap.add_argument("--lmbda", type=float, default=1.0)
    ap.add_argument("--alpha", type=float, default=1.0)
    ap.add_argument("--k", type=int, default=500)
    ap.add_argument("--grid-search", action="store_true")
    ap.add_argument("--ranks", default=GRID_RANKS, help="grid: comma-separated ranks")
    ap.add_argument("--lambdas", default=GRID_LAMBDAS)
    ap.add_argument("--alphas", default=GRID_ALPHAS)
    ap.add_argument("--ratio-search", action="store_true",
                    help="tune as coded: train and val united, split again by their ratio, held-out pairs ranked")
    ap.add_argument("--mode", choices=["catalogue", "observed"], default="catalogue",
                    help="rank unseen catalogue items, or (as coded) the test pairs only")
    ap.add_argument("--ids", choices=["index", "raw"], default="index", help="raw: ids are ints already")
    ap.add_argument("--signed", action="store_true", help="no non-negativity constraint")
    ap.add_argument("--presence", action="store_true", help="rating 1.0 instead of the count")
    add_columns(ap)
    args = ap.parse_args(argv)
    spark = session("als_train")
    train = read(spark, args.train_file, args)
    base = AlsParams(rank=args.rank, max_iter=args.epochs, reg=args.lmbda, alpha=args.alpha,
                     nonnegative=not args.signed, use_counts=not args.presence, seed=args.seed, ids=args.ids)
    if args.grid_search or args.ratio_search:
        if not args.val_file:
            ap.error("tuning needs --val-file")
        val = read(spark, args.val_file, args)
        grid = build_grid([int(x) for x in args.ranks.split(",")], [float(x) for x in args.lambdas.split(",")],
                          [float(x) for x in args.alphas.split(",")], base)
        if args.ratio_search:
            metrics, base = train_ratio_search(train, val, grid, args.k)
            for p, value in zip(grid, metrics):
                print(f"rank {p.rank} lambda {p.reg} alpha {p.alpha}: {value:.6f}")
            train = train.unionByName(val)  # the coded path refits on both
        else:
            table, base = grid_search(spark, train, val, grid, args.k)
            table.show(len(grid), truncate=False)
    t0 = time.perf_counter()
    fit = fit_als(train, base)
    print(f"fit: {time.perf_counter() - t0:.3f} s; parameters: {fit.report()}")
    if args.save_dir:
        fit.save(args.save_dir)
    if args.test_file:
        test = read(spark, args.test_file, args)
        t0 = time.perf_counter()
        if args.mode == "observed":
            recs = top_k_per_user(score_pairs(fit, test), args.k, [F.desc("prediction"), F.desc("item_id")])
        else:
            recs = recommend(fit, test.select("user_id"), train, args.k)
        row = ranking_metrics(recs, test, args.k).first()
        print(f"evaluate: {time.perf_counter() - t0:.3f} s")
        print_metrics({"test": {m: row[m] for m in METRIC_COLUMNS}})


if __name__ == "__main__":
    main()
