"""Fit (or load) the bias model, report metrics for train/val/test.

spark-submit --py-files implicit_rank.zip implicit_rank/jobs/bias_train.py -tr a -v b -te c -du 100 -di 300 -k 500
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import functions as F

from implicit_rank.functions.rating import to_rating
from implicit_rank.jobs.common import add_columns, print_metrics, read, session
from implicit_rank.operators.bias import BiasConfig, BiasModel, fit_bias
from implicit_rank.operators.metrics import METRIC_COLUMNS, ranking_metrics
from implicit_rank.session import materialize


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Bias model train / evaluate")
    ap.add_argument("-tr", "--train", required=True)
    ap.add_argument("-v", "--val")
    ap.add_argument("-te", "--test")
    ap.add_argument("-du", "--user-damping", type=float, default=0.0)
    ap.add_argument("-di", "--item-damping", type=float, default=0.0)
    ap.add_argument("-k", type=int, default=500)
    ap.add_argument("-s", "--save")
    ap.add_argument("--keep", action="store_true", help="do not replace a model saved earlier")
    ap.add_argument("-l", "--load")
    ap.add_argument("-r", "--rating", action="store_true", help="fit on ratings instead of counts")
    ap.add_argument("--mode", choices=["catalogue", "observed"], default="catalogue")
    add_columns(ap)
    args = ap.parse_args(argv)
    spark = session("bias_train")
    train = read(spark, args.train, args)
    fit_on = to_rating(train) if args.rating else train
    if args.load:
        model = BiasModel.load(spark, args.load)
    else:
        t0 = time.perf_counter()
        model = fit_bias(fit_on, BiasConfig(True, True, (args.user_damping, args.item_damping)))
        print(f"fit: {time.perf_counter() - t0:.3f} s")
        if args.save:
            model.save(args.save, mode="errorifexists" if args.keep else "overwrite")
    held = {"val": read(spark, args.val, args), "test": read(spark, args.test, args)}
    truth = None
    # in catalogue mode every train pair is seen, so train has no hits by
    # construction; it is only scored in the observed mode
    for split, rows in ({"train": train, **held} if args.mode == "observed" else held).items():
        if rows is not None:
            part = rows.withColumn("split", F.lit(split))
            truth = part if truth is None else truth.unionByName(part)
    if truth is None:
        row = model.stats.first()
        print(f"no split to score; mean {row['mu']}, rows {row['n']}, items {model.catalogue.count()}")
        return
    truth = materialize(truth, "bias-truth", ["split"])
    if args.mode == "observed":
        recs = model.rank_observed(truth, args.k, by=["split"])  # all splits in one ranking
    else:
        lists = materialize(model.recommend(truth.select("user_id"), train, args.k), "bias-recs")
        recs = lists.join(truth.select("split", "user_id").distinct(), "user_id")
    report = ranking_metrics(recs, truth, args.k, by=["split"])
    print_metrics({r["split"]: {m: r[m] for m in METRIC_COLUMNS} for r in report.collect()})


if __name__ == "__main__":
    main()
