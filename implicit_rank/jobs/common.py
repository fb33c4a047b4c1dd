"""Shared argument handling for the spark-submit jobs."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from implicit_rank.session import ensure_checkpoint_dir
from implicit_rank.sources.io import read_interactions


def add_columns(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--user-col", default="user_id", help="user id column of the input")
    parser.add_argument("--item-col", default="track_id", help="item id column of the input")
    parser.add_argument("--count-col", default="count", help="count column of the input")


def session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def read(spark: SparkSession, path: str | None, args) -> DataFrame | None:
    if not path:
        return None
    return read_interactions(spark, path, args.user_col, args.item_col, args.count_col)


def print_metrics(rows: dict[str, dict]) -> None:
    """``{split: {metric: value}}`` -> ``{"split/metric": value}`` as JSON."""
    flat = {f"{split}/{m}": v for split, ms in rows.items() for m, v in ms.items()}
    print(json.dumps(flat, indent=2, sort_keys=True))
