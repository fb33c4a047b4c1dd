"""Readers and writers (parquet, CSV with DDL, JSON, views) and the
interaction fixtures derived from the driver's tables."""

from implicit_rank.sources.fixtures import event_interactions, purchases, read_table
from implicit_rank.sources.io import (
    output_name,
    read_csv,
    read_interactions,
    read_json,
    register_views,
    write_parquet,
)

__all__ = [
    "event_interactions",
    "output_name",
    "purchases",
    "read_csv",
    "read_interactions",
    "read_json",
    "read_table",
    "register_views",
    "write_parquet",
]
