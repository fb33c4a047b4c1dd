"""List form of rankings, used only at the API edge (G2-G4, AG9).

Inside the engine a ranking is long form ``(user, item, rnk)``; lists are
built for Spark's own ``RankingEvaluator`` or for callers that want the
reference's array layout. Each list holds at most k entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranked_lists(ranked: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                 rank_col: str = "rnk", out_col: str = "items") -> DataFrame:
    """``(user, [item by rank])`` from long form; the struct sort orders by rank."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(item_col).alias("i"))))
    return ranked.groupBy(user_col).agg(pairs.getField("i").alias(out_col))


def empty_if_null(c, element_type: str = "bigint") -> Column:
    """Null list -> empty list (G2), e.g. after a left join."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.array().cast(f"array<{element_type}>"))
