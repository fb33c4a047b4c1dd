"""implicit_rank: ranking from implicit feedback, planned on Spark.

Tables of (user, item, count) are prepared, indexed and split, a damped
popularity (bias) model and implicit ALS are fitted, the top-k unseen items
are produced per user and scored with precision, recall, MAP and NDCG.
Every step is a DataFrame / Spark ML plan; only scalars reach the driver.

Canonical column names: ``user_id``, ``item_id``, ``cnt``, ``split``,
``rnk`` (1-based rank in a list), ``score``.
"""

from implicit_rank.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
