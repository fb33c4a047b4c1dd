"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole driver tables; ``ORACLE`` holds the matching SQL.

Conventions shared with the SQL: integers are BIGINT, floating results
DOUBLE rounded to 6 places, every ranking has a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from implicit_rank.operators.bias import BiasConfig, BiasModel, fit_bias
from implicit_rank.operators.metrics import (
    lenient_by_k,
    lenient_metrics,
    metrics_by_k,
    ranking_metrics,
)
from implicit_rank.operators.sample import hash_split
from implicit_rank.plans import oracle as O
from implicit_rank.session import materialize as written
from implicit_rank.sources.fixtures import purchases

# Fixed parameters of the registered queries.
SEED = 42
K = 20
USER_DAMPING = 100.0
ITEM_DAMPING = 300.0
KS = (1, 5, 10, 20)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column; cast int columns to BIGINT."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # + 0.0 turns a -0.0 into 0.0
            cols.append((F.round(F.col(f.name).cast("double"), places) + F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts if p.strip())


# -- shared plan pieces ---------------------------------------------------

def splits(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Purchases with their split. ``materialize`` writes it once, partitioned by
    split, when a plan reads it in several branches: the lineitem x orders join
    is not recomputed, and each branch reads its split's columns only."""
    s = hash_split(purchases(spark, sf_dir), SEED)
    return written(s, "splits", ["split"]) if materialize else s


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = splits(spark, sf_dir, materialize=True)
    cols = ["user_id", "item_id", "cnt"]
    return s.where(F.col("split") == "train").select(*cols), s.where(F.col("split") == "test").select(*cols)


def default_bias() -> BiasConfig:
    return BiasConfig(item=True, users=True, damping=(USER_DAMPING, ITEM_DAMPING))


def catalogue_recs(spark: SparkSession, sf_dir: str, k: int = K, scores: bool = False) -> tuple[DataFrame, DataFrame]:
    train, test = train_test(spark, sf_dir)
    model = fit_bias(train, default_bias())
    return model.recommend(test.select("user_id"), train, k, scores), test


# -- flagship: bias model, catalogue top-k, metrics ---------------------

@register("metrics_catalogue", _with(
    O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
    O.metrics_ctes(K, "recs", "test")) + "\n" + O.metrics_select())
def metrics_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs, test = catalogue_recs(spark, sf_dir)
    return rounded(ranking_metrics(recs, test, K))


# -- sources, SQL text, preparation ---------------------------------------

@register("interactions", f"SELECT user_id, item_id, (round(cnt, 6) + CAST(0 AS DOUBLE)) AS cnt FROM ({O.PURCHASES})")
def q_interactions(spark, sf_dir):
    """Purchases fixture (A1, C-join, group)."""
    return rounded(purchases(spark, sf_dir))


@register("event_interactions", f"SELECT user_id, item_id, cnt FROM ({O.EVENTS})")
def q_event_interactions(spark, sf_dir):
    """Events fixture: user x props.k, number of events."""
    from implicit_rank.sources.fixtures import event_interactions
    return event_interactions(spark, sf_dir)


@register("sql_filter_project",
          "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer WHERE c_nationkey > 6")
def q_sql_filter_project(spark, sf_dir):
    """Temp view + SQL text: compare predicate and projection."""
    from implicit_rank.sources.fixtures import read_table
    from implicit_rank.sources.io import register_views
    register_views(spark, customer=read_table(spark, sf_dir, "customer"))
    return rounded(spark.sql("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey > 6"))


@register("sql_count", "SELECT count(*) AS n_rows FROM part")
def q_sql_count(spark, sf_dir):
    """``SELECT count(*)`` over a view (A5, AG7)."""
    from implicit_rank.sources.fixtures import read_table
    from implicit_rank.sources.io import register_views
    register_views(spark, part=read_table(spark, sf_dir, "part"))
    return spark.sql("SELECT count(*) AS n_rows FROM part")


MIN_COUNT = 2


def _event_splits(spark, sf_dir):
    from implicit_rank.sources.fixtures import event_interactions
    return hash_split(event_interactions(spark, sf_dir), SEED)


def _preprocessed_events(spark, sf_dir):
    from implicit_rank.operators.prep import drop_low_counts, tag_split, union_all
    ev = written(_event_splits(spark, sf_dir), "events", ["split"])  # the JSON is parsed once
    given = {name: ev.where(F.col("split") == name).select("user_id", "item_id", "cnt")
             for name in ("train", "val", "test")}
    tagged = union_all([tag_split(df, name) for name, df in given.items()])
    return drop_low_counts(tagged, MIN_COUNT)


@register("tag_union_threshold", _with(
    f"e AS ({O.EVENTS})",
    f"s AS (SELECT user_id, item_id, cnt, {O.split_expr(SEED)} AS split FROM e)")
    + f"\nSELECT split, count(*) AS n_rows FROM s WHERE cnt >= {MIN_COUNT} GROUP BY split")
def q_tag_union_threshold(spark, sf_dir):
    """Tag given splits, union, drop low counts, count per split (B1-B3, F1, AG7)."""
    from implicit_rank.operators.prep import split_counts
    return split_counts(_preprocessed_events(spark, sf_dir))


@register("index_ids", _with(
    f"e AS ({O.EVENTS})",
    f"s AS (SELECT user_id, item_id, cnt, {O.split_expr(SEED)} AS split FROM e WHERE cnt >= {MIN_COUNT})",
    """ui AS (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) - 1 AS user_idx
              FROM s GROUP BY user_id)""",
    """ii AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) - 1 AS item_idx
              FROM s GROUP BY item_id)""")
    + "\nSELECT ui.user_idx, s.cnt, ii.item_idx, s.split FROM s JOIN ui USING (user_id) JOIN ii USING (item_id)")
def q_index_ids(spark, sf_dir):
    """Joint frequency index of users and items over all splits."""
    from implicit_rank.operators.indexing import index_ids
    from implicit_rank.operators.prep import indexed_columns
    # read by both index passes and the final join: parse the JSON once
    kept = written(_preprocessed_events(spark, sf_dir), "events")
    return rounded(indexed_columns(index_ids(kept)))


INDEX_FROM = 50  # the index is fitted on train pairs of at least this count, so that some ids are unseen

_INDEX_SQL = _with(
    O.base_ctes(SEED),
    f"base AS (SELECT * FROM train WHERE cnt >= {INDEX_FROM})",
    """ii AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) - 1 AS item_idx
              FROM base GROUP BY item_id)""",
    """fresh AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) AS place
              FROM s WHERE item_id NOT IN (SELECT item_id FROM ii) GROUP BY item_id)""",
    "unseen AS (SELECT count(*) > 0 AS any_unseen FROM fresh)")


def _index_frames(spark, sf_dir):
    from implicit_rank.operators.indexing import IdIndex
    s = splits(spark, sf_dir, materialize=True)
    base = s.where((F.col("split") == "train") & (F.col("cnt") >= INDEX_FROM))
    return s.select("user_id", "item_id"), base.select("user_id", "item_id"), IdIndex


@register("index_modes", _INDEX_SQL + """
SELECT 'skip' AS handle, s.user_id, s.item_id, ii.item_idx, (SELECT any_unseen FROM unseen) AS refused FROM s JOIN ii USING (item_id)
UNION ALL SELECT 'keep', s.user_id, s.item_id, coalesce(ii.item_idx, (SELECT count(*) FROM ii)), (SELECT any_unseen FROM unseen) FROM s LEFT JOIN ii USING (item_id)
UNION ALL SELECT 'reserved', s.user_id, s.item_id, coalesce(ii.item_idx + 1, 0), (SELECT any_unseen FROM unseen) FROM s LEFT JOIN ii USING (item_id)
UNION ALL SELECT 'error', b.user_id, b.item_id, ii.item_idx, (SELECT any_unseen FROM unseen) FROM base b JOIN ii USING (item_id)""")
def q_index_modes(spark, sf_dir):
    """Index fitted on part of the pairs, applied to all: unseen ids dropped, put in a slot, or refused (H2)."""
    pairs, base, IdIndex = _index_frames(spark, sf_dir)
    plain, reserved = IdIndex.fit(base, "item_id", "item_idx"), IdIndex.fit(base, "item_id", "item_idx", reserve=True)
    try:
        plain.transform(pairs, "error").write.format("noop").mode("overwrite").save()
        refused = False
    except Exception as e:  # the plan's own error, not another
        refused = "is not in the index" in str(e)
    runs = (("skip", plain.transform(pairs, "skip")), ("keep", plain.transform(pairs, "keep")),
            ("reserved", reserved.transform(pairs, "keep")), ("error", plain.transform(base, "error")))
    out = None
    for name, df in runs:
        part = df.select(F.lit(name).alias("handle"), "user_id", "item_id", "item_idx", F.lit(refused).alias("refused"))
        out = part if out is None else out.unionByName(part)
    return out


@register("index_extend", _INDEX_SQL + """
SELECT item_id, item_idx, false AS added FROM ii
UNION ALL SELECT item_id, place - 1 + (SELECT count(*) FROM ii), true FROM fresh""")
def q_index_extend(spark, sf_dir):
    """An index saved, loaded and extended by new ids: old numbers stay, new ones follow the last (H2)."""
    from implicit_rank.session import shared_folder
    pairs, base, IdIndex = _index_frames(spark, sf_dir)
    folder = IdIndex.fit(base, "item_id", "item_idx").save(shared_folder(spark, "item-index"))
    old = IdIndex.load(spark, folder)
    old.extend(pairs).save(folder)
    new = IdIndex.load(spark, folder)
    known = old.table.select("item_id", F.lit(True).alias("known"))
    return new.table.join(known, "item_id", "left").select("item_id", "item_idx", F.col("known").isNull().alias("added"))


TOP_USERS = 100

_TOP_SQL = f"top AS (SELECT user_id, count(*) AS activity FROM p GROUP BY user_id ORDER BY activity DESC, user_id LIMIT {TOP_USERS})"


@register("topk_users", _with(f"p AS ({O.PURCHASES})", _TOP_SQL) + "\nSELECT user_id, activity FROM top")
def q_topk_users(spark, sf_dir):
    """Top-k most active users by rows (AG2, E1)."""
    from implicit_rank.operators.sample import top_users
    return top_users(purchases(spark, sf_dir), TOP_USERS)


@register("topk_user_interactions", _with(f"p AS ({O.PURCHASES})", _TOP_SQL)
          + "\nSELECT p.user_id, p.item_id, (round(p.cnt, 6) + CAST(0 AS DOUBLE)) AS cnt FROM p WHERE p.user_id IN (SELECT user_id FROM top)")
def q_topk_user_interactions(spark, sf_dir):
    """Interactions of the top-k users, broadcast semi-join."""
    from implicit_rank.operators.sample import top_user_interactions
    return rounded(top_user_interactions(written(purchases(spark, sf_dir), "purchases"), TOP_USERS))


@register("subsample_topk", _with(
    f"p AS ({O.PURCHASES})", _TOP_SQL,
    "t AS (SELECT * FROM p WHERE user_id IN (SELECT user_id FROM top))",
    """ui AS (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) - 1 AS user_idx
              FROM t GROUP BY user_id)""",
    """ii AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR)) - 1 AS item_idx
              FROM t GROUP BY item_id)""")
    + f"""\nSELECT t.user_id, t.item_id, (round(t.cnt, 6) + CAST(0 AS DOUBLE)) AS cnt, ui.user_idx, ii.item_idx, {O.split_expr(SEED, 't.user_id', 't.item_id')} AS split
FROM t JOIN ui ON ui.user_id = t.user_id JOIN ii ON ii.item_id = t.item_id""")
def q_subsample_topk(spark, sf_dir):
    """Top-k-user subsample: top users, their rows, index inside, split."""
    from implicit_rank.operators.sample import subsample_topk
    return rounded(subsample_topk(written(purchases(spark, sf_dir), "purchases"), TOP_USERS, SEED))


@register("hash_split", _with(O.base_ctes(SEED)) + "\nSELECT user_id, item_id, (round(cnt, 6) + CAST(0 AS DOUBLE)) AS cnt, split FROM s")
def q_hash_split(spark, sf_dir):
    """Stable 80/10/10 split on md5(user|item|seed)."""
    return rounded(splits(spark, sf_dir))


@register("split_counts", _with(O.base_ctes(SEED)) + "\nSELECT split, count(*) AS n_rows FROM s GROUP BY split")
def q_split_counts(spark, sf_dir):
    """Rows per split in one aggregation (AG7)."""
    from implicit_rank.operators.prep import split_counts
    return split_counts(splits(spark, sf_dir))


N_FOLDS = 5
HOLDOUT = 5

_FOLDS_SQL = f"""f AS (
  SELECT user_id, item_id, cnt,
         CAST(CAST('0x' || substr({O.md5_of("'u'", 'user_id', seed=SEED)}, 1, 3) AS INTEGER) % {N_FOLDS} AS BIGINT) AS fold,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY {O.md5_of('user_id', 'item_id', seed=SEED)}, item_id) <= {HOLDOUT} AS BIGINT) AS holdout
  FROM p)"""


def _folds(spark, sf_dir):
    from implicit_rank.operators.sample import user_folds
    return user_folds(written(purchases(spark, sf_dir), "purchases"), N_FOLDS, HOLDOUT, SEED)


@register("user_folds", _with(f"p AS ({O.PURCHASES})", _FOLDS_SQL)
          + "\nSELECT user_id, item_id, (round(cnt, 6) + CAST(0 AS DOUBLE)) AS cnt, fold, holdout FROM f")
def q_user_folds(spark, sf_dir):
    """User folds: user hash bucket, 5 held-out rows per user."""
    return rounded(_folds(spark, sf_dir))


_EVEN_FOLDS_SQL = f"""SELECT p.user_id, p.item_id, {O.r6('p.cnt')} AS cnt, u.fold,
  CAST(row_number() OVER (PARTITION BY p.user_id ORDER BY {O.md5_of('p.user_id', 'p.item_id', seed=SEED)}, p.item_id) <= {HOLDOUT} AS BIGINT) AS holdout
FROM p JOIN (SELECT user_id, (row_number() OVER (ORDER BY {O.md5_of("'u'", 'user_id', seed=SEED)}, user_id) - 1) % {N_FOLDS} AS fold
  FROM (SELECT DISTINCT user_id FROM p)) u ON u.user_id = p.user_id"""


@register("user_folds_even", _with(f"p AS ({O.PURCHASES})") + "\n" + _EVEN_FOLDS_SQL)
def q_user_folds_even(spark, sf_dir):
    """User folds of sizes that differ by at most one user, 5 held-out rows per user."""
    from implicit_rank.operators.sample import user_folds
    return rounded(user_folds(written(purchases(spark, sf_dir), "purchases"), N_FOLDS, HOLDOUT, SEED, even=True))


@register("fold_summary", _with(f"p AS ({O.PURCHASES})", _FOLDS_SQL)
          + """\nSELECT fold, count(DISTINCT user_id) AS n_users, CAST(sum(holdout) AS BIGINT) AS n_test,
       count(*) - CAST(sum(holdout) AS BIGINT) AS n_rest FROM f GROUP BY fold""")
def q_fold_summary(spark, sf_dir):
    """Fold sizes; the test rows of all folds together are the truth (F3, AG8)."""
    f = _folds(spark, sf_dir)
    return f.groupBy("fold").agg(
        F.countDistinct("user_id").alias("n_users"),
        F.sum("holdout").cast("bigint").alias("n_test"),
        (F.count(F.lit(1)) - F.sum("holdout")).cast("bigint").alias("n_rest"))


# -- count to rating ------------------------------------------------------

def _rating_sql(c: str, m: str, s: str) -> str:
    lo, hi = f"({m} - 2 * {s})", f"({m} + 2 * {s})"
    scaled = f"(5 * (least(greatest(CAST({c} AS DOUBLE), {lo}), {hi}) - {lo}) / ({hi} - {lo}))"
    return f"CASE WHEN {s} IS NULL OR {s} = 0 THEN 2.5 WHEN {scaled} <= 0 THEN 0.05 ELSE {scaled} END"


@register("rating_moments", _with(O.base_ctes(SEED)) + """
SELECT item_id, n, (round(m, 6) + CAST(0 AS DOUBLE)) AS m, (round(sd, 6) + CAST(0 AS DOUBLE)) AS s FROM (
  SELECT item_id, count(cnt) AS n, avg(cnt) AS m, stddev_samp(cnt) AS sd FROM s GROUP BY item_id
  UNION ALL SELECT NULL, count(cnt), avg(cnt), stddev_samp(cnt) FROM s)""")
def q_rating_moments(spark, sf_dir):
    """Mean and deviation per item and overall, merged from the moments of each split (AG6)."""
    from implicit_rank.functions.rating import mean_and_deviation, merge_moments, moments
    parts = written(moments(splits(spark, sf_dir), by=["split", "item_id"]), "moments")
    items = mean_and_deviation(merge_moments(parts, ["item_id"]), ["item_id"])
    whole = mean_and_deviation(merge_moments(parts)).select(F.lit(None).cast("bigint").alias("item_id"), "n", "m", "s")
    return rounded(items.unionByName(whole))


@register("count_to_rating", _with(O.base_ctes(SEED),
          "rs AS (SELECT avg(cnt) AS m, stddev_samp(cnt) AS sd FROM train)")
          + f"\nSELECT user_id, item_id, split, (round({_rating_sql('cnt', 'rs.m', 'rs.sd')}, 6) + CAST(0 AS DOUBLE)) AS rating FROM s, rs")
def q_count_to_rating(spark, sf_dir):
    """Count -> rating with train statistics, applied to every split (AG6, G1)."""
    from implicit_rank.functions.rating import to_rating
    s = splits(spark, sf_dir, materialize=True)
    train = s.where(F.col("split") == "train")
    out = to_rating(s, fitted_on=train).select("user_id", "item_id", "split", F.col("cnt").alias("rating"))
    return rounded(out)


@register("count_to_rating_per_item", _with(O.base_ctes(SEED),
          "rs AS (SELECT item_id, avg(cnt) AS m, stddev_samp(cnt) AS sd FROM train GROUP BY item_id)")
          + f"\nSELECT s.user_id, s.item_id, s.split, (round({_rating_sql('s.cnt', 'rs.m', 'rs.sd')}, 6) + CAST(0 AS DOUBLE)) AS rating "
            "FROM s LEFT JOIN rs ON rs.item_id = s.item_id")
def q_count_to_rating_per_item(spark, sf_dir):
    """Per-item statistics variant (as the report describes G1)."""
    from implicit_rank.functions.rating import to_rating
    s = splits(spark, sf_dir, materialize=True)
    train = s.where(F.col("split") == "train")
    out = to_rating(s, fitted_on=train, per_item=True).select(
        "user_id", "item_id", "split", F.col("cnt").alias("rating"))
    return rounded(out)


# -- bias model -------------------------------------------------------------

_BIAS = _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING))


@register("bias_item_offsets", _BIAS + "\nSELECT item_id, (round(b_i, 6) + CAST(0 AS DOUBLE)) AS b_i, n_i FROM bi")
def q_bias_item_offsets(spark, sf_dir):
    """b_i = sum(r - mu) / (n_i + damping_item) (J1, J2, AG1, AG3, AG4)."""
    train, _ = train_test(spark, sf_dir)
    return rounded(fit_bias(train, default_bias()).item_offsets)


@register("bias_user_offsets", _BIAS + "\nSELECT user_id, (round(b_u, 6) + CAST(0 AS DOUBLE)) AS b_u, n_u FROM bu")
def q_bias_user_offsets(spark, sf_dir):
    """b_u = sum(r - mu - b_i) / (n_u + damping_user)."""
    train, _ = train_test(spark, sf_dir)
    return rounded(fit_bias(train, default_bias()).user_offsets)


@register("bias_undamped", _with(O.base_ctes(SEED), O.bias_ctes(0.0, 0.0))
          + """\nSELECT 'item' AS kind, item_id AS id, (round(b_i, 6) + CAST(0 AS DOUBLE)) AS offset_value, n_i AS n FROM bi
UNION ALL SELECT 'user' AS kind, user_id AS id, (round(b_u, 6) + CAST(0 AS DOUBLE)) AS offset_value, n_u AS n FROM bu""")
def q_bias_undamped(spark, sf_dir):
    """Damping 0: offsets are plain means of residuals (AG5)."""
    train, _ = train_test(spark, sf_dir)
    m = fit_bias(train, BiasConfig(damping=0.0))
    items = m.item_offsets.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"),
                                  F.col("b_i").alias("offset_value"), F.col("n_i").alias("n"))
    users = m.user_offsets.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"),
                                  F.col("b_u").alias("offset_value"), F.col("n_u").alias("n"))
    return rounded(items.unionByName(users))


def _predict_sql(prefix: str = "") -> str:
    return f"""SELECT x.user_id, x.item_id,
       (round((SELECT mu FROM {prefix}st) + coalesce(i.b_i, 0) + coalesce(u.b_u, 0), 6) + CAST(0 AS DOUBLE)) AS prediction
FROM x LEFT JOIN {prefix}bi i ON i.item_id = x.item_id LEFT JOIN {prefix}bu u ON u.user_id = x.user_id"""


@register("bias_predict", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING),
                                "x AS (SELECT user_id, item_id FROM s WHERE split <> 'train')") + "\n" + _predict_sql())
def q_bias_predict(spark, sf_dir):
    """mu + b_i + b_u for held-out pairs; unseen users/items get offset 0."""
    s = splits(spark, sf_dir, materialize=True)
    train = s.where(F.col("split") == "train").select("user_id", "item_id", "cnt")
    pairs = s.where(F.col("split") != "train").select("user_id", "item_id")
    return rounded(fit_bias(train, default_bias()).predict(pairs))


_VARIANTS = (("item_only", True, False), ("user_only", False, True), ("neither", False, False))


@register("bias_variants", _with(
    O.base_ctes(SEED),
    O.bias_ctes(USER_DAMPING, ITEM_DAMPING, prefix="a_", users=False),
    O.bias_ctes(USER_DAMPING, ITEM_DAMPING, prefix="b_", item=False),
    O.bias_ctes(USER_DAMPING, ITEM_DAMPING, prefix="c_", item=False, users=False),
    "x AS (SELECT user_id, item_id FROM test)")
    + "\nSELECT 'item_only' AS variant, * FROM (" + _predict_sql("a_") + ")"
    + "\nUNION ALL SELECT 'user_only' AS variant, * FROM (" + _predict_sql("b_") + ")"
    + "\nUNION ALL SELECT 'neither' AS variant, * FROM (" + _predict_sql("c_") + ")")
def q_bias_variants(spark, sf_dir):
    """Item or user part switched off (J1 flags): predictions on test pairs."""
    train, test = train_test(spark, sf_dir)
    pairs = test.select("user_id", "item_id")
    out = None
    for name, item, users in _VARIANTS:
        m = fit_bias(train, BiasConfig(item=item, users=users, damping=(USER_DAMPING, ITEM_DAMPING)))
        part = m.predict(pairs).select(F.lit(name).alias("variant"), "user_id", "item_id", "prediction")
        out = part if out is None else out.unionByName(part)
    return rounded(out)


_OBSERVED_SQL = """obs AS (
  SELECT x.user_id, x.item_id,
         row_number() OVER (PARTITION BY x.user_id ORDER BY coalesce(i.b_i, 0) DESC, x.item_id DESC) AS rnk,
         (SELECT mu FROM st) + coalesce(i.b_i, 0) + coalesce(u.b_u, 0) AS score
  FROM test x LEFT JOIN bi i ON i.item_id = x.item_id LEFT JOIN bu u ON u.user_id = x.user_id)"""


@register("bias_rank_observed", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), _OBSERVED_SQL)
          + f"\nSELECT user_id, item_id, rnk, (round(score, 6) + CAST(0 AS DOUBLE)) AS score FROM obs WHERE rnk <= {K}")
def q_bias_rank_observed(spark, sf_dir):
    """Rank only the held-out pairs of each user, as coded."""
    train, test = train_test(spark, sf_dir)
    return rounded(fit_bias(train, default_bias()).rank_observed(test, K))


@register("bias_topk_catalogue", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K))
          + "\nSELECT user_id, item_id, rnk, (round(score, 6) + CAST(0 AS DOUBLE)) AS score FROM recs")
def q_bias_topk_catalogue(spark, sf_dir):
    """Top-k unseen catalogue items per test user."""
    recs, _ = catalogue_recs(spark, sf_dir, scores=True)
    return rounded(recs)


@register("bias_model_roundtrip", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING),
                                        "x AS (SELECT user_id, item_id FROM test)") + "\n" + _predict_sql())
def q_bias_model_roundtrip(spark, sf_dir):
    """Save the model (three parquet parts), load it, predict."""
    from implicit_rank.session import shared_folder
    train, test = train_test(spark, sf_dir)
    path = fit_bias(train, default_bias()).save(shared_folder(spark, "bias-model"))
    return rounded(BiasModel.load(spark, path).predict(test.select("user_id", "item_id")))


# -- metrics ----------------------------------------------------------------

@register("metrics_observed", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), _OBSERVED_SQL,
                                    f"orecs AS (SELECT * FROM obs WHERE rnk <= {K})",
                                    O.metrics_ctes(K, "orecs", "test")) + "\n" + O.metrics_select())
def q_metrics_observed(spark, sf_dir):
    """Metrics when only held-out pairs are ranked: MAP and NDCG are 1."""
    train, test = train_test(spark, sf_dir)
    recs = fit_bias(train, default_bias()).rank_observed(test, K)
    return rounded(ranking_metrics(recs, test, K))


@register("metrics_lenient", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
                                   O.lenient_ctes(K, "recs", "test")) + "\n" + O.lenient_select())
def q_metrics_lenient(spark, sf_dir):
    """Lenient precision/recall/NDCG with count gains and the manual MAP (K5-K8)."""
    recs, test = catalogue_recs(spark, sf_dir)
    return rounded(lenient_metrics(recs, test, K))


def _by_k_sql() -> str:
    parts = []
    for k in KS:
        parts.append(f"SELECT CAST({k} AS BIGINT) AS k, * FROM (" + _with(
            O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
            O.metrics_ctes(k, "recs", "test")) + "\n" + O.metrics_select() + ")")
    return "\nUNION ALL\n".join(parts)


@register("metrics_by_k", _by_k_sql())
def q_metrics_by_k(spark, sf_dir):
    """Metrics at several k from one list of length max(k), one aggregation."""
    recs, test = catalogue_recs(spark, sf_dir, max(KS))
    return rounded(metrics_by_k(recs, test, max(KS)).where(F.col("k").isin(*KS)))


@register("per_user_metrics", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
                                    O.metrics_ctes(K, "recs", "test"))
          + """\nSELECT user_id, n_truth, n_recs, n_hits, (round(precision_at_k, 6) + CAST(0 AS DOUBLE)) AS precision_at_k,
       (round(recall_at_k, 6) + CAST(0 AS DOUBLE)) AS recall_at_k, (round(map, 6) + CAST(0 AS DOUBLE)) AS map, (round(map_at_k, 6) + CAST(0 AS DOUBLE)) AS map_at_k,
       (round(ndcg_at_k, 6) + CAST(0 AS DOUBLE)) AS ndcg_at_k FROM m_pu""")
def q_per_user_metrics(spark, sf_dir):
    """One row per user with truth."""
    from implicit_rank.operators.metrics import per_user_metrics
    recs, test = catalogue_recs(spark, sf_dir)
    return rounded(per_user_metrics(recs, test, K))


@register("metrics_long", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
                                O.metrics_ctes(K, "recs", "test"), "w AS (" + O.metrics_select() + ")")
          + """\nSELECT 'precision_at_k' AS metric, precision_at_k AS value FROM w
UNION ALL SELECT 'recall_at_k', recall_at_k FROM w UNION ALL SELECT 'map', map FROM w
UNION ALL SELECT 'map_at_k', map_at_k FROM w UNION ALL SELECT 'ndcg_at_k', ndcg_at_k FROM w""")
def q_metrics_long(spark, sf_dir):
    """Metric report as (metric, value) rows."""
    from implicit_rank.operators.metrics import metrics_long
    recs, test = catalogue_recs(spark, sf_dir)
    return metrics_long(rounded(ranking_metrics(recs, test, K)).drop("n_users"))


@register("metrics_by_split", _with(
    O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING),
    """obs AS (
  SELECT x.split, x.user_id, x.item_id,
         row_number() OVER (PARTITION BY x.split, x.user_id ORDER BY coalesce(i.b_i, 0) DESC, x.item_id DESC) AS rnk
  FROM s x LEFT JOIN bi i ON i.item_id = x.item_id)""",
    """nt AS (SELECT split, user_id, count(*) AS n_truth FROM s GROUP BY split, user_id)""",
    f"""hits AS (SELECT split, user_id, rnk, row_number() OVER (PARTITION BY split, user_id ORDER BY rnk) AS h
             FROM obs WHERE rnk <= {K})""",
    """ha AS (SELECT split, user_id, count(*) AS n_hits, sum(h / rnk) AS prec_sum, sum(1 / log2(rnk + 1)) AS dcg
           FROM hits GROUP BY split, user_id)""",
    f"""pu AS (SELECT nt.split, ha.n_hits / {K} AS precision_at_k, ha.n_hits / nt.n_truth AS recall_at_k,
       ha.prec_sum / nt.n_truth AS map, ha.prec_sum / least(nt.n_truth, {K}) AS map_at_k,
       ha.dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(nt.n_truth, {K}) + 1) g(i)) AS ndcg_at_k
     FROM nt JOIN ha ON ha.split = nt.split AND ha.user_id = nt.user_id)""")
    + """\nSELECT split, count(*) AS n_users, (round(avg(precision_at_k), 6) + CAST(0 AS DOUBLE)) AS precision_at_k,
  (round(avg(recall_at_k), 6) + CAST(0 AS DOUBLE)) AS recall_at_k, (round(avg(map), 6) + CAST(0 AS DOUBLE)) AS map, (round(avg(map_at_k), 6) + CAST(0 AS DOUBLE)) AS map_at_k,
  (round(avg(ndcg_at_k), 6) + CAST(0 AS DOUBLE)) AS ndcg_at_k FROM pu GROUP BY split""")
def q_metrics_by_split(spark, sf_dir):
    """Train / val / test metrics of the coded (observed) mode in one aggregation."""
    s = splits(spark, sf_dir, materialize=True)
    train = s.where(F.col("split") == "train").select("user_id", "item_id", "cnt")
    model = fit_bias(train, default_bias())
    recs = model.rank_observed(s, K, by=["split"])
    return rounded(ranking_metrics(recs, s, K, by=["split"]))


@register("ranked_lists", _with(O.base_ctes(SEED), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K))
          + "\nSELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rnk) AS items FROM recs GROUP BY user_id")
def q_ranked_lists(spark, sf_dir):
    """Array form of the lists at the API edge (AG9, G2-G4), shown as text."""
    from implicit_rank.functions.arrays import ranked_lists
    recs, _ = catalogue_recs(spark, sf_dir)
    lists = ranked_lists(recs)
    return lists.select("user_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


# -- studies of the bias model with oracles (L7, L8) -----------------------

THRESHOLDS = (1, 10, 20, 30)


def _threshold_sql() -> str:
    ctes = [O.base_ctes(SEED)]
    selects = []
    for n in THRESHOLDS:
        p = f"t{n}_"
        ctes += [f"{p}train AS (SELECT * FROM train WHERE cnt >= {n})",
                 f"{p}test AS (SELECT * FROM test WHERE cnt >= {n})",
                 O.bias_ctes(USER_DAMPING, ITEM_DAMPING, src=f"{p}train", prefix=p),
                 O.catalogue_ctes(K, prefix=p, seen=f"{p}train", truth=f"{p}test"),
                 O.metrics_ctes(K, f"{p}recs", f"{p}test", prefix=f"{p}m_")]
        selects.append(O.metrics_select(prefix=f"{p}m_", extra=f"CAST({n} AS BIGINT) AS threshold, "))
    return _with(*ctes) + "\n" + "\nUNION ALL\n".join(selects)


@register("metrics_by_threshold", _threshold_sql())
def q_metrics_by_threshold(spark, sf_dir):
    """Drop counts below N, refit, re-evaluate, at every N in one pass over the pairs."""
    from implicit_rank.operators.thresholds import metrics_by_threshold
    train, test = train_test(spark, sf_dir)
    out = metrics_by_threshold(train, test, THRESHOLDS, K, default_bias())
    return rounded(out.withColumn("threshold", F.col("threshold").cast("bigint")))


@register("count_vs_rating", _with(
    O.base_ctes(SEED),
    "rs AS (SELECT avg(cnt) AS m, stddev_samp(cnt) AS sd FROM train)",
    f"rtrain AS (SELECT user_id, item_id, {_rating_sql('cnt', 'rs.m', 'rs.sd')} AS cnt FROM train, rs)",
    O.bias_ctes(USER_DAMPING, ITEM_DAMPING),
    O.catalogue_ctes(K),
    O.metrics_ctes(K, "recs", "test", prefix="c_m_"),
    O.bias_ctes(USER_DAMPING, ITEM_DAMPING, src="rtrain", prefix="r_"),
    O.catalogue_ctes(K, prefix="r_"),
    O.metrics_ctes(K, "r_recs", "test", prefix="r_m_"))
    + "\n" + O.metrics_select("c_m_", "'count' AS variant, ")
    + "\nUNION ALL\n" + O.metrics_select("r_m_", "'rating' AS variant, "))
def q_count_vs_rating(spark, sf_dir):
    """Bias model on raw counts and on ratings (G1), same truth."""
    from implicit_rank.functions.rating import to_rating
    train, test = train_test(spark, sf_dir)
    out = None
    for variant, fitted_on in (("count", train), ("rating", to_rating(train))):
        recs = fit_bias(fitted_on, default_bias()).recommend(test.select("user_id"), train, K, scores=False)
        part = ranking_metrics(recs, test, K).select(F.lit(variant).alias("variant"), "*")
        out = part if out is None else out.unionByName(part)
    return rounded(out)


# -- ALS and experiment sweeps (rows-only: iterative, not SQL) ---------------

# the driver tables have int ids
ALS_SMALL = dict(rank=10, max_iter=5, reg=1.0, alpha=10.0, ids="raw")
# Runs of a sweep submitted concurrently (they share the executors).
SWEEP_PARALLELISM = 4


def _als_params(**over):
    from implicit_rank.operators.als import AlsParams
    return AlsParams(**{**ALS_SMALL, **over})


@register("als_score_pairs", _with(O.base_ctes(SEED))
          + """\nSELECT user_id, item_id, true AS scored FROM test
WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""")
def q_als_score_pairs(spark, sf_dir):
    """Implicit ALS fit on train; the test pairs that get a finite score: cold users and items are dropped."""
    from implicit_rank.operators.als import fit_als, score_pairs
    train, test = train_test(spark, sf_dir)
    scored = score_pairs(fit_als(train, _als_params()), test)
    finite = F.col("prediction").isNotNull() & (F.abs("prediction") < float("inf"))
    return scored.select("user_id", "item_id", finite.alias("scored"))


def _als_topk(spark, sf_dir, **over):
    from implicit_rank.operators.als import fit_als, recommend
    train, test = train_test(spark, sf_dir)
    fit = fit_als(train, _als_params(**over))
    return recommend(fit, test.select("user_id"), train, K), train, test


def _list_checks(recs: DataFrame, seen: DataFrame) -> DataFrame:
    """What holds for every user's list, whatever the factors are."""
    from pyspark.sql import Window
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rnk"))
    lists = recs.withColumn("_up", F.coalesce(F.col("score") > before, F.lit(False))).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.countDistinct("item_id").alias("n_items"),
        (F.max("rnk") == F.count(F.lit(1))).alias("ranks_1_to_n"), (~F.max("_up")).alias("scores_descend"))
    again = recs.join(seen, ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
    return lists.join(again, "user_id", "left").withColumn("n_seen", F.coalesce("n_seen", F.lit(0).cast("bigint")))


_ALS_LISTS_SQL = _with(O.base_ctes(SEED), "seen AS (SELECT user_id, count(*) AS n FROM train GROUP BY user_id)",
                       f"""lists AS (SELECT user_id, least({K}, (SELECT count(DISTINCT item_id) FROM train) - n) AS n_recs
  FROM seen WHERE user_id IN (SELECT user_id FROM test))""") + """
SELECT user_id, n_recs, n_recs AS n_items, true AS ranks_1_to_n, true AS scores_descend, CAST(0 AS BIGINT) AS n_seen
FROM lists WHERE n_recs > 0"""


@register("als_topk", _ALS_LISTS_SQL)
def q_als_topk(spark, sf_dir):
    """Top-k unseen catalogue items per test user from ALS (J8): what every list must satisfy."""
    recs, train, _ = _als_topk(spark, sf_dir)
    return _list_checks(recs, train)


@register("als_presence", _ALS_LISTS_SQL)
def q_als_presence(spark, sf_dir):
    """ALS on presence only (rating 1.0) instead of counts."""
    recs, train, _ = _als_topk(spark, sf_dir, use_counts=False)
    return _list_checks(recs, train)


@register("als_signed", _ALS_LISTS_SQL)
def q_als_signed(spark, sf_dir):
    """Factorisation without non-negativity."""
    recs, train, _ = _als_topk(spark, sf_dir, nonnegative=False)
    return _list_checks(recs, train)


def _audit_sql() -> str:
    sizes = "(SELECT count(DISTINCT user_id) FROM train) AS n_users, (SELECT count(DISTINCT item_id) FROM train) AS n_items"
    return _with(O.base_ctes(SEED)) + "\nUNION ALL\n".join(
        f"\nSELECT '{name}' AS variant, {sizes}, true AS objective_falls, true AS solves_its_setting, false AS solves_the_other, {signed} AS has_negative"
        for name, signed in (("counts", "false"), ("presence", "false"), ("signed", "true")))


@register("als_audit", _audit_sql())
def q_als_audit(spark, sf_dir):
    """Whether the fits on counts, on presence and without non-negativity solve what they were asked (J6, J10, J11):
    the objective is below the start's and each user's gradient vanishes for the fit's own setting, not
    for the other kind of rating; negative factors appear only where they may."""
    from implicit_rank.operators.als import fit_als
    from implicit_rank.operators.implicit import audits_als, pack_als
    from implicit_rank.session import collect_garbage
    train, _ = train_test(spark, sf_dir)
    packed, rows = pack_als(train), []
    for name, over in (("counts", {}), ("presence", {"use_counts": False}), ("signed", {"nonnegative": False})):
        fit = fit_als(train, _als_params(**over))
        found, other = audits_als(fit, packed, [fit.params.use_counts, not fit.params.use_counts])
        users, items = fit.model.userFactors.count(), fit.model.itemFactors.count()
        rows.append((name, users, items, found["objective"] < found["zero"], found["gradient"] < 1e-3 * found["scale"],
                     other["gradient"] < 1e-3 * other["scale"], found["least"] < 0))
        del fit
        collect_garbage(spark)  # this fit's shuffles and those of its audit go before the next
    return spark.createDataFrame(rows, "variant string, n_users bigint, n_items bigint, objective_falls boolean, "
                                       "solves_its_setting boolean, solves_the_other boolean, has_negative boolean")


_FAR = 1 << 40  # shifts ids beyond 32 bits


@register("implicit_cg", _ALS_LISTS_SQL.replace("SELECT user_id, n_recs, n_recs AS", f"SELECT user_id + {_FAR} AS user_id, true AS objective_falls, n_recs, n_recs AS"))
def q_implicit_cg(spark, sf_dir):
    """Conjugate-gradient factorisation with ids beyond 32 bits: the objective falls with every half-step,
    and what every list must satisfy (J10, J8)."""
    from implicit_rank.operators.implicit import CgParams, fit_cg
    train, test = (t.withColumn("user_id", F.col("user_id") + _FAR) for t in train_test(spark, sf_dir))
    fit = fit_cg(train, CgParams(rank=8, max_iter=2, reg=1.0, alpha=10.0), track=True)
    falls = all(b < a for a, b in zip(fit.objectives, fit.objectives[1:]))
    return _list_checks(fit.recommend(test.select("user_id"), train, K), train).withColumn("objective_falls", F.lit(falls))


@register("als_metrics")
def q_als_metrics(spark, sf_dir):
    """Metrics of the ALS catalogue lists on test (K1-K4 on J8)."""
    recs, _, test = _als_topk(spark, sf_dir)
    return rounded(ranking_metrics(recs, test, K))


@register("als_roundtrip", _with(O.base_ctes(SEED)) + """
SELECT count(*) AS n_pairs, CAST(0 AS BIGINT) AS n_differ, true AS same_report, true AS string_ids_survive FROM test
WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""")
def q_als_roundtrip(spark, sf_dir):
    """Save a string-id model, then an int-id model to the same folder; what is
    loaded is each time the last save, predictions and parameters alike (A12, J12)."""
    from implicit_rank.operators.als import AlsFit, fit_als, score_pairs
    from implicit_rank.session import shared_folder
    train, test = train_test(spark, sf_dir)
    path = shared_folder(spark, "als-model")
    named = train.withColumn("user_id", F.col("user_id").cast("string"))
    first = fit_als(named, _als_params(rank=4, max_iter=1, ids="index"))
    back = AlsFit.load(spark, first.save(path))
    survives = back.users is not None and back.report() == first.report()
    fit = fit_als(train, _als_params(reg=0.5))
    loaded = AlsFit.load(spark, fit.save(path))
    pairs = score_pairs(fit, test).join(
        score_pairs(loaded, test).withColumnRenamed("prediction", "again"), ["user_id", "item_id"], "full")
    differ = F.sum(F.when(F.col("prediction").eqNullSafe(F.col("again")), 0).otherwise(1)).cast("bigint")
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.coalesce(differ, F.lit(0).cast("bigint")).alias("n_differ")).select(
        "*", F.lit(loaded.report() == fit.report() and loaded.users is None).alias("same_report"),
        F.lit(survives).alias("string_ids_survive"))


@register("als_grid", _with(O.base_ctes(SEED)) + """
SELECT CAST(r AS DOUBLE) AS rank, CAST(l AS DOUBLE) AS reg, CAST(10 AS DOUBLE) AS alpha,
  (SELECT count(DISTINCT user_id) FROM val) AS n_user_rows, CAST(1 AS BIGINT) AS n_best, true AS best_is_largest
FROM (VALUES (5), (10)) a(r), (VALUES (0.1), (1.0)) b(l)""")
def q_als_grid(spark, sf_dir):
    """Grid rank x lambda x alpha, fit on train, pick by precision@k on the fixed val split (L1, L2):
    the settings, the users scored by each, and that one setting is picked, the best."""
    from implicit_rank.plans.tune import build_grid, grid_search
    s = splits(spark, sf_dir, materialize=True)
    cols = ["user_id", "item_id", "cnt"]
    train = s.where(F.col("split") == "train").select(*cols)
    val = s.where(F.col("split") == "val").select(*cols)
    grid = build_grid([5, 10], [0.1, 1.0], [10.0], _als_params())
    table, _best = grid_search(spark, train, val, grid, K, parallelism=SWEEP_PARALLELISM)
    picked = table.agg(F.sum("best").alias("n_best"), (F.max("precision_at_k") == F.max(
        F.when(F.col("best") == 1, F.col("precision_at_k")))).alias("best_is_largest"))
    return rounded(table.select("rank", "reg", "alpha", "n_user_rows").join(F.broadcast(picked)))  # one row


@register("cg_grid", _with(O.base_ctes(SEED)) + """
SELECT CAST(8 AS DOUBLE) AS rank, CAST(l AS DOUBLE) AS reg, CAST(a AS DOUBLE) AS alpha,
  (SELECT count(DISTINCT user_id) FROM val) AS n_user_rows, CAST(1 AS BIGINT) AS n_best, true AS best_is_largest, true AS as_alone
FROM (VALUES (0.1), (1.0)) x(l), (VALUES (1), (10)) y(a)""")
def q_cg_grid(spark, sf_dir):
    """Grid lambda x alpha of conjugate-gradient fits on one packing of the pairs (L2, J10): the settings, the users
    scored by each, that one is picked, the best, and that the last has the factors of its fit alone."""
    from implicit_rank.operators.implicit import CgParams, fit_cg, fit_cg_grid
    from implicit_rank.plans.tune import cg_grid_search
    s = splits(spark, sf_dir, materialize=True)
    cols = ["user_id", "item_id", "cnt"]
    train = s.where(F.col("split") == "train").select(*cols)
    val = s.where(F.col("split") == "val").select(*cols)
    grid = [CgParams(rank=8, max_iter=2, reg=reg, alpha=alpha) for reg in (0.1, 1.0) for alpha in (1.0, 10.0)]
    packed: dict = {}
    table, _best = cg_grid_search(spark, train, val, grid, K, parallelism=SWEEP_PARALLELISM, packed=packed)
    together, alone = fit_cg_grid(train, grid[-2:], packed)[-1], fit_cg(train, grid[-1])
    differ = F.array_max(F.zip_with("features", "other", lambda a, b: F.abs(a - b)))
    apart = together.users.join(alone.users.withColumnRenamed("features", "other"), "id", "full").agg(F.max(F.coalesce(differ, F.lit(1.0))).alias("d"))
    picked = table.agg(F.sum("best").alias("n_best"), (F.max("precision_at_k") == F.max(
        F.when(F.col("best") == 1, F.col("precision_at_k")))).alias("best_is_largest"))
    return rounded(table.select("rank", "reg", "alpha", "n_user_rows").join(F.broadcast(picked))  # one row
                   .join(F.broadcast(apart.select((F.col("d") < 1e-6).alias("as_alone")))))  # one row


@register("als_fold_sweep")
def q_als_fold_sweep(spark, sf_dir):
    """User folds x (ALS, bias), run log, per-user metrics, mean per setting (I5, L3-L5, K9, C7, AG10)."""
    from implicit_rank.operators.sample import fold_test, fold_train
    from implicit_rank.plans.tune import Algorithm, als_fitter, bias_fitter, mean_by, run_metrics, sweep
    folds = written(_folds(spark, sf_dir), "folds")
    cols = ["user_id", "item_id", "cnt"]
    datasets = {f"fold{f}": (fold_train(folds, f).select(*cols), fold_test(folds, f).select(*cols))
                for f in range(N_FOLDS)}
    algs = [Algorithm("ImplicitALS", {"rank": r, "reg": 1.0, "alpha": 10.0},
                      als_fitter(_als_params(rank=r, max_iter=3))) for r in (5, 10)]
    algs.append(Algorithm("Bias", {"user_damping": USER_DAMPING, "item_damping": ITEM_DAMPING},
                          bias_fitter(default_bias())))
    run_log, recs = sweep(spark, datasets, algs, K, parallelism=SWEEP_PARALLELISM)
    per_user = run_metrics(run_log, recs, {n: t for n, (_, t) in datasets.items()}, K, include_missing=False)
    return rounded(mean_by(per_user, ["algo", "rank", "reg", "alpha"]))


@register("als_train_ratio_search")
def q_als_train_ratio_search(spark, sf_dir):
    """The coded tuning path: TrainValidationSplit over train+val with the
    train ratio, observed-pair evaluator (I4, L2, K12)."""
    from implicit_rank.plans.tune import build_grid, train_ratio_search
    s = splits(spark, sf_dir, materialize=True)
    cols = ["user_id", "item_id", "cnt"]
    train = s.where(F.col("split") == "train").select(*cols)
    val = s.where(F.col("split") == "val").select(*cols)
    grid = build_grid([5, 10], [1.0], [10.0], _als_params(max_iter=3))
    metrics, best = train_ratio_search(train, val, grid, K, parallelism=SWEEP_PARALLELISM)
    rows = [(g.rank, g.reg, g.alpha, float(m), int(g == best)) for g, m in zip(grid, metrics)]
    return spark.createDataFrame(rows, "rank bigint, reg double, alpha double, precision_at_k double, best bigint")


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """Bias vs ALS on test: metrics, fit and recommend time."""
    from implicit_rank.plans.tune import Algorithm, als_fitter, bias_fitter, metric_by_time, run_metrics, sweep
    train, test = train_test(spark, sf_dir)
    p = _als_params()
    algs = [Algorithm("Bias", {}, bias_fitter(default_bias())), Algorithm("ImplicitALS", {}, als_fitter(p))]
    run_log, recs = sweep(spark, {"test": (train, test)}, algs, K)
    per_user = run_metrics(run_log, recs, {"test": test}, K)
    return rounded(metric_by_time(per_user, run_log))


TOP_SIZES = (10, 100, 1000, 10000)


@register("fit_time_by_size")
def q_fit_time_by_size(spark, sf_dir):
    """Fit time and rows by top-k-user subsample size (I1 outputs swept, L10)."""
    from implicit_rank.operators.sample import top_user_interactions
    from implicit_rank.plans.tune import Algorithm, als_fitter, sweep
    data = written(purchases(spark, sf_dir), "purchases")
    datasets = {}
    for n in TOP_SIZES:
        sub = written(hash_split(top_user_interactions(data, n), SEED), "subsample", ["split"])
        cols = ["user_id", "item_id", "cnt"]
        datasets[f"top{n}"] = (sub.where(F.col("split") == "train").select(*cols),
                               sub.where(F.col("split") == "test").select(*cols))
    run_log, _ = sweep(spark, datasets, [Algorithm("ImplicitALS", {}, als_fitter(_als_params()))], K)
    sizes = spark.createDataFrame([(name, n, datasets[name][0].count()) for name, n in zip(datasets, TOP_SIZES)],
                                  "dataset string, top_users bigint, n_rows bigint")
    return rounded(run_log.join(F.broadcast(sizes), "dataset").select("dataset", "top_users", "n_rows", "train_time", "rec_time"))


# -- the same bias pipeline on the events fixture: 100 items, many exact
#    ties of b_i, users who have seen nearly the whole catalogue ----------

def _event_train_test(spark, sf_dir):
    s = written(_event_splits(spark, sf_dir), "events", ["split"])
    cols = ["user_id", "item_id", "cnt"]
    return s.where(F.col("split") == "train").select(*cols), s.where(F.col("split") == "test").select(*cols)


def _event_recs(spark, sf_dir):
    train, test = _event_train_test(spark, sf_dir)
    return fit_bias(train, default_bias()).recommend(test.select("user_id"), train, K), test


@register("bias_topk_catalogue_events", _with(
    O.base_ctes(SEED, O.EVENTS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K))
    + "\nSELECT user_id, item_id, rnk, (round(score, 6) + CAST(0 AS DOUBLE)) AS score FROM recs")
def q_bias_topk_catalogue_events(spark, sf_dir):
    """Top-k unseen on the events fixture: ties broken by item id, short lists."""
    recs, _ = _event_recs(spark, sf_dir)
    return rounded(recs)


@register("metrics_catalogue_events", _with(
    O.base_ctes(SEED, O.EVENTS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K),
    O.metrics_ctes(K, "recs", "test")) + "\n" + O.metrics_select())
def q_metrics_catalogue_events(spark, sf_dir):
    """Flagship metrics on the events fixture (K1-K4)."""
    recs, test = _event_recs(spark, sf_dir)
    return rounded(ranking_metrics(recs, test, K))


@register("als_metrics_observed", _with(
    O.base_ctes(SEED),
    """warm AS (SELECT user_id, item_id FROM test
  WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train))""",
    f"""pu AS (SELECT t.user_id, count(*) AS nt, least({K}, count(w.item_id)) AS h
  FROM test t LEFT JOIN warm w ON w.user_id = t.user_id AND w.item_id = t.item_id GROUP BY t.user_id)""",
    f"""m AS (SELECT h / {K} AS precision_at_k, h / nt AS recall_at_k, h / nt AS map, h / least(nt, {K}) AS map_at_k,
  (SELECT coalesce(sum(1 / log2(i + 1)), 0) FROM range(1, h + 1) g(i))
    / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(nt, {K}) + 1) g(i)) AS ndcg_at_k FROM pu)""")
    + "\n" + O.metrics_select("").replace("FROM pu", "FROM m"))
def q_als_metrics_observed(spark, sf_dir):
    """The coded ALS evaluation: score the test pairs, rank them per user, compare with the
    test items (observed mode, D10; J7, E2, E3, K1-K4). Every ranked pair is a hit, so the
    metrics depend on the counts of warm pairs only."""
    from implicit_rank.operators.als import fit_als, score_pairs
    from implicit_rank.operators.rank import top_k_per_user
    train, test = train_test(spark, sf_dir)
    scored = score_pairs(fit_als(train, _als_params()), test)
    recs = top_k_per_user(scored, K, [F.col("prediction").desc(), F.col("item_id").desc()])
    return rounded(ranking_metrics(recs, test, K))


# -- sources and sinks on the given tables -----------------------------------

_PAIRS_SQL = f"SELECT user_id, item_id, (round(cnt, 6) + CAST(0 AS DOUBLE)) AS cnt FROM ({O.PURCHASES})"


@register("parquet_roundtrip", f"SELECT *, true AS refused, 'cf_top5_unseeded' AS name FROM ({_PAIRS_SQL}) "
                               "UNION ALL SELECT *, true, 'cf_top5_7' FROM (" + _PAIRS_SQL + ")")
def q_parquet_roundtrip(spark, sf_dir):
    """Write with the reference's column names, refuse to write again, overwrite, read back."""
    from pyspark.errors import AnalysisException

    from implicit_rank.operators.prep import rename_columns
    from implicit_rank.session import shared_folder
    from implicit_rank.sources.io import output_name, read_interactions, write_parquet
    pairs = written(purchases(spark, sf_dir), "purchases")
    raw = rename_columns(pairs, {"cnt": "count", "item_id": "track_id"})
    folder = shared_folder(spark, "roundtrip")
    out = None
    for seed in (None, 7):
        name = output_name("cf", 5, seed)
        write_parquet(raw.limit(3), f"{folder}/{name}.parquet", mode="errorifexists")
        try:
            write_parquet(raw, f"{folder}/{name}.parquet", mode="errorifexists")
            refused = False
        except AnalysisException:
            refused = True
        write_parquet(raw, f"{folder}/{name}.parquet")
        part = read_interactions(spark, f"{folder}/{name}.parquet", "user_id", "track_id", "count").select(
            "*", F.lit(refused).alias("refused"), F.lit(name).alias("name"))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


_PART_COLUMNS = "CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size"


@register("csv_json_roundtrip", f"SELECT 'csv' AS kind, {_PART_COLUMNS} FROM part UNION ALL SELECT 'json', {_PART_COLUMNS} FROM part")
def q_csv_json_roundtrip(spark, sf_dir):
    """Part table through CSV with a DDL schema and through JSON (A2, A3)."""
    from implicit_rank.session import shared_folder
    from implicit_rank.sources.fixtures import read_table
    from implicit_rank.sources.io import read_csv, read_json
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    folder, ddl = shared_folder(spark, "text"), "p_partkey BIGINT, p_name STRING, p_brand STRING, p_size BIGINT"
    part.write.option("header", True).csv(f"{folder}/csv")
    part.write.json(f"{folder}/json")
    both = read_csv(spark, f"{folder}/csv", ddl, header=True).withColumn("kind", F.lit("csv")).unionByName(
        read_json(spark, f"{folder}/json").withColumn("kind", F.lit("json")))
    return rounded(both.select("kind", "p_partkey", "p_name", "p_brand", "p_size"))


# -- splits, nulls and repeats ------------------------------------------------

WEIGHTS = {"train": 0.8, "val": 0.2}


@register("subsample_80_20", _with(f"p AS ({O.PURCHASES})", _TOP_SQL)
          + f"""\nSELECT user_id, item_id, CASE WHEN CAST('0x' || substr({O.md5_of('user_id', 'item_id', seed=SEED)}, 1, 12) AS BIGINT)
  < {round(0.8 * 2**48)} THEN 'train' ELSE 'val' END AS split FROM p WHERE user_id IN (SELECT user_id FROM top)""")
def q_subsample_80_20(spark, sf_dir):
    """The coded subsample: top users split 80/20."""
    from implicit_rank.operators.sample import subsample_topk
    sub = subsample_topk(written(purchases(spark, sf_dir), "purchases"), TOP_USERS, SEED, weights=WEIGHTS)
    return sub.select("user_id", "item_id", "split")


@register("preprocess_splits", _with(
    f"e AS ({O.EVENTS})", f"s AS (SELECT user_id, item_id, cnt, {O.split_expr(SEED)} AS split FROM e WHERE cnt >= {MIN_COUNT})")
    + "\nSELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM s GROUP BY split")
def q_preprocess_splits(spark, sf_dir):
    """The preprocessing job's table, written by split and read back."""
    from implicit_rank.operators.prep import preprocess
    from implicit_rank.session import shared_folder
    from implicit_rank.sources.io import write_parquet
    ev = written(_event_splits(spark, sf_dir), "events", ["split"])
    given = {name: ev.where(F.col("split") == name) for name in ("train", "val", "test")}
    path = write_parquet(preprocess(given, MIN_COUNT), shared_folder(spark, "processed"), partition_by=["split"])
    return spark.read.parquet(path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_idx").alias("n_users"), F.countDistinct("item_idx").alias("n_items"))


_NULLED = "SELECT user_id, item_id, CASE WHEN (user_id + item_id) % 5 <> 0 THEN cnt END AS cnt FROM p"


@register("bias_null_counts", _with(
    f"p AS ({O.PURCHASES})", f"x AS ({_NULLED})", "m AS (SELECT avg(cnt) AS mu FROM x)",
    f"bi AS (SELECT item_id, coalesce(sum(cnt - mu), 0) / (count(*) + {ITEM_DAMPING}) AS b_i, count(*) AS n FROM x, m GROUP BY item_id)",
    f"""bu AS (SELECT user_id, coalesce(sum(cnt - mu - b_i), 0) / (count(*) + {USER_DAMPING}) AS b_u, count(*) AS n
  FROM x JOIN bi USING (item_id), m GROUP BY user_id)""")
    + f"\nSELECT 'item' AS kind, item_id AS id, {O.r6('b_i')} AS offset_value, n FROM bi"
    + f"\nUNION ALL SELECT 'user', user_id, {O.r6('b_u')}, n FROM bu UNION ALL SELECT 'mean', CAST(0 AS BIGINT), {O.r6('mu')}, CAST(0 AS BIGINT) FROM m")
def q_bias_null_counts(spark, sf_dir):
    """Null counts have no residual and count in the damped denominators (AG1, AG3-AG5)."""
    pairs = written(purchases(spark, sf_dir), "purchases")
    cnt = F.when((F.col("user_id") + F.col("item_id")) % 5 != 0, F.col("cnt"))
    m = fit_bias(pairs.withColumn("cnt", cnt), default_bias())
    items = m.item_offsets.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("b_i").alias("offset_value"),
                                  F.col("n_i").alias("n"))
    users = m.user_offsets.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("b_u").alias("offset_value"),
                                  F.col("n_u").alias("n"))
    zero = F.lit(0).cast("bigint")
    mean = m.stats.select(F.lit("mean").alias("kind"), zero.alias("id"), F.col("mu").alias("offset_value"), zero.alias("n"))
    return rounded(items.unionByName(users).unionByName(mean))


_REPEATED = "reps AS (SELECT * FROM test UNION ALL SELECT * FROM test WHERE item_id % 2 = 0)"


@register("metrics_repeated_truth", _with(
    O.base_ctes(SEED, O.EVENTS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K), _REPEATED,
    O.metrics_ctes(K, "recs", "reps"), O.lenient_ctes(K, "recs", "reps"),
    "a AS (" + O.metrics_select() + ")", "b AS (" + O.lenient_select() + ")")
    + "\nSELECT a.*, b.precision_lk, b.recall_lk, b.ndcg_lk, b.map_manual FROM a, b")
def q_metrics_repeated_truth(spark, sf_dir):
    """Repeated truth rows: relevance is a set, gains of an item add up (K1-K8)."""
    recs, test = _event_recs(spark, sf_dir)
    truth = written(test.unionByName(test.where("item_id % 2 = 0")), "truth")
    recs = written(recs, "recs")
    lenient = lenient_metrics(recs, truth, K).drop("n_users")
    return rounded(ranking_metrics(recs, truth, K).join(F.broadcast(lenient)))  # one row each


@register("null_lists", _with(O.base_ctes(SEED))
          + "\nSELECT c_custkey AS user_id, (SELECT count(*) FROM test WHERE user_id = c_custkey) AS n_items FROM customer")
def q_null_lists(spark, sf_dir):
    """Customers without test items get an empty list, not a null one (AG9, G2)."""
    from implicit_rank.functions.arrays import empty_if_null, ranked_lists
    from implicit_rank.operators.rank import top_k_per_user
    from implicit_rank.sources.fixtures import read_table
    _, test = train_test(spark, sf_dir)
    lists = ranked_lists(top_k_per_user(test, 1 << 30, [F.desc("cnt"), F.asc("item_id")]))
    every = read_table(spark, sf_dir, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id"))
    return every.join(lists, "user_id", "left").select(
        "user_id", F.size(empty_if_null("items")).cast("bigint").alias("n_items"))


# -- every k, large catalogue, sweeps ----------------------------------------

K_CURVE = 500


@register("metrics_k_curve", _with(
    O.base_ctes(SEED, O.EVENTS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K_CURVE),
    "nt AS (SELECT user_id, count(DISTINCT item_id) AS n FROM test GROUP BY user_id)",
    """h AS (SELECT r.user_id, r.rnk, row_number() OVER (PARTITION BY r.user_id ORDER BY r.rnk) AS h
  FROM recs r JOIN (SELECT DISTINCT user_id, item_id FROM test) t ON t.user_id = r.user_id AND t.item_id = r.item_id)""",
    f"""ks AS (SELECT unnest(range(1, {K_CURVE} + 1)) AS k)""",
    "ideal AS (SELECT a.k, sum(1 / log2(b.k + 1)) AS idcg FROM ks a JOIN ks b ON b.k <= a.k GROUP BY a.k)",
    """cell AS (SELECT ks.k, nt.user_id, any_value(nt.n) AS n, count(h.h) AS hits, coalesce(sum(h.h / h.rnk), 0) AS ap,
    coalesce(sum(1 / log2(h.rnk + 1)), 0) AS dcg
  FROM ks CROSS JOIN nt LEFT JOIN h ON h.user_id = nt.user_id AND h.rnk <= ks.k GROUP BY ks.k, nt.user_id)""")
    + f"""\nSELECT cell.k, count(*) AS n_users, {O.r6('avg(hits / cell.k)')} AS precision_at_k, {O.r6('avg(hits / n)')} AS recall_at_k,
  {O.r6('avg(ap / n)')} AS map, {O.r6('avg(ap / least(n, cell.k))')} AS map_at_k, {O.r6('avg(dcg / idcg)')} AS ndcg_at_k
FROM cell JOIN ideal ON ideal.k = least(cell.n, cell.k) GROUP BY cell.k""")
def q_metrics_k_curve(spark, sf_dir):
    """Metrics at every k from 1 to 500 in one pass over lists of length 500."""
    train, test = _event_train_test(spark, sf_dir)
    recs = fit_bias(train, default_bias()).recommend(test.select("user_id"), train, K_CURVE, scores=False)
    return rounded(metrics_by_k(recs, test, K_CURVE))


@register("metrics_lenient_curve", _with(
    O.base_ctes(SEED, O.EVENTS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K_CURVE),
    "nr AS (SELECT user_id, count(*) AS n FROM recs GROUP BY user_id)",
    """tr AS (SELECT user_id, item_id, CAST(cnt AS DOUBLE) AS gain, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, item_id) AS pos FROM test)""",
    "nt AS (SELECT user_id, count(*) AS m FROM tr GROUP BY user_id)",
    "h AS (SELECT r.user_id, r.rnk, tr.gain FROM recs r JOIN tr ON tr.user_id = r.user_id AND tr.item_id = r.item_id)",
    f"ks AS (SELECT unnest(range(1, {K_CURVE} + 1)) AS k)",
    """found AS (SELECT ks.k, nr.user_id, count(h.rnk) AS hits, coalesce(sum(h.gain / greatest(log2(h.rnk), 1)), 0) AS dcg
  FROM ks CROSS JOIN nr LEFT JOIN h ON h.user_id = nr.user_id AND h.rnk <= ks.k GROUP BY ks.k, nr.user_id)""",
    """ideal AS (SELECT ks.k, tr.user_id, sum(tr.gain / greatest(log2(tr.pos), 1)) AS idcg
  FROM ks JOIN tr ON tr.pos <= ks.k GROUP BY ks.k, tr.user_id)""",
    """pu AS (SELECT f.k, f.user_id, f.hits / least(nr.n, f.k) AS p, f.hits / least(nt.m, f.k) AS r,
    CASE WHEN i.idcg > 0 THEN f.dcg / i.idcg ELSE 0 END AS g
  FROM found f JOIN nr ON nr.user_id = f.user_id JOIN nt ON nt.user_id = f.user_id JOIN ideal i ON i.user_id = f.user_id AND i.k = f.k)""",
    "run AS (SELECT *, sum(p) OVER (PARTITION BY user_id ORDER BY k) / k AS a FROM pu)")
    + f"""\nSELECT k, count(*) AS n_users, {O.r6('avg(p)')} AS precision_lk, {O.r6('avg(r)')} AS recall_lk, {O.r6('avg(g)')} AS ndcg_lk,
  {O.r6('avg(a)')} AS map_manual FROM run GROUP BY k""")
def q_metrics_lenient_curve(spark, sf_dir):
    """Lenient metrics at every k from 1 to 500 in one pass over lists of length 500."""
    train, test = _event_train_test(spark, sf_dir)
    recs = fit_bias(train, default_bias()).recommend(test.select("user_id"), train, K_CURVE, scores=False)
    return rounded(lenient_by_k(recs, test, K_CURVE))


_ORDERS_AS_ITEMS = """SELECT o_custkey AS user_id, o_orderkey AS item_id, CAST(round(o_totalprice) AS BIGINT) % 97 AS cnt
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL"""


@register("bias_topk_large_catalogue", _with(
    O.base_ctes(SEED, _ORDERS_AS_ITEMS), O.bias_ctes(USER_DAMPING, ITEM_DAMPING), O.catalogue_ctes(K))
    + f"\nSELECT user_id, item_id, rnk, {O.r6('score')} AS score FROM recs")
def q_bias_topk_large_catalogue(spark, sf_dir):
    """Top-k unseen over a catalogue of all orders, with small rank buckets and head, so that
    the prefix and tail branches carry rows at every size (J9)."""
    from implicit_rank.operators.rank import catalogue_topk
    from implicit_rank.sources.fixtures import read_table
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderkey", "o_totalprice"]).where(
        "o_custkey IS NOT NULL AND o_orderkey IS NOT NULL")
    pairs = orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("item_id"),
                          (F.round("o_totalprice").cast("bigint") % 97).alias("cnt"))
    s = written(hash_split(pairs, SEED), "order-splits", ["split"])
    cols = ["user_id", "item_id", "cnt"]
    train, test = s.where("split = 'train'").select(*cols), s.where("split = 'test'").select(*cols)
    m = fit_bias(train, default_bias())
    recs = catalogue_topk(m.item_order(), train, test.select("user_id"), K, bucket_rows=64, head_rows=4, carry=("b_i",))
    return rounded(m.with_scores(recs))


def _fold_bias_sql() -> str:
    ctes, parts = [f"p AS ({O.PURCHASES})", _FOLDS_SQL], []
    for f in range(N_FOLDS):
        x = f"f{f}_"
        ctes += [f"{x}train AS (SELECT user_id, item_id, cnt FROM f WHERE NOT (fold = {f} AND holdout = 1))",
                 f"{x}test AS (SELECT user_id, item_id, cnt FROM f WHERE fold = {f} AND holdout = 1)",
                 O.bias_ctes(USER_DAMPING, ITEM_DAMPING, src=f"{x}train", prefix=x),
                 O.catalogue_ctes(K, prefix=x, seen=f"{x}train", truth=f"{x}test"),
                 O.metrics_ctes(K, f"{x}recs", f"{x}test", prefix=f"{x}m_"),
                 O.lenient_ctes(K, f"{x}recs", f"{x}test", prefix=f"{x}l_")]
        wide = ", ".join(f"{O.r6(f'avg(a.{c})')} AS {c}" for c in ("precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k"))
        loose = ", ".join(f"{O.r6(f'avg(b.{c})')} AS {c}" for c in ("precision_lk", "recall_lk", "ndcg_lk", "map_manual"))
        parts.append(f"SELECT CAST({f + 1} AS BIGINT) AS run_id, 'fold{f}' AS dataset, count(*) AS n_users, {wide}, {loose} "
                     f"FROM {x}m_pu a JOIN {x}l_pu b ON b.user_id = a.user_id")
    return _with(*ctes) + "\n" + "\nUNION ALL\n".join(parts)


@register("bias_fold_sweep", _fold_bias_sql())
def q_bias_fold_sweep(spark, sf_dir):
    """Bias model over user folds by the sweep: both families of metrics per run, attributes
    from the run log that the sweep wrote (I5, L3-L5, K5-K9, C7, AG10, A13)."""
    from implicit_rank.operators.metrics import LENIENT_COLUMNS, METRIC_COLUMNS
    from implicit_rank.operators.sample import fold_test, fold_train
    from implicit_rank.plans.tune import (Algorithm, bias_fitter, read_recs, read_run_log, run_lenient_metrics, run_metrics,
                                          sweep)
    from implicit_rank.session import shared_folder
    folds = written(_folds(spark, sf_dir), "folds")
    cols = ["user_id", "item_id", "cnt"]
    datasets = {f"fold{f}": (fold_train(folds, f).select(*cols), fold_test(folds, f).select(*cols)) for f in range(N_FOLDS)}
    algs = [Algorithm("Bias", {"user_damping": USER_DAMPING, "item_damping": ITEM_DAMPING}, bias_fitter(default_bias()))]
    folder = shared_folder(spark, "fold-sweep")
    sweep(spark, datasets, algs, K, folder, parallelism=SWEEP_PARALLELISM)
    log, recs = read_run_log(spark, f"{folder}/runs.csv"), read_recs(spark, f"{folder}/recs")
    truths = {n: t for n, (_, t) in datasets.items()}
    strict = run_metrics(log, recs, truths, K).select("run_id", "dataset", "user_id", *METRIC_COLUMNS)
    loose = run_lenient_metrics(log, recs, truths, K).select("run_id", "user_id", *LENIENT_COLUMNS)
    both = strict.join(loose, ["run_id", "user_id"])
    return rounded(both.groupBy(F.col("run_id").cast("bigint").alias("run_id"), "dataset").agg(
        F.count(F.lit(1)).alias("n_users"), *[F.avg(c).alias(c) for c in (*METRIC_COLUMNS, *LENIENT_COLUMNS)]))


@register("subsample_sizes", _with(f"p AS ({O.PURCHASES})",
          "act AS (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) AS place, count(*) AS n FROM p GROUP BY user_id)")
          + "\nSELECT CAST(k AS BIGINT) AS top_users, CAST(sum(n) AS BIGINT) AS n_rows FROM act, (VALUES (10), (100), (1000), (10000)) v(k) "
            "WHERE place <= k GROUP BY k")
def q_subsample_sizes(spark, sf_dir):
    """Rows of the top-k-user subsamples at the sizes of the fit-time study."""
    from implicit_rank.operators.sample import top_user_interactions
    data = written(purchases(spark, sf_dir), "purchases")
    out = None
    for n in TOP_SIZES:
        part = top_user_interactions(data, n).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).cast("bigint").alias("top_users"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out
