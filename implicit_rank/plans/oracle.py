"""SQL text of the oracle: the same results written as plain SQL over the
driver's tables (runs in DuckDB and other engines with md5 and window
functions). Written independently of the DataFrame plans: where the plans
use a scalable trick (gap counting for top-k unseen, two-level numbering,
one-pass manual MAP), the SQL uses the direct definition.

Fragments are composed into ``WITH`` clauses by ``plans.catalog``.
"""

from __future__ import annotations

from implicit_rank.functions.hashing import TRAIN_BELOW, VAL_BELOW

PURCHASES = """
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, sum(l.l_quantity) AS cnt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_partkey IS NOT NULL AND o.o_custkey IS NOT NULL
  GROUP BY o.o_custkey, l.l_partkey"""

EVENTS = """
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         count(*) AS cnt
  FROM events
  WHERE user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL
  GROUP BY user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)"""


def md5_of(*parts: str, seed: int) -> str:
    items = ", ".join([f"CAST({p} AS VARCHAR)" for p in parts] + [f"'{seed}'"])
    return f"md5(concat_ws('|', {items}))"


def split_expr(seed: int, user: str = "user_id", item: str = "item_id") -> str:
    prefix = f"substr({md5_of(user, item, seed=seed)}, 1, 2)"
    return (f"CASE WHEN {prefix} < '{TRAIN_BELOW}' THEN 'train' "
            f"WHEN {prefix} < '{VAL_BELOW}' THEN 'val' ELSE 'test' END")


def base_ctes(seed: int, source: str = PURCHASES) -> str:
    """p (all pairs), s (with split), train, val, test."""
    return f"""
p AS ({source}),
s AS (SELECT user_id, item_id, cnt, {split_expr(seed)} AS split FROM p),
train AS (SELECT user_id, item_id, cnt FROM s WHERE split = 'train'),
val AS (SELECT user_id, item_id, cnt FROM s WHERE split = 'val'),
test AS (SELECT user_id, item_id, cnt FROM s WHERE split = 'test')"""


def exact_sum(expr: str) -> str:
    """A sum that does not depend on the order of its rows, as DOUBLE."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,12))) AS DOUBLE)"


def bias_ctes(user_damping: float, item_damping: float, src: str = "train", prefix: str = "",
              item: bool = True, users: bool = True) -> str:
    """{prefix}st (mu), {prefix}bi (item_id, b_i, n_i), {prefix}bu (user_id, b_u, n_u)."""
    st, bi, bu = f"{prefix}st", f"{prefix}bi", f"{prefix}bu"
    mu = f"(SELECT mu FROM {st})"
    if item:
        bi_sql = f"""{bi} AS (SELECT item_id,
      coalesce(({exact_sum('cnt')} - count(cnt) * {mu}) / (count(*) + CAST({item_damping} AS DOUBLE)), 0) AS b_i,
      count(*) AS n_i
    FROM {src} GROUP BY item_id)"""
        bi_term = f"coalesce({bi}.b_i, 0)"
        bi_join = f"LEFT JOIN {bi} ON {bi}.item_id = x.item_id"
    else:
        bi_sql = f"{bi} AS (SELECT item_id, CAST(0 AS DOUBLE) AS b_i, count(*) AS n_i FROM {src} GROUP BY item_id)"
        bi_term, bi_join = "0", ""
    bu_sql = f"""{bu} AS (SELECT x.user_id,
      coalesce(({exact_sum('x.cnt')} - count(x.cnt) * {mu} - sum(CASE WHEN x.cnt IS NOT NULL THEN {bi_term} END))
        / (count(*) + CAST({user_damping} AS DOUBLE)), 0) AS b_u,
      count(*) AS n_u
    FROM {src} x {bi_join} GROUP BY x.user_id)"""
    if not users:
        bu_sql = f"{bu} AS (SELECT user_id, CAST(0 AS DOUBLE) AS b_u, count(*) AS n_u FROM {src} GROUP BY user_id)"
    return f"""
{st} AS (SELECT {exact_sum('cnt')} / count(cnt) AS mu FROM {src}),
{bi_sql},
{bu_sql}"""


def catalogue_ctes(k: int, prefix: str = "", seen: str = "train", truth: str = "test") -> str:
    """{prefix}recs (user_id, item_id, rnk, score): top-k unseen by the direct
    definition: candidates are global ranks 1..k+n_seen, minus seen, renumbered."""
    p = prefix
    return f"""
{p}ord AS (SELECT item_id, b_i, row_number() OVER (ORDER BY b_i DESC, item_id) AS r FROM {p}bi),
{p}users AS (SELECT DISTINCT user_id FROM {truth}),
{p}nseen AS (SELECT u.user_id, count(t.item_id) AS n FROM {p}users u LEFT JOIN {seen} t ON t.user_id = u.user_id GROUP BY u.user_id),
{p}slots AS (SELECT user_id, unnest(range(1, n + {k} + 1)) AS pos FROM {p}nseen),
{p}cand AS (
  SELECT sl.user_id, o.item_id, o.r, o.b_i FROM {p}slots sl JOIN {p}ord o ON o.r = sl.pos
  WHERE NOT EXISTS (SELECT 1 FROM {seen} t WHERE t.user_id = sl.user_id AND t.item_id = o.item_id)),
{p}recs0 AS (SELECT user_id, item_id, b_i, row_number() OVER (PARTITION BY user_id ORDER BY r) AS rnk FROM {p}cand),
{p}recs AS (
  SELECT c.user_id, c.item_id, c.rnk,
         (SELECT mu FROM {p}st) + c.b_i + coalesce(u.b_u, 0) AS score
  FROM {p}recs0 c LEFT JOIN {p}bu u ON u.user_id = c.user_id
  WHERE c.rnk <= {k})"""


def metrics_ctes(k: int, recs: str, truth: str, prefix: str = "m_", include_missing: bool = True) -> str:
    """{prefix}pu: per-user metrics of Spark's definitions."""
    p = prefix
    join = "LEFT JOIN" if include_missing else "JOIN"
    return f"""
{p}nt AS (SELECT user_id, count(DISTINCT item_id) AS n_truth FROM {truth} GROUP BY user_id),
{p}nr AS (SELECT user_id, count(*) AS n_recs FROM {recs} WHERE rnk <= {k} GROUP BY user_id),
{p}hits AS (
  SELECT r.user_id, r.rnk, row_number() OVER (PARTITION BY r.user_id ORDER BY r.rnk) AS h
  FROM {recs} r WHERE r.rnk <= {k}
    AND EXISTS (SELECT 1 FROM {truth} t WHERE t.user_id = r.user_id AND t.item_id = r.item_id)),
{p}ha AS (SELECT user_id, count(*) AS n_hits, sum(h / rnk) AS prec_sum, sum(1 / log2(rnk + 1)) AS dcg
          FROM {p}hits GROUP BY user_id),
{p}pu AS (
  SELECT nt.user_id, nt.n_truth, coalesce(nr.n_recs, 0) AS n_recs, coalesce(ha.n_hits, 0) AS n_hits,
         coalesce(ha.n_hits, 0) / {k} AS precision_at_k,
         coalesce(ha.n_hits, 0) / nt.n_truth AS recall_at_k,
         coalesce(ha.prec_sum, 0) / nt.n_truth AS map,
         coalesce(ha.prec_sum, 0) / least(nt.n_truth, {k}) AS map_at_k,
         coalesce(ha.dcg, 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(nt.n_truth, {k}) + 1) g(i))
           AS ndcg_at_k
  FROM {p}nt nt {join} {p}nr nr ON nr.user_id = nt.user_id LEFT JOIN {p}ha ha ON ha.user_id = nt.user_id)"""


def r6(expr: str) -> str:
    """Rounded to 6 places; ``+ 0.0`` turns a -0.0 into 0.0 (they hash differently)."""
    return f"(round({expr}, 6) + CAST(0 AS DOUBLE))"


def metrics_select(prefix: str = "m_", extra: str = "") -> str:
    cols = ", ".join(f"{r6(f'avg({c})')} AS {c}"
                     for c in ("precision_at_k", "recall_at_k", "map", "map_at_k", "ndcg_at_k"))
    return f"SELECT {extra}count(*) AS n_users, {cols}\nFROM {prefix}pu"


def lenient_ctes(k: int, recs: str, truth: str, prefix: str = "l_") -> str:
    """{prefix}pu: per-user lenient metrics by their direct definitions
    (manual MAP as the mean over t=1..k of precision@t)."""
    p = prefix
    return f"""
{p}truth AS (SELECT user_id, item_id, coalesce(sum(CAST(cnt AS DOUBLE)), 0) AS cnt FROM {truth} GROUP BY user_id, item_id),
{p}r AS (SELECT user_id, item_id, rnk FROM {recs} WHERE rnk <= {k}),
{p}nr AS (SELECT user_id, count(*) AS n_recs FROM {p}r GROUP BY user_id),
{p}nt AS (SELECT user_id, count(*) AS n_truth FROM {p}truth GROUP BY user_id),
{p}hits AS (SELECT r.user_id, r.rnk, CAST(t.cnt AS DOUBLE) AS gain
            FROM {p}r r JOIN {p}truth t ON t.user_id = r.user_id AND t.item_id = r.item_id),
{p}ideal AS (
  SELECT user_id, sum(gain / greatest(log2(pos), 1)) AS idcg FROM (
    SELECT user_id, CAST(cnt AS DOUBLE) AS gain,
           row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, item_id) AS pos FROM {p}truth)
  WHERE pos <= {k} GROUP BY user_id),
{p}ptab AS (
  SELECT nr.user_id, g.t,
         (SELECT count(*) FROM {p}hits h WHERE h.user_id = nr.user_id AND h.rnk <= g.t)
           / least(g.t, nr.n_recs) AS p_at_t
  FROM {p}nr nr, range(1, {k} + 1) g(t)),
{p}pu AS (
  SELECT nr.user_id,
         coalesce(hs.n_hits, 0) / least(nr.n_recs, {k}) AS precision_lk,
         coalesce(hs.n_hits, 0) / least(nt.n_truth, {k}) AS recall_lk,
         CASE WHEN id.idcg > 0 THEN coalesce(hs.dcg, 0) / id.idcg ELSE 0 END AS ndcg_lk,
         (SELECT sum(p_at_t) FROM {p}ptab pt WHERE pt.user_id = nr.user_id) / {k} AS map_manual
  FROM {p}nr nr JOIN {p}nt nt ON nt.user_id = nr.user_id
  LEFT JOIN (SELECT user_id, count(*) AS n_hits, sum(gain / greatest(log2(rnk), 1)) AS dcg
             FROM {p}hits GROUP BY user_id) hs ON hs.user_id = nr.user_id
  LEFT JOIN {p}ideal id ON id.user_id = nr.user_id)"""


def lenient_select(prefix: str = "l_", extra: str = "") -> str:
    cols = ", ".join(f"{r6(f'avg({c})')} AS {c}" for c in ("precision_lk", "recall_lk", "ndcg_lk", "map_manual"))
    return f"SELECT {extra}count(*) AS n_users, {cols}\nFROM {prefix}pu"
