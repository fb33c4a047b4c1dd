"""The registered queries of this subpackage: op<N>_<name> and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from implicit_rank.llm import (adscan, arrowfile, common, gam, imatch, langid, merkle, pack, pcatiles, pivotal, simhash, spelling,
                               tokens, toxicity, warc)


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every text and of its edited text, with their likeness."""
    docs = common.table(spark, sf_dir, "documents")
    return imatch.compare_edits(docs, imatch.lexicon(docs))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit among the captures derived from all pages, with its response."""
    found = warc.resolve(warc.captures(common.table(spark, sf_dir, "pages")))
    names = ["content-type", "cache-control", "date"]
    return found.select("record_id", "url_key", "response_id", "outcome",
                        *(F.element_at("headers", n).alias(n.replace("-", "_")) for n in names))


OP2_SQL = r"""
WITH c AS (
  SELECT page_id, url, html, '"' || md5(coalesce(html, '')) || '"' AS whole,
         CASE WHEN page_id % 5 <> 0 THEN '"' || md5(coalesce(html, '')) || '"' END AS tag,
         CAST(page_id % 28 AS VARCHAR) AS day FROM pages),
records AS (
  SELECT page_id * 8 AS record_id, url, page_id * 100 - 7 AS ts, 'revisit' AS kind, tag AS etag, day AS modified, 0 AS n
    FROM c WHERE page_id % 4 = 1
  UNION ALL SELECT page_id * 8 + 1, url, page_id * 100, 'response', tag, day, 1 FROM c
  UNION ALL SELECT page_id * 8 + 2, url || '#again', page_id * 100 + 5, 'revisit', 'W/' || tag, day, 2 FROM c
  UNION ALL SELECT page_id * 8 + 3, url || '#again', page_id * 100 + 10, 'response',
                   '"2' || md5(coalesce(html, '')) || '"', 'again', 3 FROM c WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 8 + 4, url, page_id * 100 + 15, 'revisit', tag, day, 4 FROM c WHERE page_id % 3 = 0),
bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM records),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '^[^/?]*', ''),
         '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&', '?', 'g'), '[?&/]+$', '') AS url_key FROM bare),
pairs AS (
  SELECT v.record_id, v.url_key, v.etag, v.modified, v.n, v.ts, r.record_id AS response_id, r.etag AS r_etag, r.modified AS r_modified,
         row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC) AS place
  FROM keyed v LEFT JOIN keyed r ON r.url_key = v.url_key AND r.kind = 'response' AND r.ts < v.ts
  WHERE v.kind = 'revisit'),
checked AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL AND r_etag IS NOT NULL
      THEN CASE WHEN regexp_replace(etag, '^W/', '') = r_etag THEN 'resolved' ELSE 'etag_differs' END
    WHEN modified = r_modified THEN 'resolved' ELSE 'modified_differs' END AS outcome
  FROM pairs WHERE place = 1)
SELECT record_id, url_key, CASE WHEN outcome = 'resolved' THEN response_id END AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
       CASE WHEN outcome = 'resolved' THEN 'max-age=' || n END AS cache_control,
       CASE WHEN outcome = 'resolved' THEN CAST(ts AS VARCHAR) END AS date
FROM checked"""


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id 20 divides."""
    vectors = common.table(spark, sf_dir, "embeddings")
    return adscan.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op4_pack_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of 4096-token sequences."""
    docs = common.table(spark, sf_dir, "documents")
    return pack.pack(docs, tokens.vocabulary("word_bpe_49k.json"), seq_len=4096, end_id=2)


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; fold 2 of 4 by crc32 is held out."""
    docs = common.table(spark, sf_dir, "documents")
    model = gam.learn(docs, common.table(spark, sf_dir, "labels"))
    return _decided(gam.predict(docs, model), gam.THRESHOLD)


def op6_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.groups(common.table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_mix_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of sources takes."""
    mixed = pivotal.mix(common.table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, limit=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to Arrow files and read back."""
    docs = common.table(spark, sf_dir, "documents")
    return arrowfile.read(spark, arrowfile.write(docs, tokens.vocabulary("byte_bpe_50k.json"), seq_len=2048, end_id=2))


def op9_lang_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fold 1 of 3 by crc32 is held out."""
    docs = common.table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(F.col("doc_id").isNotNull() & (common.crc_fold("doc_id", 3) != 1)))
    held_out = F.coalesce(common.crc_fold("doc_id", 3) == 1, F.lit(False))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 2 of 4 by crc32 is held out."""
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, common.table(spark, sf_dir, "labels"))
    return _decided(toxicity.predict(docs, model), toxicity.THRESHOLD)


def op11_merkle_witness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves of all documents with their proofs; a third has its text lower-cased and is checked."""
    docs = common.table(spark, sf_dir, "documents")
    cells = {name: F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    shown = F.when(common.crc_fold("doc_id", 3) == 0, tampered).otherwise(F.col("text"))
    rows = docs.select("doc_id", "lang", merkle.leaf(*cells.values()).alias("leaf"), merkle.leaf(*(cells | {"text": shown}).values()).alias("shown"))
    found = merkle.check(merkle.manifest(rows, tree="lang", order=["doc_id"]), digest="shown")
    hexed = (F.lower(F.hex(c)).alias(name) for c, name in (("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"),
                                                           ("proof", "proof_sha256"), ("folded", "folded_root")))
    return found.select("doc_id", *hexed, "verified")


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes: a byte is mixed in, then shifted out bit by bit."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT)"
    steps = f"flatten(list_transform(range(1, strlen({text}) + 1), lambda i: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295], {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)"
            " ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)")


def _leaf_sql(text: str) -> str:
    cells = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
             for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(cells)})"


_LOWER_SQL = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_SIBLINGS_SQL = """coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"""

OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('text')} AS leaf, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0
    THEN {_leaf_sql(_LOWER_SQL)} ELSE {_leaf_sql('text')} END AS shown FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM numbered
  UNION ALL SELECT tree, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1
    GROUP BY tree, lvl, pos // 8, n),
trees AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM nodes WHERE n = 1),
tops AS (
  SELECT '' AS tree, 0 AS lvl, place AS pos, trees AS n, subroot AS h FROM trees
  UNION ALL SELECT tree, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1
    GROUP BY tree, lvl, pos // 8, n),
low AS (SELECT tree, lvl, pos, {_SIBLINGS_SQL} FROM nodes WHERE n > 1),
high AS (SELECT tree, lvl, pos, {_SIBLINGS_SQL} FROM tops WHERE n > 1),
path AS (
  SELECT v.tree, v.pos, s.lvl, s.l, s.r FROM numbered v JOIN low s ON s.tree = v.tree AND s.pos = v.pos // CAST(pow(8, s.lvl) AS BIGINT)
  UNION ALL SELECT v.tree, v.pos, 1000 + s.lvl, s.l, s.r FROM numbered v JOIN trees t ON t.tree = v.tree
    JOIN high s ON s.pos = t.place // CAST(pow(8, s.lvl) AS BIGINT)),
steps AS (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY lvl) AS step FROM path),
folds AS (
  SELECT tree, pos, 0 AS step, shown AS h FROM numbered
  UNION ALL SELECT f.tree, f.pos, f.step + 1, sha256(s.l || f.h || s.r) FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step + 1),
folded AS (SELECT tree, pos, arg_max(h, step) AS folded_root FROM folds GROUP BY tree, pos),
proofs AS (SELECT tree, pos, string_agg(l || r, '' ORDER BY step) AS siblings FROM steps GROUP BY tree, pos)
SELECT v.doc_id, v.leaf, t.subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.folded_root, f.folded_root = (SELECT h FROM tops WHERE n = 1) AS verified
FROM numbered v JOIN trees t USING (tree) JOIN folded f USING (tree, pos) LEFT JOIN proofs p USING (tree, pos)"""


def op12_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent word one edit away that each may be a variant of."""
    return spelling.variants(common.table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER_SQL}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM counted),
written AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT DISTINCT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places),
shorter AS (SELECT DISTINCT g.word, w.word AS near FROM gaps g JOIN words w ON w.word = g.head || g.tail),
near AS (
  SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT word, near FROM shorter UNION SELECT near, word FROM shorter),
ranked AS (
  SELECT p.word, p.near, w.n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM near p JOIN words w ON w.word = p.near),
forms AS (
  SELECT w.word, CASE WHEN r.n >= 2 * w.n THEN r.near END AS form, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chains AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def op13_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95 or more, and their components."""
    return pcatiles.near_duplicates(common.table(spark, sf_dir, "embeddings"), threshold=0.95)


OP13_SQL = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM rows
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.k, b.k AS other FROM usable a JOIN usable b ON a.k <> b.k AND len(a.v) = len(b.v)
    AND list_inner_product(a.v, b.v) >= 0.95 * a.norm * b.norm),
counts AS (SELECT k, count(*) AS n FROM links GROUP BY k),
reached AS (SELECT k, other FROM links UNION SELECT r.k, l.other FROM reached r JOIN links l ON l.k = r.other),
least AS (SELECT k, min(vec_id) AS least FROM (SELECT k, vec_id FROM rows UNION ALL SELECT r.k, o.vec_id FROM reached r JOIN rows o ON o.k = r.other) GROUP BY k)
SELECT vec_id, coalesce(n, 0) AS n_links, least AS component_id, vec_id IS NOT DISTINCT FROM least AS kept
FROM rows LEFT JOIN counts USING (k) JOIN least USING (k)"""


def _decided(scored: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score and the decision at the threshold."""
    held_out = F.coalesce(common.crc_fold("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


QUERIES = {
    "op1_imatch": op1_imatch,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_adaptive_scan": op3_adaptive_scan,
    "op4_pack_concat_cut": op4_pack_concat_cut,
    "op5_quality_gam": op5_quality_gam,
    "op6_simhash_ball": op6_simhash_ball,
    "op7_mix_pivotal": op7_mix_pivotal,
    "op8_arrow_tokens": op8_arrow_tokens,
    "op9_lang_viterbi": op9_lang_viterbi,
    "op10_toxicity_grammar": op10_toxicity_grammar,
    "op11_merkle_witness": op11_merkle_witness,
    "op12_spelling_trie": op12_spelling_trie,
    "op13_pca_tiles": op13_pca_tiles,
}
ORACLE: dict[str, str] = {"op2_warc_revisits": OP2_SQL, "op11_merkle_witness": OP11_SQL, "op12_spelling_trie": OP12_SQL,
                          "op13_pca_tiles": OP13_SQL}
