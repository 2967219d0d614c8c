"""The queries of the numbered operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, htmltext, jaccard, langid, lempelziv, merkle, neardup, pieces, quality, secrets, toxicity, warc, whitening
from .base import fold, table

def held_out() -> Column:
    return (fold(F.col("doc_id")) == 0).alias("held_out")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out()), id_col="doc_id")
    return langid.identify(docs, model, keep=(F.col("doc_id"), held_out()))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.resolve(warc.captures(table(spark, sf_dir, "pages"))))


def op3_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return quality.score(docs, model, F.col("doc_id"), held_out())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digests(secrets.find_secrets(docs, owner="source", repo=F.concat_ws("/", "source", "lang")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes it again, and says whether the text came back."""
    vocabulary = pieces.load()
    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    both = pieces.encode(table(spark, sf_dir, "documents"), vocabulary, F.col("doc_id"), text_hash, decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), (F.xxhash64("decoded") == F.col("text_hash")).alias("exact"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.cluster(table(spark, sf_dir, "documents"), size=4, share=85)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.train(pages), F.col("page_id"), F.col("url"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, F.col("doc_id"), held_out())


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.with_verdict(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.components(rows, whitening.fit(rows, "embedding", scale=64, shift=1_000_000), "embedding", F.col("vec_id"))


def op12_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts, and of what they become when their last third gives way to the beginning of the next document."""
    return lempelziv.with_next(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = lambda n: [F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(chosen, merkle.leaf(*fields(more)))
    manifest = merkle.build(docs, fields(F.col("n_chars")), F.col("lang"), F.col("doc_id"), doc_id=F.col("doc_id"), altered=altered)
    proved = merkle.prove(manifest).withColumn("folded_root", merkle.folded(F.coalesce("altered", "leaf"), F.col("path")))
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_language_id": op1_language_id,
        "op2_warc_revisits": op2_warc_revisits,
        "op3_quality_nbsvm": op3_quality_nbsvm,
        "op4_secret_scan": op4_secret_scan,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_main_text": op7_main_text,
        "op8_toxicity": op8_toxicity,
        "op9_decontaminate": op9_decontaminate,
        "op10_embedding_neardup": op10_embedding_neardup,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_lz_fingerprint": op12_lz_fingerprint,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


OP9_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT item_id, w, least(13, len(w)) AS k FROM iw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM it)),
sizes AS (SELECT DISTINCT k FROM win),
cell AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)),
occ AS (SELECT c.doc_id, c.i, c.k, w.item_id FROM cell c JOIN win w ON c.win = w.win AND c.k = w.k),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, coalesce(t.items_sha256, sha256('')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN its t USING (doc_id)
"""




def _either_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


#: The gap before each match and the match make up the text, so summed lengths give the places.
OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
    concat_ws('/', source, lang) AS repo FROM documents),
hits AS (
  SELECT doc_id, t, owner, repo, 0 AS kind, regexp_extract_all(t, '(?s)(.*?)(({_either_case("password|passwd|secret|token|api_?key")})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 0) AS a,
    regexp_extract_all(t, '(?s)(.*?)(({_either_case("password|passwd|secret|token|api_?key")})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 2) AS m,
    regexp_extract_all(t, '(?s)(.*?)(({_either_case("password|passwd|secret|token|api_?key")})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 4) AS v FROM d
  UNION ALL SELECT doc_id, t, owner, repo, 1, regexp_extract_all(t, '(?s)(.*?)(AKIA[A-Z0-9]+)', 0), regexp_extract_all(t, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2), regexp_extract_all(t, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2) FROM d
  UNION ALL SELECT doc_id, t, owner, repo, 2, regexp_extract_all(t, '(?s)(.*?)([0-9a-f]+)', 0), regexp_extract_all(t, '(?s)(.*?)([0-9a-f]+)', 2), regexp_extract_all(t, '(?s)(.*?)([0-9a-f]+)', 2) FROM d
  UNION ALL SELECT doc_id, t, owner, repo, 3, regexp_extract_all(t, '(?s)(.*?)([A-Za-z0-9_-]+)', 0), regexp_extract_all(t, '(?s)(.*?)([A-Za-z0-9_-]+)', 2), regexp_extract_all(t, '(?s)(.*?)([A-Za-z0-9_-]+)', 2) FROM d),
each AS (SELECT doc_id, owner, repo, kind, unnest(a) AS a, unnest(m) AS m, unnest(v) AS v, generate_subscripts(a, 1) AS i FROM hits),
placed AS (SELECT *, CAST(sum(length(a)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop FROM each),
cand AS (SELECT doc_id, owner, repo, kind, stop - length(m) AS start, stop, v FROM placed
  WHERE length(v) >= CASE kind WHEN 0 THEN 6 WHEN 1 THEN 20 ELSE 24 END),
vals AS (SELECT DISTINCT v FROM cand),
bits AS (SELECT v, -sum(c / n * log2(c / n)) AS bits FROM (
  SELECT v, ch, CAST(count(*) AS DOUBLE) AS c, CAST(any_value(length(v)) AS DOUBLE) AS n
  FROM (SELECT v, unnest(string_split(v, '')) AS ch FROM vals) GROUP BY v, ch) GROUP BY v),
good AS (SELECT c.*, b.bits >= CASE c.kind WHEN 0 THEN 2.5 ELSE 3.0 END AND NOT regexp_matches(lower(c.v), 'example|sample|changeme|placeholder|your|dummy|test|xxxx|1234567|abcdef') AS random
  FROM cand c JOIN bits b USING (v) WHERE c.kind < 3 OR (regexp_matches(c.v, '[0-9]') AND lower(c.v) <> c.v AND upper(c.v) <> c.v AND b.bits >= 3.5
    AND NOT EXISTS (SELECT 1 FROM cand o WHERE o.doc_id = c.doc_id AND o.kind < 3 AND o.start < c.stop AND c.start < o.stop))),
own AS (SELECT v, count(DISTINCT owner) AS n_owners, bool_or(random) AS random FROM good GROUP BY v),
rep AS (SELECT v, count(*) AS n_repos FROM (SELECT DISTINCT v, owner, repo FROM good) GROUP BY v),
stat AS (SELECT v, CASE WHEN n_owners > 2 OR n_repos > 3 THEN 'copied' WHEN random THEN 'live' ELSE 'plain' END AS status FROM own JOIN rep USING (v)),
j AS (SELECT g.*, s.status, CASE g.kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'opaque' END || ':' || g.start || ':' || g.stop AS s FROM good g JOIN stat s USING (v))
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3 OR status = 'live'), '') AS spans,
  count(*) FILTER (status = 'copied') AS n_copied, count(*) FILTER (status = 'live') AS n_live
FROM d LEFT JOIN j USING (doc_id) GROUP BY d.doc_id
"""


OP2_SQL = r"""
WITH p AS (SELECT page_id, url, html, md5(html) AS tag, regexp_replace(regexp_replace(url, '^https?://(www\.|m\.)?', ''), '#.*$', '') AS u FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^(www|m)\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&'), ''), '') AS canonical_url FROM p),
r AS (SELECT page_id * 3 AS id, page_id, canonical_url, page_id * 10 AS t, 0 AS k, tag, html FROM c
  UNION ALL SELECT page_id * 3 + 1, page_id, canonical_url, page_id * 10 + 5, 1, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'other' ELSE tag END, NULL FROM c
  UNION ALL SELECT page_id * 3 + 2, page_id, canonical_url, page_id * 10 - 5, 1, CASE WHEN page_id % 7 = 0 THEN 'other' ELSE tag END, NULL FROM c WHERE page_id % 13 = 0),
a AS (SELECT *, last_value(CASE WHEN k = 0 THEN page_id END IGNORE NULLS) OVER (PARTITION BY canonical_url ORDER BY t, k, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src FROM r),
j AS (SELECT a.id, a.page_id, a.canonical_url, a.tag, s.page_id AS sid, s.tag AS stag, s.html AS shtml, CASE WHEN s.page_id IS NULL THEN 'missing' WHEN a.tag IS NULL THEN 'unchecked' WHEN a.tag = s.tag THEN 'resolved' ELSE 'changed' END AS outcome,
  a.id % 3 = 2 AS early FROM a LEFT JOIN c s ON a.src = s.page_id WHERE a.k = 1)
SELECT id AS record_id, canonical_url, CASE WHEN outcome IN ('resolved', 'unchecked') THEN CAST(sid * 3 AS VARCHAR) END AS source_id, outcome,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || strlen(shtml) || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || (page_id * 10 + 5)
      || chr(10) || 'etag: ' || CASE WHEN outcome = 'unchecked' THEN stag ELSE 'W/' || tag END
    ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || (page_id * 10 + 5)
      || coalesce(chr(10) || 'etag: ' || CASE WHEN tag = 'other' THEN tag ELSE 'W/' || tag END, '') END AS header_text,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN md5(shtml) END AS body_md5
FROM j
"""

OP7_SQL = r"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:h1|p)>'),
  lambda x: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]+>', ' ', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS parts FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""

OP10_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
ok AS (SELECT * FROM e WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(v, lambda x: x * x)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM r JOIN link l ON r.b = l.a) SELECT a, min(b) AS b FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT m.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(m.vec_id, coalesce(r.b, m.vec_id)) AS component_id,
  m.vec_id = least(m.vec_id, coalesce(r.b, m.vec_id)) AS kept
FROM embeddings m LEFT JOIN n ON n.a = m.vec_id LEFT JOIN reach r ON r.a = m.vec_id
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"
#: Trees of (g, lv, i): a node's two children are 2 i and 2 i + 1 of the level below; ``fold`` climbs from the leaf with its siblings.
OP13_SQL = f"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
  FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 7 = 0, false) AS chosen FROM documents, tab),
h AS (SELECT doc_id, lang AS g, {_LEAF.format('n_chars')} AS leaf, CASE WHEN chosen THEN {_LEAF.format('(CAST(n_chars AS HUGEINT) + 1)')} ELSE {_LEAF.format('n_chars')} END AS altered FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM h),
node(g, lv, i, n, h) AS (SELECT g, 0, r, n, leaf FROM l
  UNION ALL SELECT a.g, a.lv + 1, a.i // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, '')) FROM node a LEFT JOIN node b ON a.g IS NOT DISTINCT FROM b.g AND b.i = a.i + 1 WHERE a.i % 2 = 0 AND a.n > 1),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM node WHERE n = 1),
top(lv, i, n, h) AS (SELECT 0, r, n, h FROM sub
  UNION ALL SELECT a.lv + 1, a.i // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, '')) FROM top a LEFT JOIN top b ON b.i = a.i + 1 WHERE a.i % 2 = 0 AND a.n > 1),
f1(doc_id, g, leaf, i, n, lv, now, p) AS (SELECT doc_id, g, leaf, r, n, 0, altered, '' FROM l
  UNION ALL SELECT f.doc_id, f.g, f.leaf, f.i // 2, (f.n + 1) // 2, f.lv + 1, sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.now ELSE f.now || coalesce(s.h, '') END), f.p || coalesce(s.h, '')
  FROM f1 f LEFT JOIN node s ON s.g IS NOT DISTINCT FROM f.g AND s.lv = f.lv AND s.i = xor(f.i, 1) WHERE f.n > 1),
f2(doc_id, leaf, subroot, i, n, lv, now, p) AS (SELECT f.doc_id, f.leaf, sub.h, sub.r, sub.n, 0, f.now, f.p FROM f1 f JOIN sub ON sub.g IS NOT DISTINCT FROM f.g WHERE f.n = 1
  UNION ALL SELECT f.doc_id, f.leaf, f.subroot, f.i // 2, (f.n + 1) // 2, f.lv + 1, sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.now ELSE f.now || coalesce(s.h, '') END), f.p || coalesce(s.h, '')
  FROM f2 f LEFT JOIN top s ON s.lv = f.lv AND s.i = xor(f.i, 1) WHERE f.n > 1)
SELECT f.doc_id, f.leaf, f.subroot, t.h AS root, sha256(f.p) AS proof_sha256, f.now AS folded_root, f.now = t.h AS verified FROM f2 f, top t WHERE f.n = 1 AND t.n = 1
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_main_text": OP7_SQL,
        "op10_embedding_neardup": OP10_SQL,
        "op2_warc_revisits": OP2_SQL,
        "op4_secret_scan": OP4_SQL,
        "op9_decontaminate": OP9_SQL,
        "op13_merkle_manifest": OP13_SQL}
