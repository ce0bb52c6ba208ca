"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import byte_bpe, collocations, conversation_repair, katz, kmeans_tree, ngram_join, packing, substring_dedup, syncmers, toxicity, url_filter, vector_links, warc
from gridloom.llm.common import crc_fold, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


@query(r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g') AS search
  FROM parts
), named AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
    regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)+$', '') || '?' || regexp_replace(search, '^&', '') AS canonical
  FROM split
), listed AS (
  SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '(^|[.])(spam-farm|cheap-pills|casino-win|adult-x)([.]|$)')
), rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT n.page_id, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule, arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM named) n
  JOIN rules r ON (n.host = r.rhost OR ends_with(n.host, '.' || r.rhost)) AND starts_with(n.path, r.rpath) GROUP BY n.page_id
)
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  n.canonical, l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON n.canonical = l.canonical
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.denied_urls(pages))


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def _urn(name: str) -> str:
    return f"'<urn:uuid:' || regexp_replace(md5({name}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5') || '>'"


_E = "chr(13) || chr(10)"
_BREAK = r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|title|article|section|header|footer|nav|table|tr|td|th|blockquote|pre)([\s/][^>]*)?(>|$)"


@query(rf"""
WITH source AS (
  SELECT {_urn("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '')")} AS source_id, url, coalesce(html, '') AS page,
    'HTTP/1.1 200 OK' || {_E} || 'Content-Type: text/html; charset=utf-8' || {_E} || 'Content-Length: ' || strlen(coalesce(html, '')) || {_E} || {_E} AS http
  FROM pages
), digested AS (
  SELECT *, 'sha256:' || sha256(page) AS payload_digest, 'sha256:' || sha256(http || page) AS source_digest FROM source
), texts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(page, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'),
    '{_BREAK}', chr(10), 'g'), '(?s)<[!/?a-zA-Z][^>]*(>|$)', '', 'g') AS visible FROM digested
), decoded AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(visible, '&copy;?', chr(169), 'g'), '&middot;?', chr(183), 'g'), '&quot;?', '"', 'g'),
    '&amp;?', '&', 'g') AS readable FROM texts
), blocks AS (
  SELECT source_id, url, payload_digest, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type,
    trim(regexp_replace(regexp_replace(readable, '[\t\r\f\v \x{{A0}}]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS block FROM decoded
  UNION ALL
  SELECT source_id, url, payload_digest, 'metadata', 'application/warc-fields',
    'source-record-id: ' || source_id || {_E} || 'source-block-digest: ' || source_digest || {_E} || 'source-payload-digest: ' || payload_digest || {_E}
    || 'source-status: HTTP/1.1 200 OK' || {_E} || 'source-header: Content-Type: text/html; charset=utf-8' || {_E}
    || 'source-header: Content-Length: ' || strlen(page) || {_E} FROM digested
), named AS (
  SELECT *, {_urn("warc_type || '|' || source_id || '|' || coalesce(url, '') || '|' || payload_digest")} AS record_id,
    strlen(block) AS content_length, 'sha256:' || sha256(block) AS block_digest FROM blocks
)
SELECT record_id, warc_type, source_id AS refers_to, url AS target_uri, content_length::BIGINT AS content_length, block_digest,
  payload_digest AS source_payload_digest,
  sha256('WARC/1.1' || {_E} || 'WARC-Type: ' || warc_type || {_E} || 'WARC-Record-ID: ' || record_id || {_E} || 'WARC-Refers-To: ' || source_id || {_E}
    || coalesce('WARC-Target-URI: ' || url || {_E}, '') || 'WARC-Date: 2024-01-01T00:00:00Z' || {_E} || 'WARC-Block-Digest: ' || block_digest || {_E}
    || 'Content-Type: ' || content_type || {_E} || 'Content-Length: ' || content_length || {_E}) AS header_sha256
FROM named
""")
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derivatives(warc.page_responses(table(spark, sf_dir, "pages")))
    return records.select(
        "record_id", "warc_type", "refers_to", "target_uri", "content_length", "block_digest", "source_payload_digest", F.sha2("header", 256).alias("header_sha256"),
    )


@query(r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split
), windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(words, i, i + 49), ' ')) AS seq FROM starts
), later AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY seq) AS repeats FROM windows
), gone AS (SELECT doc_id, list(DISTINCT j) AS cut FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM later WHERE repeats) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(cut), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN cut IS NULL THEN words
    ELSE list_select(words, list_sort(list_filter(range(1, len(words) + 1), lambda j: NOT list_contains(cut, j)))) END, ' ')) AS kept_sha256
FROM split LEFT JOIN gone USING (doc_id)
""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(words, i, i + 4), ' ')) AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r USING (doc_id) GROUP BY d.doc_id
""")
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=crc_fold(F.col("doc_id")) != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", F.size("offending").cast("long").alias("n_offending"))


@query(r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counted USING (vec_id)
""")
def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = syncmers.compare_with_edits(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), syncmers.as_text(F.col("prints")).alias("fingerprint"),
        syncmers.as_text(F.col("edited_prints")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query()
def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id")) == 1)


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t FROM range(256) r(n)
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ord(ch)::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS d
  FROM conversations, bits
), damaged AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), judged AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault
  FROM placed
), inserts(q, t, w, letters, lines) AS (
  VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']),
    (2, 3, 3, 'I', ['assistant:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])
), moves(q, t, letter, initial, w) AS (
  VALUES (0, 0, 'D', NULL, 4), (1, 1, 'D', NULL, 4), (2, 2, 'D', NULL, 4), (3, 3, 'D', NULL, 4), (0, 2, 'R', NULL, 3), (1, 2, 'R', NULL, 3), (2, 3, 'R', NULL, 3), (3, 2, 'R', NULL, 3),
    (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0)
), paths(conv_id, i, q, best) AS (
  SELECT conv_id, 0::BIGINT, t, {'cost': w, 'audit': letters, 'said': lines} FROM (SELECT DISTINCT conv_id FROM conversations), inserts WHERE q = 0
  UNION ALL
  SELECT p.conv_id, r.i, e.t, min({'cost': p.best.cost + m.w + e.w + CASE WHEN r.fault = 3 AND m.letter <> 'D' THEN 3 ELSE 0 END, 'audit': p.best.audit || m.letter || e.letters,
    'said': list_concat(p.best.said, CASE m.letter WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [CASE m.t WHEN 3 THEN 'assistant:' ELSE 'user:' END || r.text] END, e.lines)})
  FROM paths p JOIN judged r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
  JOIN moves m ON m.q = p.q AND (m.initial IS NULL OR m.initial = r.initial) AND (m.letter = 'D' OR r.fault NOT IN (1, 2)) JOIN inserts e ON e.q = m.t
  GROUP BY p.conv_id, r.i, e.t
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ended AS (
  SELECT p.conv_id, min(p.best) AS best FROM paths p LEFT JOIN counted c ON p.conv_id IS NOT DISTINCT FROM c.conv_id WHERE p.i = coalesce(c.n, 0) AND p.q IN (0, 3) GROUP BY p.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  e.best.cost::BIGINT AS cost, e.best.audit AS audit, sha256(array_to_string(e.best.said, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@query()
def op12_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(table(spark, sf_dir, "embeddings"))


@query(r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), starts AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM split, range(1, 6) t(k)
), counts AS (
  SELECT lang, k AS size, array_to_string(list_slice(words, i, i + k - 1), ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL HAVING count(*) >= 100
), totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS p1, array_to_string(list_slice(string_split(phrase, ' '), k + 1, size), ' ') AS p2
  FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.a, n, min({'score': (1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f))::BIGINT, 'k': k, 'l': x.f, 'r': y.f}) AS best
  FROM cuts c JOIN totals USING (lang) JOIN counts x ON x.lang = c.lang AND x.phrase = p1 JOIN counts y ON y.lang = c.lang AND y.phrase = p2 GROUP BY ALL
), free AS (
  SELECT * FROM scored s WHERE NOT EXISTS (SELECT 1 FROM scored b WHERE b.lang = s.lang AND b.a >= s.a AND b.phrase <> s.phrase AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, rank, phrase, a, best.l AS l, best.r AS r, n, best.score AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY best.score DESC, a DESC, phrase) AS rank FROM free) WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
