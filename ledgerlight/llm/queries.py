"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, context_tree, decontam, importance, infill, langid, minhash_dedup, mixing, pii, quality, topk_search, url_filter, warc
from .common import reach_workers, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


#: (verdict, host, path)
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))

_RULE_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)


@query("op1_url_filter", f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(verdict, rhost, rpath) AS (VALUES {_RULE_VALUES}),
best AS (
  SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(verdict, length(rhost || rpath)) AS verdict
  FROM u LEFT JOIN r ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the fixed rules."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


@query("op3_source_mix")
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"),
                        (F.col("mix_size") * F.col("mix_copies")).alias("taken"), "source",
                        F.col("mix_copies").alias("copies"))


#: Conversation -7: texts full of the template's own control strings.
HARD_TURNS = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]

_ESC = r"regexp_replace(text, '(\\*(?:### |</turn>))', '\\\1', 'g')"


@query("op4_chat_format", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS line,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('### ' || replace(replace(role, '\', '\\'), chr(10), '\n') || ':' || chr(10) || {_ESC}
             || chr(10) || '</turn>' || chr(10))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(line) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g""")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(HARD_TURNS, turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(hard)))


@query("op9_minhash_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, similarity 0.85."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), 3, (85, 100))


@query("op5_topk_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS t FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.t, c.t) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 20""")
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every row whose vec_id is divisible by 20."""
    return topk_search.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query("op8_warc", """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest
  FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest)""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as legacy archives, converted to WARC and read back."""
    return warc.page_records(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def learn() -> Column:
    """Rows that a classifier may learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2


def held_out() -> Column:
    return F.coalesce(~learn(), F.lit(False)).alias("held_out")


@query("op10_langid")
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs, learn()))
    return found.select("doc_id", held_out(), "lang_pred", "score")


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document as the labels mark it."""
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    found = quality.scored(docs, quality.fit(docs, labels, learn()), keep=["doc_id"])
    return found.select("doc_id", held_out(), F.col("quality_score").alias("score"), F.col("quality_pred").alias("predicted"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of document and test item that the document holds."""
    return decontam.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data and secrets."""
    return pii.pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), pii.session_key(spark))


@query("op11_context_tree")
def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by context-tree weighting, and by single words."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    scored = context_tree.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), rest != 1)
    return scored.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op12_importance", r"""
WITH e AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
           FROM (SELECT unnest(range(256)) AS i)),
w AS MATERIALIZED (
  SELECT 'd' AS side, rid, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT row_number() OVER () AS rid, text FROM documents)
  UNION ALL
  SELECT 'b', 0, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
c AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(octet_length(encode(w)) AS BIGINT)),
                  lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM w), e),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM w JOIN c USING (w) GROUP BY bucket),
a AS (SELECT CAST(coalesce(sum(s), 0) AS BIGINT) AS s_all, CAST(coalesce(sum(t), 0) AS BIGINT) AS t_all FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM n, a),
f AS (SELECT rid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN c USING (w) JOIN g USING (bucket) WHERE side = 'd' GROUP BY rid),
d AS (
  SELECT rid, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN f USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS place, count(*) OVER () AS many
      FROM d WHERE n_features >= 20 AND doc_id IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * many // 100 THEN place END AS rank FROM d LEFT JOIN r USING (rid)""")
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts, a tenth of the longer ones drawn."""
    return importance.resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


@query("op13_infill", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         list_transform(range(4), lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS h
  FROM documents),
k AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS i, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS j,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (SELECT *, array_to_string(u[1:i], '') AS pre, array_to_string(u[i + 1:j], '') AS mid, array_to_string(u[j + 1:], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p""")
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut for filling in the middle, and read back."""
    made = infill.fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
