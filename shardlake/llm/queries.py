"""The queries of the operators, with production parameters, and their SQL
where SQL can express them."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import feistel, filter_audit, licenses, line_dedup, ngram_join, packing, periodic_runs, pq_dedup, quality, sp_codec, topk, toxicity, url_filter
from .common import table, workers_find_library

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_library(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


@query("op1_exact_topk", """
WITH v AS (
  SELECT vec_id, min(embedding) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  GROUP BY vec_id),
q AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


@query("op3_url_filter", r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rule, rhost, rpath) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
  ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op8_pack")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), PACK_TOKENIZER)


@query("op2_license_scan", licenses.scan_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text with merge-dropout, decodes the ids and compares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    encoded = (sp_codec.encode(docs, PIECE_MODEL, seed=20240601)
               .withColumn("n_ids", F.size("ids").cast("long")).withColumn("ids_hash", F.xxhash64("ids")))
    return (sp_codec.decode(encoded, PIECE_MODEL)
            .select("doc_id", "n_ids", "ids_hash", "text_crc32",
                    F.crc32(F.col("text").cast("binary")).eqNullSafe(F.col("text_crc32")).alias("lossless")))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after the dedup."""
    return (line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_removed", "emptied", "text"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), _labels(spark, sf_dir))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), _labels(spark, sf_dir))


@query("op10_ngram_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * i >= 90 * (len(x.s) + len(y.s) - i)),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s
  UNION SELECT k.b, r.other FROM r JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) k ON k.a = r.doc_id)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_pq_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.other FROM r JOIN l ON l.a = r.vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE a = r.vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM r GROUP BY vec_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


# CRC-32 in SQL: the table of its bytes by rule, then one step for each byte of x
CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda b:
  list_reduce([b::BIGINT] || range(8)::BIGINT[], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS t)"""


def crc_sql(text: str) -> str:
    """CRC-32 of a string in DuckDB, beside a row of ``crc_table``."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8)), 4294967295)"


@query("op11_feistel_shards", f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, {crc_sql("coalesce(text, '')")} AS text_crc32
      FROM documents, crc_table),
r AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row FROM d),
{feistel.permutation_sql("r")}
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % {feistel.SHARDS} AS INTEGER) AS shard,
       CAST(place // {feistel.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM r JOIN placed USING (row)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards by the law `rows`; equal texts are spread as all other rows."""
    rows = feistel.shuffle(feistel.document_digest(table(spark, sf_dir, "documents")), ["doc_id", "size", "text_crc32", "text_hash"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query("op12_filter_audit", r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
f AS (
  SELECT part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
         + 16 * CAST(coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS INT) AS mask,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM t),
g AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
o(o, used) AS (
  SELECT '', 0 UNION ALL
  SELECT o || chr(65 + b), used | (1 << b) FROM o, (SELECT unnest(range(5))::INT AS b) WHERE (used >> b) & 1 = 0),
s AS (
  SELECT o AS filter_order, step, substr(o, step, 1) AS filter, 1 << (ascii(substr(o, step, 1)) - 65) AS bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(o, i::INT, 1)) - 65))) AS prior
  FROM (SELECT o FROM o WHERE length(o) = 5), (SELECT unnest(range(1, 6))::INT AS step)),
c AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (mask & (coalesce(prior, 0) | bit)::INT = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & coalesce(prior, 0)::INT = 0 AND mask & bit::INT <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & coalesce(prior, 0)::INT <> 0 AND mask & bit::INT <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & coalesce(prior, 0)::INT = 0 AND mask & bit::INT <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & coalesce(prior, 0)::INT = 0 AND mask & bit::INT <> 0), 0) AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM c""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The input that the query's contract sets: (doc_id, text), where a tenth
    of the documents, by a hash of the id, repeat some words to their end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", filter_audit.WORD_GAP), lambda w: w != "")

    def repeated(w):
        n, g = F.greatest(F.size(w), F.lit(1)).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        bound = F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda x: F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.get(w, F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))))[0]
        return F.array_join(bound, " ")

    tail = F.transform(F.array(words), repeated)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, tail).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs", rf"""
WITH {CRC_TABLE},
h AS (SELECT *, {crc_sql("CAST(doc_id AS VARCHAR)")} AS h,
             list_filter(string_split_regex(coalesce(text, ''), '[ 	-]+'), lambda x: x <> '') AS w FROM documents, crc_table),
p AS (SELECT doc_id, h, w, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a,
             1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM h),
d AS (SELECT row_number() OVER () AS d, doc_id, CASE WHEN h % 10 = 0 THEN
        list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM p),
u AS (SELECT d, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
-- equal words q apart; neighbours of one distance are a stretch
m AS (SELECT x.d, y.i - x.i AS q, x.i FROM u x JOIN u y ON x.d = y.d AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
k AS (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM m),
c AS (SELECT d, q, min(i) AS s, max(i) + q + 1 - min(i) AS len FROM k GROUP BY d, q, island HAVING max(i) + q + 1 - min(i) >= greatest(6, 4 * q)),
r AS (SELECT * FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c e WHERE e.d = c.d AND e.q < c.q AND e.s <= c.s AND e.s + e.len >= c.s + c.len)),
x AS (SELECT d, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM r GROUP BY d),
b AS (SELECT d, s, len, q FROM r QUALIFY row_number() OVER (PARTITION BY d ORDER BY (len * 1000000000000)::HUGEINT // q DESC, s, q) = 1),
g AS (SELECT DISTINCT d, unnest(range(s + q, s + len)) AS i FROM r),
t AS (SELECT d, string_agg(word, ' ' ORDER BY i) AS kept FROM u ANTI JOIN g USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN x USING (d) LEFT JOIN b USING (d) LEFT JOIN t USING (d)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    return (found.withColumn("top", periodic_runs.strongest(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                    F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
