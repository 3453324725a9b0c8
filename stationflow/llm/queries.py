"""Registered queries of the text operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, decontaminate, html_extract, line_dedup, periodic, pii, quality, secret_scan, sharding, simhash, topk, url_filter, whitening,
)

SHARDS = 40
#: Tail probability from which a document is selected.
SELECT_AT = 0.5

# The stated rules.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS, keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.weights(F.col("embedding")).alias("weights"))
    return topk.top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors, 10)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, keep=["page_id"])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.group_near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return grouped.select("doc_id", "fingerprint", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents the classifier selects."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.grade_of(table(spark, sf_dir, "labels")))
    return quality.grade(docs, model).where(F.col("p_good") >= SELECT_AT).select("doc_id", "expected_grade", "p_good")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def of(*rules: int):
        return F.filter("found", lambda s: s["rule"].isin(*rules))

    counts = [F.size(of(n)).cast("long").alias(f"n_{rule.kind}") for n, rule in enumerate(secret_scan.BASE_RULES)]
    base = secret_scan.written(of(*range(len(secret_scan.BASE_RULES))))
    return found.select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), secret_scan.written(F.col("found")).alias("spans")
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where one document of ten repeats a stretch of its words to its end.

    h = crc32 of the decimal doc_id, g = h / 10. If h % 10 = 0, of the n words each word i >= a
    becomes word a + (i - a) % p, with a = g % n and p = 1 + (n - a) / (3 + g % 8). A null
    doc_id leaves the text as it is.
    """
    text = F.coalesce("text", F.lit(""))
    mark = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(F.col("mark") / 10), F.size("words")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", at(i).cast("int")))
    # Only those documents are cut into words here.
    chosen = docs.select("doc_id", text.alias("text"), mark.alias("mark"))
    cut = chosen.withColumn("words", F.when(F.col("mark") % 10 == 0, words)).withColumns({"a": a, "p": p})
    planted = F.when(F.size("words") > 0, F.array_join(repeated, " "))
    return cut.select("doc_id", F.coalesce(planted, "text").alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_period(table(spark, sf_dir, "documents")))
    # Greatest length / period first, compared as whole numbers; the order of the runs breaks ties.
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda best, r: F.when(better(best, r), r).otherwise(best))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.scan(docs, pii.train(docs))
    base = F.filter("found", lambda s: s["base"])

    def count_of(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count_of(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("found")).alias("spans"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it is beyond a long."""
    made = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.select(
        "vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error"
    )


# Each kind's expression in one outer group, the group whose length counts, the least length.
_SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
    ("private_key", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 1),
    ("slack", r"(xox[abprs]-[A-Za-z0-9-]{10,})", 1, 1),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 1),
]
_SECRET_CUTS = " UNION ALL ".join(
    f"""SELECT doc_id, {n} AS rule, '{kind}' AS kind, {least} AS least, regexp_extract_all(text, '{pattern}', 1) AS hits,
        regexp_extract_all(text, '{pattern}', {group}) AS groups, regexp_split_to_array(text, '{pattern}') AS gaps FROM documents"""
    for n, (kind, pattern, group, least) in enumerate(_SECRETS)
)

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_topk": op2_topk,
    "op3_url_filter": op3_url_filter,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_html_extract": op6_html_extract,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic": op11_periodic,
    "op12_pii": op12_pii,
    "op13_whitening": op13_whitening,
}

ORACLE = {
    "op2_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 10
""",
    "op3_url_filter": r"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
named AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
judged AS (
    SELECT n.page_id, n.host, n.path, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS place
    FROM named n LEFT JOIN rules r
      ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE place = 1
""",
    "op4_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents
),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op5_decontamination": r"""
WITH cut AS (
    SELECT 'd' AS side, CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark
),
worded AS (
    SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM cut
),
items AS (SELECT id, words, least(10, len(words)) AS size FROM worded WHERE side = 'b' AND len(words) > 0),
windows AS (
    SELECT DISTINCT id, size, array_to_string(words[i : i + size - 1], ' ') AS said
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT id, size, i, array_to_string(words[i : i + size - 1], ' ') AS said
    FROM (SELECT d.id, d.words, s.size, unnest(range(1, len(d.words) - s.size + 2)) AS i FROM worded d, sizes s WHERE d.side = 'd')
),
hits AS (SELECT p.id, p.i, p.size, w.id AS item FROM places p JOIN windows w USING (size, said)),
words_hit AS (SELECT id, count(DISTINCT n) AS n_hit FROM (SELECT id, unnest(range(i, i + size)) AS n FROM hits) GROUP BY id),
items_hit AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
SELECT CAST(d.id AS BIGINT) AS doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded d LEFT JOIN words_hit w ON w.id = d.id LEFT JOIN items_hit t ON t.id = d.id
WHERE d.side = 'd'
""",
    "op10_secret_scan": f"""
WITH cut AS ({_SECRET_CUTS}),
numbered AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut WHERE len(hits) > 0),
placed AS (
    SELECT doc_id, rule, kind, length(groups[i]) >= least AS good, length(hits[i]) AS size,
           sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY doc_id, rule ORDER BY i) AS stop
    FROM numbered
),
spans AS (
    SELECT doc_id, rule, kind, stop - size AS start, kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said
    FROM placed WHERE good
),
texts AS (
    SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
           coalesce(string_agg(said, ',' ORDER BY start, rule) FILTER (rule < 3), '') AS base, string_agg(said, ',' ORDER BY start, rule) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN texts USING (doc_id)
""",
}
