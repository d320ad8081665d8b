"""The registered ``opN_<name>`` queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import chat_format, decontaminate, late_layout, line_quality, mixing, near_dedup, periodic, pii, suffix_dedup, token_blocks, topk, toxicity, url_filter
from hearth.llm.common import cut, table, work_path


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(spark, table(spark, sf_dir, "documents")).drop("removed")


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_blocks.write(token_blocks.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")), path)
    return token_blocks.decode(token_blocks.read(spark, path))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    out = chat_format.format_chats(turns)
    read = out.select(
        "conv_id", "n_groups", "formatted",
        chat_format.parse_turns(F.col("formatted")).alias("turns"),
        F.concat_ws("", chat_format.under_mask(F.col("formatted"), F.col("mask"))).alias("loss"),
    )
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_groups",
    )


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w <> role, true) AS opens,
    length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g')) AS role_n,
    length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) AS text_n
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_n + CASE WHEN opens THEN role_n + length('<|role|><|text|><|end|>') ELSE length('<|next|>') END)::BIGINT AS formatted_chars,
  count(*) FILTER (opens) AS n_groups
FROM o GROUP BY conv_id
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = cut(spark, docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    targets = cut(spark, mixing.source_targets(sized))
    mixed = mixing.with_copies(sized, targets)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), l AS (
  SELECT *, row_number() OVER o AS place,
    ((sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
      / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST)
), f AS (SELECT min_by(level, place) AS level FROM l WHERE level * weight <= (3 * source_size)::DOUBLE),
t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(f.level, 0) * weight) AS target FROM l, f
), r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM (
  SELECT doc_id, size, source_size, target,
    floor(rate)::BIGINT + (CASE WHEN ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(spark, rows, rows.where(F.col("vec_id") % 100 == 0), 10)


OP7_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.classes(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.lower(F.hex("root")).alias("class_key"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.fit(spark))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 10 reads from an url before its model is asked."""
    judged = url_filter.judge(table(spark, sf_dir, "pages"), ([0.0] * url_filter.BUCKETS, 0.0))
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


URL_RULES_SQL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(h, p, ruled) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, max_by(r.h || r.p, length(r.h || r.p)) AS rule, max_by(ruled, length(r.h || r.p)) AS ruled
  FROM p JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p) GROUP BY page_id
)
SELECT p.page_id, host, path, rule, ruled FROM p LEFT JOIN m USING (page_id)
"""


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return line_quality.judge(docs, line_quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out)))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 11 counts in a text before its field is asked."""
    counted = line_quality.judge(table(spark, sf_dir, "documents"), line_quality.Model())
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUALITY_COUNTS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+4]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM t, range(5) AS o(k) WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines
  FROM w)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed
FROM c LEFT JOIN r USING (doc_id)
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find(table(spark, sf_dir, "documents"), looped=True)


LATE_FROM = 1_712_707_200_000_000  # 2024-04-10 00:00 in microseconds since 1970


def op13_late_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "sales")
    h = F.crc32(F.col("sale_id").cast("string"))
    days = lambda n: F.make_dt_interval(n.cast("int"))
    copies = sales.where((h % 3 == 0) & (late_layout.day_of(late_layout.micros(sales, "sold_at")) % 7 == 0)).withColumns(
        {"total": F.col("total") + 1, "sold_at": F.col("sold_at") + days(h % 2), "arrived_at": F.col("arrived_at") + days(1 + h % 97)}
    )
    rows = 1 + sales.count() // 700
    return late_layout.overwrite_late(spark, sales.unionByName(copies), rows, work_path(spark, "layout"), work_path(spark, "standing"), LATE_FROM)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_blocks": op2_token_blocks,
    "op3_toxicity": op3_toxicity,
    "op4_chat_format": op4_chat_format,
    "op5_mixing": op5_mixing,
    "op6_decontaminate": op6_decontaminate,
    "op7_topk": op7_topk,
    "op8_pii": op8_pii,
    "op9_near_dedup": op9_near_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_line_quality": op11_line_quality,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_late_overwrite": op13_late_overwrite,
    "url_rules": url_rules,
    "quality_counts": quality_counts,
}
ORACLE_SQL: dict[str, str] = {"op4_chat_format": OP4_SQL, "op5_mixing": OP5_SQL, "op7_topk": OP7_SQL, "url_rules": URL_RULES_SQL, "quality_counts": QUALITY_COUNTS_SQL}
