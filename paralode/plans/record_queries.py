"""Queries of gates, joins and blocks that work on single records or lines, with SQL of its own wording."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralode.catalog import register, table
from paralode.functions import normalize, scripts, urls
from paralode.operators import domains, gates, joins, ordered, select, translation
from paralode.plans.gate_queries import _GARBLED

_WORDS = "len(regexp_extract_all({c}, '[A-Za-z]+(?:[''’-][A-Za-z]+)*'))"
_BASIC = "len(regexp_extract_all({c}, '[一-鿿]'))"
_VISIBLE = r"length(regexp_replace({c}, '[\s\p{{Z}}]+', '', 'g'))"


@register(
    "c16_alignment_ids",
    r"""WITH l AS (SELECT pool_record_id, trim(coalesce(document_id, '') || ' en:' || coalesce(cast(provenance.start_line AS varchar), 'x') || ':1 zh:' || coalesce(cast(provenance.end_line AS varchar), '') || ':1') AS line FROM zh_en_pool),
p AS (SELECT pool_record_id, string_split(line, ' ') AS p FROM l)
SELECT pool_record_id, p[1] AS document_id, p[2] || ' ' || p[3] AS sentence_id FROM p WHERE len(p) = 3 AND regexp_full_match(p[2], '(en|zh):\d+:\d+') AND regexp_full_match(p[3], '(en|zh):\d+:\d+')""",
)
def alignment_ids(spark: SparkSession, d: str) -> DataFrame:
    """Alignment lines made of the document and line numbers of each record; lines that are none are left out."""
    at = lambda c, none: F.coalesce(F.col(f"provenance.{c}").cast("string"), F.lit(none))
    line = F.concat(F.coalesce("document_id", F.lit("")), F.lit(" en:"), at("start_line", "x"), F.lit(":1 zh:"), at("end_line", ""), F.lit(":1"))
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", joins.alignment_id(line).alias("a"))
    return rows.filter("a is not null").select("pool_record_id", "a.document_id", "a.sentence_id")


@register(
    "d4_raw_then_merged",
    r"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY coalesce(zh_text, ''), coalesce(en_text, '') ORDER BY pool_record_id) AS n FROM zh_en_pool),
b AS (SELECT pool_record_id, nfc_normalize(lower(regexp_replace(coalesce(zh_text, '') || chr(31) || coalesce(en_text, ''), '\s+', ' ', 'g'))) AS k FROM a WHERE n = 1),
c AS (SELECT pool_record_id, row_number() OVER (PARTITION BY k ORDER BY pool_record_id) AS n FROM b)
SELECT pool_record_id FROM c WHERE n = 1""",
)
def raw_then_merged(spark: SparkSession, d: str) -> DataFrame:
    """First of each raw pair, then first of what is left of each merged pair."""
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", F.coalesce("zh_text", F.lit("")).alias("zh"), F.coalesce("en_text", F.lit("")).alias("en"))
    raw = rows.groupBy(F.sha2(F.concat_ws("\u001f", "zh", "en"), 256).alias("raw")).agg(F.min_by(F.struct("pool_record_id", "zh", "en"), "pool_record_id").alias("r"))
    merged = normalize.nfc(F.lower(F.regexp_replace(F.concat_ws("\u001f", "r.zh", "r.en"), r"[\t\n\x0B\f\r ]+", " ")))
    return raw.groupBy(F.sha2(merged, 256).alias("key")).agg(F.min("r.pool_record_id").alias("pool_record_id")).select("pool_record_id")


@register("c7_sanitized_chunks")
def sanitized_chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", normalize.sanitize_chunk("text").alias("text"))


@register(
    "c28_clean_answers",
    r"""WITH a AS (SELECT id, loaded_at, regexp_replace(regexp_replace(coalesce(th_text, ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS t FROM zh_th_merged),
b AS (SELECT *, regexp_replace(t, '(?is)<think>.*?</think>\s*', '', 'g') AS u FROM a)
SELECT id, loaded_at, regexp_replace(u, '^(?:泰语译文|泰文译文|翻译|译文|คำแปลภาษาไทย|คำแปล)\s*[:：]\s*', '') AS text FROM b""",
)
def clean_answers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_merged").select("id", "loaded_at", translation.clean_output("th_text")["text"].alias("text"))


@register(
    "c29_batch_answers",
    """SELECT source_file || '/' || (source_row // 20) AS batch, count(*) AS n_ids, true AS complete FROM sft_records WHERE source_file IS NOT NULL AND source_row IS NOT NULL GROUP BY 1""",
)
def batch_answers(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 20 lines of a file put into one answer each and parted again; complete where the parts are as many as the ids."""
    text = F.replace(F.coalesce("target_text", F.lit("")), F.lit("<SEP>"), F.lit(" "))
    rows = table(spark, d, "sft_records").filter("source_file is not null and source_row is not null")
    batch = F.concat_ws("/", "source_file", F.expr("cast(source_row div 20 as string)"))
    listed = rows.groupBy(batch.alias("batch")).agg(F.array_sort(F.collect_list(F.struct("record_id", text.alias("t")))).alias("r"))
    answer = F.array_join(F.transform("r", lambda x: x["t"]), " <SEP> ")
    return listed.select("batch", F.size("r").cast("long").alias("n_ids"), translation.split_answers(answer, F.transform("r", lambda x: x["record_id"])).isNotNull().alias("complete"))


def _garbled(name: str) -> str:
    return _GARBLED.replace("(t,", f"({name},").replace("(t)", f"({name})")


@register(
    "f2_sentence_gate",
    f"""WITH s AS (SELECT pool_record_id, coalesce(zh_text, '') AS zh, coalesce(en_text, '') AS en FROM zh_en_pool),
m AS (SELECT *, {_BASIC.format(c='zh')} AS h, {_VISIBLE.format(c='zh')} AS vz, {_WORDS.format(c='en')} AS w, len(regexp_extract_all(en, '[A-Za-z]')) AS l, {_VISIBLE.format(c='en')} AS ve FROM s)
SELECT pool_record_id, CASE WHEN zh = '' OR en = '' THEN 'empty_text' WHEN {_garbled('zh')} OR {_garbled('en')} THEN 'text_corruption' WHEN lower(zh) = lower(en) THEN 'identical_bilingual_text'
 WHEN h < 2 OR h < 0.1 * greatest(vz, 1) THEN 'chinese_language_error' WHEN w < 2 OR l < 0.2 * greatest(ve, 1) THEN 'english_language_error' END AS reason FROM m""",
)
def sentence_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", gates.sentence_gate("zh_text", "en_text").alias("reason"))


@register(
    "f3_tsv_gate",
    r"""WITH s AS (SELECT pool_record_id, coalesce(zh_text, '') AS zh, coalesce(en_text, '') AS en FROM zh_en_pool),
m AS (SELECT *, len(regexp_extract_all(zh, '[㐀-䶿一-鿿]')) AS h, len(regexp_extract_all(en, '[㐀-䶿一-鿿]')) AS he, len(regexp_extract_all(en, '[A-Za-z]+(?:[''’-][A-Za-z]+)*')) AS w FROM s)
SELECT pool_record_id, CASE WHEN zh = '' OR en = '' THEN 'empty_field' WHEN lower(trim(en)) IN ('en', 'english', 'en_text', 'english_text') AND lower(trim(zh)) IN ('zh', 'zh-cn', 'chinese', 'zh_text', 'chinese_text') THEN 'header_row'
 WHEN regexp_matches(en, '^(?i:Ends(/|$)|Issued\s+at\s+HKT\b|NNNN\b)') THEN 'publication_boilerplate' WHEN h < 3 OR w < 3 THEN 'row_too_short' WHEN he > 2 THEN 'english_column_language_mismatch'
 WHEN h / greatest(w, 1) < 0.7 OR h / greatest(w, 1) > 3.5 THEN 'length_ratio_outlier' END AS reason FROM m""",
)
def tsv_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", gates.tsv_gate("en_text", "zh_text").alias("reason"))


@register(
    "f15_successful",
    "SELECT record_id, CASE WHEN semantic_status IS NOT NULL THEN lower(semantic_status) = 'success' WHEN quality_status IS NOT NULL THEN lower(quality_status) = 'success' ELSE true END AS ok FROM zh_th_final",
)
def successful(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_final").select("record_id", gates.is_successful(F.lower("semantic_status"), F.lower("quality_status")).alias("ok"))


@register(
    "f17_date_range",
    "SELECT doc_id, coalesce(cast(published_at AS date) BETWEEN DATE '2024-06-01' AND DATE '2025-03-31', false) AS inside FROM documents",
)
def date_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", urls.in_date_range(F.date_format("published_at", "yyyy-MM-dd"), "2024-06-01", "2025-03-31").alias("inside"))


@register(
    "f18_link_patterns",
    "SELECT doc_id, coalesce(regexp_matches(url, '^https://') AND NOT regexp_matches(url, '/archive') AND NOT regexp_matches(lower(coalesce(title, '')), 'report|报告'), false) AS passes FROM documents",
)
def link_patterns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", urls.passes_patterns("url", "title", allow="^https://", exclude="/archive", exclude_title="report|报告").alias("passes"))


_LEAK = "regexp_matches(coalesce(target_text, ''), '(?i)(You must retain an equal number|Do not omit, summarize, explain|only output the translation|separators? in the translation|<SEP[A-Za-z0-9_]*>)')"


@register("f29_prompt_leaks", f"SELECT record_id, {_LEAK} AS leaks FROM sft_records")
def prompt_leaks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sft_records").select("record_id", translation.leaks_prompt("target_text").alias("leaks"))


@register(
    "t10_quarantine",
    """WITH b AS (SELECT DISTINCT source_file FROM sft_records WHERE source_file IS NOT NULL AND regexp_matches(coalesce(target_text, ''), 'API'))
SELECT record_id, CASE WHEN source_file IN (SELECT source_file FROM b) THEN 'moved' ELSE 'kept' END AS outcome FROM sft_records WHERE split = 'test'""",
)
def quarantined(spark: SparkSession, d: str) -> DataFrame:
    """Records of the test split whose source file has a marked text in any split."""
    rows = table(spark, d, "sft_records").select("record_id", "source_file", "target_text", "split")
    out = joins.quarantine(rows.filter("split = 'test'"), rows.filter("split is null or split <> 'test'"), "source_file", "record_id", F.coalesce(F.col("target_text"), F.lit("")).contains("API"), "contaminated")
    return out["kept"].select("record_id", F.lit("kept").alias("outcome")).unionByName(out["moved"].select("record_id", F.lit("moved").alias("outcome")))


@register(
    "j2_lookup",
    """SELECT r.record_id, z.domain AS found_domain, z.id IS NOT NULL AS found FROM (SELECT DISTINCT record_id, original_id FROM sft_records) r LEFT JOIN (SELECT id, min(domain) AS domain FROM zh_en GROUP BY id) z ON r.original_id = z.id""",
)
def looked_up(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sft_records").select("record_id", F.col("original_id").alias("id"))
    known = table(spark, d, "zh_en").groupBy("id").agg(F.min("domain").alias("found_domain"))
    found, missing = joins.lookup(rows, known, "id")
    return found.select("record_id", "found_domain", F.lit(True).alias("found")).unionByName(missing.select("record_id", F.lit(None).cast("string").alias("found_domain"), F.lit(False).alias("found")))


@register(
    "j9_scored",
    "SELECT f.record_id, f.semantic_qe_score AS score, 'evaluated' AS score_status FROM zh_th_final f WHERE f.semantic_qe_score >= 0.5",
)
def scored(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final")
    scores = rows.filter("semantic_qe_score is not null").select("record_id", "semantic_qe_score")
    return joins.with_scores(rows.select("record_id"), scores, "record_id", "semantic_qe_score", 0.5)


@register(
    "a23_joined_lines",
    """SELECT provenance.source_file AS f, document_id, string_agg(pool_record_id, ' ' ORDER BY pool_record_id) AS ids FROM zh_en_pool
WHERE document_id IS NOT NULL AND provenance.source_file IS NOT NULL AND provenance.start_line IS NOT NULL GROUP BY ALL""",
)
def joined_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("document_id is not null and provenance.source_file is not null and provenance.start_line is not null")
    return ordered.join_ordered(rows.select(F.col("provenance.source_file").alias("f"), "document_id", "pool_record_id", F.col("pool_record_id").alias("ids")), ["f", "document_id"], "pool_record_id", "ids")


@register("c14_technology_reviews")
def technology_reviews(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", domains.domain_score("zh_text", "en_text", "technology").alias("s"))
    return rows.select("pool_record_id", F.array_join(domains.review_reasons(F.col("s"), "technology"), " ").alias("review_reasons"))


@register(
    "p7_surrogate_ids",
    "SELECT pool_record_id, domain || '_pool_' || lpad(cast(row_number() OVER (PARTITION BY domain ORDER BY pool_record_id DESC) AS varchar), 6, '0') AS new_id FROM zh_en_pool WHERE domain IS NOT NULL",
)
def surrogate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("domain is not null").select("pool_record_id", "domain")
    numbered = joins.surrogate_ids(rows, "", [F.col("pool_record_id").desc()], "n", 6, partition="domain")
    return numbered.select("pool_record_id", F.concat("domain", F.lit("_pool_"), "n").alias("new_id"))


@register("o1_collated_order")
def collated_order(spark: SparkSession, d: str) -> DataFrame:
    """Documents in the order of a composite key under the rules of a locale; ties by id."""
    key = F.concat_ws("|", "lang", "source", F.date_format("published_at", "yyyy-MM-dd"), "url")
    rows = table(spark, d, "documents").select("doc_id", F.collate(key, "UNICODE").alias("k"))
    return ordered.ranked(rows, [], [F.col("k"), F.col("doc_id")], "position").select("doc_id", "position")


@register("o12_head", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25")
def head(spark: SparkSession, d: str) -> DataFrame:
    """The first rows in order: the sample option of the stages, whose feature is the limit."""
    return ordered.first_k(table(spark, d, "documents").select("doc_id"), 25, "doc_id")


@register("o5_reservoir")
def reservoir(spark: SparkSession, d: str) -> DataFrame:
    """Five records in the order in which a seeded reservoir over all records keeps them."""
    rows = table(spark, d, "zh_en_pool").select("pool_record_id")
    return select.reservoir(rows, [F.col("pool_record_id")], 5, 42).select("pool_record_id", "slot")
