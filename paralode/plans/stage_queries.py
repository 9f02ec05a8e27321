"""Queries of whole stages and of what surrounds translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralode.catalog import register, table
from paralode.functions import scripts, urls
from paralode.operators import joins, translation
from paralode.plans import pipelines
from paralode.plans.gate_queries import LIMITS, _POOL_GATE
from paralode.plans.text_queries import WORD, n_of


@register("w5_pool_views")
def pool_views(spark: SparkSession, d: str) -> DataFrame:
    out = pipelines.prepare_pool(table(spark, d, "zh_en_pool"), LIMITS)
    return out["eligible"].withColumn("view", F.lit("eligible")).unionByName(out["soft_review"].withColumn("view", F.lit("soft_review"))).withColumn("reasons", F.array_join("reasons", " "))


@register("w5_pool_rejects", f"{_POOL_GATE} SELECT pool_record_id AS record_id, domain, reasons FROM g WHERE reasons <> ''")
def pool_rejects(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.prepare_pool(table(spark, d, "zh_en_pool"), LIMITS)["rejected"].withColumn("reasons", F.array_join("reasons", " "))


@register("w5_pool_accounts", f"{_POOL_GATE} SELECT count(*) FILTER (WHERE reasons = '') AS kept, count(*) FILTER (WHERE reasons <> '') AS rejected FROM g")
def pool_accounts(spark: SparkSession, d: str) -> DataFrame:
    out = pipelines.prepare_pool(table(spark, d, "zh_en_pool"), LIMITS)
    return out["unique"].agg(F.sum("n_rows").alias("kept")).crossJoin(out["rejected"].agg(F.count("*").alias("rejected")))  # one row each


@register("w6_audit")
def audit(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").withColumns({"source_lang": scripts.language("source_lang", "source_text"), "target_lang": scripts.language("target_lang", "target_text")})
    sides = joins.swap_to_sides(rows, "zh", "th", "zh_side", "th_side")
    # Rows of another or an unclear direction are audited as they stand: a row that names Thai only as its source is turned.
    turned = F.coalesce((F.col("source_lang") == "th") | (F.col("target_lang") == "zh"), F.lit(False)) & F.coalesce(F.col("source_lang") != "zh", F.lit(True))
    sides = sides.withColumns(
        {
            "zh_side": F.when(F.col("direction_known"), F.col("zh_side")).when(turned, F.col("target_text")).otherwise(F.col("source_text")),
            "th_side": F.when(F.col("direction_known"), F.col("th_side")).when(turned, F.col("source_text")).otherwise(F.col("target_text")),
        }
    )
    out = pipelines.audit(sides, zh="zh_side", th="th_side")
    return out.select("record_id", "decision", *[F.array_join(c, " ").alias(c) for c in ("reject_reasons", "review_reasons", "flags")])


@register("o10_prepared_sft")
def prepared_sft(spark: SparkSession, d: str) -> DataFrame:
    out = pipelines.prepare_sft(table(spark, d, "sft_records"))
    return out["accepted"].select("record_id", "group", "direction", "assigned_split")


@register("f31_sft_rejects")
def sft_rejects(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.prepare_sft(table(spark, d, "sft_records"))["rejected"].select("record_id", "direction", "primary_reason")


@register("s11_mono_corpus")
def mono_corpus(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "documents").filter(scripts.language("lang", "text") == "th").select(F.col("doc_id").alias("page_id"), "title", "text")
    return pipelines.mono_corpus(pages, most=None)["accepted"].select("page_id", "paragraph", "text_sha256")


@register(
    "f21_output_gate",
    f"""SELECT id, loaded_at, CASE WHEN trim(coalesce(target_text, '')) = '' THEN 'empty_translation' WHEN target_lang = 'zh-CN' AND {n_of('target_text', r'\p{Han}')} < 100 THEN 'target_zh_han_count_below_100'
 WHEN target_lang = 'en' AND {n_of('target_text', WORD)} < 30 THEN 'target_en_word_count_below_30' END AS reason FROM zh_en""",
)
def output_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en").select("id", "loaded_at", translation.output_reason("target_text", "target_lang").alias("reason"))


@register("f22_thai_events")
def thai_events(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_merged").select("id", "loaded_at", translation.thai_event_quality("zh_text", "th_text").alias("q"))
    return rows.select("id", "loaded_at", "q.failure", F.array_join("q.flags", " ").alias("flags"))


@register(
    "f26_candidates",
    f"""WITH m AS (SELECT record_id, coalesce(source_text, '') AS t, {n_of('source_text', r'[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]')} AS h, {n_of('source_text', r'[\p{L}\p{M}]')} AS l FROM zh_th_final WHERE source_lang = 'zh-CN')
SELECT record_id, CASE WHEN trim(t) = '' THEN 'empty_chinese' WHEN h < 100 THEN 'chinese_too_short' WHEN h > 400 THEN 'chinese_too_long' WHEN h / greatest(l, 1) < 0.5 THEN 'chinese_not_han_dominant' END AS reason FROM m""",
)
def candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_final").filter("source_lang = 'zh-CN'").select("record_id", translation.candidate_reason("source_text").alias("reason"))


@register("f20_chunk_gate")
def chunk_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", translation.chunk_reason("text", "lang").alias("reason"))


@register(
    "c31_masked_labels",
    """WITH t AS (SELECT doc_id, list_transform(range(cast(n_chars % 5 AS bigint)), lambda i: cast(i + 1 AS int)) AS p, list_transform(range(cast(n_chars % 7 AS bigint)), lambda i: cast(i + 10 AS int)) AS c FROM documents WHERE n_chars > 0)
SELECT doc_id, array_to_string(list_transform(range(8), lambda i: CASE WHEN i < len(p) THEN -100 WHEN i < len(p) + len(c) THEN c[i + 1 - len(p)] ELSE -100 END), ' ') AS labels FROM t""",
)
def masked_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("n_chars > 0")
    numbers = lambda n, base: F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: (i + base).cast("int"))).otherwise(F.array().cast("array<int>"))
    prompt, completion = numbers((F.col("n_chars") % 5).cast("int"), 1), numbers((F.col("n_chars") % 7).cast("int"), 10)
    return rows.select("doc_id", F.array_join(translation.masked_labels(prompt, completion, 8)["labels"], " ").alias("labels"))


@register("a14_corpus_metrics")
def corpus_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The delivered targets against the last delivery of the same text, as a stand-in for predictions."""
    rows = table(spark, d, "sft_records").filter("direction is not null")
    return translation.corpus_metrics(rows, "target_text", "source_text", "direction")


@register(
    "a20_document_counts",
    "SELECT document_id, count(*) AS n, count(*) FILTER (WHERE zh_text IS NULL OR en_text IS NULL) AS n_incomplete FROM zh_en_pool GROUP BY document_id",
)
def document_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").groupBy("document_id").agg(F.count("*").alias("n"), F.count_if(F.col("zh_text").isNull() | F.col("en_text").isNull()).alias("n_incomplete"))


@register(
    "c30_translation_methods",
    """SELECT id, loaded_at, CASE WHEN translation_method = 'human' OR translation_method = 'google_mt' OR translation_method = 'llm_mt' THEN translation_method
 WHEN strpos(lower(coalesce(data_origin, '')), 'machine_translation') > 0 THEN 'llm_mt' WHEN strpos(lower(coalesce(dataset_name, '')), 'tencent') > 0 THEN 'llm_mt'
 WHEN strpos(lower(coalesce(dataset_name, '')), 'baidu') > 0 THEN 'llm_mt' ELSE 'human' END AS method FROM zh_en""",
)
def translation_methods(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en").select("id", "loaded_at", translation.translation_method("translation_method", "data_origin", "dataset_name").alias("method"))


@register(
    "c34_numbers",
    "SELECT event_id, try_cast(json_extract_string(props, '$.ref') AS double) AS ref FROM events",
)
def coerced_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", translation.as_number(F.get_json_object("props", "$.ref")).alias("ref"))


@register(
    "s13_listing_pages",
    "SELECT doc_id, 'https://list.example/' || source || '?page=' || i AS page FROM documents, range(1, 4) r(i)",
)
def listing_pages(spark: SparkSession, d: str) -> DataFrame:
    template = F.concat(F.lit("https://list.example/"), "source", F.lit("?page={page}"))
    return table(spark, d, "documents").select("doc_id", F.explode(urls.expand_pages(template, 1, 3)).alias("page"))


@register(
    "t12_hourly_events",
    "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.window("ts", "1 hour").alias("w"), "event_type")
    return rows.groupBy(F.col("w.start").alias("window_start"), "event_type").agg(F.count("*").alias("n"))
