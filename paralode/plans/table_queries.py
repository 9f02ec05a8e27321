"""Queries of the table operators: joins, duplicates, aggregates, order, selection and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paralode.catalog import register, table
from paralode.functions import keys, normalize, scripts
from paralode.operators import aggregate, dedup, gates, joins, ordered, select
from paralode.plans.text_queries import POOL_HAN, WORD, merge_text, n_of, pool_text


def _keyed_pool(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool")
    rows = rows.withColumns({"zh": normalize.pool_text("zh_text"), "en": normalize.pool_text("en_text")})
    return rows.withColumn("key", keys.pool_pair("zh", "en", normalized=True))


_KEYED = f"k AS (SELECT *, sha256(zh || chr(31) || lower(en)) AS key FROM (SELECT *, {pool_text('zh_text')} AS zh, {pool_text('en_text')} AS en FROM zh_en_pool))"


@register(
    "d1_unique_pairs",
    f"""WITH {_KEYED} SELECT key AS pair_sha256, min(pool_record_id) AS pool_record_id, arg_min(domain, pool_record_id) AS domain, count(*) AS n_rows,
 array_to_string(list_sort(list_distinct(list(data_origin || '/' || dataset_name))), ' ') AS sources FROM k GROUP BY key""",
)
def unique_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: normalised pairs, one row per content, with where it came from and how often."""
    rows = _keyed_pool(spark, d).select("key", "pool_record_id", "domain", "data_origin", "dataset_name")
    lineage = F.concat("data_origin", F.lit("/"), "dataset_name")
    once = dedup.first_with_lineage(rows, "key", ["pool_record_id"], lineage=lineage)
    return once.select(F.col("key").alias("pair_sha256"), "pool_record_id", "domain", "n_rows", F.array_join("sources", " ").alias("sources"))


@register(
    "d2_unique_within_domain",
    f"WITH {_KEYED} SELECT domain, key, min(pool_record_id) AS pool_record_id FROM k GROUP BY domain, key",
)
def unique_within_domain(spark: SparkSession, d: str) -> DataFrame:
    rows = _keyed_pool(spark, d).select("domain", "key", "pool_record_id")
    return dedup.first_per_key(rows, ["domain", "key"], ["pool_record_id"])


@register(
    "d3_duplicate_statistics",
    f"""WITH {_KEYED}, g AS (SELECT key, count(*) AS n, count(DISTINCT dataset_name) AS s, count(DISTINCT domain) AS dm FROM k GROUP BY key)
SELECT count(*) FILTER (WHERE n > 1) AS duplicate_groups, cast(sum(n - 1) AS bigint) AS extra_rows, count(*) FILTER (WHERE s > 1) AS cross_source_groups, count(*) FILTER (WHERE dm > 1) AS cross_domain_groups FROM g""",
)
def duplicate_statistics(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_statistics(_keyed_pool(spark, d), "key", "dataset_name", "domain")


@register(
    "d5_first_accepted",
    f"""WITH {_KEYED}, v AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY provenance.source_file, provenance.start_line, pool_record_id) AS rn FROM k WHERE zh <> '' AND en <> '')
SELECT pool_record_id, CASE WHEN rn = 1 THEN 'accepted' ELSE 'duplicate_parallel_pair' END AS outcome FROM v""",
)
def first_accepted(spark: SparkSession, d: str) -> DataFrame:
    rows = _keyed_pool(spark, d).filter("zh <> '' and en <> ''").select("pool_record_id", "key", F.col("provenance.source_file").alias("f"), F.col("provenance.start_line").alias("l"))
    first = rows.groupBy("key").agg(F.min_by("pool_record_id", _nulls_last("f", "l", "pool_record_id")).alias("__first"))
    return rows.join(first, "key").select("pool_record_id", F.when(F.col("pool_record_id") == F.col("__first"), "accepted").otherwise("duplicate_parallel_pair").alias("outcome"))


def _nulls_last(*columns: str):
    return F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))])


@register(
    "d6_cross_domain_text",
    """WITH r AS (SELECT doc_id, domain, lang, lower(text) AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn, source FROM documents WHERE text <> ''),
f AS (SELECT *, row_number() OVER (PARTITION BY lang, t ORDER BY turn, source, doc_id) AS rn FROM r)
SELECT doc_id FROM f WHERE rn = 1""",
)
def cross_domain_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text <> ''").select("doc_id", "lang", F.sha2(F.lower("text"), 256).alias("t"), "source")
    turned = rows.withColumn("turn", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")))
    return dedup.first_per_key(turned, ["lang", "t"], ["turn", "source", "doc_id"]).select("doc_id")


@register(
    "d7_first_url",
    "SELECT url, min(doc_id) AS doc_id, count(*) AS n FROM documents WHERE url IS NOT NULL GROUP BY url",
)
def first_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("url is not null").groupBy("url").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@register(
    "d8_unique_texts",
    "SELECT sha256(text) AS text_sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY text",
)
def unique_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter("text is not null and text <> ''").select(F.sha2("text", 256).alias("text_sha256"), "doc_id")
    return rows.groupBy("text_sha256").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@register("d9_greedy_multi_key")
def greedy_multi_key(spark: SparkSession, d: str) -> DataFrame:
    rows = dedup.last_per_key(table(spark, d, "zh_th_merged"), ["id"], ["loaded_at"]).select(
        F.col("id").alias("rank"), keys.exact_pair("zh_text", "th_text").alias("exact"), keys.loose_pair("zh_text", "th_text").alias("loose"),
        F.sha2(normalize.side_key("zh_text"), 256).alias("zh_key"), F.sha2(normalize.side_key("th_text"), 256).alias("th_key"),
    )
    return dedup.greedy_multi_key(rows, ["exact", "loose", "zh_key", "th_key"], "rank").select("rank", "kept", "collides_with")


@register(
    "d10_occurrence_reasons",
    f"""WITH s AS (SELECT record_id, candidate_id, {merge_text('source_text')} AS s, {merge_text('target_text')} AS t FROM zh_th_final),
k AS (SELECT *, s || chr(31) || t AS p FROM s),
w AS (SELECT *, min(record_id) OVER (PARTITION BY candidate_id) AS c1, min(record_id) OVER (PARTITION BY p) AS p1, min(record_id) OVER (PARTITION BY s) AS s1, min(record_id) OVER (PARTITION BY t) AS t1,
 first(t) OVER (PARTITION BY s ORDER BY record_id) AS st, first(s) OVER (PARTITION BY t ORDER BY record_id) AS ts FROM k)
SELECT record_id, array_to_string(list_filter([CASE WHEN c1 < record_id THEN 'duplicate_candidate_id' END, CASE WHEN p1 < record_id THEN 'duplicate_pair' END,
 CASE WHEN s1 < record_id THEN 'duplicate_source' END, CASE WHEN s1 < record_id AND st <> t THEN 'one_source_multiple_targets' END,
 CASE WHEN t1 < record_id THEN 'duplicate_target' END, CASE WHEN t1 < record_id AND ts <> s THEN 'one_target_multiple_sources' END], lambda x: x IS NOT NULL), ' ') AS reasons FROM w""",
)
def occurrence_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").select("record_id", "candidate_id", F.sha2(normalize.merge_text("source_text"), 256).alias("s"), F.sha2(normalize.merge_text("target_text"), 256).alias("t"))
    rows = rows.withColumn("p", F.concat("s", "t"))
    return dedup.occurrence_reasons(rows, "record_id", "candidate_id", "p", "s", "t").select("record_id", F.array_join("duplicate_reasons", " ").alias("reasons"))


@register(
    "d12_first_source",
    f"SELECT s AS source_sha256, min(record_id) AS record_id FROM (SELECT record_id, sha256(lower({merge_text('source_text')})) AS s FROM zh_th_final WHERE source_lang = 'zh-CN') GROUP BY s",
)
def first_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").filter("source_lang = 'zh-CN'").select("record_id", F.sha2(F.lower(normalize.merge_text("source_text")), 256).alias("source_sha256"))
    return dedup.first_per_key(rows, ["source_sha256"], ["record_id"])


@register(
    "a1_counter",
    "SELECT domain, dataset_name, data_origin, count(*) AS n FROM zh_en_pool GROUP BY ALL",
)
def counter(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.counter(table(spark, d, "zh_en_pool"), "domain", "dataset_name", "data_origin")


@register(
    "a2_flag_counter",
    "SELECT domain, flag, count(*) AS n FROM (SELECT domain, unnest(quality_flags) AS flag FROM zh_th_merged) GROUP BY ALL",
)
def flag_counter(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.explode_counter(table(spark, d, "zh_th_merged"), "quality_flags", "domain", name="flag")


@register(
    "a3_distinct_counts",
    "SELECT split, count(DISTINCT pair_group_id) AS groups, count(DISTINCT record_id) AS records, count(DISTINCT source_file) AS files FROM sft_records GROUP BY split",
)
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sft_records").groupBy("split").agg(F.count_distinct("pair_group_id").alias("groups"), F.count_distinct("record_id").alias("records"), F.count_distinct("source_file").alias("files"))


@register(
    "a5_length_summary",
    "SELECT source, count(n_chars) AS n, min(n_chars) AS min, max(n_chars) AS max, round(avg(n_chars), 3) AS mean, median(n_chars) AS median FROM documents GROUP BY source",
)
def length_summary(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.length_summary(table(spark, d, "documents"), "n_chars", "source")


@register(
    "a6_nearest_rank",
    """WITH s AS (SELECT domain, list(zh_char_count ORDER BY zh_char_count) AS l, count(*) AS n FROM zh_en WHERE zh_char_count IS NOT NULL GROUP BY domain)
SELECT domain, n, l[cast(round_even((n - 1) * 0.5, 0) AS bigint) + 1] AS p50, l[cast(round_even((n - 1) * 0.95, 0) AS bigint) + 1] AS p95, l[n] AS largest FROM s""",
)
def nearest_rank(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.nearest_rank(table(spark, d, "zh_en"), "zh_char_count", {"p50": 0.5, "p95": 0.95, "largest": 1.0}, "domain")


@register(
    "a7_index_percentiles",
    """WITH s AS (SELECT list(n_chars ORDER BY n_chars) AS l, count(*) AS n FROM documents WHERE n_chars IS NOT NULL)
SELECT n, l[least(cast(floor(n * 0.5) AS bigint), n - 1) + 1] AS p50, l[least(cast(floor(n * 0.9) AS bigint), n - 1) + 1] AS p90, l[least(cast(floor(n * 0.99) AS bigint), n - 1) + 1] AS p99 FROM s""",
)
def index_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.nearest_rank(table(spark, d, "documents"), "n_chars", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, rounding="floor")


@register(
    "a8_thresholds",
    "SELECT domain, count(*) AS n, count(*) FILTER (WHERE repeat_score >= 0.1) AS ge_0_1, count(*) FILTER (WHERE repeat_score >= 0.2) AS ge_0_2, count(*) FILTER (WHERE repeat_score >= 0.5) AS ge_0_5 FROM zh_th_final GROUP BY domain",
)
def thresholds(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.threshold_counts(table(spark, d, "zh_th_final"), "repeat_score", [0.1, 0.2, 0.5], "domain")


@register(
    "a9_gap_report",
    "SELECT domain, source_lang, count(DISTINCT id) AS n, greatest(0, 100 - count(DISTINCT id)) AS missing, greatest(0, count(DISTINCT id) - 100) AS surplus FROM zh_en GROUP BY domain, source_lang",
)
def gap_report(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "zh_en").groupBy("domain", "source_lang").agg(F.count_distinct("id").alias("n"))
    return aggregate.gap_report(counts, 100)


@register(
    "a10_grouped_sources",
    "SELECT document_id, array_to_string(list_sort(list_distinct(list(dataset_name))), ' ') AS datasets, count(*) AS n FROM zh_en_pool WHERE document_id IS NOT NULL GROUP BY document_id",
)
def grouped_sources(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("document_id is not null")
    return rows.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_set("dataset_name")), " ").alias("datasets"), F.count("*").alias("n"))


@register(
    "a11_composition",
    "SELECT original_id, array_to_string(list_sort(list_distinct(list(direction))), '+') AS composition FROM sft_records WHERE original_id IS NOT NULL AND direction IS NOT NULL GROUP BY original_id",
)
def composition(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.composition(table(spark, d, "sft_records").filter("original_id is not null and direction is not null"), "original_id", "direction")


@register(
    "a12_accept_rate",
    "SELECT teacher_model, count(*) AS n, count(*) FILTER (WHERE quality_status = 'accepted') AS n_accepted, round(count(*) FILTER (WHERE quality_status = 'accepted') / greatest(count(*), 1), 6) AS accept_rate FROM zh_th_final GROUP BY teacher_model",
)
def accept_rate(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.accept_rate(table(spark, d, "zh_th_final"), F.coalesce(F.col("quality_status") == "accepted", F.lit(False)), "teacher_model")


@register(
    "a13_macro_average",
    """WITH m AS (SELECT domain, direction, avg(semantic_qe_score) AS m FROM zh_th_final GROUP BY domain, direction)
SELECT domain, round(CASE WHEN count(*) FILTER (WHERE m IS NULL) = 0 THEN avg(m) END, 6) AS macro, count(*) AS n_groups FROM m GROUP BY domain""",
)
def macro_average(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.macro_average(table(spark, d, "zh_th_final"), "semantic_qe_score", "direction", "domain")


@register(
    "a15_series_summary",
    """SELECT domain, arg_min(semantic_qe_score, record_id) AS first, arg_max(semantic_qe_score, record_id) AS last, min(semantic_qe_score) AS least,
 min(record_id) FILTER (WHERE semantic_qe_score = lo) AS least_step, count(*) AS n FROM (SELECT *, min(semantic_qe_score) OVER (PARTITION BY domain) AS lo FROM zh_th_final WHERE semantic_qe_score IS NOT NULL) GROUP BY domain""",
)
def series_summary(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.series_summary(table(spark, d, "zh_th_final"), "record_id", "semantic_qe_score", "domain")


@register(
    "a16_mapping_conflicts",
    "SELECT zh_text, count(DISTINCT en_text) AS n_partners FROM zh_en_pool GROUP BY zh_text HAVING count(DISTINCT en_text) > 1",
)
def mapping_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.mapping_conflicts(table(spark, d, "zh_en_pool"), "zh_text", "en_text")


@register(
    "a17_coverage",
    """WITH a AS (SELECT DISTINCT zh_text AS t FROM zh_th_merged), b AS (SELECT DISTINCT zh_text AS t FROM zh_en_pool)
SELECT (SELECT count(*) FROM (SELECT t FROM a UNION SELECT t FROM b)) AS covered, (SELECT count(*) FROM b WHERE t NOT IN (SELECT t FROM a WHERE t IS NOT NULL) AND t IS NOT NULL) AS remaining""",
)
def coverage(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "zh_th_merged").select(F.col("zh_text").alias("t")), table(spark, d, "zh_en_pool").select(F.col("zh_text").alias("t"))
    covered = a.union(b).distinct().agg(F.count("*").alias("covered"))
    remaining = b.distinct().filter("t is not null").join(a, "t", "left_anti").agg(F.count("*").alias("remaining"))
    return covered.crossJoin(remaining)  # one row each


@register(
    "a18_acceptance_checks",
    """SELECT bool_and(coalesce(record_id IS NOT NULL, false)) AS has_id, bool_and(coalesce(length(target_text) > 0, false)) AS has_target, bool_and(coalesce(source_row > 0, false)) AS has_row,
 bool_and(coalesce(record_id IS NOT NULL, false)) AND bool_and(coalesce(length(target_text) > 0, false)) AND bool_and(coalesce(source_row > 0, false)) AS passed FROM zh_th_final""",
)
def acceptance_checks(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.checks(table(spark, d, "zh_th_final"), has_id=F.col("record_id").isNotNull(), has_target=F.length("target_text") > 0, has_row=F.col("source_row") > 0)


@register("a19_fingerprint")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.fingerprint(table(spark, d, "zh_en_pool"), "pool_record_id", "zh_text")


@register(
    "a21_review_quota",
    "SELECT domain, count(*) AS n_ready, count(*) FILTER (WHERE translation_method = 'human') AS n_reviewed, cast(ceil(count(*) * 0.1) AS bigint) AS n_required, count(*) FILTER (WHERE translation_method = 'human') >= ceil(count(*) * 0.1) AS met FROM zh_en GROUP BY domain",
)
def review_quota(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.review_quota(table(spark, d, "zh_en"), F.coalesce(F.col("translation_method") == "human", F.lit(False)), "domain")


@register("a24_report")
def report(spark: SparkSession, d: str) -> DataFrame:
    pool = table(spark, d, "zh_en_pool")
    return aggregate.report({"domains": aggregate.counter(pool, "domain"), "datasets": aggregate.counter(pool, "dataset_name"), "duplicates": duplicate_statistics(spark, d)})


@register(
    "n1_latest_delivery",
    "SELECT id, max(loaded_at) AS loaded_at, arg_max(domain, loaded_at) AS domain FROM zh_en GROUP BY id",
)
def latest_delivery(spark: SparkSession, d: str) -> DataFrame:
    return ordered.latest_event(table(spark, d, "zh_en").select("id", "loaded_at", "domain"), "id", ["loaded_at"])


@register("n2_attempts", "SELECT id, count(*) AS attempts FROM zh_th_merged GROUP BY id")
def attempts(spark: SparkSession, d: str) -> DataFrame:
    return ordered.attempts(table(spark, d, "zh_th_merged"), "id")


@register(
    "n3_best_candidate",
    """WITH r AS (SELECT original_id, record_id, row_number() OVER (PARTITION BY original_id ORDER BY coalesce(-semantic_qe_score, 9), record_id) AS rn, count(*) OVER (PARTITION BY original_id) - 1 AS alternatives FROM zh_th_final)
SELECT original_id, record_id, alternatives FROM r WHERE rn = 1""",
)
def best_candidate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").select("original_id", "record_id", F.coalesce(-F.col("semantic_qe_score"), F.lit(9.0)).alias("rank"))
    return ordered.best_candidate(rows, "original_id", ["rank", "record_id"]).select("original_id", "record_id", "alternatives")


@register(
    "n4_round_robin",
    """WITH t AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY crawled_at DESC NULLS LAST, doc_id) AS turn FROM documents)
SELECT doc_id, turn, row_number() OVER (ORDER BY turn, source) AS position FROM t""",
)
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", "crawled_at")
    return ordered.round_robin(rows, "source", [F.col("crawled_at").desc_nulls_last(), F.col("doc_id")]).select("doc_id", "turn", "position")


_LINES = "SELECT pool_record_id, document_id, provenance.source_file AS f, provenance.start_line AS s, provenance.end_line AS e FROM zh_en_pool WHERE provenance.source_file IS NOT NULL AND provenance.start_line IS NOT NULL"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("provenance.source_file is not null and provenance.start_line is not null")
    p = F.col("provenance")
    return rows.select("pool_record_id", "document_id", p["source_file"].alias("f"), p["start_line"].alias("s"), p["end_line"].alias("e"), "zh_text", "en_text")


@register(
    "n5_document_islands",
    f"""WITH l AS ({_LINES}), b AS (SELECT *, lag(document_id) OVER (PARTITION BY f ORDER BY s, pool_record_id) AS before FROM l),
i AS (SELECT *, sum(CASE WHEN document_id IS NOT NULL AND document_id = before THEN 0 ELSE 1 END) OVER (PARTITION BY f ORDER BY s, pool_record_id) AS island FROM b)
SELECT f, cast(island AS bigint) AS island, count(*) AS n_rows, min(s) AS first_line, max(s) AS last_line FROM i GROUP BY f, island""",
)
def document_islands(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).withColumn("at", F.struct("s", "pool_record_id"))
    found = ordered.document_islands(rows, "f", "at", "document_id")
    return found.groupBy("f", "island").agg(F.count("*").alias("n_rows"), F.min("s").alias("first_line"), F.max("s").alias("last_line"))


@register("n7_packed_chunks")
def packed_chunks(spark: SparkSession, d: str) -> DataFrame:
    chunks = ordered.pack_units(scripts.english_sentences("text"), scripts.english_words, 60, 110)
    return table(spark, d, "documents").filter(scripts.language("lang", "text") == "en").select("doc_id", F.posexplode(chunks).alias("chunk", "text"))


@register("n8_greedy_blocks")
def greedy_blocks(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).withColumn("at", F.struct("s", "pool_record_id"))
    runs = ordered.contiguous_islands(rows, "f", "s", "e", F.col("zh_text").isNotNull() & F.col("en_text").isNotNull(), "at")
    sized = runs.select("f", "island", F.col("s").alias("line"), scripts.han("zh_text").alias("han"), scripts.english_words("en_text").alias("words"))
    return ordered.greedy_blocks(sized, ["f", "island"], "line", ["han", "words"], [100, 30], [220, 180])


@register("n9_anchored_intervals")
def anchored_intervals(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).groupBy("f", "s").agg(F.min_by(F.struct("document_id", "zh_text", "en_text"), "pool_record_id").alias("r"))
    rows = ordered.document_islands(rows.withColumn("document_id", F.col("r.document_id")), "f", "s", "document_id").filter("document_id is not null")
    rows = rows.select(
        "f", "island", F.col("s").alias("line"), F.col("r.en_text").rlike("(?i)budget|software|school").alias("anchor"), F.coalesce(gates.sentence_gate("r.zh_text", "r.en_text").isNotNull(), F.lit(False)).alias("bad"),
        scripts.han("r.zh_text").alias("han"), scripts.english_words("r.en_text").alias("words"),
    )
    return ordered.anchored_intervals(rows.withColumn("anchor", F.coalesce("anchor", F.lit(False))), ["f", "island"], "line", "anchor", "bad", "han", "words", least=40)


@register(
    "n10_running_cut",
    "WITH r AS (SELECT doc_id, source, cast(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS bigint) AS running FROM documents) SELECT doc_id, source, running FROM r WHERE running <= 20000",
)
def running_cut(spark: SparkSession, d: str) -> DataFrame:
    return ordered.running_cut(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "n_chars", [F.col("doc_id")], 20_000, "source").select("doc_id", "source", "running")


@register(
    "n11_top_n",
    "WITH r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents) SELECT source, doc_id, n_chars FROM r WHERE rn <= 3",
)
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return ordered.top_n(table(spark, d, "documents").select("source", "doc_id", "n_chars"), 3, [F.col("n_chars").desc(), F.col("doc_id")], "source")


@register("n12_first_k", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50")
def first_k(spark: SparkSession, d: str) -> DataFrame:
    return ordered.first_k(table(spark, d, "documents").select("doc_id", "n_chars"), 50, F.col("n_chars").desc(), F.col("doc_id"))


@register(
    "n13_neighbours",
    "SELECT doc_id, lag(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS previous_n_chars, lead(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS next_n_chars FROM documents",
)
def neighbours(spark: SparkSession, d: str) -> DataFrame:
    return joins.neighbours(table(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source"], "doc_id", "n_chars").select("doc_id", "previous_n_chars", "next_n_chars")


@register(
    "o2_score_order",
    f"""WITH s AS (SELECT pool_record_id, {n_of('en_text', WORD)} AS score FROM zh_en_pool), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, sha256(pool_record_id)) AS place FROM s)
SELECT pool_record_id, score, place FROM r WHERE place <= 200""",
)
def score_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", scripts.english_words("en_text").alias("score"))
    best = ordered.first_k(rows.withColumn("h", F.sha2("pool_record_id", 256)), 200, F.col("score").desc(), F.col("h"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("score").desc(), F.col("h")))).drop("h")


@register(
    "o3_hash_sample",
    "WITH r AS (SELECT pool_record_id, domain, row_number() OVER (PARTITION BY domain ORDER BY sha256('sample-1' || chr(31) || pool_record_id), pool_record_id) AS rn FROM zh_en_pool) SELECT pool_record_id, domain FROM r WHERE rn <= 50",
)
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return select.hash_sample(table(spark, d, "zh_en_pool").select("pool_record_id", "domain"), "sample-1", "pool_record_id", 50, "domain")


@register(
    "o6_disjoint_quotas",
    f"""WITH {_KEYED}, u AS (SELECT DISTINCT key, domain FROM k WHERE domain IN ('education', 'technology', 'finance')),
c AS (SELECT domain, row_number() OVER (ORDER BY count(DISTINCT key), domain) AS ord FROM u GROUP BY domain),
a AS (SELECT key, u.domain, row_number() OVER (ORDER BY sha256('quota:' || u.domain || chr(31) || key), key) AS rn FROM u JOIN c ON u.domain = c.domain AND ord = 1),
s1 AS (SELECT key, domain FROM a WHERE rn <= 100),
b AS (SELECT key, u.domain, row_number() OVER (ORDER BY sha256('quota:' || u.domain || chr(31) || key), key) AS rn FROM u JOIN c ON u.domain = c.domain AND ord = 2 WHERE key NOT IN (SELECT key FROM s1)),
s2 AS (SELECT key, domain FROM s1 UNION ALL SELECT key, domain FROM b WHERE rn <= 100),
e AS (SELECT key, u.domain, row_number() OVER (ORDER BY sha256('quota:' || u.domain || chr(31) || key), key) AS rn FROM u JOIN c ON u.domain = c.domain AND ord = 3 WHERE key NOT IN (SELECT key FROM s2))
SELECT key, domain FROM s2 UNION ALL SELECT key, domain FROM e WHERE rn <= 100""",
)
def disjoint_quotas(spark: SparkSession, d: str) -> DataFrame:
    rows = _keyed_pool(spark, d).select("key", "domain").distinct()
    return select.disjoint_quotas(rows, "key", "domain", {"education": 100, "technology": 100, "finance": 100}, "quota")[0]


@register(
    "o7_stratified_quota",
    """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents) SELECT doc_id, lang FROM r WHERE rn <= CASE lang WHEN 'en' THEN 50 WHEN 'th' THEN 20 WHEN 'zh-CN' THEN 70 END""",
)
def stratified_quota(spark: SparkSession, d: str) -> DataFrame:
    return select.stratified_quota(table(spark, d, "documents").select("doc_id", "lang"), "lang", {"en": 50, "th": 20, "zh-CN": 70}, [F.col("doc_id")])


@register(
    "o8_largest_remainder",
    """WITH w AS (SELECT domain, source_lang, target_lang, target_share, 1000 * target_share / sum(target_share) OVER () AS x FROM sample_targets),
f AS (SELECT *, floor(x) AS fl, row_number() OVER (ORDER BY x - floor(x) DESC, domain || source_lang) AS rk FROM w)
SELECT domain, source_lang, target_lang, cast(fl + CASE WHEN rk <= 1000 - sum(fl) OVER () THEN 1 ELSE 0 END AS bigint) AS quota FROM f""",
)
def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sample_targets").withColumn("i", F.concat("domain", "source_lang"))
    return select.apportion(rows, F.lit(1000), "target_share", "i").select("domain", "source_lang", "target_lang", "quota")


@register(
    "o9_allocated_directions",
    """WITH r AS (SELECT pool_record_id, domain, zh_text, en_text, row_number() OVER (PARTITION BY domain ORDER BY sha256('direction:7' || chr(31) || domain || chr(31) || pool_record_id), pool_record_id) <= 500 AS ahead FROM zh_en_pool WHERE domain IS NOT NULL)
SELECT pool_record_id, domain, CASE WHEN ahead THEN 'zh-CN' ELSE 'en' END AS source_lang, CASE WHEN ahead THEN 'en' ELSE 'zh-CN' END AS target_lang,
 CASE WHEN ahead THEN zh_text ELSE en_text END AS source_text, CASE WHEN ahead THEN en_text ELSE zh_text END AS target_text FROM r""",
)
def allocated_directions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("domain is not null").select("pool_record_id", "domain", "zh_text", "en_text")
    return select.allocate_direction(rows, "7", "pool_record_id", 500, "domain", "zh_text", "en_text", "zh-CN", "en")


@register("o10_group_split")
def group_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sft_records").select("record_id", F.coalesce("direction", F.lit("unknown")).alias("direction"), F.coalesce("original_id", "record_id").alias("g"))
    return select.group_split(rows, "g", "direction", "split-1")


@register(
    "o11_fill_to_target",
    """WITH b AS (SELECT id AS k, 0 AS source_rank FROM zh_en UNION ALL SELECT id, 1 FROM zh_th_merged), o AS (SELECT k, min(source_rank) AS source_rank FROM b GROUP BY k)
SELECT k, source_rank FROM o ORDER BY source_rank, k LIMIT 1200""",
)
def fill_to_target(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "zh_en").select(F.col("id").alias("k")), table(spark, d, "zh_th_merged").select(F.col("id").alias("k"))
    return select.fill_to_target(a, b, "k", ["k"], 1200)


@register(
    "j1_aligned_lines",
    """WITH a AS (SELECT provenance.start_line AS line_no, min(zh_text) AS zh FROM zh_en_pool WHERE provenance.start_line IS NOT NULL AND domain = 'finance' GROUP BY 1),
b AS (SELECT provenance.start_line AS line_no, min(en_text) AS en FROM zh_en_pool WHERE provenance.start_line IS NOT NULL AND domain = 'technology' GROUP BY 1)
SELECT coalesce(a.line_no, b.line_no) AS line_no, zh, en, zh IS NOT NULL AND en IS NOT NULL AS is_complete FROM a FULL JOIN b ON a.line_no = b.line_no""",
)
def aligned_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("provenance.start_line is not null").withColumn("line_no", F.col("provenance.start_line"))
    zh = rows.filter("domain = 'finance'").groupBy("line_no").agg(F.min("zh_text").alias("value"))
    en = rows.filter("domain = 'technology'").groupBy("line_no").agg(F.min("en_text").alias("value"))
    return joins.align_lines([zh, en], names=["zh", "en"])


@register(
    "j3_carry_forward",
    """SELECT f.record_id, coalesce(f.semantic_qe_score, s.score) AS semantic_qe_score FROM zh_th_final f
 LEFT JOIN (SELECT candidate_id, max(semantic_qe_score) AS score FROM zh_th_final WHERE candidate_id IS NOT NULL GROUP BY candidate_id) s ON f.candidate_id = s.candidate_id""",
)
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").select("record_id", "candidate_id", "semantic_qe_score")
    known = rows.filter("candidate_id is not null").groupBy("candidate_id").agg(F.max("semantic_qe_score").alias("semantic_qe_score"))
    return joins.carry_forward(rows, known, "candidate_id", ["semantic_qe_score"]).select("record_id", "semantic_qe_score")


@register(
    "j5_unseen_records",
    "SELECT pool_record_id FROM zh_en_pool p WHERE NOT EXISTS (SELECT 1 FROM zh_en e WHERE e.pair_sha256 = p.pair_sha256)",
)
def unseen_records(spark: SparkSession, d: str) -> DataFrame:
    return joins.unseen(table(spark, d, "zh_en_pool").select("pool_record_id", "pair_sha256"), table(spark, d, "zh_en"), "pair_sha256").select("pool_record_id")


@register(
    "j7_foreign_keys",
    """SELECT s.record_id, CASE WHEN g.original_id IS NULL THEN 'missing_parent' ELSE 'parent_differs' END AS error FROM sft_records s
 LEFT JOIN (SELECT DISTINCT original_id, domain FROM zh_th_final) g ON s.original_id = g.original_id WHERE g.original_id IS NULL OR g.domain IS DISTINCT FROM s.domain""",
)
def foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    child = table(spark, d, "sft_records").select("record_id", "original_id", "domain")
    return joins.foreign_key_errors(child, table(spark, d, "zh_th_final"), "original_id", "original_id", "domain").select("record_id", "error")


@register(
    "j8_contaminated_groups",
    "SELECT pool_record_id FROM zh_en_pool WHERE document_id IN (SELECT document_id FROM zh_en_pool WHERE contains(zh_text, chr(65533)) AND document_id IS NOT NULL)",
)
def contaminated_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", "document_id", "zh_text")
    return joins.contaminated_batches(rows, "document_id", F.coalesce(F.contains("zh_text", F.lit("�")), F.lit(False)))[1].select("pool_record_id")


@register(
    "j10_baseline",
    """WITH a AS (SELECT DISTINCT pair_sha256 AS k FROM zh_en WHERE pair_sha256 IS NOT NULL), b AS (SELECT DISTINCT pair_sha256 AS k FROM zh_en_pool WHERE pair_sha256 IS NOT NULL)
SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS retained, count(*) FILTER (WHERE a.k IS NULL) AS removed, count(*) FILTER (WHERE b.k IS NULL) AS added FROM a FULL JOIN b ON a.k = b.k""",
)
def baseline(spark: SparkSession, d: str) -> DataFrame:
    a, b = (table(spark, d, t).filter("pair_sha256 is not null") for t in ("zh_en", "zh_en_pool"))
    return joins.baseline_comparison(a, b, "pair_sha256")


@register(
    "j11_variant_deltas",
    """WITH m AS (SELECT domain, direction, avg(semantic_qe_score) AS m FROM zh_th_final GROUP BY domain, direction),
a AS (SELECT domain, m FROM m WHERE direction = 'zh-CN->th'), b AS (SELECT domain, m FROM m WHERE direction = 'th->zh-CN')
SELECT coalesce(a.domain, b.domain) AS domain, round(a.m, 6) AS base, round(b.m, 6) AS other, round(round(b.m, 6) - round(a.m, 6), 6) AS delta FROM a FULL JOIN b ON a.domain = b.domain""",
)
def variant_deltas(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "zh_th_final").groupBy("domain", "direction").agg(F.round(F.avg("semantic_qe_score"), 6).alias("m"))
    return joins.variant_deltas(m.filter("direction = 'zh-CN->th'"), m.filter("direction = 'th->zh-CN'"), "domain", "m")


@register(
    "j12_target_lookup",
    """SELECT z.id, z.loaded_at, t.target_share, t.min_rows FROM zh_en z LEFT JOIN sample_targets t ON z.domain = t.domain AND z.source_lang = t.source_lang AND z.target_lang = t.target_lang""",
)
def target_lookup(spark: SparkSession, d: str) -> DataFrame:
    small = joins.small(table(spark, d, "sample_targets"))
    return table(spark, d, "zh_en").join(small, ["domain", "source_lang", "target_lang"], "left").select("id", "loaded_at", "target_share", "min_rows")


@register(
    "s1_sides",
    """SELECT id, loaded_at, CASE WHEN source_lang = 'zh-CN' AND target_lang = 'en' THEN source_text WHEN source_lang = 'en' AND target_lang = 'zh-CN' THEN target_text END AS zh,
 CASE WHEN source_lang = 'zh-CN' AND target_lang = 'en' THEN target_text WHEN source_lang = 'en' AND target_lang = 'zh-CN' THEN source_text END AS en,
 coalesce((source_lang = 'zh-CN' AND target_lang = 'en') OR (source_lang = 'en' AND target_lang = 'zh-CN'), false) AS direction_known FROM zh_en""",
)
def sides(spark: SparkSession, d: str) -> DataFrame:
    return joins.swap_to_sides(table(spark, d, "zh_en"), "zh-CN", "en", "zh", "en").select("id", "loaded_at", "zh", "en", "direction_known")


@register(
    "x1_union_sources",
    """SELECT 'pool' AS source_name, 0 AS source_ord, pool_record_id AS k, zh_text, en_text, NULL AS th_text FROM zh_en_pool UNION ALL SELECT 'merged', 1, id, zh_text, NULL, th_text FROM zh_th_merged""",
)
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "zh_en_pool").select(F.col("pool_record_id").alias("k"), "zh_text", "en_text")
    b = table(spark, d, "zh_th_merged").select(F.col("id").alias("k"), "zh_text", "th_text")
    return joins.union_sources([("pool", a), ("merged", b)])


@register(
    "x2_set_difference",
    "SELECT zh_text FROM zh_en_pool EXCEPT SELECT source_text FROM zh_en",
)
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("zh_text").subtract(table(spark, d, "zh_en").select(F.col("source_text").alias("zh_text")))


@register(
    "x3_subset_errors",
    "SELECT DISTINCT original_id FROM sft_records s WHERE original_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM zh_th_final f WHERE f.original_id = s.original_id)",
)
def subset_errors(spark: SparkSession, d: str) -> DataFrame:
    return joins.subset_errors(table(spark, d, "sft_records").filter("original_id is not null"), table(spark, d, "zh_th_final"), "original_id")


@register(
    "x4_leaking_groups",
    "SELECT pair_group_id, count(DISTINCT split) AS n_splits FROM sft_records WHERE pair_group_id IS NOT NULL GROUP BY pair_group_id HAVING count(DISTINCT split) > 1",
)
def leaking_groups(spark: SparkSession, d: str) -> DataFrame:
    return select.leaking_keys(table(spark, d, "sft_records"), "pair_group_id", "split")


@register(
    "s3_messages",
    """SELECT record_id, array_to_string(['system: Translate from ' || source_lang || ' to ' || target_lang, 'user: ' || source_text, 'assistant: ' || target_text], chr(10)) AS messages
 FROM sft_records WHERE source_lang IS NOT NULL AND target_lang IS NOT NULL""",
)
def messages(spark: SparkSession, d: str) -> DataFrame:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    ask = F.concat(F.lit("Translate from "), "source_lang", F.lit(" to "), "target_lang")
    return table(spark, d, "sft_records").filter("source_lang is not null and target_lang is not null").select("record_id", F.array(turn("system", ask), turn("user", F.col("source_text")), turn("assistant", F.col("target_text"))).alias("m")).select(
        "record_id", F.array_join(F.transform("m", lambda t: F.concat(t["role"], F.lit(": "), t["content"])), "\n").alias("messages")
    )


@register(
    "r1_pricing_summary",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
 FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""",
)
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )


@register(
    "r2_nation_revenue",
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def nation_revenue(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(joins.small(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@register(
    "r3_event_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, cast(session AS bigint) AS session, count(*) AS n FROM s GROUP BY user_id, session""",
)
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts")
    gap = F.col("ts") - F.lag("ts").over(w) <= F.expr("interval 30 minutes")
    marked = table(spark, d, "events").select("user_id", "ts", F.when(gap, 0).otherwise(1).alias("new"))
    return marked.withColumn("session", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("user_id", "session").agg(F.count("*").alias("n"))
