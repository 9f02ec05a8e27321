"""Queries of the quality gates and domain scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralode.catalog import register, table
from paralode.functions import normalize
from paralode.operators import aggregate, domains, gates
from paralode.plans.text_queries import POOL_HAN, WORD, merge_text, n_of, plain_numbers, pool_text, sft_text

_POOL = f"""p AS (SELECT pool_record_id, domain, {pool_text('zh_text')} AS zh, {pool_text('en_text')} AS en FROM zh_en_pool),
m AS (SELECT *, {n_of('zh', POOL_HAN)} AS zh_han, {n_of('zh', '[A-Za-z]')} AS zh_latin, {n_of('en', POOL_HAN)} AS en_han, {n_of('en', '[A-Za-z]')} AS en_latin, {n_of('en', WORD)} AS words FROM p)"""


def _hits(mark: str) -> str:
    return f"(length(t) - length(replace(t, '{mark}', ''))) / {len(mark)}"


_GARBLED = (
    "(contains(t, chr(65533)) OR contains(t, '锟斤拷') OR contains(t, '鏁欏笀') OR "
    + " + ".join(_hits(m) for m in gates.WEAK_MARKS)
    + " >= 2)"
)
_REASONS = f"""array_to_string(list_filter([
 CASE WHEN zh = '' OR en = '' THEN 'empty_text' END,
 CASE WHEN zh <> '' AND en <> '' AND lower(zh) = lower(en) THEN 'identical_bilingual_text' END,
 CASE WHEN zh <> '' AND zh_han / greatest(zh_han + zh_latin, 1) < 0.5 THEN 'chinese_language_error' END,
 CASE WHEN en <> '' AND en_latin / greatest(en_latin + en_han, 1) < 0.8 THEN 'english_language_error' END,
 CASE WHEN zh_han < 40 THEN 'zh_chars_below_minimum' END,
 CASE WHEN zh_han > 220 THEN 'zh_chars_above_maximum' END,
 CASE WHEN words < 20 THEN 'english_words_below_minimum' END,
 CASE WHEN {_GARBLED} THEN 'severe_mojibake' END,
 CASE WHEN NOT (zh_han / greatest(words, 1) BETWEEN 0.25 AND 6.0) THEN 'extreme_length_ratio' END], lambda x: x IS NOT NULL), ' ')"""
_POOL_GATE = f"WITH {_POOL}, g AS (SELECT pool_record_id, domain, {_REASONS} AS reasons FROM (SELECT *, zh || chr(10) || en AS t FROM m))"
#: The pool texts of these tables are shorter than those of the production default.
LIMITS = gates.PairLimits(min_zh=40)


def _judged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", "domain", normalize.pool_text("zh_text").alias("zh"), normalize.pool_text("en_text").alias("en"))
    return rows.select("*", gates.pool_gate("zh", "en", LIMITS).alias("reasons"))


@register("f1_pool_gate", f"{_POOL_GATE} SELECT pool_record_id, reasons FROM g")
def pool_gate(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d).select("pool_record_id", F.array_join("reasons", " ").alias("reasons"))


@register(
    "f1_reason_counts",
    f"{_POOL_GATE} SELECT domain, reason, count(*) AS n FROM (SELECT domain, unnest(string_split(reasons, ' ')) AS reason FROM g WHERE reasons <> '') GROUP BY ALL",
)
def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return aggregate.explode_counter(_judged(spark, d), "reasons", "domain", name="reason")


@register(
    "f1_soft_flags",
    f"""WITH {_POOL}, n AS (SELECT *, zh_han / greatest(words, 1) AS r,
 list_sort(list_distinct(list_transform(regexp_extract_all({plain_numbers('zh')}, '(?:^|[^A-Za-z0-9])([+-]?\\d+(?:[.,]\\d+)*(?:%|％)?)', 1), lambda x: replace(x, ',', '')))) AS a,
 list_sort(list_distinct(list_transform(regexp_extract_all({plain_numbers('en')}, '(?:^|[^A-Za-z0-9])([+-]?\\d+(?:[.,]\\d+)*(?:%|％)?)', 1), lambda x: replace(x, ',', '')))) AS b FROM m)
SELECT pool_record_id, array_to_string(list_filter([CASE WHEN r BETWEEN 0.25 AND 6.0 AND NOT (r BETWEEN 0.5 AND 4.0) THEN 'length_ratio_outlier' END, CASE WHEN a <> b THEN 'number_mismatch' END], lambda x: x IS NOT NULL), ' ') AS flags FROM n""",
)
def soft_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = _judged(spark, d)
    return rows.select("pool_record_id", F.array_join(gates.pool_flags("zh", "en", LIMITS), " ").alias("flags"))


@register(
    "f4_merge_gate",
    f"""WITH p AS (SELECT id, loaded_at, {merge_text('zh_text')} AS zh, {merge_text('th_text')} AS th FROM zh_th_merged),
m AS (SELECT *, {n_of('zh', r'[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}\x{30000}-\x{323AF}]')} AS zh_han, {n_of('th', r'[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}\x{30000}-\x{323AF}]')} AS th_han,
 {n_of('zh', r'[\x{0E00}-\x{0E7F}]')} AS zh_thai, {n_of('th', r'[\x{0E00}-\x{0E7F}]')} AS th_thai, {n_of('th', r'\p{L}')} AS letters, {n_of('th', r'[ก-ะาำเ-ๆ]')} AS thai_letters,
 length(th) / greatest(length(zh), 1) AS ratio FROM p)
SELECT id, loaded_at, array_to_string(list_filter([
 CASE WHEN zh = '' THEN 'empty_chinese' END, CASE WHEN th = '' THEN 'empty_thai' END,
 CASE WHEN zh <> '' AND zh_han = 0 THEN 'chinese_side_has_no_han' END, CASE WHEN th <> '' AND th_thai = 0 THEN 'thai_side_has_no_thai' END,
 CASE WHEN zh <> '' AND zh = th THEN 'identical_sides' END,
 CASE WHEN regexp_matches(zh, '\\x{{FFFD}}|鏁|鈥|锟|à¸|à¹|Ã.|Â.') OR regexp_matches(th, '\\x{{FFFD}}|鏁|鈥|锟|à¸|à¹|Ã.|Â.') THEN 'mojibake' END,
 CASE WHEN th_han > 0 THEN 'thai_side_contains_han' END, CASE WHEN th <> '' AND thai_letters / greatest(letters, 1) < 0.5 THEN 'thai_side_not_thai_dominant' END,
 CASE WHEN zh <> '' AND zh_thai > greatest(5, zh_han) THEN 'chinese_side_looks_thai' END,
 CASE WHEN zh <> '' AND th <> '' AND NOT (ratio BETWEEN 0.1 AND 8.0) THEN 'extreme_length_ratio' END], lambda x: x IS NOT NULL), ' ') AS reasons FROM m""",
)
def merge_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_merged").select("id", "loaded_at", normalize.merge_text("zh_text").alias("zh"), normalize.merge_text("th_text").alias("th"))
    return rows.select("id", "loaded_at", F.array_join(gates.merge_gate("zh", "th"), " ").alias("reasons"))


@register("f5_audit_decision")
def audit_decision(spark: SparkSession, d: str) -> DataFrame:
    rows = gates.with_audit(table(spark, d, "zh_th_merged").select("id", "loaded_at", "zh_text", "th_text"), "zh_text", "th_text")
    return rows.select("id", "loaded_at", gates.decision(F.col("reject"), F.col("review")).alias("decision"), *[F.array_join(c, " ").alias(c) for c in ("reject", "review", "flags")])


@register(
    "f6_mono_gate",
    f"""WITH m AS (SELECT record_id, coalesce(target_text, '') AS t, {n_of('target_text', r'[\x{0E00}-\x{0E7F}]')} AS n, {n_of('target_text', r'[\p{L}\p{M}]')} AS l FROM zh_th_final)
SELECT record_id, CASE WHEN t = '' THEN 'empty_after_cleaning' WHEN NOT regexp_matches(t, '[\\p{{L}}\\p{{M}}\\p{{N}}]') THEN 'symbols_only' WHEN n < 10 THEN 'too_few_thai_characters'
 WHEN n / greatest(l, 1) < 0.5 THEN 'not_thai_dominant' WHEN regexp_matches(t, '\\{{\\{{|\\}}\\}}|\\[\\[|\\]\\]') THEN 'residual_wiki_markup' END AS reason FROM m""",
)
def mono_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_final").select("record_id", gates.mono_gate("target_text").alias("reason"))


@register("f7_latin_contamination")
def latin_contamination(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_th_final").select("record_id", gates.latin_contamination("target_text").alias("c"))
    return rows.select("record_id", F.array_join("c.words", " ").alias("words"), F.array_join("c.mixed", " ").alias("mixed"))


AUDIT = r"[\x{3007}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
_SFT_HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3134F}]"


@register(
    "f8_side_quality",
    f"""WITH s AS (SELECT record_id, source_lang, {sft_text('source_text')} AS t FROM sft_records),
c AS (SELECT *, {n_of('t', _SFT_HAN)} AS h, {n_of('t', r'\p{Latin}')} AS l, {n_of('t', r'[\x{0E00}-\x{0E7F}]')} AS th FROM s),
r AS (SELECT record_id, source_lang, greatest(h + l + th, 1) AS d, CASE source_lang WHEN 'zh-CN' THEN h WHEN 'en' THEN l WHEN 'th' THEN th ELSE 0 END AS n FROM c)
SELECT record_id, round(n / d, 6) AS share, coalesce(CASE source_lang WHEN 'zh-CN' THEN n >= 10 AND n / d >= 0.4 WHEN 'en' THEN n >= 20 AND n / d >= 0.7 WHEN 'th' THEN n >= 10 AND n / d >= 0.5 END, false) AS passes FROM r""",
)
def side_quality(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sft_records").select("record_id", gates.side_quality(normalize.sft_text("source_text"), "source_lang").alias("q"))
    return rows.select("record_id", "q.share", "q.passes")


@register("f9_severe_repetition")
def severe_repetition(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_final").select("record_id", gates.severe_repetition("target_text").alias("severe"))


@register(
    "f11_garbled",
    f"SELECT pool_record_id, {_GARBLED} AS garbled FROM (SELECT pool_record_id, coalesce(zh_text, '') AS t FROM zh_en_pool)",
)
def garbled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", gates.looks_garbled("zh_text").alias("garbled"))


@register(
    "f12_raw_characters",
    r"""SELECT pool_record_id, regexp_matches(coalesce(zh_text, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]') AS has_control,
 regexp_matches(coalesce(zh_text, ''), '[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{2066}-\x{2069}\x{FEFF}]') AS has_invisible, regexp_matches(coalesce(zh_text, ''), '\p{Co}') AS has_private FROM zh_en_pool""",
)
def raw_characters(spark: SparkSession, d: str) -> DataFrame:
    c = F.coalesce("zh_text", F.lit(""))
    return table(spark, d, "zh_en_pool").select(
        "pool_record_id", c.rlike(normalize.CONTROL).alias("has_control"), c.rlike(normalize.BIDI_ZERO_WIDTH).alias("has_invisible"), c.rlike(r"\p{Co}").alias("has_private")
    )


@register(
    "f14_reversed_fields",
    f"""SELECT pool_record_id, CASE WHEN {n_of('zh_text', WORD)} >= 20 AND {n_of('zh_text', AUDIT)} < 10 THEN 'zh_text_appears_to_be_english'
 WHEN {n_of('en_text', AUDIT)} >= 20 AND {n_of('en_text', WORD)} < 5 THEN 'en_text_appears_to_be_chinese' END AS field FROM zh_en_pool""",
)
def reversed_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", gates.reversed_field("zh_text", "en_text").alias("field"))


@register(
    "f24_submission_check",
    f"""WITH s AS (SELECT id, loaded_at, source_lang, target_lang, coalesce(source_text, '') AS s, coalesce(target_text, '') AS t, domain, zh_char_count AS c FROM zh_en),
x AS (SELECT *, CASE WHEN source_lang = 'zh-CN' THEN s ELSE t END AS zh, CASE WHEN source_lang = 'zh-CN' THEN t ELSE s END AS en FROM s),
m AS (SELECT *, {n_of('zh', r'\p{Han}')} AS h, {n_of('en', WORD)} AS w FROM x)
SELECT id, loaded_at, array_to_string(list_filter([CASE WHEN trim(s) = '' THEN 'empty_source' END, CASE WHEN trim(t) = '' THEN 'empty_target' END,
 CASE WHEN coalesce(domain, '') NOT IN ('education', 'technology', 'finance') THEN 'invalid_domain' END,
 CASE WHEN concat_ws('->', source_lang, target_lang) NOT IN ('zh-CN->en', 'en->zh-CN') THEN 'invalid_direction' END,
 CASE WHEN s <> '' AND s = t THEN 'identical_texts' END, CASE WHEN h = 0 THEN 'chinese_without_han' END, CASE WHEN w = 0 THEN 'english_without_words' END,
 CASE WHEN c IS NULL OR c < 0 THEN 'invalid_count' END, CASE WHEN c IS NOT NULL AND c <> h THEN 'count_mismatch' END], lambda x: x IS NOT NULL), ' ') AS reasons FROM m""",
)
def submission_check(spark: SparkSession, d: str) -> DataFrame:
    names = ("source_lang", "target_lang", "source_text", "target_text", "domain", "zh_char_count")
    rows = table(spark, d, "zh_en")
    return rows.select("id", "loaded_at", F.array_join(gates.submission_reasons({n: F.col(n) for n in names}), " ").alias("reasons"))


@register("f31_sft_reasons")
def sft_reasons(spark: SparkSession, d: str) -> DataFrame:
    found = gates.sft_reasons("source_text", "target_text", "source_lang", "target_lang")
    rows = table(spark, d, "sft_records").select("record_id", found.alias("r"), gates.sft_warnings("source_text", "target_text", "source_lang", "target_lang").alias("w"))
    return rows.select("record_id", gates.primary_reason(F.col("r"), gates.SFT_PRIORITY).alias("primary_reason"), F.array_join("r", " ").alias("reasons"), F.array_join("w", " ").alias("warnings"))


@register(
    "f35_present_text",
    "SELECT count(*) FILTER (WHERE length(trim(coalesce(zh_text, ''))) > 0) AS zh, count(*) FILTER (WHERE length(trim(coalesce(en_text, ''))) > 0) AS en FROM zh_en_pool",
)
def present_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").agg(F.count_if(gates.present("zh_text")).alias("zh"), F.count_if(gates.present("en_text")).alias("en"))


def _sql_concepts(concepts: tuple[domains.Concept, ...], out: str) -> str:
    rows = []
    for c in concepts:
        terms = "".join(f" OR contains(zh, '{t}')" for t in c.chinese)
        rows.append(f"CASE WHEN regexp_matches(en, '(?i){c.english}'){terms} THEN '{c.name}' END")
    return f"list_filter([{', '.join(rows)}], lambda x: x IS NOT NULL) AS {out}"


@register(
    "c11_domain_scores",
    f"""WITH p AS (SELECT pool_record_id, coalesce(zh_text, '') AS zh, coalesce(en_text, '') AS en FROM zh_en_pool),
c AS (SELECT pool_record_id, {_sql_concepts(domains.EDUCATION, 'e')}, {_sql_concepts(domains.TECHNOLOGY_STRONG, 's')}, {_sql_concepts(domains.TECHNOLOGY_GENERAL, 'g')} FROM p)
SELECT pool_record_id, 3 * len(e) AS education_score, array_to_string(e, ' ') AS education_concepts, 3 * len(s) + len(g) AS technology_score, len(s) > 0 OR len(g) >= 2 AS technology_eligible FROM c""",
)
def domain_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", domains.domain_score("zh_text", "en_text", "education").alias("e"), domains.domain_score("zh_text", "en_text", "technology").alias("t"))
    return rows.select(
        "pool_record_id", F.col("e.score").alias("education_score"), F.array_join("e.strong", " ").alias("education_concepts"),
        F.col("t.score").alias("technology_score"), F.col("t.eligible").alias("technology_eligible"),
    )


@register("c12_finance_scores")
def finance_scores(spark: SparkSession, d: str) -> DataFrame:
    s = domains.domain_score("zh_text", "en_text", "finance")
    rows = table(spark, d, "zh_en_pool").select("pool_record_id", s.alias("f"))
    return rows.select(
        "pool_record_id", "f.score", "f.eligible", F.array_join("f.excluded", " ").alias("excluded"), F.array_join(domains.review_reasons(F.col("f"), "finance"), " ").alias("review_reasons")
    )


@register("c13_best_domain")
def best_domain(spark: SparkSession, d: str) -> DataFrame:
    names = list(domains.DOMAINS)
    rows = table(spark, d, "zh_en_pool")
    scored = rows.select("pool_record_id", "domain", *[domains.domain_score("zh_text", "en_text", n)["score"].alias(n) for n in names])
    return scored.select("pool_record_id", "domain", *names, domains.best_label(names, [F.col(n) for n in names]).alias("best_domain"))


@register(
    "a4_score_histogram",
    f"""WITH p AS (SELECT domain, coalesce(zh_text, '') AS zh, coalesce(en_text, '') AS en FROM zh_en_pool), c AS (SELECT domain, {_sql_concepts(domains.EDUCATION, 'e')} FROM p)
SELECT domain, 3 * len(e) AS score, count(*) AS n FROM c GROUP BY ALL""",
)
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").select("domain", domains.domain_score("zh_text", "en_text", "education")["score"].alias("score"))
    return aggregate.counter(rows, "domain", "score")
