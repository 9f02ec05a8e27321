"""Queries of the text functions over the tables of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralode.catalog import register, table
from paralode.functions import keys, normalize, scripts, urls

POOL_HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]"
AUDIT_HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
WORD = "[A-Za-z]+(?:[''’-][A-Za-z]+)*"


def n_of(column: str, pattern: str) -> str:
    """SQL for the number of matches of a pattern."""
    return f"len(regexp_extract_all(coalesce({column}, ''), '{pattern}'))"


def narrow(column: str) -> str:
    """SQL for full-width forms as ASCII."""
    return (
        f"translate({column}, (select string_agg(chr(cast(65281 + i as integer)), '' order by i) from range(94) r(i)), "
        "(select string_agg(chr(cast(33 + i as integer)), '' order by i) from range(94) r(i)))"
    )


def plain_numbers(column: str) -> str:
    """SQL for texts in which digits of other forms are ASCII, as far as the compatibility form changes them."""
    column = f"translate({narrow(column)}, '¹²³', '123')"
    for fraction, digits in (("½", "1⁄2"), ("¼", "1⁄4"), ("¾", "3⁄4")):
        column = f"replace({column}, '{fraction}', '{digits}')"
    return column


def sub(column: str, *steps: tuple[str, str]) -> str:
    for pattern, to in steps:
        column = f"regexp_replace({column}, '{pattern}', '{to}', 'g')"
    return column


SPACES = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]+"


def collapse(column: str) -> str:
    return sub(column, (SPACES, " "), ("^ | $", ""))


def pool_text(column: str) -> str:
    return collapse(
        sub(
            f"translate(nfc_normalize(coalesce({column}, '')), chr(65279) || chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(8289) || chr(8290) || chr(8291) || chr(8292), '')",
            (r"[\x{A0}\x{3000}\r\n\t\f\x0B]", " "), (r"[\p{Cc}\p{Cf}]", ""), (r"\p{Zs}", " "),
        )
    )


def merge_text(column: str) -> str:
    return collapse(
        sub(
            f"nfc_normalize(coalesce({column}, ''))",
            (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", ""), (r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{2066}-\x{2069}\x{FEFF}]", ""),
        )
    )


def sft_text(column: str) -> str:
    return collapse(f"translate(nfc_normalize(coalesce({column}, '')), chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(65279), '')")


@register(
    "c1_script_counts",
    f"""SELECT pool_record_id, {n_of('zh_text', POOL_HAN)} AS han_pool, {n_of('zh_text', r'[\x{4E00}-\x{9FFF}]')} AS han_basic,
 {n_of('zh_text', AUDIT_HAN)} AS han_audit, {n_of('en_text', '[A-Za-z]')} AS latin, {n_of('en_text', r'[\p{L}\p{M}]')} AS letters,
 {n_of('zh_text', r'[\x{0E00}-\x{0E7F}]')} AS thai, length(regexp_replace(coalesce(en_text, ''), '[\\s\\p{{Z}}]+', '', 'g')) AS visible
 FROM zh_en_pool""",
)
def script_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select(
        "pool_record_id", scripts.han("zh_text").alias("han_pool"), scripts.han("zh_text", "basic").alias("han_basic"), scripts.han("zh_text", "audit").alias("han_audit"),
        scripts.latin("en_text").alias("latin"), scripts.letters("en_text").alias("letters"), scripts.thai("zh_text").alias("thai"), scripts.visible("en_text").alias("visible"),
    )


@register("c2_english_words", f"SELECT pool_record_id, {n_of('en_text', WORD)} AS words FROM zh_en_pool")
def english_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", scripts.english_words("en_text").alias("words"))


@register("c3_pool_text", f"SELECT pool_record_id, {pool_text('zh_text')} AS zh, {pool_text('en_text')} AS en FROM zh_en_pool")
def normal_pool(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", normalize.pool_text("zh_text").alias("zh"), normalize.pool_text("en_text").alias("en"))


@register("c3_merge_text", f"SELECT id, loaded_at, {merge_text('th_text')} AS th FROM zh_th_merged")
def normal_merge(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_merged").select("id", "loaded_at", normalize.merge_text("th_text").alias("th"))


@register("c3_sft_text", f"SELECT record_id, {sft_text('source_text')} AS source, {sft_text('target_text')} AS target FROM sft_records")
def normal_sft(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sft_records").select("record_id", normalize.sft_text("source_text").alias("source"), normalize.sft_text("target_text").alias("target"))


@register(
    "c3_bitext_text",
    f"SELECT pool_record_id, {collapse(sub('translate(nfc_normalize(coalesce(en_text, chr(0)[2:])), chr(65279), chr(0)[2:])', (r'[\p{Cc}\p{Cf}\x{A0}\x{3000}]', ' ')))} AS en FROM zh_en_pool",
)
def normal_bitext(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", normalize.bitext_text("en_text").alias("en"))


@register(
    "c3_page_text",
    "SELECT doc_id, " + sub("translate(coalesce(text, ''), chr(160), ' ')", (r"\r\n?", r"\n"), (r"[\t\f\x0B ]+", " "), (" *\\n *", "\\n"), ("\\n{3,}", "\\n\\n"), (r"^\s+|\s+$", "")).replace("'\\n'", "chr(10)").replace("'\\n\\n'", "chr(10) || chr(10)") + " AS text FROM documents",
)
def normal_page(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", normalize.page_text("text").alias("text"))


@register(
    "c4_number_sets",
    "SELECT pool_record_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all("
    + plain_numbers("coalesce(en_text, '')")
    + r", '(?:^|[^A-Za-z0-9])([+-]?\d+(?:[.,]\d+)*(?:%|％)?)', 1), lambda x: replace(x, ',', '')))), ' ') AS numbers FROM zh_en_pool",
)
def number_sets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", F.array_join(scripts.numbers("en_text"), " ").alias("numbers"))


@register(
    "c5_content_keys",
    f"""WITH n AS (SELECT pool_record_id, {pool_text('zh_text')} AS zh, {pool_text('en_text')} AS en, coalesce(zh_text, '') AS z, coalesce(en_text, '') AS e FROM zh_en_pool)
SELECT pool_record_id, sha256(zh || chr(31) || lower(en)) AS pool_key, sha256(lower(e) || chr(31) || z) AS tsv_key, sha256(z || chr(31) || e) AS merge_key,
 sha256(nfc_normalize(z) || chr(31) || lower(nfc_normalize(e))) AS submission_key FROM n""",
)
def content_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select(
        "pool_record_id", keys.pool_pair("zh_text", "en_text").alias("pool_key"), keys.tsv_pair("zh_text", "en_text").alias("tsv_key"),
        keys.merge_pair("zh_text", "en_text").alias("merge_key"), keys.submission_pair("zh_text", "en_text").alias("submission_key"),
    )


@register(
    "c5_pair_groups",
    f"""WITH s AS (SELECT record_id, coalesce(source_lang, '') AS a, coalesce(target_lang, '') AS b,
 coalesce(source_lang, '') || chr(30) || lower({sft_text('source_text')}) AS x, coalesce(target_lang, '') || chr(30) || lower({sft_text('target_text')}) AS y FROM sft_records)
SELECT record_id, 'pair_' || sha256(CASE WHEN a < b OR (a = b AND x <= y) THEN x || chr(31) || y ELSE y || chr(31) || x END) AS pair_group FROM s""",
)
def pair_groups(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sft_records").select("record_id", keys.pair_group("source_lang", "source_text", "target_lang", "target_text").alias("pair_group"))


@register(
    "c6_chinese_sentences",
    "SELECT pool_record_id, len(list_filter(list_transform(regexp_extract_all(coalesce(zh_text, ''), '[^。！？!?；;]+[。！？!?；;]?'), lambda x: trim(x)), lambda x: x <> '')) AS n FROM zh_en_pool",
)
def sentences_zh(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", F.size(scripts.chinese_sentences("zh_text")).alias("n"))


@register("c6_english_sentences")
def sentences_en(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_en_pool").select("pool_record_id", F.size(scripts.english_sentences("en_text")).alias("n"))


@register("c8_codepoint_pieces")
def codepoint_pieces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(scripts.split_codepoints("text", 1800)).alias("piece", "part"))


@register(
    "c17_script_profile",
    f"""WITH c AS (SELECT record_id, {n_of('target_text', r'[\p{L}\p{M}]')} AS lm, {n_of('target_text', AUDIT_HAN)} AS h, {n_of('target_text', r'\p{Latin}')} AS l FROM zh_th_final)
SELECT record_id, lm AS letter_mark_count, h AS han_count, round(h / greatest(lm, 1), 6) AS han_ratio, round(l / greatest(lm, 1), 6) AS latin_ratio FROM c""",
)
def script_profile(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "zh_th_final").select("record_id", scripts.script_profile("target_text").alias("p"))
    return p.select("record_id", "p.letter_mark_count", "p.han_count", "p.han_ratio", "p.latin_ratio")


@register(
    "c18_repeat_score_20",
    r"""WITH t AS (SELECT record_id, regexp_replace(coalesce(target_text, ''), '[\s\p{Z}]+', '', 'g') AS t FROM zh_th_final)
SELECT record_id, CASE WHEN length(t) >= 20 THEN round(1 - len(list_distinct(list_transform(range(1, length(t) - 18), lambda i: substring(t, i, 20)))) / (length(t) - 19), 6) ELSE 0.0 END AS score FROM t""",
)
def repeat_score(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "zh_th_final").select("record_id", scripts.repeat_score("target_text", 20).alias("score"))


@register(
    "c19_english_profile",
    f"""SELECT record_id, {n_of('target_text', WORD)} AS english_word_count,
 coalesce(list_max(list_transform(regexp_extract_all(coalesce(target_text, ''), '(?:[A-Za-z][A-Za-z0-9''’_-]*(?:[ \\t,.;:()/+&-]+|$)){{5,}}'), lambda x: length(x))), 0) AS longest_english_block FROM zh_th_final""",
)
def english_profile(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "zh_th_final").select("record_id", scripts.english_profile("target_text").alias("p"))
    return p.select("record_id", "p.english_word_count", "p.longest_english_block")


@register(
    "c21_canonical_urls",
    r"""WITH u AS (SELECT doc_id, regexp_replace(url, '#.*$', '') AS u FROM documents WHERE url IS NOT NULL),
q AS (SELECT doc_id, regexp_replace(u, '\?.*$', '') AS p, list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?i:utm_|spm|from|eqid)')) AS k FROM u)
SELECT doc_id, CASE WHEN len(k) > 0 THEN p || '?' || array_to_string(k, '&') ELSE p END AS url FROM q""",
)
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("url is not null").select("doc_id", urls.canonical_url("url").alias("url"))


@register("c22_url_dates")
def url_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", urls.url_date_hint("url").alias("hint"), urls.url_outside_window("url", "2024-01-01", "2025-12-31").alias("outside"))


@register("c26_paragraphs")
def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(urls.paragraphs("text")).alias("at", "paragraph"))


@register("c32_page_addresses")
def all_page_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of all titles; SQL does not encode all characters alike, so a test compares them with a library."""
    return table(spark, d, "documents").filter("title is not null").select("doc_id", urls.page_url("title", "https://wiki.example/").alias("address"))


@register(
    "c33_canonical_json",
    """SELECT pool_record_id, '{"data_origin":"' || data_origin || '","dataset_name":"' || dataset_name || '"}' AS lineage FROM zh_en_pool WHERE data_origin IS NOT NULL AND dataset_name IS NOT NULL""",
)
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "zh_en_pool").filter("data_origin is not null and dataset_name is not null")
    return rows.select("pool_record_id", keys.lineage_key("dataset_name", "data_origin").alias("lineage"))


@register(
    "c35_list_arguments",
    "SELECT record_id, len(list_filter(list_transform(string_split(coalesce(provenance, ''), ','), lambda x: trim(x)), lambda x: x <> '')) AS n FROM zh_th_final",
)
def list_arguments(spark: SparkSession, d: str) -> DataFrame:
    parts = F.filter(F.transform(F.split(F.coalesce("provenance", F.lit("")), ","), lambda s: F.trim(s)), lambda x: x != "")
    return table(spark, d, "zh_th_final").select("record_id", F.size(parts).alias("n"))
