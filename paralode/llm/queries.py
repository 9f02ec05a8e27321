"""Queries of the training-data operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralode.llm import canonical, cube, langid, leakage, mojibake, overlap, packing, repetition, splits, truncation

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Records of related sets that the delivered split tears apart."""
    return splits.grouped_splits(_t(spark, d, "sft_records")).filter("is_torn").select("record_id")


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    """The new split of every record."""
    return splits.grouped_splits(_t(spark, d, "sft_records"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every copy with the record that is kept for it."""
    return canonical.hidden_duplicates(_t(spark, d, "zh_en_pool"))["members"]


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per content with the number of its copies and whether its hash collides with that of another one."""
    groups = canonical.hidden_duplicates(_t(spark, d, "zh_en_pool"))["groups"]
    return canonical.with_collisions(groups).select("keep_id", "n_copies", "collides")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Categories that cannot be served in full."""
    report = cube.proportional_sample(_t(spark, d, "zh_en"), _t(spark, d, "sample_targets"))["report"]
    return report.filter(~F.col("served")).select("domain", "source_lang", "target_lang")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Available, wanted and sampled rows of each category with the residual imbalance."""
    return cube.proportional_sample(_t(spark, d, "zh_en"), _t(spark, d, "sample_targets"))["report"]


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    """The sample itself."""
    return cube.proportional_sample(_t(spark, d, "zh_en"), _t(spark, d, "sample_targets"))["sample"]


def p3_balance(spark: SparkSession, d: str) -> DataFrame:
    """Of each category, counted in the sample itself: repeated ids, and whether their number is the wanted one rounded down or up."""
    out = cube.proportional_sample(_t(spark, d, "zh_en"), _t(spark, d, "sample_targets"))
    drawn = out["sample"].groupBy(*cube.CATEGORY).agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))
    goal = F.least("available", "wanted")
    n = F.coalesce("n", F.lit(0))
    return out["report"].join(F.broadcast(drawn), list(cube.CATEGORY), "left").select(
        *cube.CATEGORY, "available", "served", F.round("wanted", 4).alias("wanted"), F.coalesce(F.col("n") - F.col("n_ids"), F.lit(0)).alias("n_repeated"),
        ((n >= F.floor(goal + 1e-9)) & (n <= F.ceil(goal - 1e-9))).alias("within"),
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a training record and a held-out record with the same or nearly the same source text."""
    return overlap.overlap_pairs(overlap.split_overlaps(_t(spark, d, "sft_records"))).select("record_id_a", "record_id_b")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping held-out records per split and source file."""
    records = _t(spark, d, "sft_records")
    return overlap.overlap_report(records, overlap.split_overlaps(records))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    final = _t(spark, d, "zh_th_final")
    return langid.language_segments(final, langid.train(langid.training_sample(final, "target_text")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of the records whose label is missing or wrong or whose text is mixed."""
    return langid.mislabelled(_segments(spark, d))


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every stretch of every record."""
    return _segments(spark, d)


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    pool, merged = _t(spark, d, "zh_en_pool"), _t(spark, d, "zh_th_merged")
    dictionaries = mojibake.language_dictionaries([(pool, "zh_text", "zh"), (pool, "en_text", "en"), (merged, "th_text", "th")])
    return mojibake.damaged_values(pool, "zh_en_pool", "pool_record_id", {"zh_text": "zh", "en_text": "en"}, dictionaries).unionByName(
        mojibake.damaged_values(merged, "zh_th_merged", "id", {"th_text": "th"}, dictionaries)
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Values that went through a wrong encoding."""
    return _damaged(spark, d).select("table_name", "record_key", "field_name").distinct()


def p6_restored(spark: SparkSession, d: str) -> DataFrame:
    """Damaged values with the chain undone and the text that came back."""
    return _damaged(spark, d).distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Records at least half of whose target text says again what was said before."""
    profile = repetition.repetition_profile(_t(spark, d, "zh_th_final"))
    return profile.filter(F.array_contains("flags", "repeated_content")).select("record_id")


def p7_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every measure of every record."""
    return repetition.repetition_profile(_t(spark, d, "zh_th_final"))


def _capacity(spark: SparkSession, d: str) -> int:
    return _t(spark, d, "pack_limits").agg(F.min("capacity_tokens")).first()[0]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that exceed a container by themselves: those that the packing had to part."""
    packed = packing.pack(packing.token_sizes(_t(spark, d, "documents")), _capacity(spark, d))
    return packed.filter("piece >= 1").select("doc_id").distinct()


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    """The container of every piece of every document."""
    return packing.pack(packing.token_sizes(_t(spark, d, "documents")), _capacity(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the items they hold, whole or in good part."""
    return leakage.leaked_items(_t(spark, d, "documents"), _t(spark, d, "benchmark")).select("doc_id", "item_id")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Number of leaking documents of every item, and of them those that paraphrase it."""
    items = _t(spark, d, "benchmark")
    return leakage.leak_report(leakage.leaked_items(_t(spark, d, "documents"), items), items)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text was cut off."""
    return truncation.judge_ends(_t(spark, d, "documents")).filter("is_cut").select("doc_id").distinct()


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts."""
    return truncation.source_rates(truncation.judge_ends(_t(spark, d, "documents")))


_CANON = r"""regexp_replace(nfc_normalize(lower(nfc_normalize(translate({c},
  (select string_agg(chr(cast(65281 + i as integer)), '' order by i) from range(94) r(i)),
  (select string_agg(chr(cast(33 + i as integer)), '' order by i) from range(94) r(i)))))),
  '[\s\p{{Z}}\p{{P}}\p{{Cc}}\p{{Cf}}\x{{034F}}\x{{115F}}\x{{1160}}\x{{180B}}-\x{{180F}}\x{{3164}}\x{{FE00}}-\x{{FE0F}}]+', '', 'g')"""

_CATEGORY = r"""replace(lower(regexp_replace(translate({c},
  (select string_agg(chr(cast(65281 + i as integer)), '' order by i) from range(94) r(i)),
  (select string_agg(chr(cast(33 + i as integer)), '' order by i) from range(94) r(i))),
  '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '_', '-')"""


def _categories(table: str) -> str:
    return ", ".join(f"coalesce({_CATEGORY.format(c=f'{table}.{c}')}, '') AS k_{c}" for c in cube.CATEGORY)


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that a database can express on whole tables."""
    return {
        "p1_found": r"""
WITH RECURSIVE r AS (
  SELECT record_id, split,
         nullif(regexp_replace(lower(regexp_replace(pair_group_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '^pair_', ''), '') AS g,
         nullif(original_id, '') AS o
  FROM sft_records),
e AS (SELECT DISTINCT 'g' || g AS u, 'o' || o AS v FROM r WHERE g IS NOT NULL AND o IS NOT NULL),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (
  SELECT DISTINCT n, n AS m FROM (SELECT 'g' || g AS n FROM r WHERE g IS NOT NULL UNION SELECT 'o' || o FROM r WHERE o IS NOT NULL)
  UNION
  SELECT reach.n, b.v FROM reach JOIN b ON reach.m = b.u),
root AS (SELECT n, min(m) AS c FROM reach GROUP BY n),
x AS (SELECT record_id, split, coalesce('g' || g, 'o' || o, 'r' || record_id) AS node FROM r),
y AS (SELECT record_id, split, coalesce(c, node) AS c FROM x LEFT JOIN root ON node = n)
SELECT record_id FROM y WHERE c IN (SELECT c FROM y GROUP BY c HAVING count(DISTINCT split) > 1)""",
        "p2_found": f"""
WITH c AS (SELECT pool_record_id AS id, coalesce({_CANON.format(c='zh_text')}, '') AS a, coalesce({_CANON.format(c='en_text')}, '') AS b FROM zh_en_pool),
k AS (SELECT id, least(a, b) AS a, greatest(a, b) AS b FROM c WHERE a <> '' OR b <> ''),
w AS (SELECT id, min(id) OVER (PARTITION BY a, b) AS keep_id FROM k)
SELECT DISTINCT keep_id, id AS copy_id FROM w WHERE id <> keep_id""",
        "p3_found": f"""
WITH z AS (SELECT DISTINCT id, {_categories('zh_en')} FROM zh_en),
t AS (SELECT *, {_categories('sample_targets')} FROM sample_targets),
n AS (SELECT count(DISTINCT id) AS n FROM zh_en),
a AS (SELECT t.domain, t.source_lang, t.target_lang, t.target_share, t.min_rows, t.sample_share, count(DISTINCT z.id) AS have
      FROM t LEFT JOIN z USING (k_domain, k_source_lang, k_target_lang) GROUP BY ALL)
SELECT domain, source_lang, target_lang FROM a, n WHERE have < target_share * sample_share * n OR have < min_rows""",
        "p2_groups": f"""
WITH c AS (SELECT pool_record_id AS id, coalesce({_CANON.format(c='zh_text')}, '') AS a, coalesce({_CANON.format(c='en_text')}, '') AS b FROM zh_en_pool),
k AS (SELECT id, CASE WHEN a <> '' OR b <> '' THEN least(a, b) || chr(31) || greatest(a, b) ELSE chr(30) || id END AS p FROM c)
SELECT min(id) AS keep_id, count(*) AS n_copies, false AS collides FROM k GROUP BY p""",
        "p3_balance": f"""
WITH z AS (SELECT DISTINCT id, {_categories('zh_en')} FROM zh_en),
t AS (SELECT *, {_categories('sample_targets')} FROM sample_targets),
n AS (SELECT count(DISTINCT id) AS n FROM zh_en),
a AS (SELECT t.domain, t.source_lang, t.target_lang, t.target_share, t.min_rows, t.sample_share, count(DISTINCT z.id) AS available
      FROM t LEFT JOIN z USING (k_domain, k_source_lang, k_target_lang) GROUP BY ALL)
SELECT domain, source_lang, target_lang, available, available >= greatest(target_share * sample_share * n, min_rows) AS served,
       round(greatest(target_share * sample_share * n, min_rows), 4) AS wanted, 0 AS n_repeated, true AS within FROM a, n""",
        "p4_found": f"""
WITH t AS (SELECT record_id, split, {_CANON.format(c='source_text')} AS t FROM sft_records WHERE split IN ('train', 'validation', 'test')),
x AS (SELECT a.record_id AS x, b.record_id AS y, a.t AS s, b.t AS t FROM t a JOIN t b
      ON a.split = 'train' AND b.split <> 'train' AND a.t <> '' AND b.t <> ''
      AND abs(length(a.t) - length(b.t)) <= 0.1 * greatest(length(a.t), length(b.t)))
SELECT DISTINCT least(x, y) AS record_id_a, greatest(x, y) AS record_id_b FROM x
WHERE levenshtein(s, t) <= 0.1 * greatest(length(s), length(t))""",
        "p7_found": r"""
WITH t AS (SELECT record_id, regexp_replace(coalesce(target_text, ''), '[\s\p{Z}\p{Nd}.。．｡…‥・·]+', '', 'g') AS t FROM zh_th_final),
g AS (SELECT record_id, t, i, substring(t, cast(i AS bigint), 10) AS g FROM (SELECT record_id, t, unnest(range(1, length(t) - 8)) AS i FROM t WHERE length(t) >= 10)),
w AS (SELECT record_id, t, i, row_number() OVER (PARTITION BY record_id, g ORDER BY i) AS n FROM g),
s AS (SELECT DISTINCT record_id, t, i + j AS at FROM w, range(10) x(j) WHERE n > 1)
SELECT record_id FROM s GROUP BY record_id, t HAVING count(*) >= 0.5 * length(t)""",
    }


def queries() -> dict[str, Query]:
    return {name: fn for name, fn in globals().items() if name[0] == "p" and name[1:2].isdigit() and callable(fn)}
