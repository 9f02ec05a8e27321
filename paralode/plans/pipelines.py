"""Whole stages composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.functions import keys, normalize, scripts, urls, wiki
from paralode.operators import aggregate, dedup, domains, gates, ordered, select
from paralode.session import cut


def prepare_pool(pool: DataFrame, limits: gates.PairLimits = gates.PairLimits(), id_col: str = "pool_record_id") -> dict[str, DataFrame]:
    """Pool records to unique pairs, their domain views and what was turned away.

    ``unique``: one row per content of all records that pass the gate, with
    flags, sources, counts and a score per domain. ``eligible`` and
    ``soft_review``: (key, domain, score, reasons). ``rejected``: records with
    their reasons. ``report``: counts of each. A record without text is
    rejected, not dropped: unique rows and rejects account for every record.
    """
    rows = pool.select(F.col(id_col).alias("record_id"), "domain", "data_origin", "dataset_name", normalize.pool_text("zh_text").alias("zh"), normalize.pool_text("en_text").alias("en"))
    judged = rows.withColumn("reasons", gates.pool_gate("zh", "en", limits))
    passed = judged.filter(F.size("reasons") == 0).drop("reasons").withColumns({"key": keys.pool_pair("zh", "en", normalized=True), "flags": gates.pool_flags("zh", "en", limits)})
    lineage = F.concat_ws("/", "data_origin", "dataset_name", "domain")
    once = dedup.first_with_lineage(passed, "key", ["record_id"], "flags", lineage)
    scored = once.withColumns({"zh_chars": scripts.han("zh"), "en_words": scripts.english_words("en"), **{d: domains.domain_score("zh", "en", d) for d in domains.DOMAINS}})
    unique = cut(scored.select("key", "record_id", "zh", "en", "zh_chars", "en_words", F.col("all_flags").alias("flags"), "sources", "n_rows", *domains.DOMAINS))
    views = None
    for d in domains.DOMAINS:
        part = unique.select("key", F.lit(d).alias("domain"), F.col(f"{d}.score").alias("score"), F.col(f"{d}.eligible").alias("eligible"), domains.review_reasons(F.col(d), d).alias("reasons"))
        views = part if views is None else views.unionByName(part)
    rejected = judged.filter(F.size("reasons") > 0).select("record_id", "domain", "reasons")
    report = aggregate.report(
        {
            "unique": unique.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("records")),
            "rejected": rejected.agg(F.count("*").alias("records")),
            "reject_reasons": aggregate.explode_counter(rejected, "reasons", name="reason"),
            "eligible": aggregate.counter(views.filter("eligible"), "domain"),
        }
    )
    return {"unique": unique, "eligible": views.filter("eligible").drop("eligible"), "soft_review": views.filter("not eligible").drop("eligible"), "rejected": rejected, "report": report}


def prepare_sft(records: DataFrame, seed: str = "20260824", shares: Sequence[tuple[str, float]] = (("train", 0.9), ("validation", 0.05), ("test", 0.05)), id_col: str = "record_id", order: Sequence[str] = ("source_file", "source_row", "record_id")) -> dict[str, DataFrame]:
    """Training records with a leakage-safe split, and the rejected ones with their first reason.

    A pair in either direction is one group. Of several clean records of one
    group and direction the first in file order stays.
    """
    found = gates.sft_reasons("source_text", "target_text", "source_lang", "target_lang")
    judged = cut(
        records.select(
            F.col(id_col).alias("record_id"), *[c for c in order if c != id_col], "source_lang", "target_lang", "source_text", "target_text",
            F.concat_ws("->", "source_lang", "target_lang").alias("direction"), keys.pair_group("source_lang", "source_text", "target_lang", "target_text").alias("group"),
            found.alias("reasons"), gates.sft_warnings("source_text", "target_text", "source_lang", "target_lang").alias("warnings"),
        )
    )
    clean = judged.filter(F.size("reasons") == 0)
    names = [c if c != id_col else "record_id" for c in order]
    first = dedup.first_per_key(clean.select("group", "direction", *dict.fromkeys([*names, "record_id"])), ["group", "direction"], names).select("record_id")
    kept = clean.join(first, "record_id", "left_semi")
    repeated = clean.join(first, "record_id", "left_anti").withColumn("reasons", F.array(F.lit("duplicate_same_direction")))
    accepted = select.group_split(kept.drop("reasons"), "group", "direction", seed, shares)
    rejected = judged.filter(F.size("reasons") > 0).unionByName(repeated).select("record_id", "direction", gates.primary_reason(F.col("reasons"), gates.SFT_PRIORITY).alias("primary_reason"), "reasons")
    return {"accepted": accepted, "rejected": rejected}


def mono_corpus(pages: DataFrame, least: int = 10, least_share: float = 0.5, most: int | None = None) -> dict[str, DataFrame]:
    """Paragraphs of wiki pages as a monolingual corpus: accepted once per text in page order, rejected with a reason."""
    parts = pages.select("page_id", "title", F.posexplode(urls.paragraphs(wiki.clean_wikitext("text"))).alias("paragraph", "text"))
    judged = cut(parts.withColumn("reason", gates.mono_gate("text", least, least_share)).withColumn("text_sha256", F.sha2("text", 256)))
    good = dedup.first_per_key(judged.filter("reason is null").drop("reason"), ["text_sha256"], ["page_id", "paragraph"])
    if most is not None:
        good = ordered.first_k(good, most, "page_id", "paragraph")
    return {"accepted": good, "rejected": judged.filter("reason is not null")}


def merge_best(events: DataFrame, key: str, order: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """Last events of each provider and key, then the best of each key that succeeded and passes the merge gate."""
    latest = dedup.last_per_key(events, [key, "provider"], order).filter("status = 'success'")
    sound = latest.filter(F.size(gates.merge_gate(normalize.merge_text("zh_text"), normalize.merge_text("th_text"))) == 0)
    return ordered.best_candidate(sound, key, rank, "provider")


def audit(rows: DataFrame, id_col: str = "record_id", candidate: str = "candidate_id", zh: str = "source_text", th: str = "target_text", least_thai: int = 20, most_repeat: float = 0.5) -> DataFrame:
    """Audited Chinese-Thai rows: decision and all reasons, those of the pair gate, of Latin runs, length, repetition and duplicates."""
    judged = gates.with_audit(rows.select(F.col(id_col).alias("record_id"), F.col(candidate).alias("candidate_id"), F.col(zh).alias("zh"), F.col(th).alias("th")), "zh", "th")
    judged = judged.withColumn("latin", gates.latin_contamination("audit_th"))
    extra = gates.reasons(
        [
            ("thai_side_suspicious_lowercase_latin", F.size("latin.words") > 0),
            ("thai_latin_mixed_token", F.size("latin.mixed") > 0),
            ("target_too_short", scripts.thai("audit_th") < least_thai),
            ("repeat_score_20_too_high", scripts.repeat_score("audit_th", 20) >= most_repeat),
        ]
    )
    keyed = judged.select(
        "record_id", "candidate_id", keys.exact_pair("zh", "th").alias("pair"), F.sha2("audit_zh", 256).alias("source_key"), F.sha2("audit_th", 256).alias("target_key"),
        "reject", "review", "flags", extra.alias("extra"),
    )
    marked = dedup.occurrence_reasons(cut(keyed), "record_id", "candidate_id", "pair", "source_key", "target_key")
    reject: Column = F.concat("reject", "extra", "duplicate_reasons")
    return marked.select("record_id", gates.decision(reject, F.col("review")).alias("decision"), reject.alias("reject_reasons"), F.col("review").alias("review_reasons"), "flags")
