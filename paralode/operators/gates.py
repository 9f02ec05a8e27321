"""Quality gates: named conditions compiled into one reason array or the first reason that holds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralode.functions import normalize, scripts
from paralode.functions.scripts import count, english_words, han, latin, share, thai, visible
from paralode.functions.text import casefold, let

Rule = tuple[str, Column]


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of all conditions that hold, in order, each once. A null condition does not hold."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules])))


def first_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first condition that holds, else null."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in rules])


def primary_reason(found: Column, priority: Sequence[str]) -> Column:
    """Of the reasons found, the one that comes first in a list of priorities."""
    order = F.array(*[F.lit(p) for p in priority])
    return F.try_element_at(F.array_intersect(order, found), F.lit(1))


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


# Sequences that wrong decodings of Chinese text leave behind.
STRONG_MARKS = ("�", "\x00", "锟斤拷", "鏁欏笀")
WEAK_MARKS = ("鈥?", "鈥", "銆?", "锛?", "涓€", "脙", "脗", "芒鈧")
MERGE_MARKS = r"(?:\x{FFFD}|鏁|鈥|锟|à¸|à¹|Ã.|Â.)"
AUDIT_MARKS = (
    r"(?:\x{FFFD}|锟斤拷|鏁欏笀|鈥[?？]|\x{C3}.|\x{C2}.|\x{E2}(?:\x{20AC}|\x{2122}|\x{153}|\x{17E})|\x{E0}(?:\x{B8}|\x{B9})|\x{EF}\x{BF}\x{BD})"
)


def occurrences(c: Column, mark: str) -> Column:
    """How often a plain string occurs, without overlap."""
    return (F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)


def marker_hits(c: Column | str, marks: Sequence[str]) -> Column:
    c = _text(c)
    total = occurrences(c, marks[0])
    for m in marks[1:]:
        total = total + occurrences(c, m)
    return total.cast("int")


def looks_garbled(c: Column | str, least_weak: int = 2) -> Column:
    """A strong mark, or at least ``least_weak`` weak ones."""
    return (marker_hits(c, STRONG_MARKS) > 0) | (marker_hits(c, WEAK_MARKS) >= least_weak)


@dataclass(frozen=True)
class PairLimits:
    """Bounds of the pool gate."""

    min_zh: int = 100
    max_zh: int = 220
    min_words: int = 20
    hard_ratio: tuple[float, float] = (0.25, 6.0)
    soft_ratio: tuple[float, float] = (0.5, 4.0)
    min_han_share: float = 0.5
    min_latin_share: float = 0.8


def han_per_word(zh: Column, en: Column, variant: str = "pool") -> Column:
    """Han letters of the Chinese side per word of the English side."""
    return han(zh, variant) / F.greatest(english_words(en), F.lit(1))


def pool_gate(zh: Column | str, en: Column | str, limits: PairLimits = PairLimits()) -> Column:
    """Hard reasons of a Chinese-English pair in pool form."""
    zh, en = _text(zh), _text(en)
    both = (zh != "") & (en != "")
    low, high = limits.hard_ratio
    return reasons(
        [
            ("empty_text", ~both),
            ("identical_bilingual_text", both & (casefold(zh) == casefold(en))),
            ("chinese_language_error", (zh != "") & (han(zh) / F.greatest(han(zh) + latin(zh), F.lit(1)) < limits.min_han_share)),
            ("english_language_error", (en != "") & (latin(en) / F.greatest(latin(en) + han(en), F.lit(1)) < limits.min_latin_share)),
            ("zh_chars_below_minimum", han(zh) < limits.min_zh),
            ("zh_chars_above_maximum", han(zh) > limits.max_zh),
            ("english_words_below_minimum", english_words(en) < limits.min_words),
            ("severe_mojibake", looks_garbled(F.concat_ws("\n", zh, en))),
            ("extreme_length_ratio", ~han_per_word(zh, en).between(low, high)),
        ]
    )


def pool_flags(zh: Column | str, en: Column | str, limits: PairLimits = PairLimits()) -> Column:
    """Soft flags of a pair: unusual length ratio, numbers that differ."""
    zh, en = _text(zh), _text(en)
    (low, high), (least, most) = limits.soft_ratio, limits.hard_ratio
    ratio = han_per_word(zh, en)
    return reasons([("length_ratio_outlier", ratio.between(least, most) & ~ratio.between(low, high)), ("number_mismatch", ~scripts.same_numbers(zh, en))])


def sentence_gate(zh: Column | str, en: Column | str) -> Column:
    """First reason against an aligned sentence pair in bitext form, else null."""
    zh, en = _text(zh), _text(en)
    return first_reason(
        [
            ("empty_text", (zh == "") | (en == "")),
            ("text_corruption", looks_garbled(zh) | looks_garbled(en)),
            ("identical_bilingual_text", casefold(zh) == casefold(en)),
            ("chinese_language_error", (han(zh, "basic") < 2) | (han(zh, "basic") / F.greatest(visible(zh), F.lit(1)) < 0.10)),
            ("english_language_error", (english_words(en) < 2) | (latin(en) / F.greatest(visible(en), F.lit(1)) < 0.20)),
        ]
    )


def tsv_gate(en: Column | str, zh: Column | str, min_zh: int = 3, min_words: int = 3, ratio: tuple[float, float] = (0.7, 3.5)) -> Column:
    """First reason against a row of a TSV bitext, else null."""
    zh, en = _text(zh), _text(en)
    header = F.lower(F.trim(en)).isin("en", "english", "en_text", "english_text") & F.lower(F.trim(zh)).isin("zh", "zh-cn", "chinese", "zh_text", "chinese_text")
    return first_reason(
        [
            ("empty_field", (zh == "") | (en == "")),
            ("header_row", header),
            ("publication_boilerplate", en.rlike(r"(?i)^(?:Ends(?:/|$)|Issued\s+at\s+HKT\b|NNNN\b)")),
            ("row_too_short", (han(zh, "tsv") < min_zh) | (english_words(en) < min_words)),
            ("english_column_language_mismatch", han(en, "tsv") > 2),
            ("length_ratio_outlier", ~han_per_word(zh, en, "tsv").between(*ratio)),
        ]
    )


def merge_gate(zh: Column | str, th: Column | str) -> Column:
    """Hard reasons of a Chinese-Thai pair in merge form."""
    zh, th = _text(zh), _text(th)
    letters = count(th, r"\p{L}")
    thai_share = count(th, r"[\x{0E00}-\x{0E7F}&&\p{L}]") / F.greatest(letters, F.lit(1))
    ratio = F.char_length(th) / F.greatest(F.char_length(zh), F.lit(1))
    has_zh, has_th = zh != "", th != ""
    return reasons(
        [
            ("empty_chinese", ~has_zh),
            ("empty_thai", ~has_th),
            ("chinese_side_has_no_han", has_zh & (han(zh, "merge") == 0)),
            ("thai_side_has_no_thai", has_th & (thai(th) == 0)),
            ("identical_sides", has_zh & has_th & (zh == th)),
            ("mojibake", zh.rlike(MERGE_MARKS) | th.rlike(MERGE_MARKS)),
            ("thai_side_contains_han", han(th, "merge") > 0),
            ("thai_side_not_thai_dominant", has_th & (thai_share < 0.5)),
            ("chinese_side_looks_thai", has_zh & (thai(zh) > F.greatest(F.lit(5), han(zh, "merge")))),
            ("extreme_length_ratio", has_zh & has_th & ~ratio.between(0.1, 8.0)),
        ]
    )


def merge_flags(zh: Column | str, th: Column | str) -> Column:
    zh, th = _text(zh), _text(th)
    ratio = F.char_length(th) / F.greatest(F.char_length(zh), F.lit(1))
    return reasons(
        [
            ("unusual_length_ratio", (zh != "") & (th != "") & ratio.between(0.1, 8.0) & ~ratio.between(0.25, 4.0)),
            ("source_has_digits_target_has_none", zh.rlike(r"\p{Nd}") & ~th.rlike(r"\p{Nd}")),
        ]
    )


@F.pandas_udf(T.DoubleType())
def compression_ratio(texts: pd.Series) -> pd.Series:
    """zlib size over byte size of a text, 0 for an empty one."""
    import zlib

    def one(t: str | None) -> float:
        raw = (t or "").encode("utf-8", "replace")
        return round(len(zlib.compress(raw, 9)) / max(len(raw), 1), 6)

    return texts.map(one).astype("float64")


def _collapsed(c: Column, unique_below: float, ratio_below: float, n: int = 8) -> Column:
    """Few distinct n-grams and a small compressed size; only repetitive long texts reach the compression."""
    suspect = let(c, lambda t: F.when((F.char_length(t) >= 100) & (1 - scripts.repeat_score(t, n) < unique_below), t))
    return F.coalesce(compression_ratio(suspect) < ratio_below, F.lit(False)) & suspect.isNotNull()


def severe_repetition(c: Column | str) -> Column:
    """One unit repeated over 80 characters or more, or a text that collapses to a few n-grams."""
    form = normalize.sft_text(c)
    return (scripts.loop_span(form) >= 80) | _collapsed(form, 0.15, 0.12)


def with_audit(df: DataFrame, zh: str, th: str) -> DataFrame:
    """Adds audit_zh, audit_th (merge form) and the reason arrays reject, review and flags of a Chinese-Thai pair.

    Judged on the raw text and on its merge form. Forms, script counts and
    English counts are columns of their own first, so each is computed once.
    """
    given = df.withColumns({"__raw_zh": _text(zh), "__raw_th": _text(th)})
    forms = given.withColumns({"audit_zh": normalize.merge_text("__raw_zh"), "audit_th": normalize.merge_text("__raw_th")})
    counted = forms.withColumns(
        {
            "__p_zh": scripts.script_profile("audit_zh"), "__p_th": scripts.script_profile("audit_th"),
            "__e_zh": scripts.english_profile("audit_zh"), "__e_th": scripts.english_profile("audit_th"),
            "__loop": scripts.loop_span("audit_th"), "__collapsed": _collapsed(F.col("audit_th"), 0.20, 0.20),
        }
    )
    raw_zh, raw_th, zh_, th_ = F.col("__raw_zh"), F.col("__raw_th"), F.col("audit_zh"), F.col("audit_th")
    p_zh, p_th, e_zh, e_th = F.col("__p_zh"), F.col("__p_th"), F.col("__e_zh"), F.col("__e_th")
    either = lambda p: raw_zh.rlike(p) | raw_th.rlike(p)
    large = lambda e: (e["latin_letter_count"] >= 100) | (e["english_word_count"] >= 20) | (e["longest_english_block"] >= 100)
    supported = large(e_th) & (e_zh["latin_letter_count"] >= 20) & (scripts.english_support(th_, zh_) >= 0.6)
    ratio = F.char_length(th_) / F.greatest(F.char_length(zh_), F.lit(1))
    has_zh, has_th = zh_ != "", th_ != ""
    no_han, no_thai = has_zh & (p_zh["han_count"] == 0), has_th & (p_th["thai_count"] == 0)
    reject = reasons(
        [
            ("empty_chinese", ~has_zh),
            ("empty_thai", ~has_th),
            ("control_character", either(normalize.CONTROL)),
            ("invisible_format_character", either(normalize.BIDI_ZERO_WIDTH)),
            ("mojibake", either(AUDIT_MARKS)),
            ("private_use_character", either(r"\p{Co}")),
            ("chinese_side_has_no_han", no_han),
            ("chinese_side_contains_thai", thai(zh_) > 0),
            ("thai_side_has_no_thai", no_thai),
            ("thai_side_not_thai_dominant", ~no_thai & (p_th["thai_ratio"] < 0.5)),
            ("thai_side_contains_han", han(th_, "audit") > 0),
            ("thai_side_foreign_letter_mark", th_.rlike(r"[\p{L}\p{M}&&[^\x{0E00}-\x{0E7F}\p{IsLatin}]]")),
            ("continuous_repetition", F.col("__loop") >= 40),
            ("severe_ngram_collapse", F.col("__collapsed")),
            ("source_target_identical", has_zh & has_th & (casefold(zh_) == casefold(th_))),
            ("extreme_length_ratio", has_zh & has_th & ~ratio.between(0.1, 8.0)),
        ]
    )
    review = reasons(
        [
            ("chinese_side_not_han_dominant", ~no_han & (p_zh["han_ratio"] < 0.5)),
            ("chinese_side_foreign_letter_mark", zh_.rlike(r"[\p{L}\p{M}&&[^\p{IsHan}\p{IsLatin}]]")),
            ("thai_script_ratio_below_0_80", ~no_thai & (p_th["thai_ratio"] >= 0.5) & (p_th["thai_ratio"] < 0.8)),
            ("large_abnormal_english", large(e_th) & ~supported),
        ]
    )
    flags = reasons(
        [
            ("source_supported_large_english", supported),
            ("chinese_source_contains_large_english", large(e_zh)),
            ("unusual_length_ratio", has_zh & has_th & ratio.between(0.1, 8.0) & ~ratio.between(0.25, 4.0)),
        ]
    )
    judged = counted.withColumns({"reject": reject, "review": review, "flags": flags})
    return judged.drop("__raw_zh", "__raw_th", "__p_zh", "__p_th", "__e_zh", "__e_th", "__loop", "__collapsed")


def decision(reject: Column, review: Column) -> Column:
    return F.when(F.size(reject) > 0, "reject").when(F.size(review) > 0, "review").otherwise("accept")


def mono_gate(text: Column | str, least: int = 10, least_share: float = 0.5) -> Column:
    """First reason against a Thai text, else null."""
    c = _text(text)
    n = thai(c)
    return first_reason(
        [
            ("empty_after_cleaning", c == ""),
            ("symbols_only", ~c.rlike(r"[\p{L}\p{M}\p{N}]")),
            ("too_few_thai_characters", n < least),
            ("not_thai_dominant", n / F.greatest(count(c, r"[\p{L}\p{M}]"), F.lit(1)) < least_share),
            ("residual_wiki_markup", c.rlike(r"\{\{|\}\}|\[\[|\]\]")),
        ]
    )


# Spans of a Thai text in which Latin letters are in place.
PROTECTED = (
    r"(?i)\b(?:https?://|www\.)[^\s<>]+",
    r"(?i)\b(?:contact(?:\s+(?:at|:))?\s+)?[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    r"\b(?:[A-Z]+(?:[-/]\d+)+(?:/\d+)*|\d+(?:/\d+)+)\b",
)


def latin_contamination(c: Column | str) -> Column:
    """Struct of lower-case Latin words and of units that mix Thai with lower-case Latin, each once in order.

    Addresses and identifiers are blanked out first. A unit of Thai and Latin
    letters mixes where it has one lower-case letter; runs of four or more in it,
    and plain lower-case words of four or more, are suspicious.
    """
    masked = _text(c)
    for p in PROTECTED:
        masked = F.regexp_replace(masked, p, " ")
    units = F.regexp_extract_all(masked, F.lit(r"[A-Za-z\x{0E00}-\x{0E7F}]+"), F.lit(0))
    has_thai = lambda u: u.rlike(scripts.THAI)
    words = F.flatten(
        F.transform(
            units,
            lambda u: F.when(has_thai(u), F.regexp_extract_all(u, F.lit("[a-z]{4,}"), F.lit(0)))
            .when(u.rlike("^[a-z]{4,}$"), F.array(u))
            .otherwise(F.array().cast("array<string>")),
        )
    )
    return F.struct(F.array_distinct(words).alias("words"), F.array_distinct(F.filter(units, lambda u: has_thai(u) & u.rlike("[a-z]"))).alias("mixed"))


#: Least letters and least share of a language on its side of a record: (script, letters, share).
SIDES = {"zh-CN": ("han", 10, 0.40), "en": ("latin", 20, 0.70), "th": ("thai", 10, 0.50)}


def side_quality(text: Column | str, lang: Column | str) -> Column:
    """Struct (share, amount, passes, borderline) of a side under the language it should be in; other languages fail."""
    lang = F.col(lang) if isinstance(lang, str) else lang

    def judge(k: Column) -> Column:
        total = F.greatest(k["han"] + k["latin"] + k["thai"], F.lit(1))
        ratio, amount, ok = F.lit(0.0), F.lit(0), F.lit(False)
        for name, (script, least, least_share) in SIDES.items():
            hit = k["lang"] == name
            ratio = F.when(hit, k[script] / total).otherwise(ratio)
            amount = F.when(hit, k[script]).otherwise(amount)
            ok = F.when(hit, (k[script] >= least) & (k[script] / total >= least_share)).otherwise(ok)
        return F.struct(F.round(ratio, 6).alias("share"), amount.cast("int").alias("amount"), ok.alias("passes"), (ok & (ratio < 0.85)).alias("borderline"))

    def counts(c: Column) -> Column:
        return F.struct(han(c, "sft").alias("han"), count(c, r"[\p{IsLatin}&&\p{L}]").alias("latin"), thai(c).alias("thai"), F.coalesce(lang, F.lit("")).alias("lang"))

    return let(let(_text(text), counts), judge)


SFT_PRIORITY = (
    "empty_source", "empty_target", "source_equals_target", "invalid_direction", "source_language_mismatch",
    "target_language_mismatch", "severe_target_repetition", "duplicate_same_direction",
)
DIRECTIONS = ("zh-CN->en", "en->zh-CN", "zh-CN->th", "th->zh-CN")


def sft_reasons(source: Column | str, target: Column | str, source_lang: Column | str, target_lang: Column | str) -> Column:
    """Reasons against a training record, without the check for duplicates."""
    sl, tl = (F.col(x) if isinstance(x, str) else x for x in (source_lang, target_lang))
    forms = F.struct(normalize.sft_text(source).alias("s"), normalize.sft_text(target).alias("t"), F.coalesce(sl, F.lit("")).alias("sl"), F.coalesce(tl, F.lit("")).alias("tl"))

    def plain(f: Column) -> Column:
        known = F.concat_ws("->", f["sl"], f["tl"]).isin(*DIRECTIONS)
        return reasons(
            [
                ("empty_source", f["s"] == ""),
                ("empty_target", f["t"] == ""),
                ("source_equals_target", (f["s"] != "") & (casefold(f["s"]) == casefold(f["t"]))),
                ("invalid_direction", ~known),
                ("source_language_mismatch", known & (f["s"] != "") & ~side_quality(f["s"], f["sl"])["passes"]),
                ("target_language_mismatch", known & (f["t"] != "") & ~side_quality(f["t"], f["tl"])["passes"]),
            ]
        )

    return F.concat(let(forms, plain), reasons([("severe_target_repetition", severe_repetition(target))]))


def sft_warnings(source: Column | str, target: Column | str, source_lang: Column | str, target_lang: Column | str) -> Column:
    langs = [F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (source_lang, target_lang)]
    forms = F.struct(normalize.sft_text(source).alias("s"), normalize.sft_text(target).alias("t"), langs[0].alias("sl"), langs[1].alias("tl"))

    def plain(f: Column) -> Column:
        ratio = F.char_length(f["t"]) / F.greatest(F.char_length(f["s"]), F.lit(1))
        return reasons(
            [
                ("source_language_ratio_borderline", side_quality(f["s"], f["sl"])["borderline"]),
                ("target_language_ratio_borderline", side_quality(f["t"], f["tl"])["borderline"]),
                ("length_ratio_extreme", ~ratio.between(0.2, 5.0)),
                ("long_text", F.greatest(F.char_length(f["s"]), F.char_length(f["t"])) > 2000),
            ]
        )

    return let(forms, plain)


def submission_reasons(row: dict[str, Column]) -> Column:
    """Reasons against a row of a delivered file: fields, languages, lengths and the recounted Han letters."""
    s, t = _text(row["source_text"]), _text(row["target_text"])
    zh = F.when(row["source_lang"] == "zh-CN", s).otherwise(t)
    en = F.when(row["source_lang"] == "zh-CN", t).otherwise(s)
    counted = row["zh_char_count"]
    return reasons(
        [
            ("empty_source", F.trim(s) == ""),
            ("empty_target", F.trim(t) == ""),
            ("invalid_domain", ~F.coalesce(row["domain"].isin("education", "technology", "finance"), F.lit(False))),
            ("invalid_direction", ~F.coalesce(F.concat_ws("->", row["source_lang"], row["target_lang"]).isin("zh-CN->en", "en->zh-CN"), F.lit(False))),
            ("identical_texts", (s != "") & (s == t)),
            ("chinese_without_han", han(zh, "script") == 0),
            ("english_without_words", english_words(en) == 0),
            ("invalid_count", counted.isNull() | (counted < 0)),
            ("count_mismatch", counted.isNotNull() & (counted != han(zh, "script"))),
        ]
    )


def split_gate(df: DataFrame, found: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with the column ``reasons``) of a table under a reason array."""
    judged = df.withColumn("reasons", found)
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def reversed_field(zh: Column | str, en: Column | str) -> Column:
    """Names the side whose text is clearly in the other language, else null."""
    zh, en = _text(zh), _text(en)
    return first_reason(
        [
            ("zh_text_appears_to_be_english", (english_words(zh) >= 20) & (han(zh, "named") < 10)),
            ("en_text_appears_to_be_chinese", (han(en, "named") >= 20) & (english_words(en) < 5)),
        ]
    )


# What a record calls a translation that went well.
SUCCESS = ("accepted", "complete", "completed", "ready", "success", "succeeded", "translated")


def is_successful(*status: Column) -> Column:
    """The first status that is not null says success; without any it counts as success."""
    first = F.coalesce(*status)
    return first.isNull() | F.lower(F.trim(first)).isin(*SUCCESS)


def present(c: Column | str) -> Column:
    """A text that is neither null nor blank."""
    return F.length(F.trim(_text(c))) > 0


