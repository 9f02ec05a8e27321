"""Counts of scripts, words and numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paralode.functions.normalize import page_text
from paralode.functions.text import nfkc

# The Han classes that the stages of the corpus use; none is interchangeable with another.
HAN = {
    "script": r"\p{IsHan}",
    "pool": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]",
    "basic": r"[\x{4E00}-\x{9FFF}]",
    "tsv": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]",
    "named": r"[\x{3007}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}&&[\p{L}\x{3007}]]",
    "merge": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FA1F}\x{30000}-\x{323AF}]",
    "audit": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]",
    "sft": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3134F}]",
    "submission": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{20000}-\x{2EBEF}]",
}
THAI = r"[\x{0E00}-\x{0E7F}]"
LATIN_ASCII = "[A-Za-z]"
LATIN = r"\p{IsLatin}"
LETTER_MARK = r"[\p{L}\p{M}]"
ENGLISH_WORD = r"[A-Za-z]+(?:['’-][A-Za-z]+)*"
NUMBER = r"(?<![A-Za-z0-9])[+-]?\d+(?:[.,]\d+)*(?:%|％)?"
ENGLISH_BLOCK = r"(?:[A-Za-z][A-Za-z0-9'’_-]*(?:[ \t,.;:()/+&-]+|$)){5,}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count(c: Column | str, pattern: str) -> Column:
    """Matches of a pattern; null counts as an empty text."""
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(pattern))


def han(c: Column | str, variant: str = "pool") -> Column:
    return count(c, HAN[variant])


def thai(c: Column | str) -> Column:
    return count(c, THAI)


def latin(c: Column | str) -> Column:
    return count(c, LATIN_ASCII)


def letters(c: Column | str) -> Column:
    """Letters and marks."""
    return count(c, LETTER_MARK)


def visible(c: Column | str) -> Column:
    """Characters that are no white space."""
    return F.char_length(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"[\s\p{Z}]+", ""))


def english_words(c: Column | str) -> Column:
    return count(c, ENGLISH_WORD)


def numbers(c: Column | str) -> Column:
    """Sorted distinct numbers of a text in compatibility form, thousands separators dropped."""
    found = F.regexp_extract_all(nfkc(F.coalesce(_col(c), F.lit(""))), F.lit(NUMBER), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda n: F.replace(F.replace(n, F.lit(","), F.lit("")), F.lit("％"), F.lit("%")))))


def same_numbers(a: Column | str, b: Column | str) -> Column:
    return numbers(a) == numbers(b)


def share(n: Column, total: Column, digits: int = 6) -> Column:
    """A rounded ratio whose denominator is at least one."""
    return F.round(n / F.greatest(total, F.lit(1)), digits)


def script_profile(c: Column | str, han_variant: str = "audit") -> Column:
    """Struct of letter and mark counts and the shares of Han, Thai and Latin among them."""
    c = F.coalesce(_col(c), F.lit(""))
    total, h, t, l = letters(c), han(c, han_variant), count(c, r"[\x{0E00}-\x{0E7F}&&[\p{L}\p{M}]]"), count(c, r"[\p{IsLatin}&&[\p{L}\p{M}]]")
    return F.struct(
        total.alias("letter_mark_count"), h.alias("han_count"), t.alias("thai_count"), l.alias("latin_count"),
        share(h, total).alias("han_ratio"), share(t, total).alias("thai_ratio"), share(l, total).alias("latin_ratio"),
    )


def language(label: Column | str, text: Column | str) -> Column:
    """Main language of a label in any spelling (en, EN, en-US, zh_CN); without a label that of the script most letters have, zh, th or en."""
    main = F.regexp_extract(F.lower(F.coalesce(_col(label), F.lit(""))), r"^[\s\p{Z}]*([a-z]+)", 1)
    of_han, of_thai, of_latin = han(text), thai(text), latin(text)
    script = F.when((of_thai > of_han) & (of_thai > of_latin), "th").when((of_han > of_thai) & (of_han > of_latin), "zh").when((of_latin > of_han) & (of_latin > of_thai), "en")
    return F.when((main != "") & ~main.isin("und", "unknown"), main).otherwise(script)


def repeat_score(c: Column | str, n: int, compact: bool = True) -> Column:
    """One minus the share of distinct n-grams of characters; texts shorter than n score 0 for no gram."""
    c = F.coalesce(_col(c), F.lit(""))
    if compact:
        c = F.regexp_replace(c, r"[\s\p{Z}]+", "")
    grams = F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return F.when(F.size(grams) > 0, F.round(1 - F.size(F.array_distinct(grams)) / F.size(grams), 6)).otherwise(F.lit(0.0))


def loop_span(c: Column | str, low: int = 2, high: int = 40, times: int = 5) -> Column:
    """Length of the first stretch that is one unit of low to high characters at least ``times`` times in a row."""
    return F.char_length(F.regexp_extract(F.coalesce(_col(c), F.lit("")), rf"(.{{{low},{high}}}?)\1{{{times - 1},}}", 0))


def english_profile(c: Column | str) -> Column:
    """Struct of Latin letters, English words and the longest run of five or more English words."""
    c = F.coalesce(_col(c), F.lit(""))
    blocks = F.regexp_extract_all(c, F.lit(ENGLISH_BLOCK), F.lit(0))
    return F.struct(
        count(c, r"[\p{IsLatin}&&\p{L}]").alias("latin_letter_count"),
        english_words(c).alias("english_word_count"),
        F.coalesce(F.array_max(F.transform(blocks, F.char_length)), F.lit(0)).alias("longest_english_block"),
    )


def english_support(target: Column | str, source: Column | str) -> Column:
    """Share of the target's English words, repeats included, that the source has too."""
    words = lambda x: F.transform(F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(ENGLISH_WORD), F.lit(0)), F.lower)
    mine, theirs = words(target), F.array_distinct(words(source))
    return share(F.size(F.filter(mine, lambda w: F.array_contains(theirs, w))), F.size(mine))


def chinese_sentences(c: Column | str) -> Column:
    """Sentences that end with a Chinese or western mark; the rest of a text is one too."""
    return F.filter(F.transform(F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit("[^。！？!?；;]+[。！？!?；;]?"), F.lit(0)), lambda s: F.trim(s)), lambda s: s != "")


def english_sentences(c: Column | str, least: int = 5) -> Column:
    """Sentences of page text parted at line feeds and after a mark before a capital, digit or quotation mark; ``least`` words or more."""
    parts = F.split(page_text(F.coalesce(_col(c), F.lit(""))), r"\n+|(?<=[.!?])\s+(?=[A-Z0-9\"'])")
    return F.filter(F.transform(parts, lambda s: page_text(s)), lambda s: F.regexp_count(s, F.lit(ENGLISH_WORD)) >= least)


def split_codepoints(c: Column | str, limit: int, tail: float = 0.45) -> Column:
    """Pieces of at most ``limit`` code points, cut at the last mark or space in the last ``tail`` of each window."""
    least = max(1, int(limit * (1 - tail)))
    piece = rf"(?s).{{{least},{limit}}}(?<=[。！？!?；;，,.\s])|.{{1,{limit}}}"
    return F.filter(F.transform(F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(piece), F.lit(0)), lambda s: F.trim(s)), lambda s: s != "")
