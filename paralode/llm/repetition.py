"""Repetition inside one document, measured by a threshold table compiled into one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the languages in the corpus.
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "with", "on", "by", "at", "dan", "yang", "di", "untuk", "của", "và", "trong")


@dataclass(frozen=True)
class Rule:
    """A metric is flagged when it is at or above ``at_least`` or below ``below``."""

    name: str
    metric: str
    at_least: float | None = None
    below: float | None = None


RULES = (
    Rule("repeated_content", "repeat_share", at_least=0.5),
    Rule("repeated_lines", "line_repeat_share", at_least=0.3),
    Rule("repeated_sentences", "sentence_repeat_share", at_least=0.3),
    Rule("symbols", "symbol_share", at_least=0.1),
    Rule("stop_words", "stop_word_share", at_least=0.8),
    Rule("short", "length", below=20),
)


def repeat_share(text: Column, stretch: int = 10) -> Column:
    """Share of characters in second or later copies of a stretch of the same text.

    White space, digits and dots are left out first. Every window of ``stretch``
    characters is paired with its position and sorted; a window equal to the one
    before it in that order occurs earlier in the text. The union of those
    windows is measured in one pass. The work is n log n in the length.
    """
    bare = F.regexp_replace(text, r"[\s\p{Z}\p{Nd}.。．｡…‥・·]+", "")
    windows = F.regexp_extract_all(bare, F.lit(f"(?s)(?=(.{{{stretch}}}))."), F.lit(1))
    placed = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    starts = _let(placed, lambda p: F.sort_array(F.filter(F.transform(p, lambda w, k: F.when((k > 0) & (w["g"] == p[F.greatest(k - 1, F.lit(0))]["g"]), w["i"])), lambda i: i.isNotNull())))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + stretch - F.greatest(acc["end"], i)).alias("n"), (i + stretch).alias("end")),
        lambda acc: acc["n"],
    )
    return F.coalesce(covered / F.nullif(F.char_length(bare), F.lit(0)), F.lit(0.0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _copies_share(parts: Column) -> Column:
    total = lambda ps: F.aggregate(ps, F.lit(0), lambda a, p: a + F.char_length(p))
    return _let(F.filter(parts, lambda p: F.char_length(F.trim(p)) > 0), lambda ps: F.coalesce((total(ps) - total(F.array_distinct(ps))) / F.nullif(total(ps), F.lit(0)), F.lit(0.0)))


def metrics(text: Column, stretch: int = 10) -> dict[str, Column]:
    """The measures a rule may name, each a built-in expression; a null text measures as an empty one."""
    text = F.coalesce(text, F.lit(""))
    length = F.char_length(text)
    visible = F.char_length(F.regexp_replace(text, r"[\s\p{Z}]+", ""))
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w != "")
    per = lambda n, d: F.when(d > 0, n / d).otherwise(F.lit(0.0))
    return {
        "length": length.cast("double"),
        "symbol_share": per(F.regexp_count(text, F.lit(r"[\p{S}]")), visible),
        "stop_word_share": per(F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))), F.size(words)),
        "line_repeat_share": _copies_share(F.split(text, r"\R")),
        "sentence_repeat_share": _copies_share(F.split(text, r"(?<=[.!?。！？])\s*")),
        "repeat_share": repeat_share(text, stretch),
    }


def repetition_profile(df: DataFrame, id_col: str = "record_id", text_col: str = "target_text", rules: Sequence[Rule] = RULES, stretch: int = 10) -> DataFrame:
    """record_id, every metric a rule names, and ``flags`` with the names of the rules that hold.

    One projection without user functions and without a shuffle; rows come out
    as often as they go in. Null and empty texts have share 0.
    """
    known = metrics(F.col(f"`{text_col}`"), stretch)
    used = list(dict.fromkeys(r.metric for r in rules))
    measured = df.select(F.col(f"`{id_col}`").alias("record_id"), *[known[m].alias(m) for m in used])
    hits = [F.when(F.col(r.metric) >= r.at_least if r.at_least is not None else F.col(r.metric) < r.below, F.lit(r.name)) for r in rules]
    return measured.select("record_id", *used, F.array_compact(F.array(*hits)).alias("flags"))
