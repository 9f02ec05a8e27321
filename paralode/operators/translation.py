"""What surrounds machine translation: output cleaning, batch answers, output gates, prompts, tokens, metrics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.functions.scripts import count, english_words, han, thai
from paralode.operators.gates import first_reason, reasons


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


# Control characters, wrappers and prefixes that models put around their answer.
ANSWER_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
THINKING = r"(?is)<think>.*?</think>\s*"
FENCE = r"(?is)^```(?:thai|th)?\s*\n?(.*?)\n?```$"
PREFIX = r"(?i)^(?:泰语译文|泰文译文|翻译|译文|คำแปลภาษาไทย|คำแปล)\s*[:：]\s*"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def clean_output(c: Column | str) -> Column:
    """Struct (text, flags) of a model's answer: control characters, thinking blocks, a fence around all of it and one prefix go."""
    text = _strip(F.regexp_replace(_text(c), ANSWER_CONTROL, ""))
    thought = _strip(F.regexp_replace(text, THINKING, ""))
    fenced = thought.rlike(FENCE)
    bare = F.when(fenced, _strip(F.regexp_replace(thought, FENCE, "$1"))).otherwise(thought)
    clean = _strip(F.regexp_replace(bare, PREFIX, ""))
    flags = [
        F.when(thought != text, F.lit("removed_thinking_block")),
        F.when(fenced, F.lit("removed_markdown_fence")),
        F.when(clean != bare, F.lit("removed_translation_prefix")),
    ]
    return F.struct(clean.alias("text"), F.array_compact(F.array(*flags)).alias("flags"))


# Marks of a prompt that leaked into an answer.
PROMPT_LEAKS = (
    "You must retain an equal number",
    "Do not omit, summarize, explain",
    "only output the translation",
    r"separators? in the translation",
    r"<SEP\w*>",
)


def leaks_prompt(c: Column | str) -> Column:
    """Whether an answer repeats its instructions; null does not."""
    return _text(c).rlike("(?i)(?:" + "|".join(PROMPT_LEAKS) + ")")


def split_answers(answer: Column | str, ids: Column | str, separator: str = "<SEP>") -> Column:
    """Array of (id, text) from one answer to a batch; null where the number of parts is not that of the ids."""
    parts = F.transform(F.split(_text(answer), F.lit("\\Q" + separator + "\\E")), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.when(F.size(parts) == F.size(ids), F.zip_with(ids, parts, lambda i, t: F.struct(i.alias("id"), t.alias("text"))))


def output_reason(target: Column | str, target_lang: Column | str, least_han: int = 100, least_words: int = 30) -> Column:
    """First reason against a translation by its length in its language, else null."""
    t = _text(target)
    lang = F.col(target_lang) if isinstance(target_lang, str) else target_lang
    return first_reason(
        [
            ("empty_translation", F.trim(t) == ""),
            ("target_zh_han_count_below_100", (lang == "zh-CN") & (han(t, "script") < least_han)),
            ("target_en_word_count_below_30", (lang == "en") & (english_words(t) < least_words)),
        ]
    )


def thai_event_quality(source: Column | str, target: Column | str) -> Column:
    """Struct (failure, flags) of a translation into Thai."""
    s, t = _text(source), _text(target)
    letters = F.greatest(count(t, r"\p{L}"), F.lit(1))
    ratio = F.char_length(t) / F.greatest(F.char_length(s), F.lit(1))
    failure = first_reason([("empty_translation", F.trim(t) == ""), ("unchanged_source", F.trim(t) == F.trim(s)), ("no_thai_characters", thai(t) == 0)])
    flags = reasons(
        [
            ("low_thai_letter_ratio", thai(t) / letters < 0.6),
            ("contains_han_characters", han(t, "merge") > 0),
            ("target_much_shorter_than_source", ratio < 0.25),
            ("target_much_longer_than_source", ratio > 4),
        ]
    )
    return F.struct(failure.alias("failure"), flags.alias("flags"))


def candidate_reason(zh: Column | str, least: int = 100, most: int = 400, least_share: float = 0.5) -> Column:
    """First reason against a Chinese text as a source of translations."""
    c = _text(zh)
    n = han(c, "audit")
    return first_reason(
        [
            ("empty_chinese", F.trim(c) == ""),
            ("chinese_too_short", n < least),
            ("chinese_too_long", n > most),
            ("chinese_not_han_dominant", n / F.greatest(count(c, r"[\p{L}\p{M}]"), F.lit(1)) < least_share),
        ]
    )


def chunk_reason(text: Column | str, lang: Column | str) -> Column:
    """First reason against a chunk of a page."""
    t = _text(text)
    lang = F.col(lang) if isinstance(lang, str) else lang
    return first_reason(
        [
            ("too_few_han", (lang == "zh-CN") & (han(t, "script") < 100)),
            ("too_few_words", (lang == "en") & (english_words(t) < 60)),
            ("split_after_title", t.rlike(r"\bDr\. (?:It|This|We)\b")),
            ("contains_e_mail", t.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")),
        ]
    )


def translation_method(method: Column | str, origin: Column | str, dataset: Column | str) -> Column:
    """A known method as it stands, else ``llm_mt`` for an origin or a dataset of machine translation, else ``human``."""
    # The known methods, and what origin and dataset name as machine translation.
    known = F.col(method) if isinstance(method, str) else method
    machine = F.lower(_text(origin)).contains("machine_translation") | F.lower(_text(dataset)).rlike("tencent|baidu")
    return F.when(known.isin("human", "google_mt", "llm_mt"), known).when(machine, "llm_mt").otherwise("human")


def messages(system: Column | str, user: Column, assistant: Column | None = None) -> Column:
    """Chat messages of a training or inference record."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    system = F.lit(system) if isinstance(system, str) else system
    return F.array(turn("system", system), turn("user", user), *([turn("assistant", assistant)] if assistant is not None else []))


def masked_labels(prompt: Column, completion: Column, length: int | None = None, pad: int = 0, ignore: int = -100) -> dict[str, Column]:
    """input_ids, attention_mask and labels of token arrays: the prompt is masked, the right is padded or cut."""
    ids = F.concat(prompt, completion)
    labels = F.concat(F.array_repeat(F.lit(ignore), F.size(prompt)), completion)
    mask = F.array_repeat(F.lit(1), F.size(ids))
    if length is None:
        return {"input_ids": ids, "attention_mask": mask, "labels": labels}
    fill = lambda a, x: F.concat(F.slice(a, 1, length), F.array_repeat(F.lit(x), F.greatest(F.lit(length) - F.size(a), F.lit(0))))
    return {"input_ids": fill(ids, pad), "attention_mask": fill(mask, 0), "labels": fill(labels, ignore)}


def completion_tokens(tokens: Column, eos: Sequence[int], most: int) -> Column:
    """Struct (n, hit_limit): tokens up to and with the first end token, and whether the limit was reached without one."""
    ends = F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(*eos), i + 1)), lambda i: i.isNotNull())
    first = F.array_min(ends)
    return F.struct(F.coalesce(first, F.size(tokens)).alias("n"), (first.isNull() & (F.size(tokens) >= most)).alias("hit_limit"))


def token_counts(df: DataFrame, key: str, columns: Sequence[str], tokenizer: Callable[[list[str]], list[int]]) -> DataFrame:
    """Numbers of tokens of text columns under an injected tokenizer (texts to counts); null counts as 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], **{f"n_{c}": tokenizer([t or "" for t in pdf[c]]) for c in columns}})

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), *columns).mapInPandas(run, f"k {kind}, " + ", ".join(f"n_{c} int" for c in columns)).withColumnRenamed("k", key)


def as_number(c: Column | str) -> Column:
    """A finite number, else null; true and false are none."""
    v = F.col(c) if isinstance(c, str) else c
    n = v.try_cast("double")
    return F.when(~F.lower(v.cast("string")).isin("true", "false", "nan", "inf", "-inf", "infinity", "-infinity") & n.isNotNull(), n)


def _grams(tokens: Sequence[str], n: int) -> Counter:
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def corpus_metrics(df: DataFrame, reference: str, prediction: str, *keys: str) -> DataFrame:
    """Corpus BLEU (characters as tokens for Han and Thai, else words) and chrF per key.

    Each row gives sufficient statistics in Arrow batches; these add up with
    map-side sums, so no group is gathered anywhere.
    """
    bleu = [f"{x}{n}" for n in range(1, 5) for x in ("m", "t")]
    chrf = [f"{x}{n}" for n in range(1, 7) for x in ("cm", "cr", "cp")]
    names = [*bleu, "rl", "pl", *chrf]

    def tokens(text: str) -> list[str]:
        out, word = [], ""
        for ch in text:
            if ch.isspace() or "฀" <= ch <= "๿" or "㐀" <= ch <= "鿿" or not ch.isalnum():
                if word:
                    out.append(word)
                    word = ""
                if not ch.isspace():
                    out.append(ch)
            else:
                word += ch
        return [*out, word] if word else out

    def statistics(r: str, p: str) -> list[int]:
        out = []
        rt, pt = tokens(r), tokens(p)
        for n in range(1, 5):
            a, b = _grams(rt, n), _grams(pt, n)
            out += [sum((a & b).values()), sum(b.values())]
        out += [len(rt), len(pt)]
        rc, pc = "".join(r.split()), "".join(p.split())
        for n in range(1, 7):
            a, b = _grams(rc, n), _grams(pc, n)
            out += [sum((a & b).values()), sum(a.values()), sum(b.values())]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = [statistics(r or "", p or "") for r, p in zip(pdf["__r"], pdf["__p"])]
            yield pd.concat([pdf[list(keys)].reset_index(drop=True), pd.DataFrame(values, columns=names, dtype="int64")], axis=1)

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{n} long" for n in names)])
    rows = df.select(*keys, F.col(reference).alias("__r"), F.col(prediction).alias("__p")).mapInPandas(run, schema)
    total = rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names])
    logs = sum((F.when(F.col(f"m{n}") > 0, F.log(F.col(f"m{n}") / F.col(f"t{n}"))) for n in range(1, 5)), F.lit(0.0)) / 4
    brevity = F.when(F.col("pl") >= F.col("rl"), F.lit(1.0)).otherwise(F.exp(1 - F.col("rl") / F.greatest(F.col("pl"), F.lit(1))))
    precision = sum((F.coalesce(F.col(f"cm{n}") / F.nullif(F.col(f"cp{n}"), F.lit(0)), F.lit(0.0)) for n in range(1, 7)), F.lit(0.0)) / 6
    recall = sum((F.coalesce(F.col(f"cm{n}") / F.nullif(F.col(f"cr{n}"), F.lit(0)), F.lit(0.0)) for n in range(1, 7)), F.lit(0.0)) / 6
    f2 = F.coalesce(5 * precision * recall / F.nullif(4 * precision + recall, F.lit(0.0)), F.lit(0.0))
    return total.select(*keys, "n", F.round(100 * F.coalesce(brevity * F.exp(logs), F.lit(0.0)), 4).alias("bleu"), F.round(100 * f2, 4).alias("chrf"))


def bleu_of(pairs: Sequence[tuple[list[str], list[str]]]) -> float:
    """Corpus BLEU of (reference tokens, predicted tokens) on the driver, for small sets and for tests."""
    match, total, rl, pl = [0] * 4, [0] * 4, 0, 0
    for r, p in pairs:
        rl, pl = rl + len(r), pl + len(p)
        for n in range(1, 5):
            a, b = _grams(r, n), _grams(p, n)
            match[n - 1] += sum((a & b).values())
            total[n - 1] += sum(b.values())
    if not all(match):
        return 0.0
    brevity = 1.0 if pl >= rl else math.exp(1 - rl / max(pl, 1))
    return 100 * brevity * math.exp(sum(math.log(m / t) for m, t in zip(match, total)) / 4)
