"""Normalisers of the stages. Each stage has its own; none may stand in for another."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralode.functions.text import casefold, nfc

# Characters that the pool stage deletes as zero-width.
ZERO_WIDTH_POOL = "\ufeff\u200b\u200c\u200d\u2060\u2061\u2062\u2063\u2064"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]"
BIDI_ZERO_WIDTH = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{2066}-\x{2069}\x{FEFF}]"
SPACES = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]+"


def _col(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _sub(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def collapse_space(c: Column) -> Column:
    return _sub(c, (SPACES, " "), ("^ | $", ""))


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else html.unescape(t))


def unescape_html(c: Column | str) -> Column:
    """Entities decoded; only texts with an ampersand leave the JVM's fast path for Arrow."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.contains(c, F.lit("&")), _unescape(F.when(F.contains(c, F.lit("&")), c))).otherwise(c)


def page_text(c: Column | str) -> Column:
    """Page text: runs of blanks to one, lines trimmed, at most one blank line; line breaks stay and nothing is composed."""
    return _sub(F.translate(_col(c), "\u00a0", " "), (r"\r\n?", "\n"), (r"[\t\f\x0B ]+", " "), (" *\n *", "\n"), ("\n{3,}", "\n\n"), (r"^\s+|\s+$", ""))


def pool_text(c: Column | str) -> Column:
    """Pool records: composed, zero-width and other control characters deleted (neighbours join), blanks to one space."""
    kept = F.translate(nfc(_col(c)), ZERO_WIDTH_POOL, "")
    return collapse_space(_sub(kept, (r"[\x{A0}\x{3000}\r\n\t\f\x0B]", " "), (r"[\p{Cc}\p{Cf}]", ""), (r"\p{Zs}", " ")))


def bitext_text(c: Column | str) -> Column:
    """Line-aligned bitext: composed, byte order marks dropped, control characters become spaces (neighbours part)."""
    return collapse_space(_sub(F.translate(nfc(_col(c)), "\ufeff", ""), (r"[\p{Cc}\p{Cf}\x{A0}\x{3000}]", " ")))


def tsv_text(c: Column | str) -> Column:
    """TSV bitext: entities decoded, byte order marks dropped, composed, tags and control characters become spaces."""
    plain = nfc(F.translate(unescape_html(_col(c)), "\ufeff", ""))
    return collapse_space(_sub(plain, ("</?[A-Za-z][^>]{0,500}>", " "), (r"[\p{Cc}\p{Cf}]", " ")))


def wiki_text(c: Column | str) -> Column:
    """Wiki text: composed, control characters deleted, blanks to one space, lines trimmed, at most one blank line."""
    return _sub(
        nfc(_col(c)), (r"\r\n?|[\x{2028}\x{2029}]", "\n"), (r"[\p{Cc}&&[^\n\t]]", ""), (r"[ \t\x{A0}\x{1680}\x{2000}-\x{200B}\x{202F}\x{205F}\x{3000}]+", " "),
        (" *\n *", "\n"), ("\n{3,}", "\n\n"), (r"^\s+|\s+$", ""),
    )


def merge_text(c: Column | str) -> Column:
    """zh-th records: composed, control, zero-width and direction characters deleted, blanks to one space."""
    return collapse_space(_sub(nfc(_col(c)), (CONTROL, ""), (BIDI_ZERO_WIDTH, "")))


def sft_text(c: Column | str) -> Column:
    """SFT comparison text: composed, five zero-width characters deleted, blanks to one space."""
    return collapse_space(F.translate(nfc(_col(c)), "\u200b\u200c\u200d\u2060\ufeff", ""))


def side_key(c: Column | str) -> Column:
    """Letters and digits of a case-folded side, as a loose key."""
    return _sub(casefold(merge_text(c)), (r"[^\p{L}\p{N}\x{0E00}-\x{0E7F}]+", ""))


NORMALIZERS = {
    "page": page_text,
    "pool": pool_text,
    "bitext": bitext_text,
    "tsv": tsv_text,
    "wiki": wiki_text,
    "merge": merge_text,
    "sft": sft_text,
    "side_key": side_key,
}


# What is cut out of a chunk of a page, in this order.
CHUNK_STEPS = (
    (r"\s+>\s*(?=[A-Z])", " "),
    (r"([.!?])['’](?=\s+[A-Z])", "$1"),
    (r"\bdestiny\s+(?=Education Secretary\b)", "destiny. "),
    (r"(?i)\s+[A-Z][^.!?]{0,120}\bsaid:\s*$", ""),
    (r"(?i)[（(]?(?:https?://|www\.)[^\s）)]+[）)]?", ""),
    (r"(?i)website:\s+(?=Oak National Academy\b)", "website. "),
    (r"\s+项目办公室\s+.*$", ""),
    (r"\s+附件[:：]\s*.*$", ""),
    (r"\s{2,}", " "),
)


def sanitize_chunk(c: Column | str) -> Column:
    """A chunk of a page without stray marks, addresses, trailing speakers, offices and attachments; null stays null."""
    return F.regexp_replace(_sub(page_text(c), *CHUNK_STEPS), r"^\s+|\s+$", "")
