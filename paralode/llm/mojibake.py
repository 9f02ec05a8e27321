"""Text garbled by a wrong character encoding: found and restored by minimum description length.

A step undoes one wrong decoding over the stretches of a value where that is
possible; every text that a chain of steps leads to is a candidate. Candidates
and the value itself are compressed with zstandard under a dictionary of each
language; the shortest description, cost of the chain included, wins. Values
that lost characters for good (U+FFFD, runs of question marks) are named as
``damaged`` beside that: no decoding brings those back.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralode.operators.select import least_hashed

LOST = "\ufffd"
#: Share of the plain length in a description.
PLAIN_SHARE = 0.05
#: The first bytes of a dictionary that zstandard trained.
TRAINED = b"\x37\xa4\x30\xec"
#: Runs of question marks that no sentence has: what is left where an encoder had no character.
QUESTION_RUN = re.compile(r"\?{4,}|(?:\?[^?\s]{0,3}){6,}")
CONTROL = re.compile("[\u0080-\u009f]")
#: What a restored stretch may consist of: Latin with accents, marks, Thai, CJK and its punctuation,
#: and the characters of one more wrong decoding.
PLAUSIBLE = re.compile(
    "[\u0080-\u017f\u0192\u01a0\u01a1\u01af\u01b0\u02c6\u02dc\u0e00-\u0e7f\u1e00-\u1eff\u2010-\u2044\u20ac\u2122\u3000-\u303f\u3400-\u9fff\uf900-\ufaff\uff00-\uffef]*"
)
UTF8 = rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}"
UTF8_WIDE = rb"\xe2\x80[\x80-\xbf]|[\xe3-\xe9][\x80-\xbf]{2}|\xef[\xbc\xbd][\x80-\xbf]|\xe0[\xb8\xb9][\x80-\xbf]"


def _table(codec: str) -> list[str]:
    """The 256 characters of a codec; bytes it does not define stand for themselves."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _encode_map(codec: str) -> dict[int, int]:
    table = _table(codec)
    return {b: b for b in range(0x80, 0x100)} | {ord(c): b for b, c in enumerate(table)} if codec == "cp1252" else {ord(c): b for b, c in enumerate(table)}


def _class(mapping: dict[int, int], low: int, high: int) -> str:
    return "[" + "".join(re.escape(chr(c)) for c, b in mapping.items() if low <= b <= high) + "]"


@dataclass(frozen=True)
class Step:
    """Undoing one wrong decoding: text was in ``true`` but was read as ``wrong``."""

    name: str
    cost: float
    languages: frozenset[str]
    undo: Callable[[str], str | None]


def _undo_single(codec: str, true: str, valid: bytes, least: int) -> Callable[[str], str | None]:
    mapping = _encode_map(codec)
    high = {c: b for c, b in mapping.items() if b >= 0x80}
    pattern = re.compile(b"(?:" + valid + b"){%d,}" % least)
    if true == "utf-8":
        first = re.compile(_class(high, 0xC2, 0xF0) + _class(high, 0x80, 0xBF))
    else:
        first = re.compile(_class(high, 0xA1, 0xFE) + "{%d}" % (2 * least))

    def undo(text: str) -> str | None:
        if not first.search(text):
            return None
        raw = bytes(mapping.get(ord(c), 0x1A) for c in text)
        out, at = [], 0
        for m in pattern.finditer(raw):
            try:
                fixed = m.group().decode(true)
            except UnicodeDecodeError:
                continue
            if not PLAUSIBLE.fullmatch(fixed):
                continue
            out += [text[at : m.start()], fixed]
            at = m.end()
        return "".join(out) + text[at:] if at else None

    return undo


_HAN = re.compile("[\u3400-\u9fff\ue000-\uf8ff]")


_LATIN = re.compile("[A-Za-z]")


def _undo_double(codec: str, true: str, valid: bytes, least: int, latin: bool = False) -> Callable[[str], str | None]:
    pattern = re.compile(b"(?:" + valid + b"){%d,}" % least)

    def undo(text: str) -> str | None:
        if not _HAN.search(text):
            return None
        # Single accents and quotation marks are looked for only between Latin letters.
        if latin and len(_HAN.findall(text)) * 5 > len(_LATIN.findall(text)):
            return None
        try:
            raw = b"\x1a".join(part.encode(codec) for part in text.split(LOST))
        except UnicodeEncodeError:
            raw = text.encode(codec, "replace")
        out, at = [], 0
        for m in pattern.finditer(raw):
            fixed = m.group().decode(true, "replace")
            out += [raw[at : m.start()].decode(codec, "replace"), fixed]
            at = m.end()
        if not at:
            return None
        return ("".join(out) + raw[at:].decode(codec, "replace")).replace("\x1a", LOST)

    return undo


_ALL = frozenset({"zh", "en", "th"})
#: Costs in bytes, all above nothing: a chain must pay for itself in the description of the text. UTF-8 read as a single
#: byte code is the commonest damage and costs least; single-byte targets take nearly any bytes and cost most.
STEPS = (
    Step("utf-8 read as windows-1252", 0.5, _ALL, _undo_single("cp1252", "utf-8", UTF8, 1)),
    Step("utf-8 read as mac-roman", 0.55, _ALL, _undo_single("mac_roman", "utf-8", UTF8, 1)),
    Step("utf-8 read as windows-874", 2, frozenset({"th"}), _undo_single("cp874", "utf-8", UTF8_WIDE, 2)),
    Step("utf-8 read as windows-874", 0.55, frozenset({"zh", "en"}), _undo_single("cp874", "utf-8", UTF8, 1)),
    Step("gbk read as windows-1252", 4, frozenset({"zh", "en"}), _undo_single("cp1252", "gbk", rb"[\xa1-\xfe][\xa1-\xfe]", 3)),
    Step("tis-620 read as windows-1252", 4, frozenset({"th"}), _undo_single("cp1252", "tis-620", rb"[\xa1-\xda\xdf-\xfb]", 4)),
    Step("utf-8 read as gb18030", 2, _ALL, _undo_double("gb18030", "utf-8", UTF8_WIDE, 3)),
    Step("utf-8 in latin text read as gb18030", 0.55, _ALL, _undo_double("gb18030", "utf-8", UTF8, 1, latin=True)),
    Step("utf-8 read as big5", 2, _ALL, _undo_double("big5", "utf-8", UTF8_WIDE, 3)),
    Step("tis-620 read as gb18030", 4, frozenset({"th"}), _undo_double("gb18030", "tis-620", rb"[\xa1-\xda\xdf-\xfb]", 6)),
)


class Describer:
    """Length of a text in bytes under the best of the language dictionaries.

    Dictionaries that zstandard trained bring tables of their own for single
    characters, so that rare ones are dear and the usual ones of a language
    cheap. Of two texts that compress alike the shorter wins by a small share
    of the plain length.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3):
        self.compressors = []
        for data in dictionaries.values():
            kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == TRAINED else zstandard.DICT_TYPE_RAWCONTENT
            d = zstandard.ZstdCompressionDict(data, dict_type=kind)
            d.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: str) -> float:
        raw = text.encode("utf-8", "surrogatepass")
        return min((len(c.compress(raw)) for c in self.compressors), default=len(raw)) + PLAIN_SHARE * len(raw)


def restore(text: str, language: str, describe: Callable[[str], float]) -> tuple[str, list[str]]:
    """The text as it once was and the chain of wrong decodings undone; unchanged with an empty chain where none is shorter.

    Every text that any chain of steps leads to is described, and the chain with
    the least description and cost wins over the value as it stands. A chain is
    carried on until its cost alone exceeds the best found, so none is too long.
    """
    reached: dict[str, tuple[float, list[str]]] = {text: (0.0, [])}
    open_ = [text]
    best: tuple[float, str] | None = None
    while open_:
        now = open_.pop()
        cost, chain = reached[now]
        for step in STEPS:
            if language not in step.languages or (fixed := step.undo(now)) is None or fixed == now:
                continue
            total = cost + step.cost
            if fixed in reached and reached[fixed][0] <= total:
                continue
            if best is None:
                best = (float(describe(text)), text)
            if total >= best[0]:
                continue
            reached[fixed] = (total, [*chain, step.name])
            open_.append(fixed)
            best = min(best, (describe(fixed) + total, fixed))
    fixed = best[1] if best else text
    return fixed, reached[fixed][1]


def is_lossy(text: str) -> bool:
    """Characters are gone for good: replacement characters or runs of question marks."""
    return LOST in text or bool("???" in text or text.count("?") > 5) and bool(QUESTION_RUN.search(text))


def examine(text: str | None, language: str, describe: Describer) -> tuple[str, str, str] | None:
    """(status, chain, text) of a damaged value, else None. Null and empty values are whole."""
    if not text:
        return None
    if text.isascii():
        return ("damaged", "", text) if is_lossy(text) else None
    fixed, chain = restore(text, language, describe)
    lossy = is_lossy(text) or is_lossy(fixed)
    if not chain and not lossy:
        return None
    lossy = lossy or bool(CONTROL.search(fixed))
    return ("damaged" if lossy else "restored", " < ".join(chain), fixed)


#: Rows that may enter a dictionary: the plain characters of one language.
CLEAN = {
    "zh": r"^[\x{4E00}-\x{9FFF}\x{3001}-\x{3011}\x{FF00}-\x{FF5E}\x20-\x7E]{20,}$",
    "en": r"^[\x20-\x7E\x{2013}\x{2014}\x{2018}\x{2019}\x{201C}\x{201D}]{20,}$",
    "th": r"^[\x{0E00}-\x{0E7F}\x20-\x7E]{20,}$",
}


def language_dictionaries(columns: Sequence[tuple[DataFrame, str, str]], sample_rows: int = 1000, max_bytes: int = 65_536) -> dict[str, bytes]:
    """One zstandard dictionary per language, trained on the ``sample_rows`` clean values of each column with the least hash.

    ``columns`` lists (table, column, language). The bound is the only thing
    sampled; every value is examined. Where there are too few values to train
    on, they are the dictionary themselves.
    """
    samples: dict[str, list[bytes]] = {}
    for df, column, language in columns:
        rows = least_hashed(df, column, sample_rows, F.col("value").rlike(CLEAN[language])).collect()
        samples.setdefault(language, []).extend(r["value"].encode() for r in rows)
    return {language: train_dictionary(texts, max_bytes) for language, texts in samples.items() if texts}


def train_dictionary(texts: Sequence[bytes], max_bytes: int) -> bytes:
    """A dictionary of at most ``max_bytes`` for texts of one language."""
    size = min(max_bytes, sum(map(len, texts)) // 4)
    try:
        return zstandard.train_dictionary(size, list(texts), k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-max_bytes:]


def damaged_values(df: DataFrame, table_name: str, id_col: str, fields: dict[str, str], dictionaries: dict[str, bytes]) -> DataFrame:
    """Damaged values of a table: table_name, record_key, field_name, status, chain, restored_text.

    ``fields`` maps columns to their language. One narrow pass without a
    shuffle; every whole value is examined. Status is ``restored`` or, where
    characters are gone, ``damaged`` with what could be brought back. Rows come
    out as often as they go in.
    """
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        describe = Describer(dictionaries)
        for pdf in batches:
            found = []
            for name in names:
                language = fields[name]
                for key, text in zip(pdf["record_key"], pdf[name]):
                    if text and (hit := examine(text, language, describe)):
                        found.append((table_name, key, name, *hit))
            yield pd.DataFrame(found, columns=["table_name", "record_key", "field_name", "status", "chain", "restored_text"])

    source = df.select(F.col(f"`{id_col}`").cast("string").alias("record_key"), *[F.col(f"`{n}`") for n in names])
    return source.mapInPandas(run, "table_name string, record_key string, field_name string, status string, chain string, restored_text string")
