"""Text primitives that stay in the JVM.

Unicode normal forms and full case folding have no SQL function in Spark; they
are reached through the reflection expression on the ICU classes that Spark
ships with, so no text leaves the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"
_ICU_CHARACTER = "com.ibm.icu.lang.UCharacter"

#: Characters that print nothing beside the Cc and Cf categories: joiners, fillers, variation selectors.
INVISIBLE_CLASS = (
    r"\p{Cc}\p{Cf}\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{E0100}-\x{E01EF}"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it; no Python function may be inside."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _icu(owner: str, method: str, c: Column | str, flag: bool) -> Column:
    # The argument appears once, so nested calls stay linear; a null argument fails inside and comes out as null.
    return F.try_reflect(F.lit(owner), F.lit(method), _col(c), F.lit(flag))


def nfc(c: Column | str) -> Column:
    """Canonical composition; null stays null."""
    return _icu(_ICU_NORMALIZER, "compose", c, False)


def nfkc(c: Column | str) -> Column:
    """Compatibility composition; null stays null."""
    return _icu(_ICU_NORMALIZER, "compose", c, True)


def casefold(c: Column | str) -> Column:
    """Full Unicode case folding; null stays null."""
    return _icu(_ICU_CHARACTER, "foldCase", c, True)


def _width_pairs() -> tuple[str, str]:
    source, target = ["　"], [" "]
    for code in range(0xFF01, 0xFFEF):
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain != chr(code):
            source.append(chr(code))
            target.append(plain)
    return "".join(source), "".join(target)


_WIDE, _NARROW = _width_pairs()


def fold_width(c: Column | str) -> Column:
    """Full-width and half-width forms become the ordinary ones."""
    return F.translate(_col(c), _WIDE, _NARROW)


def canonical_form(c: Column | str) -> Column:
    """Text without white space, invisible characters, case, width and punctuation."""
    folded = nfc(casefold(fold_width(c)))
    return F.regexp_replace(folded, r"[\s\p{Z}\p{P}" + INVISIBLE_CLASS + "]+", "")


def trim_space(c: Column | str) -> Column:
    """Trim every kind of white space and invisible character from both ends."""
    edge = r"[\s\p{Z}" + INVISIBLE_CLASS + "]+"
    return F.regexp_replace(_col(c), f"^{edge}|{edge}$", "")
