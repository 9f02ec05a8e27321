"""Wiki markup to plain text in one pass over its marks.

Nested templates, tables and links need a stack, so this runs in Arrow batches.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from paralode.functions.normalize import wiki_text

# Elements dropped with their content, words that steer the page, prefixes of links without text.
DROPPED = "ref gallery math score timeline syntaxhighlight source code poem"
MAGIC = "NOTOC TOC FORCETOC NOEDITSECTION NEWSECTIONLINK"
NO_TEXT = "ไฟล์ ภาพ file image หมวดหมู่ category"

_MARK = re.compile(
    r"(?P<skip><!--.*?-->"
    r"|<(?P<element>" + DROPPED.replace(" ", "|") + r")\b[^>]*(?:(?<=/)>|>.*?</(?P=element)\s*>)"
    r"|__(?:" + MAGIC.replace(" ", "|") + r")__"
    r"|\[\[(?:" + NO_TEXT.replace(" ", "|") + r"):[^\]]*\]\]"
    r"|\[(?:https?|ftp)://[^\s\]]+\s*\]"
    r"|https?://\S+"
    r"|<[^>]+>)"
    r"|(?P<label>\[(?:https?|ftp)://[^\s\]]+\s+(?=[^\]]+\]))"
    r"|(?P<open>\{\||\{\{|\[\[)"
    r"|(?P<close>\|\}|\}\}|\]\])"
    r"|(?P<end>\])",
    re.IGNORECASE | re.DOTALL,
)
_OPENER = {"|}": "{|", "}}": "{{", "]]": "[["}
_TABLE_LINE = re.compile(r"\s*(?:[!|]|\{\|$)")
_HEADING = re.compile(r"\s*=+.*=+\s*$")
_LEFTOVER = re.compile(r"\s*^\s*[*#:;]+\s*|'{2,3}|\{\{[^{}]*\}\}|\[\[[^\[\]]*\]\]")


class _Text:
    """What is visible so far: a stack of open marks, each with the text inside it; inside templates and tables nothing is."""

    def __init__(self) -> None:
        self.marks: list[str] = []
        self.texts: list[list[str]] = [[]]
        self.labels = 0

    @property
    def hidden(self) -> bool:
        return "{{" in self.marks or "{|" in self.marks

    def add(self, text: str) -> None:
        if not self.hidden:
            self.texts[-1].append(text)

    def open(self, mark: str) -> None:
        if mark == "[[" and self.hidden:
            return
        self.marks.append(mark)
        self.texts.append([])

    def close(self, mark: str) -> bool:
        """Close the innermost opener of a mark; false where none is open."""
        opener = _OPENER[mark]
        if opener not in self.marks or opener == "[[" and self.hidden:
            return False
        at = len(self.marks) - 1 - self.marks[::-1].index(opener)
        inside = "".join("".join(t) for t in self.texts[at + 1 :])
        del self.marks[at:], self.texts[at + 1 :]
        if opener == "[[":
            self.add(_shown(inside))
        return True

    def end(self) -> str:
        """All text; a link never closed stays as it is, a template or table never closed hides the rest."""
        out = self.texts[0]
        for mark, text in zip(self.marks, self.texts[1:]):
            if mark != "[[":
                break
            out += ["[[", *text]
        return "".join(out)


def _shown(link: str) -> str:
    """The visible part of a link: its last part, without the section of a plain target."""
    if link[:1] in ("#", ":"):
        return ""
    target, *rest = link.split("|")
    return (rest[-1] if rest else target.split("#", 1)[0] if "#" in target else target).strip()


def plain_text(markup: str) -> str:
    """The text of a page: no comments, references, templates, tables, headings, files or addresses, links as they show."""
    text, at = _Text(), 0
    markup = re.sub(r"\r\n?|[\u2028\u2029]", "\n", markup)
    while m := _MARK.search(markup, at):
        text.add(markup[at : m.start()])
        at = m.end()
        if m["label"]:
            text.labels += 1
        elif m["open"]:
            text.open(m["open"])
        elif m["close"] and not text.close(m["close"]):
            # Not a closer here: its first character is text, and the second may start another mark.
            text.add(m["close"][0])
            at = m.start() + 1
        elif m["end"]:
            text.labels -= (closes := text.labels > 0)
            text.add("" if closes else "]")
    text.add(markup[at:])
    lines = html.unescape(text.end()).splitlines()
    return "\n".join("" if _HEADING.match(line) else _LEFTOVER.sub("", line) for line in lines if not _TABLE_LINE.match(line))


def clean_wikitext(c: Column | str) -> Column:
    """Plain text of wiki markup in normal form; null stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else plain_text(t))

    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), wiki_text(clean(c)))
