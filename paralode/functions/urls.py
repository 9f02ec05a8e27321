"""Web addresses, dates in them, links, pages and paragraphs."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from paralode.functions.normalize import page_text, wiki_text


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_url(c: Column | str) -> Column:
    """Address without its fragment and without tracking parameters (utm_*, spm*, from*, eqid*)."""
    bare = F.regexp_replace(_col(c), "#.*$", "")
    query = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike("(?i)^(?:utm_|spm|from|eqid)"))
    path = F.regexp_replace(bare, r"\?.*$", "")
    return F.when(F.size(query) > 0, F.concat(path, F.lit("?"), F.array_join(query, "&"))).otherwise(path)


# How a path shows a date, most telling first: (pattern, whether the day is known).
_DATES = (
    (r"/(20\d{2})-(\d{2})/(\d{2})/", True),
    (r"/(20\d{2})/(\d{2})(\d{2})/", True),
    (r"/(20\d{2})(\d{2})(\d{2})/", True),
    (r"/(20\d{2})/(\d{1,2})/(\d{1,2})/", True),
    (r"/(20\d{2})(\d{2})(\d{2})\d{4,}/", True),
    (r"/(20\d{2})(\d{2})/", False),
)


def url_date_hint(c: Column | str) -> Column:
    """YYYY-MM-DD or YYYY-MM that the path of an address shows, else null."""
    path = F.concat(F.regexp_replace(F.regexp_replace(_col(c), r"[?#].*$", ""), "^[a-zA-Z]+://[^/]*", ""))
    hints = []
    for pattern, day in _DATES:
        part = lambda k, p=pattern: F.lpad(F.regexp_extract(path, p, k), 2 if k > 1 else 4, "0")
        hints.append(F.when(path.rlike(pattern), F.concat_ws("-", part(1), part(2), *([part(3)] if day else []))))
    return F.coalesce(*hints)


def url_outside_window(c: Column | str, start: str, end: str) -> Column:
    """The hint lies outside the days from start to end; an address without one never does."""
    hint = url_date_hint(c)
    exact = F.length(hint) == 10
    return F.coalesce(F.when(exact, (hint < start) | (hint > end)).otherwise((hint < start[:7]) | (hint > end[:7])), F.lit(False))


def in_date_range(c: Column | str, start: str, end: str) -> Column:
    """An ISO day from start to end; anything else is not."""
    return F.coalesce(_col(c).rlike(r"^\d{4}-\d{2}-\d{2}$") & _col(c).between(start, end), F.lit(False))


def normalize_date(c: Column | str) -> Column:
    """The first day written as year, month, day in a text, as YYYY-MM-DD."""
    pattern = r"(20\d{2})\s*[-/.年]\s*(\d{1,2})\s*[-/.月]\s*(\d{1,2})"
    part = lambda k: F.lpad(F.regexp_extract(_col(c), pattern, k), 2 if k > 1 else 4, "0")
    return F.when(_col(c).rlike(pattern), F.concat_ws("-", part(1), part(2), part(3)))


def page_url(title: Column | str, base: str) -> Column:
    """Address of a wiki page: blanks become underscores, the rest is escaped."""
    return F.concat(F.lit(base), F.replace(F.url_encode(F.replace(_col(title), F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20")))


def links(html: Column | str) -> Column:
    """Distinct link targets of a page in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit("(?i)href\\s*=\\s*[\"']([^\"'#]+)"), F.lit(1)))


def expand_pages(template: Column | str, start: Column | int, end: Column | int, first_bare: bool = False) -> Column:
    """Addresses of numbered listing pages; ``first_bare`` drops the page parameter from the first."""
    low, high = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    pages = F.transform(F.sequence(low, high), lambda i: F.replace(_col(template), F.lit("{page}"), i.cast("string")))
    if first_bare:
        bare = F.regexp_replace(F.regexp_replace(_col(template), r"[?&][^?&=]+=\{page\}", ""), r"\{page\}", "")
        pages = F.concat(F.array(bare), F.slice(pages, F.lit(2), F.greatest(F.size(pages) - 1, F.lit(0))))
    return F.array_distinct(pages)


def page_title(html: Column | str) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(_col(html), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


class _Article(HTMLParser):
    """Paragraphs and list items outside of boilerplate elements."""

    SKIP = frozenset({"script", "style", "nav", "header", "footer", "aside", "form", "noscript"})
    VOID = frozenset({"br", "img", "hr", "meta", "link", "input"})

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skipped, self.open, self.blocks = 0, False, [""]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.SKIP:
            self.skipped += 1
        elif tag in ("p", "li"):
            self.open = True
            self.blocks.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIP:
            self.skipped = max(0, self.skipped - 1)
        elif tag in ("p", "li"):
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open and not self.skipped:
            self.blocks[-1] += data


def article_text(html: Column | str, least: int = 20) -> Column:
    """Paragraphs and list items of at least ``least`` characters, one to a line; whole pages, no limit on their size."""

    @F.pandas_udf("string")
    def parse(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> str | None:
            if page is None:
                return None
            parser = _Article()
            parser.feed(page)
            blocks = (" ".join(b.split()) for b in parser.blocks)
            return "\n".join(b for b in blocks if len(b) >= least)

        return pages.map(one)

    return page_text(parse(_col(html)))


def paragraphs(c: Column | str) -> Column:
    """Blocks between blank lines, each on one line, without empty ones."""
    blocks = F.split(F.coalesce(_col(c), F.lit("")), "\n\\s*\n+")
    return F.filter(F.transform(blocks, lambda b: wiki_text(F.regexp_replace(b, "\\s*\n\\s*", " "))), lambda b: b != "")


def passes_patterns(url: Column | str, title: Column | str | None = None, allow: str | None = None, exclude: str | None = None, include_title: str | None = None, exclude_title: str | None = None) -> Column:
    """Whether an address and its title pass the patterns of a source; titles without regard to case, a null address never."""
    u = _col(url)
    t = F.coalesce(_col(title), F.lit("")) if title is not None else F.lit("")
    tests = [
        u.rlike(allow) if allow else None,
        ~u.rlike(exclude) if exclude else None,
        t.rlike(f"(?i){include_title}") if include_title else None,
        ~t.rlike(f"(?i){exclude_title}") if exclude_title else None,
    ]
    out = u.isNotNull()
    for test in tests:
        out = out if test is None else out & test
    return F.coalesce(out, F.lit(False))


#: Files that are no pages.
NO_PAGE = r"(?i)\.(?:pdf|docx?|xlsx?|csv|ods|zip)(?:[?#]|$)"


def attached_pages(links: Column, page: Column, root: str, most: int = 10) -> Column:
    """Of the links of a page the first ``most`` pages below its root: same host and root, not the page itself, no files.

    ``root`` is the pattern of the root's path, such as two leading folders.
    """
    host = F.regexp_extract(page, r"^(https?://[^/?#]+)", 1)
    base = F.concat(host, F.regexp_extract(page, r"^https?://[^/?#]+(" + root + ")", 1))
    full = F.transform(links, lambda x: canonical_url(F.when(x.startswith("/"), F.concat(host, x)).otherwise(x)))
    bare = F.regexp_replace(page, r"[?#].*$", "")
    wanted = F.filter(full, lambda x: x.startswith(F.concat(base, F.lit("/"))) & (F.regexp_replace(x, r"[?#].*$", "") != bare) & ~x.rlike(NO_PAGE))
    return F.when(base != host, F.slice(F.array_distinct(wanted), 1, most)).otherwise(F.slice(links, 1, 0))
