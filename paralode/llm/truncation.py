"""Text cut off by field limits: structural completeness of the whole text against baselines of its source and of all texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.session import cut

#: What ends a sentence, and what may follow it.
TERMINATORS = ".!?。！？…‥؟।"
CLOSERS = "\"'”’»)）」』】》〉]］｝}*_"
OPENING = "“‘«(（「『【《〈[［{｛"
CLOSING = "”’»)）」』】》〉]］}｝"
#: What is left in place of the rest of a text.
PLACEHOLDER = (
    r"(?:…|\.{3,}|‥|。{3,}|[\[(（【]\s*(?:…|\.{2,}|more|cut|truncated|continued|continue reading|read more|未完|略|下略|更多|阅读全文|อ่านต่อ|มีต่อ)\s*[…\.]*\s*[\])）】]"
    r"|(?i:read more|continue reading|\(?continued\)?|truncated)|阅读全文|未完待续|อ่านต่อ|มีต่อ)$"
)
#: Broken characters, entities, escapes and tags.
BROKEN = (
    r"(?:\x{FFFD}+|&(?:#x?[0-9A-Fa-f]{0,6}|nb?s?p?|am?p?|[lg]t?|quo?t?|[lr][sd]q?u?o?|hel?l?i?p?|[mn]da?s?h?)"
    r"|\\(?:u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?|(?:%[0-9A-Fa-f]{2})+%[0-9A-Fa-f]?|</?[A-Za-z][^<>]{0,60})$"
)
#: Thai particles that close a sentence.
PARTICLES = r"(?:ฯลฯ|ครับ|ค่ะ|คะ|นะ|จ้ะ|จ้า)$"
#: Ends that are complete by their form: list items, table rows, addresses, labels, closing brackets.
LIST_ITEM = r"^\s*(?:[-*•·‣–—]|\d{1,3}[.)、]|[（(]\d{1,3}[)）])\s*\S"
TABLE_ROW = r"\S\s*\|\s*\S"
ADDRESS = r"(?:https?://|www\.)\S+$|[\w.+-]+@[\w-]+\.[\w.]+$"
#: A short label with its value, such as key words or a source.
LABEL = r"^[^\s:：，。,.!?！？][^:：，。,.!?！？]{0,19}[:：]\s*\S.{0,60}$"
THAI = r"[\x{0E00}-\x{0E7F}]"

#: Elements whose end may be left out, and those that have none.
OPTIONAL = ("<p", "<li", "<dt", "<dd", "<tr", "<td", "<th", "<option", "<thead", "<tbody")
VOID = ("<br", "<hr", "<img", "<input", "<meta", "<link", "<wbr", "<col", "<source", "<area", "<base")
#: What the automaton reads: fences, elements, brackets and quotation marks. An apostrophe takes the letter behind it along
#: and what may be an inch mark the space, so that they are told from quotation marks.
_READ = "".join("\\" + c for c in OPENING + CLOSING)
TOKENS = r"(?=[\"<`" + _READ + r"])(?:(?m:^)```|[’‘](?<=\p{L}.)\p{L}|’(?<=s.)\s|\"(?<=\d.)[\s,.;)]|</?[A-Za-z][\w-]*(?:\s[^<>]*)?/?>|[\"" + _READ + "])"
#: What a text must hold for anything to be left open.
OPENS = r"[\"<`" + "".join("\\" + c for c in OPENING) + "]"

#: Letters of a line or clause start and of the grams counted everywhere.
PREFIX = 8
GRAM = 4
#: Share of the occurrences of the last letters of a Thai end that must end a clause.
GRAM_END = 0.05
#: Longest line that may be a signature, longest closing line, and shortest line (letters, Han) that is a paragraph.
SHORT_LINE = 20
CLOSING_LINE = 60
PARAGRAPH, PARAGRAPH_HAN = 60, 20
#: Share of the paragraphs of a source from which a missing terminator counts as a cut; where nothing is known of it, this share is taken.
PUNCTUATED, PRIOR = 0.5, 0.9
#: Texts that a share of few counts is smoothed with.
WEIGHT = 2
#: Share of the cut texts of a source that have one length, from which this length is a limit of its field.
LIMIT_SHARE = 0.1
#: Verdicts of texts that were cut off.
CUT = ("placeholder", "broken", "open", "cut between clauses", "cut in a sentence", "cut at a limit")


def _mask(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Nd}+(?:[.,]\p{Nd}+)*", "0")


def _line_start(line: Column) -> Column:
    """The start of a line: its first two words, or its first letters where words are not spaced."""
    masked = _mask(F.left(line, F.lit(CLOSING_LINE)))
    return F.coalesce(F.nullif(F.regexp_extract(masked, r"^([A-Za-z]\S*(?:\s+\S+)?)", 1), F.lit("")), F.substring(masked, 1, PREFIX))


def open_structures(text: Column) -> Column:
    """What a stack automaton holds at the end of the whole text: the openers never closed, innermost last.

    Brackets, curly and straight quotation marks, elements and code fences enter
    the automaton, so its work follows their number. A closer pops its opener
    and, for elements, what was left open inside; one without an opener on the
    stack is passed over, as are apostrophes, inch marks, elements without an
    end and, at the end, those whose end may be left out.
    """
    tokens = F.when(text.rlike(OPENS), F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)))
    opener = lambda t: F.translate(t, "”’»)）」』】》〉]］}｝", "“‘«(（「『【《〈[［{｛")
    nothing = F.array().cast("array<string>")

    def upto(stack: Column, name: Column) -> Column:
        """The stack without its last ``name`` and all above it; unchanged where it holds none."""
        place = F.array_position(F.reverse(stack), name).cast("int")
        return F.when(place > 0, F.slice(stack, 1, F.size(stack) - place)).otherwise(stack)

    def read(stack: Column, token: Column) -> Column:
        top = F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(""))
        name = F.lower(F.regexp_extract(token, r"^<(/?[A-Za-z][\w-]*)", 1))
        both = token.isin('"', "```")
        return (
            F.when(F.lit(OPENING).contains(token), F.array_append(stack, token))
            .when(top == opener(token), F.slice(stack, 1, F.size(stack) - 1))
            .when(both, F.when(F.array_contains(stack, token), upto(stack, token)).otherwise(F.array_append(stack, token)))
            .when(~token.startswith("<"), F.when((F.length(token) == 2) & token.startswith('"'), upto(stack, F.lit('"'))).otherwise(stack))
            .when(name.startswith("/"), upto(stack, F.concat(F.lit("<"), F.substring(name, 2, 100))))
            .when(token.endswith("/>") | F.concat(F.lit("<"), name).isin(*VOID), stack)
            .otherwise(F.array_append(stack, F.concat(F.lit("<"), name)))
        )

    held = F.aggregate(tokens, nothing, read)
    return F.coalesce(F.array_join(F.filter(held, lambda x: ~x.isin(*OPTIONAL)), ""), F.lit(""))


def _bare(text: Column) -> Column:
    """Text without white space at its end, lines parted by line feeds."""
    feeds = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.rtrim(feeds, F.lit(" \t\n\u00a0\u3000\u200b\ufeff\u2028\u2029\u0085"))


def _clauses(line: Column) -> Column:
    """Thai clauses of a line: runs between spaces; numbers, repetition marks and Latin words join their neighbours."""
    joined = F.regexp_replace(F.regexp_replace(line, r"\s*\p{Nd}+(?:[.,]\p{Nd}+)*\s*", "0"), r"\s+(?=ๆ|[A-Za-z])", "")
    return F.filter(F.split(joined, r"[\s\p{Z}]+"), lambda c: c != "")


def _may_close(line: Column) -> Column:
    """A line short and plain enough for a closing line, without a sentence end inside."""
    return (F.length(line) <= CLOSING_LINE) & ~line.rlike(r"[，。！？；]|[.!?]\s+\p{Lu}")


def _script(line: Column) -> Column:
    return F.when(line.rlike(THAI), "thai").when(line.rlike(r"[\x{3400}-\x{9FFF}]"), "han").otherwise("other")


def _baseline_key(source: Column, line: Column) -> Column:
    return F.concat_ws("\u001f", _script(line), F.coalesce(source.cast("string"), F.lit("\u0000")))


def _tip(line: Column) -> Column:
    return F.right(_mask(F.right(line, F.lit(SHORT_LINE))), F.lit(3))


def _is_short(line: Column) -> Column:
    return (F.length(line) <= SHORT_LINE) & ~line.rlike(r"[,，、;；]")


_MARKS = "".join("\\" + c for c in CLOSERS)
END = "[" + TERMINATORS.replace(".", r"\.") + "][" + _MARKS + "]*$"
CLOSED = "[" + "".join("\\" + c for c in CLOSING.replace("’", "")) + '"]$|‘.*’$'


def _entries(line: Column, last: Column, source: Column) -> Column:
    """What one line adds to the counts: (kind, key, flag)."""

    def entry(kind: str, key: Column, flag: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), flag.alias("flag"))

    def of_clause(clause: Column, closes: Column) -> Column:
        grams = F.transform(F.regexp_extract_all(clause, F.lit("(?=(.{%d}))." % GRAM), F.lit(1)), lambda g: entry("gram", g, F.lit(False)))
        ends = F.array(entry("head", F.substring(clause, 1, PREFIX), closes), entry("gram", F.right(clause, F.lit(GRAM)), F.lit(True)))
        return F.when(~clause.rlike(THAI), F.slice(ends, 1, 0)).when(closes & last, grams).otherwise(F.concat(ends, grams))

    ended = line.rlike(END)
    paragraph = (F.length(line) >= PARAGRAPH) | (F.length(line) >= PARAGRAPH_HAN) & line.rlike(r"[\x{3400}-\x{9FFF}]")
    clauses = F.transform(F.array(_clauses(line)), lambda cs: F.flatten(F.transform(cs, lambda c, j: of_clause(c, j + 1 == F.size(cs)))))
    none = F.slice(F.array(entry("start", line, last)), 1, 0)
    return F.concat(
        F.array(entry("start", _line_start(line), last & _may_close(line))),
        F.when(~ended, F.array(entry("tip", _tip(line), last & _is_short(line)))).otherwise(none),
        F.when(~last & paragraph, F.array(entry("base", _baseline_key(source, line), ended))).otherwise(none),
        F.when(line.rlike(THAI), clauses[0]).otherwise(none),
        # Words of list items and labels, and what a cut could leave of them.
        F.when(
            ~last & _is_form(line),
            F.flatten(F.transform(_form_words(line), lambda w: F.transform(F.sequence(F.lit(2), F.length(w)), lambda k: entry("word", F.left(w, k), k == F.length(w))))),
        ).otherwise(none),
    )


def _is_form(line: Column) -> Column:
    return line.rlike(LIST_ITEM) | line.rlike(TABLE_ROW) | line.rlike(LABEL)


def _form_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^a-z]+"), lambda w: F.length(w) >= 3)


def line_statistics(df: DataFrame, text_col: str, source_col: str) -> DataFrame:
    """Counts over all texts that say what a complete end looks like: kind, key, n, flagged.

    ``start``: lines with this start, and how many of them are short and end a
    text. ``tip``: lines without a terminator that end with these letters, and
    how many are short and end a text. ``base``: paragraphs of a source and
    script that do not end a text, and how many end with a terminator. ``head``:
    Thai clauses with this start, and how many of them close a line. ``gram``:
    occurrences of these letters in Thai lines plus, flagged, at the end of a
    clause. ``word``: beginnings of the words of list items, flagged the whole
    words. What ends a text is left out of what it is judged by. One pass;
    counts combine on the map side.
    """
    lines = df.select(F.filter(F.split(_bare(F.col(f"`{text_col}`")), "\n"), lambda x: x != "").alias("lines"), F.col(f"`{source_col}`").alias("source"))
    entries = lines.select(F.explode(F.flatten(F.transform("lines", lambda x, i: _entries(x, i + 1 == F.size("lines"), F.col("source"))))).alias("e"))
    return entries.groupBy("e.kind", "e.key").agg(F.count("*").alias("n"), F.count_if("e.flag").alias("flagged"))


def judge_ends(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, last_line, verdict and is_cut of every row.

    The verdict is the first that holds: empty, placeholder, broken (character,
    entity, escape, tag), open (a bracket, quotation, element or fence anywhere
    in the text that is never closed), terminated, form (list item, table row,
    address, label, unless its last word is known only as the beginning of
    others), closed (by a closing mark), closing (a start or an end that mostly
    closes texts), for Thai the clause against the counts of all texts, and
    unpunctuated, where the paragraphs of the source mostly have no terminator
    either; anything else is cut. A form, clause, closing, closed or
    unpunctuated end counts as cut at a limit where most other texts of the
    source of just this length, in characters or in bytes, are cut. All tests
    on counts are shares, smoothed with a fixed weight, so that a verdict does
    not drift with the size of the table; where little is known of a source,
    the share of all sources stands in. Null and empty texts are no case.
    Repeated rows are judged as often as they come.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bare = _bare(text)
    line = F.col("line")
    rows = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        F.substring_index(bare, "\n", -1).alias("line"),
        open_structures(bare).alias("held"),
        F.char_length(text).alias("n_chars"),
        F.octet_length(text).alias("n_bytes"),
    )
    quick = (
        F.when(line == "", "empty")
        .when(line.rlike(PLACEHOLDER), "placeholder")
        .when(line.rlike(BROKEN), "broken")
        .when(F.col("held") != "", "open")
        .when(line.rlike(END) | line.rlike(PARTICLES), "terminated")
    )
    ends = cut(rows.withColumn("verdict", quick).drop("held"))
    word = F.element_at(F.split(F.lower(line), r"[^a-z]+"), -1)
    open_ = ends.filter("verdict is null").withColumns(
        {
            "start": _line_start(line),
            "clause": F.when(line.rlike(THAI), F.element_at(_clauses(line), -1)),
            "tip": _tip(line),
            "base": _baseline_key(F.col("source"), line),
            "script": _script(line),
            "word": F.when(_is_form(line) & (F.length(word) >= 2), word),
            "form": F.when(_is_form(line) | line.rlike(ADDRESS), "form").when(line.rlike(CLOSED), "closed"),
        }
    )
    open_ = open_.withColumns({"head": F.substring("clause", 1, PREFIX), "gram": F.right("clause", F.lit(GRAM))})
    stats = cut(line_statistics(df, text_col, source_col))

    def counts(kind: str, n: str, flagged: str) -> DataFrame:
        return stats.filter(F.col("kind") == kind).select(F.col("key").alias(kind), F.col("n").alias(n), F.col("flagged").alias(flagged))

    base = counts("base", "n_paragraphs", "n_terminated")
    of_script = base.groupBy(F.substring_index("base", "\u001f", 1).alias("script")).agg(F.sum("n_paragraphs").alias("n_all"), F.sum("n_terminated").alias("n_all_terminated"))
    known = (
        open_.join(counts("start", "n_lines", "n_last"), "start", "left")
        .join(counts("head", "n_clauses", "n_closing"), "head", "left")
        .join(counts("gram", "n_any", "n_end"), "gram", "left")
        .join(counts("tip", "n_tips", "n_tip_last"), "tip", "left")
        .join(counts("word", "n_words", "n_whole"), "word", "left")
        .join(base, "base", "left")
        .join(F.broadcast(of_script), "script", "left")  # one row per script
    )
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    # The text itself is one of the lines with its start and end; it does not count for itself.
    closes = lambda last, of: (F.col(last) - 1) / (F.col(of) - 1 + WEIGHT) >= 0.5
    closing = (_may_close(line) & closes("n_last", "n_lines")) | (_is_short(line) & closes("n_tip_last", "n_tips"))
    attested = n("n_end") > GRAM_END * (n("n_any") - n("n_end"))
    # Clauses that start like this and never close a line: under one in 250, smoothed by a fifth of a line.
    opening = n("n_closing") + 0.2 < 0.004 * n("n_clauses")
    overall = (n("n_all_terminated") + WEIGHT * PRIOR) / (n("n_all") + WEIGHT)
    punctuated = (n("n_terminated") + WEIGHT * overall) / (n("n_paragraphs") + WEIGHT)
    late = (
        F.when((F.col("form") == "form") & F.col("word").isNotNull() & (n("n_words") > 0) & (n("n_whole") == 0), "cut in a sentence")
        .when(F.col("form").isNotNull(), F.col("form"))
        .when(closing, "closing")
        .when(F.col("clause").isNotNull() & attested & ~opening, "clause")
        .when(F.col("clause").isNotNull() & attested, "cut between clauses")
        .when(F.col("clause").isNull() & (punctuated < PUNCTUATED), "unpunctuated")
        .otherwise("cut in a sentence")
    )
    columns = ("doc_id", "source", "line", "n_chars", "n_bytes", "verdict")
    judged = known.withColumn("verdict", late).select(*columns).unionByName(ends.filter("verdict is not null").select(*columns))
    return _at_limits(cut(judged)).select("doc_id", "source", F.col("line").alias("last_line"), "verdict", F.col("verdict").isin(*CUT).alias("is_cut"))


def _at_limits(judged: DataFrame) -> DataFrame:
    """Ambiguous ends whose source cuts most of its other texts at this very length count as cut at a limit.

    A limit holds at least ``LIMIT_SHARE`` of the cut texts of its source.
    Lengths are compared in characters, and in bytes in steps of four, as a
    limit in bytes may leave out or replace a part of a character.
    """
    doubtful = F.col("verdict").isin("form", "closed", "closing", "clause", "unpunctuated")
    near = lambda shift: F.floor((F.col("n_bytes") + shift) / 4)
    lengths = F.array(*[F.concat_ws(":", F.lit(kind), value.cast("string")) for kind, value in (("c", F.col("n_chars")), ("b", near(0)), ("d", near(2)))])
    # A complete form must have the very length of the limit.
    own = F.when(F.col("verdict") == "form", F.slice("lengths", 1, 1)).otherwise(F.col("lengths"))
    keyed = judged.withColumn("lengths", F.when(F.col("verdict") != "empty", lengths))
    totals = keyed.groupBy(F.col("source").alias("in_source")).agg(F.count_if(F.col("verdict").isin(*CUT)).alias("n_source_cut"))
    per = (
        keyed.select("source", F.explode("lengths").alias("length"), F.col("verdict").isin(*CUT).alias("is_cut"))
        .groupBy("source", "length")
        .agg(F.count("*").alias("n"), F.count_if("is_cut").alias("n_cut"))
        .join(totals, F.col("source").eqNullSafe(F.col("in_source")))
        .filter((F.col("n_cut") > 0.5 * (F.col("n") - 1 + WEIGHT)) & (F.col("n_cut") >= LIMIT_SHARE * F.col("n_source_cut")))
        .groupBy(F.col("source").alias("of_source"))
        .agg(F.collect_set("length").alias("limits"))
    )
    return (
        keyed.join(per, F.col("source").eqNullSafe(F.col("of_source")), "left")
        .select("doc_id", "source", "line", F.when(doubtful & F.arrays_overlap(own, F.col("limits")), "cut at a limit").otherwise(F.col("verdict")).alias("verdict"))
    )


def source_rates(judged: DataFrame) -> DataFrame:
    """Per source: texts, cut texts, the share, and how it stands to the share of all texts."""
    per = judged.groupBy("source").agg(F.count_if(F.col("verdict") != "empty").alias("n_texts"), F.count_if("is_cut").alias("n_cut"))
    total = per.agg(F.sum("n_texts").alias("t"), F.sum("n_cut").alias("c"))
    return per.crossJoin(F.broadcast(total)).select("source", "n_texts", "n_cut", F.round(F.col("n_cut") / F.col("n_texts"), 6).alias("cut_share"), F.round(F.col("c") / F.col("t"), 6).alias("base_share"))
