"""Text functions against plain Python."""

import re
import unicodedata
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from paralode.functions import keys, normalize, scripts, text, urls, wiki
from paralode.plans import text_queries

SAMPLES = [None, "", "  a b　c ", "é​x﻿", "ＡＢＣ１２３", "ﬁ ½ Straße İ", "line\r\nbreak\x07 \x85z", "&amp; &lt;b&gt; <i>x</i>", "学校 school “q”", "ก็ น้ำ ํา", "𠀀𠀁 x", "a‍b"]


def run(spark, column, samples=SAMPLES):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, c string").select("i", column.alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


def test_unicode_forms(spark):
    for form, fn in (("NFC", text.nfc), ("NFKC", text.nfkc)):
        assert run(spark, fn("c")) == [None if s is None else unicodedata.normalize(form, s) for s in SAMPLES]
    assert run(spark, text.casefold("c")) == [None if s is None else s.casefold() for s in SAMPLES]


def test_pool_form(spark):
    def plain(s):
        out = []
        for ch in unicodedata.normalize("NFC", s or ""):
            if ch in normalize.ZERO_WIDTH_POOL:
                continue
            kind = unicodedata.category(ch)
            out.append(" " if ch in " 　\r\n\t\f\v" or kind == "Zs" else "" if kind in ("Cc", "Cf") else ch)
        return re.sub(r"\s+", " ", "".join(out)).strip()

    assert run(spark, normalize.pool_text("c")) == [plain(s) for s in SAMPLES]


def test_forms_differ_where_stages_do(spark):
    joined, parted = run(spark, normalize.pool_text("c"), ["a­b"]), run(spark, normalize.bitext_text("c"), ["a­b"])
    assert (joined, parted) == (["ab"], ["a b"])
    assert run(spark, normalize.page_text("c"), ["a \n\n\n\n b \tc "]) == ["a\n\nb c"]
    assert run(spark, normalize.tsv_text("c"), ["&lt;b&gt;x&amp;y</b>"]) == ["x&y"]
    assert run(spark, normalize.side_key("c"), ["A-b, Ç学 ก็!"]) == ["abç学ก็"]
    for fn in normalize.NORMALIZERS.values():
        assert run(spark, fn("c"))[:2] == ["", ""]


def test_han_classes(spark):
    cases = {"々": "script", "〇": "named", "㐀": "pool", "\uf900": "pool", "𠀀": "audit", "\U00030000": "merge", "中": "basic"}
    for ch, variant in cases.items():
        assert run(spark, scripts.han("c", variant), [ch]) == [1]
    assert run(spark, scripts.han("c", "basic"), list(cases)) == [0, 0, 0, 0, 0, 0, 1]


def test_numbers_and_sentences(spark):
    assert run(spark, F.array_join(scripts.numbers("c"), " "), ["1,234 and ５６％ x7 -8.5 7", None]) == ["-8.5 1234 56% 7", ""]
    assert run(spark, scripts.chinese_sentences("c"), ["一。二！ 三", None]) == [["一。", "二！", "三"], []]
    assert run(spark, scripts.english_sentences("c", 1), ["One. Two? \"Three\" e.g. four"]) == [["One.", "Two?", "\"Three\" e.g. four"]]
    pieces = run(spark, scripts.split_codepoints("c", 10), ["abcdefgh, ijklmnopqrstuv", ""])
    assert pieces == [["abcdefgh,", "ijklmnopqr", "stuv"], []]
    assert run(spark, scripts.repeat_score("c", 3), ["abcabc", "ab", None]) == [0.25, 0.0, 0.0]
    assert run(spark, scripts.loop_span("c"), ["xabababababy", "abc", None]) == [10, 0, 0]


def test_keys(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = spark.createDataFrame([("你 好", "Hello", "zh-CN", "en")], "z string, e string, a string, b string")
    r = one.select(keys.pool_pair("z", "e").alias("p"), keys.tsv_pair("z", "e").alias("t"), keys.pair_group("a", "z", "b", "e").alias("g"), keys.pair_group("b", "e", "a", "z").alias("h"), keys.chunk_id("a", "b", "z").alias("c")).first()
    assert r["p"] == sha("你 好\x1fhello") and r["t"] == sha("hello\x1f你 好") and r["g"] == r["h"] and r["c"] == "clean_" + sha("zh-CN\x1fen\x1f你 好")[:20]


def test_urls(spark):
    assert run(spark, urls.canonical_url("c"), ["https://a.b/c?utm_x=1&q=2&spm=3#f", "https://a.b/?from=1", None]) == ["https://a.b/c?q=2", "https://a.b/", None]
    hints = {"https://a/2024-05/06/x": "2024-05-06", "https://a/2024/0506/x": "2024-05-06", "https://a/20240506/x": "2024-05-06", "https://a/2024/5/6/x": "2024-05-06", "https://a/202405/x": "2024-05", "https://a/x": None, "https://a/202405061234/x": "2024-05-06"}
    assert run(spark, urls.url_date_hint("c"), list(hints)) == list(hints.values())
    assert run(spark, urls.url_outside_window("c", "2024-05-01", "2024-06-01"), list(hints)) == [False] * 7
    assert run(spark, urls.normalize_date("c"), ["am 2024年5月6日", "none", None]) == ["2024-05-06", None, None]
    assert run(spark, urls.links("c"), ['<a href="x">1</a><A HREF=\'y\'><a href="x">', None]) == [["x", "y"], []]
    assert run(spark, urls.expand_pages("c", 1, 3, first_bare=True), ["https://a/?page={page}"]) == [["https://a/", "https://a/?page=2", "https://a/?page=3"]]
    page = "<html><title> T </title><nav><p>skipped navigation text here</p></nav><p>A paragraph that is long enough.</p><li>short</li><script>x</script></html>"
    assert run(spark, urls.article_text("c"), [page, None]) == ["A paragraph that is long enough.", ""]
    assert run(spark, urls.page_title("c"), [page]) == ["T"]


def test_wiki(spark):
    markup = "<!-- c -->'''Bold''' [[A|link]] and [[B]]{{T|{{nested}}}} [http://x label]<ref>r</ref>\n== Head ==\n* item\n{| table\n| cell\n|}\n\nSecond [[File:x.jpg|thumb]]para &amp; more"
    assert run(spark, wiki.clean_wikitext("c"), [markup, None, ""]) == ["Bold link and B label\n\nitem\n\nSecond para & more", None, ""]
    assert run(spark, urls.paragraphs("c"), ["a\nb\n\n  \nc", None]) == [["a b", "c"], []]


@pytest.mark.parametrize(
    "markup, text",
    [
        ("a{{b{{c}}d}}e", "ae"), ("a{{b", "a"), ("x{|y|}z|}", "xz|}"), ("{{a|}}b", "b"), ("[[A|b|c]] [[#x]] [[:y]] [[B#s]]", "c   B"),
        ("[[File:x|thumb|[[A]] cap]]", " cap]]"), ("[http://x label] [http://y] http://z q", "label   q"), ("<poem>x</poem><code>y</code><nowiki>k</nowiki>", "k"),
        ("* ''i'' t\n== H ==\n| cell\n! h\nz &amp; <br/>q<ref name=a /> w<ref>zz</ref>", "i t\n\nz & q w"), ("[[u", "[[u"), ("__NOTOC__a<!-- c\nd -->", "a"),
    ],
)
def test_wiki_marks(markup, text):
    assert wiki.plain_text(markup) == text


def test_sentences_of_pages(spark):
    text = "The first one has five words. Too short. \"This one has five words\"\n\nAnother line of five words here"
    assert run(spark, scripts.english_sentences("c"), [text, None]) == [["The first one has five words.", '"This one has five words"', "Another line of five words here"], []]


def test_chunk_sanitiser(spark):
    from paralode.functions.normalize import sanitize_chunk

    cases = {
        "One > Two": "One Two", "It ended.' Then more": "It ended. Then more", "See (https://a.example/x) now": "See now", "我们 项目办公室 电话": "我们", "正文 附件：表": "正文",
        "Plan it. The Secretary of State said:": "Plan it.", "destiny Education Secretary": "destiny. Education Secretary", "website: Oak National Academy": "website. Oak National Academy",
    }
    assert run(spark, sanitize_chunk("c"), list(cases)) == list(cases.values())


def test_link_patterns(spark):
    rows = ["https://a.b/news/1", "https://a.b/news/video", "https://c.d/x", None]
    assert run(spark, urls.passes_patterns("c", allow=r"a\.b/news", exclude="video"), rows) == [True, False, False, False]
    page = "https://www.a.b/government/publications/x?y=1"
    links = F.array(*[F.lit(x) for x in ("/government/publications/x/one", "/government/publications/x", "/government/publications/x/two.pdf", "https://www.a.b/government/publications/x/one#f", "https://e.f/government/publications/x/q")])
    assert run(spark, urls.attached_pages(links, F.col("c"), "/government/(?:publications|statistics)/[^/?#]+"), [page, "https://www.a.b/other"]) == [["https://www.a.b/government/publications/x/one"], []]


def test_page_addresses_of_all_titles(spark, tmp_path):
    titles = {"a": "Bank of China", "b": "银行", "c": "ไทย 1", "d": "A+B & C/D?", "e": None, "f": "50%"}
    spark.createDataFrame(list(titles.items()), "doc_id string, title string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["address"] for r in text_queries.all_page_addresses(spark, str(tmp_path)).collect()}
    assert got == {k: "https://wiki.example/" + quote(t.replace(" ", "_"), safe="") for k, t in titles.items() if t is not None}
