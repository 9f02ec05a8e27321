"""The training-data operators: results against brute force, and odd rows of every kind."""

import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paralode.llm import canonical, cube, langid, leakage, mojibake, overlap, packing, repetition, splits, truncation
from paralode.llm.graph import connected_components

LONG = "The quiet savings bank published annual audit reports. " * 4000


# -- p1 ---------------------------------------------------------------------

SFT = "record_id string, original_id string, pair_group_id string, direction string, split string, component string, n long"


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(f"g{rng.randrange(60):02d}", f"o{rng.randrange(60):02d}") for _ in range(70)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges + [(None, "x"), ("y", "y")], "u string, v string")).collect()}
    assert got == {n: find(n) for e in edges for n in e}


def test_splits_keep_related_records_together(spark):
    rows = [
        ("a", "o1", " PAIR_X ", "zh-CN->en", "train", "clash", 1),
        ("b", None, "pair_x", "en->zh-CN", "test", "clash", 1),
        ("c", "o1", None, None, None, "clash", 1),
        ("d", None, None, "zh-CN->en", "train", None, 1),
        ("e", None, "", "zh-CN->en", "test", None, 1),
        ("e", None, "", "zh-CN->en", "test", None, 1),
    ]
    got = splits.grouped_splits(spark.createDataFrame(rows, SFT)).collect()
    assert len(got) == 6
    by = {r["record_id"]: r for r in got}
    assert {k for k, r in by.items() if r["is_torn"]} == {"a", "b", "c"}
    assert len({by[k]["component"] for k in "abc"}) == 1 and len({by[k]["new_split"] for k in "abc"}) == 1
    assert splits.grouped_splits(spark.createDataFrame([], SFT)).count() == 0


def test_splits_meet_their_shares(spark):
    rng = random.Random(1)
    rows = [(f"r{i}", None, f"g{rng.randrange(700)}", rng.choice(["a", "b", "c"]), None, "", 0) for i in range(2000)]
    got = splits.grouped_splits(spark.createDataFrame(rows, SFT))
    share = {r["new_split"]: r["count"] / 2000 for r in got.groupBy("new_split").count().collect()}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["validation"] - 0.1) < 0.01 and abs(share["test"] - 0.1) < 0.01
    assert got.groupBy("component").agg(F.count_distinct("new_split").alias("n")).filter("n > 1").count() == 0


def test_one_group_with_a_third_of_all_rows(spark):
    rows = [(f"r{i}", None, "hot" if i % 3 == 0 else f"g{i}", "a", "train" if i % 2 else "test", "", 0) for i in range(3000)]
    got = splits.grouped_splits(spark.createDataFrame(rows, SFT))
    assert got.filter("is_torn").count() == 1000


# -- p2 ---------------------------------------------------------------------


def _canon(t):
    t = "".join(unicodedata.normalize("NFKC", c) if 0xFF00 <= ord(c) <= 0xFFEF else c for c in t or "")
    return "".join(c for c in unicodedata.normalize("NFC", t.casefold()) if unicodedata.category(c)[0] not in "PZ" and unicodedata.category(c) not in ("Cc", "Cf") and not c.isspace())


def test_hidden_duplicates(spark):
    rows = [
        ("a", "你好，世界。", "Hello, World", "k"),
        ("b", "HELLO　ｗorld!", "你好 世界", "k"),
        ("c", "你好世界", "hello​ world", "k"),
        ("d", "你好世界", "hello worlds", "k"),
        ("e", None, "only", "k"),
        ("f", "", "Only.", "k"),
        ("g", None, None, "k"),
        ("h", "", " ", "k"),
        ("i", LONG, "x", "k"),
        ("i", LONG, "x", "k"),
        ("j", "Café", "y", "k"),
        ("l", "CAFÉ", "y", "k"),
    ]
    found = canonical.hidden_duplicates(spark.createDataFrame(rows, "pool_record_id string, zh_text string, en_text string, key string"))
    assert {tuple(r) for r in found["members"].collect()} == {("a", "b"), ("a", "c"), ("e", "f"), ("j", "l")}
    groups = {r["keep_id"]: r["n_copies"] for r in found["groups"].collect()}
    assert groups["a"] == 3 and groups["i"] == 2 and groups["g"] == 1 and groups["h"] == 1
    assert found["collisions"].count() == 0
    brute = defaultdict(list)
    for i, zh, en, _ in rows:
        brute[tuple(sorted((_canon(zh), _canon(en))))].append(i)
    assert {min(v): len(v) for k, v in brute.items() if any(k)} == {k: n for k, n in groups.items() if k not in "gh"}


def test_hidden_duplicates_empty(spark):
    found = canonical.hidden_duplicates(spark.createDataFrame([], "pool_record_id string, zh_text string, en_text string"))
    assert found["groups"].count() == found["members"].count() == 0


# -- p3 ---------------------------------------------------------------------


def test_flight_keeps_balance():
    rng = np.random.default_rng(0)
    pi = rng.random(400)
    x = np.eye(4)[rng.integers(0, 4, 400)]
    out = cube.flight(pi, x, rng)
    assert np.allclose(pi @ x, out @ x) and ((out > 0) & (out < 1)).sum() <= 4
    done = cube.landing(out, x, rng)
    assert set(np.unique(done)) <= {0.0, 1.0} and np.abs(pi @ x - done @ x).max() < 2


def test_flight_of_categories_keeps_balance_without_a_matrix():
    rng = np.random.default_rng(0)
    pi, k = rng.random(5000), rng.integers(0, 900, 5000)
    out = cube.flight_categories(pi, k, rng)
    sums = lambda p: np.bincount(k, weights=p, minlength=900)
    assert np.allclose(sums(pi), sums(out)) and np.bincount(k[(out > 0) & (out < 1)], minlength=900).max() <= 1
    done = cube.landing_categories(out, rng)
    assert set(np.unique(done)) <= {0.0, 1.0} and np.abs(sums(pi) - sums(done)).max() < 1 and abs(done.sum() - pi.sum()) < 1
    one, many = np.array([0.3, 0.6, 0.4]), np.zeros(3)
    for seed in range(4000):
        many += cube.landing_categories(cube.flight_categories(one, np.array([0, 0, 1]), r := np.random.default_rng(seed)), r)
    assert np.abs(many / 4000 - one).max() < 0.03


def test_report_follows_the_draw(spark, monkeypatch):
    monkeypatch.setattr(cube, "landing_categories", lambda pi, rng: np.zeros(len(pi)))
    data = spark.createDataFrame([(str(i), "a", "b", "c", None) for i in range(10)], "id string, domain string, source_lang string, target_lang string, loaded_at timestamp")
    goals = spark.createDataFrame([("a", "b", "c", 1.0, 12, 1.0)], "domain string, source_lang string, target_lang string, target_share double, min_rows int, sample_share double")
    assert [r["served"] for r in cube.proportional_sample(data, goals)["report"].collect()] != [False]


def test_sample_follows_targets(spark):
    rows = [(str(i), "Finance " if i % 2 else "ＦＩＮＡＮＣＥ", "zh_CN", "EN", None, "k") for i in range(300)] + [(str(300 + i), "law", "en", "zh-CN", None, "k") for i in range(10)]
    rows += [("1", "finance", "zh-CN", "en", None, "k"), ("x", None, None, None, None, "k"), ("y", "", "en", "en", None, "k")]
    data = spark.createDataFrame(rows, "id string, domain string, source_lang string, target_lang string, loaded_at timestamp, category string")
    goals = spark.createDataFrame([("finance", "zh-CN", "en", 0.75, 5, 0.2), ("law", "en", "zh-CN", 0.25, 12, 0.2), ("art", "en", "zh-CN", 0.0, 0, 0.2)], "domain string, source_lang string, target_lang string, target_share double, min_rows int, sample_share double")
    out = cube.proportional_sample(data, goals, block_rows=40, fan_in=2)
    report = {r["domain"]: r for r in out["report"].collect()}
    assert report["finance"]["available"] == 300 and abs(report["finance"]["sampled"] - 0.75 * 0.2 * 312) <= 1 and report["finance"]["served"]
    assert report["law"]["sampled"] == 10 and not report["law"]["served"]
    assert report["art"]["sampled"] == 0 and report["art"]["served"]
    sample = out["sample"].collect()
    assert len(sample) == len({r["id"] for r in sample}) == report["finance"]["sampled"] + 10
    assert {r["id"] for r in cube.proportional_sample(data, goals, block_rows=40, fan_in=2)["sample"].collect()} == {r["id"] for r in sample}


def test_sample_of_nothing(spark):
    data = spark.createDataFrame([], "id string, domain string, source_lang string, target_lang string, loaded_at timestamp")
    goals = spark.createDataFrame([("a", "b", "c", 1.0, 1, 0.5)], "domain string, source_lang string, target_lang string, target_share double, min_rows int, sample_share double")
    out = cube.proportional_sample(data, goals)
    assert out["sample"].count() == 0 and [r["served"] for r in out["report"].collect()] == [False]


# -- p4 ---------------------------------------------------------------------


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_overlaps_find_planted_pairs(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    text = lambda: " ".join(rng.choice(words) for _ in range(35))
    rows, want = [], set()
    for i in range(120):
        t = text()
        rows.append((f"t{i:03d}", t, "train", "f"))
        if i % 3 == 0:
            chars = list(t)
            for p in rng.sample(range(len(chars)), int(len(chars) * 0.03)):
                chars[p] = "q"
            rows.append((f"v{i:03d}", "".join(chars).upper() + "!", "test", "f"))
            want.add((f"t{i:03d}", f"v{i:03d}"))
    rows += [("n1", None, "train", "f"), ("n2", None, "test", "f"), ("e1", "", "train", "f"), ("e2", "?!", "test", "f"), ("z", text(), None, "f"), ("l1", LONG, "train", "f"), ("l2", LONG, "validation", "f")]
    want.add(("l1", "l2"))
    data = spark.createDataFrame(rows, "record_id string, source_text string, split string, class string")
    got = {(r[0], r[1]) for r in overlap.overlap_pairs(overlap.split_overlaps(data)).collect()}
    assert not got - want
    assert len(got) >= 0.95 * len(want)
    sample = dict((r[0], r[1]) for r in rows)
    for a, b in sorted(got)[:5]:
        x, y = (_canon(sample[k]) for k in (a, b))
        assert len(x) > 10_000 or _lev(x, y) <= 0.1 * max(len(x), len(y))


def test_overlaps_miss_no_pair_of_spread_edits(spark):
    rng = random.Random(8)
    letters = {"en": "etaoinshrdlucmfwyp", "th": "".join(chr(c) for c in range(0x0E01, 0x0E2F)), "zh": "".join(chr(0x4E00 + 7 * k) for k in range(300))}
    rows, want = [], set()
    for lang, alphabet in letters.items():
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 8))) for _ in range(60)]
        for i in range(60):
            t = "".join(rng.choice(words) for _ in range(40))[: [9, 10, 11, 17, 19, 40, 64, 100, 130, 180][i % 10]]
            edits = int(len(t) * 0.1)
            chars = list(t)
            for k in range(edits):
                p = min(len(chars) - 1, int((k + 0.5) * len(chars) / edits))
                op = rng.randrange(3) if i % 2 else 0
                chars[p : p + 1] = [["x"], [], [chars[p], "x"]][op]
            rows += [(f"t{lang}{i}", t, "train"), (f"v{lang}{i}", "".join(chars), "test")]
    train, held = [r for r in rows if r[2] == "train"], [r for r in rows if r[2] == "test"]
    for x, s, _ in train:
        for y, t, _ in held:
            if abs(len(s) - len(t)) <= 0.1 * max(len(s), len(t)) and _lev(s, t) <= int(0.1 * max(len(s), len(t))):
                want.add((x, y))
    got = {(r[0], r[1]) for r in overlap.overlap_pairs(overlap.split_overlaps(spark.createDataFrame(rows, "record_id string, source_text string, split string"))).collect()}
    assert len(want) >= 120 and got == want


def test_overlaps_of_copies_and_nothing(spark):
    schema = "record_id string, source_text string, split string, source_file string"
    rows = [(f"t{i}", "Same text here, again and again.", "train", "a") for i in range(30)] + [(f"v{i}", "same TEXT here again and again", "test", "b") for i in range(20)]
    data = spark.createDataFrame(rows, schema)
    found = overlap.split_overlaps(data)
    assert found["links"].count() == 1 and overlap.overlap_pairs(found).count() == 600
    assert [(r["n_records"], r["n_overlapping"], r["n_exact"]) for r in overlap.overlap_report(data, found).collect()] == [(20, 20, 20)]
    assert overlap.overlap_pairs(overlap.split_overlaps(spark.createDataFrame([], schema))).count() == 0


# -- p5 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return langid.train([])


def test_code_lengths_are_a_code(model):
    # Under every context the probabilities of all next bytes, escapes included, add up to at most one.
    prefix = "ประเทศ".encode()
    raw = np.frombuffer(b"".join(prefix + bytes([b]) for b in range(256)), dtype=np.uint8)
    bits = model.code_lengths(raw)[len(prefix) :: len(prefix) + 1]
    assert bits.shape[0] == 256 and (2.0 ** -bits.astype(float)).sum(axis=0).max() <= 1.0 + 1e-3


def test_languages_and_mixed_texts(spark, model):
    en, th = "The committee has opened a new school for the people of this city.", "โรงเรียนในเมืองนี้เปิดสอนหลักสูตรใหม่สำหรับนักเรียนทุกคน"
    rows = [
        ("1", "th", th), ("2", "TH_th", th), ("3", None, th), ("4", "und", th), ("5", "en", th), ("6", "th", th + " " + en), ("7", "th", th + " GPU https://a.example/b และ API"),
        ("8", "th", None), ("9", "th", ""), ("10", "zh_cn", "银行宣布将降低利率，工程师们正在测试新的系统。"), ("11", "id", "Sekolah di kota ini telah membuka kursus baru untuk semua siswa."), ("12", "zh-CN", "学校は今年すべての生徒のために新しい講座を開きました。"),
        ("13", "en", LONG), ("13", "en", LONG), ("14", "en", "?!"),
    ]
    data = spark.createDataFrame([(*r, "x") for r in rows], "record_id string, target_lang string, target_text string, lang string")
    found = langid.language_segments(data, model)
    assert found.filter("record_id in ('8', '9') and lang is null and confidence = 0").count() == 2
    got = {tuple(r) for r in langid.mislabelled(found).collect()}
    assert got == {("3", "th"), ("4", "th"), ("5", "th"), ("6", "th"), ("6", "en"), ("12", "ja")} | {g for g in got if g[0] == "14"}
    assert langid.language_segments(data.limit(0), model).count() == 0


# -- p6 ---------------------------------------------------------------------

ZH = "银行宣布将降低利率，工程师们正在测试新的系统。学校今年为所有学生开设了新的课程。"
TH = "โรงเรียนในเมืองนี้เปิดสอนหลักสูตรใหม่สำหรับนักเรียนทุกคนในปีนี้"
EN = "The parents’ council of Dronuldèl praised the café – a first for Ixmia."


def _sloppy(raw, codec):
    return "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in raw)


@pytest.mark.parametrize(
    "text, language, damage",
    [
        (ZH, "zh", lambda t: _sloppy(t.encode(), "cp1252")),
        (ZH, "zh", lambda t: _sloppy(_sloppy(t.encode(), "cp1252").encode(), "cp1252")),
        (ZH, "zh", lambda t: _sloppy(t.encode(), "mac_roman")),
        (ZH, "zh", lambda t: t.encode("gbk").decode("latin-1")),
        (ZH[:20] + "{}", "zh", lambda t: t.format(_sloppy(ZH[20:].encode(), "cp1252"))),
        (TH, "th", lambda t: _sloppy(t.encode(), "cp1252")),
        (TH, "th", lambda t: _sloppy(t.encode(), "cp874")),
        (TH, "th", lambda t: t.encode("tis-620").decode("latin-1")),
        (EN, "en", lambda t: _sloppy(t.encode(), "cp1252")),
        (EN, "en", lambda t: _sloppy(t.encode(), "mac_roman")),
    ],
)
def test_round_trips(text, language, damage):
    describe = mojibake.Describer({"zh": ZH.encode() * 3, "th": TH.encode() * 3, "en": EN.encode() * 3})
    whole = text.format(ZH[20:]) if "{}" in text else text
    status, chain, fixed = mojibake.examine(damage(text), language, describe)
    assert (status, fixed) == ("restored", whole) and chain
    assert mojibake.examine(whole, language, describe) is None


def test_description_length_decides():
    """With a describer that says the same of every text nothing is restored; without dictionaries what grows is not."""
    damaged = [_sloppy(ZH.encode(), "cp1252"), _sloppy(TH.encode(), "mac_roman"), EN.encode().decode("mac_roman")]
    for text, language in zip(damaged, ("zh", "th", "en")):
        assert mojibake.restore(text, language, lambda t: 7.0) == (text, [])
        assert mojibake.examine(text, language, lambda t: 7.0) is None
    thai = TH.encode("tis-620").decode("latin-1")
    full = mojibake.Describer({"th": TH.encode() * 3})
    assert mojibake.examine(thai, "th", full)[2] == TH
    assert mojibake.examine(thai, "th", mojibake.Describer({})) is None or mojibake.examine(thai, "th", mojibake.Describer({}))[2] != TH
    assert all(step.cost > 0 for step in mojibake.STEPS)


def test_every_wrong_decoding_of_a_chain_is_undone():
    text = ZH
    for _ in range(5):
        text = _sloppy(text.encode(), "cp1252")
    status, chain, fixed = mojibake.examine(text, "zh", mojibake.Describer({"zh": ZH.encode() * 3}))
    assert (status, fixed, chain.count("<")) == ("restored", ZH, 4)


def test_trained_dictionaries():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["银行", "学校", "宣布", "降低", "利率", "系统", "课程", "，"]) for _ in range(30)).encode() for _ in range(400)]
    trained = mojibake.train_dictionary(texts, 65_536)
    assert trained[:4] == mojibake.TRAINED and mojibake.train_dictionary(texts[:2], 65_536)
    assert mojibake.Describer({"zh": trained})("银行宣布降低利率") < mojibake.Describer({})("银行宣布降低利率")


def test_damaged_values(spark):
    rows = [("1", ZH, EN), ("2", ZH.replace("利率", "��"), EN), ("3", None, ""), ("4", "系统" + "?" * 12, "Is this so? Really?? Yes!"), ("5", "café 龘靐", "naïve Zoë — “déjà vu”…"), ("6", LONG, LONG), ("2", ZH.replace("利率", "��"), EN)]
    data = spark.createDataFrame([(*r, "x") for r in rows], "pool_record_id string, zh_text string, en_text string, chain string")
    found = mojibake.damaged_values(data, "zh_en_pool", "pool_record_id", {"zh_text": "zh", "en_text": "en"}, {"zh": ZH.encode()})
    assert Counter((r["record_key"], r["field_name"], r["status"]) for r in found.collect()) == {("2", "zh_text", "damaged"): 2, ("4", "zh_text", "damaged"): 1}
    assert mojibake.damaged_values(data.limit(0), "t", "pool_record_id", {"zh_text": "zh"}, {}).count() == 0


# -- p7 ---------------------------------------------------------------------


def _repeat_share(t, n=10):
    import re

    t = re.sub(r"[\s\d.]", "", t or "")
    seen, cover = set(), set()
    for i in range(len(t) - n + 1):
        g = t[i : i + n]
        if g in seen:
            cover |= set(range(i, i + n))
        seen.add(g)
    return len(cover) / len(t) if len(t) >= n else 0.0


def test_repetition_against_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "short", "abcdefghij" * 3, "aaaaaaaaaaaaaaaaaaaa", "1234567890 ... " * 5, LONG[:20000], "ก𠀀" * 30]
    texts += ["".join(rng.choice(["alpha beta ", "gamma delta eps ", "zeta! "]) for _ in range(rng.randrange(30))) for _ in range(20)]
    data = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "record_id int, target_text string, length string")
    got = {r["record_id"]: r for r in repetition.repetition_profile(data).collect()}
    for i, t in enumerate(texts):
        assert got[i]["repeat_share"] == pytest.approx(_repeat_share(t)), t
        assert ("repeated_content" in got[i]["flags"]) == (_repeat_share(t) >= 0.5)
    assert repetition.repetition_profile(data.limit(0)).count() == 0


# -- p8 ---------------------------------------------------------------------


def test_packing_wastes_little_and_loses_nothing(spark):
    rng = random.Random(5)
    sizes = [rng.randrange(1, 700) for _ in range(3000)] + [0, None, 4096, 5000, 12_288, 1000]
    data = spark.createDataFrame([(i, s, i) for i, s in enumerate(sizes)], "doc_id int, n_tokens long, seed long")
    packed = packing.pack(data, 1000, block_items=800)
    rows = packed.collect()
    pieces = defaultdict(int)
    bins = defaultdict(int)
    for r in rows:
        if r["container"] is not None:
            pieces[r["doc_id"]] += r["piece_tokens"]
            bins[(r["block"], r["container"])] += r["piece_tokens"]
    assert dict(pieces) == {i: s for i, s in enumerate(sizes) if s is not None}
    assert max(bins.values()) <= 1000 and sum(bins.values()) / (1000 * len(bins)) > 0.97
    assert Counter(r["doc_id"] for r in rows)[3001] == 1 and [r["container"] for r in rows if r["doc_id"] == 3001] == [None]
    assert {r["doc_id"] for r in rows if r["piece"] > 0} == {i for i, s in enumerate(sizes) if s and s > 1000}
    assert packing.pack(data.limit(0), 10).count() == 0


def test_sum_of_squares_rule():
    # Fills a gap exactly where that lowers the sum, opens a container otherwise.
    assert packing.sum_of_squares(np.array([6, 4, 6, 4]), 10).tolist() in ([0, 0, 1, 1], [0, 1, 1, 0], [0, 1, 0, 1])
    rng = np.random.default_rng(1)
    where = packing.sum_of_squares(rng.integers(1, 30, 500), 60)
    assert where.max() + 1 >= 500 * 15 / 60 * 0.9


def test_token_sizes(spark):
    data = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (4, "<|endoftext|> สวัสดี", "x"), (4, "again", "x")], "doc_id int, text string, n_tokens string")
    sizes = {(r["doc_id"], r["n_tokens"] is None, r["n_tokens"] == 0) for r in packing.token_sizes(data).collect()}
    assert (2, True, False) in sizes and (3, False, True) in sizes and (1, False, False) in sizes


# -- p9 ---------------------------------------------------------------------


def test_leaks(spark):
    rng = random.Random(8)
    nouns = [w + s for w in ("bank", "school", "museum", "factory", "river", "harbour", "garden", "library") for s in ("", "s", " board", " office")]
    name = lambda: "".join(rng.choice(["ka", "lo", "mi", "ser", "tun", "vo", "pra", "zel"]) for _ in range(4)).title()
    sentence = lambda: f"The {rng.choice(nouns)} of {name()} {rng.choice(['opened', 'closed', 'praised', 'rebuilt'])} the {rng.choice(nouns)} near {name()} with {rng.choice(nouns)}."
    items = [(i, " ".join(sentence() for _ in range(4))) for i in range(30)]
    filler = lambda: " ".join(sentence() for _ in range(10))
    docs, want = [], set()
    for i, t in items[:10]:
        docs.append((i, f"{filler()} {t.upper().replace('.', ' !')} {filler()}"))
        want.add((i, i))
    for i, t in items[10:20]:
        half = " ".join(t.split(". ")[:3])
        docs.append((i, f"{filler()} {half} {filler()}"))
        want.add((i, i))
    for i, t in items[20:]:
        docs.append((i, f"{filler()} {t.split('. ')[0]} {filler()}"))  # a short quotation
    docs += [(100, None), (101, ""), (102, LONG), (103, docs[0][1]), (103, docs[0][1])]
    want.add((103, 0))
    data = spark.createDataFrame([(*r, "x") for r in docs], "doc_id int, text string, coverage string")
    bench = spark.createDataFrame([(*r, "test") for r in items], "item_id int, text string, split string")
    hits = leakage.leaked_items(data, bench)
    assert {(r["doc_id"], r["item_id"]) for r in hits.collect()} == want
    report = {r["item_id"]: r["n_documents"] for r in leakage.leak_report(hits, bench).collect()}
    assert report[0] == 2 and report[25] == 0
    assert leakage.leaked_items(data.limit(0), bench).count() == 0 and leakage.leaked_items(data, bench.limit(0)).count() == 0
    blocks = leakage.leaked_items(data, bench, block_items=7)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == want


def test_paraphrases_are_found_and_other_orders_are_not(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeioubcdfghlmnprstvz") for _ in range(rng.randrange(3, 11))) for _ in range(900)]
    text = lambda n: " ".join(vocabulary[min(899, int(rng.expovariate(1 / 180)))] for _ in range(n))
    items = [(i, text(44)) for i in range(24)]
    docs = []
    for i, t in items[:12]:
        words = t.split()
        words[2::3] = [rng.choice(vocabulary) for _ in words[2::3]]  # one word in three
        docs.append((i, f"{text(90)} {' '.join(words)} {text(90)}"))
    for i, t in items[12:]:
        parts = [t.replace(" ", "")[k : k + 20] for k in range(0, 200, 20)]
        swapped = "".join(p for k in range(0, 10, 2) for p in parts[k : k + 2][::-1])
        docs.append((i, f"{text(90)} {swapped} {text(90)}"))
    docs += [(100 + i, text(250)) for i in range(100)]
    data = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    hits = leakage.leaked_items(data, bench).collect()
    assert all(r["doc_id"] == r["item_id"] for r in hits)
    found = {r["doc_id"]: (r["kind"], r["coverage"]) for r in hits}
    assert sum(found.get(i, ("",))[0] == "paraphrase" for i in range(12)) >= 7
    assert not {k: v for k, v in found.items() if 12 <= k < 24}


def test_common_subsequences_against_brute_force():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    rng = random.Random(3)
    for _ in range(60):
        a, b = [[rng.randrange(7) for _ in range(rng.randrange(1, 90))] for _ in range(2)]
        assert leakage.common_words(leakage.word_masks(a), len(a), b) == lcs(a, b)
        hits = [(i, j) for i, x in enumerate(b) for j, y in enumerate(a) if x == y]
        at, place = np.array([h[0] for h in hits], dtype=int), np.array([h[1] for h in hits], dtype=int)
        chain = leakage.longest_chain(at, place)
        assert len(chain) == lcs(a, b) and (np.diff(at[chain]) > 0).all() and (np.diff(place[chain]) > 0).all()
    text = np.array([rng.randrange(5000) for _ in range(240)], dtype=np.uint64)
    swapped = np.concatenate([c for k in range(0, 240, 40) for c in (text[k + 20 : k + 40], text[k : k + 20])])
    known = {g: i for i, g in enumerate(leakage.gram_hashes(text, 5).tolist())}
    hits = [(i, known[g]) for i, g in enumerate(leakage.gram_hashes(swapped, 5).tolist()) if g in known]
    assert leakage.chain_coverage(np.array([h[0] for h in hits]), np.array([h[1] for h in hits]), 5, 240) < 0.55


# -- p10 --------------------------------------------------------------------


def test_cut_texts(spark):
    whole = ["The bank closed. It opened again.", "银行宣布降低利率。", "He said “it is done.”", "List\n- one\n- two", "Total | 3 | 4", "See\nhttps://a.example/b", "关键词：预算，学校", "Done (really)", "Plan\n- growth of 45%", "Plan\n- work of R&D", "ตามเอกสาร ธนาคารลดดอกเบี้ยครับ"]
    cut = ["The bank closed. It opened ag", "The bank clos…", "银行宣布降低利率。学校今年", "He said “it is", "The bank closed &nb", "The bank closed <di", "The bank �", "It was read [...]", "He went (more", LONG + "and then"]
    none = [None, "", " \n "]
    rows = [(i, t, "s" if i % 2 else None) for i, t in enumerate(whole + cut + none)]
    judged = truncation.judge_ends(spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, source string, verdict string"))
    got = {r["doc_id"] for r in judged.filter("is_cut").collect()}
    assert got == set(range(len(whole), len(whole) + len(cut)))
    assert judged.count() == len(rows)
    rates = truncation.source_rates(judged).collect()
    assert sum(r["n_cut"] for r in rates) == len(cut) and sum(r["n_texts"] for r in rates) == len(whole) + len(cut)
    empty = spark.createDataFrame([], "doc_id int, text string, source string")
    assert truncation.judge_ends(empty).count() == 0


def test_thai_clauses_follow_the_corpus(spark):
    subject, tail = ["ธนาคาร", "โรงเรียน", "ห้องสมุด", "บริษัท"], ["ในปีนี้", "ก่อนเปิดภาคเรียน", "โดยไม่มีใครคัดค้าน"]
    rows = [(i, "\n".join(f"{subject[(i + k) % 4]}ประกาศแผนใหม่ {tail[(i * 7 + k) % 3]}" for k in range(4)), "s") for i in range(200)]
    rows += [(900, rows[0][1] + "\nธนาคารประกาศแผนให", "s"), (901, rows[1][1] + "\nโรงเรียนประกาศแผนใหม่ ก่อนเปิดภ", "s")]
    judged = truncation.judge_ends(spark.createDataFrame(rows, "doc_id int, text string, source string"))
    assert {r["doc_id"] for r in judged.filter("is_cut").collect()} == {900, 901}


def test_stack_automaton(spark):
    cases = {"a (b [c] d": "(", "a (b) “c": "“", "it’s ‘fine’": "", "「『x』": "「", "1) one (two)": "", ")(": "("}
    cases |= {'a "b" c': "", 'a "b\nc.': '"', '(a "b" c': "(", "<div><p>a": "<div", "<div><p>a</div>": "", "<br>a<b>c</b><hr/>": "", "```\nx = (1)\n": "```", "```\nx\n```\n": "", 'a 5" pipe.': "", "the parents’": "", "(x\ny.": "("}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", truncation.open_structures(F.col("t")).alias("s")).collect()
    assert {r["t"]: r["s"] for r in rows} == cases
