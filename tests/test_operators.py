"""Core operators against brute force on small tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paralode.functions import scripts
from paralode.operators import aggregate, dedup, domains, gates, joins, ordered, select
from paralode.plans import table_queries


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_first_and_last_per_key(spark):
    data = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, None, "w"), ("a", 1, "y")], "k string, o int, __row string")
    assert rows_of(dedup.first_per_key(data, ["k"], ["o"]), "k", "o") == [("a", 1), (None, None)]
    assert rows_of(dedup.last_per_key(data, ["k"], ["o"]), "k", "o") == [("a", 2), (None, 5)]
    assert dedup.first_per_key(data.limit(0), ["k"], ["o"]).count() == 0


def test_greedy_multi_key_is_the_ordered_walk(spark):
    rng = random.Random(11)
    for _ in range(3):
        rows = [(i, *[rng.choice([None, *(f"{c}{rng.randrange(12)}" for _ in range(5))]) for c in "abcd"]) for i in range(60)]
        used, want = [set() for _ in range(4)], {}
        for rank, *ks in rows:
            hit = next((n for n, (k, u) in zip("abcd", zip(ks, used)) if k is not None and k in u), None)
            want[rank] = hit
            if hit is None:
                for k, u in zip(ks, used):
                    u.add(k)
        got = dedup.greedy_multi_key(spark.createDataFrame(rows, "rank int, a string, b string, c string, d string"), ["a", "b", "c", "d"], "rank")
        assert {r["rank"]: r["collides_with"] for r in got.collect()} == want
        assert got.filter("kept").count() == sum(v is None for v in want.values())
    assert dedup.greedy_multi_key(spark.createDataFrame([], "rank int, a string"), ["a"], "rank").count() == 0


def test_lineage(spark):
    data = spark.createDataFrame([("k", 2, ["b"], "s2"), ("k", 1, ["c", "a"], "s1"), ("k", 3, None, "s1"), ("l", 1, [], None)], "key string, o int, flags array<string>, src string")
    got = {r["key"]: r for r in dedup.first_with_lineage(data, "key", ["o"], "flags", F.col("src")).collect()}
    assert got["k"]["o"] == 1 and got["k"]["all_flags"] == ["a", "b", "c"] and got["k"]["sources"] == ["s1", "s2"] and got["k"]["n_rows"] == 3


def test_gates(spark):
    zh, en = "银行宣布" * 30, "The bank said that it would lower the rate of interest for all people in this city and " * 2
    cases = {
        (zh, en): [], ("", en): ["empty_text", "zh_chars_below_minimum", "extreme_length_ratio"], (zh + "�", en): ["severe_mojibake"],
        (en, en): ["identical_bilingual_text", "chinese_language_error", "zh_chars_below_minimum", "extreme_length_ratio"], (zh * 2, en): ["zh_chars_above_maximum", "extreme_length_ratio"],
        (zh, zh): ["identical_bilingual_text", "english_language_error", "english_words_below_minimum", "extreme_length_ratio"],
    }
    data = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, zh string, en string")
    got = {r["i"]: r["r"] for r in data.select("i", gates.pool_gate("zh", "en").alias("r")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    null = spark.createDataFrame([(None, None)], "zh string, en string")
    assert null.select(gates.pool_gate("zh", "en").alias("r")).first()["r"][0] == "empty_text"
    for gate in (gates.sentence_gate, gates.tsv_gate, gates.merge_gate, gates.reversed_field):
        null.select(gate("zh", "en")).collect()


def test_latin_contamination(spark):
    cases = {
        "คำภาษาไทยwordต่อ": (["word"], ["คำภาษาไทยwordต่อ"]), "ไทย API GPU ไทย": ([], []), "ดู https://a.example/word ครับ": ([], []),
        "เขียนถึง someone@example.com ได้": ([], []), "ไทย plain ไทย": (["plain"], []), "ไทย AB-12/3 ไทย": ([], []), "ไทยxไทย": ([], ["ไทยxไทย"]),
    }
    data = spark.createDataFrame([(k,) for k in [*cases, None]], "t string").select("t", gates.latin_contamination("t").alias("c"))
    got = {r["t"]: (r["c"]["words"], r["c"]["mixed"]) for r in data.collect()}
    assert {k: v for k, v in got.items() if k} == cases and got[None] == ([], [])


def test_audit_and_sft_gates(spark):
    th, zh = "ธนาคารประกาศว่าจะลดอัตราดอกเบี้ยให้กับประชาชนในปีนี้", "银行宣布今年将为公众降低利率"
    data = spark.createDataFrame([(1, zh, th), (2, zh, th + "学"), (3, zh, "คำซ้ำ" * 60), (4, None, None), (5, zh + "ก", th), (6, zh, "​" + th)], "i int, zh string, th string")
    judged = gates.with_audit(data, "zh", "th")
    got = {r["i"]: r["d"] for r in judged.select("i", gates.decision(F.col("reject"), F.col("review")).alias("d")).collect()}
    assert got == {1: "accept", 2: "reject", 3: "reject", 4: "reject", 5: "reject", 6: "reject"}
    rec = spark.createDataFrame([(zh, th, "zh-CN", "th"), (zh, zh, "zh-CN", "th"), ("", None, "zh-CN", "xx"), (zh, "abc " * 100, "zh-CN", "en")], "s string, t string, a string, b string")
    primary = [r[0] for r in rec.select(gates.primary_reason(gates.sft_reasons("s", "t", "a", "b"), gates.SFT_PRIORITY)).collect()]
    assert primary == [None, "source_equals_target", "empty_source", "severe_target_repetition"]


def test_domains(spark):
    data = spark.createDataFrame(
        [(1, "学校 教师", "schools"), (2, "", "The trade unions met"), (3, "工会", "trade union and banks of the river"), (4, "", "market trade"), (5, None, None), (6, "软件", "")], "i int, zh string, en string"
    )
    got = {r["i"]: r for r in data.select("i", domains.domain_score("zh", "en", "education").alias("e"), domains.domain_score("zh", "en", "finance").alias("f"), domains.domain_score("zh", "en", "technology").alias("t")).collect()}
    assert got[1]["e"]["score"] == 6 and got[1]["e"]["eligible"]
    assert got[2]["f"]["excluded"] == ["trade_union_only"] and got[2]["f"]["score"] == 0
    assert got[3]["f"]["excluded"] == ["geographical_bank_only", "trade_union_only"]
    assert got[4]["f"]["score"] == 2 and got[4]["f"]["eligible"] and not got[5]["f"]["eligible"] and got[6]["t"]["score"] == 3
    assert data.select(domains.best_label(["a", "b"], [F.lit(0), F.lit(0)]).alias("l")).first()["l"] == "a"


def _pack(units, n, least, most):
    chunks, cur = [], []
    for u in units:
        if cur and sum(map(n, cur)) >= least and sum(map(n, cur)) + n(u) > most:
            chunks.append(cur)
            cur = []
        cur = [*cur, u]
    if cur:
        if sum(map(n, cur)) >= least:
            chunks.append(cur)
        elif chunks and sum(map(n, chunks[-1])) + sum(map(n, cur)) <= 1.25 * most:
            chunks[-1] += cur
    return [" ".join(c) for c in chunks if sum(map(n, c)) >= least]


def test_pack_units(spark):
    rng = random.Random(6)
    cases = [[" ".join(["w"] * rng.randrange(1, 9)) for _ in range(rng.randrange(0, 14))] for _ in range(40)]
    data = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, u array<string>")
    got = {r["i"]: r["c"] for r in data.select("i", ordered.pack_units(F.col("u"), scripts.english_words, 6, 10).alias("c")).collect()}
    assert [got[i] for i in range(40)] == [_pack(c, lambda u: len(u.split()), 6, 10) for c in cases]


def test_islands_and_blocks(spark):
    lines = [(1, "a", True), (2, "a", True), (3, "a", False), (4, "a", True), (6, "a", True), (7, "b", True), (8, None, True), (9, "b", True)]
    data = spark.createDataFrame([("f", *x) for x in lines], "file string, line int, doc string, ok boolean")
    runs = ordered.document_islands(data, "file", "line", "doc")
    assert [r["island"] for r in runs.orderBy("line").collect()] == [1, 1, 1, 1, 1, 2, 3, 4]
    runs = ordered.contiguous_islands(data, "file", "line", "line", F.col("ok"))
    assert [r["island"] for r in runs.orderBy("line").collect()] == [1, 1, 2, 3, 4, 4, 4, 4]
    sizes = spark.createDataFrame([("f", i, h, w) for i, (h, w) in enumerate([(50, 10), (60, 25), (300, 5), (40, 40), (90, 9)])], "g string, line int, han int, words int")
    blocks = ordered.greedy_blocks(sizes, ["g"], "line", ["han", "words"], [100, 30], [220, 180])
    assert rows_of(blocks, "first_row", "last_row", "outcome") == [(0, 1, "accepted"), (2, 2, "too_long"), (3, 4, "accepted")]
    assert ordered.greedy_blocks(sizes.limit(0), ["g"], "line", ["han", "words"], [1, 1], [2, 2]).count() == 0


def test_blocks_and_intervals_cross_round_line_numbers(spark, tmp_path):
    zh, en = "银行宣布今年将为公众降低贷款利率，学校也将为学生开设新的课程，工程师正在测试新的软件系统。", "The bank announced that it would lower interest rates on loans this year, and the school will offer new courses for students."
    rows = [(f"r{line}", "d", ("f", line, line), zh, en) for line in (9_998, 9_999, 10_000, 10_001, 10_002)]
    rows += [("x", "d", ("g", 10_003, 10_003), zh, en), ("y", "e", ("f", 10_003, 10_003), None, en), ("z", None, ("f", 10_005, 10_005), zh, en)]
    pool = spark.createDataFrame(rows, "pool_record_id string, document_id string, provenance struct<source_file:string,start_line:long,end_line:long>, zh_text string, en_text string")
    pool.write.parquet(str(tmp_path / "zh_en_pool.parquet"))
    blocks = table_queries.greedy_blocks(spark, str(tmp_path))
    assert set(rows_of(blocks, "f", "first_row", "last_row", "n_rows", "outcome")) == {
        ("f", 9_998, 10_000, 3, "accepted"), ("f", 10_001, 10_002, 2, "incomplete"), ("f", 10_003, 10_003, 1, "incomplete"), ("f", 10_005, 10_005, 1, "incomplete"), ("g", 10_003, 10_003, 1, "incomplete"),
    }
    got = rows_of(table_queries.anchored_intervals(spark, str(tmp_path)), "f", "anchor_line", "start_line", "end_line")
    assert any(f == "f" and start < 10_000 <= end for f, _, start, end in got) and all(end <= 10_002 for f, _, _, end in got if f == "f")


def test_anchored_intervals(spark):
    lines = [(1, False, False, 60, 12), (2, True, False, 70, 12), (3, False, False, 60, 12), (4, True, False, 120, 5), (5, False, True, 90, 9), (9, True, False, 300, 30)]
    data = spark.createDataFrame([("d", *x) for x in lines], "d string, line int, anchor boolean, bad boolean, han int, words int")
    got = ordered.anchored_intervals(data, ["d"], "line", "anchor", "bad", "han", "words")
    assert rows_of(got, "anchor_line", "start_line", "end_line", "outcome") == [(2, 1, 2, "accepted"), (4, 3, 4, "english_words_below_minimum"), (9, 9, 9, "zh_chars_over_maximum")]


def test_order_and_selection(spark):
    data = spark.createDataFrame([("x", i, i % 3) for i in range(9)] + [("y", i, i) for i in range(4)], "g string, v int, c int")
    positions = ordered.round_robin(data, "g", [F.col("v")])
    assert [(r["g"], r["v"]) for r in positions.orderBy("position").collect()][:5] == [("x", 0), ("y", 0), ("x", 1), ("y", 1), ("x", 2)]
    assert sorted(r["position"] for r in positions.collect()) == list(range(1, 14))
    assert ordered.running_cut(data, "v", [F.col("v")], 6, "g").count() == 8
    assert select.largest_remainder(20_000, [1, 1, 1]) == [6667, 6667, 6666] and select.largest_remainder(5, [0, 0]) == [0, 0] and sum(select.largest_remainder(7, [3, 0, 5.5])) == 7
    assert sorted(select.twister_order(50, 3)) == list(range(50)) and select.twister_order(9, 1) == select.twister_order(9, 1)
    assert select.hash_sample(data, "s", "v", 2, "g").count() == 4
    picked, missing = select.disjoint_quotas(spark.createDataFrame([("k1", "a"), ("k1", "b"), ("k2", "b"), ("k3", "b")], "key string, domain string"), "key", "domain", {"a": 2, "b": 2}, "s")
    assert missing == {"a": 1, "b": 0} and picked.groupBy("key").count().filter("count > 1").count() == 0
    split = select.group_split(spark.createDataFrame([(i, i // 2, "s") for i in range(200)] + [(999, None, "s")], "i int, g int, s string"), "g", "s", "x")
    assert split.count() == 201 and split.groupBy("g").agg(F.count_distinct("assigned_split").alias("n")).filter("n > 1").count() == 0


def test_least_hashed(spark):
    data = spark.createDataFrame([(str(i % 500),) for i in range(2000)] + [(None,)], "h string")
    want = [r["h"] for r in data.filter("h is not null").distinct().orderBy(F.xxhash64("h")).limit(20).collect()]
    assert [r["value"] for r in select.least_hashed(data, "h", 20).collect()] == want
    assert select.least_hashed(data, "h", 9999).count() == 500 and select.least_hashed(data.limit(0), "h", 5).count() == 0


def test_surrogate_ids(spark):
    data = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    ids = joins.surrogate_ids(data, "r_", [F.col("v")], width=5)
    assert [(r["v"], r["record_id"]) for r in ids.orderBy("v").limit(2).collect()] == [(0, "r_00001"), (1, "r_00002")]
    assert ids.select("record_id").distinct().count() == 1000


def test_percentiles_and_checks(spark):
    data = spark.createDataFrame([(v,) for v in [5, 1, 4, 2, 3, 3, None]], "v int")
    assert aggregate.nearest_rank(data, "v", {"p50": 0.5, "p95": 0.95}).first().asDict() == {"n": 6, "p50": 3, "p95": 5}
    assert aggregate.nearest_rank(data, "v", {"p50": 0.5, "p99": 0.99}, rounding="floor").first().asDict() == {"n": 6, "p50": 3, "p99": 5}
    out = aggregate.checks(data, positive=F.col("v") > 0, small=F.col("v") < 9).first()
    assert not out["positive"] and not out["passed"]
    assert aggregate.checks(data.limit(0), positive=F.col("v") > 0).first()["passed"]
    a, b = aggregate.fingerprint(data, "v", "v").first(), aggregate.fingerprint(data.orderBy(F.desc("v")), "v", "v").first()
    assert a == b


def test_joins(spark):
    lines = [spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "line_no int, value string") for vs in (["a", "b", "c"], ["x", "y"])]
    got = rows_of(joins.align_lines(lines, names=["l", "r"]), "line_no", "l", "r", "is_complete")
    assert got == [(0, "a", "x", True), (1, "b", "y", True), (2, "c", None, False)]
    batches = spark.createDataFrame([("1", "ok"), ("1", "bad"), ("2", "ok"), (None, "bad")], "b string, t string")
    sound, moved = joins.contaminated_batches(batches, "b", F.col("t") == "bad")
    assert moved.count() == 2 and sound.count() == 2
    assert joins.overlap(batches, batches, "b").count() == 3
    view = joins.view_on_base(spark.createDataFrame([("a",), ("a",), ("z",)], "k string"), spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), "k")
    assert (view["found"].count(), view["missing"].count(), view["repeated"].count()) == (1, 1, 1)


def test_occurrence_reasons(spark):
    data = spark.createDataFrame([(1, "c", "p", "s", "t"), (2, "d", "q", "s", "u"), (3, "c", "p", "s", "t"), (4, "e", None, None, "t")], "i int, c string, p string, s string, t string")
    got = {r["i"]: r["duplicate_reasons"] for r in dedup.occurrence_reasons(data, "i", "c", "p", "s", "t").collect()}
    assert got[1] == [] and got[2] == ["duplicate_source", "one_source_multiple_targets"] and got[3] == ["duplicate_candidate_id", "duplicate_pair", "duplicate_source", "duplicate_target"]
