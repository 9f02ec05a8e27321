"""Translation helpers and whole stages."""

import json

import pytest
from pyspark.sql import functions as F

from paralode.operators import translation as tr
from paralode.plans import pipelines, stage_queries, table_queries
from paralode.streaming import events

ZH = "银行宣布今年将为公众降低贷款利率，学校也将为学生开设新的课程，工程师正在测试新的软件系统。"
EN = "The bank announced that it would lower interest rates on loans this year, and the school will offer new courses for students while engineers test software."


def one(spark, column, *values):
    return spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values)))).select(column.alias("o")).first()["o"]


def test_outputs(spark):
    got = one(spark, tr.clean_output("c0"), "<think>hm</think>\n```thai\n译文：你好\n```")
    assert got["text"] == "你好" and got["flags"] == ["removed_thinking_block", "removed_markdown_fence", "removed_translation_prefix"]
    parts = one(spark, tr.split_answers("c0", F.array(F.lit("a"), F.lit("b"))), "one <SEP> two")
    assert [(p["id"], p["text"]) for p in parts] == [("a", "one"), ("b", "two")]
    assert one(spark, tr.split_answers("c0", F.array(F.lit("a"))), "one<SEP>two") is None
    assert one(spark, tr.output_reason("c0", F.lit("en")), None) == "empty_translation"
    q = one(spark, tr.thai_event_quality("c0", "c1"), "你好", "你好")
    assert q["failure"] == "unchanged_source" and "contains_han_characters" in q["flags"]
    assert [one(spark, tr.as_number("c0"), v) for v in ("1.5", "true", "NaN", "x", None)] == [1.5, None, None, None, None]
    assert one(spark, tr.candidate_reason("c0"), "短") == "chinese_too_short"
    assert one(spark, tr.chunk_reason("c0", F.lit("zh-CN")), "短") == "too_few_han"


def test_tokens(spark):
    a = lambda *x: F.array(*[F.lit(v) for v in x]) if x else F.array().cast("array<int>")
    m = tr.masked_labels(a(1, 2), a(7, 8, 9), 7)
    row = spark.range(1).select(*[c.alias(n) for n, c in m.items()]).first()
    assert row.asDict() == {"input_ids": [1, 2, 7, 8, 9, 0, 0], "attention_mask": [1, 1, 1, 1, 1, 0, 0], "labels": [-100, -100, 7, 8, 9, -100, -100]}
    cases = {(5, 6, 2, 2): (3, False), (5, 6, 7, 8): (4, True), (2,): (1, False), (): (0, False), (5, 6): (2, False)}
    for tokens, want in cases.items():
        assert tuple(spark.range(1).select(tr.completion_tokens(a(*tokens), [2, 3], 4).alias("o")).first()["o"]) == want
    counts = tr.token_counts(spark.createDataFrame([(1, "a b", None)], "i int, s string, t string"), "i", ["s", "t"], lambda texts: [len(t.split()) for t in texts])
    assert tuple(counts.first()) == (1, 2, 0)


def test_metrics(spark):
    rows = [("en", "the cat sat on the mat today", "the cat sat on the mat"), ("en", "a dog ran far away home", "a dog ran far home"), ("th", "สวัสดี", "สวัสดี"), ("x", "abc", None)]
    got = {r["d"]: r for r in tr.corpus_metrics(spark.createDataFrame(rows, "d string, r string, p string"), "r", "p", "d").collect()}
    assert got["en"]["bleu"] == pytest.approx(tr.bleu_of([(r.split(), p.split()) for d, r, p in rows if d == "en"]), abs=1e-3)
    assert got["th"]["bleu"] == pytest.approx(100) and got["th"]["chrf"] == pytest.approx(100) and got["x"]["bleu"] == 0 and got["x"]["chrf"] == 0


def test_pool_accounts_for_every_record(spark):
    zh = ZH * 3
    rows = [("1", zh, EN, "finance", "o", "d1"), ("2", zh, EN.upper(), "technology", "o", "d2"), ("3", None, EN, None, None, None), ("4", zh, "short", "finance", "o", "d1"), ("5", "", "", "x", "o", "d")]
    pool = spark.createDataFrame(rows, "pool_record_id string, zh_text string, en_text string, domain string, data_origin string, dataset_name string")
    out = pipelines.prepare_pool(pool)
    u = out["unique"].collect()
    assert [(r["record_id"], r["n_rows"], len(r["sources"])) for r in u] == [("1", 2, 2)]
    assert {r["record_id"] for r in out["rejected"].collect()} == {"3", "4", "5"}
    assert {(r["domain"]) for r in out["eligible"].collect()} == {"education", "technology", "finance"} and out["soft_review"].count() == 0
    assert out["report"].filter("section = 'unique'").first()["content"] == json.dumps({"pairs": 1, "records": 2}, separators=(",", ":"))
    assert pipelines.prepare_pool(pool.limit(0))["unique"].count() == 0


def test_sft_split_isolates_pairs(spark):
    rows = []
    for i in range(60):
        s, t = f"{ZH}{'一二三四五六七八九十'[i % 10]}{i}", f"{EN} {i}"
        rows += [(f"a{i}", "f", 2 * i, "zh-CN", "en", s, t), (f"b{i}", "f", 2 * i + 1, "en", "zh-CN", t, s)]
    rows += [("dup", "g", 1, "zh-CN", "en", rows[0][5], rows[0][6]), ("bad", "g", 2, "zh-CN", "en", "", None)]
    data = spark.createDataFrame(rows, "record_id string, source_file string, source_row int, source_lang string, target_lang string, source_text string, target_text string")
    out = pipelines.prepare_sft(data)
    accepted = out["accepted"]
    assert accepted.count() == 120 and accepted.groupBy("group").agg(F.count_distinct("assigned_split").alias("n")).filter("n > 1").count() == 0
    assert {r["assigned_split"]: r["count"] for r in accepted.groupBy("assigned_split").count().collect()} == {"train": 108, "validation": 6, "test": 6}
    assert {(r["record_id"], r["primary_reason"]) for r in out["rejected"].collect()} == {("dup", "duplicate_same_direction"), ("bad", "empty_source")}


def test_mono_and_merge(spark):
    th = "ธนาคารประกาศว่าจะลดอัตราดอกเบี้ยให้กับประชาชนในปีนี้"
    pages = spark.createDataFrame([(1, "T", f"'''{th}'''\n\n{th}\n\nEnglish only text here"), (2, "U", None), (3, "V", "")], "page_id long, title string, text string")
    out = pipelines.mono_corpus(pages)
    assert [(r["page_id"], r["paragraph"]) for r in out["accepted"].collect()] == [(1, 0)] and [r["reason"] for r in out["rejected"].collect()] == ["too_few_thai_characters"]
    log = spark.createDataFrame([("k", "p1", 1, "failed", ZH, th, 0), ("k", "p1", 2, "success", ZH, th, 1), ("k", "p2", 1, "success", ZH, th + "x", 0), ("j", "p1", 1, "success", ZH, ZH, 0)], "id string, provider string, line int, status string, zh_text string, th_text string, preference int")
    best = pipelines.merge_best(log, "id", ["line"], ["preference", "provider"]).collect()
    assert [(r["id"], r["provider"], r["alternatives"]) for r in best] == [("k", "p2", 1)]


def test_audit_stage(spark):
    th = "ธนาคารประกาศว่าจะลดอัตราดอกเบี้ยให้กับประชาชนในปีนี้"
    rows = [("1", "c1", ZH, th), ("2", "c1", ZH, th), ("3", "c3", ZH[:20], th + "word"), ("4", None, None, None)]
    out = {r["record_id"]: r for r in pipelines.audit(spark.createDataFrame(rows, "record_id string, candidate_id string, source_text string, target_text string")).collect()}
    assert out["1"]["decision"] == "accept" and "duplicate_pair" in out["2"]["reject_reasons"] and "thai_latin_mixed_token" in out["3"]["reject_reasons"] and "empty_thai" in out["4"]["reject_reasons"]


def test_stages_take_every_direction_and_label(spark, tmp_path):
    th = "ธนาคารประกาศว่าจะลดอัตราดอกเบี้ยให้กับประชาชนในปีนี้"
    final = [("1", "c1", "zh-CN", "th", ZH, th), ("2", "c2", "th", "zh_CN", th, ZH), ("3", "c3", None, None, th * 2, ZH * 2), ("4", "c4", "zh-CN", "en", ZH * 3, EN)]
    spark.createDataFrame(final, "record_id string, candidate_id string, source_lang string, target_lang string, source_text string, target_text string").write.parquet(str(tmp_path / "zh_th_final.parquet"))
    out = {r["record_id"]: r for r in stage_queries.audit(spark, str(tmp_path)).collect()}
    assert set(out) == {"1", "2", "3", "4"} and "duplicate_pair" in out["2"]["reject_reasons"] and out["3"]["decision"] == out["1"]["decision"] == "accept" and out["4"]["decision"] == "reject"
    long = " ".join([EN] * 4)
    docs = [("a", "en", "t", long), ("b", "EN", "t", long), ("c", "en-US", "t", long), ("d", None, "t", long), ("e", "TH", "t", th), ("f", None, "t", th + "ๆ"), ("g", "zh", "t", ZH), ("h", None, "t", None)]
    spark.createDataFrame(docs, "doc_id string, lang string, title string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r["doc_id"] for r in table_queries.packed_chunks(spark, str(tmp_path)).collect()} == {"a", "b", "c", "d"}
    assert {r["page_id"] for r in stage_queries.mono_corpus(spark, str(tmp_path)).collect()} == {"e", "f"}


def test_windowed_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"ts":"2024-01-01T00:10:00","k":"a"}\n{"ts":"2024-01-01T00:50:00","k":"a"}\n{"ts":"2024-01-01T05:00:00","k":"b"}\n')
    stream = events.event_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "ts timestamp, k string").schema)
    query = events.windowed_counts(stream, "ts", "k").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert sorted((r["k"], r["n"]) for r in spark.table("w").collect()) == [("a", 2), ("b", 1)]
