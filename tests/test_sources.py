"""Readers, writers and streams on files of their own."""

import bz2
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paralode.operators import ordered
from paralode.sources import readers, sinks
from paralode.streaming import events

RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])


def write(path, content, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode) as f:
        f.write(content)
    return str(path)


def test_documents_and_lines(spark, tmp_path):
    write(tmp_path / "d/a.json", json.dumps({"domain": "x", "records": [{"id": "1", "text": "a"}, {"id": "2", "text": None}]}))
    write(tmp_path / "d/b.json", json.dumps([{"id": "3", "text": "c"}]))
    rows = readers.read_documents(spark, str(tmp_path / "d"), RECORD)
    assert {(r["id"], r["text"]) for r in rows.collect()} == {("1", "a"), ("2", None), ("3", "c")}
    path = write(tmp_path / "l.jsonl", '{"id":"1","text":"a"}\n\nnot json\n[1]\n{"id":"2"}\n')
    outcomes = {r["outcome"] for r in readers.line_errors(spark, path, RECORD, ["id", "text"]).collect()}
    assert outcomes == {"ok", "blank_line", "invalid_json", "not_an_object", "missing_text"}
    assert sum(r["_corrupt_record"] is not None for r in readers.read_json_lines(spark, path, RECORD, strict=False).collect()) == 2
    with pytest.raises(Exception):
        readers.read_json_lines(spark, path, RECORD).collect()
    with pytest.raises(ValueError):
        readers.require_columns(rows, ["id", "nothing"])


def test_numbered_lines_over_several_splits(spark, tmp_path):
    path = write(tmp_path / "big.txt", "".join(f"line {i}\n" for i in range(1, 5001)))
    write(tmp_path / "two.txt", "x\ny")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = readers.read_lines(spark, [path, str(tmp_path / "two.txt")]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 5002
    assert all(r["value"] == f"line {r['line_no']}" for r in rows if r["file"].endswith("big.txt"))
    assert {(r["line_no"], r["value"]) for r in rows if r["file"].endswith("two.txt")} == {(1, "x"), (2, "y")}


def test_tables(spark, tmp_path):
    tsv = write(tmp_path / "a.tsv", 'en\tzh\n"quoted\t一\nonly one\na\tb\tc\n')
    assert [(r["line_no"], r["n_columns"], r["en"], r["zh"]) for r in readers.read_tsv(spark, tsv, ["en", "zh"]).orderBy("line_no").collect()] == [(1, 2, "en", "zh"), (2, 2, '"quoted', "一"), (3, 1, "only one", None), (4, 3, "a", "b")]
    path = write(tmp_path / "b.csv", '﻿id,text\n1,"two\nlines, ""q"""\n2,x\n')
    rows = readers.read_csv_rows(spark, path, ["id", "text"]).orderBy("row_no").collect()
    assert [(r["row_no"], r["line_start"], r["line_end"], r["id"], r["text"]) for r in rows] == [(2, 2, 3, "1", 'two\nlines, "q"'), (3, 4, 4, "2", "x")]


def test_wiki_dump_and_archives(spark, tmp_path):
    page = lambda i, ns, extra="": f"<page><title>T{i}</title><ns>{ns}</ns><id>{i}</id>{extra}<revision><id>9{i}</id><text>body {i}</text></revision></page>"
    xml = "<mediawiki>" + page(1, 0) + page(2, 1) + page(3, 0, '<redirect title="T1"/>') + "</mediawiki>"
    path = write(tmp_path / "dump.xml.bz2", bz2.compress(xml.encode()), "wb")
    assert [tuple(r) for r in readers.read_wiki_dump(spark, path).collect()] == [(1, 91, "T1", "body 1")]
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("in/a.txt", "hello")
    assert readers.extract_zip(str(tmp_path / "ok.zip"), str(tmp_path / "out")) == [str(tmp_path / "out/in/a.txt")]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../evil.txt", "x")
    with pytest.raises(ValueError):
        readers.extract_zip(str(tmp_path / "bad.zip"), str(tmp_path / "out"))
    assert readers.latest_numbered(["c-9", "c-10", "x"]) == "c-10" and readers.latest_numbered([]) is None


def test_roles_and_scores(spark, tmp_path):
    write(tmp_path / "r/en.txt", "hello world\n" * 20)
    write(tmp_path / "r/zh.txt", "你好世界\n" * 20)
    roles = readers.detect_roles(spark, str(tmp_path / "r"))
    assert roles["en"].endswith("en.txt") and roles["zh"].endswith("zh.txt")
    for name, content in (("a.csv", "candidate_id,semantic_qe_score\nk,0.5\n"), ("a.jsonl", '{"candidate_id":"k","semantic_qe_score":0.5}\n'), ("a.json", '{"k":0.5}'), ("b.json", '[{"candidate_id":"k","semantic_qe_score":0.5}]')):
        assert [tuple(r) for r in readers.read_scores(spark, write(tmp_path / name, content)).collect()] == [("k", 0.5)]
    with pytest.raises(ValueError):
        readers.read_scores(spark, write(tmp_path / "d.csv", "candidate_id,semantic_qe_score\nk,1\nk,2\n"))


def test_events(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("target_text", T.StringType())])
    line = lambda i, s: json.dumps({"id": i, "status": s, "target_text": "x"}) + "\n"
    write(tmp_path / "log/chunk_000010.jsonl", line("a", "failed"))
    write(tmp_path / "log/chunk_000009.jsonl", line("a", "success") + line("b", "success"))
    log = readers.read_events(spark, str(tmp_path / "log"), schema)
    latest = {r["id"]: r["status"] for r in ordered.latest_event(log, "id", ["chunk_no", "line_no"]).collect()}
    assert latest == {"a": "failed", "b": "success"}
    records = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert {r["id"] for r in events.pending(records, log, "id", ["chunk_no", "line_no"]).collect()} == {"c"}
    assert {r["id"] for r in events.pending(records, log, "id", ["chunk_no", "line_no"], retry_failed=True).collect()} == {"a", "c"}
    assert events.compact(records.filter("id <> 'b'"), log, "id", ["chunk_no", "line_no"]).count() == 1
    assert {r["id"] for r in readers.prior_successes(spark, str(tmp_path / "log/*.jsonl")).collect()} == {"a", "b"}
    for name in ("accepted.jsonl", "rejected.jsonl"):
        write(tmp_path / "log" / name, line("z", "success"))
    assert {r["id"] for r in readers.read_events(spark, str(tmp_path / "log"), schema).collect()} == {"z"}
    torn = write(tmp_path / "torn.jsonl", line("a", "success") + '{"id": "b", "sta')
    good, bad = events.drop_torn_tail(readers.read_lines(spark, torn), schema)
    assert good.count() == 1 and [r["is_tail"] for r in bad.collect()] == [True]
    assert events.duplicate_ids(log, "id").count() == 1


def test_stream_resumes(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    for i in range(3):
        write(tmp_path / f"in/{i}.json", json.dumps({"id": str(i), "n": i}) + "\n")
    run = lambda: events.run_available(events.event_stream(spark, str(tmp_path / "in"), schema, 1), str(tmp_path / "cp"), events.save_chunks(str(tmp_path / "out"))).awaitTermination(60)
    run()
    assert spark.read.parquet(str(tmp_path / "out/*")).count() == 3
    write(tmp_path / "in/3.json", json.dumps({"id": "3", "n": 3}) + "\n")
    run()
    assert spark.read.parquet(str(tmp_path / "out/*")).count() == 4 and len(os.listdir(tmp_path / "out")) == 4


def test_resilient_batches(spark):
    def upper(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return [t.upper() for t in texts]

    data = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id int, t string").coalesce(1)
    got = {r["id"]: (r["output"], r["status"]) for r in events.apply_resilient(data, "id", "t", upper).collect()}
    assert got == {1: ("A", "success"), 2: (None, "failed"), 3: ("C", "success")}


def test_sinks(spark, tmp_path):
    data = spark.createDataFrame([(1, "a"), (2, 'q"x'), (2, 'q"x')], "id int, t string")
    root = str(tmp_path / "out")
    sinks.write_views(data, root, {"one": F.col("id") == 1, "two": F.col("id") == 2})
    assert spark.read.parquet(root + "/two").count() == 2 and not [p for p in os.listdir(tmp_path) if "stage" in p]
    with pytest.raises(FileExistsError):
        sinks.write_atomic({"x": data}, root)
    assert sinks.written_differs(data.filter("id = 2"), spark, root + "/two").count() == 0
    assert sinks.written_differs(data, spark, root + "/two").count() == 1
    sinks.write_csv(data, str(tmp_path / "csv"), ["id", "t"], bom=True)
    assert readers.read_csv_rows(spark, str(tmp_path / "csv/*.csv"), ["t"]).count() == 3
    with pytest.raises(ValueError):
        sinks.write_csv(data, str(tmp_path / "c2"), ["id"])
    assert sinks.file_hashes(spark, root + "/one/*.parquet").count() >= 1
    assert sinks.review_sheet(data, ["id", "t"], ["t"]).first()["record"] == '{"id":1,"t":"a"}'
