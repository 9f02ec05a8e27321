"""Operators on single records, batches and ranks against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from paralode.operators import joins, ordered, select, translation
from paralode.sources import sinks


def test_ranks_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]) if rng.random() < 0.6 else "hot", rng.randrange(50), i) for i in range(900)]
    data = spark.createDataFrame(rows, "k string, v int, id int")
    got = {r["id"]: r["rank"] for r in ordered.ranked(data, ["k"], [F.col("v").desc(), F.col("id")]).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        for place, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = place
    assert got == want
    assert [r["rank"] for r in ordered.ranked(data, [], [F.col("id")]).orderBy("id").collect()] == list(range(1, 901))
    assert ordered.ranked(data.limit(0), ["k"], [F.col("id")]).count() == 0


def test_round_robin_and_nulls(spark):
    data = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "g string, id int")
    got = [r["id"] for r in ordered.round_robin(data, "g", [F.col("id")]).orderBy("position").collect()]
    assert got == [4, 1, 3, 2]


def test_reservoir(spark):
    def brute(n, k, seed):
        rng, kept = random.Random(seed), []
        for i in range(1, n + 1):
            if len(kept) < k:
                kept.append(i)
            elif (at := rng.randrange(i)) < k:
                kept[at] = i
        return kept

    for n in (0, 3, 5, 6, 400):
        assert select.reservoir_places(n, 5, 42) == brute(n, 5, 42)
    data = spark.range(1, 401).withColumnRenamed("id", "x")
    got = [r["x"] for r in select.reservoir(data, [F.col("x")], 5, 42).orderBy("slot").collect()]
    assert got == brute(400, 5, 42) and select.reservoir(data.limit(0), [F.col("x")], 5, 1).count() == 0


def test_group_split_keeps_groups_and_strata(spark):
    rows = [(f"g{i}", d) for i in range(60) for d in (["zh->en"], ["zh->en", "en->zh"], ["zh->en", "zh->en"])[i % 3]]
    out = select.group_split(spark.createDataFrame(rows, "g string, direction string"), "g", "direction", "s").collect()
    assert len(out) == len(rows)
    split = {}
    for r in out:
        assert split.setdefault(r["g"], r["assigned_split"]) == r["assigned_split"]
    for kind in range(3):
        names = [split[f"g{i}"] for i in range(kind, 60, 3)]
        assert (names.count("train"), names.count("validation"), names.count("test")) == (18, 1, 1)


def test_alignment_ids(spark):
    lines = ["doc en:1:2 zh:3:4", " doc  zh:1:1 en:2:2 en:2:3 ", "doc en:1:2", "doc en:1 zh:1:1", "", None, "doc en:1:2 zh:3:4 fr:1:1"]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, c string")
    got = {r["i"]: r["a"] for r in data.select("i", joins.alignment_id("c").alias("a")).collect()}
    assert got[0]["sentence_id"] == "en:1:2 zh:3:4" and got[1]["english_references"] == ["en:2:2", "en:2:3"] and got[1]["document_id"] == "doc"
    assert [got[i] for i in range(2, 7)] == [None] * 5


def test_quarantine_moves_whole_batches_once(spark):
    schema = "id int, batch string, text string"
    accepted = spark.createDataFrame([(1, "x", "fine"), (2, "x", "only output the translation"), (3, "y", "fine"), (4, None, "<SEP1>"), (5, "z", None)], schema)
    rejected = spark.createDataFrame([(9, "z", "Separator in the translation")], schema)
    leaks = translation.leaks_prompt("text")
    out = joins.quarantine(accepted, rejected, "batch", "id", leaks, "contaminated", expected=3)
    assert {r["id"] for r in out["kept"].collect()} == {3, 4} and {r["id"] for r in out["moved"].collect()} == {1, 2, 5}
    again = joins.quarantine(out["kept"], out["rejected"].select("id", "batch", "text"), "batch", "id", leaks, "contaminated", expected=3)
    assert again["moved"].count() == 0 and again["rejected"].count() == 4
    with pytest.raises(ValueError):
        joins.quarantine(accepted, rejected, "batch", "id", leaks, "contaminated", expected=2)


def test_scores(spark):
    rows, scores = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, score int"), spark.createDataFrame([("a", 0.9), ("b", 0.2)], "k string, s double")
    assert [r["score_status"] for r in joins.with_scores(rows.select("k"), scores, "k", "s").orderBy("k").collect()] == ["not_evaluated", "evaluated", "evaluated"]
    assert [r["k"] for r in joins.with_scores(rows.select("k"), scores, "k", "s", 0.5).collect()] == ["a"]


@pytest.mark.parametrize(
    "method, origin, dataset, want",
    [("human", "machine_translation", "x", "human"), ("google_mt", None, None, "google_mt"), ("MT", "web", "Tencent-1", "llm_mt"), (None, "Machine_Translation_v2", None, "llm_mt"), ("gpt", "web", "news", "human"), (None, None, "baidu", "llm_mt"), (None, None, None, "human")],
)
def test_translation_methods(spark, method, origin, dataset, want):
    row = spark.createDataFrame([(method, origin, dataset)], "m string, o string, d string")
    assert row.select(translation.translation_method("m", "o", "d").alias("r")).first()["r"] == want


@pytest.mark.parametrize(
    "answer, text, flags",
    [
        ("<think>a\nb</think>\n```thai\nสวัสดี\n```", "สวัสดี", ["removed_thinking_block", "removed_markdown_fence"]),
        ("```\nคำแปล: ก\n```", "ก", ["removed_markdown_fence", "removed_translation_prefix"]),
        ("泰文译文：ข", "ข", ["removed_translation_prefix"]),
        ("```python\nx\n```", "python\nx", ["removed_markdown_fence"]),
        ("```\nx", "```\nx", []),
        ("Translation: x", "Translation: x", []),
        (" a\x00b ", "ab", []),
        (None, "", []),
    ],
)
def test_clean_answers(spark, answer, text, flags):
    row = spark.createDataFrame([(answer,)], "c string").select(translation.clean_output("c").alias("r")).first()["r"]
    assert (row["text"], row["flags"]) == (text, flags)


def test_a_failed_write_keeps_the_old_output(spark, tmp_path):
    root = str(tmp_path / "out")
    sinks.write_atomic({"t": spark.range(3)}, root)
    with pytest.raises(Exception):
        sinks.write_atomic({"t": spark.range(4), "u": spark.range(2).select(F.raise_error(F.lit("broken")).alias("x"))}, root, overwrite=True)
    assert spark.read.parquet(f"{root}/t").count() == 3
    sinks.write_atomic({"t": spark.range(5)}, root, overwrite=True)
    assert spark.read.parquet(f"{root}/t").count() == 5 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out"]
