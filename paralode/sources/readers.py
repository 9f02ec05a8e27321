"""Readers for the formats of the corpus."""

from __future__ import annotations

import csv
import io
import os
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table itself, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_documents(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of JSON files that hold an envelope with ``records`` or a bare array, with their position in the file."""
    envelope = T.StructType([T.StructField("records", T.ArrayType(record)), *[f for f in record.fields if f.name != "records"]])
    raw = spark.read.option("multiLine", True).schema(envelope).json(path).withColumn("source_path", F.input_file_name())
    inside = raw.filter("records is not null").select("source_path", F.posexplode("records").alias("position", "r")).select("source_path", "position", "r.*")
    bare = raw.filter("records is null").select("source_path", F.monotonically_increasing_id().alias("position"), *[f.name for f in record.fields])
    return inside.unionByName(bare)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines. Strict reading fails on the first bad line; otherwise bad lines come out in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def line_errors(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """Lines of a JSON-lines file by outcome: blank_line, invalid_json, not_an_object, missing_<field>, ok."""
    lines = spark.read.text(path).select(F.regexp_replace("value", f"^{BOM}", "").alias("value"))
    parsed = lines.select("value", F.from_json("value", schema).alias("r"), F.try_parse_json("value").alias("v"))
    outcome = F.when(F.trim("value") == "", "blank_line").when(F.col("v").isNull(), "invalid_json").when(~F.schema_of_variant("v").startswith("OBJECT"), "not_an_object")
    for name in required:
        field = F.col(f"r.{name}")
        outcome = outcome.when(field.isNull() | (F.trim(field.cast("string")) == ""), f"missing_{name}")
    return parsed.select("value", "r.*", outcome.otherwise("ok").alias("outcome"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files, numbered from 1 within each file.

    Numbers come from the position of each split in its file: lines are counted
    per split first, so no file is read by a single task.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    counts = raw.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    w = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "start", "first", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return raw.join(F.broadcast(starts), ["file", "start"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "value")


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Tab-separated lines without any quoting; ``n_columns`` tells rows of another width apart."""
    parts = F.split("value", "\t")
    fields = [F.try_element_at(parts, F.lit(i + 1)).alias(c) for i, c in enumerate(columns)]
    return read_lines(spark, path).select("file", "line_no", F.size(parts).alias("n_columns"), *fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Quoted CSV with a header, quotes doubled, line breaks inside fields, an optional byte order mark."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("enforceSchema", False).csv(path)


def read_csv_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Quoted CSV with the physical first and last line of each row (file, row_no, line_start, line_end, columns).

    A quoted file cannot be cut before it is parsed, so a file is one task;
    files are read in parallel.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path_, content in zip(pdf["path"], pdf["content"]):
                reader = csv.reader(io.StringIO(bytes(content).decode("utf-8-sig"), newline=""), strict=True)
                header = next(reader, [])
                places = [header.index(c) for c in columns]
                rows, end = [], reader.line_num
                for i, row in enumerate(reader):
                    rows.append((path_, i + 2, end + 1, reader.line_num, *[row[p] if p < len(row) else None for p in places]))
                    end = reader.line_num
                yield pd.DataFrame(rows, columns=["file", "row_no", "line_start", "line_end", *columns])

    schema = "file string, row_no long, line_start long, line_end long, " + ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, schema)


def read_wiki_dump(spark: SparkSession, path: str) -> DataFrame:
    """Articles of a wiki XML dump, plain or compressed: page_id, revision_id, title, text; main name space, no redirects."""
    schema = "id long, ns int, title string, redirect struct<_title:string>, revision struct<id:long, text:string>"
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreNamespace", True).schema(schema).load(path)
    return pages.filter("ns = 0 and redirect is null").select(F.col("id").alias("page_id"), F.col("revision.id").alias("revision_id"), "title", F.col("revision.text").alias("text"))


def read_events(spark: SparkSession, root: str, schema: T.StructType, consolidated: Sequence[str] = ("accepted.jsonl", "rejected.jsonl"), chunks: str = "chunk_*.jsonl") -> DataFrame:
    """Events of a log with ``chunk_no`` and ``line_no``: the consolidated files if none is older than the newest chunk, else the chunks in numeric order."""
    base = Path(root)
    parts = sorted(base.glob(chunks))
    whole = [base / c for c in consolidated]
    newest = max((p.stat().st_mtime for p in parts), default=0.0)
    use_whole = all(p.exists() for p in whole) and all(p.stat().st_mtime >= newest for p in whole)
    files = whole if use_whole else parts
    if not files:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("chunk_no", T.LongType()), T.StructField("line_no", T.LongType())]))
    lines = read_lines(spark, [str(f) for f in files])
    name = F.element_at(F.split("file", "/"), -1)
    number = F.when(name.rlike("_[0-9]+[.]"), F.regexp_extract(name, "_([0-9]+)[.]", 1).cast("long"))
    for i, c in enumerate(consolidated):
        number = F.when(name == c, F.lit(i).cast("long")).otherwise(number)
    return lines.filter(F.trim("value") != "").select(F.from_json("value", schema).alias("e"), number.alias("chunk_no"), "line_no").select("e.*", "chunk_no", "line_no")


def prior_successes(spark: SparkSession, pattern: str) -> DataFrame:
    """Ids of records with a successful, non-blank target in any of the files of a pattern."""
    rows = spark.read.schema("id string, status string, target_text string").json(pattern)
    return rows.filter("status = 'success' and trim(target_text) <> ''").select("id").distinct()


def read_scores(spark: SparkSession, path: str, key: str = "candidate_id", score: str = "semantic_qe_score") -> DataFrame:
    """Scores from CSV, JSON lines, a JSON object of key to score, or a JSON list; a key given twice is an error."""
    kind = os.path.splitext(path)[1].lower()
    if kind == ".csv":
        rows = spark.read.option("header", True).csv(path).select(key, F.expr(f"try_cast({score} as double)").alias(score))
    elif kind == ".jsonl":
        rows = spark.read.schema(f"{key} string, {score} double").json(path)
    else:
        text = spark.read.option("wholetext", True).text(path)
        listed = F.from_json("value", f"array<struct<{key}:string,{score}:double>>")
        mapped = F.from_json("value", "map<string,double>")
        is_list = F.ltrim("value").startswith("[")
        rows = text.filter(is_list).select(F.inline(listed)).unionByName(text.filter(~is_list).select(F.explode(mapped).alias(key, score)))
    twice = rows.groupBy(key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {twice[0][key]} in {path}")
    return rows


def detect_roles(spark: SparkSession, directory: str, sample: int = 5, margin: float = 0.8) -> dict[str, str]:
    """Which file of a directory is English and which Chinese, by the letters of its first lines; the largest of each kind.

    An error if the runner-up is at least ``margin`` of the size of the largest.
    """
    candidates: dict[str, list[tuple[int, str]]] = {"en": [], "zh": []}
    for path in sorted(Path(directory).iterdir()):
        if not path.is_file():
            continue
        lines = [r.value for r in spark.read.text(str(path)).filter("trim(value) <> ''").limit(sample).collect()]
        text = "".join(lines)
        han = sum("㐀" <= c <= "鿿" for c in text)
        latin = sum(c.isascii() and c.isalpha() for c in text)
        if han + latin:
            candidates["zh" if han / (han + latin) >= 0.3 else "en"].append((path.stat().st_size, str(path)))
    out = {}
    for role, found in candidates.items():
        found.sort(reverse=True)
        if not found:
            raise ValueError(f"no {role} file in {directory}")
        if len(found) > 1 and found[1][0] >= margin * found[0][0]:
            raise ValueError(f"two {role} files of nearly one size: {found[0][1]}, {found[1][1]}")
        out[role] = found[0][1]
    return out


def extract_zip(path: str, target: str) -> list[str]:
    """Members of an archive, extracted below ``target`` unless they are there with the same size; a member that would leave it is refused."""
    root = Path(target).resolve()
    out = []
    with zipfile.ZipFile(path) as z:
        for info in z.infolist():
            place = (root / info.filename).resolve()
            if not place.is_relative_to(root):
                raise ValueError(f"unsafe member {info.filename}")
            if info.is_dir():
                continue
            if not (place.exists() and place.stat().st_size == info.file_size):
                z.extract(info, root)
            out.append(str(place))
    return out


def latest_numbered(paths: Sequence[str], pattern: str = r"(\d+)$") -> str | None:
    """The path with the largest number, compared as a number."""
    import re

    numbered = [(int(m.group(1)), p) for p in paths if (m := re.search(pattern, p))]
    return max(numbered)[1] if numbered else None


def from_records(value: Column, schema: str) -> Column:
    """Records of an envelope or bare array given as a JSON string."""
    listed = F.from_json(value, f"array<{schema}>")
    inside = F.from_json(value, f"struct<records:array<{schema}>>")["records"]
    return F.when(F.ltrim(value).startswith("["), listed).otherwise(inside)
