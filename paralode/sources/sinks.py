"""Writers: all or nothing, several views at once, and checks of what was written."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def refuse_overwrite(spark: SparkSession, *paths: str) -> None:
    """An error if one of the outputs is there already."""
    there = [p for p in paths if exists(spark, p)]
    if there:
        raise FileExistsError(", ".join(there))


def write_atomic(outputs: dict[str, DataFrame], root: str, fmt: str = "parquet", overwrite: bool = False, **options: str) -> None:
    """Write several tables below a root so that all of them appear or none: staged beside it, then renamed."""
    spark = next(iter(outputs.values())).sparkSession
    if not overwrite:
        refuse_overwrite(spark, root)
    stage = f"{root.rstrip('/')}.stage-{uuid.uuid4().hex[:12]}"
    fs, p_stage = _fs(spark, stage)
    try:
        for name, df in outputs.items():
            df.write.options(**options).format(fmt).save(f"{stage}/{name}")
        _, p_root = _fs(spark, root)
        _, p_old = _fs(spark, f"{stage}.old")
        # The old output is moved aside and deleted only when the new one stands in its place.
        replaced = fs.exists(p_root)
        if replaced and not fs.rename(p_root, p_old):
            raise OSError(f"could not move {root} aside")
        if not fs.rename(p_stage, p_root):
            if replaced:
                fs.rename(p_old, p_root)
            raise OSError(f"could not move {stage} to {root}")
        if replaced:
            fs.delete(p_old, True)
    finally:
        if fs.exists(p_stage):
            fs.delete(p_stage, True)


def write_views(df: DataFrame, root: str, views: dict[str, Column], fmt: str = "parquet") -> None:
    """Filtered views of one table, committed together."""
    write_atomic({name: df.filter(test) for name, test in views.items()}, root, fmt)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], bom: bool = False) -> None:
    """Delivered CSV: exactly these columns in order, quotes doubled, LF; extra columns are an error.

    The byte order mark, where asked for, is part of the first column's header.
    """
    extra = [c for c in df.columns if c not in columns]
    if extra:
        raise ValueError(f"extra columns: {', '.join(extra)}")
    out = df.select([F.col(c).alias("﻿" + c if bom and i == 0 else c) for i, c in enumerate(columns)])
    out.write.option("header", True).option("escape", '"').option("lineSep", "\n").csv(path)


def written_differs(df: DataFrame, spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows of the table or of what was written that the other lacks, repeated rows counted; empty when equal."""
    back = spark.read.format(fmt).load(path).select(df.columns)
    return df.exceptAll(back).withColumn("side", F.lit("expected")).unionByName(back.exceptAll(df).withColumn("side", F.lit("written")))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and length of each file, to see that inputs stayed as they were."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def review_sheet(df: DataFrame, fields: Sequence[str], editable: Sequence[str]) -> DataFrame:
    """Rows for review as JSON, with the fields that may be edited."""
    return df.select(F.to_json(F.struct(*fields)).alias("record"), F.array(*[F.lit(e) for e in editable]).alias("editable_fields"))
