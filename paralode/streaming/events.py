"""Append-only event logs as streams: resume, micro-batches, compaction, repair."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paralode.operators.dedup import last_per_key


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """JSON-lines chunks as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there in micro-batches and stop; a batch is done once, also after a restart with the same checkpoint."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def save_chunks(root: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A batch writer that puts batch n into its own folder, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{root}/chunk_{n:06d}")

    return write


def split_batches(accepted: str, rejected: str, test) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends accepted and rejected rows to their own folders."""

    def write(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            batch.filter(test).write.mode("overwrite").parquet(f"{accepted}/batch={n}")
            batch.filter(~test | test.isNull()).write.mode("overwrite").parquet(f"{rejected}/batch={n}")
        finally:
            batch.unpersist()

    return write


def pending(records: DataFrame, events: DataFrame, key: str, order: Sequence[str], retry_failed: bool = False) -> DataFrame:
    """Records still to do: those without an event, and, if asked, those whose last event failed."""
    latest = last_per_key(events, [key], order)
    done = latest.filter("status = 'success'") if retry_failed else latest
    return records.join(done.select(key), key, "left_anti")


def compact(records: DataFrame, events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last event of each record that the input still has."""
    return last_per_key(events, [key], order).join(records.select(key).distinct(), key, "left_semi")


def duplicate_ids(events: DataFrame, key: str) -> DataFrame:
    """Keys that a log which may hold each once holds more often."""
    return events.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def once_each(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """A stream without repeated keys within the delay; the state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def drop_torn_tail(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, torn lines) of a log read by line: only the last line of a file may be torn, any other is an error in ``torn`` with ``is_tail`` false."""
    parsed = lines.withColumn("r", F.from_json("value", schema)).withColumn("bad", F.try_parse_json("value").isNull() & (F.trim("value") != ""))
    last = lines.groupBy("file").agg(F.max("line_no").alias("__last"))
    torn = parsed.filter("bad").join(last, "file").select("file", "line_no", "value", (F.col("line_no") == F.col("__last")).alias("is_tail"))
    return parsed.filter("not bad and trim(value) <> ''").select("file", "line_no", "r.*"), torn


def apply_resilient(df: DataFrame, key: str, text: str, translate: Callable[[list[str]], list[str]], batch_size: int = 50) -> DataFrame:
    """Run a batch function over texts; a batch that fails is tried record by record.

    Gives (key, output, status, error). A batch whose answer has another length
    counts as failed. The function is injected; none is part of this library.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(texts: list[str]) -> list[tuple[str | None, str, str | None]]:
            try:
                answers = translate(texts)
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers to {len(texts)} texts")
                return [(a, "success", None) for a in answers]
            except Exception as e:  # the injected function may fail in any way
                if len(texts) == 1:
                    return [(None, "failed", f"{type(e).__name__}: {e}")]
                return [one([t])[0] for t in texts]

        for pdf in batches:
            texts, out = pdf["t"].tolist(), []
            for at in range(0, len(texts), batch_size):
                out += one(texts[at : at + batch_size])
            yield pd.DataFrame({"k": pdf["k"], "output": [o[0] for o in out], "status": [o[1] for o in out], "error": [o[2] for o in out]})

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, output string, status string, error string").withColumnRenamed("k", key)


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events per key and tumbling window; late ones within the delay count, state ends with the watermark."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), key, "n")
