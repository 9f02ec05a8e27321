"""Filling containers of fixed capacity by the sum-of-squares rule."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralode.session import cut

TOKENIZER_DIR = os.environ.get("PARALODE_TOKENIZERS", "/opt/tokenizers")
#: The public pre-tokenisation pattern of byte-level BPE vocabularies.
BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_ENCODINGS: dict = {}


def _encoding(path: str):
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def _shipped(df: DataFrame, path: str) -> str:
    """Send a vocabulary to the executors once and return its name there."""
    context = df.sparkSession.sparkContext
    name = os.path.basename(path)
    if all(os.path.basename(known) != name for known in context.listFiles):
        context.addFile(path)
    return name


def token_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_multi_50k.tiktoken", directory: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, seed): whole texts sized with a public tokenizer; a null text has a null size.

    The vocabulary is read where the driver runs and shipped from there. The seed is a hash of the text, so
    that the packing does not depend on how the table lies in files.
    """
    name = _shipped(df, os.path.join(directory or TOKENIZER_DIR, vocabulary))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(SparkFiles.get(name))
        for pdf in batches:
            sizes = [None if t is None else len(encoding.encode_ordinary(t)) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": pd.array(sizes, dtype="Int64"), "seed": pdf["seed"]})

    source = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(F.xxhash64(F.col(f"`{text_col}`")), F.lit(0)).alias("seed"))
    kind = dict(df.dtypes)[id_col]
    return source.mapInPandas(count, f"doc_id {kind}, n_tokens long, seed long")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item, in order, so that the sum of N(gap)^2 grows least at every step.

    N(g) is the number of open containers with residual gap g. A placement that
    fills a container exactly removes it from the sum. Ties go to the smallest gap.
    """
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, dtype=np.int64)
    where = np.empty(len(sizes), dtype=np.int64)
    made = 0
    for i, s in enumerate(sizes):
        s = int(s)
        best, gap = None, 0
        gaps = np.flatnonzero(n[s:]) + s if s else np.flatnonzero(n)
        if len(gaps):
            after = n[gaps - s] * 2 + 1
            after[gaps == s] = 0
            change = after - 2 * n[gaps] + 1
            if s == 0:
                change = np.zeros_like(change)
            k = int(np.argmin(change))
            best, gap = int(change[k]), int(gaps[k])
        fresh = 2 * int(n[capacity - s]) + 1 if s < capacity else 0
        if best is None or fresh < best:
            bin_, gap = made, capacity
            made += 1
        else:
            bin_ = open_at[gap].pop()
            n[gap] -= 1
        where[i] = bin_
        rest = gap - s
        if rest > 0:
            open_at[rest].append(bin_)
            n[rest] += 1
    return where


def pack(sizes: DataFrame, capacity: int, block_items: int = 40_000) -> DataFrame:
    """Assign every piece of every item to a container: doc_id, piece, offset, piece_tokens, n_tokens, block, container.

    Only an item above the capacity is split, into full pieces and a remainder;
    full pieces take a container each. Items are spread over blocks of about
    ``block_items``, larger ones first within a block; a container never spans
    blocks. Items of size 0 join any container; null sizes (null texts) get no
    container. Repeated rows are packed as often as they come.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    sizes = cut(sizes)
    blocks = max(1, -(-sizes.count() // block_items))
    kind = dict(sizes.dtypes)["doc_id"]
    spread = sizes.withColumn("block", F.pmod(F.xxhash64("doc_id", "seed"), F.lit(blocks)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "seed"], ascending=[False, True, True]).reset_index(drop=True)
        total = pdf["n_tokens"].to_numpy(dtype=np.int64)
        full = np.where(total > capacity, (total - 1) // capacity, 0)
        rest = total - full * capacity
        order = np.argsort(-rest, kind="stable")
        container = np.empty(len(pdf), dtype=np.int64)
        container[order] = sum_of_squares(rest[order], capacity)
        at = container.max() + 1 if len(pdf) else 0
        parts = [pd.DataFrame({"doc_id": pdf["doc_id"], "piece": full, "offset": full * capacity, "piece_tokens": rest, "n_tokens": total, "container": container})]
        big = np.flatnonzero(full)
        if len(big):
            rows = np.repeat(big, full[big])
            piece = np.concatenate([np.arange(full[b]) for b in big])
            parts.append(pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[rows], "piece": piece, "offset": piece * capacity, "piece_tokens": capacity, "n_tokens": total[rows], "container": at + np.arange(len(rows))}))
        return pd.concat(parts).assign(block=int(pdf["block"].iloc[0]))

    schema = f"doc_id {kind}, piece int, offset long, piece_tokens long, n_tokens long, block int, container long"
    packed = spread.filter("n_tokens is not null").groupBy("block").applyInPandas(run, schema)
    none = spread.filter("n_tokens is null").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("offset"), F.lit(None).cast("long").alias("piece_tokens"), "n_tokens", "block", F.lit(None).cast("long").alias("container")
    )
    return packed.unionByName(none)
