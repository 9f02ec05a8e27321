"""Splits that keep related records together: components, then grouped iterative stratification."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.functions.text import trim_space
from paralode.llm.graph import connected_components
from paralode.session import cut

SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def group_key(c: Column) -> Column:
    """A pair group id without case, surrounding space and the prefix ``pair_``; blank is null."""
    bare = F.regexp_replace(F.lower(trim_space(c)), "^pair_", "")
    return F.when(bare != "", bare)


def _node(kind: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.unhex(F.md5(F.concat(F.lit(kind + "\u001f"), c))))


def related_records(df: DataFrame, id_col: str = "record_id", group_col: str = "pair_group_id", origin_col: str = "original_id") -> DataFrame:
    """(record_id, component) plus every input column that the split needs.

    Records are related through an equal group key or an equal origin, over any
    number of steps. The graph has the keys as nodes, not the records, so a key
    shared by a third of all rows is a single node. A record without either key
    is its own component.
    """
    group = _node("g", group_key(F.col(f"`{group_col}`").cast("string")))
    origin = F.col(f"`{origin_col}`").cast("string")
    origin = _node("o", F.when(origin != "", origin))
    rows = df.select(
        F.col(f"`{id_col}`").alias("record_id"),
        F.col("direction"),
        F.col("split"),
        group.alias("u"),
        origin.alias("v"),
    )
    labels = connected_components(rows.select("u", "v"))
    alone = _node("r", F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    rows = rows.withColumn("node", F.coalesce("u", "v", alone)).drop("u", "v")
    return rows.join(labels, "node", "left").select("record_id", "direction", "split", F.coalesce("component", "node").alias("component"))


def stratify(sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place groups (rows of label counts) into splits; ``wanted`` is splits x labels of outstanding rows.

    Iterative stratification for groups: take the label with the fewest
    outstanding rows, place its groups from the largest on, each where that label
    is wanted most, ties by the total wanted and then by the order of the splits.
    """
    n, n_labels = sizes.shape
    wanted = wanted.astype(float).copy()
    placed = np.full(n, -1)
    open_rows = sizes.sum(axis=0).astype(float)
    totals = sizes.sum(axis=1)
    orders = [np.lexsort((np.arange(n), -totals, -sizes[:, k])) for k in range(n_labels)]
    while True:
        live = np.flatnonzero(open_rows > 0)
        if not len(live):
            break
        k = live[np.argmin(open_rows[live])]
        for i in orders[k]:
            if sizes[i, k] == 0:
                break
            if placed[i] >= 0:
                continue
            best = max(range(len(wanted)), key=lambda s: (wanted[s, k], wanted[s].sum(), -s))
            placed[i] = best
            wanted[best] -= sizes[i]
            open_rows -= sizes[i]
        open_rows[k] = 0
    placed[placed < 0] = 0
    return placed


def stratified_groups(rows: DataFrame, splits: Sequence[tuple[str, float]] = SPLITS, giant_share: float = 0.0005, block_rows: int = 20_000) -> DataFrame:
    """Give every component one split; (component, new_split).

    Components of at least ``giant_share`` of all rows, at most 1 / giant_share
    in number, are placed first on the driver. The others are hashed into blocks
    of about ``block_rows`` components that each meet the shares that are left,
    so no task grows with the data.
    """
    spark = rows.sparkSession
    names = [name for name, _ in splits]
    shares = np.array([share for _, share in splits])
    labelled = rows.groupBy("component", F.coalesce("direction", F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    groups = cut(labelled.groupBy("component").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("labels")))
    totals = {r["label"]: r["n"] for r in groups.select(F.explode("labels").alias("label", "n")).groupBy("label").agg(F.sum("n").alias("n")).collect()}
    n_rows = sum(totals.values())
    labels = sorted(totals)
    n_groups = groups.count()
    least = giant_share * n_rows

    def vectors(maps: Sequence[dict]) -> np.ndarray:
        return np.array([[dict(m).get(k, 0) for k in labels] for m in maps]).reshape(len(maps), len(labels))

    wanted = shares[:, None] * np.array([totals[k] for k in labels], dtype=float)[None, :]
    giants = groups.filter(F.col("size") >= least).orderBy("component").select("component", "labels").collect()
    where = np.zeros(0, dtype=int)
    if giants:
        counts = vectors([g["labels"] for g in giants])
        where = stratify(counts, wanted)
        for s in range(len(names)):
            wanted[s] -= counts[where == s].sum(axis=0)
    left = np.maximum(wanted, 0)
    left = left / np.where(left.sum(axis=0) > 0, left.sum(axis=0), 1)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("component").reset_index(drop=True)
        counts = vectors(pdf["labels"].tolist())
        goal = left * counts.sum(axis=0)[None, :]
        where = stratify(counts, goal)
        return pd.DataFrame({"component": pdf["component"], "new_split": [names[s] for s in where]})

    blocks = max(1, -(-n_groups // block_rows))
    rest = groups.filter(F.col("size") < least) if giants else groups
    placed = (
        rest.select("component", "labels", F.pmod(F.xxhash64("component"), F.lit(blocks)).alias("block"))
        .groupBy("block")
        .applyInPandas(place, "component binary, new_split string")
    )
    if giants:
        fixed = spark.createDataFrame([(bytes(g["component"]), names[s]) for g, s in zip(giants, where)], "component binary, new_split string")
        placed = placed.union(fixed)
    return placed


def grouped_splits(df: DataFrame, splits: Sequence[tuple[str, float]] = SPLITS, **columns: str) -> DataFrame:
    """One row per record: record_id, component, direction, delivered split, new_split, is_torn.

    ``is_torn`` names the records (also those without a split) of a set of
    related records whose delivered splits differ. Null keys relate nothing, a
    null direction is a label of its own, repeated rows count as often as they
    come, extra columns are ignored and an empty table gives an empty result.
    """
    rows = cut(related_records(df, **columns))
    torn = rows.groupBy("component").agg((F.min("split") != F.max("split")).alias("torn"))
    placed = stratified_groups(rows, splits)
    return (
        rows.join(torn, "component")
        .join(placed, "component")
        .select("record_id", F.hex("component").alias("component"), "direction", "split", "new_split", F.coalesce("torn", F.lit(False)).alias("is_torn"))
    )
