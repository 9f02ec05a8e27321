"""Samples with given category shares, drawn by the cube method."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.functions.text import casefold, fold_width, trim_space
from paralode.session import cut

CATEGORY = ("domain", "source_lang", "target_lang")
EPS = 1e-9


def category_value(c: Column) -> Column:
    """A category value without case, surrounding space, width and ``_`` for ``-``; blank is null."""
    v = F.translate(casefold(trim_space(fold_width(c))), "_", "-")
    return F.when(v != "", v)


def _category_key(columns: Sequence[str]) -> Column:
    return F.concat_ws("\u001f", *[F.coalesce(category_value(F.col(f"`{c}`").cast("string")), F.lit("\u0000")) for c in columns])


def flight(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: move ``pi`` at random inside the cube while sum(x * pi) stays as it is.

    ``x`` (units x variables) holds the balancing variables. A window of one
    unit more than there are variables moves at a time; at most as many units as
    variables stay unresolved.
    """
    pi = pi.astype(float).copy()
    p = x.shape[1]
    waiting = list(np.flatnonzero((pi > EPS) & (pi < 1 - EPS))[::-1])
    window: list[int] = []
    while True:
        while waiting and len(window) < p + 1:
            window.append(waiting.pop())
        if not window:
            break
        a = x[window].T
        # Units that share their whole vector with another one need no decomposition.
        direction = None
        seen: dict[bytes, int] = {}
        for j in range(len(window)):
            key = a[:, j].tobytes()
            if key in seen:
                direction = np.zeros(len(window))
                direction[seen[key]], direction[j] = 1.0, -1.0
                break
            seen[key] = j
        if direction is None:
            _, s, vt = np.linalg.svd(a, full_matrices=True)
            rank = int((s > 1e-10).sum())
            if rank >= len(window):
                break
            direction = vt[-1]
        at = pi[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(direction > EPS, (1 - at) / direction, np.where(direction < -EPS, -at / direction, np.inf)).min()
            down = np.where(direction > EPS, at / direction, np.where(direction < -EPS, (at - 1) / direction, np.inf)).min()
        at = at + direction * up if rng.random() < down / (up + down) else at - direction * down
        at[at < EPS] = 0.0
        at[at > 1 - EPS] = 1.0
        pi[window] = at
        window = [i for i in window if 0.0 < pi[i] < 1.0]
    return pi


def landing(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Landing phase: give up balancing variables from the last one on until every unit is resolved."""
    for p in range(x.shape[1] - 1, 0, -1):
        pi = flight(pi, x[:, :p], rng)
    free = (pi > 0) & (pi < 1)
    return np.where(free, (rng.random(len(pi)) < pi).astype(float), pi)


def flight_categories(pi: np.ndarray, k: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase where the balancing variables are the indicators of categories ``k``, without their matrix.

    The vectors of two units of one category are equal, so raising one and
    lowering the other by as much keeps every sum: such a pair is the window, and
    one of the two is resolved each time. At most one unit per category stays
    unresolved.
    """
    pi = pi.astype(float).copy()
    waiting: dict[int, int] = {}
    draws = rng.random(len(pi))
    for i in np.flatnonzero((pi > EPS) & (pi < 1 - EPS)):
        j = waiting.pop(int(k[i]), None)
        if j is None:
            waiting[int(k[i])] = i
            continue
        a, b = pi[i], pi[j]
        up, down = min(1 - a, b), min(a, 1 - b)
        move = up if draws[i] < down / (up + down) else -down
        pi[i], pi[j] = a + move, b - move
        for u in (i, j):
            pi[u] = 0.0 if pi[u] < EPS else 1.0 if pi[u] > 1 - EPS else pi[u]
            if 0 < pi[u] < 1:
                waiting[int(k[u])] = u
    return pi


def landing_categories(pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Landing phase for categories: the category indicators are given up, the size of the sample is kept to the end."""
    pi = flight_categories(pi, np.zeros(len(pi), dtype=int), rng)
    free = (pi > 0) & (pi < 1)
    return np.where(free, (rng.random(len(pi)) < pi).astype(float), pi)


def proportional_sample(
    df: DataFrame,
    targets: DataFrame,
    id_col: str = "id",
    columns: Sequence[str] = CATEGORY,
    order_col: str = "loaded_at",
    seed: int = 7,
    block_rows: int = 20_000,
    fan_in: int = 32,
) -> dict[str, DataFrame]:
    """Sample distinct ids so that each category has its target share.

    ``targets`` has the category columns, target_share, min_rows and
    sample_share. Returns ``sample`` (id and category) and ``report`` (per
    category: available, wanted, sampled, residual, served). The wanted number
    is the larger of target_share * sample_share * N and min_rows; where the
    sample holds all there is of a category and that is fewer, it is not
    ``served``. Each other category gets its wanted number rounded down or up. Rows repeated
    under one id count once, with the category of the latest arrival; ids
    that are null count as one. Rows of no target category are never drawn.

    The flight phase runs in blocks of about ``block_rows`` ids; what stays
    unresolved, at most one unit per balancing variable and block, moves up
    ``fan_in`` blocks at a time until one block lands. ``targets`` is small by
    contract: it is refused above 10,000 rows.
    """
    spark = df.sparkSession
    wanted_rows = targets.select(*columns, "target_share", "min_rows", "sample_share", _category_key(columns).alias("category")).limit(10_001).collect()
    if len(wanted_rows) > 10_000:
        raise ValueError("more than 10,000 target categories")
    goals = {r["category"]: r for r in wanted_rows}
    names = sorted(goals)

    rows = df.select(F.col(f"`{id_col}`").alias("id"), _category_key(columns).alias("category"), F.col(f"`{order_col}`").alias("at"))
    units = cut(rows.groupBy("id").agg(F.max_by("category", F.struct(F.col("at").isNotNull(), "at", "category")).alias("category")))
    counts = {r["category"]: r["n"] for r in units.groupBy("category").agg(F.count("*").alias("n")).join(F.broadcast(spark.createDataFrame([(n,) for n in names], "category string")), "category").collect()} if names else {}
    total = units.count()
    probability, quota = {}, {}
    for name in names:
        g = goals[name]
        quota[name] = max((g["target_share"] or 0.0) * (g["sample_share"] or 0.0) * total, float(g["min_rows"] or 0))
        probability[name] = min(1.0, quota[name] / counts[name]) if counts.get(name) else 0.0

    index = {name: k for k, name in enumerate(names)}
    table = spark.createDataFrame([(n, index[n], probability[n]) for n in names], "category string, k int, pi double")
    blocks = max(1, -(-total // block_rows))
    state = units.join(F.broadcast(table), "category").select("id", "k", "pi", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))

    def fly(last: bool, level: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id", na_position="first").reset_index(drop=True)
            rng = np.random.default_rng([seed, level, int(pdf["block"].iloc[0])])
            pi = flight_categories(pdf["pi"].to_numpy(dtype=float), pdf["k"].to_numpy(), rng)
            if last:
                pi = landing_categories(pi, rng)
            return pdf.assign(pi=pi)

        return run

    schema = state.schema
    done = None
    level = 0
    while True:
        last = blocks == 1
        state = cut(state.groupBy("block").applyInPandas(fly(last, level), schema))
        resolved = state.filter("pi = 0 or pi = 1") if not last else state
        done = resolved if done is None else done.union(resolved)
        if last:
            break
        blocks, level = -(-blocks // fan_in), level + 1
        state = state.filter("pi > 0 and pi < 1").withColumn("block", F.floor(F.col("block") / fan_in))

    drawn = done.filter("pi = 1").select("id", "k")
    shown = spark.createDataFrame(
        [(index[n], *[goals[n][c] for c in columns], int(counts.get(n, 0)), int(goals[n]["min_rows"] or 0), quota[n]) for n in names],
        "k int, " + ", ".join(f"{c} string" for c in columns) + ", available long, min_rows long, wanted double",
    )
    sampled = drawn.groupBy("k").agg(F.count("*").alias("sampled"))
    report = (
        shown.join(F.broadcast(sampled), "k", "left")
        .withColumn("sampled", F.coalesce("sampled", F.lit(0)))
        .withColumn("residual", F.round(F.col("sampled") - F.col("wanted"), 6))
        # What was drawn tells: a category is short where all of it is in the sample and that is less than wanted.
        .withColumn("served", ~((F.col("sampled") == F.col("available")) & (F.col("sampled") < F.col("wanted"))))
        .drop("k")
    )
    return {"sample": drawn.join(F.broadcast(shown.select("k", *columns)), "k").drop("k"), "report": report}
