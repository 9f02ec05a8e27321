"""Operators whose result follows an order: latest and best rows, islands, packing, running cuts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paralode.session import cut
from paralode.operators.dedup import first_per_key, last_per_key


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the place of each row, from 1, within its keys in the given order; a key may hold any part of the rows.

    Rows are range-partitioned by keys and order, so that a large key lies in
    many tasks; rows count up within their part and are shifted by the rows of
    their key in the parts before. ``order`` should settle every tie.
    """
    by = [*[F.col(f"`{k}`") for k in keys], *order]
    parted = cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()}))
    hidden = [F.col(f"`{k}`").alias(f"__k{j}") for j, k in enumerate(keys)]
    names = [f"__k{j}" for j in range(len(keys))]
    parts = parted.groupBy("__p", *hidden).agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    # One row for each part of a key: a window over the parts of a key, not over its rows.
    w = Window.partitionBy(*names).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))).withColumnRenamed("__p", "__q")
    same = F.col("__p") == F.col("__q")
    for j, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{j}"))
    return parted.join(starts, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__before") + F.col("__i") - F.col("__first") + 1).alias(name))


def latest_event(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last event of each key by chunk and line, not by time stamp."""
    return last_per_key(df, [key], order)


def attempts(df: DataFrame, key: str) -> DataFrame:
    """Number of events of each key."""
    return df.groupBy(key).agg(F.count("*").alias("attempts"))


def best_candidate(df: DataFrame, key: str, rank: Sequence[str], alternative: str | None = None) -> DataFrame:
    """The row of each key that is first by ``rank``; ``alternatives`` counts the others, distinct by a column."""
    best = first_per_key(df, [key], rank)
    others = df.groupBy(F.col(key).alias("__k")).agg((F.count_distinct(alternative) if alternative else F.count("*")).alias("__n"))
    return best.join(others, F.col(key).eqNullSafe(F.col("__k"))).select(*df.columns, (F.col("__n") - 1).alias("alternatives"))


def round_robin(df: DataFrame, group: str, within: Sequence[Column]) -> DataFrame:
    """Adds ``turn``, the place in the group, and ``position``, the place when groups take turns in name order.

    Neither is computed in one partition per group or for all rows.
    """
    turned = ranked(df, [group], within, "turn")
    # In the order of turn and group the position is a rank over all rows.
    return ranked(turned, [], [F.col("turn"), F.col(f"`{group}`")], "position")


def islands(df: DataFrame, file: str, order: str, same: Column, name: str = "island") -> DataFrame:
    """Numbers maximal runs: a row starts a new island where ``same`` is not true against the row before.

    ``same`` may use lag() over ``Window.partitionBy(file).orderBy(order)``. One
    partition per file, as the order is that of the file.
    """
    w = Window.partitionBy(file).orderBy(order)
    return df.withColumn("__new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def document_islands(df: DataFrame, file: str, line: str, document: str) -> DataFrame:
    """Runs of lines of one document; a line without a document breaks the run."""
    w = Window.partitionBy(file).orderBy(line)
    before = F.lag(document).over(w)
    return islands(df, file, line, F.col(document).isNotNull() & (F.col(document) == before))


def contiguous_islands(df: DataFrame, file: str, start: str, end: str, valid: Column, order: str | None = None) -> DataFrame:
    """Runs of valid rows whose lines follow each other without a gap; a rejected row breaks the run.

    ``order`` settles the order where lines may be repeated.
    """
    w = Window.partitionBy(file).orderBy(order or start)
    ok = df.withColumn("__ok", F.coalesce(valid, F.lit(False)))
    same = F.col("__ok") & F.coalesce(F.lag("__ok").over(w), F.lit(False)) & (F.col(start) == F.lag(end).over(w) + 1)
    return islands(ok, file, order or start, same).drop("__ok")


def running_cut(df: DataFrame, cost: str, order: Sequence[Column], budget: float, *keys: str) -> DataFrame:
    """Rows, in order, until their summed cost passes the budget of their key."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(cost).over(w)).filter(F.col("running") <= budget)


def top_n(df: DataFrame, n: int, order: Sequence[Column], *keys: str) -> DataFrame:
    """The first n rows of each key."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def first_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of the whole table: a top-k per partition, then one merge."""
    return df.orderBy(*order).limit(k)


def pack_units(units: Column, measure: Callable[[Column], Column], least: int, most: int, slack: float = 1.25) -> Column:
    """Join units with spaces into chunks: a chunk closes when it has its least and the next unit would pass its most.

    A short last chunk joins the one before if both stay within ``slack`` times
    the most, else it is dropped. Measures add up over units.
    """
    sized = F.transform(units, lambda u: F.struct(u.alias("t"), measure(u).cast("int").alias("n")))
    state = F.struct(F.array().cast("array<struct<t:string,n:int>>").alias("done"), F.lit(None).cast("struct<t:string,n:int>").alias("open"))

    def add(s: Column, u: Column) -> Column:
        joined = F.struct(F.concat_ws(" ", s["open"]["t"], u["t"]).alias("t"), (s["open"]["n"] + u["n"]).alias("n"))
        closes = (s["open"]["n"] >= least) & (s["open"]["n"] + u["n"] > most)
        return (
            F.when(s["open"].isNull(), F.struct(s["done"].alias("done"), u.alias("open")))
            .when(closes, F.struct(F.concat(s["done"], F.array(s["open"])).alias("done"), u.alias("open")))
            .otherwise(F.struct(s["done"].alias("done"), joined.alias("open")))
        )

    def finish(s: Column) -> Column:
        last = F.when(F.size(s["done"]) > 0, F.element_at(s["done"], -1))
        fits = last["n"] + s["open"]["n"] <= slack * most
        merged = F.concat(F.slice(s["done"], F.lit(1), F.greatest(F.size(s["done"]) - 1, F.lit(0))), F.array(F.struct(F.concat_ws(" ", last["t"], s["open"]["t"]).alias("t"), (last["n"] + s["open"]["n"]).alias("n"))))
        chunks = F.when(s["open"].isNull(), s["done"]).when(s["open"]["n"] >= least, F.concat(s["done"], F.array(s["open"]))).when(fits, merged).otherwise(s["done"])
        return F.transform(F.filter(chunks, lambda c: c["n"] >= least), lambda c: c["t"])

    return F.aggregate(sized, state, add, finish)


def greedy_blocks(df: DataFrame, group: Sequence[str], order: str, measures: Sequence[str], least: Sequence[int], most: Sequence[int]) -> DataFrame:
    """Rows of each island gathered into blocks: group, block, first, last, n_rows, the summed measures, outcome.

    A block closes when every measure has its least; a block in which a measure
    passes its most is ``too_long``; what is left at the end is ``incomplete``.
    Islands are runs within one file. Their rows stream in order and the open
    block is carried from batch to batch, so an island may be of any length.
    """
    kinds = dict(df.dtypes)
    names = [*group, "block", "first_row", "last_row", "n_rows", *measures, "outcome"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, block, start, last, n, sums = None, 0, None, None, 0, [0] * len(measures)
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False, name=None):
                at, place, v = tuple(None if pd.isna(x) else x for x in row[: len(group)]), row[len(group)], row[len(group) + 1 :]
                if at != key:
                    if n:
                        rows.append((*key, block, start, last, n, *sums, "incomplete"))
                    key, block, n, sums = at, 0, 0, [0] * len(measures)
                start, last = place if n == 0 else start, place
                n += 1
                sums = [int(s + x) for s, x in zip(sums, v)]
                over = any(s > m for s, m in zip(sums, most))
                if over or all(s >= m for s, m in zip(sums, least)):
                    rows.append((*key, block, start, place, n, *sums, "too_long" if over else "accepted"))
                    block, n, sums = block + 1, 0, [0] * len(measures)
            yield pd.DataFrame(rows, columns=names)
        if n:
            yield pd.DataFrame([(*key, block, start, last, n, *sums, "incomplete")], columns=names)

    schema = ", ".join(f"{g} {kinds[g]}" for g in group) + ", block int, first_row long, last_row long, n_rows int, " + ", ".join(f"{m} long" for m in measures) + ", outcome string"
    rows = df.select(*group, F.col(order).cast("long").alias(order), *measures).repartition(*group).sortWithinPartitions(*group, order)
    return rows.mapInPandas(run, schema).select("block", "first_row", "last_row", "n_rows", *measures, "outcome", *group)


def anchored_intervals(df: DataFrame, group: Sequence[str], line: str, anchor: str, bad: str, zh: str, en: str, window: int = 2, least: int = 100, target: int = 150, most: int = 220, least_words: int = 20) -> DataFrame:
    """For each anchor line of a document the best run of neighbouring lines around it.

    A run spans at most ``window`` unused, sound lines without a gap on either
    side; its Chinese length must lie in bounds and its English have enough
    words. Nearest to the target length wins, then the most centred, the
    shortest, the earliest. Lines of a chosen run are used up. Anchors without
    a run come out with a reason.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(line).reset_index(drop=True)
        at = pdf[line].to_numpy()
        # Sums of any stretch from running totals; ``free`` runs down as lines are used up.
        total = {c: np.append(0, np.cumsum(pdf[c].to_numpy())) for c in (zh, en)}
        free = ~pdf[bad].to_numpy(dtype=bool)
        joined = np.append(np.diff(at) == 1, False)
        rows = []
        for a in np.flatnonzero(pdf[anchor].to_numpy(dtype=bool)):
            if not free[a]:
                continue
            before = joined[max(0, a - window) : a] & free[max(0, a - window) : a]
            after = joined[a : a + window] & np.append(free, False)[a + 1 : a + 1 + window]
            low = a - int(np.cumprod(before[::-1]).sum())
            high = a + int(np.cumprod(after).sum())
            s, e = (grid.ravel() for grid in np.meshgrid(np.arange(low, a + 1), np.arange(a, high + 1), indexing="ij"))
            h, w = total[zh][e + 1] - total[zh][s], total[en][e + 1] - total[en][s]
            fits = np.flatnonzero((h >= least) & (h <= most) & (w >= least_words))
            if len(fits):
                best = fits[np.lexsort((e[fits], s[fits], (e - s)[fits], np.abs(2 * a - s - e)[fits], np.abs(h - target)[fits]))[0]]
                free[s[best] : e[best] + 1] = False
                rows.append((at[a], at[s[best]], at[e[best]], h[best], w[best], "accepted"))
                continue
            h, w = total[zh][high + 1] - total[zh][low], total[en][high + 1] - total[en][low]
            reason = (
                "english_words_below_minimum" if w < least_words
                else "zh_chars_below_minimum_after_context" if h < least
                else "zh_chars_over_maximum" if total[zh][a + 1] - total[zh][a] > most
                else "cannot_fit_complete_sentences_within_maximum"
            )
            rows.append((at[a], at[low], at[high], h, w, reason))
        out = pd.DataFrame(rows, columns=["anchor_line", "start_line", "end_line", "han", "words", "outcome"])
        for g in group:
            out[g] = pdf[g].iloc[0] if len(pdf) else None
        return out

    kinds = dict(df.dtypes)
    schema = "anchor_line long, start_line long, end_line long, han long, words long, outcome string, " + ", ".join(f"{g} {kinds[g]}" for g in group)
    return df.select(*group, F.col(line).cast("long").alias(line), anchor, bad, zh, en).groupBy(*group).applyInPandas(run, schema)


def join_ordered(df: DataFrame, group: Sequence[str], order: str, text: str, separator: str = " ") -> DataFrame:
    """Texts of each block joined in order; blocks are bounded by their operator."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*group).agg(F.array_join(F.transform(listed, lambda x: x["t"]), separator).alias(text))
