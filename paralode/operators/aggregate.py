"""Counters, summaries, percentiles and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counter(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key; null is a key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def explode_counter(df: DataFrame, array: str, *keys: str, name: str = "value") -> DataFrame:
    """Rows per element of an array column; empty arrays count for nothing."""
    return df.select(*keys, F.explode(array).alias(name)).groupBy(*keys, name).agg(F.count("*").alias("n"))


def length_summary(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Least, largest, mean to three digits and median per key; without rows of a key there is none."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 3).alias("mean"), F.median(value).alias("median")
    )


def nearest_rank(df: DataFrame, value: str, fractions: dict[str, float], *keys: str, rounding: str = "half_even") -> DataFrame:
    """Percentiles by rank in the sorted values: rank round((n - 1) * f) half to even, or floor(n * f) capped.

    Exact at any size: values are counted first, so what is ranked are distinct
    values with running totals, never a collected list of all rows.
    """
    from pyspark.sql import Window

    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys).orderBy(value) if keys else Window.partitionBy(F.lit(1)).orderBy(value)
    all_ = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    ranked = counts.withColumns({"upto": F.sum("c").over(w), "total": F.sum("c").over(all_)})
    out = []
    for name, f in fractions.items():
        rank = F.bround((F.col("total") - 1) * F.lit(f)) if rounding == "half_even" else F.least(F.floor(F.col("total") * F.lit(f)), F.col("total") - 1)
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank)
        out.append(F.max(F.when(hit, F.col(value))).alias(name))
    return ranked.groupBy(*keys).agg(F.max("total").alias("n"), *out)


def threshold_counts(df: DataFrame, value: str, thresholds: Sequence[float], *keys: str, strict: bool = False) -> DataFrame:
    """Rows at or above (or, strict, above) each threshold."""
    test = lambda t: F.col(value) > t if strict else F.col(value) >= t
    name = lambda t: "ge_" + str(t).replace(".", "_") if not strict else "gt_" + str(t).replace(".", "_")
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.count_if(test(t)).alias(name(t)) for t in thresholds])


def gap_report(counts: DataFrame, target: int, n: str = "n") -> DataFrame:
    """How much each count lacks of, or has beyond, a target."""
    return counts.withColumns({"missing": F.greatest(F.lit(0), F.lit(target) - F.col(n)), "surplus": F.greatest(F.lit(0), F.col(n) - F.lit(target))})


def accept_rate(df: DataFrame, accepted: Column, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(accepted).alias("n_accepted"), F.round(F.count_if(accepted) / F.greatest(F.count("*"), F.lit(1)), 6).alias("accept_rate"))


def composition(df: DataFrame, key: str, value: str, separator: str = "+", name: str = "composition") -> DataFrame:
    """Sorted distinct values of each key joined to one string; bounded by the number of values."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), separator).alias(name))


def macro_average(df: DataFrame, metric: str, within: str, *keys: str) -> DataFrame:
    """Mean of the means of ``within``; a null metric of one group makes the whole null."""
    per = df.groupBy(*keys, within).agg(F.avg(metric).alias("m"))
    return per.groupBy(*keys).agg(F.round(F.when(F.count_if(F.col("m").isNull()) == 0, F.avg("m")), 6).alias("macro"), F.count("*").alias("n_groups"))


def series_summary(df: DataFrame, step: str, value: str, *keys: str) -> DataFrame:
    """First, last and least value of a series and the earliest step of the least one."""
    there = df.filter(F.col(value).isNotNull())
    return there.groupBy(*keys).agg(
        F.min_by(value, step).alias("first"), F.max_by(value, step).alias("last"), F.min(value).alias("least"), F.min(F.struct(value, step)).getField(step).alias("least_step"), F.count("*").alias("n")
    )


def checks(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: whether each condition holds for all rows, and whether all hold. An empty table passes."""
    each = [F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True)).alias(n) for n, c in conditions.items()]
    out = df.agg(*each)
    every = F.lit(True)
    for n in conditions:
        every = every & F.col(n)
    return out.withColumn("passed", every)


def fingerprint(df: DataFrame, key: str, text: str) -> DataFrame:
    """A hash of a table that does not depend on the order of its rows: (rows, sum and xor of 64-bit row hashes)."""
    h = F.xxhash64(F.col(key), F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"))


def review_quota(df: DataFrame, reviewed: Column, *keys: str, share: float = 0.1) -> DataFrame:
    """Rows reviewed and rows that must be, a share of each group rounded up."""
    need = F.ceil(F.count("*") * F.lit(share))
    return df.groupBy(*keys).agg(F.count("*").alias("n_ready"), F.count_if(reviewed).alias("n_reviewed"), need.alias("n_required"), (F.count_if(reviewed) >= need).alias("met"))


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """Named small tables as rows (section, content), each row of theirs as JSON with its fields in order."""
    parts = [df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("content")) for name, df in sections.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
