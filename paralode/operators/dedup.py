"""Duplicates by content keys: first wins, lineage kept, ordered greedy over several keys.

"First" is always by explicit order columns. Groups are reduced with
aggregates that combine on the map side; no window over a whole group is used
where one key may hold a large part of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.session import cut


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. Null keys are a key of their own; ties fall to the whole row's content."""
    ordered = [F.struct(F.col(o).isNotNull().alias("there"), F.col(o).alias("v")) if isinstance(o, str) else F.struct(o.alias("v")) for o in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(ordered)], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("tie"))
    # The keys are hidden under positions, so input columns may have any name.
    grouped = df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min_by(packed, ranked).alias("__row"))
    return grouped.select("__row.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    ranked = F.struct(*[F.struct(F.col(f"`{o}`").isNotNull().alias("there"), F.col(f"`{o}`").alias("v")).alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("tie"))
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max_by(packed, ranked).alias("__row")).select("__row.*")


def first_with_lineage(df: DataFrame, key: str, order: Sequence[str], flags: str | None = None, lineage: Column | None = None) -> DataFrame:
    """The first row of each key with the flags of all rows, sorted, the distinct sources and the number of rows.

    The set of sources is bounded by the number of different sources, not of rows.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ranked = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)])
    aggregates = [F.min_by(packed, ranked).alias("__row"), F.count("*").alias("n_rows")]
    rows = df
    if flags:
        # Flags are exploded into a distinct set per row group, never into a list of all rows.
        aggregates.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(f"`{flags}`"))))).alias("all_flags"))
    if lineage is not None:
        aggregates.append(F.array_sort(F.collect_set(lineage)).alias("sources"))
    grouped = rows.groupBy(F.col(f"`{key}`").alias("__key")).agg(*aggregates)
    return grouped.select("__row.*", *[a for a in ("n_rows", "all_flags", "sources") if a in grouped.columns])


def duplicate_statistics(df: DataFrame, key: str, source: str | None = None, domain: str | None = None) -> DataFrame:
    """One row: groups with copies, rows beyond the first, groups over several sources and several domains."""
    aggregates = [F.count("*").alias("n")]
    for name, c in (("s", source), ("d", domain)):
        if c:
            # More than one value is all that counts, so least and largest suffice.
            aggregates.append((F.min(f"`{c}`") != F.max(f"`{c}`")).alias(name))
    groups = df.groupBy(F.col(f"`{key}`").alias("k")).agg(*aggregates)
    out = [F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows")]
    if source:
        out.append(F.count_if("s").alias("cross_source_groups"))
    if domain:
        out.append(F.count_if("d").alias("cross_domain_groups"))
    return groups.agg(*out)


def greedy_multi_key(df: DataFrame, keys: Sequence[str], rank: str, max_rounds: int = 100) -> DataFrame:
    """Keep a row only if no earlier kept row has one of its keys; adds ``kept`` and ``collides_with``, the first such key.

    Exact result of the ordered walk, without walking: in each round the
    undecided rows that are the least under all their keys are kept, and those
    that share a key with a kept row drop out. Rounds follow the longest chain
    of conflicts. ``rank`` must be unique; null keys collide with nothing.
    """
    undecided = cut(df)
    kept: DataFrame | None = None
    for _ in range(max_rounds):
        if undecided.isEmpty():
            break
        marked = undecided
        for k in keys:
            least = undecided.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min(rank).alias(f"__{k}"))
            marked = marked.join(least, k, "left")
        wins = [F.col(k).isNull() | (F.col(f"__{k}") == F.col(rank)) for k in keys]
        test = wins[0]
        for w in wins[1:]:
            test = test & w
        winners = cut(marked.filter(test).select(df.columns))
        kept = winners if kept is None else kept.union(winners)
        rest = undecided.join(winners.select(rank), rank, "left_anti")
        for k in keys:
            rest = rest.join(winners.select(k).filter(F.col(k).isNotNull()).distinct(), k, "left_anti")
        undecided = cut(rest.select(df.columns))
    else:
        raise RuntimeError(f"rows stay undecided after {max_rounds} rounds")
    if kept is None:
        return df.withColumns({"kept": F.lit(True), "collides_with": F.lit(None).cast("string")}).limit(0)
    out = df.join(kept.select(rank).withColumn("kept", F.lit(True)), rank, "left")
    for i, k in enumerate(keys):
        owner = kept.filter(F.col(k).isNotNull()).groupBy(k).agg(F.min(rank).alias(f"__w{i}"))
        out = out.join(owner, k, "left")
    collides = F.coalesce(*[F.when(F.col(f"__w{i}") < F.col(rank), F.lit(k)) for i, k in enumerate(keys)])
    return out.select(*df.columns, F.coalesce("kept", F.lit(False)).alias("kept"), F.when(F.col("kept").isNull(), collides).alias("collides_with"))


def occurrence_reasons(df: DataFrame, rank: str, candidate: str, pair: str, source: str, target: str) -> DataFrame:
    """Duplicate reasons where every row, rejected or not, occupies its keys.

    A row repeats a key when an earlier one has it; one source has several
    targets when the first row of the source has another target, and the other
    way round.
    """
    firsts = df
    for i, k in enumerate((candidate, pair, source, target)):
        partner = target if k == source else source
        first = df.groupBy(F.col(k).alias(f"__key{i}")).agg(F.min(rank).alias(f"__first{i}"), F.min_by(partner, rank).alias(f"__with{i}"))
        firsts = firsts.join(first, F.col(k).eqNullSafe(F.col(f"__key{i}")), "left")
    later = [F.col(f"__first{i}") < F.col(rank) for i in range(4)]
    found = F.array_compact(
        F.array(
            F.when(later[0], "duplicate_candidate_id"),
            F.when(later[1], "duplicate_pair"),
            F.when(later[2], "duplicate_source"),
            F.when(later[2] & (F.col("__with2") != F.col(target)), "one_source_multiple_targets"),
            F.when(later[3], "duplicate_target"),
            F.when(later[3] & (F.col("__with3") != F.col(source)), "one_target_multiple_sources"),
        )
    )
    return firsts.select(*df.columns, found.alias("duplicate_reasons"))


def mapping_conflicts(df: DataFrame, left: str, right: str) -> DataFrame:
    """Values of ``left`` that stand with more than one value of ``right``, and how many."""
    return df.groupBy(left).agg(F.count_distinct(right).alias("n_partners")).filter("n_partners > 1")
