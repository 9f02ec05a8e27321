"""Joins between stages: by line, by id, against known keys, between deliveries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.operators.ordered import ranked


def small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a side for broadcast if it has at most ``max_rows`` rows of together ``max_bytes`` as JSON, else leave the choice to the planner."""
    first = df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("b")).agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    return F.broadcast(df) if first["n"] <= max_rows and (first["b"] or 0) <= max_bytes else df


def align_lines(frames: Sequence[DataFrame], line: str = "line_no", names: Sequence[str] | None = None) -> DataFrame:
    """Line-aligned files joined by line; a line that one of them lacks is flagged in ``is_complete``."""
    named = [f.select(line, F.col("value").alias(n)) for f, n in zip(frames, names or [f"text_{i}" for i in range(len(frames))])]
    joined = reduce(lambda a, b: a.join(b, line, "full_outer"), named)
    columns = [c for c in joined.columns if c != line]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return joined.withColumn("is_complete", complete)


def lookup(df: DataFrame, other: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their match, rows without one)."""
    return df.join(other, key), df.join(other.select(key).distinct(), key, "left_anti")


def carry_forward(df: DataFrame, known: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Values that a record had before, where it has none now."""
    before = known.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(before, key, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def unseen(df: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not known; null keys are never known."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def contaminated_batches(df: DataFrame, batch: str, is_bad: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of sound batches, all rows of batches with one bad row)."""
    bad = df.filter(is_bad & F.col(batch).isNotNull()).select(batch).distinct()
    return df.join(bad, batch, "left_anti"), df.join(bad, batch, "left_semi")


def view_on_base(view: DataFrame, base: DataFrame, key: str) -> dict[str, DataFrame]:
    """A view resolved against its base: ``found``, ``missing`` keys, and keys the view ``repeated``."""
    once = view.select(key).distinct()
    return {
        "found": base.join(once, key, "left_semi"),
        "missing": once.join(base.select(key), key, "left_anti"),
        "repeated": view.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"),
    }


def foreign_key_errors(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, same: str | None = None) -> DataFrame:
    """Children without a parent, or whose parent differs in a column both have."""
    p = parent.select(F.col(parent_key).alias("__pk"), *([F.col(same).alias("__same")] if same else [])).distinct()
    joined = child.join(p, F.col(child_key) == F.col("__pk"), "left")
    wrong = F.col("__pk").isNull()
    reason = F.when(F.col("__pk").isNull(), "missing_parent")
    if same:
        wrong = wrong | ~F.col("__same").eqNullSafe(F.col(same))
        reason = reason.otherwise("parent_differs")
    return joined.filter(wrong).select(*child.columns, reason.alias("error"))


def baseline_comparison(current: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """Counts of distinct keys retained, removed and added against a baseline."""
    a, b = current.select(key).distinct().withColumn("now", F.lit(1)), baseline.select(key).distinct().withColumn("was", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count_if(F.col("now").isNotNull() & F.col("was").isNotNull()).alias("retained"),
        F.count_if(F.col("now").isNull()).alias("removed"),
        F.count_if(F.col("was").isNull()).alias("added"),
    )


def variant_deltas(a: DataFrame, b: DataFrame, key: str, metric: str) -> DataFrame:
    """The metric of two variants per key and its change; a key of one variant only has no change."""
    return a.select(key, F.col(metric).alias("base")).join(b.select(key, F.col(metric).alias("other")), key, "full_outer").withColumn("delta", F.round(F.col("other") - F.col("base"), 6))


def neighbours(df: DataFrame, partition: Sequence[str], order: str, *columns: str) -> DataFrame:
    """Values of the rows before and after."""
    from pyspark.sql import Window

    w = Window.partitionBy(*partition).orderBy(order)
    return df.select("*", *[f(c).over(w).alias(f"{n}_{c}") for c in columns for n, f in (("previous", F.lag), ("next", F.lead))])


def union_sources(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Heterogeneous tables in configured order, missing columns null, with ``source_name`` and ``source_ord``."""
    tagged = [df.withColumns({"source_name": F.lit(name), "source_ord": F.lit(i)}) for i, (name, df) in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def subset_errors(view: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Keys of a view that its base does not have."""
    return view.select(key).distinct().join(base.select(key), key, "left_anti")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in both tables; empty where they are disjoint."""
    return a.select(key).intersect(b.select(key))


def swap_to_sides(df: DataFrame, left_lang: str, right_lang: str, left: str, right: str) -> DataFrame:
    """Source and target text as the sides of a language pair, with ``direction_known``."""
    forward = (F.col("source_lang") == left_lang) & (F.col("target_lang") == right_lang)
    backward = (F.col("source_lang") == right_lang) & (F.col("target_lang") == left_lang)
    return df.withColumns(
        {
            left: F.when(forward, F.col("source_text")).when(backward, F.col("target_text")),
            right: F.when(forward, F.col("target_text")).when(backward, F.col("source_text")),
            "direction_known": F.coalesce(forward | backward, F.lit(False)),
        }
    )


def surrogate_ids(df: DataFrame, prefix: str, order: Sequence[Column], name: str = "record_id", width: int = 9, partition: str | None = None) -> DataFrame:
    """Numbered ids in the given order without one sorted partition for all rows.

    Rows are range-partitioned, numbered within their part and shifted by the rows before it.
    """
    numbered = ranked(df, [partition] if partition else [], order, "__rn")
    return numbered.select(*df.columns, F.concat(F.lit(prefix), F.lpad(F.col("__rn").cast("string"), width, "0")).alias(name))


# A reference to a segment of one side of an alignment.
REFERENCE = r"(?:en|zh):\d+:\d+"


def alignment_id(c: Column | str) -> Column:
    """Struct (document_id, sentence_id, english_references, chinese_references) of an alignment line, null where it is none.

    A line is a document and references to segments, at least one of each side.
    """
    parts = F.split(F.trim(F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"\s+", " ")), " ")
    references = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    of = lambda side: F.filter(references, lambda r: r.startswith(side))
    sound = F.forall(references, lambda r: r.rlike(f"^{REFERENCE}$")) & (F.size(of("en:")) > 0) & (F.size(of("zh:")) > 0) & (parts[0] != "")
    return F.when(
        sound,
        F.struct(parts[0].alias("document_id"), F.array_join(references, " ").alias("sentence_id"), of("en:").alias("english_references"), of("zh:").alias("chinese_references")),
    )


def with_scores(df: DataFrame, scores: DataFrame, key: str, score: str, least: float | None = None) -> DataFrame:
    """Adds ``score`` and ``score_status`` of each row; with ``least`` only rows that have that score or more stay. Scores are unique by key."""
    known = scores.select(F.col(key).alias("__k"), F.col(score).alias("__s"))
    joined = df.join(known, F.col(key) == F.col("__k"), "left")
    if least is not None:
        joined = joined.filter(F.col("__s") >= least)
    status = F.when(F.col("__s").isNotNull(), "evaluated").otherwise("not_evaluated")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__s").alias("score"), status.alias("score_status"))


def quarantine(accepted: DataFrame, rejected: DataFrame, batch: str, key: str, leaks: Column, reason: str, expected: int | None = None) -> dict[str, DataFrame]:
    """Whole batches with one leaking record move from accepted to rejected; a second run moves nothing.

    A batch is contaminated by a leak on either side; a null batch is none. With
    ``expected`` any other number of moved records is an error, unless nothing is
    left to move. Rows that are rejected already are not marked twice.
    """
    both = accepted.select(batch, leaks.alias("__leak")).unionByName(rejected.select(batch, leaks.alias("__leak")))
    bad = both.filter(F.col("__leak") & F.col(batch).isNotNull()).select(batch).distinct()
    moved = accepted.join(bad, batch, "left_semi").join(rejected.select(key).distinct(), key, "left_anti")
    if expected is not None and (n := moved.count()) not in (0, expected):
        raise ValueError(f"{n} records to move, {expected} expected")
    marked = moved.select(*accepted.columns, F.lit(reason).alias("rejection_reason"), F.lit(True).alias("retranslation_required"))
    return {"kept": accepted.join(bad, batch, "left_anti"), "moved": marked, "rejected": rejected.unionByName(marked, allowMissingColumns=True)}
