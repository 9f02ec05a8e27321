"""Duplicates hidden by formatting: canonical form, 128-bit key, map-side counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paralode.functions.text import canonical_form
from paralode.session import cut


def canonical_keys(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """(record id, 128-bit key, 64-bit check) of each row.

    The canonical fields are sorted before hashing, so their order does not
    matter. A missing field counts as an empty one; a row without any content
    in any field equals nothing but itself.
    """
    forms = [F.coalesce(canonical_form(F.col(f"`{f}`")), F.lit("")) for f in fields]
    payload = F.array_join(F.array_sort(F.array(*forms)), "\u001f")
    rows = df.select(F.col(f"`{id_col}`").alias("record_key"), payload.alias("payload"))
    rows = rows.withColumn(
        "payload",
        F.when(F.length(F.replace("payload", F.lit("\u001f"), F.lit(""))) > 0, F.col("payload")).otherwise(
            F.concat(F.lit("\u001e"), F.coalesce(F.col("record_key").cast("string"), F.lit("")))
        ),
    )
    return rows.select("record_key", F.unhex(F.md5("payload")).alias("key"), F.xxhash64("payload").alias("check"))


def collapse(keys: DataFrame) -> DataFrame:
    """One row per set of equal records: key, check, keep_id (smallest id), n_copies.

    Counts are combined on the map side, so a set that holds a third of all rows
    costs one row per task. Key and check together identify the content; rows
    with one key and two checks are listed by :func:`collisions` and kept apart.
    """
    return keys.groupBy("key", "check").agg(F.min("record_key").alias("keep_id"), F.count("*").alias("n_copies"))


def with_collisions(groups: DataFrame) -> DataFrame:
    """Groups with ``collides``: whether another content has the same key; a key has one row for each of its contents."""
    return groups.withColumn("collides", F.count("*").over(Window.partitionBy("key")) > 1)


def collisions(groups: DataFrame) -> DataFrame:
    """Keys under which different contents met; empty unless the 128-bit hash collides."""
    return groups.groupBy("key").agg(F.count("*").alias("n_contents")).filter("n_contents > 1")


def hidden_duplicates(df: DataFrame, id_col: str = "pool_record_id", fields: Sequence[str] = ("zh_text", "en_text")) -> dict[str, DataFrame]:
    """Collapse records that differ only in formatting.

    Returns ``groups`` (one row per content with its number of copies),
    ``members`` (keep_id, copy_id for every other record of a set) and
    ``collisions``. A repeated id is one more copy of its set but never its own
    copy_id. Empty tables give empty results.
    """
    keys = cut(canonical_keys(df, id_col, fields))
    groups = collapse(keys)
    repeated = groups.filter("n_copies > 1")
    members = (
        keys.join(repeated, ["key", "check"])
        .filter(F.col("record_key") != F.col("keep_id"))
        .select("keep_id", F.col("record_key").alias("copy_id"))
        .distinct()
    )
    return {"groups": groups, "members": members, "collisions": collisions(groups)}
