"""Same or near-same texts across splits: shared pieces and bit fingerprints with proven bounds, edit-distance check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralode.functions.text import canonical_form, nfkc
from paralode.session import cut

#: Most letters of a piece.
PIECE = 6
#: Classes of letters in the first part of the bit fingerprint, each with a cyclic count of 8 bits.
BINS = 64
#: Classes of pairs of neighbouring letters in its second part, each with the parity of its count.
PAIRS = 1024
LETTER_WORDS, PAIR_WORDS = BINS // 8, PAIRS // 64
WORDS = LETTER_WORDS + PAIR_WORDS

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Neighbours in this cycle of 16 codes differ in one bit.
_CYCLE = np.array([(1 << v) - 1 if v <= 8 else 0xFF ^ ((1 << (v - 8)) - 1) for v in range(16)], dtype=np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def most_edits(n: int, max_edits: float) -> int:
    """Edits that a text of n letters may be away from any other, which may be the longer one."""
    return int(max_edits * n / (1 - max_edits) + 1e-9)


def piece_length(n: int, max_edits: float) -> int:
    """Letters of a piece, so that a text of n letters has a piece more than it may have edits."""
    return min(PIECE, n // (most_edits(n, max_edits) + 1))


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of the grams of q letters at every place."""
    h = np.full(max(len(codes) - q + 1, 0), q, dtype=np.uint64)
    for k in range(q):
        h = h * np.uint64(0x100000001B3) + codes[k : len(codes) - q + 1 + k] * _MIX
    return _mix(h).view(np.int64)


def fingerprint(codes: np.ndarray) -> np.ndarray:
    """Bit code of a text, two parts with a bound each.

    Counts of the letters by class: texts differ in at most two bits for each
    substitution, one for each other edit. Parities of the counts of
    neighbouring letters by class: an edit takes two pairs away at most and
    adds two, so texts differ in at most four bits for each.
    """
    letters = _CYCLE[np.bincount((codes % np.uint64(BINS)).astype(np.int64), minlength=BINS) % 16]
    pairs = gram_hashes(codes, 2).view(np.uint64) >> np.uint64(54)
    parity = np.packbits(np.bincount(pairs.astype(np.int64), minlength=PAIRS) % 2 == 1)
    return np.concatenate([letters.view(np.int64), parity.view(np.int64)])


def places(n: int) -> tuple[int, int]:
    """Level of a length and the width of the stretches of a text in which its grams are looked up."""
    level = n.bit_length() - 1
    return level, max(1, 1 << max(level - 3, 0))


def split_overlaps(
    df: DataFrame,
    id_col: str = "record_id",
    text_col: str = "source_text",
    split_col: str = "split",
    train: str = "train",
    held_out: tuple[str, ...] = ("validation", "test"),
    max_edits: float = 0.1,
) -> dict[str, DataFrame]:
    """Overlaps between the training split and the held-out splits.

    Texts are compared without case, white space and punctuation. Equal texts
    form one class, so copies are fingerprinted and joined once. ``links`` has
    all pairs of classes (class_a in train, class_b held out, edits) whose edit
    distance is at most ``max_edits`` of the longer text; a class found on both
    sides links to itself. ``members`` maps records to classes. Rows with a null
    split, a null or contentless text take no part; an empty table gives empty
    results.

    No such pair is missed. A held-out text has one more of its disjoint pieces,
    the rarest, than it may have edits, so there is a first piece i (from 0) up
    to whose end at most i edits lie: it is unchanged, exactly i edits lie before
    it and the others behind. It stands in the training text at most i letters
    further on or back, and, from the end, at most as many as the edits left.
    Pairs that share such a piece are compared by fingerprint, then by letters.
    """
    if not 0 <= max_edits < 0.5:
        raise ValueError("max_edits must be at least 0 and under 0.5")
    form = canonical_form(nfkc(F.col(f"`{text_col}`")))
    side = F.when(F.col(f"`{split_col}`") == train, F.lit(1)).when(F.col(f"`{split_col}`").isin(*held_out), F.lit(2))
    rows = df.select(F.col(f"`{id_col}`").alias("record_id"), F.col(f"`{split_col}`").alias("split"), side.alias("side"), form.alias("form"))
    rows = cut(rows.filter("side is not null and form <> ''").withColumn("class", F.unhex(F.md5("form"))))
    members = rows.select("record_id", "split", "side", "class")
    texts = cut(
        rows.groupBy("class")
        .agg(F.max((F.col("side") == 1).cast("int")).alias("in_train"), F.max((F.col("side") == 2).cast("int")).alias("in_held"), F.first("form").alias("form"))
        .select("class", "in_train", "in_held", "form", F.char_length("form").alias("n"), F.monotonically_increasing_id().alias("id"))
    )

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, n, form in zip(pdf["id"], pdf["n"], pdf["form"]):
                codes = _letters(form)
                level, width = places(n)
                for q in {piece_length(m, max_edits) for m in range(n - int(max_edits * n), n + most_edits(n, max_edits) + 1)} - {0}:
                    h = gram_hashes(codes, q)
                    # Of a gram that comes again within a stretch, the first and the last place.
                    at = _mix(h.view(np.uint64) + np.arange(len(h), dtype=np.uint64) // np.uint64(width) * _MIX)
                    first = np.unique(at, return_index=True)[1]
                    last = len(at) - 1 - np.unique(at[::-1], return_index=True)[1]
                    rows.append((key, n, level, width, h[first], first.astype(np.int32), last.astype(np.int32)))
            yield pd.DataFrame(rows, columns=["id", "n", "level", "width", "gram", "first", "last"])

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, n, form in zip(pdf["id"], pdf["n"], pdf["form"]):
                q, (level, width) = piece_length(n, max_edits), places(n)
                if most_edits(n, max_edits):
                    rows.append((key, n, level, width, q, most_edits(n, max_edits) + 1, gram_hashes(_letters(form), q)[::q]))
            yield pd.DataFrame(rows, columns=["id", "n", "level", "width", "q", "n_pieces", "gram"])

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = np.array([fingerprint(_letters(t)) for t in pdf["form"]], dtype=np.int64).reshape(-1, WORDS)
            yield pd.DataFrame({"id": pdf["id"], "n": pdf["n"], **{f"w{k}": words[:, k] for k in range(WORDS)}})

    # Gram, level and stretch are one hash in the join, first and last place one number: these rows are the bulk of the work.
    key = F.xxhash64("gram", "level", "stretch")
    train_rows = texts.filter("in_train = 1").select("id", "n", "form").mapInPandas(known, "id long, n int, level int, width int, gram array<long>, first array<int>, last array<int>")
    a = cut(train_rows).select(F.col("id").alias("id_a"), F.col("n").alias("n_a"), "level", "width", F.explode(F.arrays_zip("gram", "first", "last")).alias("g"))
    a = a.select("id_a", "n_a", "level", F.expr("g.first div width").cast("int").alias("stretch"), "g.gram", F.shiftleft(F.col("g.first").cast("long"), 32).bitwiseOR(F.col("g.last")).alias("span"))
    a = a.select("id_a", "n_a", key.alias("key"), "span")
    rare = a.groupBy("key").agg(F.count("*").alias("n_known"))
    held_rows = texts.filter("in_held = 1").select("id", "n", "form").mapInPandas(pieces, "id long, n int, level int, width int, q int, n_pieces int, gram array<long>")
    b = held_rows.select("id", "n", "level", "width", "n_pieces", "q", F.posexplode("gram").alias("k", "gram")).withColumn("at", F.col("k") * F.col("q"))
    b = b.withColumn("stretch", F.expr("at div width").cast("int")).withColumn("key", key).join(rare.hint("shuffle_hash"), "key", "left")
    b = b.groupBy("id", "n", "n_pieces").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n_known", F.lit(0)).alias("n_known"), "at", "gram"))).alias("all"))
    chosen = F.array_sort(F.transform(F.slice("all", F.lit(1), F.col("n_pieces")), lambda x: F.struct(x["at"].alias("at"), x["gram"].alias("gram"))))
    b = b.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), F.posexplode(chosen).alias("i", "p")).select("id_b", "n_b", "i", "p.at", "p.gram")
    # Sizes of tables cut by a checkpoint are estimates that a broadcast must not rest on: the joins name their kind.
    # Lengths of two levels may lie within the bound.
    level = lambda n: F.floor(F.log2(n) + 1e-12).cast("int")
    shortest = F.ceil((1 - max_edits) * F.col("n_b") - 1e-9)
    longest = F.floor(F.col("n_b") / (1 - max_edits) + 1e-9)
    b = b.withColumn("level", F.explode(F.sequence(level(shortest), level(longest))))
    width = F.greatest(F.lit(1), F.pow(F.lit(2), F.col("level") - 3).cast("int"))
    b = b.withColumn("stretch", F.explode(F.sequence(F.floor(F.greatest(F.col("at") - F.col("i"), F.lit(0)) / width).cast("int"), F.floor((F.col("at") + F.col("i")) / width).cast("int"))))
    b = b.select("id_b", "n_b", "i", "at", key.alias("key"))
    limit = F.floor(max_edits * F.greatest("n_a", "n_b")).cast("int")
    gap = F.col("n_a") - F.col("n_b")
    low = F.greatest(-F.col("i"), gap - limit + F.col("i"))
    high = F.least(F.col("i"), gap + limit - F.col("i"))
    shared = (
        a.hint("merge").join(b, "key")
        .filter((F.col("id_a") != F.col("id_b")) & (F.col("i") <= limit) & (F.abs(gap) <= limit))
        .filter((F.shiftright("span", 32) <= F.col("at") + high) & (F.col("span").bitwiseAND((1 << 32) - 1) >= F.col("at") + low) & (low <= high))
        .select("id_a", "id_b")
        .distinct()
    )
    coded = cut(texts.select("id", "n", "form").mapInPandas(bits, "id long, n int, " + ", ".join(f"w{k} long" for k in range(WORDS))))
    side_of = lambda s: coded.select(*[F.col(c).alias(f"{c}_{s}") for c in coded.columns])
    apart = lambda words: sum((F.bit_count(F.col(f"w{k}_a").bitwiseXOR(F.col(f"w{k}_b"))) for k in words), F.lit(0))
    within = (apart(range(LETTER_WORDS)) + F.abs(gap) <= 2 * limit) & (apart(range(LETTER_WORDS, WORDS)) <= 4 * limit)
    near = shared.join(side_of("a").hint("merge"), "id_a").join(side_of("b").hint("merge"), "id_b").filter(within).select("id_a", "id_b", limit.alias("limit"))
    checked = (
        near.join(texts.select(F.col("id").alias("id_a"), F.col("class").alias("class_a"), F.col("form").alias("form_a")).hint("merge"), "id_a")
        .join(texts.select(F.col("id").alias("id_b"), F.col("class").alias("class_b"), F.col("form").alias("form_b")).hint("merge"), "id_b")
        # Under a threshold only the band that can hold the distance is filled; -1 is beyond it.
        .withColumn("edits", F.call_function("levenshtein", F.col("form_a"), F.col("form_b"), F.col("limit")))
        .filter("edits >= 0")
        .select("class_a", "class_b", "edits")
    )
    same = texts.filter("in_train = 1 and in_held = 1").select(F.col("class").alias("class_a"), F.col("class").alias("class_b"), F.lit(0).alias("edits"))
    return {"links": cut(checked.union(same)), "members": members}


def overlap_pairs(found: dict[str, DataFrame]) -> DataFrame:
    """record_id_a, record_id_b (the smaller first), edits, of every pair of records across the splits."""
    members = found["members"]
    left = members.filter("side = 1").select(F.col("class").alias("class_a"), F.col("record_id").alias("x"))
    right = members.filter("side = 2").select(F.col("class").alias("class_b"), F.col("record_id").alias("y"))
    return (
        found["links"].join(left, "class_a").join(right, "class_b")
        .select(F.least("x", "y").alias("record_id_a"), F.greatest("x", "y").alias("record_id_b"), "edits")
        .distinct()
    )


def overlap_report(df: DataFrame, found: dict[str, DataFrame], id_col: str = "record_id", group_cols: tuple[str, ...] = ("split", "source_file")) -> DataFrame:
    """Per held-out split and source: records, records that overlap with train, exactly or nearly."""
    links = found["links"].groupBy(F.col("class_b").alias("class")).agg((F.min("edits") == 0).alias("exact"))
    hit = found["members"].filter("side = 2").join(links, "class").groupBy("record_id").agg(F.max("exact").alias("exact"))
    rows = df.filter(F.col("split").isin("validation", "test")).select(F.col(id_col).alias("record_id"), *group_cols)
    return (
        rows.join(hit, "record_id", "left")
        .groupBy(*group_cols)
        .agg(F.count("*").alias("n_records"), F.count("exact").alias("n_overlapping"), F.count_if(F.col("exact")).alias("n_exact"))
    )
