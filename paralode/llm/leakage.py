"""Evaluation texts leaking into a corpus: latent semantic candidates, then common-subsequence and answer checks.

Texts are reduced to the letters of one script with the digits among them (case,
width, spacing and punctuation dropped) and cut into overlapping windows. A
window is a TF-IDF vector of hashed letter grams; a randomised singular value
decomposition gives the latent space in which windows of the corpus are compared
with those of the evaluation items. Candidates are checked on the letters: the
longest common subsequence must hold about half of the item, or, for a
paraphrase, the longest common subsequence of words together with the answers.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paralode.operators.select import least_hashed
from paralode.session import cut

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
RANK = 64
GRAM = 4
#: Cosine in the latent space from which an item and a text are checked.
COSINE = 0.8
#: Share of an item that a connected passage must hold.
COVERAGE = 0.55
#: Of a paraphrase: share of the item's words in order, share of its answers, and the part of its words that are answers.
PARAPHRASE = 0.64
ANSWERS = 0.6
ANSWER_PART = 0.25


@dataclass(frozen=True)
class Script:
    """Letters of a script, window length, the gram length of the check, the letters of a word and of an answer (0: a word as spaced)."""

    name: str
    ranges: tuple[tuple[int, int], ...]
    window: int
    check: int
    word: int
    answer: int


SCRIPTS = (
    Script("han", ((0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)), 32, 5, 1, 2),
    Script("latin", ((0x61, 0x7A), (0xDF, 0x24F), (0x1E00, 0x1EFF)), 80, 12, 0, 0),
    Script("thai", ((0xE01, 0xE2E), (0xE40, 0xE44)), 44, 6, 2, 4),
    Script("other", (), 60, 8, 0, 0),
)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)
_DIGIT = len(SCRIPTS) + 1
FLAG_BITS = 20
_FLAG_MASK = np.uint64((1 << FLAG_BITS) - 1)


def _classes() -> np.ndarray:
    """The script of every code point, 0 for what is no letter; digits go with every script."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x250, 0x1E000):
        if not 0xAC00 <= code <= 0xD7A3 and chr(code).isalpha():
            kinds[code] = 4
    kinds[0xAC00:0xD7A4] = 4
    for k, script in enumerate(SCRIPTS):
        for low, high in script.ranges:
            kinds[low : high + 1] = k + 1
    kinds[0x30:0x3A] = _DIGIT
    return kinds


_CLASS = _classes()


def gram_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every gram of n letters."""
    m = max(0, len(chars) - n + 1)
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = h * _STEP + chars[k : k + m] * _GOLD
    return h ^ (h >> np.uint64(29))


@dataclass
class Letters:
    """Letters of one script of many texts, one after the other; the text that each belongs to; where a word starts."""

    chars: np.ndarray
    owner: np.ndarray
    starts: np.ndarray

    def bounds(self, text: int) -> tuple[int, int]:
        return int(np.searchsorted(self.owner, text)), int(np.searchsorted(self.owner, text, "right"))

    def hashed(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place) of every gram of n letters within one text."""
        h = gram_hashes(self.chars, n)
        inside = np.flatnonzero(self.owner[: len(h)] == self.owner[n - 1 :][: len(h)])
        return h[inside], inside

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, text, place) of every gram within one text."""
        h, inside = self.hashed(GRAM)
        return ((h * _GOLD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), self.owner[inside], inside

    def words(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, place of its first letter) of every word; with n above 0 every n letters are one."""
        if n:
            return self.hashed(n)
        if not len(self.chars):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.starts)
        place = np.arange(len(self.chars)) - np.repeat(at, np.diff(np.append(at, len(self.chars))))
        mixed = (self.chars * _GOLD) ^ ((place.astype(np.uint64) + np.uint64(1)) * _STEP)
        return np.add.reduceat((mixed ^ (mixed >> np.uint64(31))) * _GOLD, at), at


def letters_of(texts: Sequence[str | None]) -> list[Letters]:
    """The letters of each script with the digits; a text takes part where it has letters enough for a gram."""
    joined = "\x00".join((t or "").replace("\x00", " ") for t in texts)
    if not unicodedata.is_normalized("NFKC", joined):
        joined = unicodedata.normalize("NFKC", joined)
    codes = np.frombuffer(joined.casefold().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.cumsum(codes == 0, dtype=np.int32)
    kinds = _CLASS[codes]
    digits = kinds == _DIGIT
    out = []
    for k in range(len(SCRIPTS)):
        own = kinds == k + 1
        enough = np.bincount(owner[own], minlength=len(texts)) >= GRAM
        at = np.flatnonzero((own | digits) & enough[owner]) if enough.any() else np.zeros(0, np.int64)
        starts = np.append(True, np.diff(at) != 1)[: len(at)]
        out.append(Letters(codes[at].astype(np.uint64), owner[at], starts))
    return out


def half_windows(buckets: np.ndarray, owner: np.ndarray, basis: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, text, first gram, last gram) of the windows of two halves each; a short text is one window."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    starts = np.flatnonzero(place % half == 0)
    ends = np.append(starts[1:], len(owner))
    # Halves as rows of equal length; short ones are padded with the zero vector behind the basis.
    index = starts[:, None] + np.arange(half)
    padded = np.where(index < ends[:, None], buckets[np.minimum(index, len(buckets) - 1)], len(basis) - 1)
    sums = np.empty((len(starts), basis.shape[1]), dtype=np.float32)
    for at in range(0, len(starts), 1024):
        part, some = padded[at : at + 1024], sums[at : at + 1024]
        some[:] = basis[part[:, 0]]
        for k in range(1, half):
            some += basis[part[:, k]]
    who = owner[starts]
    pair = np.append(who[1:] == who[:-1], False)
    single = ~pair & ~np.append(False, pair[:-1])
    full = np.flatnonzero(pair)
    vectors = np.vstack([sums[full] + sums[full + 1], sums[single]])
    text = np.concatenate([who[full], who[single]])
    low, high = np.concatenate([starts[full], starts[single]]), np.concatenate([ends[full + 1], ends[single]])
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9), text, low, high


def dense_windows(buckets: np.ndarray, basis: np.ndarray, window: int, step: int) -> np.ndarray:
    """Latent unit vectors of windows that start at every ``step``-th gram."""
    total = np.vstack([np.zeros((1, basis.shape[1])), np.cumsum(basis[buckets], axis=0, dtype=np.float64)])
    last = max(0, len(buckets) - window)
    starts = np.unique(np.append(np.arange(0, last + 1, step), last))
    full = total[np.minimum(starts + window, len(buckets))] - total[starts]
    return (full / np.maximum(np.sqrt((full * full).sum(axis=1, keepdims=True)), 1e-9)).astype(np.float32)


def longest_chain(at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Indices of the longest common subsequence of the hits (place in the text, place in the item), both strictly increasing."""
    order = np.lexsort((-place, at))
    ends: list[int] = []
    last: list[int] = []
    before = np.full(len(order), -1)
    for i in order:
        k = bisect_left(ends, place[i])
        if k == len(ends):
            ends.append(place[i])
            last.append(i)
        else:
            ends[k], last[k] = place[i], i
        before[i] = last[k - 1] if k else -1
    chain = []
    i = last[-1] if last else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return np.array(chain[::-1], dtype=np.int64)


def chain_coverage(at: np.ndarray, place: np.ndarray, n: int, length: int) -> float:
    """Share of an item's letters in the longest common subsequence of grams with a connected stretch of a text."""
    chain = place[longest_chain(at, place)]
    return (n + int(np.minimum(np.diff(chain), n).sum())) / length if len(chain) else 0.0


def word_masks(words: Sequence[int]) -> dict[int, int]:
    """Bits of the places of every word."""
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def common_words(masks: dict[int, int], length: int, words: Sequence[int]) -> int:
    """Length of the longest common subsequence of ``words`` with the ``length`` words of the masks, bit-parallel."""
    row = full = (1 << length) - 1
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return length - row.bit_count()


def gram_counts(df: DataFrame, text_col: str) -> np.ndarray:
    """Occurrences of every hashed gram of each script over all texts (scripts x buckets)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(SCRIPTS), BUCKETS), dtype=np.int64)
        for pdf in batches:
            for texts in _chunks(pdf["text"].tolist()):
                for k, own in enumerate(letters_of(texts)):
                    total[k] += np.bincount(own.grams()[0], minlength=BUCKETS)
        script, bucket = np.nonzero(total)
        yield pd.DataFrame({"script": script.astype(np.int32), "bucket": bucket.astype(np.int32), "n": total[script, bucket]})

    counts = df.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(run, "script int, bucket int, n long")
    summed = counts.groupBy("script", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most scripts x buckets rows
    total = np.zeros((len(SCRIPTS), BUCKETS), dtype=np.int64)
    total[summed["script"].to_numpy(), summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return total


def _chunks(texts: list, letters: int = 300_000) -> Iterator[list]:
    at = 0
    while at < len(texts):
        size, start = 0, at
        while at < len(texts) and (at == start or size < letters):
            size += len(texts[at] or "")
            at += 1
        yield texts[start:at]


def idf_weights(counts: np.ndarray) -> np.ndarray:
    """Weight of each gram: the logarithm of its rarity, the commonest ones near nothing."""
    total = counts.sum(axis=1, keepdims=True)
    return np.clip(np.log((total + 1) / (counts + 1)) - 4, 0.1, None).astype(np.float32)


def fit_basis(sample: DataFrame, idf: np.ndarray, rank: int = RANK, rounds: int = 3, seed: int = 5) -> np.ndarray:
    """Latent basis (scripts x buckets x rank) by a distributed randomised decomposition of the sample's windows.

    Subspace iteration: each round multiplies a random, then orthogonal, block
    by A and by its transpose, both over the partitions of the sample, and sums
    one block per partition. ``sample`` has the column text and is bounded by
    its caller, so the blocks are few.
    """
    spark = sample.sparkSession
    rng = np.random.default_rng(seed)
    q = rng.standard_normal((len(SCRIPTS), BUCKETS, rank)).astype(np.float32)
    for _ in range(rounds):
        box = spark.sparkContext.broadcast(q * idf[:, :, None])

        def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            b = box.value
            z = np.zeros_like(b)
            for pdf in batches:
                for texts in _chunks(pdf["text"].tolist()):
                    for k, own in enumerate(letters_of(texts)):
                        buckets, owner, _ = own.grams()
                        if not len(buckets):
                            continue
                        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
                        starts = np.flatnonzero(place % SCRIPTS[k].window == 0)
                        y = np.add.reduceat(b[k][buckets], starts, axis=0)
                        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(owner))))
                        order = np.argsort(buckets, kind="stable")
                        used, at = np.unique(buckets[order], return_index=True)
                        z[k][used] += np.add.reduceat(y[row[order]], at, axis=0)
            rows = [np.flatnonzero(z[k].any(axis=1)) for k in range(len(SCRIPTS))]
            yield pd.DataFrame({"script": range(len(SCRIPTS)), "rows": [r.tobytes() for r in rows], "block": [z[k][r].tobytes() for k, r in enumerate(rows)]})

        # Only the rows of grams that a part has come back from it.
        blocks = sample.mapInPandas(multiply, "script int, rows binary, block binary").toLocalIterator()
        z = np.zeros_like(q)
        for row in blocks:
            z[row["script"]][np.frombuffer(row["rows"], dtype=np.int64)] += np.frombuffer(row["block"], dtype=np.float32).reshape(-1, rank)
        z *= idf[:, :, None]
        q = np.stack([np.linalg.qr(z[k])[0] for k in range(len(SCRIPTS))]).astype(np.float32)
        box.unpersist()
    return q * idf[:, :, None]


class Index:
    """The items of one script: latent windows, and sorted grams and answers with the item and place of each."""

    def __init__(self, script: Script, own: Letters, keys: list, mine: np.ndarray, basis: np.ndarray, idf: np.ndarray):
        self.script, self.keys = script, keys
        buckets, of, places = own.grams()
        vectors, owner, grams, answers = [], [], [], []
        self.masks, self.sizes, self.lengths, self.wanted = [], [], [], []
        check, check_at = own.hashed(script.check)
        words, words_at = own.words(script.word)
        all_answers, answers_at = own.words(script.answer)
        for i, text in enumerate(mine):
            low, high = own.bounds(text)
            self.lengths.append(max(high - low, 1))
            inside = slice(*np.searchsorted(places, (low, high)))
            v = dense_windows(buckets[inside], basis, script.window, max(2, script.window // 4)) if buckets[inside].size else np.zeros((0, basis.shape[1]), np.float32)
            vectors.append(v)
            owner += [i] * len(v)
            inside = slice(*np.searchsorted(check_at, (low, high)))
            grams += [(h, i, p) for h, p in zip(check[inside].tolist(), (check_at[inside] - low).tolist())]
            inside = slice(*np.searchsorted(words_at, (low, high)))
            self.masks.append(word_masks(words[inside].tolist()))
            self.sizes.append(int(inside.stop - inside.start))
            # Answers are the words whose letters stand in the rarest grams of the corpus.
            of_item = slice(*np.searchsorted(places, (low, high)))
            weight = np.zeros(high - low + 1)
            weight[places[of_item] - low] = idf[buckets[of_item]]
            inside = slice(*np.searchsorted(answers_at, (low, high)))
            rarity: dict[int, float] = {}
            for h, p in zip(all_answers[inside].tolist(), (answers_at[inside] - low).tolist()):
                rarity[h] = max(rarity.get(h, 0.0), float(weight[p]))
            best = sorted(rarity, key=lambda h: (-rarity[h], h))[: max(2, round(ANSWER_PART * len(rarity)))]
            answers += [(h, i, k) for k, h in enumerate(best)]
            self.wanted.append(max(1, math.ceil(ANSWERS * len(best))))
        self.matrix = np.vstack(vectors).T.copy() if vectors else np.zeros((basis.shape[1], 0), np.float32)
        self.owner = np.array(owner, dtype=np.int64)
        self.lengths, self.wanted = np.array(self.lengths, dtype=np.int64), np.array(self.wanted, dtype=np.int64)
        self.grams, self.gram_item, self.gram_place = self._sorted(grams)
        self.gram_flags = self.flags(self.grams)
        self.answers, self.answer_item, self.answer_number = self._sorted(answers)
        self.answer_flags = self.flags(self.answers)

    @staticmethod
    def _sorted(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = np.array([r[0] for r in rows], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        return hashes[order], np.array([r[1] for r in rows], dtype=np.int64)[order], np.array([r[2] for r in rows], dtype=np.int64)[order]

    @staticmethod
    def flags(known: np.ndarray) -> np.ndarray:
        """Which of the last bits of a hash any known one has: most others are told apart by them."""
        out = np.zeros(1 << FLAG_BITS, dtype=bool)
        out[known & _FLAG_MASK] = True
        return out

    @staticmethod
    def hits(known: np.ndarray, flags: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the hash, index of the known one) of every pair of equal ones."""
        likely = np.flatnonzero(flags[hashes & _FLAG_MASK])
        left = np.searchsorted(known, hashes[likely])
        same = np.flatnonzero(known[np.minimum(left, len(known) - 1)] == hashes[likely]) if len(known) else likely
        hit, left = likely[same], left[same]
        many = np.searchsorted(known, hashes[hit], "right") - left
        return np.repeat(hit, many), np.repeat(left, many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))


class Searcher:
    """The items in latent space and in letters; finds them in texts."""

    def __init__(self, items: Sequence[tuple[object, str]], basis: np.ndarray, idf: np.ndarray, cosine: float = COSINE, coverage: float = COVERAGE):
        self.basis = np.concatenate([basis, np.zeros_like(basis[:, :1])], axis=1)
        self.cosine, self.least = cosine, coverage
        known = letters_of([t for _, t in items])
        # An item is looked for in the script that most of its letters are of.
        sizes = np.array([np.bincount(own.owner, minlength=len(items)) for own in known]).reshape(len(SCRIPTS), len(items))
        main = np.where(sizes.max(axis=0, initial=0) > 0, sizes.argmax(axis=0), -1) if len(items) else np.zeros(0, np.int64)
        self.indexes = []
        for k, script in enumerate(SCRIPTS):
            mine = np.flatnonzero(main == k)
            self.indexes.append(Index(script, known[k], [items[i][0] for i in mine], mine, basis[k], idf[k]))

    def find(self, texts: Sequence[str | None]) -> list[tuple[int, object, float, str]]:
        """(text, item key, coverage, kind) of every leaked item."""
        out = []
        for k, (own, index) in enumerate(zip(letters_of(texts), self.indexes)):
            buckets, of, places = own.grams()
            if len(buckets) and index.matrix.shape[1]:
                out += self._search(own, index, buckets, of, places, self.basis[k])
        return out

    def _search(self, own: Letters, index: Index, buckets: np.ndarray, of: np.ndarray, places: np.ndarray, basis: np.ndarray) -> list:
        vectors, text, low, high = half_windows(buckets, of, basis, index.script.window // 2)
        width, n_items = index.matrix.shape[1], len(index.keys)
        window, item = [], []
        for at in range(0, len(vectors), 512):
            near = np.flatnonzero((vectors[at : at + 512] @ index.matrix >= self.cosine).ravel())
            window.append(near // width + at)
            item.append(index.owner[near % width])
        window, item = np.concatenate(window), np.concatenate(item)
        if not len(window):
            return []
        pair = text[window].astype(np.int64) * n_items + item
        order = np.argsort(pair, kind="stable")
        pair, window = pair[order], window[order]
        pairs, first = np.unique(pair, return_index=True)
        region = np.minimum.reduceat(places[low[window]], first), np.maximum.reduceat(places[high[window] - 1], first) + GRAM
        slot = np.full((int(own.owner[-1]) + 1) * n_items, -1, dtype=np.int32)
        slot[pairs] = np.arange(len(pairs), dtype=np.int32)

        def of_candidates(hashes: np.ndarray, at: np.ndarray, known: np.ndarray, flags: np.ndarray, known_item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """(pair, place in the letters, index of the known hash) of the hits of a candidate."""
            hit, which = Index.hits(known, flags, hashes)
            place = at[hit]
            near = slot[own.owner[place].astype(np.int64) * n_items + known_item[which]]
            ok = np.flatnonzero(near >= 0)
            return near[ok], place[ok], which[ok]

        n = index.script.check
        lengths = index.lengths[pairs % n_items]
        found: dict[int, tuple[float, str]] = {}
        of_pair, at, which = of_candidates(*own.hashed(n), index.grams, index.gram_flags, index.gram_item)
        # A hit covers letters of its block of n letters of the item and of the next one: pairs with too few blocks are out.
        blocks = np.zeros((len(pairs), int(index.lengths.max()) // n + 2), dtype=bool)
        blocks[of_pair, index.gram_place[which] // n] = True
        blocks[:, 1:] |= blocks[:, :-1].copy()
        ok = np.flatnonzero((blocks.sum(axis=1) * n >= self.least * lengths)[of_pair])
        of_pair, at, which = of_pair[ok], at[ok], which[ok]
        if len(at):
            # Hits further apart than a quarter of the item belong to different stretches of the text.
            order = np.lexsort((at, of_pair))
            of_pair, at, place = of_pair[order], at[order], index.gram_place[which[order]]
            new = (np.diff(of_pair) > 0) | (np.diff(at) > np.maximum(4 * n, lengths[of_pair[1:]] // 4))
            stretch = np.append(0, np.cumsum(new))
            # No chain holds more of an item than all hits of its stretch together.
            order = np.lexsort((place, stretch))
            p, q = stretch[order], place[order]
            step = np.where(np.append(True, p[1:] != p[:-1]), n, np.minimum(np.append(0, np.diff(q)), n))
            most = np.bincount(p, weights=step)
            first = np.searchsorted(stretch, np.arange(len(most)))
            for g in np.flatnonzero(most >= self.least * lengths[of_pair[first]]):
                c = int(of_pair[first[g]])
                mine = slice(first[g], first[g + 1] if g + 1 < len(first) else len(stretch))
                share = chain_coverage(at[mine], place[mine], n, int(lengths[c]))
                if share >= max(self.least, found.get(c, (0.0,))[0]):
                    found[c] = (share, "literal")
        of_pair, at, which = of_candidates(*own.words(index.script.answer), index.answers, index.answer_flags, index.answer_item)
        need = index.wanted[pairs % n_items]
        answered = np.zeros((len(pairs), int(index.answer_number.max(initial=0)) + 1), dtype=bool)
        answered[of_pair, index.answer_number[which]] = True
        ok = np.flatnonzero((answered.sum(axis=1) >= need)[of_pair])
        of_pair, at, which = of_pair[ok], at[ok], which[ok]
        if not len(at):
            return self._named(found, pairs, n_items, index)
        order = np.lexsort((at, of_pair))
        of_pair, at, number = of_pair[order], at[order], index.answer_number[which[order]]
        # A connected passage is about as long as the item and starts, but for what precedes it, at an answer.
        room = lengths + lengths // 4
        span = int(own.owner.size) + int(room.max()) + 1
        code = of_pair * span + at
        last = np.searchsorted(code, code + room[of_pair], "right")
        words, words_at = own.words(index.script.word)
        done = (-1, 0)
        for i in np.flatnonzero(last - np.arange(len(at)) >= need[of_pair]):
            c = int(of_pair[i])
            if found.get(c, ("", ""))[1] == "literal" or len(set(number[i : last[i]].tolist())) < need[c]:
                continue
            length, here = int(lengths[c]), int(at[i])
            # Passages that start within a quarter of the item are one.
            if done[0] == c and here < done[1] + length // 4:
                continue
            done = (c, here)
            # The passage has the cosine's window in it.
            if here > region[1][c] + length or here + room[c] < region[0][c] - length:
                continue
            item, low_at, high_at = int(pairs[c] % n_items), *own.bounds(int(pairs[c] // n_items))
            inside = slice(*np.searchsorted(words_at, (max(low_at, here - length // 2), min(high_at, here + int(room[c])))))
            share = common_words(index.masks[item], index.sizes[item], words[inside].tolist()) / max(index.sizes[item], 1)
            if share >= max(PARAPHRASE, found.get(c, (0.0,))[0]):
                found[c] = (share, "paraphrase")
        return self._named(found, pairs, n_items, index)

    @staticmethod
    def _named(found: dict[int, tuple[float, str]], pairs: np.ndarray, n_items: int, index: Index) -> list:
        return [(int(pairs[c] // n_items), index.keys[int(pairs[c] % n_items)], share, kind) for c, (share, kind) in found.items()]


def leaked_items(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    sample_rows: int = 1500,
    block_items: int = 5000,
) -> DataFrame:
    """doc_id, item_id, coverage and kind of every text that holds an item or a connected passage of about half of it.

    ``kind`` is ``literal`` (the common subsequence of letter grams holds
    ``COVERAGE`` of the item) or ``paraphrase`` (``PARAPHRASE`` of its words in
    order and ``ANSWERS`` of its rarest words). Gram statistics come from all
    texts; the latent basis is fitted on the ``sample_rows`` texts of least
    hash; every window of every text is searched. The held-out items are read
    and broadcast in blocks of ``block_items``, each against all texts, so
    their number is not limited. Null texts and texts without letters hold
    nothing. Repeated rows are reported once; empty tables give an empty result.
    """
    spark = df.sparkSession
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    idf = idf_weights(gram_counts(texts, "text"))
    sample = least_hashed(texts, "text", sample_rows).select(F.col("value").alias("text"))
    wanted = items.select(F.col(f"`{item_id}`").alias("k"), F.col(f"`{item_text}`").alias("t")).filter("t is not null").distinct()
    of_items = least_hashed(wanted, "t", sample_rows).select(F.col("value").alias("text"))
    basis = fit_basis(cut(sample.union(of_items).repartition(6)), idf)
    kinds = dict(df.dtypes)[id_col], dict(items.dtypes)[item_id]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, coverage double, kind string"

    def search(block: Sequence) -> DataFrame:
        box = spark.sparkContext.broadcast(Searcher([(r["k"], r["t"]) for r in block], basis, idf))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                ids, all_texts, at, found = pdf["doc_id"].tolist(), pdf["text"].tolist(), 0, []
                for chunk in _chunks(all_texts):
                    found += [(ids[at + t], key, share, kind) for t, key, share, kind in box.value.find(chunk)]
                    at += len(chunk)
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "coverage", "kind"])

        return texts.mapInPandas(run, schema)

    rows = wanted.orderBy("k", "t").toLocalIterator()
    hits = None
    while block := list(islice(rows, block_items)):
        found = search(block)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return spark.createDataFrame([], schema)
    return hits.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.min("kind").alias("kind"))


def leak_report(hits: DataFrame, items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Per item: its number of leaking texts, of those that paraphrase it, and the largest share that one of them holds."""
    per = hits.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.count_if(F.col("kind") == "paraphrase").alias("n_paraphrased"), F.max("coverage").alias("most"))
    return items.select(F.col(item_id).alias("item_id"), "split").join(per, "item_id", "left").na.fill({"n_documents": 0, "n_paraphrased": 0, "most": 0.0})
