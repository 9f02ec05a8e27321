"""Language of documents and of mixed-language stretches by prediction by partial matching.

Per language a variable-order byte context tree with escape probabilities
gives the exact code length of a text under frozen statistics. Stretches are
found by the cheapest path through the units of a text, where a change of
language costs a fixed number of bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralode.operators.select import least_hashed

LANGUAGES = ("th", "zh-CN", "en", "lo", "ja", "vi", "id")
ORDER = 4
#: Bits that a change of language costs on the path through a text.
SWITCH_BITS = 24.0
#: What a stretch must hold to count as a sentence: words for Latin script, letters for the others.
LEAST_WORDS = 5
LEAST_LETTERS = {"th": 15, "lo": 15, "zh-CN": 8, "ja": 8}

#: A few plain sentences of each language, from which the first models are made.
SEEDS = {
    "th": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ โรงเรียนในเมืองนี้เปิดสอนหลักสูตรใหม่สำหรับนักเรียนทุกคนในปีนี้ ธนาคารประกาศว่าจะลดอัตราดอกเบี้ยให้กับประชาชน",
    "zh-CN": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。这所学校今年为所有学生开设了新的课程，银行宣布将降低利率，工程师们正在测试新的系统，图书馆也在城市的北部。我们的公司没有这个计划，因为他们说还不需要。",
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. The school in this city has opened a new course for all of its students this year, and the bank said that it would lower the interest rate. The engineers are testing a new system which was approved by the committee after a long review of the plan.",
    "lo": "ມະນຸດເກີດມາມີສິດເສລີພາບ ແລະ ສະເໝີໜ້າກັນໃນທາງກຽດຕິສັກ ແລະ ທາງສິດດ້ວຍ ມີສະຕິສຳປັດຊັນຍະ ແລະ ຕ້ອງປະພຶດຕໍ່ກັນໃນທາງພີ່ນ້ອງ ໂຮງຮຽນຢູ່ເມືອງນີ້ໄດ້ເປີດສອນຫຼັກສູດໃໝ່ໃຫ້ນັກຮຽນທຸກຄົນໃນປີນີ້ ທະນາຄານໄດ້ປະກາດວ່າຈະຫຼຸດອັດຕາດອກເບ້ຍ",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。この町の学校は今年すべての生徒のために新しい講座を開きました。銀行は金利を下げると発表しています。技術者たちは新しいシステムを試しています。",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hóa ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình bằng hữu. Trường học ở thành phố này đã mở một khóa học mới cho tất cả học sinh trong năm nay. Ngân hàng đã công bố rằng sẽ giảm mức lãi suất cho người dân. Các kỹ sư đang thử nghiệm hệ thống mới.",
    "id": "Semua orang dilahirkan merdeka dan mempunyai martabat dan hak-hak yang sama. Mereka dikaruniai akal dan hati nurani dan hendaknya bergaul satu sama lain dalam semangat persaudaraan. Sekolah di kota ini telah membuka kursus baru untuk semua siswa pada tahun ini. Bank itu mengumumkan bahwa suku bunga akan diturunkan bagi warga. Para insinyur sedang menguji sistem yang baru tanpa pemberitahuan di wilayah ini.",
}

_KINDS = (("th", "฀-๿"), ("lo", "຀-໿"), ("cjk", "぀-ヿ㐀-鿿豈-﫿々〆〇"), ("latin", "A-Za-zÀ-ɏ̀-ͯḀ-ỿ"))
#: A unit: letters of one script with all that is no letter of another one, up to the end of a sentence or line.
_UNIT = re.compile(
    "[^\n]*?(?:"
    + "|".join(
        f"[{own}][^{''.join(c for k, c in _KINDS if k != kind)}\n.。!！?？]*(?:[.](?!\\s|$)[^{''.join(c for k, c in _KINDS if k != kind)}\n.。!！?？]*)*(?:[.。!！?？]+[\"”’）)]*)?"
        for kind, own in _KINDS
    )
    + ")|[^\n]+"
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Model:
    """Frozen statistics of all languages: for each order the grams with their code length and their escape length."""

    def __init__(self, texts: dict[str, str]):
        self.languages = tuple(texts)
        self.tables = []
        data = {k: np.frombuffer(("\n" + v).encode(), dtype=np.uint8).astype(np.uint64) for k, v in texts.items()}
        counted = []
        for k in range(ORDER + 1):
            per = {}
            for lang, raw in data.items():
                n = max(0, len(raw) - k)
                grams = np.zeros(n, dtype=np.uint64)
                for j in range(k + 1):
                    grams = (grams << np.uint64(8)) | raw[j : j + n]
                per[lang] = np.unique(grams, return_counts=True)
            counted.append(per)
        for k in range(ORDER + 1):
            keys = np.unique(np.concatenate([g for g, _ in counted[k].values()]))
            code = np.full((len(keys), len(data)), np.inf, dtype=np.float32)
            escape = np.zeros((len(keys), len(data)), dtype=np.float32)
            for j, lang in enumerate(self.languages):
                grams, n = counted[k][lang]
                context, start, distinct = np.unique(grams >> np.uint64(8), return_index=True, return_counts=True)
                total = np.add.reduceat(n, start) if len(n) else n
                at = np.searchsorted(context, grams >> np.uint64(8))
                code[np.searchsorted(keys, grams), j] = -np.log2(n / (total + distinct)[at])
                if k < ORDER and len(counted[k + 1][lang][0]):
                    up, m = counted[k + 1][lang]
                    context, start, distinct = np.unique(up >> np.uint64(8), return_index=True, return_counts=True)
                    total = np.add.reduceat(m, start)
                    spot = np.searchsorted(keys, context)
                    known = (spot < len(keys)) & (keys[np.minimum(spot, len(keys) - 1)] == context)
                    escape[spot[known], j] = -np.log2(distinct / (total + distinct))[known]
            self.tables.append((*self._hash(keys), np.vstack([code, np.full((1, len(data)), np.inf, np.float32)]), np.vstack([escape, np.zeros((1, len(data)), np.float32)])))
        # Order 0 escapes to a uniform byte.
        distinct = np.array([len(counted[0][x][0]) for x in self.languages])
        total = np.array([counted[0][x][1].sum() for x in self.languages])
        self.last = (8 - np.log2(distinct / (total + distinct))).astype(np.float32)

    @staticmethod
    def _hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        bits = max(4, int(np.ceil(np.log2(len(keys) * 3 + 1))))
        slots = np.full(1 << bits, -1, dtype=np.int32)
        open_ = np.arange(len(keys))
        at = ((keys * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)
        while len(open_):
            slot = at[open_]
            free = slots[slot] < 0
            first = np.unique(slot[free], return_index=True)
            chosen = open_[free][first[1]]
            slots[first[0]] = chosen
            open_ = open_[slots[at[open_]] != open_]
            at[open_] = (at[open_] + 1) & ((1 << bits) - 1)
        return keys, slots, bits

    @staticmethod
    def _find(table: tuple, grams: np.ndarray) -> np.ndarray:
        keys, slots, bits = table[:3]
        at = ((grams * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)
        found = slots[at]
        miss = np.flatnonzero((found >= 0) & (keys[found] != grams))
        while len(miss):
            at[miss] = (at[miss] + 1) & ((1 << bits) - 1)
            found[miss] = slots[at[miss]]
            miss = miss[(found[miss] >= 0) & (keys[found[miss]] != grams[miss])]
        return np.where(found >= 0, found, len(keys))

    def code_lengths(self, raw: np.ndarray) -> np.ndarray:
        """Bits of every byte under every language, as float32 (bytes x languages)."""
        wide = raw.astype(np.uint64)
        n = len(raw)
        rows = []
        gram = np.zeros(n, dtype=np.uint64)
        for k in range(ORDER + 1):
            shifted = np.zeros(n, dtype=np.uint64)
            if k < n:
                shifted[k:] = wide[: n - k]
            gram = gram | (shifted << np.uint64(8 * k))
            rows.append(self._find(self.tables[k], gram))
        bits = np.zeros((n, len(self.languages)), dtype=np.float32)
        todo = np.ones((n, len(self.languages)), dtype=bool)
        for k in range(ORDER, -1, -1):
            code = self.tables[k][3][rows[k]]
            seen = np.isfinite(code) & todo
            if k:
                context = np.empty(n, dtype=np.int64)
                context[1:] = rows[k - 1][:-1]
                context[0] = len(self.tables[k - 1][0])
                escape = self.tables[k - 1][4][context]
                bits += np.where(seen, code, np.where(todo, escape, 0))
            else:
                bits += np.where(seen, code, np.where(todo, self.last, 0))
            todo &= ~seen
        return bits


def units_of(text: str) -> list[tuple[int, int]]:
    """Spans of the units of a text; they cover every character that is no line break."""
    return [m.span() for m in _UNIT.finditer(text)]


_OWN = {"th": re.compile("[฀-๿]"), "lo": re.compile("[຀-໿]"), "zh-CN": re.compile("[㐀-鿿]"), "ja": re.compile("[぀-ヿ㐀-鿿]")}


def _enough(text: str, lang: str) -> bool:
    if lang in LEAST_LETTERS:
        return len(_OWN[lang].findall(text)) >= LEAST_LETTERS[lang]
    return sum(any(ch.isalpha() for ch in w) for w in text.split()) >= LEAST_WORDS


def segments(text: str, spans: Sequence[tuple[int, int]], costs: np.ndarray, languages: Sequence[str]) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of the stretches on the cheapest path; a stretch is at least a sentence.

    A stretch too short for a sentence belongs to its neighbour: terms, names
    and addresses are no language of their own. Where the whole text is shorter
    than a sentence it is one stretch.
    """
    if not len(spans):
        return []
    if len(spans) == 1:
        path = [int(costs[0].argmin())]
    else:
        best, back = costs[0].copy(), []
        for c in costs[1:]:
            j = int(best.argmin())
            stay = best <= best[j] + SWITCH_BITS
            back.append(np.where(stay, np.arange(len(best)), j))
            best = np.where(stay, best, best[j] + SWITCH_BITS) + c
        path = [int(best.argmin())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        path.reverse()
    runs: list[list] = []
    for (start, end), c, j in zip(spans, costs, path):
        if runs and runs[-1][2] == j:
            runs[-1][1] = end
            runs[-1][3] = runs[-1][3] + c
        else:
            runs.append([start, end, j, c.copy()])
    sentence = [_enough(text[r[0] : r[1]], languages[r[2]]) for r in runs]
    if not any(sentence):
        total = costs.sum(axis=0)
        whole = [[spans[0][0], spans[-1][1], int(total.argmin()), total]]
    else:
        keep: list[list] = []
        for r, is_sentence in zip(runs, sentence):
            if is_sentence:
                keep.append(r)
            elif keep:
                keep[-1][1] = r[1]
        keep[0][0] = spans[0][0]
        merged = [keep[0]]
        for r in keep[1:]:
            if r[2] == merged[-1][2]:
                merged[-1][1] = r[1]
                merged[-1][3] = merged[-1][3] + r[3]
            else:
                merged.append(r)
        whole = merged
    out = []
    for start, end, j, c in whole:
        gap = float(np.partition(c, 1)[1] - c[j]) if len(c) > 1 else 64.0
        out.append((start, end, languages[j], float(1 - 0.5 ** (1 + max(gap, 0.0) / 8))))
    return out


def assign_batch(model: Model, texts: Sequence[str | None], chunk_bytes: int = 400_000) -> list[list[tuple[int, int, str, float]]]:
    """The stretches of each text; null and blank texts have none."""
    out: list[list] = []
    at = 0
    while at < len(texts):
        chunk, size = [], 0
        while at < len(texts) and (not chunk or size < chunk_bytes):
            text = texts[at] or ""
            chunk.append(text)
            size += len(text) * 3
            at += 1
        spans = [units_of(t) if t.strip() else [] for t in chunk]
        raws = [t.encode("utf-8", "replace") for t in chunk]
        joined = b"\n" + b"\n".join(raws)
        bits = model.code_lengths(np.frombuffer(joined, dtype=np.uint8))
        sums = np.vstack([np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)])
        offset = 1
        for text, own, raw in zip(chunk, spans, raws):
            if own:
                starts, ends, byte, char = [], [], 0, 0
                for start, end in own:
                    byte += len(text[char:start].encode("utf-8", "replace"))
                    starts.append(byte)
                    byte += len(text[start:end].encode("utf-8", "replace"))
                    ends.append(byte)
                    char = end
                costs = sums[offset + np.array(ends)] - sums[offset + np.array(starts)]
                out.append(segments(text, own, costs, model.languages))
            else:
                out.append([])
            offset += len(raw) + 1
    return out


def train(samples: Sequence[str], seeds: dict[str, str] = SEEDS, max_chars: int = 40_000, margin: float = 0.5) -> Model:
    """Models of the seeds, then models of what those recognise in the samples.

    A sentence of the samples teaches a language when its code is shorter than
    under every other language by ``margin`` bits a byte.
    """
    first = Model(seeds)
    learnt = {k: [v] for k, v in seeds.items()}
    size = {k: len(v) for k, v in seeds.items()}
    for text, found in zip(samples, assign_batch(first, samples)):
        for start, end, lang, confidence in found:
            part = text[start:end]
            if size[lang] < max_chars and confidence > 0.99 and _enough(part, lang):
                learnt[lang].append(part)
                size[lang] += len(part)
    return Model({k: "\n".join(v) for k, v in learnt.items()})


def training_sample(df: DataFrame, text_col: str, rows: int = 3000) -> list[str]:
    """A bounded sample for the models: the ``rows`` texts of least hash."""
    return [r["value"] for r in least_hashed(df, text_col, rows).collect()]


def primary_language(label: Column) -> Column:
    """The language a label names, without case, region and ``_`` for ``-``; null where it is no language code."""
    first = F.regexp_extract(F.lower(F.trim(label)), "^([a-z]{2,3})([-_][a-z0-9]{1,8})*$", 1)
    return F.when((first != "") & ~first.isin("und", "mul", "mis", "zxx", "unk"), first)


def language_segments(df: DataFrame, model: Model, id_col: str = "record_id", text_col: str = "target_text", label_col: str = "target_lang") -> DataFrame:
    """One row per stretch: record_id, label, start, end, lang, confidence, n_languages, document_lang.

    ``document_lang`` is the language of most characters. One narrow pass, no
    shuffle; whole texts are scored. Records without any text give one row with
    a null language and confidence 0.
    """
    box = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, label, found in zip(pdf["record_id"], pdf["label"], assign_batch(box.value, pdf["text"].tolist())):
                if not found:
                    rows.append((key, label, None, None, None, 0.0, 0, None))
                    continue
                weight: dict[str, int] = {}
                for start, end, lang, _ in found:
                    weight[lang] = weight.get(lang, 0) + end - start
                main = max(weight, key=lambda k: (weight[k], k))
                rows += [(key, label, start, end, lang, confidence, len(weight), main) for start, end, lang, confidence in found]
            frame = pd.DataFrame(rows, columns=["record_id", "label", "start", "end", "lang", "confidence", "n_languages", "document_lang"])
            yield frame.astype({"start": "Int32", "end": "Int32", "n_languages": "int32"})

    source = df.select(F.col(f"`{id_col}`").alias("record_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(df.dtypes)[id_col]
    return source.mapInPandas(run, f"record_id {kind}, label string, start int, end int, lang string, confidence double, n_languages int, document_lang string")


def mislabelled(found: DataFrame) -> DataFrame:
    """(record_id, lang) where the label is missing or wrong or the text holds sentences of several languages."""
    own = F.regexp_extract("document_lang", "^[a-z]+", 0)
    wrong = ~F.coalesce(primary_language(F.col("label")) == own, F.lit(False))
    return found.filter(F.col("lang").isNotNull() & (wrong | (F.col("n_languages") > 1))).select("record_id", "lang").distinct()
