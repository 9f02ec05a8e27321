"""Content keys: SHA-256 over separated parts, as each stage defines them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paralode.functions.normalize import merge_text, page_text, pool_text, sft_text, side_key, wiki_text
from paralode.functions.text import casefold, nfc

UNIT, RECORD = "\u001f", "\u001e"


def _col(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def sha256(*parts: Column, separator: str = UNIT) -> Column:
    return F.sha2(F.concat_ws(separator, *parts), 256)


def pool_pair(zh: Column | str, en: Column | str, normalized: bool = False) -> Column:
    """Chinese text and case-folded English text; ``normalized`` says that both are in pool form already."""
    zh, en = (_col(zh), _col(en)) if normalized else (pool_text(zh), pool_text(en))
    return sha256(zh, casefold(en))


def tsv_pair(zh: Column | str, en: Column | str) -> Column:
    """As the pool key with the sides the other way round."""
    return sha256(casefold(_col(en)), _col(zh))


def merge_pair(zh: Column | str, th: Column | str) -> Column:
    """zh-th pair as it stands, case kept."""
    return sha256(_col(zh), _col(th))


def exact_pair(zh: Column | str, th: Column | str) -> Column:
    return sha256(merge_text(zh), casefold(merge_text(th)))


def loose_pair(zh: Column | str, th: Column | str) -> Column:
    return sha256(side_key(zh), side_key(th))


def submission_pair(zh: Column | str, th: Column | str) -> Column:
    return sha256(nfc(_col(zh)), casefold(nfc(_col(th))))


def pair_group(source_lang: Column | str, source: Column | str, target_lang: Column | str, target: Column | str, form=sft_text) -> Column:
    """The same id for a pair in either direction."""
    side = lambda lang, text: F.concat_ws(RECORD, _col(lang), casefold(form(text)))
    a, b = side(source_lang, source), side(target_lang, target)
    first = F.struct(_col(source_lang), a) <= F.struct(_col(target_lang), b)
    return F.concat(F.lit("pair_"), sha256(F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)))


def chunk_id(domain: Column | str, lang: Column | str, text: Column | str) -> Column:
    return F.concat(F.lit("clean_"), F.substring(sha256(_col(domain), _col(lang), _col(text)), 1, 20))


def page_id(url: Column | str) -> Column:
    return F.concat(F.lit("raw_"), F.substring(F.sha2(_col(url), 256), 1, 16))


def candidate_id(zh: Column | str) -> Column:
    return F.substring(F.sha2(casefold(merge_text(zh)), 256), 1, 24)


def mono_id(text: Column | str) -> Column:
    return F.sha2(wiki_text(text), 256)


def page_key(text: Column | str) -> Column:
    return F.lower(page_text(text))


def batch_id(domain: Column | str, direction: Column | str, ids: Column | str) -> Column:
    """Of an ordered array of record ids."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.substring(F.sha2(F.concat_ws("\n", _col(domain), _col(direction), F.array_join(ids, "\n")), 256), 1, 20)


def lineage_key(*columns: Column | str) -> Column:
    """Compact JSON with sorted keys of a source reference."""
    named = sorted((c if isinstance(c, str) else str(c), c) for c in columns)
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for _, c in named]))
