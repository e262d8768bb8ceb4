"""Evaluation texts inside training texts, by winnowing.

Texts become runs of tokens (words, or single letters for scripts without spaces) after case, accents,
punctuation, invisible characters and inline mark-up are taken away. Of every window of k-gram hashes the
smallest is kept as a fingerprint, so two texts that share ``span`` tokens in a row always share a
fingerprint. Fingerprints of items and documents are joined; each hit outside the runs found before it is
extended in both directions over equal tokens and counts if the shared run is long enough. A document is
tokenised once for the fingerprints of both units, and again only if some fingerprint hits. No document's
fingerprints leave the executors, and the items' side is broadcast only where its written size is small.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellon.session import Scratch

if TYPE_CHECKING:
    import pandas as pd


@dataclass(frozen=True)
class Unit:
    """``chars``: single letters and digits are the tokens, else words. A shared run of ``span`` tokens is a leak."""

    name: str
    span: int
    gram: int
    chars: bool = False

    @property
    def window(self) -> int:
        return self.span - self.gram + 1


WORDS = Unit("words", 12, 6)
CHARS = Unit("chars", 24, 12, chars=True)

# HTML elements that part words; all other tags lie inside the running text.
_BLOCK = "br|p|div|li|ul|ol|tr|td|th|table|h[1-6]|hr|section|article|blockquote|pre|dd|dt|dl"
BLOCK_TAG = rf"</?(?:{_BLOCK})\b[^<>]*>"
TAG = r"</?[A-Za-z][^<>]*>|<!--.*?-->"
_BLOCK_TAG, _TAG = re.compile(BLOCK_TAG, re.I), re.compile(TAG, re.S)
_GAP = re.compile(r"[\W_]+")
_MARKS = re.compile("[*_]")


@lru_cache(1)
def _odd() -> frozenset[str]:
    """Accents, vowel signs and invisible characters: they part no word."""
    return frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Mn", "Mc", "Me", "Cf"))


def clean(text: str | None) -> str:
    """The words of a text with a space between each two."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub("", _BLOCK_TAG.sub(" ", text))
    text = _MARKS.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.casefold())
        for c in _odd().intersection(text):
            text = text.replace(c, "")
    return _GAP.sub(" ", text.casefold()).strip()


def tokens(text: str | None, chars: bool = False) -> list[str]:
    words = clean(text)
    return list(words.replace(" ", "")) if chars else words.split()


def hashed(texts: list[str], chars: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every token of many cleaned texts."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    inside = (codes != 32) & (codes != 10)
    owner = np.cumsum(codes == 10)
    if chars:
        h = (codes[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29)), owner[inside]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.array([], np.uint64), np.array([], np.int64)
    codes, inside, owner, starts = codes[starts[0] :], inside[starts[0] :], owner[starts[0] :], starts - starts[0]
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    power = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    h = np.add.reduceat(np.where(inside, (codes.astype(np.uint64) + np.uint64(1)) * power[place], np.uint64(0)), starts)
    return h ^ (h >> np.uint64(31)), owner[starts]


_P, _P_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_LOW = np.uint64((1 << 24) - 1)


def winnow(h: np.ndarray, owner: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash) of the fingerprints of many texts at once, from ``hashed``."""
    none = np.array([], np.int64)
    if len(h) < unit.span:
        return none, none, none
    # a gram's hash is a difference of two prefix sums of h * P^i, divided by P^i
    power, inverse = (np.cumprod(np.full(len(h), x, np.uint64)) for x in (_P, _P_INVERSE))
    sums = np.cumsum(h * power)
    g = sums[unit.gram - 1 :].copy()
    g[1:] -= sums[: -unit.gram]
    g = g * inverse[: len(g)] + np.uint64(unit.gram)  # fingerprints of two units differ
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    # the least of each window, the rightmost of equal ones: places count down in the low bits
    place = np.arange(len(g), dtype=np.uint64)
    least = (g & ~_LOW) | (_LOW - (place & _LOW))
    width = 1
    while 2 * width <= unit.window:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < unit.window:
        least = np.minimum(least[: width - unit.window], least[unit.window - width :])
    wins = len(least)
    at = (place[:wins] + ((_LOW - (least & _LOW) - place[:wins]) & _LOW)).astype(np.int64)
    whole = owner[:wins] == owner[unit.span - 1 : unit.span - 1 + wins]  # windows inside one text
    at = np.unique(at[whole])
    first = np.searchsorted(owner, owner[at])
    return owner[at], at - first, g[at].view(np.int64)


def _fingerprint(units: tuple[Unit, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for pdf in batches:
            for a in range(0, len(pdf), 2000):
                part = pdf.iloc[a : a + 2000]
                texts = [clean(t) for t in part["_text"]]
                for unit in units:
                    who, pos, h = winnow(*hashed(texts, unit.chars), unit)
                    yield pd.DataFrame({"_id": part["_id"].to_numpy()[who], "pos": pos, "h": h})

    return run


def run_length(a: list[str], b: list[str], i: int, j: int) -> tuple[int, int]:
    """Start in ``a`` and length of the shared run through a[i] and b[j]."""
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    right = 0
    while i + right < len(a) and j + right < len(b) and a[i + right] == b[j + right]:
        right += 1
    return i - left, left + right


def longest_run(a: list[str], b: list[str], hits: list[tuple[int, int]]) -> tuple[int, int]:
    """(length, -start in ``a``) of the longest shared run through a hit, the first of equally long ones."""
    best, diagonal, end = (0, 0), None, 0
    for d, pos in sorted((i - j, i) for i, j in hits):
        if d == diagonal and pos < end:  # inside the run of an earlier hit
            continue
        if pos < len(a) and a[pos] == b[pos - d]:
            at, n = run_length(a, b, pos, pos - d)
            best, diagonal, end = max(best, (n, -at)), d, at + n
    return best


def _extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by document: its texts, then its items. One document's texts and one item are held at a time."""
    import pandas as pd

    doc, texts, items = None, [], {}
    for pdf in batches:
        rows = []
        for key, text, item, chars, hits in zip(pdf["_id"], pdf["_text"], pdf["item"], pdf["chars"], pdf["hits"]):
            if hits is None:
                if key != doc:
                    doc, texts = key, []
                texts.append({False: tokens(text), True: None, "text": text})
                continue
            unit = CHARS if chars else WORDS
            if (item, chars) not in items:
                items = {} if len(items) > 1000 else items
                items[item, chars] = tokens(text, unit.chars)
            best = (0, 0)
            for t in texts if key == doc else ():
                if unit.chars and t[True] is None:
                    t[True] = tokens(t["text"], True)
                best = max(best, longest_run(t[unit.chars], items[item, chars], [(x["pos"], x["item_pos"]) for x in hits]))
            if best[0] >= unit.span:
                rows.append((key, item, best[0], -best[1]))
        yield pd.DataFrame(rows, columns=["_id", "item", "shared", "at"])


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, scratch: Scratch, chars: Column | None = None) -> DataFrame:
    """doc_key, item_key, shared (tokens of the longest shared run), at (its first token in the document):
    one row per document key and item that share ``WORDS.span`` words in a row, or ``CHARS.span`` letters
    where ``chars`` (a column of ``items``) is true.

    Texts that are null, blank or shorter than the span hold and are held by nothing. Documents of equal
    text give a row each; a repeated document key gives one row per item that any of its rows holds. Items'
    keys must be unique. Rows with a null key are left out, other columns are ignored.
    """
    dt, it = docs.schema[doc_key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    d = docs.where(F.col(doc_text).isNotNull() & F.col(doc_key).isNotNull()).select(F.col(doc_key).alias("_id"), F.col(doc_text).alias("_text"))
    by_char = F.lit(False) if chars is None else F.coalesce(chars, F.lit(False))
    q = items.where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).select(F.col(item_key).alias("_id"), F.col(item_text).alias("_text"), by_char.alias("chars"))
    prints = None
    for unit in (WORDS, CHARS):
        part = q.where(F.col("chars") == unit.chars).select("_id", "_text").mapInPandas(_fingerprint((unit,)), f"_id {it}, pos int, h bigint")
        prints = part if prints is None else prints.unionByName(part)
    prints = scratch.write(prints.select(F.col("_id").alias("item"), F.col("pos").alias("item_pos"), "h"), "item_prints")
    units = (WORDS,) if chars is None else (WORDS, CHARS)
    found = d.mapInPandas(_fingerprint(units), f"_id {dt}, pos int, h bigint").join(prints, "h")
    # all hits of a pair: an unequal token parts the runs of a diagonal, and any of them may be the long one
    hits = scratch.write(found.groupBy("_id", "item").agg(F.collect_set(F.struct("pos", "item_pos")).alias("hits")), "hits")
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    texts = d.join(hits.select("_id").distinct(), "_id", "left_semi").select("_id", "_text", none("item", it), none("chars", "boolean"), none("hits", hits.schema["hits"].dataType))
    pairs = hits.join(q.withColumnRenamed("_id", "item"), "item").select("_id", "_text", "item", "chars", "hits")
    merged = texts.unionByName(pairs).repartition("_id").sortWithinPartitions("_id", F.col("item").asc_nulls_first())
    out = merged.mapInPandas(_extend, f"_id {dt}, item {it}, shared int, at int")
    return out.select(F.col("_id").alias(doc_key), F.col("item").alias(item_key), "shared", "at")
