"""Passages of test items inside documents, literal up to a budget of word edits.

A passage is `window` consecutive words of an item. Items are cut into pieces so short that every window holds budget + 1 whole ones; at most budget of them can
be edited, so one stands in the document as it is. Documents are walked once, however many items there are: the hashes of all pieces make one bitmap of bounded
size, and where a document's words hash to a piece, the words around are joined with the pieces by the full hash. Myers' bit-parallel
distance over words verifies each such alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.llm.words import MAX_BITS, bitmap, bits_for, words
from corpuslathe.runtime import count_up_to, materialize

#: Up to this many pieces are broadcast to the hits; beyond it both are shuffled, hits with a salt.
BROADCAST_PIECES = 100_000
SALTS = 16
_CACHE_WORDS = 1_000_000


def piece_length(window: int, budget: int) -> int:
    """Longest piece such that every window holds budget + 1 whole pieces, wherever it starts."""
    return (window + 1) // (budget + 2)


def myers(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(smallest edit distance of the pattern to any stretch of the text, end of the first such stretch)."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, at = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & mask, (mh << 1) & mask  # a stretch may begin anywhere: no cost to come in
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        if score < best:
            best, at = score, j + 1
    return best, at


class _Hasher:
    """64-bit hashes of the word sequences of a fixed length at each place of a text; a word's hash is kept between texts (up to a bound of memory)."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, {}
        with np.errstate(over="ignore"):
            self.mult = np.cumprod(np.full(size, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def words(self, ws: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE_WORDS:
            known.clear()
        new = {w for w in ws if w not in known}
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))

    def places(self, hashed: np.ndarray) -> np.ndarray:
        n = len(hashed) - self.size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            s = np.zeros(n, np.uint64)
            for j in range(self.size):
                s += hashed[j : j + n] * self.mult[j]
            s ^= s >> np.uint64(31)
            s *= np.uint64(0x94D049BB133111EB)
            s ^= s >> np.uint64(29)
        return s


def _bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _pieces(window: int, size: int):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = _Hasher(size)
        for b in batches:
            rows = []
            for i, t in zip(b["i"], b["t"], strict=True):
                ws = words(t)
                if len(ws) < window:
                    continue
                hs = h.words(ws)
                at = h.places(hs)
                for p in range(0, len(ws) - size + 1, size):
                    # the words of all windows that hold the piece; a word is its hash from here on
                    first = max(0, p + size - window)
                    rows.append((int(at[p].astype(np.int64)), i, p, first, hs[first : p + window].astype(np.int64).tobytes()))
            yield pd.DataFrame(rows, columns=["h", "i", "p", "first", "around"])

    return run


def _hits(known: np.ndarray, bits: int, window: int, size: int, budget: int):  # noqa: ANN202
    """The places of documents (d, t) whose words hash to a piece, as far as the bitmap tells, with the words around."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = _Hasher(size)
        reach = window - size + budget
        for b in batches:
            rows = []
            for d, t in zip(b["d"], b["t"], strict=True):
                ws = words(t)
                if len(ws) < size:
                    continue
                hs = h.words(ws)
                at = h.places(hs)
                bit = _bit(at, bits)
                for q in np.flatnonzero(known[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).tolist():
                    first = max(0, q - reach)
                    rows.append((int(at[q].astype(np.int64)), d, q, first, hs[first : q + size + reach].astype(np.int64).tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["h", "d", "q", "left", "region"])

    return run


def _verified(window: int, budget: int, size: int):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, d, p, first, around, q, left, region in zip(*(b[c] for c in ("item_id", "doc_id", "p", "first", "around", "q", "left", "region")), strict=True):
                got = verify(np.frombuffer(around, np.int64).tolist(), first, p, np.frombuffer(region, np.int64).tolist(), left, q, window, budget, size)
                if got is not None:
                    rows.append((i, d, *got))
            yield pd.DataFrame(rows, columns=["item_id", "doc_id", "distance", "item_word", "doc_word"])

    return run


def verify(around: list[int], first: int, p: int, region: list[int], left: int, q: int, window: int, budget: int, size: int) -> tuple[int, int, int] | None:
    """(distance, first word of the item's window, first word in the document) of the best window that holds the piece at p, which stands at q in the document.

    around: the item's words from `first` on; region: the document's words from `left` on.
    """
    lo, hi = max(0, p + size - window), min(p, first + len(around) - window)
    if lo > hi:
        return None
    there = set(region[max(0, q - (p - lo) - budget - left) : q + (hi + window - p) + budget - left])
    have = [c in there for c in around[lo - first : hi + window - first]]
    found, count = None, sum(have[: window - 1])
    for s in range(lo, hi + 1):
        count += have[s - lo + window - 1]
        if count >= window - budget:
            a = max(0, q - (p - s) - budget)
            dist, end = myers(around[s - first : s - first + window], region[a - left : q + (s + window - p) + budget - left])
            if dist <= budget and (found is None or dist < found[0]):
                found = (dist, s, max(a, a + end - window))
                if dist == 0:
                    break
        count -= have[s - lo]
    return found


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 15, budget: int = 2, broadcast_pieces: int = BROADCAST_PIECES, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct (item_id, doc_id, distance, item_word, doc_word): documents holding a window of an item within `budget` word edits.

    distance is the smallest over the item's windows, item_word and doc_word where that window begins (words from 0; doc_word
    exact for distance 0). Items of fewer words than the window, and null or empty texts on either side, match nothing.
    Equal ids on several rows count as one each. Any number of items: documents are read once, and never split, sampled or cut. Words compare by 64-bit hashes.
    """
    size = piece_length(window, budget)
    if size < 1:
        raise ValueError("the error budget is too large for the window")
    src = items.select(F.col(item_id).alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct()
    docs = documents.select(F.col(doc_id).alias("d"), F.col(doc_text).cast("string").alias("t")).where("d is not null and t is not null")
    i_type, d_type = src.schema["i"].dataType.simpleString(), docs.schema["d"].dataType.simpleString()
    pieces = materialize(src.mapInPandas(_pieces(window, size), f"h bigint, i {i_type}, p int, first int, around binary").distinct(), "pieces")
    n = pieces.count()
    bits = bits_for(n, max_bits)
    hits = docs.mapInPandas(_hits(bitmap(pieces, bits), bits, window, size, budget), f"h bigint, d {d_type}, q int, left int, region binary")
    hits, pieces = hits.withColumnRenamed("d", "doc_id"), pieces.withColumnRenamed("i", "item_id")
    if count_up_to(pieces, broadcast_pieces) <= broadcast_pieces:
        both = hits.join(F.broadcast(pieces), "h")
    else:  # one piece may stand in a third of all documents
        salted = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        both = salted.join(pieces.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["h", "salt"]).drop("salt")
    out = both.mapInPandas(_verified(window, budget, size), f"item_id {i_type}, doc_id {d_type}, distance int, item_word int, doc_word int")
    least = out.groupBy("item_id", "doc_id").agg(F.min(F.struct("distance", "item_word", "doc_word")).alias("m"))
    return least.select("item_id", "doc_id", "m.distance", "m.item_word", "m.doc_word")
