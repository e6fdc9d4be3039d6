"""Words and word sequences, as all operators here count them.

A word is a run of letters and digits in lower case; each Han or kana character is a word of its own;
everything else only separates.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A bitmap has about 128 bits a member, within these bounds (in powers of two): it never takes more than 16 MB; fuller, it lets more through.
MIN_BITS, MAX_BITS = 16, 27

#: Han and kana ranges (iteration and closing marks that are letters included).
HAN_KANA = "々-〇ぁ-ゖゝ-ゟァ-ヺー-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
_WORD = re.compile(f"[{HAN_KANA}]|[^\\W_{HAN_KANA}]+")
_CACHE_WORDS = 1_000_000


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Shingler:
    """64-bit hashes of word sequences of a fixed width; a word's hash is kept between texts (up to a bound of memory)."""

    def __init__(self, width: int) -> None:
        self.width, self.known = width, {}
        with np.errstate(over="ignore"):
            self.mult = np.cumprod(np.full(width, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)

    def sequences(self, text: str | None) -> np.ndarray:
        """The distinct sequences of the text, sorted; none if it has fewer words than the width."""
        ws = words(text)
        n = len(ws) - self.width + 1
        if n <= 0:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > _CACHE_WORDS:
            known.clear()
        h = np.empty(len(ws), np.uint64)
        for i, w in enumerate(ws):
            v = known.get(w)
            if v is None:
                v = known[w] = xxhash.xxh3_64_intdigest(w)
            h[i] = v
        with np.errstate(over="ignore"):
            s = np.zeros(n, np.uint64)
            for j in range(self.width):
                s += h[j : j + n] * self.mult[j]
            s ^= s >> np.uint64(29)
            s *= np.uint64(0xBF58476D1CE4E5B9)
            s ^= s >> np.uint64(32)
        return np.unique(s.view(np.int64))


def bits_for(members: int, most: int = MAX_BITS) -> int:
    return min(max(MIN_BITS, (128 * max(1, members)).bit_length()), most)


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The first `bits` bits of all hashes (column h) as a bitmap; 4 KB for each 32,768 numbers reach the driver, 16 MB at most."""
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    number = F.shiftrightunsigned("h", 64 - bits)
    got = hashes.select(number.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    for r in got.collect():
        # buckets hold the numbers from 1 on: number b stands in bucket b / 32768 + 1 at (b - 1) mod 32768
        at = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["m"]), np.uint8), bitorder="little")) + (r["bucket"] - 1) * 32_768 + 1
        if r["bucket"] == 0:
            at = np.zeros(1, np.int64)
        np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out
