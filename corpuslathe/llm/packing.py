"""Documents into training sequences of fixed capacity with little unused space.

Best fit, bulk-synchronously: items are range-sorted by size and numbered, gaps are kept in order of their width, and one step
per size, from large to small, gives all items of that size the closest gaps that hold them; conflicts between equal items are settled
by rank. Gaps of equal width are alike, so they are held as runs (width, first bin, number of bins). There are never more
runs than a function of the capacity, whatever the number of documents: the sweep over them is small and is done once, at the
driver, from the counts per size; what grows with the data (sizes, sort, ranks, assignment) is distributed.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.runtime import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the split pattern published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):  # noqa: ANN202
    """The tokenizer of a vocabulary file, built once a process."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, id_col: str, text_col: str, vocabulary: str = TOKENIZER) -> DataFrame:
    """(id, n_tokens) of a public byte-pair vocabulary file, which every executor must be able to read; null text: 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from corpuslathe.llm import packing  # the module of the worker, so that its cache outlives the task

        enc = packing._encoder(vocabulary)
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in b["t"]]})

    # ids travel as strings: a null among numbers would make pandas read them as floats
    src = documents.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInPandas(run, "id string, n_tokens bigint").withColumn("id", F.col("id").cast(documents.schema[id_col].dataType))


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[pd.DataFrame, int]:
    """(plan, bins): for counts of items by size, which ranks of a size go to which bins.

    A row (size, first, n, per_bin, bin, offset): ranks first .. first + n - 1 go, per_bin to a bin, to the bins from `bin` on, at
    `offset` and the steps of `size` after it. This is best-fit decreasing: each item goes to the narrowest gap that holds it.
    """
    widths: list[int] = []  # sorted widths that have runs
    runs: dict[int, list[tuple[int, int]]] = {}
    rows, bins = [], 0

    def put(width: int, first: int, n: int) -> None:
        if width > 0 and n > 0:
            if width not in runs:
                bisect.insort(widths, width)
                runs[width] = []
            runs[width].append((first, n))

    for size in sorted((s for s in counts if s > 0), reverse=True):
        left, rank = counts[size], 0
        at = bisect.bisect_left(widths, size)
        made: list[tuple[int, int, int]] = []  # gaps this step leaves; narrower than size, or the last item's bin
        while left and at < len(widths):
            width = widths[at]
            per = width // size
            stack = runs[width]
            while left and stack:
                first, n = stack.pop()
                full = min(n, left // per)
                if full:
                    rows.append((size, rank, full * per, per, first, capacity - width))
                    rank, left = rank + full * per, left - full * per
                    made.append((width - per * size, first, full))
                    first, n = first + full, n - full
                if n and left:  # fewer than a bin's worth
                    rows.append((size, rank, left, left, first, capacity - width))
                    made.append((width - left * size, first, 1))
                    rank, left, first, n = rank + left, 0, first + 1, n - 1
                if n:
                    stack.append((first, n))
            if not stack:
                del runs[width]
                widths.pop(at)
        if left:
            per = capacity // size
            full, rest = divmod(left, per)
            if full:
                rows.append((size, rank, full * per, per, bins, 0))
                made.append((capacity - per * size, bins, full))
            if rest:
                rows.append((size, rank + full * per, rest, rest, bins + full, 0))
                made.append((capacity - rest * size, bins + full, 1))
            bins += full + (rest > 0)
        for m in made:
            put(*m)
    return pd.DataFrame(rows, columns=["size", "first", "n", "per_bin", "bin", "offset"], dtype="int64"), bins


def pack(sizes: DataFrame, id_col: str = "id", size_col: str = "n_tokens", capacity: int = 2_048) -> DataFrame:
    """One row per item, or per piece of an item longer than the capacity: id, piece, piece_start, n_tokens, sequence, position.

    An item longer than the capacity is cut into full sequences and one rest, which is packed as any other item; others are never
    split. position is the piece's first place in its sequence. Sizes of null, zero or less take no space: sequence and position are null.
    Repeated ids are separate items. Ties in size are placed in the order of their ids. Empty table: nothing.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    base = sizes.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0)).alias("n"))
    cuts = F.when(F.col("n") <= capacity, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(capacity).cast("bigint")))
    base = materialize(base, "sizes")  # the range sort reads its input twice
    items = base.select("id", "n", F.posexplode(cuts).alias("piece", "piece_start")).select("id", "piece", "piece_start", F.least(F.col("n") - F.col("piece_start"), F.lit(capacity)).cast("int").alias("n_tokens"))
    order = [F.col("n_tokens").desc(), F.col("id"), F.col("piece")]
    ranged = materialize(items.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranged")
    # number of a row = rows in earlier ranges + its place in its own; of its size, less the rows of larger sizes
    per_range = ranged.groupBy(F.shiftright("at", 33).alias("r")).count().collect()
    per_size = ranged.groupBy("n_tokens").count().collect()
    before, total = {}, 0
    for r, n in sorted((x["r"], x["count"]) for x in per_range):
        before[r], total = total, total + n
    counts = {x["n_tokens"]: x["count"] for x in per_size}
    larger, total = {}, 0
    for s in sorted(counts, reverse=True):
        larger[s], total = total, total + counts[s]
    plan, _ = best_fit_plan(counts, capacity)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = plan.sort_values(["size", "first"])
        wide = int(p["first"].max() + 1) if len(p) else 1
        starts = p["size"].to_numpy() * wide + p["first"].to_numpy()
        col = {c: p[c].to_numpy() for c in p}
        for b in batches:
            size, at = b["n_tokens"].to_numpy().astype(np.int64), b["at"].to_numpy()
            rank = np.array([before[r] for r in (at >> 33)], np.int64) + (at & ((1 << 33) - 1)) - np.array([larger[s] for s in size], np.int64)
            some = size > 0
            i = np.zeros(len(b), np.int64)
            i[some] = np.searchsorted(starts, size[some] * wide + np.minimum(rank[some], wide - 1), side="right") - 1
            if not some.any():
                seq, pos = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            else:
                j = rank - col["first"][i]
                seq = col["bin"][i] + j // col["per_bin"][i]
                pos = col["offset"][i] + (j % col["per_bin"][i]) * size
            yield pd.DataFrame({"id": b["id"], "piece": b["piece"], "piece_start": b["piece_start"], "n_tokens": b["n_tokens"], "sequence": pd.Series(seq, dtype="Int64").where(some), "position": pd.Series(pos, dtype="Int64").where(some)})

    id_type = items.schema["id"].dataType
    out = ranged.withColumn("id", F.col("id").cast("string")).mapInPandas(assign, "id string, piece int, piece_start bigint, n_tokens int, sequence bigint, position bigint")
    return out.withColumn("id", F.col("id").cast(id_type))


def packing_report(packed: DataFrame, capacity: int = 2_048) -> DataFrame:
    """One row: items, tokens, sequences, full_sequences, unused_tokens, fill (share of the capacity that is used)."""
    per = packed.where("sequence is not null").groupBy("sequence").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
    return per.agg(
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"),
        F.count("*").alias("sequences"),
        F.count_if(F.col("used") == capacity).alias("full_sequences"),
        (F.count("*") * capacity - F.coalesce(F.sum("used"), F.lit(0))).alias("unused_tokens"),
        F.try_divide(F.sum("used"), F.count("*") * capacity).alias("fill"),
    )
