"""Near-duplicate texts by word sequences: all pairs at or above a Jaccard similarity, without comparing all pairs.

The document by sequence incidence matrix A is multiplied with its transpose in blocks. A block of rows is some documents, as one record of arrays: its distinct
sequences and, for each document, where its own are among them; a block of columns is a range of sequences. Columns run from rare to frequent. Two documents
that are similar share at least 1 + need // SPARE columns among the first of both, need being the overlap that their sizes demand. So the product is taken block by
block over those head columns, overlap counts accumulate as packed arrays, and size-derived bounds discard pairs as they arise and after the blocks have been summed. For
the pairs that are left the product goes on over the remaining columns, in blocks of documents that have partners in common. Documents with equal sets are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.llm.formatdup import pairs_within
from corpuslathe.llm.words import Shingler
from corpuslathe.runtime import count_up_to, discard, materialize, small_rows

#: Cells of a block of rows, and documents it may have; cells of a block of columns, which a task takes one by one.
ROW_BLOCK_CELLS, ROW_BLOCK_DOCS = 500_000, 1 << 20
COLUMN_BLOCK_CELLS = 500_000
#: Pairs that a task holds before it counts them, or gives the counts out in parts; slices of the pairs for each block of columns.
HELD_PAIRS, SLICES = 1_000_000, 8
#: Documents of one head column that meet in one task, and pairs that are completed together.
BLOCK = 2_000
PAIRS = 20_000
#: A similar pair shares one head column more for each so many sequences that it must have in common: heads grow a little, chance pairs fall away.
SPARE = 25
BROADCAST_ROWS = 50_000
#: Classes of frequency: exact up to 127 documents, then by doublings.
_EXACT = 127


def _pressed(v: np.ndarray) -> bytes:
    """The numbers compressed, equal bytes of them together; `_loose` reverses it."""
    return len(v).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(v).view(np.uint8).reshape(len(v), -1).T.tobytes(), codec="zstd", asbytes=True) if len(v) else b""


def _loose(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    n, width = int.from_bytes(data[:4], "little"), np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data[4:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T).view(kind)[:, 0]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def sequence_blocks(rows: DataFrame, id_col: str, text_col: str, width: int, cells: int = ROW_BLOCK_CELLS) -> DataFrame:
    """Blocks of rows: (block, ids, h1, h2, sizes, grams, counts, local). Texts with fewer words than the width are left out.

    Document number p of a block is block << 20 | p. h1, h2: hash of its set. grams: the block's distinct sequences, sorted, and counts: how many of its
    documents have each. local: for each document its places in grams, as steps, pressed.
    """

    def block(number: int, ids: list, sets: list[np.ndarray]) -> pd.DataFrame:
        sizes = np.array([len(x) for x in sets], np.int32)
        grams, inverse, counts = np.unique(np.concatenate(sets).view(np.uint64), return_inverse=True, return_counts=True)
        local, at = np.empty(len(inverse), np.uint32), _starts(sizes)
        for a, b in zip(at[:-1], at[1:], strict=True):
            own = np.sort(inverse[a:b])
            local[a:b] = np.diff(own, prepend=0)
        digests = [xxhash.xxh3_128_intdigest(x.tobytes()) for x in sets]
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        return pd.DataFrame({"block": [number], "ids": [ids], "h1": [[signed(d >> 64) for d in digests]], "h2": [[signed(d & (1 << 64) - 1) for d in digests]], "sizes": [sizes.tolist()], "grams": [grams.tobytes()], "counts": [np.minimum(counts, 65_535).astype(np.uint16).tobytes()], "local": [_pressed(local)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sh, number = Shingler(width), TaskContext.get().partitionId() << 24
        ids: list = []
        sets: list[np.ndarray] = []
        held = 0
        for b in batches:
            for i, t in zip(b["id"], b["text"], strict=True):
                own = sh.sequences(t)
                if not len(own):
                    continue
                if ids and (held + len(own) > cells or len(ids) >= ROW_BLOCK_DOCS):
                    yield block(number, ids, sets)
                    number, ids, sets, held = number + 1, [], [], 0
                ids.append(i)
                sets.append(own)
                held += len(own)
        if ids:
            yield block(number, ids, sets)

    id_type = rows.schema[id_col].dataType.simpleString()
    src = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    got = src.mapInPandas(run, f"block bigint, ids array<{id_type}>, h1 array<bigint>, h2 array<bigint>, sizes array<int>, grams binary, counts binary, local binary")
    return materialize(got, "row_blocks")


def classes(blocks: DataFrame) -> DataFrame:
    """(id, rep, n): documents with equal sets form a class of n under its smallest document number."""
    z = blocks.select("block", F.posexplode(F.arrays_zip("ids", "h1", "h2", "sizes")).alias("p", "z"))
    keyed = z.select(F.col("z.ids").alias("id"), (F.shiftleft("block", 20) + F.col("p")).alias("doc"), F.col("z.h1").alias("h1"), F.col("z.h2").alias("h2"), F.col("z.sizes").alias("size"))
    on = ["h1", "h2", "size"]
    rep = materialize(keyed.groupBy(*on).agg(F.min("doc").alias("rep"), F.count("*").alias("n")), "classes")
    # a class may hold a third of all documents: large ones, of which there are few, come by broadcast
    large = rep.where(F.col("n") > BLOCK)
    if 0 < count_up_to(large, BROADCAST_ROWS) <= BROADCAST_ROWS:
        both = keyed.join(F.broadcast(large), on, "left")
        done = both.where("rep is not null").select("id", "rep", "n")
        rest = both.where("rep is null").drop("rep", "n").join(rep.where(F.col("n") <= BLOCK), on).select("id", "rep", "n")
        return materialize(done.unionByName(rest), "members")
    return materialize(keyed.join(rep, on).select("id", "rep", "n"), "members")


def _split(parts: int):  # noqa: ANN202
    """A block's sequences and counts by blocks of columns."""
    edges = (np.arange(1, parts, dtype=np.float64) / parts * 2.0**64).astype(np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for number, grams, counts in zip(b["block"], b["grams"], b["counts"], strict=True):
                g, c = np.frombuffer(grams, np.uint64), np.frombuffer(counts, np.uint16)
                cut = np.concatenate([[0], np.searchsorted(g, edges), [len(g)]])
                yield pd.DataFrame({"part": np.arange(parts), "block": number, "grams": [g[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], "counts": [c[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]})

    return run


def _frequency_class(df: np.ndarray) -> np.ndarray:
    """0 for a sequence of one document alone, then rising with frequency."""
    return np.where(df <= _EXACT, df - 1, _EXACT + np.ceil(np.log2(np.maximum(df, 1) / _EXACT) * 3)).astype(np.uint8)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (part, block, grams, counts) sorted by part to (block, part, kinds, numbers): for each sequence its class of frequency and, if others have it too, its number in the part (as steps)."""

    def told(part: int, held: list) -> pd.DataFrame:
        grams = [np.frombuffer(g, np.uint64) for _, g, _ in held]
        every, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        df = np.bincount(inverse, np.concatenate([np.frombuffer(c, np.uint16) for _, _, c in held]), len(every))
        kind = _frequency_class(df)
        number = np.cumsum(kind > 0) - 1
        kinds, numbers, at = [], [], _starts([len(g) for g in grams])
        for a, b in zip(at[:-1], at[1:], strict=True):
            own = inverse[a:b]
            k = kind[own]
            kinds.append(k.tobytes())
            numbers.append(_pressed(np.diff(number[own[k > 0]], prepend=0).astype(np.uint32)))
        return pd.DataFrame({"block": [x[0] for x in held], "part": part, "kinds": kinds, "numbers": numbers})

    part, held = None, []
    for b in batches:
        for p, block, g, c in zip(b["part"], b["block"], b["grams"], b["counts"], strict=True):
            if held and p != part:
                yield told(part, held)
                held = []
            part = p
            held.append((block, g, c))
    if held:
        yield told(part, held)


def _heads(t: float):  # noqa: ANN202
    """Rows of one block, sorted by kind (0: classes of frequency by part, 1: representatives, 2: the block itself), to its documents' columns (kind 0) and head cells (kind 1)."""

    def of(block: int, told: dict[int, tuple[bytes, bytes]], reps: np.ndarray, sizes: np.ndarray, local: np.ndarray) -> Iterator[pd.DataFrame]:
        columns = []
        for p in sorted(told):
            kinds, numbers = np.frombuffer(told[p][0], np.uint8), np.cumsum(_loose(told[p][1], np.uint32), dtype=np.int64)
            c = np.full(len(kinds), -1, np.int64)
            c[kinds > 0] = kinds[kinds > 0].astype(np.int64) << 55 | p << 32 | numbers
            columns.append(c)
        column, at = np.concatenate(columns), _starts(sizes)
        docs, own, cols, heads = [], [], [], []
        for r in reps.tolist():
            n = int(sizes[r])
            c = np.sort(column[np.cumsum(local[at[r] : at[r + 1]], dtype=np.int64)])
            c = c[np.searchsorted(c, 0) :]  # what no other document has comes first in the order and needs no cell
            least = int(np.ceil(t * n - 1e-9))
            take = min(n, n - least + 1 + least // SPARE) - (n - len(c))
            docs.append(block << 20 | r)
            own.append(n)
            cols.append(np.diff(np.sort(c & (1 << 55) - 1), prepend=0).tobytes())
            h = c[: max(take, 0)]
            heads.append((h, np.arange(n - len(c), n - len(c) + len(h), dtype=np.int32)))
        yield pd.DataFrame({"kind": 0, "doc": docs, "size": own, "cols": cols, "docs": None, "sizes": None, "places": None})
        many = np.array([len(h) for h, _ in heads], np.int64)
        if many.sum():
            d, n = np.repeat(np.array(docs, np.int64), many), np.repeat(np.array(own, np.int32), many)
            h, p = np.concatenate([x for x, _ in heads]), np.concatenate([x for _, x in heads])
            yield pd.DataFrame({"kind": [1], "doc": [0], "size": [0], "cols": [h.tobytes()], "docs": [d.tobytes()], "sizes": [n.tobytes()], "places": [p.tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told: dict[int, tuple[bytes, bytes]] = {}
        reps = np.empty(0, np.int64)
        for b in batches:
            for block, kind, part, x, y in zip(b["block"], b["kind"], b["part"], b["x"], b["y"], strict=True):
                if kind == 0:
                    told[part] = (x, y)
                elif kind == 1:
                    reps = np.frombuffer(x, np.int64)
                else:
                    if len(reps):
                        yield from of(block, told, reps, np.frombuffer(x, np.int32), _loose(y, np.uint32))
                    told, reps = {}, np.empty(0, np.int64)

    return run


def _by_columns(parts: int, crowded: dict[int, int]):  # noqa: ANN202
    """A block's head cells by blocks of columns. A crowded column's documents are dealt out, and each two hands meet in a place of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = np.array(sorted(crowded), np.int64)
        for b in batches:
            for cols, docs, sizes, places in zip(b["cols"], b["docs"], b["sizes"], b["places"], strict=True):
                c, d, n, p = np.frombuffer(cols, np.int64), np.frombuffer(docs, np.int64), np.frombuffer(sizes, np.int32), np.frombuffer(places, np.int32)
                group, side = _mixed(c), np.zeros(len(c), np.int8)
                if len(hot):
                    at = np.isin(c, hot)
                    take, groups, sides = [np.flatnonzero(~at)], [group[~at]], [side[~at]]
                    for i in np.flatnonzero(at).tolist():
                        hands = crowded[int(c[i])]
                        own = int(_mixed(d[i : i + 1])[0] % np.uint64(hands))
                        meet = [(min(own, o), max(own, o)) for o in range(hands)]
                        take.append(np.full(hands, i))
                        groups.append(_mixed(np.array([(int(group[i]) + (x << 20 | y) + 1) & (1 << 64) - 1 for x, y in meet], np.uint64)))
                        sides.append(np.array([0 if x == y else 1 + (own == y) for x, y in meet], np.int8))
                    take_, group, side = np.concatenate(take), np.concatenate(groups), np.concatenate(sides)
                    d, n, p = d[take_], n[take_], p[take_]
                part = (group % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(parts + 1))
                own = np.flatnonzero(np.diff(cut))
                by = [order[cut[k] : cut[k + 1]] for k in own.tolist()]
                # half of a column's number will do: two that then look the same only give pairs that are discarded later
                group, block, d = (group >> np.uint64(32)).astype(np.uint32), int(d[0]) >> 20, (d & (1 << 20) - 1).astype(np.uint32)
                yield pd.DataFrame({"part": own, "block": block, "groups": [group[o].tobytes() for o in by], "docs": [d[o].tobytes() for o in by], "sizes": [n[o].tobytes() for o in by], "places": [p[o].tobytes() for o in by], "sides": [side[o].tobytes() for o in by]})

    return run


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        return h * np.uint64(0xD6E8FEB86659FD93)


def need(t: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The overlap that two sets of these sizes need."""
    return np.ceil(t / (1 + t) * (x.astype(np.int64) + y) - 1e-9).astype(np.int64)


def _pack(x: np.ndarray, y: np.ndarray, xs: np.ndarray, ys: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs by rising x, with sizes and counts, in about a quarter of the bytes: equal bytes of the numbers come together."""
    columns = ((np.diff(x, prepend=0), np.int64), (y, np.int64), (xs, np.int32), (ys, np.int32), (n, np.int32))
    return pa.compress(b"".join(np.ascontiguousarray(v, ty).view(np.uint8).reshape(len(x), -1).T.tobytes() for v, ty in columns), codec="zstd", asbytes=True)


def _unpack(n: int, data: bytes) -> list[np.ndarray]:
    flat, out, at = np.frombuffer(pa.decompress(data, 28 * n, codec="zstd", asbytes=True), np.uint8), [], 0
    for width in (8, 8, 4, 4, 4):
        out.append(np.ascontiguousarray(flat[at : at + width * n].reshape(width, n).T).view(np.int64 if width == 8 else np.int32)[:, 0])
        at += width * n
    return [np.cumsum(out[0]), *out[1:]]


def _products(t: float, slices: int):  # noqa: ANN202
    """Head cells of a block of columns, sorted by part, to (slice, n, data): pairs with the number of head columns that they share in it, packed. Where the pairs are many, one may come several times with a part of its number."""

    def of(held: list) -> Iterator[pd.DataFrame]:
        group, sizes, places, sides = (np.concatenate([np.frombuffer(h[i], ty) for h in held]) for i, ty in ((1, np.uint32), (3, np.int32), (4, np.int32), (5, np.int8)))
        docs = np.concatenate([h[0] << 20 | np.frombuffer(h[2], np.uint32).astype(np.int64) for h in held])
        names, doc = np.unique(docs, return_inverse=True)
        size = np.empty(len(names), np.int32)
        size[doc] = sizes
        o = np.lexsort((doc, sizes, group))
        group, doc, sizes, places, sides = group[o], doc[o], sizes[o], places[o], sides[o]

        def frame(code: np.ndarray, n: np.ndarray) -> pd.DataFrame:
            x, y = code // len(names), code % len(names)
            own = (_mixed(names[x]) >> np.uint64(16)) % np.uint64(slices)
            order = np.argsort(own, kind="stable")
            cut = np.concatenate([[0], np.flatnonzero(np.diff(own[order])) + 1, [len(own)]])
            by = [order[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            return pd.DataFrame({"slice": own[order[cut[:-1]]].astype(np.int32), "n": [len(o) for o in by], "data": [_pack(names[x[o]], names[y[o]], size[x[o]], size[y[o]], n[o]) for o in by]})

        first, codes, fresh, k = np.arange(len(group)), [], 0, 0
        code, n = np.empty(0, np.int64), np.empty(0, np.int64)
        while len(first):
            # each cell meets the k-th after it in its column; sizes rise, so one too large means that all after it are
            k += 1
            first = first[first + k < len(group)]
            second = first + k
            near = (group[first] == group[second]) & (sizes[first] >= t * sizes[second] - 1e-9)
            first, second = first[near], second[near]
            a = need(t, sizes[first], sizes[second])
            room = a - a // SPARE
            ok = (sizes[first] - places[first] >= room) & (sizes[second] - places[second] >= room) & ((sides[first] == 0) | (sides[first] != sides[second]))
            x, y = doc[first[ok]], doc[second[ok]]
            codes.append(np.minimum(x, y) * len(names) + np.maximum(x, y))
            fresh += len(x)
            if fresh > HELD_PAIRS or not len(first):
                code, at = np.unique(np.concatenate([code, *codes]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, np.ones(fresh)]), len(code)).astype(np.int64)
                codes, fresh = [], 0
                if len(code) > HELD_PAIRS:
                    yield frame(code, n)
                    code, n = code[:0], n[:0]
        if len(code):
            yield frame(code, n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, []
        for b in batches:
            for row in b[["part", "block", "groups", "docs", "sizes", "places", "sides"]].itertuples(index=False):
                if held and row[0] != part:
                    yield from of(held)
                    held = []
                part = row[0]
                held.append(row[1:])
        if held:
            yield from of(held)

    return run


def _sums(t: float):  # noqa: ANN202
    """Rows (slice, n, data) sorted by slice to (x, y, xs, ys): pairs that share enough head columns."""

    def merged(held: list) -> list[np.ndarray]:
        x, y, xs, ys, n = (np.concatenate(v) for v in zip(*held, strict=True))
        names, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        _, first, same = np.unique(at[: len(x)] * len(names) + at[len(x) :], return_index=True, return_inverse=True)
        return [x[first], y[first], xs[first], ys[first], np.bincount(same, n, len(first)).astype(np.int64)]

    def enough(held: list) -> pd.DataFrame:
        x, y, xs, ys, n = merged(held)
        ok = n >= 1 + need(t, xs, ys) // SPARE
        return pd.DataFrame({"x": x[ok], "y": y[ok], "xs": xs[ok], "ys": ys[ok]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held, fresh = None, [], 0
        for b in batches:
            for k, n, data in zip(b["slice"], b["n"], b["data"], strict=True):
                if held and k != own:
                    yield enough(held)
                    held, fresh = [], 0
                own = k
                held.append(_unpack(n, data))
                fresh += n
                if fresh > HELD_PAIRS:
                    held, fresh = [merged(held)], 0
        if held:
            yield enough(held)

    return run


def _completed(t: float):  # noqa: ANN202
    """Rows of a block of documents sorted by kind (0: a document's columns, 1: a pair) to the pairs that are similar, over all columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blk, cols = None, {}
        for b in batches:
            out = []
            for k, kind, x, y, xs, ys, c in zip(*(b[n] for n in ("blk", "kind", "x", "y", "xs", "ys", "cols")), strict=True):
                if k != blk:
                    blk, cols = k, {}
                if kind == 0:
                    cols[x] = np.cumsum(np.frombuffer(c, np.int64))
                    continue
                both = np.concatenate([cols[x], cols[y]])
                both.sort()
                overlap = int((both[1:] == both[:-1]).sum())
                sim = overlap / (xs + ys - overlap)
                if sim >= t - 1e-12:
                    out.append((x, y, overlap, sim))
            if out:
                yield pd.DataFrame(out, columns=["x", "y", "overlap", "similarity"])

    return run


def similar_classes(blocks: DataFrame, members: DataFrame, threshold: float, block: int = BLOCK, pairs: int = PAIRS, keep: bool = True) -> DataFrame:
    """(x, y, overlap, similarity) of pairs of representatives with Jaccard similarity >= threshold; x < y, each pair once, in order. keep: whether the table of blocks stays."""
    spark, t = blocks.sparkSession, float(threshold)
    cells = blocks.agg(F.coalesce(F.sum(F.length("grams") / 8), F.lit(0))).first()[0]
    parts = max(2 * spark.sparkContext.defaultParallelism, int(cells // COLUMN_BLOCK_CELLS) + 1)
    split = blocks.select("block", "grams", "counts").mapInPandas(_split(parts), "part int, block bigint, grams binary, counts binary")
    told = split.repartitionById(parts, F.col("part")).sortWithinPartitions("part").mapInPandas(_frequencies, "block bigint, part int, kinds binary, numbers binary")
    reps = members.select(F.shiftright("rep", 20).alias("block"), F.col("rep").bitwiseAND(F.lit((1 << 20) - 1)).alias("p")).distinct().groupBy("block").agg(F.array_sort(F.collect_list("p")).alias("p"))  # at most a block's documents
    as_bytes = lambda kind: F.pandas_udf(lambda s: s.map(lambda v: np.asarray(v, kind).tobytes()), "binary")
    none = F.lit(None).cast("binary")
    rows = (
        told.select("block", F.lit(0).alias("kind"), "part", F.col("kinds").alias("x"), F.col("numbers").alias("y"))
        .unionByName(reps.select("block", F.lit(1).alias("kind"), F.lit(0).alias("part"), as_bytes(np.int64)("p").alias("x"), none.alias("y")))
        .unionByName(blocks.select("block", F.lit(2).alias("kind"), F.lit(0).alias("part"), as_bytes(np.int32)("sizes").alias("x"), F.col("local").alias("y")))
    )
    schema = "kind int, doc bigint, size int, cols binary, docs binary, sizes binary, places binary"
    made = materialize(rows.repartition("block").sortWithinPartitions("block", "kind").mapInPandas(_heads(t), schema), "incidence", ["kind"])
    if not keep:
        discard(blocks)
    heads = made.where("kind = 1").select("cols", "docs", "sizes", "places")
    crowded, more = _crowded(heads, block)
    cells = heads.agg(F.coalesce(F.sum(F.length("cols") / 8), F.lit(0))).first()[0] + more
    parts = max(2 * spark.sparkContext.defaultParallelism, int(cells // COLUMN_BLOCK_CELLS) + 1)
    dealt = heads.mapInPandas(_by_columns(parts, crowded), "part int, block bigint, groups binary, docs binary, sizes binary, places binary, sides binary")
    slices = SLICES * parts
    found = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part").mapInPandas(_products(t, slices), "slice int, n int, data binary")
    left = materialize(found.repartitionById(parts, (F.col("slice") / SLICES).cast("int")).sortWithinPartitions("slice").mapInPandas(_sums(t), "x bigint, y bigint, xs int, ys int"), "candidates")
    discard(made, "kind=1")
    # pairs under one leader, the smallest partner of x, mostly have their documents in common; large leaders are split by x
    ends = left.select("x", F.col("x").alias("o")).union(left.select("y", "x"))
    lead = ends.groupBy("x").agg(F.min("o").alias("lead"))
    led = materialize(left.join(lead, "x"), "led")
    large = led.groupBy("lead").count().where(F.col("count") > pairs).select("lead", F.ceil(F.col("count") / pairs).cast("int").alias("k"))  # at most pairs / PAIRS rows
    led = led.join(F.broadcast(large) if count_up_to(large, BROADCAST_ROWS) <= BROADCAST_ROWS else large, "lead", "left")
    led = led.withColumn("blk", F.xxhash64("lead", F.pmod(F.xxhash64("x"), F.coalesce("k", F.lit(1))))).select("blk", "x", "y", "xs", "ys")
    docs = made.where("kind = 0").select(F.col("doc").alias("x"), "cols")
    wants = led.select("blk", "x").union(led.select("blk", "y")).distinct().join(docs, "x")
    no = F.lit(None).cast("bigint")
    both = wants.select("blk", F.lit(0).alias("kind"), "x", no.alias("y"), F.lit(0).alias("xs"), F.lit(0).alias("ys"), "cols").unionByName(led.select("blk", F.lit(1).alias("kind"), "x", "y", "xs", "ys", none.alias("cols")))
    return materialize(both.repartition("blk").sortWithinPartitions("blk", "kind").mapInPandas(_completed(t), "x bigint, y bigint, overlap int, similarity double"), "similar").orderBy("x", "y")


def _crowded(heads: DataFrame, block: int) -> tuple[dict[int, int], int]:
    """Head columns of more than `block` documents and into how many hands they are dealt, and the cells that this adds; what is large enough to be one rises until there are few."""
    least = int(_frequency_class(np.array([min(block, 65_535)]))[0])  # the class of a column that so many documents have; only those at or above it can be crowded

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for cols in b["cols"]:
                c = np.frombuffer(cols, np.int64)
                c, n = np.unique(c[c >> 55 >= least], return_counts=True)
                yield pd.DataFrame({"c": c, "n": n})

    counts = heads.select("cols").mapInPandas(run, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n")).where(F.col("n") > block)
    counts = materialize(counts, "crowded")
    while (rows := small_rows(counts.where(F.col("n") > block), BROADCAST_ROWS)) is None:
        block *= 2
    return (hands := {r["c"]: -(-r["n"] // block) for r in rows}), sum(r["n"] * (hands[r["c"]] - 1) for r in rows)


def near_duplicate_pairs(rows: DataFrame, id_col: str, text_col: str, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Distinct (a, b) of ids, a < b, whose texts are similar: word sequences both have / sequences at least one has >= threshold.

    Null ids, null or empty texts and texts of fewer than `width` words have no sequences and no pairs. An id on several rows
    is in a pair if any of its texts is. Ties (equal sizes) are kept. Empty table: nothing. Very long texts are used whole.
    """
    blocks = sequence_blocks(rows, id_col, text_col, width)
    members = classes(blocks)
    sim = similar_classes(blocks, members, threshold, keep=False)
    m = members.select("id", "rep")
    across = sim.join(m.select(F.col("rep").alias("x"), F.col("id").alias("ix")), "x").join(m.select(F.col("rep").alias("y"), F.col("id").alias("iy")), "y")
    across = across.where("ix <> iy").select(F.least("ix", "iy").alias("a"), F.greatest("ix", "iy").alias("b"))
    return across.unionByName(pairs_within(members.where("n > 1"), "rep", "id")).distinct()


def near_duplicate_groups(rows: DataFrame, id_col: str, text_col: str, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document with sequences: id, class_id (smallest id with an equal set), links (similar other classes), group_id (smallest class id of its connected component)."""
    blocks = sequence_blocks(rows, id_col, text_col, width)
    members = classes(blocks)
    sim = similar_classes(blocks, members, threshold, keep=False)
    names = members.groupBy("rep").agg(F.min("id").alias("class_id"))
    ends = sim.select(F.col("x").alias("rep"), F.col("y").alias("o")).union(sim.select("y", "x"))
    links = ends.groupBy("rep").agg(F.count("*").alias("links"))
    label = components(ends.select(F.col("rep").alias("u"), F.col("o").alias("v")))
    named = names.join(links, "rep", "left").join(label.select(F.col("u").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    group = named.groupBy("label").agg(F.min("class_id").alias("group_id"))
    named = named.join(group, "label").select("rep", "class_id", F.coalesce("links", F.lit(0)).alias("links"), "group_id")
    return members.join(named, "rep").select("id", "class_id", "links", "group_id").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, label) of connected components of edges (u, v), both directions given; label is the smallest node.

    Each round every node hangs below the smallest label around it and takes over that label's label, so chains
    halve; it ends when no label changes. State is written each round.
    """
    label = materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        around = edges.join(label.select(F.col("u").alias("v"), F.col("label").alias("l")), "v").groupBy("u").agg(F.min("l").alias("l"))
        near = label.join(around, "u").select("u", F.least("label", "l").alias("label"), F.col("label").alias("old"))
        # what the old label hears from any of its nodes it takes over too
        heard = near.groupBy(F.col("old").alias("u")).agg(F.min("label").alias("h"))
        near = near.join(heard, "u", "left").select("u", F.least("label", F.coalesce("h", "label")).alias("label"), "old")
        jump = near.select(F.col("u").alias("label"), F.col("label").alias("top"))
        new = materialize(near.join(jump, "label", "left").select("u", F.least("label", F.coalesce("top", "label")).alias("label"), "old"), "labels")
        if new.where("label <> old").limit(1).count() == 0:
            return new.select("u", "label")
        label = new.select("u", "label")
