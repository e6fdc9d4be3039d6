"""A sample whose category shares match target shares, by the cube method.

Inclusion probabilities are calibrated so that the expected count of every category is its target (multiplicative adjustment on
the table of category combinations). The flight phase then moves the probabilities to 0 or 1 while keeping all category counts: within a
partition first along rows of equal categories, which leaves at most one undecided row for each combination, then along null
directions of the category matrix, which leaves no more rows than there are categories. Undecided rows merge upward into fewer
partitions and fly again; the landing phase decides the last ones. The report compares targets, availability and result.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.runtime import materialize, small_rows

#: Up to this many category combinations the calibration runs at the driver; beyond it the same steps are Spark aggregations.
LOCAL_CELLS = 50_000
#: Rounds of the calibration, which ends earlier where the goals are met or nothing moves any more, and corrections of the total within a round.
ROUNDS, CORRECTIONS = 200, 30


def _members(text: str | None) -> list[str]:
    """Distinct members of a JSON array, trimmed and in lower case; none if the text isn't one."""
    try:
        got = json.loads(text) if text else None
    except (ValueError, RecursionError):
        return []
    if not isinstance(got, list):
        return []
    names = (x if isinstance(x, str) else json.dumps(x) for x in got if x is not None)
    return sorted({y for y in (x.strip().lower() for x in names) if y})


def categorized(strata: DataFrame, targets: list, id_col: str, scalars: dict[str, str], arrays: dict[str, str]) -> DataFrame:
    """(id, cats): each distinct id (trimmed, lower case) with the sorted numbers of the targets whose category it has; repeated rows unite."""
    number: dict[tuple[str, str], list[int]] = {}
    for i, t in enumerate(targets):
        number.setdefault((_fold(t["dimension"]), _fold(t["category"])), []).append(i)
    cols = [(_fold(d), c, False) for d, c in scalars.items()] + [(_fold(d), c, True) for d, c in arrays.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [set() for _ in range(len(b))]
            for k, (dim, _, many) in enumerate(cols):
                cache: dict = {}
                for j, v in enumerate(b[f"c{k}"]):
                    v = None if v is None or v != v else v
                    if v not in cache:
                        names = _members(v) if many else [v.strip().lower()] if isinstance(v, str) else []
                        cache[v] = [i for n in names for i in number.get((dim, n), ())]
                    out[j].update(cache[v])
            yield pd.DataFrame({"id": [x.strip().lower() if isinstance(x, str) else "" for x in b["id"]], "cats": [sorted(s) for s in out]})

    src = strata.select(F.col(id_col).cast("string").alias("id"), *(F.col(c).cast("string").alias(f"c{k}") for k, (_, c, _) in enumerate(cols)))
    each = src.mapInPandas(run, "id string, cats array<int>").where("id <> ''").distinct()
    return each.groupBy("id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("cats")))).alias("cats"))


def _fold(s: str | None) -> str:
    return (s or "").strip().lower()


def _filled(goal: np.ndarray, have: np.ndarray, which: np.ndarray, size: float) -> np.ndarray:
    """What categories of a dimension can't give, the others give, in proportion to their goals and no more than they have."""
    goal = goal.copy()
    for _ in range(50):
        room = which & (goal > 0) & (goal < have)
        lack = size - goal[which].sum()
        if lack <= 1e-9 or not room.any():
            break
        goal[room] = np.minimum(have[room], goal[room] * (1 + lack / goal[room].sum()))
    return goal


def calibrate(cells: DataFrame, goal: np.ndarray, total: float, least: np.ndarray) -> DataFrame:
    """cells (cats, n) with inclusion probability p, such that sums by category near the goals and the sum of all is `total`.

    Where `least` is true the goal is a lower bound (dimensions of which a row can have several categories).
    """
    k = len(goal)
    rows = small_rows(cells, LOCAL_CELLS)
    if rows is not None:
        n = np.array([r["n"] for r in rows], float)
        has = np.zeros((len(rows), k + 1))
        for j, r in enumerate(rows):
            has[j, r["cats"]] = 1
        has[:, k] = 1
        sums = lambda w: (n * w) @ has
        weigh = lambda m: np.minimum(1.0, np.exp(has @ m))
    else:
        cells = materialize(cells, "cells")

        def sums(m: np.ndarray) -> np.ndarray:
            w = cells.select("n", F.array_append("cats", F.lit(k)).alias("cats")).withColumn("w", _weight(m)).select(F.explode("cats").alias("c"), (F.col("n") * F.col("w")).alias("x"))
            got = np.zeros(k + 1)
            for r in w.groupBy("c").agg(F.sum("x").alias("x")).collect():
                got[r["c"]] = r["x"]
            return got

        weigh = lambda m: m
    aim = np.append(goal, total)
    m = np.zeros(k + 1)
    m[k] = np.log(max(total, 1e-9)) - np.log(max(1.0, sums(weigh(m))[k])) if total else -50.0
    for _ in range(ROUNDS):
        off, before = 0.0, m.copy()
        # goals that can't all hold pull against each other; the total has the last word in each round
        for part in (*([np.arange(k)] if k else []), *([np.array([k])] * CORRECTIONS)):
            now = sums(weigh(m))[part]
            ok = (now > 1e-9) & (aim[part] > 0)
            step = np.zeros(len(part))
            step[ok] = np.log(aim[part][ok] / now[ok])
            if part[0] != k:
                off = max(off, float(np.abs(step[~least]).max(initial=0)), float(np.maximum(step[least], 0).max(initial=0)))
                m[part] = np.clip(m[part] + 0.5 * np.clip(step, -2, 2), -15, 15)
                m[:k] = np.where(least, np.maximum(m[:k], 0), m[:k])
            else:  # probabilities stop at one, so a step may fall short
                m[part] = np.clip(m[part] + np.clip(step, -5, 5), -500, 30)
                if abs(step[0]) < 1e-9:
                    break
        if off < 1e-6 or np.abs(m - before).max() < 1e-9:
            break
    spark = cells.sparkSession
    if rows is not None:
        w = weigh(m)
        return spark.createDataFrame([(list(r["cats"]), float(x)) for r, x in zip(rows, w, strict=True)], "cats array<int>, p double")
    return cells.withColumn("cats2", F.array_append("cats", F.lit(k))).select("cats", _weight(m, "cats2").alias("p"))


def _weight(m: np.ndarray, col: str = "cats"):
    lit = F.array(*(F.lit(float(x)) for x in m))
    return F.least(F.lit(1.0), F.exp(F.aggregate(col, F.lit(0.0), lambda s, i: s + F.get(lit, i))))


#: Open rows beyond which those that can't move are set aside before each move.
FEW = 200


def flight(p: np.ndarray, cats: list[tuple[int, ...]], rng: np.random.Generator) -> np.ndarray:
    """Moves p (0..1) while the sum of p over the rows of each category stays, until no such move is left.

    cats: the categories of each row. A move needs one open row more than there are categories among the rows taken, so the
    matrix is never larger than what few rows bring with them, however many categories there are in all.
    """
    p = p.copy()
    open_ = _movable(list(np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))), cats)
    while open_:
        take, columns = [], {}
        for i in open_:
            take.append(i)
            for c in cats[i]:
                columns.setdefault(c, len(columns))
            if len(take) > len(columns):
                break
        x = np.zeros((len(take), max(1, len(columns))))
        for r, i in enumerate(take):
            x[r, [columns[c] for c in cats[i]]] = 1
        u = _null(x)
        if u is None:
            break
        q = p[take]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + up * u if rng.random() < down / (up + down) else q - down * u
        p[take] = np.where(q < 1e-9, 0, np.where(q > 1 - 1e-9, 1, q))
        open_ = _movable([i for i in open_ if 0 < p[i] < 1], cats) if len(open_) > FEW else [i for i in open_ if 0 < p[i] < 1]
    return p


def _movable(rows: list[int], cats: list[tuple[int, ...]]) -> list[int]:
    """Rows without a category that no other of them has: such a row alone would have to pay for its own move."""
    while True:
        n = Counter(c for i in rows for c in cats[i])
        left = [i for i in rows if all(n[c] > 1 for c in cats[i])]
        if len(left) == len(rows):
            return rows
        rows = left


def _null(a: np.ndarray) -> np.ndarray | None:
    """A vector u with a' u = 0, or None."""
    _, s, vt = np.linalg.svd(a.T, full_matrices=True)
    rank = int((s > 1e-9).sum())
    if rank >= a.shape[0]:
        return None
    u = vt[rank]
    u[np.abs(u) < 1e-12] = 0
    return u


def _fly(k: int, seed: int, land: bool):
    """A partition's flight: rows (id, cats, p) to those chosen (p = 1) or undecided (0 < p < 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        df = pd.concat(held, ignore_index=True)
        df["cats"] = [tuple(int(i) for i in c) for c in df["cats"]]
        df["o"] = [xxhash.xxh3_64_intdigest(i, seed) for i in df["id"]]
        df = df.sort_values(["o", "id"], ignore_index=True)
        rng = np.random.default_rng([seed, int(df["o"].iloc[0]) % (1 << 32) if len(df) else 0])
        p = df["p"].to_numpy().copy()
        for at in df.groupby("cats").indices.values():
            q = p[at]
            undecided = at[(q > 0) & (q < 1)]
            if len(undecided) > 1 and np.ptp(p[undecided]) < 1e-12:
                s = p[undecided].sum()
                whole = int(np.floor(s + 1e-9))
                p[undecided] = 0
                p[undecided[:whole]] = 1
                if s - whole > 1e-9:
                    p[undecided[whole]] = s - whole
        i = np.flatnonzero((p > 0) & (p < 1))
        if len(i):
            own = [(k, *df["cats"][j]) for j in i]  # k: the size of the sample
            p[i] = flight(p[i], own, rng)
            if land:  # give up one variable after the other, the size of the sample last
                i = np.flatnonzero((p > 0) & (p < 1))
                there = sorted({c for j in i for c in df["cats"][j]}, reverse=True)
                for at in range(0, len(there), max(1, len(there) // 100)):
                    gone = there[min(at + max(1, len(there) // 100), len(there)) - 1]
                    p[i] = flight(p[i], [(k, *(c for c in df["cats"][j] if c < gone)) for j in i], rng)
                i = np.flatnonzero((p > 0) & (p < 1))
                p[i] = rng.random(len(i)) < p[i]
        keep = p > 0
        yield pd.DataFrame({"id": df["id"][keep], "cats": [list(c) for c in df["cats"][keep]], "p": p[keep]})

    return run


def balanced_sample(strata: DataFrame, targets: DataFrame, id_col: str, scalars: dict[str, str], arrays: dict[str, str], fraction: float = 0.2, seed: int = 7, rows_per_task: int = 20_000, fan_in: int = 8) -> tuple[DataFrame, DataFrame]:
    """(sample, report). sample: id of the chosen, each once. report: one row per distinct target row.

    scalars and arrays map a dimension's name to its column, which holds a category or a JSON array of them. report: dimension, category
    (as stored), available (distinct ids having the category), required (the larger of min_rows and target_share times the size,
    not rounded), expected, achieved, residual (achieved - expected), unmet (available < required), short (achieved < required). The size is fraction times the distinct ids. Null ids count
    nowhere; null categories and broken arrays are no category; null shares and minima count as 0. The same input and seed give
    the same sample. No rows: an empty sample, and all targets with a minimum are unmet.
    """
    kept = targets.select("dimension", "category", "target_share", "min_rows").distinct().orderBy("dimension", "category", "target_share", "min_rows").collect()  # what is asked for, not data
    k = len(kept)
    ids = materialize(categorized(strata, kept, id_col, scalars, arrays), "categorized")
    n = ids.count()
    size = n * fraction
    cells = materialize(ids.groupBy("cats").agg(F.count("*").alias("n")), "cells")
    have = np.zeros(k)
    for r in cells.select(F.explode("cats").alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n")).collect():
        have[r["c"]] = r["n"]
    required = np.array([max(float(t["min_rows"] or 0), float(t["target_share"] or 0) * size) for t in kept])
    exclusive = {_fold(d) for d in scalars}
    goal, least = np.minimum(required, have), np.array([_fold(t["dimension"]) not in exclusive for t in kept], bool)
    for dim in exclusive:
        goal = _filled(goal, have, np.array([_fold(t["dimension"]) == dim for t in kept], bool), size)
    probs = calibrate(cells, goal, size, least)
    if cells.count() <= LOCAL_CELLS:
        probs = F.broadcast(probs)  # one combination may be that of most rows
    state = ids.join(probs, "cats").select("id", "cats", "p")
    parts = max(1, -(-n // rows_per_task))
    schema = "id string, cats array<int>, p double"
    chosen = None
    while True:
        last = parts == 1
        flown = materialize(state.repartition(parts, F.xxhash64("id")).mapInPandas(_fly(k, seed, last), schema), "flight")
        done = flown.where("p = 1").select("id", "cats")
        chosen = done if chosen is None else chosen.unionByName(done)
        if last:
            break
        state, parts = flown.where("p < 1"), -(-parts // fan_in)
    chosen = materialize(chosen, "sample")
    expected = np.zeros(k)
    for r in cells.join(probs, "cats").select(F.explode("cats").alias("c"), (F.col("n") * F.col("p")).alias("x")).groupBy("c").agg(F.sum("x").alias("x")).collect():
        expected[r["c"]] = r["x"]
    base = strata.sparkSession.createDataFrame([(i, t["dimension"], t["category"], int(have[i]), float(required[i]), float(expected[i])) for i, t in enumerate(kept)], "c int, dimension string, category string, available bigint, required double, expected double")
    got = chosen.select(F.explode("cats").alias("c")).groupBy("c").agg(F.count("*").alias("achieved"))
    report = base.join(got, "c", "left").withColumn("achieved", F.coalesce("achieved", F.lit(0)))
    report = report.select("dimension", "category", "available", "required", "expected", "achieved", (F.col("achieved") - F.col("expected")).alias("residual"), (F.col("available") < F.col("required")).alias("unmet"), (F.col("achieved") < F.col("required")).alias("short"))
    return chosen.select("id"), report
