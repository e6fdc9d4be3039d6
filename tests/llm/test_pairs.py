"""Format duplicates, near duplicates and leaked items against brute force."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslathe.llm import formatdup, leakage, neardup
from corpuslathe.llm.words import words

CLASH = "id string, text string, doc int, k string, g int, content_key string, unit string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", 2, "c", "u") for i, t in rows], CLASH)


def test_words():
    assert words("Ab_c1 漢字かな—x É") == ["ab", "c1", "漢", "字", "か", "な", "x", "é"]
    assert words(None) == [] and words(" ,. ") == []


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Hello, World 12!", "hello\nworld  12", True),
        ("Straße", "STRASSE", True),
        ("Scene: a b\nMood: c", "**mood:** C | - SCENE: a, b", True),
        ("Scene: a b\nMood: c", '{"Mood": "c", "scene": "A-B"}', True),
        ("Scene: a b\nMood: c", "Scene: c\nMood: a b", False),
        ("Scene: a 1\nMood: c", "Scene: a 2\nMood: c", False),
        ("One two. Three.", "Three. One two.", False),
        ('\xa0{"a": "x", "b": {"c": 1, "d": [2]}}', '{"b": {"d": [2], "c": 1}, "a": "X"}', True),
        ("[Scene: a | Mood: b]", "Mood: b\r\nScene: a", True),
        ("Scene: a\nand more\nMood: b", "Mood: b\nScene: a and more", True),
    ],
)
def test_content_keys(a, b, same):
    assert (formatdup.canonical_key(a) == formatdup.canonical_key(b)) is same


@pytest.mark.parametrize("hot", [5, 10**6])
def test_format_groups(spark, hot):
    rows = [(f"h{i}", "Hot text!" if i % 2 else "hot TEXT") for i in range(40)] + [("a", "x y"), ("b", "X, Y"), ("b", "x-y"), ("c", None), ("d", ""), ("e", "…"), (None, "x y"), ("z", "alone")]
    groups, members = formatdup.format_groups(table(spark, rows), "id", "text", hot_rows=hot, salts=4)
    assert sorted((r["representative"], r["copies"]) for r in groups.collect()) == [("a", 4), ("h0", 40), ("z", 1)]
    m = members.collect()
    assert len(m) == 43 and {r["representative"] for r in m if r["id"].startswith("h")} == {"h0"}
    pairs = {tuple(r) for r in formatdup.pairs_within(members, "content_key", "id", block=7).collect()}
    hots = sorted(f"h{i}" for i in range(40))
    assert pairs == set(itertools.combinations(hots, 2)) | {("a", "b")}


def test_format_groups_empty(spark):
    groups, members = formatdup.format_groups(table(spark, []), "id", "text")
    assert groups.count() == members.count() == 0


def similar(rows, width, threshold):
    sets = {}
    for i, t in rows:
        w = words(t)
        s = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
        if i is not None and s:
            sets.setdefault(i, []).append(s)
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if any(len(x & y) >= threshold * len(x | y) - 1e-12 for x in sets[a] for y in sets[b])}


@pytest.mark.parametrize(("seed", "width", "threshold"), [(1, 3, 0.6), (2, 5, 0.8), (3, 1, 0.5), (4, 3, 1.0)])
def test_near_duplicates(spark, seed, width, threshold, monkeypatch):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):
        if rows and r.random() < 0.6:
            w = r.choice(rows)[1].split()
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
        else:
            w = [r.choice(vocab) for _ in range(r.randrange(1, 60))]
        rows.append((f"d{i:03d}", " ".join(w)))
    rows += [("n1", None), ("n2", ""), (None, "w1 w2 w3 w4 w5"), ("d000", rows[1][1]), *(("s%02d" % i, "same words in all of these " * 3) for i in range(15)), ("long", " ".join(vocab) * 500)]
    want = similar(rows, width, threshold)
    assert {tuple(x) for x in neardup.near_duplicate_pairs(table(spark, rows), "id", "text", width, threshold).collect()} == want
    # small blocks of rows, crowded columns dealt out and large leaders split give the same
    monkeypatch.setattr(neardup, "BLOCK", 2)
    blocks = neardup.sequence_blocks(table(spark, rows).repartition(3), "id", "text", width, cells=150)
    members = neardup.classes(blocks)
    names = {r["rep"]: r["i"] for r in members.groupBy("rep").agg(F.min("id").alias("i")).collect()}
    run = lambda block, pairs: {tuple(sorted((names[r["x"]], names[r["y"]]))): round(r["similarity"], 9) for r in neardup.similar_classes(blocks, members, threshold, block, pairs).collect()}
    whole = run(10**6, 10**6)
    assert run(3, 2) == whole and {p for p in whole if p[0] != p[1]} <= want


def test_many_pairs_of_a_column_block(monkeypatch):
    """A task holds a bounded number of pairs, however many its columns make, and the counts stay whole."""
    r = np.random.default_rng(2)
    docs, columns = 150, 6
    has = r.random((docs, columns)) < 0.9
    d, c = np.nonzero(has)
    as_rows = pd.DataFrame({"part": [0], "block": [3], "groups": [c.astype(np.uint32).tobytes()], "docs": [d.astype(np.uint32).tobytes()], "sizes": [np.full(len(d), 20, np.int32).tobytes()], "places": [np.zeros(len(d), np.int32).tobytes()], "sides": [np.zeros(len(d), np.int8).tobytes()]})
    shared = has.astype(int) @ has.T.astype(int)
    for held in (10**6, 500, 1):
        monkeypatch.setattr(neardup, "HELD_PAIRS", held)
        frames = list(neardup._products(0.6, 7)(iter([as_rows])))
        total: dict = {}
        for f in frames:
            assert f["n"].sum() <= held + len(d)
            for k, n, data in zip(f["slice"], f["n"], f["data"], strict=True):
                for x, y, xs, ys, m in zip(*neardup._unpack(n, data), strict=True):
                    assert 0 <= k < 7 and x < y and xs == ys == 20
                    total[x - (3 << 20), y - (3 << 20)] = total.get((x - (3 << 20), y - (3 << 20)), 0) + m
        assert total == {(x, y): shared[x, y] for x in range(docs) for y in range(x + 1, docs) if shared[x, y]}
        rows = pd.concat(frames).sort_values("slice", kind="stable")
        got = pd.concat(list(neardup._sums(0.6)(iter([rows.iloc[:5], rows.iloc[5:]]))))
        assert len(got) == len(total) and {(x - (3 << 20), y - (3 << 20)) for x, y in zip(got["x"], got["y"], strict=True)} == set(total)


def test_near_duplicate_groups(spark):
    base = [f"w{i}" for i in range(40)]
    chain = [" ".join(base[i : i + 36]) for i in range(0, 5)]
    rows = [(f"c{i}", t) for i, t in enumerate(chain)] + [("x1", "a b c d e f"), ("x2", "A b, c d e f"), ("y", "q r s t u v")]
    got = {r["id"]: (r["class_id"], r["links"], r["group_id"]) for r in neardup.near_duplicate_groups(table(spark, rows), "id", "text").collect()}
    want = similar(rows, 5, 0.8)
    assert got["x2"] == ("x1", 0, "x1") and got["y"] == ("y", 0, "y")
    assert all(got[f"c{i}"][2] == "c0" for i in range(5))
    for i in range(5):
        assert got[f"c{i}"][1] == sum(f"c{i}" in p for p in want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 102), (200, 100)]
    df = spark.createDataFrame(edges + [(b, a) for a, b in edges], "u long, v long")
    got = {r["u"]: r["label"] for r in neardup.components(df).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys((100, 101, 102, 200), 100)}


def test_near_duplicates_empty(spark):
    assert neardup.near_duplicate_pairs(table(spark, []), "id", "text").count() == 0
    assert neardup.near_duplicate_groups(table(spark, [("a", "too short")]), "id", "text").count() == 0


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_myers_is_edit_distance():
    r = random.Random(7)
    for _ in range(300):
        p, t = [r.randrange(4) for _ in range(r.randrange(1, 9))], [r.randrange(4) for _ in range(r.randrange(0, 12))]
        best = min(edit(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert leakage.myers(p, t)[0] == best


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_leaks_against_brute_force(spark, budget):
    r, window = random.Random(budget), 15
    vocab = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randrange(10, 40)))) for i in range(12)]
    docs = []
    for d in range(60):
        own = [r.choice(vocab) for _ in range(r.randrange(0, 60))]
        if d % 2:
            w = r.choice(items)[1].split()
            w = w[r.randrange(0, 6) :][: r.randrange(12, 30)]
            for _ in range(r.randrange(0, 4)):
                k = r.randrange(len(w))
                w[k : k + 1] = r.choice([[], ["zz"], [w[k], "zz"]])
                if not w:
                    w = ["zz"]
            own[len(own) // 2 : len(own) // 2] = w
        docs.append((d, ", ".join(own).upper()))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[1][1]), (None, items[2][1])]
    items += [(50, None), (51, "too short"), (52, items[0][1])]
    got = {(x["item_id"], x["doc_id"]): x["distance"] for x in leakage.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=window, budget=budget).collect()}
    # full bitmaps and shuffled pieces give the same
    again = leakage.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=window, budget=budget, broadcast_pieces=3, max_bits=4)
    assert {(x["item_id"], x["doc_id"]): x["distance"] for x in again.collect()} == got
    want = {}
    for i, it in items:
        iw = words(it)
        for d, t in docs:
            dw = words(t)
            if d is None or len(iw) < window or not dw:
                continue
            best = min(leakage.myers([hash(x) for x in iw[s : s + window]], [hash(x) for x in dw])[0] for s in range(len(iw) - window + 1))
            if best <= budget:
                want[(i, d)] = min(best, want.get((i, d), 99))
    assert got == want and len(want) > 10


def test_leaks_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a " * 20)], "item_id long, text string")
    assert leakage.leaked_items(docs, items).count() == 0
    assert leakage.leaked_items(spark.createDataFrame([(1, "a " * 20)], "doc_id long, text string"), items.limit(0)).count() == 0


def test_found_queries_against_brute_force(spark):
    from corpuslathe.llm.queries import REG

    d = "/root/testdata/sf0.001"
    p = pd.read_parquet(f"{d}/prompts.parquet")
    rows = list(zip(p.prompt_sha256, p.prompt_text, strict=True))
    assert {tuple(r) for r in REG.queries["p2_found"](spark, d).collect()} == similar(rows, 3, 0.6)
    keys = {i: formatdup.canonical_key(t) for i, t in rows}
    assert {tuple(r) for r in REG.queries["p3_found"](spark, d).collect()} == {(a, b) for a, b in itertools.combinations(sorted(keys), 2) if keys[a] == keys[b]}
    items, docs = pd.read_parquet(f"{d}/eval_items.parquet"), pd.read_parquet(f"{d}/documents.parquet")
    grams = {}
    for i, t in zip(items.item_id, items.text, strict=True):
        w = words(t)
        for k in range(len(w) - 14):
            grams.setdefault(tuple(w[k : k + 15]), set()).add(i)
    want = set()
    for i, t in zip(docs.doc_id, docs.text, strict=True):
        w = words(t)
        for k in range(len(w) - 14):
            want |= {(x, i) for x in grams.get(tuple(w[k : k + 15]), ())}
    assert {tuple(r) for r in REG.queries["p8_found"](spark, d).select("item_id", "doc_id").collect()} == want


def test_labels_of_any_length(spark):
    for n in (1, 40, 70, 500):
        a, b = f"{'x' * n}: one\n{'word ' * n}: two", f"{'word ' * n}: two | {'x' * n}: one"
        assert formatdup.canonical_key(a) == formatdup.canonical_key(b) and formatdup.fields(a)
    assert formatdup.fields("He came. Then he said: go\nShe left. And said: no") is None
    assert formatdup.canonical_key("a" + " - " * 30_000 + "b") is not None


def test_many_items_and_one_walk(spark):
    r = random.Random(3)
    items = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(20))) for i in range(400)]
    docs = [(d, f"start {items[d * 7][1]} end") for d in range(50)]
    run = lambda its, **kw: {(x["item_id"], x["doc_id"]) for x in leakage.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(its, "item_id long, text string"), budget=1, **kw).collect()}
    assert run(items) == {(d * 7, d) for d in range(50)} == run(items, broadcast_pieces=10) == run(items[:200]) | run(items[200:])
