import random

import pytest

from corpuslathe.operators import hierarchy as H

SCHEMA = "folder_id string, parent_id string, name string, path string, depth bigint, note string"


def rows(spark, data):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in data], SCHEMA)


def brute(data):
    parent, name = {}, {}
    for r in data:
        k = (r[0] or "").strip().lower()
        if k:
            c = ((r[1] or "").strip().lower() or None, r[2] or "")
            if k not in parent or ((c[0] is not None, c[0] or "", c[1]) < ((parent[k]) is not None, parent[k] or "", name[k])):
                parent[k], name[k] = c
    out = {}
    for k in parent:
        chain, seen = [], set()
        i = k
        while i is not None and i in parent and i not in seen:
            seen.add(i)
            chain.append(i)
            i = parent[i]
        if i in seen:
            out[k] = (None, None, None, True, k == i or k in chain[chain.index(i) :])
        else:
            up = chain[::-1]
            out[k] = (up[0], len(up) - 1, "/".join(name[x] for x in up), False, False)
    return out


def tree(n, seed, loops):
    r = random.Random(seed)
    data = []
    for i in range(n):
        p = f"F{r.randrange(max(0, i - 5), i)}" if i and r.random() < 0.97 else r.choice([None, "", " ", "gone"])
        data.append((f"f{i}", f" {p} " if p and r.random() < 0.3 else p, f"n{i}"))
    for _ in range(loops):
        i = r.randrange(n)
        data[i] = (data[i][0], f"f{min(n - 1, i + r.randrange(0, 9))}", data[i][2])
    return data + data[:3]


@pytest.mark.parametrize(("n", "seed", "loops", "per_task", "one_task"), [(40, 1, 0, 5, 10**6), (300, 2, 4, 20, 10**6), (300, 3, 3, 1000, 10**6), (200, 4, 3, 2, 10)])
def test_against_brute_force(spark, n, seed, loops, per_task, one_task):
    data = tree(n, seed, loops)
    got = {r["node"]: (r["root"], r["depth"], r["path"], r["in_loop"], r["on_loop"]) for r in H.resolve_hierarchy(rows(spark, data), rows_per_task=per_task, one_task_rows=one_task).collect()}
    assert got == brute(data)


def test_deep_chain_and_descendants(spark):
    data = [(f"c{i}", f"c{i - 1}" if i else None, f"x{i}") for i in range(120)]
    r = H.resolve_hierarchy(rows(spark, data), rows_per_task=10)
    assert r.where("node = 'c119'").first()["depth"] == 119
    assert r.where("node = 'c119'").first()["ancestors"][-1] == "c119"
    assert H.descendants(r).count() == 120 * 119 // 2
    assert H.descendants(r).where("ancestor = 'c0' and descendant = 'c7'").first()["distance"] == 7


def test_edges(spark):
    assert H.resolve_hierarchy(rows(spark, [])).count() == 0
    r = {x["node"]: x for x in H.resolve_hierarchy(rows(spark, [(None, "a", "n"), (" ", None, "m"), ("A", None, None), ("self", "SELF ", "s"), ("b", " a", "B")])).collect()}
    assert set(r) == {"a", "self", "b"}
    assert r["self"]["on_loop"] and r["a"]["path"] == "" and r["b"]["path"] == "/B"


def test_faults(spark):
    df = rows(spark, [("a", None, "A", "A", 0), ("b", "a", "B", "A/x", 1), ("c", "b", "C", None, 5), ("c", "b", "C", None, 5), ("d", "e", "D", None, 0), ("e", "d", "E", None, None), ("g", "e", "G", None, 1)])
    got = {(x["id"], x["fault"]) for x in H.hierarchy_faults(df, H.resolve_hierarchy(df)).collect()}
    assert got == {("b", "path"), ("c", "depth"), ("d", "loop"), ("e", "loop"), ("g", "loop")}


@pytest.mark.parametrize("size", [3, 5, 7])
def test_doubling_keeps_loops_small(spark, size, monkeypatch):
    longest = []
    real = H.materialize

    def watched(df, name):
        out = real(df, name)
        if "ids" in out.columns:
            longest.append(max((len(r["ids"]) for r in out.select("ids").collect()), default=0))
        return out

    monkeypatch.setattr(H, "materialize", watched)
    data = [(f"f{i}", f"f{(i + 1) % size}" if i < size else f"f{i - 1}", f"n{i}") for i in range(60)] + [(f"g{i}", f"g{i - 1}" if i else None, "g") for i in range(20)]
    got = {r["node"]: (r["root"], r["depth"], r["path"], r["in_loop"], r["on_loop"]) for r in H.resolve_hierarchy(rows(spark, data), rows_per_task=2, one_task_rows=5).collect()}
    assert got == brute(data)
    assert max(longest) <= 20 * 4


def test_no_task_above_its_bound(spark, monkeypatch):
    lasts = []
    real = H._shorten
    monkeypatch.setattr(H, "_shorten", lambda last: lasts.append(last) or real(last))
    data = [(f"c{i}", f"c{i - 1}" if i else None, f"x{i}") for i in range(60)]
    got = {r["node"]: (r["root"], r["depth"], r["path"], r["in_loop"], r["on_loop"]) for r in H.resolve_hierarchy(rows(spark, data), rows_per_task=1000, one_task_rows=20).collect()}
    assert got == brute(data) and True not in lasts


@pytest.mark.parametrize("shape", ["binary", "chain", "random"])
def test_no_task_holds_more_than_its_bound(spark, shape, tmp_path, monkeypatch):
    n, r = 1500, random.Random(2)
    up = {"binary": lambda i: (i - 1) // 2, "chain": lambda i: i - 1, "random": lambda i: r.randrange(i)}[shape]
    data = [(f"f{i}", f"f{up(i)}" if i else None, f"n{i}") for i in range(n)]
    real = H._shorten

    def counted(last):
        inner, folder = real(last), str(tmp_path)

        def run(batches):
            import uuid

            held = list(batches)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(sum(map(len, held))))
            yield from inner(iter(held))

        return run

    monkeypatch.setattr(H, "_shorten", counted)
    got = {x["node"]: (x["root"], x["depth"], x["path"], x["in_loop"], x["on_loop"]) for x in H.resolve_hierarchy(rows(spark, data), rows_per_task=10, one_task_rows=60).collect()}
    assert got == brute(data)
    assert max(int(p.read_text()) for p in tmp_path.iterdir()) <= 60
