"""Parent links to hierarchies: root, depth, path, ancestors and loops of trees of unknown depth.

Every node starts as a link to its parent that weighs one step and one name. Partitions shorten the chains
of links they hold with a weighted disjoint-set forest: a node that hung below `top` by some steps
then hangs below the root of its chain in that partition, by the sum of the steps and with the names joined.
Only nodes that others still hang below go to the next level, into fewer partitions, until one partition
holds what is left and finds roots and loops. No task is given more than `one_task_rows` links: what stays larger and no longer shrinks is solved by
pointer doubling (a join of the links with themselves, halving the chains each round).
On the way down each level finds its nodes' roots by one join on `top`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslathe.functions.keys import key
from corpuslathe.runtime import materialize

#: top null: resolved, `base` is the root. state: 0 open or resolved, 1 hangs below or is on a loop.
_LINK = "k string, top string, base string, dist bigint, names string, ids string, loop int"
_SEP = "\u001f"


def resolve_hierarchy(
    rows: DataFrame,
    id_col: str = "folder_id",
    parent_col: str = "parent_id",
    name_col: str = "name",
    rows_per_task: int = 5_000,
    one_task_rows: int = 500_000,
) -> DataFrame:
    """One row per distinct node key: node, root, depth, path, ancestors (ids from the root down, the node last), in_loop, on_loop.

    Keys compare trimmed and in lower case. A node whose parent is null, empty or not in the table is a root of
    depth 0. Nodes on a loop or below one have in_loop true and null root, depth, path and ancestors; on_loop is
    true for those on the loop itself (a node that is its own parent is a loop of one). Rows with a null or empty id
    are no nodes and are left out. Of several rows with one key the smallest (parent, name) counts. A null name
    counts as an empty one. An empty table gives an empty result.
    """
    src = rows.select(key(id_col).alias("k"), key(parent_col).alias("p"), F.coalesce(F.col(name_col), F.lit("")).alias("name"))
    one = src.where("k is not null").groupBy("k").agg(F.min(F.struct("p", "name")).alias("s")).select("k", "s.p", "s.name")
    one = materialize(one, "nodes")
    known = one.select(F.col("k").alias("known"))
    links = one.join(known, one.p == known.known, "left").select(
        "k",
        F.col("known").alias("top"),
        F.when(F.col("known").isNull(), F.col("k")).alias("base"),
        F.when(F.col("known").isNull(), 0).otherwise(1).cast("bigint").alias("dist"),
        F.col("name").alias("names"),
        F.col("k").alias("ids"),
        F.lit(0).alias("loop"),
    )
    levels, n, before = [], one.count(), None
    rows_per_task = min(rows_per_task, one_task_rows)
    while True:
        last = n <= rows_per_task or n <= one_task_rows and before is not None and n > 0.7 * before
        if not last and before is not None and n > 0.7 * before:  # it hardly shrinks, and is too large for a task
            levels.append(_doubled(links, n))
            break
        # hashing spreads rows unevenly, so a task is given half of what it may hold
        parts = 1 if last else -(-2 * n // rows_per_task)
        local = materialize(links.repartition(parts, "k").mapInPandas(_shorten(last), _LINK), "links")
        levels.append(local)
        if last:
            break
        tops = local.where("top is not null").select(F.col("top").alias("k")).distinct()
        links = materialize(local.join(tops, "k", "left_semi"), "skeleton")
        rows_per_task, before, n = min(rows_per_task * 4, one_task_rows), n, links.count()
        if n == 0:
            break
    done = levels[-1]
    for local in reversed(levels[:-1]):
        up = done.select(F.col("k").alias("top"), F.col("base").alias("u_base"), F.col("dist").alias("u_dist"), F.col("names").alias("u_names"), F.col("ids").alias("u_ids"), F.col("loop").alias("u_loop"))
        # a node that went up itself was solved there; its own row below still points to its top and gives the same
        done = local.join(up, "top", "left").select(
            "k",
            F.lit(None).cast("string").alias("top"),
            F.coalesce("base", "u_base").alias("base"),
            (F.col("dist") + F.coalesce("u_dist", F.lit(0))).alias("dist"),
            F.when(F.col("top").isNull(), F.col("names")).otherwise(F.concat_ws("/", "u_names", "names")).alias("names"),
            F.when(F.col("top").isNull(), F.col("ids")).otherwise(F.concat_ws(_SEP, "u_ids", "ids")).alias("ids"),
            F.greatest("loop", F.coalesce("u_loop", F.lit(0))).alias("loop"),
        )
    return _with_loops(materialize(done, "resolved"), one, one_task_rows)


def _shorten(last: bool):
    """Shortens the chains among the links of a partition. last: all links are here, so a chain that doesn't end is a loop."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        df = pd.concat(held, ignore_index=True)
        at = {k: i for i, k in enumerate(df["k"])}
        top, base = df["top"].tolist(), df["base"].tolist()
        top = [None if pd.isna(t) else t for t in top]
        base = [None if pd.isna(b) else b for b in base]
        dist, names, ids, loop = df["dist"].tolist(), df["names"].tolist(), df["ids"].tolist(), df["loop"].tolist()
        final = bytearray(len(top))  # 1: shortened as far as it goes here; 2: on the present chain
        for start in range(len(top)):
            chain, i = [], start
            while i is not None and not final[i]:
                final[i] = 2
                chain.append(i)
                i = at.get(top[i]) if top[i] is not None else None
            looped = i is not None and final[i] == 2
            for j in reversed(chain):
                up = at.get(top[j]) if top[j] is not None else None
                if looped or (up is not None and loop[up]):
                    top[j], base[j], loop[j] = None, None, 1
                elif up is not None:
                    dist[j] += dist[up]
                    names[j] = f"{names[up]}/{names[j]}"
                    ids[j] = f"{ids[up]}{_SEP}{ids[j]}"
                    top[j], base[j] = top[up], base[up]
                final[j] = 1
        assert not last or all(t is None for t in top)
        yield pd.DataFrame({"k": df["k"], "top": top, "base": base, "dist": dist, "names": names, "ids": ids, "loop": loop})

    return run


def _doubled(links: DataFrame, n: int) -> DataFrame:
    """Pointer doubling: each round a link takes over its top's link; links still open after log2(n) + 1 rounds never end.

    Which links end is found with pointers alone. Names and ids are joined in a second pass over those, so a loop's never grow.
    """
    rounds = n.bit_length() + 1
    jump = links.select("k", "top", "loop")
    for _ in range(rounds):
        if jump.where("top is not null").limit(1).count() == 0:
            break
        up = jump.select(F.col("k").alias("top"), F.col("top").alias("u_top"), F.col("loop").alias("u_loop"))
        jump = materialize(jump.join(up, "top", "left").select("k", F.col("u_top").alias("top"), F.greatest("loop", F.coalesce("u_loop", F.lit(0))).alias("loop")), "jumps")
    looped = (F.col("top").isNotNull()) | (F.col("loop") == 1)
    bad = materialize(jump.where(looped).select("k"), "looped")
    none = F.lit(None).cast("string")
    lost = links.join(bad, "k", "left_semi").select("k", none.alias("top"), none.alias("base"), "dist", F.lit("").alias("names"), F.lit("").alias("ids"), F.lit(1).alias("loop"))
    state = links.join(bad, "k", "left_anti")
    for _ in range(rounds):
        if state.where("top is not null").limit(1).count() == 0:
            break
        up = state.select(F.col("k").alias("top"), F.col("top").alias("u_top"), F.col("base").alias("u_base"), F.col("dist").alias("u_dist"), F.col("names").alias("u_names"), F.col("ids").alias("u_ids"))
        shut = F.col("top").isNull()
        state = state.join(up, "top", "left").select(
            "k",
            F.col("u_top").alias("top"),
            F.coalesce("base", "u_base").alias("base"),
            (F.col("dist") + F.coalesce("u_dist", F.lit(0))).alias("dist"),
            F.when(shut, F.col("names")).otherwise(F.concat_ws("/", "u_names", "names")).alias("names"),
            F.when(shut, F.col("ids")).otherwise(F.concat_ws(_SEP, "u_ids", "ids")).alias("ids"),
            "loop",
        )
        state = materialize(state, "doubled")
    return materialize(state.unionByName(lost), "doubled")


def _with_loops(done: DataFrame, nodes: DataFrame, one_task_rows: int) -> DataFrame:
    """Tells the nodes on a loop from those below one: following n parents from all of them ends on the loops."""
    bad = done.where("loop = 1").select("k")
    jump = materialize(nodes.join(bad, "k", "left_semi").select("k", F.col("p").alias("to")), "loops")
    n = jump.count()
    if n > one_task_rows:
        for _ in range(n.bit_length() + 1):
            far = jump.select(F.col("k").alias("to"), F.col("to").alias("far"))
            jump = materialize(jump.join(far, "to").select("k", F.col("far").alias("to")), "loops")
        on = jump.select(F.col("to").alias("k")).distinct()
    else:

        def cycles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            to: dict[str, str] = {}
            for b in batches:
                to.update(zip(b["k"], b["to"], strict=True))
            seen: dict[str, int] = {}
            found: list[str] = []
            for start in to:
                i, chain = start, []
                while i not in seen:
                    seen[i] = 1
                    chain.append(i)
                    i = to[i]
                if seen[i] == 1:
                    found += chain[chain.index(i) :]
                for j in chain:
                    seen[j] = 2
            yield pd.DataFrame({"k": pd.Series(found, dtype="object")})

        on = jump.coalesce(1).mapInPandas(cycles, "k string")
    in_loop = F.col("loop") == 1
    keep = lambda c: F.when(~in_loop, F.col(c))
    return done.join(on.withColumn("_on", F.lit(True)), "k", "left").select(
        F.col("k").alias("node"),
        keep("base").alias("root"),
        keep("dist").alias("depth"),
        keep("names").alias("path"),
        F.when(~in_loop, F.split("ids", _SEP)).alias("ancestors"),
        in_loop.alias("in_loop"),
        F.coalesce("_on", F.lit(False)).alias("on_loop"),
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """All pairs (ancestor, descendant, distance), distance at least 1, from `resolve_hierarchy`; loops have none.

    Made by a projection of each node's own ancestors, so a root with a third of all nodes below it needs no group.
    """
    up = resolved.where("not in_loop").select("node", "depth", F.posexplode("ancestors").alias("pos", "ancestor"))
    return up.where("pos < depth").select("ancestor", F.col("node").alias("descendant"), (F.col("depth") - F.col("pos")).alias("distance"))


def hierarchy_faults(rows: DataFrame, resolved: DataFrame, id_col: str = "folder_id", depth_col: str = "depth", path_col: str = "path") -> DataFrame:
    """Rows of the table against the derived tree: distinct (id as stored, fault), fault one of loop, depth, path.

    A null stored depth or path is nothing stored, hence no fault. Rows without an id are left out.
    """
    own = rows.select(F.col(id_col).alias("id"), key(id_col).alias("node"), F.col(depth_col).alias("s_depth"), F.col(path_col).alias("s_path")).where("node is not null").distinct()
    r = resolved.select("node", "depth", "path", "in_loop")
    fault = F.array_compact(F.array(F.when(F.col("in_loop"), F.lit("loop")), F.when(~F.col("in_loop") & (F.col("s_depth") != F.col("depth")), F.lit("depth")), F.when(~F.col("in_loop") & (F.col("s_path") != F.col("path")), F.lit("path"))))
    return own.join(r, "node").select("id", F.explode(fault).alias("fault")).distinct()
