"""Grouping, ranking, sampling, joining and upserting, as functions from DataFrames to DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslathe.functions.text import col
from corpuslathe.runtime import materialize

NULL = "<null>"


def shown(c: Column | str, missing: str = NULL) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(missing))


def distribution(df: DataFrame, column: str, missing: str = NULL) -> DataFrame:
    """(value, rows): how often each value occurs; nulls under a name of their own."""
    return df.groupBy(shown(column, missing).alias("value")).agg(F.count("*").alias("rows"))


def distributions(df: DataFrame, columns: list[str], missing: str = NULL) -> DataFrame:
    """(dimension, value, rows) of several columns in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("dimension"), shown(c, missing).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("rows"))


def member_counts(df: DataFrame, array: Column | str) -> DataFrame:
    """(value, rows): how many rows have each member of an array; a member counts once a row."""
    return df.select(F.explode(F.array_distinct(col(array))).alias("value")).groupBy("value").agg(F.count("*").alias("rows"))


def clusters(df: DataFrame, key: str, member: str, least: int = 2) -> DataFrame:
    """(key, members, first_member) of keys with at least `least` rows; null keys form none. Aggregates partially, so a hot key is no problem."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("members"), F.min(member).alias("first_member")).where(F.col("members") >= least)


def size_histogram(groups: DataFrame, size: str) -> DataFrame:
    return groups.groupBy(F.col(size).alias("size")).agg(F.count("*").alias("groups"))


def normalized_groups(df: DataFrame, key: str, text: str, normalizer: Callable[[Column], Column], least: int = 2, weight: str | None = None) -> DataFrame:
    """(fingerprint, variants, first_key) of different texts that a normalizer makes equal: candidates, never merged. weight: a column whose sum is given as `assets`."""
    w = F.coalesce(F.col(weight), F.lit(0)) if weight else F.lit(0)
    one = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.sha2(normalizer(F.col(text)), 256).alias("fingerprint"), w.alias("w")).distinct()
    g = one.groupBy("fingerprint").agg(F.count("*").alias("variants"), F.min("k").alias("first_key"), F.sum("w").alias("assets")).where(F.col("variants") >= least)
    return g if weight else g.drop("assets")


def running(df: DataFrame, order: list[Column], amount: Column, name: str = "upto") -> tuple[DataFrame, int]:
    """(`df` with the sum of `amount` over all rows up to each one in order, the sum of all).

    Rows are sorted by ranges; each range adds up its own, and what the ranges before it have is known from one sum a range, the
    only thing that reaches the driver. No task orders more than its range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id(), "_n": amount.cast("bigint")}), "ranged")
    before, total = [], 0
    for r in ranged.groupBy("_part").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).orderBy("_part").collect():
        before.append((r["_part"], total))
        total += r["n"]
    start = df.sparkSession.createDataFrame(before, "_part int, _before bigint")
    own = F.sum("_n").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("_own", own).join(F.broadcast(start), "_part").withColumn(name, F.col("_own") + F.col("_before")).select(*df.columns, name), total  # one row a range


def numbered(df: DataFrame, *order: Column, name: str = "number") -> DataFrame:
    """`df` with the place of each row in a total order, from 1."""
    return running(df, list(order), F.lit(1), name)[0]


def numbered_members(df: DataFrame, group: str, member: str, name: str = "ordinal") -> DataFrame:
    """Distinct (group, member) with the place of each member in its group, from 0. A group may be far larger than a task: ranges are ordered, not groups."""
    all_ = numbered(df.select(group, member).where(F.col(group).isNotNull()).distinct(), F.col(group), F.col(member), name="_place")
    first = all_.groupBy(group).agg(F.min("_place").alias("_first"))
    return all_.join(first, group).select(group, (F.col("_place") - F.col("_first")).alias(name), member)


def nearest_index_percentiles(df: DataFrame, value: str, fractions: list[float]) -> DataFrame:
    """(fraction, value): of the sorted values that at index round((n - 1) * fraction), halves to even; no rows: none."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    run, total = running(counts, [F.col("v")], F.col("n"))
    f = run.withColumn("fraction", F.explode(F.array(*(F.lit(x) for x in fractions))))
    at = F.bround((F.lit(total) - 1) * F.col("fraction"), 0)
    return f.where((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at)).select("fraction", F.col("v").alias("value"))


def outliers(df: DataFrame, key: str, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows (key, value, side) at or below the low and at or above the high percentile, ends included."""
    p = nearest_index_percentiles(df, value, [low, high]).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    rows = df.select(key, value, F.lit(1).alias("_k")).join(F.broadcast(p.withColumn("_k", F.lit(1))), "_k")  # one row
    side = F.array_compact(F.array(F.when(F.col(value) <= F.col("lo"), F.lit("bottom")), F.when(F.col(value) >= F.col("hi"), F.lit("top"))))
    return rows.select(key, F.col(value).alias("value"), F.explode(side).alias("side"))


def outlier_order(rows: DataFrame, key: str) -> DataFrame:
    """`outliers` with the place of each in its side: from the shortest up, from the longest down, ties by key."""
    far = F.when(F.col("side") == "bottom", F.col("value")).otherwise(-F.col("value"))
    all_ = numbered(rows.withColumn("_far", far), F.col("side"), F.col("_far"), F.col(key), name="_place")
    first = all_.groupBy("side").agg(F.min("_place").alias("_first"))
    return all_.join(F.broadcast(first), "side").select(key, "value", "side", (F.col("_place") - F.col("_first") + 1).alias("place"))  # two sides


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: str | list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group with their rank; partitions drop what can't be among them before the shuffle."""
    by = [group] if isinstance(group, str) else group
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def hash_sample(df: DataFrame, key: str, dimensions: list[str], per_value: int, version: str, forced: DataFrame | None = None) -> DataFrame:
    """Distinct keys: of each value of each dimension the first by a hash of (version, dimension, value, key); and the forced ones."""
    pairs = F.array(*(F.struct(F.lit(c).alias("dimension"), shown(c).alias("value")) for c in dimensions))
    rows = df.select(F.col(key).alias("key"), F.explode(pairs).alias("p")).select("key", "p.dimension", "p.value")
    rows = rows.withColumn("h", F.sha2(F.concat_ws("|", F.lit(version), "dimension", "value", "key"), 256))
    picked = top_per_group(rows, ["dimension", "value"], per_value, F.col("h"), F.col("key")).select("key")
    return (picked.union(forced.select(F.col(forced.columns[0]).alias("key"))) if forced is not None else picked).distinct()


def first_wins(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in order (insert or ignore)."""
    cols = df.columns
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").select(*cols)


def repeats(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The rows that first_wins drops, with `occurrence` from 2: to be recorded as issues, not lost."""
    return df.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("occurrence > 1")


def insert_or_ignore(table: DataFrame, new: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The table with the new rows whose key it doesn't have; of equal new keys the first."""
    return table.unionByName(first_wins(new, keys, *order).join(table.select(*keys), keys, "left_anti").select(*table.columns))


def upsert(table: DataFrame, new: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The table with the new rows in place of those of equal key; of equal new keys the last in order."""
    latest = first_wins(new, keys, *(o.desc() for o in order))
    return table.join(latest.select(*keys), keys, "left_anti").select(*table.columns).unionByName(latest.select(*table.columns))


def replace_keys(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys in `new` are replaced by its rows (several to a key)."""
    return table.join(new.select(*keys).distinct(), keys, "left_anti").select(*table.columns).unionByName(new.select(*table.columns))


def incremental(source: DataFrame, previous: DataFrame, key: str, version: str, config: str) -> tuple[DataFrame, DataFrame]:
    """(to do, kept): source (key, input_digest, ...) whose result isn't there yet for the same digest, version and config; results that still hold."""
    same = [key, "input_digest"]
    valid = previous.where((F.col("version") == version) & (F.col("config") == config))
    return source.join(valid.select(*same), same, "left_anti"), valid.join(source.select(*same), same, "left_semi")


def closure(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(side, keys): keys only one of two tables has; no rows if they hold the same."""
    a, b = left.select(*keys).distinct().withColumn("_l", F.lit(True)), right.select(*keys).distinct().withColumn("_r", F.lit(True))
    j = a.join(b, keys, "full_outer").where("_l is null or _r is null")
    return j.select(F.when(F.col("_r").isNull(), "left_only").otherwise("right_only").alias("side"), *keys)


def nested_export(keys: DataFrame, prompts: DataFrame, assets: DataFrame, memberships: DataFrame) -> DataFrame:
    """Per requested key: (ordinal, prompt_sha256, found, assets), assets an array of (asset_id, folders) in order of their ids.

    keys: (ordinal, prompt_sha256), a request of moderate size; only its assets are collected. Children are collected before they are
    joined, so rows don't multiply. A key that isn't there has found false. The rows' order is that of `ordinal`.
    """
    a = assets.select("asset_id", "prompt_sha256").join(keys.select("prompt_sha256").distinct(), "prompt_sha256", "left_semi").distinct()
    m = memberships.join(a.select("asset_id").distinct(), "asset_id", "left_semi").groupBy("asset_id").agg(F.array_sort(F.collect_set("folder_id")).alias("folders"))
    a = a.join(m, "asset_id", "left")
    a = a.groupBy("prompt_sha256").agg(F.array_sort(F.collect_list(F.struct("asset_id", F.coalesce("folders", F.array().cast("array<string>")).alias("folders")))).alias("assets"))
    p = prompts.select("prompt_sha256").join(keys.select("prompt_sha256"), "prompt_sha256", "left_semi").distinct().withColumn("found", F.lit(True))
    return keys.join(p, "prompt_sha256", "left").join(a, "prompt_sha256", "left").select("ordinal", "prompt_sha256", F.coalesce("found", F.lit(False)).alias("found"), F.coalesce("assets", F.array().cast("array<struct<asset_id:string,folders:array<string>>>")).alias("assets"))


def direct_counts(folders: DataFrame) -> DataFrame:
    """(folder_id, children, child_reported, derived_direct, path_depth, issue) from folders (folder_id, parent_id, path, reported_asset_count).

    A reported count includes subfolders, so what is direct is the count less the children's. issue: missing_parent, negative_derived_direct_count
    or null. Each folder once.
    """
    f = folders.select("folder_id", "parent_id", "path", "reported_asset_count").distinct()
    kids = f.where("parent_id is not null").groupBy(F.col("parent_id").alias("folder_id")).agg(F.count("*").alias("children"), F.sum("reported_asset_count").alias("child_reported"))
    known = f.select(F.col("folder_id").alias("parent_id"), F.lit(True).alias("parent_known")).distinct()
    j = f.join(kids, "folder_id", "left").join(known, "parent_id", "left").withColumn("child_reported", F.coalesce("child_reported", F.lit(0)))
    direct = F.col("reported_asset_count") - F.col("child_reported")
    depth = F.greatest(F.lit(0), F.size(F.filter(F.split(F.coalesce("path", F.lit("")), "/"), lambda x: x != "")) - 1)
    issue = F.when(F.col("parent_id").isNotNull() & F.col("parent_known").isNull(), "missing_parent").when(direct < 0, "negative_derived_direct_count")
    return j.select("folder_id", F.coalesce("children", F.lit(0)).alias("children"), "child_reported", direct.alias("derived_direct"), depth.alias("path_depth"), issue.alias("issue"))


def families_in_turn(df: DataFrame, key: str, family: str, families: list[str], n: int, *order: Column) -> DataFrame:
    """(family, rank, key): the first n of each family; families choose in turn, and keys that an earlier one chose come last.

    One ranking per family (their number is fixed by the rules); what was chosen before is at most n keys a family.
    """
    chosen = None
    for fam in families:
        rows = df.where(F.col(family) == fam)
        if chosen is not None:
            rows = rows.join(F.broadcast(chosen.select(key).distinct().withColumn("_before", F.lit(1))), key, "left")  # at most n a family
            rows = rows.withColumn("_before", F.coalesce("_before", F.lit(0)))
        else:
            rows = rows.withColumn("_before", F.lit(0))
        lead, rest = order[:-1], order[-1:]
        got = top(rows, n, *lead, F.col("_before"), *rest).withColumn("_f", F.lit(fam))
        got = got.withColumn("rank", F.row_number().over(Window.partitionBy("_f").orderBy(*lead, F.col("_before"), *rest))).select(F.col("_f").alias("family"), "rank", key)
        chosen = got if chosen is None else chosen.unionByName(got)
    return chosen


def greedy_quota(df: DataFrame, key: str, family: str, blockers: str, quota: int, *order: Column, chunk: int = 20_000) -> DataFrame:
    """(key, family, decision): candidates in order; chosen unless their key or one of their blocking groups was chosen before, or the family is full.

    decision: selected, duplicate_key, blocked, quota_reached. Any number of candidates: what is chosen (at most `quota` a family) decides about
    all others, so rounds fold over the next `chunk` candidates that nothing chosen so far rules out, until none is left; then each
    row is judged by what was chosen before its place. The first row of a round is always chosen, and full families drop out at once.
    """
    rows = numbered(df, *order, name="_o")
    rows = materialize(rows.select("_o", F.col(key).cast("string").alias("key"), F.col(family).cast("string").alias("family"), F.coalesce(F.col(blockers), F.array().cast("array<string>")).alias("blockers")), "candidates")
    keys: dict = {}
    groups: dict = {}
    chosen: dict = {}
    done = 0
    while True:
        left = rows.where(F.col("_o") > done).mapInPandas(_judged(keys, groups, chosen, quota), "_o bigint, key string, family string, blockers array<string>, decision string").where("decision = 'selected'")
        got = left.orderBy("_o").limit(chunk).collect()
        for r in got:
            own = set(r["blockers"])
            if r["key"] in keys or own & groups.keys() or len(chosen.get(r["family"], ())) >= quota:
                continue
            keys[r["key"]] = r["_o"]
            groups.update({g: r["_o"] for g in own if g not in groups})
            chosen.setdefault(r["family"], []).append(r["_o"])
        if len(got) < chunk:
            break
        done = got[-1]["_o"]
    return rows.mapInPandas(_judged(keys, groups, chosen, quota), "_o bigint, key string, family string, blockers array<string>, decision string").select("key", "family", "decision")


def _judged(keys: dict, groups: dict, chosen: dict, quota: int):  # noqa: ANN202
    """Each row's decision by what was chosen before its place."""
    keys, groups, full = dict(keys), dict(groups), {f: places[quota - 1] for f, places in chosen.items() if quota and len(places) >= quota}
    own_places = {p for places in chosen.values() for p in places}

    def decide(o, k, f, bs) -> str:  # noqa: ANN001
        if o in own_places:
            return "selected"
        if keys.get(k, o) < o:
            return "duplicate_key"
        if any(groups.get(b, o) < o for b in bs):
            return "blocked"
        return "quota_reached" if quota <= 0 or full.get(f, o) < o else "selected"

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            yield b.assign(decision=[decide(*x) for x in zip(b["_o"], b["key"], b["family"], b["blockers"], strict=True)])

    return run


def object_key_counts(df: DataFrame, json: str, name: str) -> DataFrame:
    """(value, rows): how often each value of a key occurs among the objects of JSON arrays; text that is no array of objects has none, an object without the key counts as null."""
    items = F.try_variant_get(F.try_parse_json(json), "$", "array<variant>")
    item = df.select(F.explode(items).alias("item")).where(F.schema_of_variant("item").startswith("OBJECT"))
    return item.select(shown(F.try_variant_get("item", f"$.{name}", "string")).alias("value")).groupBy("value").agg(F.count("*").alias("rows"))


def case_numbers(df: DataFrame, family: str, *order: Column, prefix: str = "scene-case") -> DataFrame:
    """`df` with `case_id` (prefix, family, two-digit place in it) and `rank` over all; for the chosen few of `greedy_quota`."""
    in_family = F.row_number().over(Window.partitionBy(family).orderBy(*order))
    return numbered(df.withColumn("case_id", F.concat_ws("-", F.lit(prefix), family, F.lpad(in_family.cast("string"), 2, "0"))), *order, name="rank")


def group_memberships(selected: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """(key, group_type, fingerprint): which groups (group_type, fingerprint, key) a selected key belongs to; keys without a group have one row with nulls."""
    return selected.select(key).distinct().join(groups.select(key, "group_type", "fingerprint").distinct(), key, "left")


def assembled(keys: DataFrame, key: str, **parts: DataFrame) -> DataFrame:
    """(key, missing, complete) and, for each part, `n_` and its name: how many rows of each part belong to a key. Parts are counted before they are joined; a part without rows for a key is a completeness error."""
    out = keys.select(key).distinct()
    for name, df in parts.items():
        out = out.join(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"n_{name}")), key, "left").withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0)))
    gone = F.array_compact(F.array(*(F.when(F.col(f"n_{n}") == 0, F.lit(n)) for n in parts)))
    return out.withColumn("missing", gone).withColumn("complete", F.size("missing") == 0)


def json_features(df: DataFrame, key: str, arrays: dict[str, str]) -> DataFrame:
    """(key, a column for each array): JSON arrays of texts as arrays, trimmed, in lower case, sorted, each member once; what is no array is an empty one."""
    from corpuslathe.functions.keys import key as folded

    one = lambda c: F.array_sort(F.array_distinct(F.array_compact(F.transform(F.try_variant_get(F.try_parse_json(c), "$", "array<string>"), lambda x: folded(x)))))
    return df.select(key, *(F.coalesce(one(c), F.array().cast("array<string>")).alias(n) for n, c in arrays.items()))
