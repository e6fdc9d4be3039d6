"""Data contracts as queries: each returns the rows that break it, so no rows means it holds."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslathe.functions.text import col, slice_of


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows) that occur more than once, or are null."""
    null = F.greatest(*(F.col(k).isNull().cast("int") for k in [*keys, *keys])) == 1
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where((F.col("rows") > 1) | null)


def foreign_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows): referred to and not there; null refers to nothing."""
    used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("rows"))
    return used.join(parent.select(F.col(parent_key).alias("key")).distinct(), "key", "left_anti")


def evidence_faults(evidence: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """Evidence (key, start, end, sha256) whose span isn't in the text, or doesn't hash to what it says: (key, start, end, fault)."""
    j = evidence.join(texts.select(key, F.col(text).alias("_t")), key, "left")
    inside = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("_t"))
    fault = F.when(F.col("_t").isNull(), "no_text").when(~inside, "outside").when(F.sha2(slice_of("_t", F.col("start"), F.col("end")), 256) != F.col("sha256"), "hash")
    return j.select(key, "start", "end", fault.alias("fault")).where("fault is not null")


def recount_faults(stated: DataFrame, rows: DataFrame, key: str, count: str) -> DataFrame:
    """(key, stated, counted) where a stored count differs from the number of rows; keys without rows count 0."""
    n = rows.groupBy(key).agg(F.count("*").alias("counted"))
    j = stated.select(key, F.col(count).alias("stated")).join(n, key, "full_outer").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return j.where(~F.col("stated").eqNullSafe(F.col("counted")))


def identity_faults(df: DataFrame, key: str, text: str, chars: str, exempt: Column) -> DataFrame:
    """(key, fault): the stored length or hash isn't the text's; `exempt` rows (redacted texts) keep the hash of the original."""
    fault = F.when(F.length(text) != F.col(chars), "length").when(~F.coalesce(exempt, F.lit(False)) & (F.sha2(F.col(text), 256) != F.col(key)), "hash")
    return df.select(key, fault.alias("fault")).where("fault is not null")


def unsorted_sets(df: DataFrame, key: str, array: str) -> DataFrame:
    """Keys whose array isn't sorted or repeats a member."""
    return df.where(~F.col(array).eqNullSafe(F.array_sort(F.array_distinct(F.col(array))))).select(key)


def missing_members(df: DataFrame, key: str, member: str, required: list[str]) -> DataFrame:
    """(key, missing): keys that lack a required member among their rows."""
    need = F.array(*(F.lit(r) for r in sorted(required)))
    return df.groupBy(key).agg(F.array_except(need, F.collect_set(member)).alias("missing")).where(F.size("missing") > 0)


def gaps(df: DataFrame, number: str) -> DataFrame:
    """(after, next): holes in what should be 1 .. n, and before its first. Each number looks for its predecessor; only those without one are compared with the last number of an earlier range."""
    n = df.where(F.col(number).isNotNull()).select(F.col(number).cast("bigint").alias("n")).distinct().withColumn("blk", F.floor(F.col("n") / 100_000))
    inner = n.withColumn("p", F.lag("n").over(Window.partitionBy("blk").orderBy("n")))
    # the first of a range meets the end of the range before; ranges without rows between them are looked up in a second, far smaller, round
    ends = n.groupBy("blk").agg(F.max("n").alias("top")).withColumn("coarse", F.floor(F.col("blk") / 100_000))
    near = ends.withColumn("before", F.lag("top").over(Window.partitionBy("coarse").orderBy("blk")))
    far = ends.groupBy("coarse").agg(F.max("top").alias("top"))
    far = far.withColumn("last", F.lag("top").over(Window.orderBy("coarse"))).select("coarse", "last")  # a row for ten billion numbers
    near = near.join(F.broadcast(far), "coarse").select("blk", F.coalesce("before", "last").alias("before"))
    j = inner.where("p is null").join(near, "blk").select("n", F.coalesce("before", F.lit(0)).alias("after")).unionByName(inner.where("p is not null").select("n", F.col("p").alias("after")))
    return j.where(F.col("n") != F.col("after") + 1).select("after", F.col("n").alias("next"))


def checks(**named: Column) -> list[Column]:
    """Aggregates (1 where the condition holds for all rows) by name, for `check_report`."""
    return [F.bool_and(c).alias(n) for n, c in named.items()]


def check_report(row: DataFrame) -> DataFrame:
    """One row of named booleans as (check, passed), with `all` for their conjunction."""
    names = row.columns
    pairs = F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(False)).alias("passed")) for n in names), F.struct(F.lit("all").alias("check"), F.coalesce(F.least(*(F.coalesce(F.col(n), F.lit(False)) for n in [*names, *names])), F.lit(False)).alias("passed")))
    return row.select(F.explode(pairs).alias("p")).select("p.check", "p.passed")


def check_counters(results: DataFrame) -> DataFrame:
    """(check, evaluated, passed, failed) of rows (check, passed)."""
    return results.groupBy("check").agg(F.count("*").alias("evaluated"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def same_files(a: DataFrame, b: DataFrame) -> DataFrame:
    """(path, fault) where two manifests (path, sha256) differ: missing, extra or changed."""
    j = a.select("path", F.col("sha256").alias("x")).join(b.select("path", F.col("sha256").alias("y")), "path", "full_outer")
    return j.select("path", F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").when(F.col("x") != F.col("y"), "changed").alias("fault")).where("fault is not null")


def line_coverage(ranges: DataFrame, total: int) -> DataFrame:
    """(line, times): lines of 1 .. total that ranges (first, last) don't cover exactly once."""
    spark = ranges.sparkSession
    used = ranges.select(F.explode(F.sequence("first", "last")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    return spark.range(1, total + 1).withColumnRenamed("id", "line").join(used, "line", "full_outer").withColumn("times", F.coalesce("times", F.lit(0))).where((F.col("times") != 1) | ~F.col("line").between(1, total))


#: What must not be in text that is handed on, and which tokens of the other adapter must not reach a target.
LEAKS = {
    "source_asset_id": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",
    "media_url": r"(?i)https?://",
    "historical_at_tag": r"(?<![\w@])@[A-Za-z][A-Za-z0-9_.-]*",
    "historical_duration": r"(?i)\b\d+(?:\.\d+)?\s*(?:s|sec|secs|second|seconds)\b|\d+(?:\.\d+)?\s*秒",
}
FOREIGN = {
    "seedance": ("h3_syntax", ["Context-IR", "<Picture 1>", "<Video 1>", "<Audio 1>"]),
    "h3": ("seedance_syntax", ["@source_tag", "Seedance adapter", "Seedance output schema"]),
}
NOT_HANDED_ON = ["task_id", "case_id", "final_owner"]


def leaks(c: Column | str, target: Column | None = None) -> Column:
    """Codes of the kinds of leak a text has, and `kind:token` for each token of another adapter that a text for `target` holds."""
    t = col(c)
    own = [F.when(t.rlike(p), F.lit(n)) for n, p in LEAKS.items()]
    if target is not None:
        own += [F.when((target == name) & F.contains(t, F.lit(x)), F.lit(f"{kind}:{x}")) for name, (kind, xs) in FOREIGN.items() for x in xs]
    return F.array_compact(F.array(*own))


def string_leaves(df: DataFrame, key: str, document: str, without: tuple[str, ...] = ()) -> DataFrame:
    """(key, path, value): every string in JSON texts, at any depth, with where it stands; top-level members in `without` are left out.

    What is no JSON has none. Numbers, booleans and nulls are no strings. The walk keeps its own stack, so depth is bounded by the parser alone.
    """
    k_type = df.schema[key].dataType.simpleString()
    skip = frozenset(without)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["d"], strict=True):
                try:
                    root = json.loads(t)
                except (TypeError, ValueError, RecursionError):
                    continue
                if isinstance(root, dict):
                    root = {n: v for n, v in root.items() if n not in skip}
                stack = [("$", root)]
                while stack:
                    path, v = stack.pop()
                    if isinstance(v, str):
                        rows.append((k, path, v))
                    elif isinstance(v, dict):
                        stack += [(f"{path}.{n}", x) for n, x in reversed(v.items())]
                    elif isinstance(v, list):
                        stack += [(f"{path}[{i}]", x) for i, x in reversed(list(enumerate(v)))]
            yield pd.DataFrame(rows, columns=["key", "path", "value"])

    return df.select(F.col(key).alias("k"), F.col(document).alias("d")).mapInPandas(run, f"key {k_type}, path string, value string")


def handoff_faults(handoffs: DataFrame, key: str, document: str, target: str) -> DataFrame:
    """(key, code): leaks in any string of a handed-on JSON document, its own ids and owner left out; codes once a document."""
    leaves = string_leaves(handoffs, key, document, tuple(NOT_HANDED_ON)).join(handoffs.select(F.col(key).alias("key"), F.col(target).alias("_target")), "key")
    return leaves.select("key", F.explode(leaks("value", F.col("_target"))).alias("code")).distinct()


def shared_fragments(left: str, right: str) -> Column:
    """Members of two arrays of texts that both have, compared trimmed: what was put into both lists of a handoff."""
    trim = lambda c: F.transform(F.coalesce(col(c), F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.array_sort(F.array_intersect(trim(left), trim(right)))


def retrieval(signals: Column | str, triggers: list[str], skip: str) -> Column:
    """(retrieve, reason): the first trigger in the contract's order that is among the signals wins; else the skip signal; else none."""
    s = col(signals)
    first = F.get(F.array_intersect(F.array(*(F.lit(t) for t in triggers)), s), F.lit(0))
    reason = F.coalesce(first, F.when(F.array_contains(s, skip), F.lit(skip)), F.lit("no_retrieval_trigger"))
    return F.struct(first.isNotNull().alias("retrieve"), reason.alias("reason"))


def schema_faults(df: DataFrame, key: str, document: str, schema: dict[str, Any]) -> DataFrame:
    """(key, code, path, message) of JSON texts against a JSON schema.

    Keywords: $ref (#/...), type, const, enum, minLength, pattern, minimum, minItems, maxItems, prefixItems, items, required,
    properties, additionalProperties (false or a schema). Text that is no JSON, or null, gives invalid_json.
    """
    k_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["d"], strict=True):
                try:
                    value = json.loads(t)
                except (TypeError, ValueError):
                    rows.append((k, "invalid_json", "$", "not JSON"))
                    continue
                rows += [(k, *f) for f in validate(value, schema)]
            yield pd.DataFrame(rows, columns=["key", "code", "path", "message"])

    return df.select(F.col(key).alias("k"), F.col(document).alias("d")).mapInPandas(run, f"key {k_type}, code string, path string, message string")


class Schema:
    """The keywords of the published standard that are asserted here, a handler each; what a keyword doesn't apply to passes it."""

    def __init__(self, root: dict[str, Any]) -> None:
        self.root = root

    def faults(self, value: Any, schema: Any, path: str = "$") -> list[tuple[str, str, str]]:
        """(code, path, message) of each fault; true and the empty schema accept all, false nothing."""
        if isinstance(schema, bool):
            return [] if schema else [("false", path, "nothing is allowed here")]
        found = []
        for name, wanted in schema.items():
            handler = getattr(self, f"on_{name.lstrip('$').lower()}", None)
            if handler:
                found += handler(value, wanted, schema, path)
        return found

    def on_ref(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        at: Any = self.root
        for step in filter(None, wanted.lstrip("#").split("/")):
            at = at[step.replace("~1", "/").replace("~0", "~")]
        return self.faults(value, at, path)

    @staticmethod
    def kinds(value: Any) -> set[str]:
        """The standard's names for what a value is; a whole number is a number too, however it is written."""
        match value:
            case None:
                return {"null"}
            case bool():
                return {"boolean"}
            case int() | float():
                return {"number", "integer"} if float(value).is_integer() else {"number"}
            case str():
                return {"string"}
            case list():
                return {"array"}
            case _:
                return {"object"}

    def on_type(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        names = {wanted} if isinstance(wanted, str) else set(wanted)
        return [] if names & self.kinds(value) else [("type", path, f"is not of type {', '.join(sorted(names))}")]

    def on_enum(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [] if any(_same(value, x) for x in wanted) else [("enum", path, "is none of the enumerated values")]

    def on_const(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [] if _same(value, wanted) else [("const", path, f"is not {json.dumps(wanted, ensure_ascii=False)}")]

    def on_minimum(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("minimum", path, f"is below {wanted}")] if "number" in self.kinds(value) and value < wanted else []

    def on_minlength(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("minLength", path, f"has fewer than {wanted} characters")] if isinstance(value, str) and len(value) < wanted else []

    def on_pattern(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("pattern", path, f"has no match of {wanted}")] if isinstance(value, str) and not re.search(wanted, value) else []

    def on_minitems(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("minItems", path, f"has fewer than {wanted} items")] if isinstance(value, list) and len(value) < wanted else []

    def on_maxitems(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("maxItems", path, f"has more than {wanted} items")] if isinstance(value, list) and len(value) > wanted else []

    def on_prefixitems(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        pairs = enumerate(zip(value, wanted, strict=False)) if isinstance(value, list) else ()
        return [f for i, (x, sub) in pairs for f in self.faults(x, sub, f"{path}[{i}]")]

    def on_items(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        start = len(schema.get("prefixItems", ()))
        rest = list(enumerate(value))[start:] if isinstance(value, list) else ()
        return [f for i, x in rest for f in self.faults(x, wanted, f"{path}[{i}]")]

    def on_required(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [("required", f"{path}.{n}", "is required") for n in wanted if isinstance(value, dict) and n not in value]

    def on_properties(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        return [f for n, sub in wanted.items() if isinstance(value, dict) and n in value for f in self.faults(value[n], sub, f"{path}.{n}")]

    def on_additionalproperties(self, value, wanted, schema, path):  # noqa: ANN001, ANN201
        more = [n for n in value if n not in schema.get("properties", {})] if isinstance(value, dict) else []
        if wanted is False:
            return [("additionalProperties", f"{path}.{n}", "is not a property of this object") for n in more]
        return [f for n in more for f in self.faults(value[n], wanted, f"{path}.{n}")]


def _same(a: Any, b: Any) -> bool:
    """Equality of JSON values: true is not 1."""
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def validate(value: Any, schema: dict[str, Any]) -> list[tuple[str, str, str]]:
    """(code, path, message) of each fault of a JSON value against a schema, in the order of the schema's keywords."""
    return Schema(schema).faults(value, schema)


def signal_coverage(tasks: DataFrame, target: str, signals: str, required: list[str]) -> DataFrame:
    """(target, missing): targets whose tasks together lack a required signal."""
    per = tasks.select(target, F.explode_outer(signals).alias("s")).groupBy(target).agg(F.collect_set("s").alias("have"))
    return per.select(target, F.array_except(F.array(*(F.lit(r) for r in sorted(required))), "have").alias("missing")).where(F.size("missing") > 0)


def issue_register(rows: DataFrame, status: str, codes: str, failed: str | None = None) -> DataFrame:
    """(status, code, rows, failed) of issue codes by status; rows without a code under <none>; failed counts those whose flag of that name is set."""
    code = F.explode(F.when(F.size(codes) > 0, F.col(codes)).otherwise(F.array(F.lit("<none>"))))
    bad = F.col(failed) if failed else F.lit(False)
    return rows.select(F.col(status).alias("status"), bad.alias("_f"), code.alias("code")).groupBy("status", "code").agg(F.count("*").alias("rows"), F.count_if("_f").alias("failed"))


def digest_chain(stages: DataFrame) -> DataFrame:
    """(stage, fault) of manifests (stage, ordinal, status, input_digest, output_digest): a stage that took other input than the one before gave, or took input that hadn't passed."""
    before = stages.select((F.col("ordinal") + 1).alias("ordinal"), F.col("output_digest").alias("given"), F.col("status").alias("state"))
    j = stages.join(before, "ordinal", "left").where("state is not null")
    fault = F.when(F.col("state") != "passed", "input_not_passed").when(~F.col("input_digest").eqNullSafe(F.col("given")), "input_digest")
    return j.select("stage", fault.alias("fault")).where("fault is not null")


def changed_settings(stored: DataFrame, now: DataFrame) -> DataFrame:
    """(name, stored, now) of settings (name, value) that differ from those a run was begun with."""
    j = stored.select("name", F.col("value").alias("stored")).join(now.select("name", F.col("value").alias("now")), "name", "full_outer")
    return j.where(~F.col("stored").eqNullSafe(F.col("now")))


def children_faults(rows: DataFrame) -> DataFrame:
    """(page_number, folder_id, code) of listed children (page_number, item_index, asked_parent, folder_id, parent_id): another parent than asked for, or twice in a page."""
    r = rows.withColumn("n", F.row_number().over(Window.partitionBy("page_number", "folder_id").orderBy("item_index")))
    codes = F.array_compact(F.array(F.when(~F.col("parent_id").eqNullSafe(F.col("asked_parent")), F.lit("parent_mismatch")), F.when(F.col("n") > 1, F.lit("duplicate_folder_in_page"))))
    return r.select("page_number", "folder_id", F.explode(codes).alias("code"))


def _report(df_rows: DataFrame) -> DataFrame:
    """(check, actual, expected, passed) with `all`: how many passed of how many."""
    rows = df_rows.select("check", F.col("actual").cast("bigint").alias("actual"), F.col("expected").cast("bigint").alias("expected"), F.col("actual").eqNullSafe(F.col("expected")).alias("passed"))
    return rows.unionByName(rows.agg(F.lit("all").alias("check"), F.count_if("passed").alias("actual"), F.count("*").alias("expected"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed")))


def _figures(row: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), a.cast("bigint").alias("actual"), e.cast("bigint").alias("expected")) for n, (a, e) in pairs.items()))).alias("c")).select("c.*")


def corpus_audit(occurrences: DataFrame, assets: DataFrame, prompts: DataFrame, folders: DataFrame) -> DataFrame:
    """(check, actual, expected, passed) of a crawl: occurrences (asset_id, source_page, source_item_index), assets (asset_id, folder_id, prompt_sha256), prompts, folders.

    What pages say they hold against what was recorded, what was recorded against what became assets and repeats, pages without gaps, texts without
    URLs and as long and hashed as they should be, references that lead somewhere. Tables of any size: each is read once and only counted.
    """
    zero = F.lit(0)
    pages = occurrences.groupBy("source_page").agg((F.max("source_item_index") + 1).alias("stated"), F.count("*").alias("n"))
    seen = pages.agg(F.sum("stated").alias("stated"), F.sum("n").alias("n"), F.count("source_page").alias("pages"), F.max("source_page").alias("last"))
    per = occurrences.groupBy("asset_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("unique"), F.sum(F.col("n") - 1).alias("again"))
    text = prompts.agg(F.count_if(F.lower("prompt_text").rlike("https?://")).alias("urls"), F.count_if((F.col("url_redaction_count") == 0) & (F.sha2("prompt_text", 256) != F.col("prompt_sha256"))).alias("hashes"), F.count_if(F.length("prompt_text") != F.col("analysis_prompt_chars")).alias("lengths"))
    unknown = foreign_keys(assets, "folder_id", folders, "folder_id").agg(F.coalesce(F.sum("rows"), zero).alias("unknown"))
    orphans = foreign_keys(assets, "prompt_sha256", prompts, "prompt_sha256").agg(F.count("*").alias("orphans"))
    row = seen.crossJoin(per).crossJoin(text).crossJoin(unknown).crossJoin(orphans)  # one row each
    return _report(_figures(row, {
        "item_occurrence_count": (F.col("n"), F.col("stated")), "accounted_occurrence_count": (F.col("unique") + F.col("again"), F.col("n")), "page_sequence_contiguous": (F.col("pages"), F.col("last")),
        "stored_prompt_urls_absent": (F.col("urls"), zero), "prompt_hashes_match": (F.col("hashes"), zero), "prompt_lengths_match": (F.col("lengths"), zero),
        "unknown_folder_assets_absent": (F.col("unknown"), zero), "orphan_prompts_absent": (F.col("orphans"), zero),
    }))


def inventory_audit(direct: DataFrame, folders: DataFrame) -> DataFrame:
    """(check, actual, expected, passed) of `direct_counts`: the direct counts of all folders add up to what their roots report, no parent is missing, no direct count is negative."""
    known = folders.select(F.col("folder_id").alias("parent_id"), F.lit(True).alias("_known"))
    roots = folders.select("parent_id", "reported_asset_count").join(known, "parent_id", "left").where("_known is null").agg(F.sum("reported_asset_count").alias("roots"))
    row = direct.agg(F.sum("derived_direct").alias("direct"), F.count_if(F.col("issue") == "missing_parent").alias("missing"), F.count_if(F.col("derived_direct") < 0).alias("negative")).crossJoin(roots)  # one row each
    return _report(_figures(row, {"derived_direct_asset_total": (F.col("direct"), F.col("roots")), "missing_parents_absent": (F.col("missing"), F.lit(0)), "negative_direct_counts_absent": (F.col("negative"), F.lit(0))}))


def mapping_faults(keys: DataFrame, occurrences: DataFrame, memberships: DataFrame, assets: DataFrame, key: str = "prompt_sha256") -> DataFrame:
    """(key, occurrences, assets, memberships) of keys whose mappings don't close: rows listed and distinct assets differ, or some assets have no membership."""
    n = occurrences.where(F.col(key).isNotNull()).groupBy(key, "asset_id").agg(F.count("*").alias("n")).groupBy(key).agg(F.sum("n").alias("occurrences"), F.count("*").alias("assets"))
    m = memberships.groupBy("asset_id").agg(F.count("*").alias("m")).join(assets.select("asset_id", key), "asset_id").groupBy(key).agg(F.sum("m").alias("memberships"))
    j = keys.select(key).join(n, key, "left").join(m, key, "left").select(key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("occurrences", "assets", "memberships")))
    return j.where("occurrences <> assets or assets > memberships")


def unlinked_decisions(decisions: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """Decisions (key, field, evidence_ordinal, ...) whose evidence isn't there: no ordinal, or one that no evidence of the key and field has."""
    on = [key, "field", "evidence_ordinal"]
    return decisions.join(evidence.select(key, "field", F.col("ordinal").alias("evidence_ordinal")).distinct(), on, "left_anti")


def forbidden_columns(df: DataFrame, forbidden: tuple[str, ...]) -> list[str]:
    """Columns, nested ones included, whose name holds a forbidden word: features that must not be used aren't there."""

    def names(t, path: str) -> list[str]:  # noqa: ANN001
        own = [path] if path else []
        if hasattr(t, "elementType"):
            return own + names(t.elementType, f"{path}[]")[1:]
        if hasattr(t, "fields"):
            return own + [n for f in t.fields for n in names(f.dataType, f"{path}.{f.name}".lstrip("."))]
        return own

    return [n for n in names(df.schema, "") if any(w.lower() in n.rsplit(".", 1)[-1].lower() for w in forbidden)]


def crawl_audit(records: DataFrame, errors: DataFrame, expected: int, complete: bool) -> DataFrame:
    """(check, actual, expected, passed) of one folder's crawl: records (asset_id, prompt_text) and errors, against the count that the folder reported.

    As many items as expected, all of them different assets with a prompt, none twice, no errors, no URL left; nothing passes before the run is complete.
    """
    per = records.groupBy("asset_id").agg(F.count("*").alias("n"), F.sum((F.length(F.trim("prompt_text")) > 0).cast("int")).alias("full"), F.sum(F.lower("prompt_text").rlike("https?://").cast("int")).alias("urls"))
    got = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.count("*").alias("unique"), F.coalesce(F.sum("full"), F.lit(0)).alias("full"), F.count_if(F.col("n") > 1).alias("double"), F.coalesce(F.sum("urls"), F.lit(0)).alias("urls"))
    row = got.crossJoin(errors.agg(F.count("*").alias("errors")))  # one row each
    zero, want, ended = F.lit(0), F.lit(expected), F.lit(int(complete))
    held = lambda c: F.when(ended == 1, F.col(c)).otherwise(F.lit(-1))
    return _report(_figures(row, {"run_complete": (ended, F.lit(1)), "api_item_count": (F.col("items") + F.col("errors") if complete else F.lit(-1), want), "unique_asset_count": (held("unique"), want), "non_empty_prompt_count": (held("full"), want), "duplicate_asset_count": (F.col("double"), zero), "record_error_count": (F.col("errors"), zero), "prompt_urls_remaining": (F.col("urls"), zero)}))


def timeline_faults(beats: DataFrame, key: str) -> DataFrame:
    """(key, order, fault) of timed beats (key, order, start, end): the first must start at 0, each where the one before ended, and end after it starts; orders count from 1."""
    w = Window.partitionBy(key).orderBy("order")
    b = beats.select(key, "order", "start", "end", F.row_number().over(w).alias("_n"), F.lag("end").over(w).alias("_before"))
    fault = F.when(F.col("order") != F.col("_n"), "order").when(F.col("start").isNull() | F.col("end").isNull(), "no_time").when(F.col("end") <= F.col("start"), "empty").when((F.col("_n") == 1) & (F.col("start") != 0), "starts_late").when(F.col("start") != F.col("_before"), F.when(F.col("start") > F.col("_before"), "gap").otherwise("overlap"))
    return b.select(key, "order", fault.alias("fault")).where("fault is not null")


def package_faults(documents: DataFrame, files: DataFrame, required: dict[str, str]) -> DataFrame:
    """(path, code, detail) of a package of marked-up documents (path, front_matter, headings, links) and its files (path): required front matter (name to pattern) and links that lead nowhere.

    Links to other places (with a scheme, or to a part of the same document) aren't looked up; others are resolved beside their document.
    """
    front = [F.when(~F.coalesce(F.element_at("front_matter", k).rlike(p), F.lit(False)), F.lit(k)) for k, p in required.items()]
    bad = documents.select("path", F.lit("front_matter").alias("code"), F.explode(F.array_compact(F.array(*front))).alias("detail"))
    own = documents.select("path", F.explode("links").alias("detail")).where(~F.col("detail").rlike(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:|#)"))
    folder = F.regexp_replace("path", r"[^/]*$", "")
    parts = F.split(F.concat(folder, F.regexp_replace("detail", "#.*$", "")), "/")
    step = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x))
    target = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    lost = own.withColumn("target", target).join(files.select(F.col("path").alias("target")), "target", "left_anti")
    return bad.unionByName(lost.select("path", F.lit("broken_link").alias("code"), "detail"))


def checked(rows: DataFrame, key: str, **checks_: Column) -> DataFrame:
    """(check, key, passed): each row under each named condition, for `check_counters` and its failures; a null condition has not passed."""
    each = F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks_.items()))
    return rows.select(F.col(key).alias("key"), F.explode(each).alias("c")).select("c.check", "key", "c.passed")
