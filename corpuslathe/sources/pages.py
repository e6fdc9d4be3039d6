"""Landed JSON pages of a paged API: one file a page, `{items: [...], cursor: scalar or null}`.

A page is read as text and parsed as a variant, so that items of any shape, or pages that are no JSON, become rows with issues instead of errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions import text as T


def read_pages(spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None) -> DataFrame:
    """(page_number, path, raw): the files page-N.json of a folder, as a batch or as a stream."""
    r = spark.readStream if stream else spark.read
    if stream and max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    raw = r.text(path, wholetext=True).withColumnRenamed("value", "raw")
    p = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(p, r"page-(\d+)\.json$", 1).try_cast("bigint").alias("page_number"), p.alias("path"), "raw")


def with_page(pages: DataFrame) -> DataFrame:
    """Pages with `doc` (variant; null if it is no object with an items array), `cursor` (typed key; empty and null mean the end) and `page_issue`."""
    doc = F.try_parse_json("raw")
    p = pages.withColumn("doc", doc)
    items = F.try_variant_get("doc", "$.items", "array<variant>")
    cursor = F.try_variant_get("doc", "$.cursor", "variant")
    kind = F.schema_of_variant(cursor)
    issue = (
        F.when(F.col("doc").isNull(), "page_not_json").when(items.isNull(), "items_not_a_list")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY") | (kind == "BOOLEAN"), "cursor_not_scalar")
    )
    text = F.try_variant_get("doc", "$.cursor", "string")
    key = F.when(text.isNotNull() & (text != ""), F.concat(F.when(kind == "STRING", "str").when(kind == "BIGINT", "int").otherwise("float"), F.lit(":"), text))
    return p.select("page_number", "path", F.when(issue.isNull(), items).alias("items"), F.when(issue.isNull(), key).alias("next_cursor"), issue.alias("page_issue"))


def parse_items(pages: DataFrame) -> DataFrame:
    """One row per item of `with_page`: page_number, item_index, item_type, asset (or null), prompt (or null), issues (array of severity, code).

    A blank prompt keeps its asset, without a hash. The hash is that of the text as it came; URLs are redacted after it.
    """
    rows = pages.select("page_number", F.posexplode("items").alias("item_index", "item"))
    get = lambda p, t: F.try_variant_get("item", p, t)
    is_obj = F.schema_of_variant("item").startswith("OBJECT")
    kind = get("$.type", "string")
    job = F.coalesce(F.schema_of_variant(get("$.job", "variant")).startswith("OBJECT"), F.lit(False))
    good = is_obj & F.coalesce(kind == "job", F.lit(False)) & job
    params = F.coalesce(F.schema_of_variant(get("$.job.params", "variant")).startswith("OBJECT"), F.lit(False))
    string = lambda p: F.when(F.schema_of_variant(get(p, "variant")) == "STRING", F.nullif(get(p, "string"), F.lit("")))
    asset_id, folder_id, prompt = string("$.job.id"), string("$.job.folder_id"), string("$.job.params.prompt")
    blank = prompt.isNull() | (F.length(T.strip(prompt)) == 0)
    issue = lambda when, severity, code: F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code")))
    found = F.array_compact(
        F.array(
            issue(~is_obj, "error", "item_not_object"),
            issue(is_obj & ~good, "error", "unsupported_item_type"),
            issue(good & asset_id.isNull(), "error", "missing_asset_id"),
            issue(good & folder_id.isNull(), "error", "missing_folder_id"),
            issue(good & ~params, "error", "missing_job_params"),
            issue(good & ~blank & (T.url_count(prompt) > 0), "warning", "prompt_url_redacted"),
            issue(good & blank, "error", "empty_prompt"),
        )
    )
    sha = F.when(good & ~blank, F.sha2(prompt, 256))
    asset = F.when(
        good & asset_id.isNotNull(),
        F.struct(
            asset_id.alias("asset_id"), folder_id.alias("folder_id"), kind.alias("item_type"), get("$.job.results.raw.type", "string").alias("asset_type"), get("$.job.status", "string").alias("status"), get("$.job.job_set_type", "string").alias("job_set_type"),
            get("$.job.params.model", "string").alias("model"), get("$.job.created_at", "double").alias("created_at_unix"), get("$.job.params.width", "bigint").alias("width"), get("$.job.params.height", "bigint").alias("height"),
            get("$.job.params.duration", "double").alias("duration_seconds"), get("$.job.params.resolution", "string").alias("resolution"), sha.alias("prompt_sha256"),
        ),
    )
    red = T.redact_urls(prompt)
    text = F.when(sha.isNotNull(), F.struct(sha.alias("prompt_sha256"), red.alias("prompt_text"), F.length(prompt).cast("bigint").alias("source_prompt_chars"), F.length(red).cast("bigint").alias("analysis_prompt_chars"), T.url_count(prompt).cast("bigint").alias("url_redaction_count")))
    return rows.select("page_number", F.col("item_index").cast("bigint").alias("item_index"), F.when(is_obj, kind).alias("item_type"), asset.alias("asset"), text.alias("prompt"), found.alias("issues"))


def strict_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of parse_items in its strict form: the first error of an item in order decides, and an item is a record or an error.

    Here the hash is that of the redacted text, and the original's is kept beside it.
    """
    errors = F.filter("issues", lambda i: i["severity"] == "error")
    rows = parsed.withColumn("error", F.get(errors, F.lit(0))["code"])
    good = rows.where("error is null").select("page_number", "item_index", "asset.*", F.sha2("prompt.prompt_text", 256).alias("redacted_sha256"), "prompt.prompt_text")
    return good, rows.where("error is not null").select("page_number", "item_index", "error")


def in_page_faults(records: DataFrame, folder: str) -> DataFrame:
    """(page_number, item_index, code): an asset twice in a page, or of another folder than asked for."""
    from pyspark.sql import Window

    r = records.withColumn("n", F.row_number().over(Window.partitionBy("page_number", "asset_id").orderBy("item_index")))
    codes = F.array_compact(F.array(F.when(F.col("n") > 1, F.lit("duplicate_asset_in_page")), F.when(~F.col("folder_id").eqNullSafe(F.lit(folder)), F.lit("folder_mismatch"))))
    return r.select("page_number", "item_index", F.explode(codes).alias("code"))


def cursor_faults(pages: DataFrame, *group: str) -> DataFrame:
    """(group, page_number, fault) of pages (group, page_number, requested_cursor, next_cursor, items): a cursor that isn't the one before's next, came before, or stands on an empty page.

    group: columns that tell one listing from another, each with pages from 1.
    """
    from pyspark.sql import Window

    # each page meets its predecessor by its number, not by ordering all pages in a task
    p = pages.select(*group, "page_number", "requested_cursor", "next_cursor", F.size("items").alias("n"))
    before = p.select(*group, (F.col("page_number") + 1).alias("page_number"), F.col("next_cursor").alias("expected"), F.lit(True).alias("_has"))
    again = F.row_number().over(Window.partitionBy(*group, "next_cursor").orderBy("page_number")) > 1
    q = p.join(before, [*group, "page_number"], "left").withColumn("again", F.col("next_cursor").isNotNull() & again)
    fault = (
        F.when((F.col("page_number") > 1) & F.col("_has").isNull(), "page_missing").when((F.col("page_number") > 1) & ~F.col("requested_cursor").eqNullSafe(F.col("expected")), "cursor_mismatch")
        .when(F.col("again") | (F.col("next_cursor").isNotNull() & F.col("next_cursor").eqNullSafe(F.col("requested_cursor"))), "repeated_cursor").when((F.col("n") == 0) & F.col("next_cursor").isNotNull(), "empty_page_with_cursor")
    )
    return q.select(*group, "page_number", fault.alias("fault")).where("fault is not null")


def sanitized_folders(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Folder records (JSON text) as columns with `fault`, the first rule that a record breaks; only allowed fields pass."""
    v = F.try_parse_json(raw)
    get = lambda p, t: F.try_variant_get("v", p, t)
    d = docs.select(v.alias("v"))
    kind = lambda p: F.schema_of_variant(get(p, "variant"))
    whole = lambda p: F.coalesce((kind(p) == "BIGINT") & (get(p, "bigint") >= 0), F.lit(False))
    uuid = F.coalesce((kind("$.id") == "STRING") & get("$.id", "string").rlike(T.UUID), F.lit(False))
    fault = (
        F.when(~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), "not_object").when(~uuid, "invalid_id").when(~F.coalesce((kind("$.name") == "STRING") & (get("$.name", "string") != ""), F.lit(False)), "invalid_name")
        .when(~whole("$.count"), "invalid_count").when(~whole("$.subfolders_count"), "invalid_subfolder_count").when(get("$.parent_id", "variant").isNotNull() & ~kind("$.parent_id").isin("STRING", "VOID"), "invalid_parent")
    )
    return d.select(fault.alias("fault"), get("$.id", "string").alias("folder_id"), get("$.parent_id", "string").alias("parent_id"), get("$.name", "string").alias("name"), get("$.path", "string").alias("path"), get("$.count", "bigint").alias("reported_asset_count"), get("$.subfolders_count", "bigint").alias("reported_subfolders_count"))


def folder_tree(children: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(folders, faults) of all landed pages of children: (parent_id, page_number, requested_cursor, next_cursor, item_index, folder: struct of folder_id, parent_id, name, path, reported_asset_count, reported_subfolders_count).

    A row without a folder (an empty page) has a null folder. folders: each folder below `root` once, as it was first listed, with parent, depth and path as its
    links give them. faults (parent_id, folder_id, code): duplicate_folder_across_pages, conflicting_metadata, parent_mismatch, not_below_root,
    public_child_count_mismatch, and the cursor faults of each parent's own pages. A listing may come in any order: what a queue would ask for next is what has subfolders and no page.
    """
    from pyspark.sql import Window

    from corpuslathe.operators.hierarchy import resolve_hierarchy

    rows = children.where("folder is not null").select(F.col("parent_id").alias("asked"), "page_number", "item_index", "folder.*")
    again = rows.withColumn("n", F.row_number().over(Window.partitionBy("asked", "folder_id").orderBy("page_number", "item_index")))
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("folder_id").orderBy("page_number", "asked", "item_index"))).where("n = 1").drop("n", "page_number", "item_index")
    body = F.struct("parent_id", "name", "path", "reported_asset_count", "reported_subfolders_count")
    clash = rows.groupBy("folder_id").agg(F.count_distinct(F.to_json(body, {"ignoreNullFields": "false"})).alias("n"), F.min("asked").alias("parent_id")).where("n > 1")
    tree = resolve_hierarchy(first.select("folder_id", "parent_id", "name"))
    found = first.join(tree.select(F.col("node").alias("folder_id"), "root", "depth", F.col("path").alias("derived_path")), "folder_id")
    below = found.where(F.col("root") == root.strip().lower())
    listed = again.where("n = 1").groupBy(F.col("asked").alias("folder_id")).agg(F.count("*").alias("listed"))
    ended = children.groupBy(F.col("parent_id").alias("folder_id")).agg(F.bool_or(F.col("next_cursor").isNull()).alias("ended"))
    short = below.join(ended.where("ended"), "folder_id").join(listed, "folder_id", "left").where(F.coalesce("listed", F.lit(0)) != F.col("reported_subfolders_count"))
    code = lambda df, parent, c: df.select(F.col(parent).alias("parent_id"), "folder_id", F.lit(c).alias("code"))
    pages = children.groupBy("parent_id", "page_number").agg(F.first("requested_cursor").alias("requested_cursor"), F.first("next_cursor").alias("next_cursor"), F.collect_list("folder.folder_id").alias("items"))
    cursors = cursor_faults(pages, "parent_id").select("parent_id", F.lit(None).cast("string").alias("folder_id"), F.col("fault").alias("code"))
    faults = (
        code(again.where("n > 1"), "asked", "duplicate_folder_across_pages").unionByName(code(clash, "parent_id", "conflicting_metadata"))
        .unionByName(code(rows.where("not (asked <=> parent_id)"), "asked", "parent_mismatch")).unionByName(code(found.where(~F.col("root").eqNullSafe(root.strip().lower())), "parent_id", "not_below_root"))
        .unionByName(code(short, "parent_id", "public_child_count_mismatch")).unionByName(cursors)
    )
    return below.drop("asked", "root"), faults.distinct()


def pending_parents(folders: DataFrame, children: DataFrame, root: str) -> DataFrame:
    """(folder_id) of parents that must still be asked: the root and folders with subfolders whose pages aren't there or don't end."""
    ended = children.groupBy(F.col("parent_id").alias("folder_id")).agg(F.bool_or(F.col("next_cursor").isNull()).alias("ended")).where("ended").select("folder_id")
    some = folders.where("reported_subfolders_count > 0").select("folder_id").union(folders.sparkSession.createDataFrame([(root,)], "folder_id string"))
    return some.distinct().join(ended, "folder_id", "left_anti")
