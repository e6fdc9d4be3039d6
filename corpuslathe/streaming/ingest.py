"""Pages into corpus tables, once each, in batch or as a stream of files.

A batch of pages becomes rows of six tables below a folder. Each table is a folder of batches; a batch writes into a folder of its own number and
overwrites it when it is repeated, so a batch that failed half-way and ran again counts once. First-seen rows win by (page, index), across
batches too: keys that earlier batches hold are anti-joined, nothing is kept as state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.operators.relational import first_wins, repeats
from corpuslathe.runtime import exists
from corpuslathe.sources.pages import parse_items, read_pages, with_page

TABLES = ("pages", "prompts", "assets", "memberships", "occurrences", "issues")


def earlier(spark: SparkSession, root: str, table: str, batch: int, like: DataFrame) -> DataFrame:
    """Rows of a table from batches before this one."""
    folder = f"{root}/{table}"
    if not exists(spark, folder):
        return like.limit(0)
    return spark.read.option("basePath", folder).parquet(folder).where(F.col("batch") < batch).select(*like.columns)


def split_batch(pages: DataFrame) -> dict[str, DataFrame]:
    """The rows of the six tables that a batch of pages holds, before earlier batches are taken into account."""
    p = with_page(pages)
    items = parse_items(p.where("page_issue is null"))
    at = ["page_number", "item_index"]
    a = items.where("asset is not null").select(*at, "asset.*")
    counts = items.groupBy("page_number").agg(F.count("*").alias("received_items"), F.count("asset").alias("asset_id_count"), F.count("prompt").alias("prompt_record_count"), F.sum(F.size(F.filter("issues", lambda i: i["severity"] == "error"))).alias("error_count"), F.sum(F.size(F.filter("issues", lambda i: i["severity"] == "warning"))).alias("warning_count"))
    return {
        "pages": p.select("page_number", "next_cursor", "page_issue").join(counts, "page_number", "left"),
        "prompts": items.where("prompt is not null").select(*at, "prompt.*", "asset.asset_id").withColumnRenamed("asset_id", "first_asset_id"),
        "assets": a.withColumnsRenamed({"page_number": "source_page", "item_index": "source_item_index"}),
        "memberships": a.where("folder_id is not null").groupBy("asset_id", "folder_id").agg(F.min("page_number").alias("first_seen_page")),
        "occurrences": items.select(*at, "asset.asset_id", "item_type", F.when(F.size(F.filter("issues", lambda i: i["code"].isin("item_not_object", "unsupported_item_type"))) > 0, "unsupported").otherwise("parsed").alias("parse_status")),
        "issues": items.select(*at, "asset.asset_id", F.explode("issues").alias("i")).select(*at, "asset_id", "i.severity", "i.code")
        .unionByName(p.where("page_issue is not null").select("page_number", F.lit(-1).cast("bigint").alias("item_index"), F.lit(None).cast("string").alias("asset_id"), F.lit("error").alias("severity"), F.col("page_issue").alias("code"))),
    }


def commit_batch(root: str) -> Callable[[DataFrame, int], None]:
    """What a stream does with each batch of pages."""

    def commit(pages: DataFrame, batch: int) -> None:
        spark = pages.sparkSession
        pages = pages.persist()
        try:
            t = split_batch(pages)
            old = {n: earlier(spark, root, n, batch, t[n]) for n in ("prompts", "assets", "memberships", "pages")}
            new_pages = t["pages"].join(old["pages"].select("page_number"), "page_number", "left_anti")
            keep = lambda df: df.join(new_pages.select("page_number"), "page_number", "left_semi")
            by = (F.col("source_page"), F.col("source_item_index"))
            assets = t["assets"].join(new_pages.select(F.col("page_number").alias("source_page")), "source_page", "left_semi")
            known = old["assets"].select("asset_id").distinct()
            fresh = first_wins(assets.join(known, "asset_id", "left_anti"), ["asset_id"], *by)
            again = assets.join(known, "asset_id", "left_semi").select("source_page", "source_item_index", "asset_id").unionByName(repeats(assets.join(known, "asset_id", "left_anti"), ["asset_id"], *by).select("source_page", "source_item_index", "asset_id"))
            doubles = again.select(F.col("source_page").alias("page_number"), F.col("source_item_index").alias("item_index"), "asset_id", F.lit("warning").alias("severity"), F.lit("duplicate_asset_id").alias("code"))
            prompts = first_wins(keep(t["prompts"]), ["prompt_sha256"], F.col("page_number"), F.col("item_index")).join(old["prompts"].select("prompt_sha256").distinct(), "prompt_sha256", "left_anti")
            members = t["memberships"].join(old["memberships"].select("asset_id", "folder_id").distinct(), ["asset_id", "folder_id"], "left_anti")
            out = {"prompts": prompts, "assets": fresh, "memberships": members, "occurrences": keep(t["occurrences"]), "issues": keep(t["issues"]).unionByName(doubles), "pages": new_pages}
            for name in ("prompts", "assets", "memberships", "occurrences", "issues", "pages"):  # pages last: they mark the batch as done
                out[name].select(*t[name].columns).write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
        finally:
            pages.unpersist()

    return commit


def ingest(spark: SparkSession, pages_path: str, root: str, checkpoint: str, max_files: int | None = None) -> int:
    """Takes in all pages that have landed since the last time; returns the number of batches. Run again, it does nothing."""
    stream = read_pages(spark, pages_path, stream=True, max_files=max_files)
    done: set[int] = set()
    commit = commit_batch(root)

    def counted(pages: DataFrame, batch: int) -> None:
        commit(pages, batch)
        done.add(batch)

    q = stream.writeStream.foreachBatch(counted).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(done)


def corpus(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that have been taken in."""
    return {t: spark.read.option("basePath", f"{root}/{t}").parquet(f"{root}/{t}").drop("batch") for t in TABLES}


def reconciliation(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: items, occurrences, unique, duplicates, unsupported, stored_urls, and whether they add up."""
    count = lambda df, name, n=F.lit(1): df.select(F.lit(name).alias("name"), n.cast("bigint").alias("n"))
    rows = (
        count(tables["pages"], "items", F.coalesce("received_items", F.lit(0))).unionByName(count(tables["pages"].where("next_cursor is null"), "ends")).unionByName(count(tables["occurrences"], "occurrences"))
        .unionByName(count(tables["assets"], "unique_assets")).unionByName(count(tables["issues"].where("code = 'duplicate_asset_id'"), "duplicates")).unionByName(count(tables["occurrences"].where("asset_id is null"), "unsupported"))
        .unionByName(count(tables["prompts"].where(F.lower("prompt_text").rlike("https?://")), "stored_urls"))
    )
    names = ["items", "ends", "occurrences", "unique_assets", "duplicates", "unsupported", "stored_urls"]
    row = rows.agg(*(F.coalesce(F.sum(F.when(F.col("name") == x, F.col("n"))), F.lit(0)).alias(x) for x in names))
    closed = (F.col("items") == F.col("occurrences")) & (F.col("occurrences") == F.col("unique_assets") + F.col("duplicates") + F.col("unsupported")) & (F.col("stored_urls") == 0)
    return row.withColumn("closed", closed).withColumn("status", F.when(~closed, "failed").when(F.col("ends") == 0, "paused").otherwise("passed"))


def code_counts(events: DataFrame) -> DataFrame:
    """(code, rows) of an event table, in batch or as a stream in complete mode."""
    return events.groupBy("code").agg(F.count("*").alias("rows"))
