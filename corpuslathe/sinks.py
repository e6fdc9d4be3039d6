"""Writing results: committed tables, appended events, one-row reports, rendered documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """The table as Parquet in place of what was there; readers see it when the job has committed."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def append_events(df: DataFrame, path: str) -> None:
    """Events (at, level, code, ...) appended as JSON lines."""
    df.write.mode("append").json(path)


def write_report(row: DataFrame, path: str) -> None:
    """A report of one row as one JSON file."""
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def rendered(df: DataFrame, template: str, name: str = "document", **parts: Column) -> DataFrame:
    """`df` with a document made from a template with {placeholders}, each filled by a column; nulls are filled with nothing."""
    out = F.lit(template)
    for k, c in parts.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return df.withColumn(name, out)


def write_documents(df: DataFrame, path: str, name: str, document: str) -> None:
    """Documents as text, a folder for each value of `name`."""
    df.select(F.col(name).alias("name"), F.col(document).alias("value")).write.mode("overwrite").partitionBy("name").text(path)
