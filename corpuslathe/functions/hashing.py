"""Digests of texts, records and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslathe.functions.text import col


def text_digest(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def canonical(*names: str) -> Column:
    """JSON of the columns in sorted order of their names, nulls kept, so that equal records give equal strings."""
    return F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})


def record_digest(*columns: str) -> Column:
    return F.sha2(canonical(*columns), 256)


def _framed(columns: list[str]) -> Column:
    """The columns as one string from which they could be read again: length and text of each, `n` for null."""
    one = lambda c: F.when(F.col(c).isNull(), "n").otherwise(F.concat_ws(":", F.length(F.col(c).cast("string")).cast("string"), F.col(c).cast("string")))
    return F.concat_ws(",", *(one(c) for c in columns))


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (rows, digest) that doesn't depend on the order of rows: the count and the sum of 60 bits of the rows' SHA-256.

    A sum in a wide decimal, unlike an exclusive or, doesn't cancel equal rows. Works in one pass with partial sums at any size; a null and an
    empty value, or values that changed columns, differ.
    """
    h = F.conv(F.substring(F.sha2(_framed(columns or sorted(df.columns)), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest"))


def ordered_digest(df: DataFrame, key: str, columns: list[str], digits: int = 4) -> DataFrame:
    """One row (rows, digest): SHA-256 over the digests of 16^digits groups of rows, each over its rows' digests in order of the key.

    Rows are grouped by the first digits of their key's hash, so no task holds more than a group; equal tables give equal digests however they are partitioned.
    Choose as many digits as keep a group (rows / 16^digits) small; the digest depends on it.
    """
    k = F.coalesce(F.col(key).cast("string"), F.lit("\x00"))
    row = F.struct(k.alias("k"), F.sha2(F.concat_ws("\x1f", *(F.col(c).cast("string") for c in columns)), 256).alias("h"))
    each = df.select(F.substring(F.sha2(k, 256), 1, digits).alias("b"), row.alias("r"))
    groups = each.groupBy("b").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["h"]), ""), 256).alias("d"))
    top = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.array_sort(F.collect_list(F.struct("b", "d"))).alias("g"))  # at most 16^digits
    return top.select("rows", F.sha2(F.array_join(F.transform("g", lambda x: x["d"]), ""), 256).alias("digest"))
