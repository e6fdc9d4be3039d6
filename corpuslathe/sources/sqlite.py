"""SQLite files as tables, read-only: opened as such, checked before anything is read, and read in ranges of row numbers by as many tasks.

The file must lie at one path for all executors. Python's own module is all that is needed.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: SQLite's column affinities as Spark types; what a column declares otherwise is text.
_TYPES = (("INT", "bigint"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"), ("BLOB", "binary"))


def _open(path: str) -> sqlite3.Connection:
    con = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    con.execute("PRAGMA query_only=ON")
    return con


def precheck(path: str) -> None:
    """Raises ValueError if the file isn't sound or breaks its own foreign keys; it is never written to."""
    con = _open(path)
    try:
        said = con.execute("PRAGMA integrity_check").fetchone()[0]
        if said != "ok":
            raise ValueError(f"integrity check: {said}")
        broken = con.execute("SELECT count(*) FROM pragma_foreign_key_check").fetchone()[0]
        if broken:
            raise ValueError(f"{broken} rows break a foreign key")
    finally:
        con.close()


def read_table(spark: SparkSession, path: str, name: str, rows_per_task: int = 100_000) -> DataFrame:
    """The rows of a table of a file that passes `precheck`; columns in the types they declare, values that don't fit as null. A view or an unknown name raises ValueError."""
    precheck(path)
    con = _open(path)
    try:
        if con.execute("SELECT count(*) FROM sqlite_master WHERE type = 'table' AND name = ?", (name,)).fetchone()[0] != 1:
            raise ValueError(f"no table {name}")
        quoted = '"' + name.replace('"', '""') + '"'
        cols = [(c[1], next((t for word, t in _TYPES if word in (c[2] or "").upper()), "string")) for c in con.execute(f"PRAGMA table_info({quoted})")]
        low, high = con.execute(f"SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM {quoted}").fetchone()
    finally:
        con.close()
    names = [c for c, _ in cols]
    fit = {"bigint": int, "double": (int, float), "binary": bytes, "string": object}
    listed = ", ".join('"' + c.replace('"', '""') + '"' for c in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _open(path)
        try:
            for b in batches:
                for first in b["id"]:
                    got = own.execute(f"SELECT {listed} FROM {quoted} WHERE rowid BETWEEN ? AND ?", (int(first), int(first) + rows_per_task - 1))
                    while rows := got.fetchmany(10_000):
                        held = {c: pd.Series([None if v is None or not isinstance(v, fit[t]) else (v if t != "string" or isinstance(v, str) else str(v)) for v in vs], dtype="Int64" if t == "bigint" else object) for (c, t), vs in zip(cols, zip(*rows, strict=True), strict=True)}
                        yield pd.DataFrame(held)
        finally:
            own.close()

    ranges = spark.range(low, high + 1, rows_per_task, max(1, -(-(high + 1 - low) // rows_per_task)))
    return ranges.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in cols))


def read_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: read_table(spark, path, n) for n in names}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of several tables."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
