"""Where intermediate tables go, and how sizes are checked before anything is broadcast or collected.

Lineage is cut by writing Parquet into the shared folder that the cluster names in ``spark.checkpoint.dir``.
If an executor is lost, the written files are still there, so nothing upstream runs again with other
results. A folder of our own is made only where the setting is missing, as in local tests.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex[:12]
_own: str | None = None
#: Whether Spark removes a query's shuffle files when it ends; else they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables written so far.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder for this run's intermediate tables, below ``spark.checkpoint.dir`` where that is set."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _own is None:
            _own = tempfile.mkdtemp(prefix="corpuslathe-")
            atexit.register(shutil.rmtree, _own, ignore_errors=True)
        base = _own
    return f"{base.rstrip('/')}/corpuslathe-{_RUN}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes `df` as a table of this run and returns a reader of it (lineage ends there). The shuffle files that this took go at once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        w.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    _written.append(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._corpuslathe_path = path
    return read


def discard(df: DataFrame, part: str = "") -> None:
    """Removes a materialized table that nothing reads any more, or a part of it."""
    p, fs = _path(df.sparkSession, f"{df._corpuslathe_path}/{part}".rstrip("/"))
    fs.delete(p, True)
    if not part:
        _written.remove(df._corpuslathe_path)


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def clean(spark: SparkSession) -> None:
    """Removes this run's intermediate tables; results not yet written can't be read afterwards. Registered queries leave it to `cleaning`."""
    p, fs = _path(spark, shared_folder(spark))
    fs.delete(p, True)


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Removes at the end what was materialized within, also after a failure; write the result inside the block."""
    held = len(_written)
    try:
        yield
    finally:
        while len(_written) > held:
            p, fs = _path(spark, _written.pop())
            fs.delete(p, True)


def count_up_to(df: DataFrame, limit: int) -> int:
    """Rows of `df`, counted no further than `limit` + 1."""
    return df.limit(limit + 1).count()


def small_rows(df: DataFrame, limit: int) -> list | None:
    """The rows of `df` if there are at most `limit`, else None; never brings more than limit + 1 to the driver."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that it need not be installed there."""
    sc = spark.sparkContext
    if getattr(sc, "_corpuslathe_shipped", False):
        return
    sc._corpuslathe_shipped = True
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpuslathe-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/corpuslathe-{_RUN}.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(name)
