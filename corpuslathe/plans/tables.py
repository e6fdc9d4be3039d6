"""The corpus tables as queries compare them, and the same as SQL.

Ids and categories are trimmed and in lower case, empty ones null. An asset listed several times is the one listed first; folders, memberships and
strata have one row a key. The SQL views have short names: a (assets), ar (their rows, with repeats), p (prompts), f (folders), m (memberships), s (strata).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions.keys import key
from corpuslathe.operators.relational import first_wins
from corpuslathe.plans.registry import table

#: Columns of each table that hold ids or categories.
FOLDED = {
    "assets": ["asset_id", "folder_id", "prompt_sha256", "item_type", "asset_type", "status", "job_set_type", "model", "resolution"],
    "prompts": ["prompt_sha256", "first_asset_id"],
    "folders": ["folder_id", "parent_id"],
    "asset_folder_memberships": ["asset_id", "folder_id"],
    "prompt_strata": ["prompt_sha256", "source_input_sha256", "processing_status", "source_processing_status", "complexity_queue", "queue_rule_id", "structure_state", "dialogue_state", "duration_state", "text_length_band", "marker_density_band", "reference_density_band", "failure_code"],
}
#: What orders rows of one key; the first counts.
_ASSET_ORDER = ["source_page", "source_item_index", "status", "fetched_at"]
_FOLDER_ORDER = ["parent_id", "name", "path", "depth", "reported_asset_count", "derived_direct_asset_count"]


def _rows(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = table(spark, d, name)
    return df.withColumns({c: key(c) for c in FOLDED[name]})


def asset_rows(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "assets").where("asset_id is not null")


def assets(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Each asset once, as it was listed first, with these columns (and those that order its rows)."""
    need = list(dict.fromkeys(["asset_id", *_ASSET_ORDER, *columns]))
    return first_wins(asset_rows(spark, d).select(*need), ["asset_id"], *(F.col(c).asc_nulls_first() for c in _ASSET_ORDER))


def prompts(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "prompts").where("prompt_sha256 is not null")


def folders(spark: SparkSession, d: str) -> DataFrame:
    f = _rows(spark, d, "folders").where("folder_id is not null").select("folder_id", *_FOLDER_ORDER)
    return first_wins(f, ["folder_id"], *(F.col(c).asc_nulls_first() for c in _FOLDER_ORDER))


def membership_rows(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "asset_folder_memberships")


def memberships(spark: SparkSession, d: str) -> DataFrame:
    """(asset_id, folder_id, first_seen_page), each pair once."""
    m = membership_rows(spark, d).where("asset_id is not null and folder_id is not null")
    return m.groupBy("asset_id", "folder_id").agg(F.min("first_seen_page").alias("first_seen_page"))


def strata_rows(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, "prompt_strata").where("prompt_sha256 is not null")


def strata(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Distinct (prompt_sha256, columns)."""
    return strata_rows(spark, d).select("prompt_sha256", *columns).distinct()


def _folded_sql(name: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'nullif(lower(trim({c})), \'\') AS {c}' for c in FOLDED[name])}) FROM {name}"


def sql(query: str) -> str:
    """The query with the views of this module before it."""
    first = lambda order: ", ".join(f"{c} NULLS FIRST" for c in order)
    views = [
        f"ar AS (SELECT * FROM ({_folded_sql('assets')}) WHERE asset_id IS NOT NULL)",
        f"a AS (SELECT * EXCLUDE _r FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY {first(_ASSET_ORDER)}) AS _r FROM ar) WHERE _r = 1)",
        f"p AS (SELECT * FROM ({_folded_sql('prompts')}) WHERE prompt_sha256 IS NOT NULL)",
        f"f AS (SELECT * EXCLUDE _r FROM (SELECT *, row_number() OVER (PARTITION BY folder_id ORDER BY {first(_FOLDER_ORDER)}) AS _r FROM ({_folded_sql('folders')}) WHERE folder_id IS NOT NULL) WHERE _r = 1)",
        f"m AS (SELECT asset_id, folder_id, min(first_seen_page) AS first_seen_page FROM ({_folded_sql('asset_folder_memberships')}) WHERE asset_id IS NOT NULL AND folder_id IS NOT NULL GROUP BY 1, 2)",
        f"s AS (SELECT * FROM ({_folded_sql('prompt_strata')}) WHERE prompt_sha256 IS NOT NULL)",
    ]
    own = ", ".join(views)
    return f"WITH {own}, {query[5:]}" if query.startswith("WITH ") else f"WITH {own} {query}"
