"""Queries of the folder hierarchy (p4) and of orphan references (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.operators.hierarchy import descendants, hierarchy_faults, resolve_hierarchy
from corpuslathe.operators.orphans import corpus_references, orphan_references
from corpuslathe.plans.registry import Registry, table

REG = Registry()

_TREE_SQL = """
WITH RECURSIVE n AS (
  SELECT lower(trim(folder_id)) AS k, min({'p': nullif(lower(trim(parent_id)), ''), 'name': coalesce(name, '')}) AS s
  FROM folders WHERE nullif(lower(trim(folder_id)), '') IS NOT NULL GROUP BY 1),
l AS (SELECT n.k, m.k AS p, n.s.name AS name FROM n LEFT JOIN n m ON n.s.p = m.k),
t AS (
  SELECT k, k AS root, CAST(0 AS BIGINT) AS depth, name AS path FROM l WHERE p IS NULL
  UNION ALL SELECT l.k, t.root, t.depth + 1, t.path || '/' || l.name FROM l JOIN t ON l.p = t.k)
"""


@REG.query(
    _TREE_SQL
    + """SELECT DISTINCT f.folder_id FROM folders f LEFT JOIN t ON lower(trim(f.folder_id)) = t.k
WHERE nullif(lower(trim(f.folder_id)), '') IS NOT NULL AND (t.k IS NULL OR f.depth <> t.depth OR f.path <> t.path)"""
)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    folders = table(spark, d, "folders")
    return hierarchy_faults(folders, resolve_hierarchy(folders)).select(F.col("id").alias("folder_id")).distinct()


@REG.query(_TREE_SQL + "SELECT l.k AS node, t.root, t.depth, t.path, t.k IS NULL AS in_loop FROM l LEFT JOIN t ON l.k = t.k")
def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return resolve_hierarchy(table(spark, d, "folders")).select("node", "root", "depth", "path", "in_loop")


@REG.query(
    _TREE_SQL
    + """, u AS (SELECT l.k AS node, l.p AS ancestor, CAST(1 AS BIGINT) AS distance FROM l JOIN t ON l.k = t.k WHERE l.p IS NOT NULL
  UNION ALL SELECT u.node, l.p, u.distance + 1 FROM u JOIN l ON u.ancestor = l.k WHERE l.p IS NOT NULL)
SELECT ancestor, node AS descendant, distance FROM u"""
)
def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    return descendants(resolve_hierarchy(table(spark, d, "folders")))


_REFS_SQL = """
WITH k AS (
  SELECT 'assets.prompt_sha256' AS ref_field, nullif(lower(trim(asset_id)), '') AS from_key, nullif(lower(trim(prompt_sha256)), '') AS k,
    coalesce(strftime(make_timestamp(CAST(floor(created_at_unix * 1000000) AS BIGINT)), '%Y-%m'), '<null>') AS period FROM assets
  UNION ALL SELECT 'assets.folder_id', nullif(lower(trim(asset_id)), ''), nullif(lower(trim(folder_id)), ''),
    coalesce(strftime(make_timestamp(CAST(floor(created_at_unix * 1000000) AS BIGINT)), '%Y-%m'), '<null>') FROM assets
  UNION ALL SELECT 'asset_folder_memberships.asset_id', nullif(lower(trim(m.folder_id)), ''), nullif(lower(trim(m.asset_id)), ''), coalesce(g.period, '<null>')
    FROM asset_folder_memberships m LEFT JOIN (SELECT source_page, min(substr(fetched_at, 1, 7)) AS period FROM assets GROUP BY 1) g ON m.first_seen_page = g.source_page),
parent AS (
  SELECT 'assets.prompt_sha256' AS ref_field, lower(trim(prompt_sha256)) AS k FROM prompts
  UNION SELECT 'assets.folder_id', lower(trim(folder_id)) FROM folders
  UNION SELECT 'asset_folder_memberships.asset_id', k FROM (
    SELECT lower(trim(asset_id)) AS k, arg_max(coalesce(lower(trim(status)), ''), {'a': source_page, 'b': source_item_index, 's': coalesce(lower(trim(status)), '')}) AS status FROM assets GROUP BY 1)
    WHERE status <> 'deleted'),
o AS (SELECT DISTINCT k.* FROM k ANTI JOIN parent USING (ref_field, k) WHERE k.k IS NOT NULL)
"""


def _orphans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return orphan_references(*corpus_references(*(table(spark, d, t) for t in ("assets", "asset_folder_memberships", "prompts", "folders"))))


@REG.query(_REFS_SQL + "SELECT DISTINCT ref_field, from_key, k AS missing_key FROM o")
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)[1].select("ref_field", "from_key", "missing_key").distinct()


@REG.query(_REFS_SQL + "SELECT ref_field, period, count(DISTINCT k) AS orphan_keys, count(*) AS orphan_references FROM o GROUP BY 1, 2")
def p6_report(spark: SparkSession, d: str) -> DataFrame:
    per_period, rows = _orphans(spark, d)
    n = rows.groupBy("ref_field", "period").agg(F.count("*").alias("orphan_references"))
    return per_period.join(n, ["ref_field", "period"]).select("ref_field", "period", "orphan_keys", "orphan_references")
