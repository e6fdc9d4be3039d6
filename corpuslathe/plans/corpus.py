"""Queries over the crawl corpus: counts, distributions, clusters, joins, rankings, samples, contracts.

They read the tables as `plans.tables` gives them: ids and categories trimmed and in lower case, repeated rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslathe.functions import hashing
from corpuslathe.functions import numbers as N
from corpuslathe.functions import text as T
from corpuslathe.functions.keys import key
from corpuslathe.operators import contracts as C
from corpuslathe.operators import relational as R
from corpuslathe.plans.registry import Registry, table
from corpuslathe.plans.tables import asset_rows, assets, folders, membership_rows, memberships, prompts, sql, strata, strata_rows

REG = Registry()


def q(query: str | None = None, name: str | None = None):  # noqa: ANN201
    """Registers a query; its SQL may use the views of `plans.tables`."""
    return REG.query(sql(query) if query else None, name)


@q("SELECT prompt_sha256, count(*) AS members, min(asset_id) AS first_member FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) >= 2")
def exact_clusters(spark: SparkSession, d: str) -> DataFrame:
    return R.clusters(assets(spark, d, "prompt_sha256"), "prompt_sha256", "asset_id")


@q("SELECT prompt_sha256, row_number() OVER (PARTITION BY prompt_sha256 ORDER BY asset_id) - 1 AS ordinal, asset_id FROM a WHERE prompt_sha256 IS NOT NULL")
def exact_cluster_members(spark: SparkSession, d: str) -> DataFrame:
    return R.numbered_members(assets(spark, d, "prompt_sha256"), "prompt_sha256", "asset_id")


@q("SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY prompt_sha256) GROUP BY 1")
def cluster_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return R.size_histogram(R.clusters(assets(spark, d, "prompt_sha256"), "prompt_sha256", "asset_id", least=1), "members")


@q("""SELECT sum(n) AS total, count(*) AS unique_prompts, count(*) FILTER (n = 1) AS singletons, count(*) FILTER (n > 1) AS duplicate_groups, sum(n) - count(*) AS extra_records, max(n) AS largest
FROM (SELECT count(*) AS n FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY prompt_sha256)""")
def duplicate_summary(spark: SparkSession, d: str) -> DataFrame:
    g = R.clusters(assets(spark, d, "prompt_sha256"), "prompt_sha256", "asset_id", least=1)
    n = F.col("members")
    return g.agg(F.sum(n).alias("total"), F.count("*").alias("unique_prompts"), F.count_if(n == 1).alias("singletons"), F.count_if(n > 1).alias("duplicate_groups"), (F.sum(n) - F.count("*")).alias("extra_records"), F.max(n).alias("largest"))


for _c in ("model", "status", "asset_type", "job_set_type", "resolution"):

    def _distribution(spark: SparkSession, d: str, c: str = _c) -> DataFrame:
        return R.distribution(assets(spark, d, c), c)

    q(f"SELECT coalesce({_c}, '<null>') AS value, count(*) AS rows FROM a GROUP BY 1", name=f"distribution_{_c}")(_distribution)

STRATA = ["complexity_queue", "structure_state", "dialogue_state", "duration_state", "text_length_band", "marker_density_band", "reference_density_band", "processing_status"]
_UNPIVOT = " UNION ALL ".join(f"SELECT prompt_sha256, '{c}' AS dimension, {c} AS value FROM s" for c in STRATA)


@q(f"SELECT dimension, coalesce(value, '<null>') AS value, count(*) AS rows FROM (SELECT DISTINCT prompt_sha256, dimension, value FROM ({_UNPIVOT})) GROUP BY 1, 2")
def strata_distributions(spark: SparkSession, d: str) -> DataFrame:
    return R.distributions(strata(spark, d, *STRATA), STRATA)


@q("""SELECT count(*) AS assets, (SELECT count(*) FROM ar) AS listed, count(*) FILTER (prompt_sha256 IS NULL) AS without_prompt, count(*) FILTER (folder_id IS NULL) AS without_folder,
 coalesce(sum(width), 0) AS width_sum, min(duration_seconds) AS shortest, max(duration_seconds) AS longest FROM a""")
def scalar_counts(spark: SparkSession, d: str) -> DataFrame:
    # how often an asset was listed rides along, so the rows are read once
    a = asset_rows(spark, d).select("asset_id", "source_page", "source_item_index", "status", "fetched_at", "prompt_sha256", "folder_id", "width", "duration_seconds")
    first = R.first_wins(a, ["asset_id"], *(F.col(c).asc_nulls_first() for c in ("source_page", "source_item_index", "status", "fetched_at")))
    row = first.agg(F.count("*").alias("assets"), F.count_if(F.col("prompt_sha256").isNull()).alias("without_prompt"), F.count_if(F.col("folder_id").isNull()).alias("without_folder"), F.coalesce(F.sum("width"), F.lit(0)).alias("width_sum"), F.min("duration_seconds").alias("shortest"), F.max("duration_seconds").alias("longest"))
    return row.crossJoin(a.agg(F.count("*").alias("listed")))  # one row each


@q("SELECT p.prompt_sha256, p.source_prompt_chars, count(*) AS asset_count FROM p JOIN a USING (prompt_sha256) GROUP BY 1, 2")
def prompt_asset_counts(spark: SparkSession, d: str) -> DataFrame:
    n = assets(spark, d, "prompt_sha256").groupBy("prompt_sha256").agg(F.count("*").alias("asset_count"))  # counted before the join
    return prompts(spark, d).select("prompt_sha256", "source_prompt_chars").join(n, "prompt_sha256")


@q("""SELECT coalesce(f.name, '<unknown>') AS folder_name, count(*) AS assets, count(*) FILTER (a.prompt_sha256 IS NOT NULL) AS with_prompt, count(DISTINCT a.prompt_sha256) AS prompts
FROM a LEFT JOIN f USING (folder_id) GROUP BY 1""")
def folder_stats(spark: SparkSession, d: str) -> DataFrame:
    # counted by (folder, prompt) first: one folder may hold a third of all assets
    per = assets(spark, d, "folder_id", "prompt_sha256").groupBy("folder_id", "prompt_sha256").agg(F.count("*").alias("n"))
    j = per.join(folders(spark, d).select("folder_id", "name"), "folder_id", "left").groupBy(R.shown("name", "<unknown>").alias("folder_name"), "prompt_sha256").agg(F.sum("n").alias("n"))
    return j.groupBy("folder_name").agg(F.sum("n").alias("assets"), F.coalesce(F.sum(F.when(F.col("prompt_sha256").isNotNull(), F.col("n"))), F.lit(0)).alias("with_prompt"), F.count("prompt_sha256").alias("prompts"))


@q("SELECT coalesce(f.name, '<unknown>') AS folder_name, count(*) AS memberships FROM m LEFT JOIN f USING (folder_id) GROUP BY 1")
def membership_distribution(spark: SparkSession, d: str) -> DataFrame:
    n = memberships(spark, d).groupBy("folder_id").agg(F.count("*").alias("n"))
    return n.join(folders(spark, d).select("folder_id", "name"), "folder_id", "left").groupBy(R.shown("name", "<unknown>").alias("folder_name")).agg(F.sum("n").alias("memberships"))


@q("SELECT asset_id, count(*) AS folders, string_agg(folder_id, ',' ORDER BY folder_id) AS folder_ids FROM m GROUP BY 1 HAVING count(*) > 1")
def multi_membership(spark: SparkSession, d: str) -> DataFrame:
    g = memberships(spark, d).groupBy("asset_id").agg(F.array_sort(F.collect_list("folder_id")).alias("ids"))
    return g.where(F.size("ids") > 1).select("asset_id", F.size("ids").cast("bigint").alias("folders"), F.array_join("ids", ",").alias("folder_ids"))


@q("""SELECT prompt_sha256, count(DISTINCT a.asset_id) AS assets, coalesce(string_agg(DISTINCT f.name, '|' ORDER BY f.name), '') AS folder_names, coalesce(string_agg(DISTINCT a.model, '|' ORDER BY a.model), '') AS models
FROM p JOIN a USING (prompt_sha256) LEFT JOIN m ON a.asset_id = m.asset_id LEFT JOIN f ON m.folder_id = f.folder_id GROUP BY 1""")
def prompt_folders_models(spark: SparkSession, d: str) -> DataFrame:
    a = assets(spark, d, "prompt_sha256", "model").where("prompt_sha256 is not null").select("prompt_sha256", "asset_id", "model")
    per = a.groupBy("prompt_sha256").agg(F.count("*").alias("assets"), F.array_join(F.array_sort(F.collect_set("model")), "|").alias("models"))
    # distinct (prompt, folder) before names: sets stay as small as the folders of a prompt
    pairs = a.select("prompt_sha256", "asset_id").join(memberships(spark, d).select("asset_id", "folder_id"), "asset_id").select("prompt_sha256", "folder_id").distinct()
    f = pairs.join(folders(spark, d).select("folder_id", "name"), "folder_id").groupBy("prompt_sha256").agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("folder_names"))
    return prompts(spark, d).select("prompt_sha256").join(per, "prompt_sha256").join(f, "prompt_sha256", "left").select("prompt_sha256", "assets", F.coalesce("folder_names", F.lit("")).alias("folder_names"), "models")


@q("SELECT coalesce(strftime(make_timestamp(CAST(floor(created_at_unix * 1000000) AS BIGINT)), '%Y-%m'), '<null>') AS month, count(*) AS rows FROM a GROUP BY 1")
def monthly_histogram(spark: SparkSession, d: str) -> DataFrame:
    return assets(spark, d, "created_at_unix").groupBy(N.month("created_at_unix").alias("month")).agg(F.count("*").alias("rows"))


@q("SELECT coalesce(asset_type, '<null>') AS asset_type, coalesce(status, '<null>') AS status, coalesce(model, '<null>') AS model, count(*) AS rows FROM a WHERE prompt_sha256 IS NULL GROUP BY 1, 2, 3")
def empty_prompt_distribution(spark: SparkSession, d: str) -> DataFrame:
    a = assets(spark, d, "prompt_sha256", "asset_type", "model").where("prompt_sha256 is null")
    return a.groupBy(*(R.shown(c).alias(c) for c in ("asset_type", "status", "model"))).agg(F.count("*").alias("rows"))


@q("SELECT DISTINCT asset_id, folder_id FROM ar WHERE folder_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM f WHERE f.folder_id = ar.folder_id)")
def unknown_folders(spark: SparkSession, d: str) -> DataFrame:
    a = asset_rows(spark, d).where("folder_id is not null").select("asset_id", "folder_id")
    return a.join(folders(spark, d).select("folder_id"), "folder_id", "left_anti").select("asset_id", "folder_id").distinct()


@q("SELECT prompt_sha256, source_prompt_chars FROM p WHERE EXISTS (SELECT 1 FROM a WHERE a.prompt_sha256 = p.prompt_sha256 AND a.asset_type = 'video')")
def video_universe(spark: SparkSession, d: str) -> DataFrame:
    v = assets(spark, d, "prompt_sha256", "asset_type").where("asset_type = 'video'").select("prompt_sha256").distinct()
    return prompts(spark, d).select("prompt_sha256", "source_prompt_chars").join(v, "prompt_sha256", "left_semi")


@q("SELECT DISTINCT prompt_sha256, model FROM a WHERE prompt_sha256 IN (SELECT prompt_sha256 FROM p WHERE url_redaction_count > 0) AND model IS NOT NULL")
def models_of_redacted(spark: SparkSession, d: str) -> DataFrame:
    keys = prompts(spark, d).where("url_redaction_count > 0").select("prompt_sha256")
    return assets(spark, d, "prompt_sha256", "model").where("model is not null").select("prompt_sha256", "model").distinct().join(keys, "prompt_sha256", "left_semi")


@q("""WITH x AS (SELECT source_prompt_chars AS v, row_number() OVER (ORDER BY source_prompt_chars) - 1 AS i, count(*) OVER () AS n FROM p),
g AS (SELECT unnest([0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]) AS fraction)
SELECT CAST(fraction AS DOUBLE) AS fraction, v AS value FROM x JOIN g ON i = round_even((n - 1) * fraction, 0)""")
def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return R.nearest_index_percentiles(prompts(spark, d), "source_prompt_chars", [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0])


@q("""WITH x AS (SELECT prompt_sha256, source_prompt_chars AS v, row_number() OVER (ORDER BY source_prompt_chars) - 1 AS i, count(*) OVER () AS n FROM p),
b AS (SELECT max(v) FILTER (i = round_even((n - 1) * 0.01, 0)) AS lo, max(v) FILTER (i = round_even((n - 1) * 0.99, 0)) AS hi FROM x),
o AS (SELECT prompt_sha256, v AS value, 'bottom' AS side FROM x, b WHERE v <= lo UNION ALL SELECT prompt_sha256, v, 'top' FROM x, b WHERE v >= hi)
SELECT prompt_sha256, value, side, row_number() OVER (PARTITION BY side ORDER BY CASE side WHEN 'bottom' THEN value ELSE -value END, prompt_sha256) AS place FROM o""")
def length_outliers(spark: SparkSession, d: str) -> DataFrame:
    o = R.outliers(prompts(spark, d), "prompt_sha256", "source_prompt_chars")
    return R.outlier_order(o, "prompt_sha256")


@q("SELECT prompt_sha256, count(*) AS members, min(asset_id) AS first_member FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY members DESC, prompt_sha256 LIMIT 100")
def largest_groups_top100(spark: SparkSession, d: str) -> DataFrame:
    return R.top(exact_clusters(spark, d), 100, F.col("members").desc(), F.col("prompt_sha256"))


_BLANK = "[\\s\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\x1c-\\x1f]+"
# full case folding, as far as it differs from lower case: by the characters that the tables' texts hold
_FMT = f"replace(replace(lower(trim(regexp_replace(prompt_text, '{_BLANK}', ' ', 'g'))), 'ß', 'ss'), 'ς', 'σ')"


def _numberless(x: str) -> str:
    """Numbers that stand alone replaced, without look-around: runs of word characters and points are marked, then runs that are numbers lose their sign and percent sign and become one marker."""
    n = "\\x01(\\p{Nd}+(?:\\.\\p{Nd}+)?)\\x02"
    x = f"regexp_replace({x}, '([\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}.]+)', chr(1) || '\\1' || chr(2), 'g')"
    x = f"regexp_replace({x}, '(^|[^\\x02])[+-]{n}', '\\1' || chr(1) || '\\2' || chr(2), 'g')"
    x = f"regexp_replace({x}, '{n}%([^\\x01]|$)', chr(1) || '\\1' || chr(2) || '\\2', 'g')"
    return f"replace(replace(regexp_replace({x}, '{n}', '<number>', 'g'), chr(1), ''), chr(2), '')"


_NUM = _numberless(_FMT)


def _near_sql(normal: str) -> str:
    return f"""WITH n AS (SELECT prompt_sha256, count(*) AS n FROM a GROUP BY 1), g AS (SELECT sha256({normal}) AS fingerprint, p.prompt_sha256, coalesce(n.n, 0) AS n FROM p LEFT JOIN n USING (prompt_sha256))
SELECT fingerprint, count(*) AS variants, min(prompt_sha256) AS first_key, sum(n) AS assets FROM g GROUP BY 1 HAVING count(*) >= 2"""


def _near(spark: SparkSession, d: str, normalizer) -> DataFrame:  # noqa: ANN001
    n = assets(spark, d, "prompt_sha256").groupBy("prompt_sha256").agg(F.count("*").alias("n"))
    p = prompts(spark, d).select("prompt_sha256", "prompt_text").join(n, "prompt_sha256", "left")
    return R.normalized_groups(p, "prompt_sha256", "prompt_text", normalizer, weight="n")


@q(_near_sql(_FMT))
def format_neardup_groups(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d, T.format_normalize)


@q(_near_sql(_NUM))
def numeric_neardup_groups(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d, T.numeric_normalize)


@q(f"SELECT *, row_number() OVER (ORDER BY variants DESC, assets DESC, fingerprint) AS place FROM ({_near_sql(_FMT)})")
def format_neardup_order(spark: SparkSession, d: str) -> DataFrame:
    g = _near(spark, d, T.format_normalize)
    return R.numbered(g, F.col("variants").desc(), F.col("assets").desc(), F.col("fingerprint"), name="place")


@q(f"""WITH k AS (SELECT prompt_sha256, sha256({_FMT}) AS x, sha256({_NUM}) AS y FROM p), t AS (SELECT prompt_sha256 FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY count(*) DESC, prompt_sha256 LIMIT 100),
g AS (SELECT prompt_sha256, 'format' AS group_type, x AS fingerprint FROM k WHERE x IN (SELECT x FROM k GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT prompt_sha256, 'numeric', y FROM k WHERE y IN (SELECT y FROM k GROUP BY 1 HAVING count(*) > 1))
SELECT t.prompt_sha256, g.group_type, g.fingerprint FROM t LEFT JOIN g USING (prompt_sha256)""")
def neardup_membership(spark: SparkSession, d: str) -> DataFrame:
    p = prompts(spark, d).select("prompt_sha256", F.explode(F.array(*(F.struct(F.lit(n).alias("group_type"), F.sha2(f("prompt_text"), 256).alias("fingerprint")) for n, f in (("format", T.format_normalize), ("numeric", T.numeric_normalize))))).alias("g")).select("prompt_sha256", "g.*")
    several = p.groupBy("group_type", "fingerprint").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return R.group_memberships(largest_groups_top100(spark, d), p.join(several, ["group_type", "fingerprint"]), "prompt_sha256")


@q("""WITH r AS (SELECT prompt_sha256, complexity_queue, source_prompt_chars, row_number() OVER (PARTITION BY complexity_queue ORDER BY source_prompt_chars DESC, prompt_sha256) AS rank
 FROM (SELECT DISTINCT prompt_sha256, coalesce(complexity_queue, '<null>') AS complexity_queue FROM s) JOIN p USING (prompt_sha256))
SELECT complexity_queue, rank, prompt_sha256, source_prompt_chars FROM r WHERE rank <= 12""")
def rank_candidates_per_category(spark: SparkSession, d: str) -> DataFrame:
    s = strata(spark, d, "complexity_queue").withColumn("complexity_queue", R.shown("complexity_queue")).join(prompts(spark, d).select("prompt_sha256", "source_prompt_chars"), "prompt_sha256")
    return R.top_per_group(s, "complexity_queue", 12, F.col("source_prompt_chars").desc(), F.col("prompt_sha256")).select("complexity_queue", F.col("rank").cast("bigint").alias("rank"), "prompt_sha256", "source_prompt_chars")


_SAMPLED = ["complexity_queue", "duration_state", "text_length_band"]


@q(f"""WITH e AS (SELECT DISTINCT prompt_sha256 AS key, dimension, coalesce(value, '<null>') AS value FROM ({' UNION ALL '.join(f"SELECT prompt_sha256, '{c}' AS dimension, {c} AS value FROM s" for c in _SAMPLED)})),
r AS (SELECT key, row_number() OVER (PARTITION BY dimension, value ORDER BY sha256('v1|' || dimension || '|' || value || '|' || key), key) AS n FROM e)
SELECT DISTINCT key FROM r WHERE n <= 20 UNION SELECT DISTINCT prompt_sha256 FROM s WHERE text_length_band = 'very_long'""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    s = strata(spark, d, *_SAMPLED)
    return R.hash_sample(s, "prompt_sha256", _SAMPLED, 20, "v1", s.where("text_length_band = 'very_long'").select("prompt_sha256"))


@q("""SELECT status, queue, rank, prompt_sha256 FROM (SELECT *, row_number() OVER (PARTITION BY status, queue ORDER BY prompt_sha256) AS rank FROM (
 SELECT DISTINCT coalesce(processing_status, '<null>') AS status, coalesce(complexity_queue, '<null>') AS queue, prompt_sha256 FROM s)) WHERE rank <= 10""")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    s = strata(spark, d, "processing_status", "complexity_queue").select(R.shown("processing_status").alias("status"), R.shown("complexity_queue").alias("queue"), "prompt_sha256").distinct()
    return R.top_per_group(s, ["status", "queue"], 10, F.col("prompt_sha256")).select("status", "queue", F.col("rank").cast("bigint").alias("rank"), "prompt_sha256")


@q("""WITH g AS (SELECT asset_id, list(folder_id ORDER BY folder_id) AS l FROM m GROUP BY 1)
SELECT asset_id, array_to_string(CASE WHEN len(l) <= 2 THEN l ELSE [l[1], l[len(l)]] END, ',') AS kept FROM g""")
def even_spread_selection(spark: SparkSession, d: str) -> DataFrame:
    g = memberships(spark, d).groupBy("asset_id").agg(F.array_sort(F.collect_list("folder_id")).alias("l"))
    return g.select("asset_id", F.array_join(N.spread("l", 2), ",").alias("kept"))


@q("SELECT asset_id, folder_id, prompt_sha256, source_page, source_item_index FROM a")
def first_seen_assets(spark: SparkSession, d: str) -> DataFrame:
    return assets(spark, d, "folder_id", "prompt_sha256").select("asset_id", "folder_id", "prompt_sha256", "source_page", "source_item_index")


@q("""SELECT asset_id, source_page, source_item_index, occurrence FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY source_page NULLS FIRST, source_item_index NULLS FIRST, status NULLS FIRST, fetched_at NULLS FIRST) AS occurrence FROM ar) WHERE occurrence > 1""")
def duplicate_asset_issues(spark: SparkSession, d: str) -> DataFrame:
    by = [F.col(c).asc_nulls_first() for c in ("source_page", "source_item_index", "status", "fetched_at")]
    return R.repeats(asset_rows(spark, d), ["asset_id"], *by).select("asset_id", "source_page", "source_item_index", F.col("occurrence").cast("bigint").alias("occurrence"))


@q("""SELECT asset_id, arg_max(coalesce(status, '<null>'), {'p': source_page, 'i': source_item_index, 's': coalesce(status, '<null>')}) AS status, max(source_page) AS last_page FROM ar WHERE source_page IS NOT NULL AND source_item_index IS NOT NULL GROUP BY 1""")
def latest_asset_state(spark: SparkSession, d: str) -> DataFrame:
    rows = asset_rows(spark, d).where("source_page is not null and source_item_index is not null").select("asset_id", R.shown("status").alias("status"), "source_page", "source_item_index")
    first = R.first_wins(rows, ["asset_id"], F.col("source_page"), F.col("source_item_index"), F.col("status"))
    got = R.upsert(first, rows, ["asset_id"], F.col("source_page"), F.col("source_item_index"), F.col("status"))  # what was listed first, overwritten by what came last
    return got.select("asset_id", "status", F.col("source_page").alias("last_page"))


@q("""SELECT asset_id, count(DISTINCT source_page) AS pages, string_agg(DISTINCT CAST(source_page AS VARCHAR), ',' ORDER BY CAST(source_page AS VARCHAR)) AS pages_seen FROM ar GROUP BY 1 HAVING count(*) > 1""")
def asset_occurrences(spark: SparkSession, d: str) -> DataFrame:
    g = asset_rows(spark, d).groupBy("asset_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.col("source_page").cast("string"))).alias("p")).where("n > 1")
    return g.select("asset_id", F.size("p").cast("bigint").alias("pages"), F.array_join("p", ",").alias("pages_seen"))


@q("""SELECT source_page AS page, count(*) AS received, count(DISTINCT asset_id) AS assets, count(prompt_sha256) AS prompts, count(*) FILTER (prompt_sha256 IS NULL) AS errors,
 count(*) FILTER (prompt_sha256 IN (SELECT prompt_sha256 FROM p WHERE url_redaction_count > 0)) AS warnings FROM ar GROUP BY 1""")
def page_counters(spark: SparkSession, d: str) -> DataFrame:
    red = prompts(spark, d).where("url_redaction_count > 0").select("prompt_sha256", F.lit(1).alias("_red"))
    rows = asset_rows(spark, d).select("source_page", "asset_id", "prompt_sha256").join(red, "prompt_sha256", "left")
    return rows.groupBy(F.col("source_page").alias("page")).agg(F.count("*").alias("received"), F.count_distinct("asset_id").alias("assets"), F.count("prompt_sha256").alias("prompts"), F.count_if(F.col("prompt_sha256").isNull()).alias("errors"), F.count("_red").alias("warnings"))


@q("SELECT after, n AS next FROM (SELECT n, coalesce(lag(n) OVER (ORDER BY n), 0) AS after FROM (SELECT DISTINCT source_page AS n FROM assets WHERE source_page IS NOT NULL)) WHERE n <> after + 1")
def page_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return C.gaps(table(spark, d, "assets"), "source_page")


@q("""SELECT source_page AS page, count(DISTINCT source_item_index) AS items, max(source_item_index) + 1 AS expected FROM ar GROUP BY 1 HAVING count(DISTINCT source_item_index) <> max(source_item_index) + 1""")
def page_item_gaps(spark: SparkSession, d: str) -> DataFrame:
    g = asset_rows(spark, d).groupBy(F.col("source_page").alias("page")).agg(F.count_distinct("source_item_index").alias("items"), (F.max("source_item_index") + 1).alias("expected"))
    return g.where("items <> expected")


@q("SELECT max(source_page) AS last_page, arg_max(fetched_at, {'p': source_page, 'i': source_item_index, 'f': fetched_at}) AS fetched_at FROM ar WHERE source_page IS NOT NULL AND source_item_index IS NOT NULL AND fetched_at IS NOT NULL")
def last_page(spark: SparkSession, d: str) -> DataFrame:
    a = asset_rows(spark, d).where("source_page is not null and source_item_index is not null and fetched_at is not null")
    return a.agg(F.max("source_page").alias("last_page"), F.max_by("fetched_at", F.struct("source_page", "source_item_index", "fetched_at")).alias("fetched_at"))


_KEYED = "SELECT nullif(lower(trim(asset_id)), '') AS asset_id, nullif(lower(trim(folder_id)), '') AS folder_id FROM asset_folder_memberships"


@q(f"SELECT asset_id, folder_id, count(*) AS rows FROM ({_KEYED}) GROUP BY 1, 2 HAVING count(*) > 1 OR asset_id IS NULL OR folder_id IS NULL")
def pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return C.duplicate_keys(membership_rows(spark, d), ["asset_id", "folder_id"])


@q("SELECT prompt_sha256 AS key, count(*) AS rows FROM a WHERE prompt_sha256 IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.prompt_sha256 = a.prompt_sha256) GROUP BY 1")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    return C.foreign_keys(assets(spark, d, "prompt_sha256"), "prompt_sha256", prompts(spark, d), "prompt_sha256")


@q("""SELECT CASE WHEN s.prompt_sha256 IS NULL THEN 'left_only' ELSE 'right_only' END AS side, coalesce(p.prompt_sha256, s.prompt_sha256) AS prompt_sha256
FROM (SELECT DISTINCT prompt_sha256 FROM p) p FULL JOIN (SELECT DISTINCT prompt_sha256 FROM s) s ON p.prompt_sha256 = s.prompt_sha256 WHERE p.prompt_sha256 IS NULL OR s.prompt_sha256 IS NULL""")
def universe_closure(spark: SparkSession, d: str) -> DataFrame:
    return R.closure(prompts(spark, d), strata(spark, d), ["prompt_sha256"])


@q("""SELECT prompt_sha256, CASE WHEN length(prompt_text) <> analysis_prompt_chars THEN 'length' ELSE 'hash' END AS fault FROM p
WHERE length(prompt_text) <> analysis_prompt_chars OR (url_redaction_count = 0 AND sha256(prompt_text) <> prompt_sha256)""")
def source_identity(spark: SparkSession, d: str) -> DataFrame:
    return C.identity_faults(prompts(spark, d), "prompt_sha256", "prompt_text", "analysis_prompt_chars", F.col("url_redaction_count") > 0)


@q("""WITH k AS (SELECT parent_id AS folder_id, count(*) AS children, sum(reported_asset_count) AS s FROM f WHERE parent_id IS NOT NULL GROUP BY 1)
SELECT f.folder_id, coalesce(children, 0) AS children, coalesce(s, 0) AS child_reported, reported_asset_count - coalesce(s, 0) AS derived_direct,
 greatest(0, len([x FOR x IN string_split(coalesce(path, ''), '/') IF x <> '']) - 1) AS path_depth,
 CASE WHEN f.parent_id IS NOT NULL AND f.parent_id NOT IN (SELECT folder_id FROM f) THEN 'missing_parent' WHEN reported_asset_count - coalesce(s, 0) < 0 THEN 'negative_derived_direct_count' END AS issue
FROM f LEFT JOIN k USING (folder_id)""")
def folder_direct_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.direct_counts(folders(spark, d))


@q("""WITH n AS (SELECT folder_id, count(*) AS n FROM a WHERE folder_id IS NOT NULL GROUP BY 1)
SELECT f.folder_id AS key, derived_direct_asset_count AS stated, coalesce(n, 0) AS counted FROM f LEFT JOIN n USING (folder_id) WHERE derived_direct_asset_count IS DISTINCT FROM coalesce(n, 0)""")
def recount_check(spark: SparkSession, d: str) -> DataFrame:
    f = folders(spark, d).select(F.col("folder_id").alias("key"), "derived_direct_asset_count")
    got = C.recount_faults(f, assets(spark, d, "folder_id").where("folder_id is not null").select(F.col("folder_id").alias("key")).join(f.select("key"), "key", "left_semi"), "key", "derived_direct_asset_count")
    return got.select("key", "stated", "counted")


@q("""SELECT count(*) AS folders, max(depth) AS max_depth, sum(reported_asset_count) AS reported, count(*) FILTER (parent_id IS NULL) AS roots, count(*) FILTER (derived_direct_asset_count < 0) AS negative,
 count(*) FILTER (derived_direct_asset_count = 0) AS empty, count(*) FILTER (derived_direct_asset_count BETWEEN 1 AND 9) AS few, count(*) FILTER (derived_direct_asset_count >= 10) AS many FROM f""")
def folder_summary(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("derived_direct_asset_count")
    return folders(spark, d).agg(F.count("*").alias("folders"), F.max("depth").alias("max_depth"), F.sum("reported_asset_count").alias("reported"), F.count_if(F.col("parent_id").isNull()).alias("roots"), F.count_if(n < 0).alias("negative"), F.count_if(n == 0).alias("empty"), F.count_if(n.between(1, 9)).alias("few"), F.count_if(n >= 10).alias("many"))


@q("SELECT derived_direct_asset_count AS direct_assets, count(*) AS folders FROM f GROUP BY 1")
def folder_count_histogram(spark: SparkSession, d: str) -> DataFrame:
    return folders(spark, d).groupBy(F.col("derived_direct_asset_count").alias("direct_assets")).agg(F.count("*").alias("folders"))


@q("""SELECT p.prompt_sha256, count(*) AS assets, coalesce(string_agg(DISTINCT model, ',' ORDER BY model), '') AS models, count(DISTINCT duration_seconds) AS durations, coalesce(string_agg(DISTINCT resolution, ',' ORDER BY resolution), '') AS resolutions
FROM p JOIN a USING (prompt_sha256) GROUP BY 1""")
def asset_metadata(spark: SparkSession, d: str) -> DataFrame:
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    a = assets(spark, d, "prompt_sha256", "model", "duration_seconds", "resolution").where("prompt_sha256 is not null")
    per = a.groupBy("prompt_sha256").agg(F.count("*").alias("assets"), join("model").alias("models"), F.size(F.collect_set("duration_seconds")).cast("bigint").alias("durations"), join("resolution").alias("resolutions"))
    return per.join(prompts(spark, d).select("prompt_sha256"), "prompt_sha256", "left_semi")


@q("""WITH t AS (SELECT row_number() OVER (ORDER BY n DESC, prompt_sha256) AS ordinal, prompt_sha256 FROM (SELECT prompt_sha256, count(*) AS n FROM a WHERE prompt_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, prompt_sha256 LIMIT 100) UNION ALL SELECT 0, 'unknown'),
x AS (SELECT asset_id, string_agg(folder_id, '+' ORDER BY folder_id) AS f FROM m GROUP BY 1)
SELECT t.ordinal, t.prompt_sha256, p.prompt_sha256 IS NOT NULL AS found, coalesce(string_agg(a.asset_id || ':' || coalesce(x.f, ''), ',' ORDER BY a.asset_id), '') AS assets FROM t LEFT JOIN p USING (prompt_sha256) LEFT JOIN a ON a.prompt_sha256 = t.prompt_sha256 LEFT JOIN x ON x.asset_id = a.asset_id GROUP BY 1, 2, 3""")
def nested_export(spark: SparkSession, d: str) -> DataFrame:
    asked = R.numbered(largest_groups_top100(spark, d).select("prompt_sha256", "members"), F.col("members").desc(), F.col("prompt_sha256"), name="ordinal").select("ordinal", "prompt_sha256")
    asked = asked.union(spark.createDataFrame([(0, "unknown")], "ordinal bigint, prompt_sha256 string"))
    e = R.nested_export(asked, prompts(spark, d), assets(spark, d, "prompt_sha256"), memberships(spark, d))
    return e.select("ordinal", "prompt_sha256", "found", F.array_join(F.transform("assets", lambda a: F.concat(a["asset_id"], F.lit(":"), F.array_join(a["folders"], "+"))), ",").alias("assets"))


@q("""SELECT coalesce(a.model, '<null>') AS model, coalesce(f.name, '<unknown>') AS folder_name, count(*) AS rows, count(DISTINCT m.folder_id) AS folders FROM m JOIN a USING (asset_id) LEFT JOIN f ON m.folder_id = f.folder_id GROUP BY 1, 2""")
def membership_models(spark: SparkSession, d: str) -> DataFrame:
    j = memberships(spark, d).select("asset_id", "folder_id").join(assets(spark, d, "model").select("asset_id", "model"), "asset_id")
    n = j.groupBy("folder_id", R.shown("model").alias("model")).agg(F.count("*").alias("n"))  # before names: a hot folder is a few rows
    return n.join(folders(spark, d).select("folder_id", "name"), "folder_id", "left").groupBy("model", R.shown("name", "<unknown>").alias("folder_name")).agg(F.sum("n").alias("rows"), F.count_distinct("folder_id").alias("folders"))


@q("""SELECT a.prompt_sha256, count(*) AS occurrences, count(DISTINCT r.source_page) AS pages FROM ar r JOIN a USING (asset_id) JOIN p ON p.prompt_sha256 = a.prompt_sha256 GROUP BY 1""")
def prompt_occurrences(spark: SparkSession, d: str) -> DataFrame:
    per = asset_rows(spark, d).groupBy("asset_id", "source_page").agg(F.count("*").alias("n"))
    j = per.join(assets(spark, d, "prompt_sha256").select("asset_id", "prompt_sha256"), "asset_id").groupBy("prompt_sha256", "source_page").agg(F.sum("n").alias("n"))
    return j.groupBy("prompt_sha256").agg(F.sum("n").alias("occurrences"), F.count("source_page").alias("pages")).join(prompts(spark, d).select("prompt_sha256"), "prompt_sha256", "left_semi")


@q("""WITH i AS (SELECT asset_id, 'duplicate_asset_id' AS code FROM (SELECT asset_id, row_number() OVER (PARTITION BY asset_id ORDER BY source_page) AS n FROM ar) WHERE n > 1 UNION ALL SELECT asset_id, 'missing_folder_id' FROM ar WHERE folder_id IS NULL)
SELECT a.prompt_sha256, i.code, count(*) AS issues FROM i JOIN a USING (asset_id) WHERE a.prompt_sha256 IS NOT NULL GROUP BY 1, 2""")
def prompt_asset_issues(spark: SparkSession, d: str) -> DataFrame:
    r = asset_rows(spark, d).groupBy("asset_id").agg((F.count("*") - 1).alias("again"), F.count_if(F.col("folder_id").isNull()).alias("gone"))
    codes = F.explode(F.array(F.struct(F.lit("duplicate_asset_id").alias("code"), F.col("again").alias("n")), F.struct(F.lit("missing_folder_id").alias("code"), F.col("gone").alias("n"))))
    i = r.select("asset_id", codes.alias("i")).select("asset_id", "i.code", "i.n").where("n > 0")
    return i.join(assets(spark, d, "prompt_sha256").where("prompt_sha256 is not null").select("asset_id", "prompt_sha256"), "asset_id").groupBy("prompt_sha256", "code").agg(F.sum("n").alias("issues"))


@q("""WITH x AS (SELECT prompt_sha256, count(*) AS assets, count(DISTINCT asset_id) AS distinct_assets FROM ar WHERE prompt_sha256 IS NOT NULL GROUP BY 1), y AS (SELECT a.prompt_sha256, count(*) AS memberships FROM a JOIN m USING (asset_id) WHERE a.prompt_sha256 IS NOT NULL GROUP BY 1)
SELECT p.prompt_sha256, coalesce(x.assets, 0) AS occurrences, coalesce(x.distinct_assets, 0) AS assets, coalesce(y.memberships, 0) AS memberships FROM p LEFT JOIN x USING (prompt_sha256) LEFT JOIN y ON y.prompt_sha256 = p.prompt_sha256
WHERE coalesce(x.assets, 0) <> coalesce(x.distinct_assets, 0) OR coalesce(x.distinct_assets, 0) > coalesce(y.memberships, 0)""")
def mapping_count_faults(spark: SparkSession, d: str) -> DataFrame:
    return C.mapping_faults(prompts(spark, d), asset_rows(spark, d), memberships(spark, d), assets(spark, d, "prompt_sha256"))


@q("SELECT event_type AS code, count(*) AS rows FROM events GROUP BY 1")
def event_code_counts(spark: SparkSession, d: str) -> DataFrame:
    from corpuslathe.streaming.ingest import code_counts

    return code_counts(table(spark, d, "events").withColumnRenamed("event_type", "code"))


@q("""WITH e AS (SELECT coalesce(text_length_band, '<null>') AS value FROM s UNION ALL SELECT coalesce(duration_state, '<null>') FROM s) SELECT value, count(*) AS rows FROM e GROUP BY 1""")
def object_key_counts(spark: SparkSession, d: str) -> DataFrame:
    s = strata_rows(spark, d).select(F.to_json(F.array(F.struct(F.col("text_length_band").alias("value")), F.struct(F.col("duration_state").alias("value")))).alias("objects"))
    return R.object_key_counts(s, "objects", "value")


_MEMBERS = """SELECT DISTINCT prompt_sha256, value FROM (SELECT prompt_sha256, nullif(lower(trim(unnest(from_json({c}, '["VARCHAR"]')))), '') AS value FROM s WHERE json_valid({c}) AND json_type({c}) = 'ARRAY') WHERE value IS NOT NULL"""


def _member_counts(spark: SparkSession, d: str, c: str) -> DataFrame:
    tags = F.transform(F.try_variant_get(F.try_parse_json(c), "$", "array<string>"), lambda x: key(x))
    s = strata(spark, d, c).select("prompt_sha256", F.array_distinct(F.array_compact(tags)).alias("tags"))
    one = s.select("prompt_sha256", F.explode("tags").alias("value")).distinct()  # rows of one prompt unite
    return one.groupBy("value").agg(F.count("*").alias("rows"))


@q(f"SELECT value, count(*) AS rows FROM ({_MEMBERS.format(c='scene_tags_json')}) GROUP BY 1")
def scene_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return _member_counts(spark, d, "scene_tags_json")


@q(f"SELECT value, count(*) AS rows FROM ({_MEMBERS.format(c='risk_flags_json')}) GROUP BY 1")
def risk_flag_counts(spark: SparkSession, d: str) -> DataFrame:
    return _member_counts(spark, d, "risk_flags_json")


@q(f"SELECT value, count(*) AS rows FROM ({_MEMBERS.format(c='queue_reasons_json')}) GROUP BY 1")
def reason_code_counts(spark: SparkSession, d: str) -> DataFrame:
    return _member_counts(spark, d, "queue_reasons_json")


_ROW = "concat_ws(chr(31), prompt_sha256, prompt_text, CAST(source_prompt_chars AS VARCHAR))"


@q(f"""WITH h AS (SELECT prompt_sha256 AS k, sha256({_ROW}) AS h FROM prompts), b AS (SELECT substr(sha256(k), 1, 2) AS b, sha256(string_agg(h, '' ORDER BY k, h)) AS d, count(*) AS n FROM h GROUP BY 1)
SELECT 'prompts' AS name, CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM b""")
def table_digest(spark: SparkSession, d: str) -> DataFrame:
    return hashing.ordered_digest(table(spark, d, "prompts"), "prompt_sha256", ["prompt_sha256", "prompt_text", "source_prompt_chars"], digits=2).select(F.lit("prompts").alias("name"), "rows", "digest")


_FIELD = "CASE WHEN {c} IS NULL THEN 'n' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


@q(f"""SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(sha256({" || ',' || ".join(_FIELD.format(c=c) for c in ('asset_id', 'folder_id', 'model', 'source_page'))}), 1, 15) AS BIGINT)) AS VARCHAR) AS digest FROM assets""")
def commutative_digest(spark: SparkSession, d: str) -> DataFrame:
    return hashing.table_digest(table(spark, d, "assets"), ["asset_id", "folder_id", "model", "source_page"])


@q("""SELECT c.n_name AS nation, count(*) AS orders, count(DISTINCT o.o_custkey) AS customers FROM orders o JOIN customer u ON o.o_custkey = u.c_custkey JOIN nation c ON u.c_nationkey = c.n_nationkey GROUP BY 1""")
def orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    j = table(spark, d, "orders").select("o_custkey").join(c, "o_custkey").join(table(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    return j.groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"))


@q("""WITH n AS (SELECT count(*) AS occurrences, count(DISTINCT asset_id) AS assets, count(DISTINCT source_page) AS pages, min(source_page) AS first, max(source_page) AS last FROM ar),
pg AS (SELECT sum(stated) AS received FROM (SELECT max(source_item_index) + 1 AS stated FROM ar GROUP BY source_page)),
d AS (SELECT count(*) AS again FROM (SELECT row_number() OVER (PARTITION BY asset_id ORDER BY source_page) AS r FROM ar) WHERE r > 1),
u AS (SELECT count(*) FILTER (lower(prompt_text) ~ 'https?://') AS urls, count(*) FILTER (url_redaction_count = 0 AND sha256(prompt_text) <> prompt_sha256) AS hashes, count(*) FILTER (length(prompt_text) <> analysis_prompt_chars) AS lengths FROM p),
k AS (SELECT count(DISTINCT asset_id) AS unknown FROM a WHERE folder_id IS NOT NULL AND folder_id NOT IN (SELECT folder_id FROM f)),
h AS (SELECT count(DISTINCT prompt_sha256) AS orphans FROM a WHERE prompt_sha256 IS NOT NULL AND prompt_sha256 NOT IN (SELECT prompt_sha256 FROM p)),
c AS (SELECT 'item_occurrence_count' AS "check", occurrences AS actual, received AS expected FROM n, pg UNION ALL SELECT 'accounted_occurrence_count', assets + again, occurrences FROM n, d UNION ALL SELECT 'page_sequence_contiguous', pages, last FROM n
 UNION ALL SELECT 'stored_prompt_urls_absent', urls, 0 FROM u UNION ALL SELECT 'prompt_hashes_match', hashes, 0 FROM u UNION ALL SELECT 'prompt_lengths_match', lengths, 0 FROM u UNION ALL SELECT 'unknown_folder_assets_absent', unknown, 0 FROM k UNION ALL SELECT 'orphan_prompts_absent', orphans, 0 FROM h)
SELECT "check", CAST(actual AS BIGINT) AS actual, CAST(expected AS BIGINT) AS expected, actual = expected AS passed FROM c UNION ALL SELECT 'all', count(*) FILTER (actual = expected), count(*), bool_and(actual = expected) FROM c""")
def corpus_checks(spark: SparkSession, d: str) -> DataFrame:
    return C.corpus_audit(asset_rows(spark, d), assets(spark, d, "folder_id", "prompt_sha256"), prompts(spark, d), folders(spark, d))


@q("""WITH j AS (SELECT f.*, g.folder_id IS NOT NULL AS known FROM f LEFT JOIN f g ON f.parent_id = g.folder_id), x AS (SELECT folder_id, reported_asset_count - coalesce((SELECT sum(reported_asset_count) FROM f k WHERE k.parent_id = f.folder_id), 0) AS direct FROM f),
t AS (SELECT sum(reported_asset_count) FILTER (parent_id IS NULL OR NOT known) AS roots, count(*) FILTER (parent_id IS NOT NULL AND NOT known) AS missing, count(*) AS n FROM j), y AS (SELECT sum(direct) AS direct, count(*) FILTER (direct < 0) AS negative FROM x),
c AS (SELECT 'derived_direct_asset_total' AS "check", direct AS actual, roots AS expected FROM t, y UNION ALL SELECT 'missing_parents_absent', missing, 0 FROM t UNION ALL SELECT 'negative_direct_counts_absent', negative, 0 FROM y)
SELECT "check", CAST(actual AS BIGINT) AS actual, CAST(expected AS BIGINT) AS expected, actual = expected AS passed FROM c UNION ALL SELECT 'all', count(*) FILTER (actual = expected), count(*), bool_and(actual = expected) FROM c""")
def inventory_checks(spark: SparkSession, d: str) -> DataFrame:
    return C.inventory_audit(R.direct_counts(folders(spark, d)), folders(spark, d))


@q("""WITH x AS (SELECT prompt_sha256, count(*) AS n FROM (SELECT DISTINCT prompt_sha256, complexity_queue FROM s) GROUP BY 1), y AS (SELECT prompt_sha256, count(*) AS n FROM a GROUP BY 1), z AS (SELECT a.prompt_sha256, count(*) AS n FROM a JOIN m USING (asset_id) GROUP BY 1)
SELECT p.prompt_sha256, coalesce(x.n, 0) AS n_strata, coalesce(y.n, 0) AS n_assets, coalesce(z.n, 0) AS n_memberships, x.n IS NOT NULL AND y.n IS NOT NULL AND z.n IS NOT NULL AS complete,
 concat_ws(',', CASE WHEN x.n IS NULL THEN 'strata' END, CASE WHEN y.n IS NULL THEN 'assets' END, CASE WHEN z.n IS NULL THEN 'memberships' END) AS missing FROM p LEFT JOIN x USING (prompt_sha256) LEFT JOIN y ON y.prompt_sha256 = p.prompt_sha256 LEFT JOIN z ON z.prompt_sha256 = p.prompt_sha256""")
def assembled_prompts(spark: SparkSession, d: str) -> DataFrame:
    a = assets(spark, d, "prompt_sha256").select("asset_id", "prompt_sha256")
    got = R.assembled(prompts(spark, d), "prompt_sha256", strata=strata(spark, d, "complexity_queue"), assets=a, memberships=a.join(memberships(spark, d).select("asset_id"), "asset_id"))
    return got.withColumn("missing", F.array_join("missing", ","))


_SORTED = """array_to_string(list_sort(list_distinct(list_filter([nullif(lower(trim(x)), '') FOR x IN from_json(CASE WHEN json_valid({c}) AND json_type({c}) = 'ARRAY' THEN {c} ELSE '[]' END, '["VARCHAR"]')], lambda x: x IS NOT NULL))), ',')"""


@q(f"SELECT DISTINCT prompt_sha256, {_SORTED.format(c='scene_tags_json')} AS scene_tags, {_SORTED.format(c='risk_flags_json')} AS risk_flags, {_SORTED.format(c='queue_reasons_json')} AS queue_reasons FROM s")
def strata_features(spark: SparkSession, d: str) -> DataFrame:
    f = R.json_features(strata_rows(spark, d), "prompt_sha256", {"scene_tags": "scene_tags_json", "risk_flags": "risk_flags_json", "queue_reasons": "queue_reasons_json"})
    return f.select("prompt_sha256", *(F.array_join(c, ",").alias(c) for c in ("scene_tags", "risk_flags", "queue_reasons"))).distinct()
