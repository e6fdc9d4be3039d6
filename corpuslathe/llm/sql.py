"""SQL of the queries that SQL can express over whole tables in reasonable time."""

from __future__ import annotations

from corpuslathe.llm.words import HAN_KANA

P5_FOUND = """
WITH s AS (SELECT DISTINCT lower(trim(prompt_sha256)) AS id, lower(trim(complexity_queue)) AS q, lower(trim(text_length_band)) AS b, lower(trim(duration_state)) AS u,
    CASE WHEN json_valid(scene_tags_json) AND json_type(scene_tags_json) = 'ARRAY' THEN scene_tags_json END AS tags
  FROM prompt_strata WHERE nullif(lower(trim(prompt_sha256)), '') IS NOT NULL),
c AS (SELECT 'complexity_queue' AS dimension, q AS category, id FROM s UNION SELECT 'text_length_band', b, id FROM s UNION SELECT 'duration_state', u, id FROM s
  UNION SELECT 'scene_tag', lower(trim(json_extract_string(tags, '$[' || i || ']'))), id FROM (SELECT id, tags, unnest(range(CAST(json_array_length(tags) AS BIGINT))) AS i FROM s WHERE tags IS NOT NULL)),
n AS (SELECT dimension, category, count(DISTINCT id) AS n FROM c GROUP BY 1, 2),
a AS (SELECT count(DISTINCT id) AS total FROM s)
SELECT DISTINCT t.dimension, t.category FROM sampling_targets t CROSS JOIN a LEFT JOIN n ON n.dimension = lower(trim(t.dimension)) AND n.category = lower(trim(t.category))
WHERE coalesce(n.n, 0) < greatest(CAST(t.min_rows AS DOUBLE), t.target_share * a.total / 5.0)
"""

#: Han and kana characters get blanks around them first: each is a word.
_WORDS = f"regexp_extract_all(regexp_replace(lower({{c}}), '([{HAN_KANA}])', ' \\1 ', 'g'), '[\\p{{{{L}}}}\\p{{{{N}}}}]+')"

P2_FOUND = f"""
WITH w AS (SELECT prompt_sha256 AS id, {_WORDS.format(c="prompt_text")} AS w FROM prompts),
g AS (SELECT DISTINCT id, array_to_string(w[k:k + 2], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS k FROM w WHERE len(w) >= 3)),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2)
SELECT a AS prompt_sha256_a, b AS prompt_sha256_b FROM o JOIN n x ON o.a = x.id JOIN n y ON o.b = y.id WHERE 10 * c >= 6 * (x.n + y.n - c)
"""

P8_FOUND = f"""
WITH i AS (SELECT item_id, {_WORDS.format(c="text")} AS w FROM eval_items),
d AS (SELECT doc_id, {_WORDS.format(c="text")} AS w FROM documents),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 14], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS k FROM i WHERE len(w) >= 15)),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 14], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM d WHERE len(w) >= 15))
SELECT DISTINCT item_id, doc_id FROM ig JOIN dg USING (g)
"""
