"""SQL that DuckDB runs on the same tables, where SQL can express the result."""

from __future__ import annotations

_CURRENT = """
cur AS (
  SELECT * FROM utterances WHERE instance_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY instance_id ORDER BY ingested_at DESC NULLS LAST) = 1
)"""


def _norm(column: str) -> str:
    return f"lower(trim(nfc_normalize({column}), ' '))"


_P1 = f"""
WITH {_CURRENT}
SELECT instance_id FROM cur JOIN pack_limits USING (dataset)
WHERE round_even(coalesce(metadata.audio_length, end_t - start_t) * 1000, 0) > round_even(capacity_s * 1000, 0)
"""

_TERMS = f"""
WITH {_CURRENT},
raw AS (
  SELECT instance_id, 'speaker' AS field, speaker AS v FROM cur
  UNION ALL SELECT instance_id, 'sentiment_6', labels.sentiment_6 FROM cur
  UNION ALL SELECT instance_id, 'dialogue_act_function', labels.dialogue_act_function FROM cur
  UNION ALL SELECT instance_id, 'fp_type', unnest(labels.fp_type) FROM cur
),
terms AS (SELECT instance_id, field, {_norm('v')} AS term FROM raw),
counts AS (
  SELECT field, term, CAST(count(*) AS BIGINT) AS occurrences, CAST(count(DISTINCT instance_id) AS BIGINT) AS records
  FROM terms WHERE term IS NOT NULL AND term NOT IN ('', '-', 'unknown') GROUP BY field, term
),
marked AS (
  SELECT field, term, CAST(row_number() OVER (ORDER BY field, term) - 1 AS BIGINT) AS id, occurrences, records,
    CASE WHEN records < 3 THEN 'rare' WHEN records * 5 > (SELECT count(*) FROM cur) THEN 'common' END AS mark
  FROM counts
)"""

_P4 = f"""
WITH {_CURRENT},
cat AS (
  SELECT {_norm('metadata.speaker_info.lang')} AS lang, {_norm('metadata.speaker_info.speaker_gender')} AS gender,
    {_norm('labels.sentiment_6')} AS sentiment_6 FROM cur
),
ok AS (
  SELECT * FROM cat WHERE lang NOT IN ('', '-', 'unknown') AND gender NOT IN ('', '-', 'unknown')
    AND sentiment_6 NOT IN ('', '-', 'unknown')
),
n AS (SELECT count(*) // 5 AS n FROM ok),
have AS (SELECT lang, gender, sentiment_6, count(*) AS available FROM ok GROUP BY ALL),
goal AS (
  SELECT {_norm('lang')} AS lang, {_norm('gender')} AS gender, {_norm('sentiment_6')} AS sentiment_6, target_permille, min_rows
  FROM sample_targets
)
SELECT goal.lang, goal.gender, goal.sentiment_6 FROM goal LEFT JOIN have USING (lang, gender, sentiment_6), n
WHERE coalesce(available, 0) < greatest(min_rows, (n.n * target_permille + 999) // 1000)
"""

_P5 = f"""
WITH RECURSIVE {_CURRENT},
pair AS (SELECT {_norm('speaker_id')} AS a, {_norm('same_as')} AS b FROM speakers),
ids AS (SELECT DISTINCT a FROM pair WHERE a NOT IN ('', '-', 'unknown')),
link AS (
  SELECT a, b FROM pair WHERE a NOT IN ('', '-', 'unknown') AND b NOT IN ('', '-', 'unknown')
  UNION SELECT b, a FROM pair WHERE a NOT IN ('', '-', 'unknown') AND b NOT IN ('', '-', 'unknown')
),
reach AS (
  SELECT a AS x, a AS y FROM ids UNION SELECT b, b FROM link
  UNION SELECT reach.x, link.b FROM reach JOIN link ON reach.y = link.a
),
person AS (SELECT x AS id, min(y) FILTER (y IN (SELECT a FROM ids)) AS person FROM reach GROUP BY x),
who AS (
  SELECT file_id, {_norm('split')} AS split,
    CASE WHEN {_norm('speaker')} NOT IN ('', '-', 'unknown') THEN {_norm('speaker')} END AS id FROM cur
)
SELECT entity FROM (
  SELECT CASE WHEN id IS NULL THEN 'r' ELSE 'p' END AS kind,
    CASE WHEN id IS NULL THEN file_id ELSE coalesce(person, id) END AS entity, split
  FROM who LEFT JOIN person USING (id)
) WHERE split IN ('train', 'dev', 'test') GROUP BY kind, entity HAVING count(DISTINCT split) > 1
"""

_P6 = """
SELECT DISTINCT instance_id FROM frame_records JOIN pack_limits USING (dataset)
WHERE round_even(greatest(coalesce(metadata.audio_length, 0),
    coalesce(CASE WHEN frame_rate_hz > 0 THEN len(labels.filled_pause) / frame_rate_hz END, 0)) * 1000, 0)
  > round_even(max_piece_s * 1000, 0)
"""

ORACLE: dict[str, str] = {
    "p1_found": _P1,
    "p2_found": _TERMS + " SELECT field, term, mark FROM marked WHERE mark IS NOT NULL",
    "p2_terms": _TERMS + " SELECT * FROM marked",
    "p4_found": _P4,
    "p5_found": _P5,
    "p6_found": _P6,
}
