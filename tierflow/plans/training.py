"""Queries of the general operators for training data: nested records and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.common import current, ms, table
from tierflow.operators import nested, periods


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child row of every record, without its content."""
    return nested.child_positions(nested.records(table(spark, sf_dir, "record_lines")))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat parent table."""
    return nested.record_table(nested.records(table(spark, sf_dir, "record_lines")))


def _child(child: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return nested.child_table(nested.records(table(spark, sf_dir, "record_lines")), child)

    query.__doc__ = f"The flat table of {child}."
    return query


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods and gaps of every tier of a recording and of every utterance's filled pauses."""
    tiers = table(spark, sf_dir, "tier_intervals").select(
        F.col("file_id").alias("item"), F.col("tier").alias("layer"), ms("start_t").alias("start_ms"), ms("end_t").alias("end_ms")
    )
    spoken = current(table(spark, sf_dir, "utterances"), payload=["metadata.filled_pauses"])
    pauses = spoken.select("instance_id", F.explode("metadata.filled_pauses").alias("p")).select(
        F.col("instance_id").alias("item"), F.lit("filled_pauses").alias("layer"),
        ms("p.time_s").alias("start_ms"), ms("p.time_e").alias("end_ms"),
    )
    return periods.periods_and_gaps(tiers.unionByName(pauses))


QUERIES = {
    "p3_found": p3_found,
    "p3_records": p3_records,
    **{f"p3_{c}": _child(c) for c in nested.COLUMNS},
    "p7_found": p7_found,
}

_P7 = """
WITH cur AS (
  SELECT instance_id, metadata.filled_pauses AS fps FROM utterances WHERE instance_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY instance_id ORDER BY ingested_at DESC NULLS LAST) = 1
),
one AS (SELECT instance_id, unnest(fps) AS p FROM cur),
every AS (
  SELECT file_id AS item, tier AS layer, start_t AS s, end_t AS e FROM tier_intervals WHERE file_id IS NOT NULL
  UNION ALL SELECT instance_id, 'filled_pauses', p.time_s, p.time_e FROM one
),
valid AS (
  SELECT item, layer, CAST(round_even(s * 1000, 0) AS BIGINT) AS s, CAST(round_even(e * 1000, 0) AS BIGINT) AS e FROM every
  WHERE s IS NOT NULL AND e IS NOT NULL
),
marked AS (
  SELECT *, max(e) OVER (PARTITION BY item, layer ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM valid WHERE e > s
),
numbered AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END)
    OVER (PARTITION BY item, layer ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM marked
),
period AS (SELECT item, layer, k, min(s) AS start_ms, max(e) AS end_ms FROM numbered GROUP BY item, layer, k),
gap AS (
  SELECT item, layer, lag(end_ms) OVER (PARTITION BY item, layer ORDER BY k) AS start_ms, start_ms AS end_ms FROM period
)
SELECT item, layer, 'period' AS kind, start_ms, end_ms FROM period
UNION ALL SELECT item, layer, 'gap', start_ms, end_ms FROM gap WHERE start_ms IS NOT NULL
"""



def _opened(j: str) -> str:
    held = f"({j} ->> '$')"
    return rf"(CASE WHEN json_type({j}) = 'VARCHAR' AND regexp_matches({held}, '^\s*[\[{{]') AND json_valid({held}) THEN CAST({held} AS JSON) ELSE {j} END)"


def _entries(j: str) -> str:
    return f"(CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN [] WHEN json_type({j}) = 'ARRAY' THEN CAST({j} AS JSON[]) ELSE [{j}] END)"


def _placed(items: str, parent: str = "-1") -> str:
    """Entries with their places; nulls fall out later."""
    return f"unnest(list_transform({items}, lambda x, i: {{'node': x, 'pos': i - 1, 'parent_pos': {parent}}}))"


_LISTS = f"""
WITH valid AS (SELECT line_no, ingested_at, CAST(raw AS JSON) AS j FROM record_lines WHERE json_valid(raw)),
rec AS (
  SELECT j ->> '$.instance_id' AS instance_id, j FROM valid WHERE json_type(j) = 'OBJECT' AND j ->> '$.instance_id' IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY j ->> '$.instance_id' ORDER BY ingested_at DESC NULLS LAST, line_no DESC) = 1
),
meta AS (SELECT instance_id, j, {_opened("(j -> '$.metadata')")} AS m FROM rec),
info AS (SELECT instance_id, j, m, {_opened("(m -> '$.speaker_info')")} AS s FROM meta),
nodes AS (
  SELECT instance_id, j -> '$.labels' AS labels, {", ".join(f"{_opened(f'(m -> {chr(39)}$.{k}{chr(39)})')} AS {k}" for k in ("words_align", "primary_stress", "filled_pauses"))},
    {_opened("(s -> '$.Memberships')")} AS memberships FROM info
),
lists AS (
  SELECT instance_id, labels, {", ".join(f"list_transform({_entries(k)}, lambda y: {_opened('y')}) AS {k}" for k in ("words_align", "primary_stress", "filled_pauses", "memberships"))} FROM nodes
),
direct AS (
  SELECT instance_id, 'words_align' AS child, {_placed("words_align")} AS r FROM lists
  UNION ALL SELECT instance_id, 'filled_pauses', {_placed("filled_pauses")} FROM lists
  UNION ALL SELECT instance_id, 'memberships', {_placed("memberships")} FROM lists
),
flat AS (SELECT instance_id, child, CAST(r.pos AS INT) AS pos, -1 AS parent_pos, r.node AS node FROM direct WHERE r.node IS NOT NULL AND json_type(r.node) <> 'NULL'),
stress AS (SELECT instance_id, {_placed("primary_stress")} AS r FROM lists),
marks AS (
  SELECT instance_id, 'primary_stress' AS child, CAST(r.pos AS INT) AS pos, try_cast(r.node ->> '$.words_align_idx' AS DOUBLE) AS word_at, r.node AS node
  FROM stress WHERE r.node IS NOT NULL AND json_type(r.node) <> 'NULL'
),
placed AS (
  SELECT m.instance_id, m.child, m.pos, coalesce(w.pos, -1) AS parent_pos, m.node
  FROM marks m LEFT JOIN flat w ON w.instance_id = m.instance_id AND w.child = 'words_align' AND w.pos = m.word_at
),
role_lists AS (SELECT instance_id, pos AS parent_pos, list_transform({_entries(_opened("(node -> '$.Roles')"))}, lambda y: {_opened("y")}) AS items FROM flat WHERE child = 'memberships'),
role_rows AS (SELECT instance_id, {_placed("items", "parent_pos")} AS r FROM role_lists),
label_keys AS (SELECT instance_id, labels, unnest(json_keys(labels)) AS k FROM lists WHERE json_type(labels) = 'OBJECT'),
label_rows AS (SELECT instance_id, 'labels.' || k AS child, {_placed(_entries("json_extract(labels, '$.\"' || k || '\"')"))} AS r FROM label_keys),
every AS (
  SELECT instance_id, child, parent_pos, pos, node FROM flat UNION ALL SELECT instance_id, child, parent_pos, pos, node FROM placed
  UNION ALL SELECT instance_id, 'roles', CAST(r.parent_pos AS INT), CAST(r.pos AS INT), r.node FROM role_rows WHERE r.node IS NOT NULL AND json_type(r.node) <> 'NULL'
  UNION ALL SELECT instance_id, child, -1, CAST(r.pos AS INT), r.node FROM label_rows WHERE r.node IS NOT NULL AND json_type(r.node) <> 'NULL'
)
"""


def _cell(key: str, kind: str) -> str:
    if kind == "array<double>":
        node = f"(node -> '$.{key}')"
        return f"CASE WHEN json_type({node}) <> 'NULL' THEN list_transform({_entries(_opened(node))}, lambda x: try_cast(x ->> '$' AS DOUBLE)) END"
    text = f"(node ->> '$.{key}')" if key else "(node ->> '$')"
    return text if kind == "string" else f"try_cast({text} AS {kind})"


def _child_sql(kind: str) -> str:
    own = "starts_with(child, 'labels.')" if kind == "labels" else f"child = '{kind}'"
    return f"{_LISTS} SELECT instance_id, child, parent_pos, pos, {', '.join(f'{_cell(*c)} AS {n}' for n, c in nested.COLUMNS[kind].items())} FROM every WHERE {own}"


_RECORD_COLUMNS = {
    **{k: ("j", k) for k in ("dataset", "file_id", "speaker", "split", "text")}, "source_audio": ("m", "source_audio"), "lang": ("m", "lang"),
    **{k.lower(): ("s", k) for k in ("Speaker_ID", "Speaker_name", "Speaker_gender", "Speaker_birth", "Date")}, "speaker_lang": ("s", "Lang"),
}

ORACLE = {
    "p7_found": _P7,
    "p3_found": _LISTS + "SELECT instance_id, child, parent_pos, pos FROM every",
    "p3_records": _LISTS + f"SELECT instance_id, try_cast(m ->> '$.audio_length' AS DOUBLE) AS audio_length, {', '.join(f'{n} ->> {chr(39)}$.{k}{chr(39)} AS {c}' for c, (n, k) in _RECORD_COLUMNS.items())} FROM info",
    **{f"p3_{k}": _child_sql(k) for k in nested.COLUMNS},
}
