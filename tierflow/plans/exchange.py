"""Queries of sources and sinks (what is written is read back), look-up chains, exports and records of segments."""

from __future__ import annotations

from pyspark.sql import functions as F


from tierflow.common import scratch, table
from tierflow.functions import ids, values
from tierflow.operators import clean, joins, metrics, nested, reshape, segments, splits
from tierflow.plans.corpus import CUR, cur
from tierflow.plans.timelines import _TIERS, tiers
from tierflow.plans.training import _LISTS, _entries, _opened
from tierflow.schema import OPTIONAL, REQUIRED
from tierflow.sources import records, textgrid

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_ROWS = "SELECT instance_id, split, text, metadata.audio_length AS audio_length, metadata.filled_pauses AS filled_pauses FROM cur"


def _rows(spark, d):
    u = cur(spark, d, "split", "text", "metadata.audio_length", "metadata.filled_pauses")
    return u.select("instance_id", "split", "text", "metadata.audio_length", "metadata.filled_pauses")


@query(f"WITH {CUR} {_ROWS}")
def sink_jsonl(spark, d):
    """Records written as JSON lines and read back, nulls and empty lists kept apart."""
    rows, path = _rows(spark, d), scratch(spark)
    records.write_jsonl(rows, path)
    return records.read_jsonl(spark, path, rows.schema)


@query(f"WITH {CUR} {_ROWS} WHERE split = 'dev'")
def sink_by_split(spark, d):
    """Records in a folder for each split, of which one is read."""
    path = scratch(spark)
    records.write_by(_rows(spark, d), path, "split")
    return records.read_parquet(spark, path, ["instance_id", "split", "text", "audio_length", "filled_pauses"]).where("split = 'dev'")


@query("SELECT DISTINCT file_id, split FROM frame_records WHERE split IN ('train', 'dev', 'test')")
def sink_lookup(spark, d):
    """A look-up of splits as delimited text with header."""
    path = scratch(spark)
    f = table(spark, d, "frame_records").where(F.col("split").isin("train", "dev", "test")).select("file_id", "split").distinct()
    records.write_table(f, path, sep=",")
    return records.read_lookup(spark, path, "file_id")


@query("SELECT count(*) AS lines, count(*) FILTER (trim(coalesce(raw, '')) = '') AS blank, count(*) FILTER (trim(coalesce(raw, '')) <> '' AND NOT (json_valid(raw) AND coalesce(json_type(CASE WHEN json_valid(raw) THEN raw END) = 'OBJECT', false))) AS broken FROM record_lines")
def scan_lines(spark, d):
    """Lines of the corpus, blank and broken ones, written as text and read back."""
    path = scratch(spark)
    table(spark, d, "record_lines").select(F.coalesce("raw", F.lit("")).alias("value")).write.text(path)
    return records.read_with_broken(spark.read.text(path), "value")


@query("SELECT j ->> '$.instance_id' AS instance_id, count(*) AS n FROM (SELECT CAST(raw AS JSON) AS j FROM record_lines WHERE json_valid(raw)) WHERE json_type(j) = 'OBJECT' GROUP BY 1")
def scan_raw(spark, d):
    """The JSON source as VARIANT: lines of each record."""
    path = scratch(spark)
    table(spark, d, "record_lines").where(F.try_parse_json("raw").isNotNull()).select(F.col("raw").alias("value")).write.text(path)
    v = records.read_raw(spark, path).where(F.schema_of_variant("v").startswith("OBJECT"))
    return v.groupBy(F.try_variant_get("v", "$.instance_id", "string").alias("instance_id")).agg(F.count(F.lit(1)).alias("n"))


def _textgrids(spark, d, short):
    key = ["file_id", "tier"]
    rows = tiers(spark, d).select(*key, "start_ms", "end_ms", F.coalesce("label", F.lit("")).alias("label")).distinct()
    place = F.array_position(F.array(*[F.lit(x) for x in _ORDER]), F.col("tier"))
    second = lambda c: F.col(c) / F.lit(1000.0)
    long = rows.select(F.col("file_id").alias("base"), "tier", place.alias("place"), F.col("start_ms").alias("idx"), second("start_ms").alias("start_t"), second("end_ms").alias("end_t"), "label")
    files = textgrid.to_textgrid(long, short=short).select(F.col("base").alias("path"), F.encode("content", "UTF-8").alias("content"))
    whole = lambda c: F.rint(F.col(c) * 1000).cast("bigint")
    return textgrid.parsed(files).select(F.col("path").alias("file_id"), "tier", whole("start_t").alias("start_ms"), whole("end_t").alias("end_ms"), "label")


_ORDER = ["norm", "dialogueActsIsoDimension", "vocalDisfluency", "sentimentCurated", "instructions", "FilledPauses"]
_GRID = f"WITH {_TIERS} SELECT DISTINCT file_id, tier, s AS start_ms, e AS end_ms, coalesce(label, '') AS label FROM tiers WHERE file_id IS NOT NULL"


@query(_GRID)
def sink_textgrid(spark, d):
    """Tiers written in the long TextGrid form and parsed again."""
    return _textgrids(spark, d, False)


@query(_GRID)
def sink_textgrid_short(spark, d):
    """Tiers written in the short TextGrid form and parsed again."""
    return _textgrids(spark, d, True)


@query(f"""WITH {_TIERS}, n AS (SELECT * FROM tiers WHERE tier = 'norm'),
act AS (SELECT * FROM tiers WHERE tier = 'dialogueActsIsoDimension' QUALIFY row_number() OVER (PARTITION BY file_id, speaker, s, e ORDER BY idx DESC, label DESC NULLS LAST) = 1),
cur_ AS (SELECT n.file_id, n.speaker, n.idx, n.s, n.e, o.label FROM n JOIN tiers o ON o.tier = 'sentimentCurated' AND o.file_id = n.file_id AND o.s - 1 <= n.s AND n.e <= o.e + 1
  QUALIFY row_number() OVER (PARTITION BY n.file_id, n.speaker, n.idx, n.s, n.e ORDER BY o.idx, o.s, o.e, o.label NULLS FIRST) = 1),
dis AS (SELECT n.file_id, n.speaker, n.idx, n.s, n.e, count(*) AS k FROM n JOIN tiers o ON o.tier = 'vocalDisfluency' AND o.file_id = n.file_id AND o.speaker = n.speaker AND o.e + 1 >= n.s AND o.s - 1 <= n.e GROUP BY ALL)
SELECT n.file_id, n.speaker, n.s / 1000.0::DOUBLE AS start_t, n.e / 1000.0::DOUBLE AS end_t, coalesce(nullif(n.label, ''), '') AS text, nullif(c.label, '') AS sentiment, nullif(act.label, '') AS act,
CAST(coalesce(dis.k, 0) AS INT) AS disfluencies FROM n LEFT JOIN act ON act.file_id = n.file_id AND act.s = n.s AND act.e = n.e AND act.speaker IS NOT DISTINCT FROM n.speaker
LEFT JOIN cur_ c ON c.file_id = n.file_id AND c.idx = n.idx AND c.s = n.s AND c.e = n.e AND c.speaker = n.speaker
LEFT JOIN dis ON dis.file_id = n.file_id AND dis.idx = n.idx AND dis.s = n.s AND dis.e = n.e AND dis.speaker = n.speaker
WHERE length(coalesce(n.label, '')) >= 3""")
def segment_records(spark, d):
    """Canonical records of a recording's segments with what the other tiers say of them."""
    out = segments.segment_records(segments.annotated_segments(tiers(spark, d)), "ROG", "data/audio", least_chars=3)
    return out.select(
        "file_id", "speaker", "start_t", "end_t", "text", "labels.sentiment", F.col("labels.dialogue_act_dimension").alias("act"), F.col("labels.disfluency_count").alias("disfluencies")
    )


@query(f"""WITH {CUR}, i AS (SELECT DISTINCT file_id, audio_path AS path, regexp_replace(regexp_extract(audio_path, '[^/]*$'), '(.)\\.[^.]*$', '\\1') AS stem, regexp_extract(audio_path, '[^/]*$') AS base FROM frame_records),
s AS (SELECT stem, min(path) AS path FROM i GROUP BY 1), b AS (SELECT base, min(path) AS path FROM i GROUP BY 1), f AS (SELECT file_id, min(path) AS path FROM i GROUP BY 1)
SELECT instance_id, coalesce(s.path, b.path, f.path) AS path, CASE WHEN s.path IS NOT NULL THEN 'stem' WHEN b.path IS NOT NULL THEN 'base' WHEN f.path IS NOT NULL THEN 'file_id' END AS found_by
FROM cur LEFT JOIN s ON s.stem = cur.instance_id LEFT JOIN b ON b.base = regexp_extract(cur.audio_path, '[^/]*$') LEFT JOIN f ON f.file_id = cur.file_id""")
def resolve_chain(spark, d):
    """A source for each record: by its id as stem, by base name, by recording."""
    index = table(spark, d, "frame_records").select("file_id", F.col("audio_path").alias("path")).distinct()
    index = index.withColumn("stem", ids.stem("path")).withColumn("base", ids.basename("path"))
    u = cur(spark, d, "file_id", "audio_path")
    tries = [(F.col("instance_id"), "stem"), (ids.basename("audio_path"), "base"), (F.col("file_id"), "file_id")]
    return joins.resolve_chain(u.select("instance_id", "file_id", "audio_path"), index, tries, ["path"]).select("instance_id", "path", "found_by")


@query(f"""WITH {CUR}, p AS (SELECT DISTINCT audio_path AS path FROM frame_records) SELECT instance_id, CASE WHEN audio_path IN (SELECT path FROM p) THEN audio_path
WHEN 'data/' || audio_path IN (SELECT path FROM p) THEN 'data/' || audio_path END AS path FROM cur""")
def existing_source(spark, d):
    """The first candidate path that is there."""
    u = cur(spark, d, "audio_path")
    files = table(spark, d, "frame_records").select(F.col("audio_path").alias("path"))
    tries = F.array("audio_path", F.concat(F.lit("data/"), "audio_path"))
    return joins.first_existing(u, tries, files, ["instance_id"]).select("instance_id", "path")


@query(f"WITH {CUR} SELECT DISTINCT speaker FROM cur WHERE speaker IS NOT NULL AND speaker NOT IN (SELECT speaker_id FROM speakers WHERE speaker_id IS NOT NULL)")
def unknown_speakers(spark, d):
    """Speakers that the register lacks."""
    register = table(spark, d, "speakers").select(F.col("speaker_id").alias("speaker"))
    return joins.not_in(cur(spark, d, "speaker"), register, "speaker")


@query(f"""WITH {CUR}, p AS (SELECT DISTINCT speaker, split FROM cur WHERE speaker IS NOT NULL AND split IN ('train','dev','test')), k AS (SELECT split, count(*) AS k FROM p GROUP BY 1),
s AS (SELECT a.split AS group_a, b.split AS group_b, count(*) AS n FROM p a JOIN p b ON a.speaker = b.speaker AND a.split < b.split GROUP BY ALL)
SELECT group_a, group_b, n, x.k + y.k - n AS n_either, round(n / (x.k + y.k - n), 6) AS share FROM s JOIN k x ON x.split = group_a JOIN k y ON y.split = group_b""")
def speakers_either(spark, d):
    """Speakers of two splits together and the share of those in both."""
    u = cur(spark, d, "speaker", "split").where(F.col("split").isin("train", "dev", "test"))
    return joins.shared_and_all(u, "speaker", "split").withColumn("share", F.round("share", 6))


@query(f"""WITH {CUR} SELECT instance_id, coalesce(labels.sentiment_logit, CASE labels.sentiment_6 WHEN 'Negative' THEN 1.0 WHEN 'Positive' THEN 4.0 END)::DOUBLE AS sentiment_f FROM cur WHERE split IN ('train', 'dev')""")
def regression_label(spark, d):
    """One number of a numeric label, else of the class's place on a scale, for the final fit."""
    u = splits.for_training(cur(spark, d, "split", "labels.sentiment_logit", "labels.sentiment_6"))
    return u.select("instance_id", values.regression_label("labels.sentiment_logit", "labels.sentiment_6", {"Negative": 1.0, "Positive": 4.0}).alias("sentiment_f"))


@query(f"""WITH {CUR} SELECT instance_id, file_id, start_t, end_t, round(0.5 * labels.sentiment_logit + 2, 6) AS gold_label, round(0.5 * labels.speaker_age + 2, 6) AS pred_label,
labels.sentiment_logit AS gold_raw, labels.speaker_age::DOUBLE AS pred_raw FROM cur WHERE labels.sentiment_logit IS NOT NULL""")
def prediction_export(spark, d):
    """What is exported of predictions: labels in their own unit beside the raw values."""
    u = cur(spark, d, "file_id", "start_t", "end_t", "labels.sentiment_logit", "labels.speaker_age").where("labels.sentiment_logit is not null")
    u = u.withColumn("gold", F.col("labels.sentiment_logit")).withColumn("pred", F.col("labels.speaker_age").cast("double"))
    return metrics.predictions(u, "gold", "pred", scale=(2.0, 0.5)).withColumns({c: F.round(c, 6) for c in ("gold_label", "pred_label")})


@query("WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INT)) AS b FROM embeddings) SELECT vec_id AS instance_id, 32 AS n_frames, b[1:32] AS gold, b[33:64] AS pred FROM b")
def frame_export(spark, d):
    """Exported frames of gold and prediction."""
    b = F.transform("embedding", lambda x: (x > 0).cast("int"))
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("instance_id"), F.lit(None).cast("string").alias("file_id"), F.slice(b, 1, 32).alias("g"), F.slice(b, 33, 32).alias("p"))
    return metrics.frame_predictions(e, "g", "p").select("instance_id", "n_frames", "gold", "pred")


@query(_LISTS.rstrip() + f", kinds AS (SELECT instance_id, labels FROM lists WHERE json_type(labels) = 'OBJECT') SELECT instance_id, list_bool_or(list_transform(json_keys(labels), lambda k: json_type(json_extract(labels, '$.\"' || k || '\"')) = 'ARRAY')) AS has_lists FROM kinds WHERE len(json_keys(labels)) > 0")
def frame_or_instance(spark, d):
    """Whether a raw record has labels per frame."""
    labels = nested.field(F.col("v"), "labels")
    r = nested.records(table(spark, d, "record_lines")).select("instance_id", labels.alias("l")).where(F.size(F.map_keys(F.try_variant_get("l", "$", "map<string,variant>"))) > 0)
    return r.select("instance_id", clean.is_frame_record(F.col("l")).alias("has_lists"))


@query("SELECT instance_id, metadata.audio_length AS seconds FROM (SELECT DISTINCT * FROM frame_records) WHERE abs(metadata.audio_length - (end_t - start_t)) > 0.05")
def span_off(spark, d):
    """Frame records whose length isn't what their bounds say."""
    f = table(spark, d, "frame_records").distinct()
    return f.where(clean.span_off(F.col("metadata.audio_length"), F.col("start_t"), F.col("end_t"))).select("instance_id", F.col("metadata.audio_length").alias("seconds"))


_RAW = f"list_transform({_entries(_opened(chr(40) + 'node -> ' + chr(39) + '$.raw' + chr(39) + chr(41)))}, lambda x: try_cast(x ->> '$' AS DOUBLE))"


@query(_LISTS.rstrip() + f""", utt AS (SELECT instance_id, j ->> '$.text' AS utt FROM rec),
w AS (SELECT instance_id, pos, try_cast(node ->> '$.time_s' AS DOUBLE) AS a, try_cast(node ->> '$.time_e' AS DOUBLE) AS z, try_cast(node ->> '$.char_s' AS INT) AS c, try_cast(node ->> '$.char_e' AS INT) AS d, nullif(node ->> '$.text', '') AS own
  FROM flat WHERE child = 'words_align'),
mk AS (SELECT instance_id, word_at, {_RAW} AS raw FROM marks), g AS (SELECT instance_id, word_at, list({{'a': raw[1], 'z': raw[2]}}) AS m FROM mk WHERE len(raw) = 2 GROUP BY instance_id, word_at),
j AS (SELECT w.*, utt, coalesce(m, []) AS m FROM w JOIN utt USING (instance_id) LEFT JOIN g ON g.instance_id = w.instance_id AND g.word_at = w.pos)
SELECT instance_id || '#w' || pos AS instance_id, coalesce(own, substr(utt, c + 1, greatest(d - c, 0))) AS text, pos AS word_idx, round_even(round((z - a) * 1000, 6), 0) / 1000 AS audio_length, CAST(len(m) AS INT) AS n_stress_marks,
len(m) > 1 AS multistress, list_transform(range(CAST(round_even((z - a) * 50, 0) AS BIGINT)), lambda t: CAST(len(list_filter(m, lambda p: t >= round_even((p.a - a) * 50, 0) AND t < round_even((p.z - a) * 50, 0))) > 0 AS INT)) AS primary_stress
FROM j WHERE round_even((z - a) * 50, 0) > 0""")
def word_frames(spark, d):
    """Words of raw records with their stress frames."""
    r = nested.words_and_marks(nested.records(table(spark, d, "record_lines")))
    return reshape.word_rows(r, F.col("words"), F.col("marks"), 50)


def _kind_sql(key: str, kind: str, text: str) -> str:
    kinds = {"string": "'VARCHAR'", "object": "'OBJECT'", "number": "'BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN'", "integer": "'BIGINT', 'UBIGINT', 'BOOLEAN'"}[kind]
    return f"CASE WHEN json_type(j -> '$.{key}') NOT IN ({kinds}) THEN {_quoted(text)} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CHECKS = [
    *[f"CASE WHEN (j -> '$.{k}') IS NULL THEN {_quoted(clean.MISSING_KEY.format(k))} END" for k in REQUIRED],
    *[_kind_sql(k, kind, clean.WRONG_TYPE.format(k)) for k, kind in REQUIRED.items()],
    *[_kind_sql(k, kind, clean.WRONG_OPTIONAL.format(k)) for k, kind in OPTIONAL.items()],
    f"CASE WHEN NOT coalesce(j ->> '$.split' IN ('train', 'dev', 'test'), false) THEN '{clean.BAD_SPLIT}' END",
    f"CASE WHEN try_cast(j ->> '$.end_t' AS DOUBLE) < try_cast(j ->> '$.start_t' AS DOUBLE) THEN '{clean.BAD_ORDER}' END",
    f"""CASE WHEN (j -> '$.frame_rate_hz') IS NOT NULL AND NOT coalesce(json_type(j -> '$.labels') = 'OBJECT' AND list_bool_or(list_transform(json_keys(j -> '$.labels'), lambda k: json_type(json_extract(j -> '$.labels', '$."' || k || '"')) = 'ARRAY')), false)
  THEN '{clean.NO_SEQUENCE}' END""",
]


@query(f"""WITH l AS (SELECT CAST(raw AS JSON) AS j FROM record_lines WHERE json_valid(raw)), e AS (SELECT unnest([{', '.join(_CHECKS)}]) AS error FROM l)
SELECT error, count(*) AS n FROM e WHERE error IS NOT NULL GROUP BY error""")
def validate_lines(spark, d):
    """Errors of raw lines, absent keys told from null ones."""
    v = F.try_parse_json("raw")
    lines = table(spark, d, "record_lines").select("line_no", v.alias("v")).where("v is not null")
    return lines.select("line_no", F.explode(clean.errors_of_variant(F.col("v"))).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))
