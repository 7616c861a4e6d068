"""Queries of the corpus operators: cleaning, splits, sampling, profiles, labels.

Each entry is a query and, beside it, the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.common import current, table
from tierflow.functions import ids, values
from tierflow.operators import clean, joins, labels, profile, splits

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


CUR = """cur AS (
  SELECT * FROM utterances WHERE instance_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY instance_id ORDER BY ingested_at DESC NULLS LAST) = 1
)"""


def hash_sql(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967295.0::DOUBLE)"


def split_sql(key: str) -> str:
    h = hash_sql(key)
    return f"CASE WHEN {h} < 0.8::DOUBLE THEN 'train' WHEN {h} < 0.8::DOUBLE + 0.1::DOUBLE THEN 'dev' ELSE 'test' END"


def group_key(group: str, item: str) -> str:
    return f"'speech-ml-pipeline::' || coalesce(nullif(CAST({group} AS VARCHAR), ''), CAST({item} AS VARCHAR), '')"


def cur(spark: SparkSession, d: str, *paths: str) -> DataFrame:
    """Current utterances: instance_id, ingested_at and the named columns, nothing else is read."""
    return current(table(spark, d, "utterances"), payload=paths)


# --- splits -------------------------------------------------------------------


@query(f"SELECT split, lang, count(*) AS n FROM (SELECT lang, {split_sql(group_key('source', 'doc_id'))} AS split FROM documents) GROUP BY ALL")
def split_hash_group(spark, d):
    """Documents by the hash of their source, counted by split and language."""
    docs = splits.assign_splits(table(spark, d, "documents").select("doc_id", "source", "lang"), "source", "doc_id")
    return docs.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT instance_id, {split_sql(group_key('file_id', 'instance_id'))} AS new_split FROM (SELECT DISTINCT instance_id, file_id FROM utterances)")
def split_by_recording(spark, d):
    """Every utterance by the hash of its recording."""
    u = table(spark, d, "utterances").select("instance_id", "file_id").distinct()
    return splits.assign_splits(u, "file_id").select("instance_id", F.col("split").alias("new_split"))


@query(f"""SELECT event_id, {split_sql("'speech-ml-pipeline::' || CAST(event_id AS VARCHAR)")} AS split FROM events""")
def split_by_id(spark, d):
    """Events without a group fall back to their id."""
    e = table(spark, d, "events").select("event_id", F.lit(None).cast("string").alias("grp"))
    return splits.assign_splits(e, "grp", "event_id").select("event_id", "split")


@query(
    f"""WITH {CUR}, s AS (SELECT CASE WHEN split IN ('train','dev','test') THEN split ELSE {split_sql(group_key('file_id', 'instance_id'))} END AS split FROM cur)
SELECT v.split, CAST(count(s.split) AS BIGINT) AS n FROM (VALUES ('train'), ('dev'), ('test'), ('other')) v(split) LEFT JOIN s ON s.split = v.split GROUP BY v.split"""
)
def split_summary_kept(spark, d):
    """Valid splits stay, others are assigned by recording; counts with zeros."""
    return splits.split_summary(splits.assign_splits(cur(spark, d, "split", "file_id"), "file_id"))


@query(f"WITH {CUR} SELECT speaker, count(DISTINCT split) AS n_splits FROM cur WHERE speaker IS NOT NULL GROUP BY speaker HAVING count(DISTINCT split) > 1")
def split_leaks(spark, d):
    """Speakers in more than one split."""
    return splits.leaks(cur(spark, d, "speaker", "split"), "speaker")


@query(
    f"""WITH {CUR},
by_file AS (SELECT file_id, min(split) AS s FROM frame_records WHERE split IN ('train','dev','test') GROUP BY file_id),
by_stem AS (SELECT instance_id AS wav_stem, min(split) AS s FROM frame_records WHERE split IN ('train','dev','test') GROUP BY 1)
SELECT instance_id, coalesce(f.s, w.s, {split_sql(group_key('cur.file_id', 'instance_id'))}) AS split
FROM cur LEFT JOIN by_file f ON f.file_id = cur.file_id LEFT JOIN by_stem w ON w.wav_stem = regexp_replace(regexp_extract(audio_path, '[^/]*$'), '(.)\\.[^.]*$', '\\1')"""
)
def split_override(spark, d):
    """Splits of a look-up by file, else by audio stem, else by hash."""
    f = table(spark, d, "frame_records").where(F.col("split").isin("train", "dev", "test"))
    u = cur(spark, d, "file_id", "audio_path")
    by_stem = f.select(F.col("instance_id").alias("wav_stem"), "split")
    fallback = splits.hash_split(F.col("file_id"), F.col("instance_id"))
    return splits.override_split(u, f.select("file_id", "split"), by_stem, ids.stem("audio_path"), fallback).select("instance_id", "split")


_NEXT = """CASE WHEN a / qa <= b / qb AND a / qa <= c / qc THEN 'train' WHEN b / qb <= c / qc THEN 'dev' ELSE 'test' END"""


@query(f"""WITH RECURSIVE {CUR}, s AS (SELECT speaker, count(*) AS n FROM cur WHERE speaker IS NOT NULL GROUP BY speaker), t AS (SELECT sum(n) AS total FROM s),
q AS (SELECT greatest(1, round_even(0.8::DOUBLE * total, 0)) AS qa, greatest(1, round_even(0.1::DOUBLE * total, 0)) AS qb, greatest(1, total - round_even(0.8::DOUBLE * total, 0) - round_even(0.1::DOUBLE * total, 0)) AS qc FROM t),
o AS (SELECT speaker, n, row_number() OVER (ORDER BY md5('speech-ml-pipeline::' || speaker), speaker) AS i FROM s),
r(i, a, b, c, speaker, n, split) AS (SELECT 0::BIGINT, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, NULL::VARCHAR, 0::BIGINT, NULL::VARCHAR UNION ALL
SELECT i, a + CASE WHEN split = 'train' THEN n ELSE 0 END, b + CASE WHEN split = 'dev' THEN n ELSE 0 END, c + CASE WHEN split = 'test' THEN n ELSE 0 END, speaker, n, split
FROM (SELECT o.i, r.a, r.b, r.c, o.speaker, o.n, {_NEXT} AS split FROM r JOIN o ON o.i = r.i + 1, q))
SELECT speaker, n, split FROM r WHERE speaker IS NOT NULL""")
def split_speaker_disjoint(spark, d):
    """Shuffled speakers to the least filled split, one by one."""
    return splits.speaker_disjoint(cur(spark, d, "speaker").where("speaker is not null"))


# --- sampling -----------------------------------------------------------------


@query(
    f"""WITH {CUR}, t AS (SELECT instance_id, labels.sentiment_6 AS c FROM cur WHERE labels.sentiment_6 IS NOT NULL),
n AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM t GROUP BY c))
SELECT c AS label, count(*) AS n FROM (SELECT c, row_number() OVER (PARTITION BY c ORDER BY md5('speech-ml-pipeline::' || instance_id)) AS r FROM t), n
WHERE r <= n.n GROUP BY c"""
)
def balance_classes(spark, d):
    """As many rows of each class as the smallest has."""
    u = cur(spark, d, "labels.sentiment_6").select("instance_id", F.col("labels.sentiment_6").alias("label")).where("label is not null")
    return splits.balance_classes(u, F.col("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {CUR}, t AS (SELECT instance_id, labels.sentiment_6 AS c FROM cur WHERE labels.sentiment_6 IS NOT NULL),
n AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM t GROUP BY c))
SELECT instance_id FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY substr(md5('speech-ml-pipeline::' || instance_id), 1, 15)) AS r FROM t), n WHERE r <= n.n"""
)
def balance_members(spark, d):
    """Which rows the class balance draws."""
    u = cur(spark, d, "labels.sentiment_6").select("instance_id", F.col("labels.sentiment_6").alias("label"))
    return splits.balance_classes(u, F.col("label")).select("instance_id")


def _drawn(by: str) -> str:
    return f"row_number() OVER (PARTITION BY {by} ORDER BY substr(md5('speech-ml-pipeline::' || instance_id), 1, 15), instance_id)"


@query(f"WITH {CUR}, r AS (SELECT instance_id, split, {_drawn('split')} AS r, count(*) OVER (PARTITION BY split) AS n FROM cur) SELECT instance_id, split FROM r WHERE r <= greatest(1, round_even(n * 0.37::DOUBLE, 0))")
def cap_fraction(spark, d):
    """Of each split a fraction of its rows."""
    return splits.cap_fraction(cur(spark, d, "split").select("instance_id", "split"), 0.37)


@query(f"WITH {CUR}, r AS (SELECT instance_id, dataset, {_drawn('dataset')} AS r FROM cur) SELECT instance_id, dataset FROM r ORDER BY r, dataset NULLS FIRST LIMIT 700")
def cap_balanced(spark, d):
    """700 rows, the data sets in turn."""
    return splits.cap_balanced(cur(spark, d, "dataset").select("instance_id", "dataset"), 700, "dataset")


@query(f"WITH {CUR} SELECT instance_id FROM cur ORDER BY md5('speech-ml-pipeline::' || instance_id) LIMIT 500")
def cap_plain(spark, d):
    """500 rows in drawn order."""
    return splits.cap_plain(cur(spark, d), 500).select("instance_id")


@query(f"WITH {CUR}, r AS (SELECT instance_id, split, {_drawn('split')} AS r FROM cur WHERE split IN ('train','dev','test')) SELECT instance_id, split FROM r WHERE r <= CASE split WHEN 'train' THEN 400 WHEN 'dev' THEN 90 ELSE 80 END")
def cap_per_split(spark, d):
    """At most so many rows of each split."""
    return splits.cap_per_split(cur(spark, d, "split").select("instance_id", "split"), {"train": 400, "dev": 90, "test": 80})


_QUOTA = f"""WITH {CUR},
p AS (SELECT instance_id, speaker, labels.speaker_gender AS gender FROM cur WHERE labels.speaker_gender IN ('F','M') AND labels.filled_pause_count >= 1 AND speaker IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY gender, speaker ORDER BY md5('speech-ml-pipeline::' || instance_id), instance_id) AS turn FROM p),
g AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY turn, md5('speech-ml-pipeline::' || speaker), speaker) AS place FROM t),
sel AS (SELECT * FROM g WHERE place <= 120)"""


def _quota(spark, d):
    u = cur(spark, d, "speaker", "labels.speaker_gender", "labels.filled_pause_count").select("instance_id", "speaker", F.col("labels.speaker_gender").alias("gender"), F.col("labels.filled_pause_count").alias("n"))
    pool = u.where("n >= 1 and speaker is not null and gender in ('F', 'M')").drop("n")
    return pool, splits.select_quota(pool, "gender", "speaker", {"F": 120, "M": 120})


@query(_QUOTA + " SELECT instance_id, gender, CAST(turn AS INT) AS turn, CAST(place AS INT) AS place FROM sel")
def quota_wide_before_deep(spark, d):
    """Speakers in turn until each gender's quota is met."""
    return _quota(spark, d)[1].select("instance_id", "gender", "turn", "place")


@query(
    _QUOTA
    + """, per AS (SELECT gender, speaker, count(*) AS n FROM sel GROUP BY ALL)
SELECT e.gender, e.n AS speakers_eligible, u.*EXCLUDE(gender), u.selected >= 120 AS quota_met
FROM (SELECT gender, count(DISTINCT speaker) AS n FROM p GROUP BY gender) e JOIN
(SELECT gender, count(*) AS speakers_used, CAST(sum(n) AS BIGINT) AS selected, max(n) AS most, median(n) AS median, count(*) FILTER (n > 2) AS over_ideal FROM per GROUP BY gender) u USING (gender)"""
)
def quota_report(spark, d):
    """How the quota selection went."""
    pool, selected = _quota(spark, d)
    return splits.quota_report(pool, selected, "gender", "speaker", {"F": 120, "M": 120}, 2)


@query(
    _QUOTA
    + """ SELECT instance_id, CAST(i AS INT) AS "index", 'batch_' || lpad(CAST(i // 50 AS VARCHAR), 2, '0') AS folder, lpad(CAST(i AS VARCHAR), 4, '0') AS number
FROM (SELECT instance_id, row_number() OVER (ORDER BY place, gender) - 1 AS i FROM sel)"""
)
def quota_folders(spark, d):
    """The selection with genders in turn, numbered and put into folders."""
    return splits.interleave(_quota(spark, d)[1], "gender").select("instance_id", "index", "folder", "number")


# --- validation and cleaning ----------------------------------------------------


@query(
    """SELECT count(*) AS n_total, count(*) FILTER (coalesce(split IN ('train','dev','test'), false) AND instance_id IS NOT NULL AND dataset IS NOT NULL
  AND audio_path IS NOT NULL AND labels IS NOT NULL AND metadata IS NOT NULL AND coalesce(end_t >= start_t, true)) AS n_valid FROM utterances"""
)
def validate_table(spark, d):
    """Rows and valid rows."""
    return clean.validation_summary(table(spark, d, "utterances"))


@query("""SELECT * FROM (SELECT instance_id, instance_id || ': split must be one of train, dev, test, got ' || coalesce(split, 'NULL') AS error
FROM utterances WHERE NOT coalesce(split IN ('train','dev','test'), false)
UNION ALL SELECT instance_id, instance_id || ': missing required key ''split''' FROM utterances WHERE split IS NULL) ORDER BY instance_id, error LIMIT 20""")
def validate_errors(spark, d):
    """The first errors."""
    return clean.report_errors(table(spark, d, "utterances"), 20)


@query(
    """WITH v AS (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY ingested_at, md5(CAST(split AS VARCHAR))) AS r
  FROM utterances WHERE coalesce(split IN ('train','dev','test'), false)), u AS (SELECT * FROM v WHERE r = 1)
SELECT 'input' AS step, count(*) AS n FROM utterances UNION ALL SELECT 'valid', count(*) FROM v UNION ALL SELECT 'unique', count(*) FROM u
UNION ALL SELECT 'kept', count(*) FROM u WHERE trim(labels.sentiment_6) <> '' AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''"""
)
def clean_pipeline(spark, d):
    """Rows left by each step of cleaning."""
    u = table(spark, d, "utterances").withColumn("_tie", F.md5("split"))
    return clean.clean(u, ["ingested_at", "_tie"], F.col("labels.sentiment_6"), True)[1]


@query(
    """WITH u AS (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY ingested_at, md5(CAST(split AS VARCHAR))) AS r
  FROM utterances WHERE coalesce(split IN ('train','dev','test'), false))
SELECT instance_id, split FROM u WHERE r = 1 AND trim(labels.sentiment_6) <> '' AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''"""
)
def clean_kept(spark, d):
    """The records that cleaning leaves."""
    u = table(spark, d, "utterances").withColumn("_tie", F.md5("split"))
    return clean.clean(u, ["ingested_at", "_tie"], F.col("labels.sentiment_6"), True)[0].select("instance_id", "split")


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1""")
def dedup_first(spark, d):
    """The first document of each text."""
    return clean.first_of(table(spark, d, "documents").select("doc_id", "text"), ["text"], ["doc_id"]).select("doc_id")


@query(
    f"""WITH {CUR} SELECT CASE WHEN s < 2 THEN 'short' WHEN s > 15 THEN 'long' WHEN NOT coalesce(trim(labels.sentiment_6) <> '', false) THEN 'no_label' END AS reason, count(*) AS n
FROM (SELECT *, coalesce(metadata.audio_length, 0) AS s FROM cur) GROUP BY 1"""
)
def duration_reasons(spark, d):
    """Why rows fall out by length and label."""
    out = clean.duration_filter(cur(spark, d, "metadata.audio_length", "labels.sentiment_6"), F.col("metadata.audio_length"), 2, 15, F.col("labels.sentiment_6"))
    return out.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CUR} SELECT instance_id FROM cur WHERE split = 'train' AND labels.dialogue_act_function IS NOT NULL AND labels.dialogue_act_function <> 'inform'
AND coalesce(metadata.audio_length, 0) <= 12 AND NOT (coalesce(metadata.audio_length, 0) > 0 AND coalesce(metadata.audio_length, 0) < 1)""")
def load_split(spark, d):
    """Train rows of one label within the length bounds."""
    rows = clean.load_split(cur(spark, d, "split", "labels.dialogue_act_function", "metadata.audio_length"), "train", F.col("labels.dialogue_act_function"), F.col("metadata.audio_length"), 12, 1, ["inform"])
    return rows.select("instance_id")


@query(
    """WITH f AS (SELECT *, coalesce(end_t - start_t, metadata.audio_length, len(labels.filled_pause) / frame_rate_hz) AS s FROM (SELECT DISTINCT * FROM frame_records) WHERE split = 'train')
SELECT CASE WHEN coalesce(len(labels.filled_pause), 0) = 0 THEN 'no_frames' WHEN s > 20 THEN 'long' WHEN list_sum(labels.filled_pause) = 0 THEN 'all_zero' END AS reason, count(*) AS n FROM f GROUP BY 1"""
)
def load_frame_split(spark, d):
    """Why frame records of train fall out."""
    f = table(spark, d, "frame_records").distinct()
    s = values.duration("start_t", "end_t", "metadata.audio_length", "labels.filled_pause", "frame_rate_hz")
    out = clean.load_frame_split(f, "train", F.col("labels.filled_pause"), s, 20, require_positive=True)
    return out.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n, count(*) FILTER (frame_rate_hz IS DISTINCT FROM 50) AS n_wrong, list_sort(list_distinct(list(frame_rate_hz))) AS rates FROM frame_records")
def frame_rate_gate(spark, d):
    """Records of another rate than the expected."""
    return clean.rate_gate(table(spark, d, "frame_records"), 50)


@query(
    """SELECT DISTINCT instance_id FROM frame_records WHERE abs(len(labels.filled_pause) - round_even(metadata.audio_length * frame_rate_hz, 0)) > 1"""
)
def frame_length_off(spark, d):
    """Frame records whose labels don't fit their length."""
    bad = clean.frame_length_off(F.col("labels.filled_pause"), F.col("metadata.audio_length"), F.col("frame_rate_hz"))
    return table(spark, d, "frame_records").where(bad).select("instance_id").distinct()


# --- profiles -------------------------------------------------------------------


@query(f"WITH {CUR} SELECT dataset, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM cur GROUP BY dataset")
def value_counts(spark, d):
    """Rows and share of each data set."""
    return profile.value_counts(cur(spark, d, "dataset"), "dataset").withColumn("pct", F.round("pct", 6))


@query(f"""WITH {CUR} SELECT dataset, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'dev') AS dev, count(*) FILTER (split = 'test') AS test FROM cur GROUP BY dataset""")
def crosstab_split(spark, d):
    """Data set by split."""
    return profile.crosstab(cur(spark, d, "dataset", "split"), "dataset", "split", ["train", "dev", "test"])


@query(f"WITH {CUR} SELECT split, count(*) AS n, round(sum(CAST(round_even(metadata.audio_length * 1000, 0) AS BIGINT)) / 3600000.0::DOUBLE, 6) AS hours FROM cur GROUP BY split")
def hours_per_split(spark, d):
    """Hours of each split, summed in whole milliseconds."""
    from tierflow.common import ms

    out = profile.hours(cur(spark, d, "split", "metadata.audio_length"), "split", ms("metadata.audio_length"))
    return out.withColumn("hours", F.round(F.col("hours") / 1000, 6))


@query(f"""WITH {CUR} SELECT dataset, count(metadata.audio_length) AS n, min(metadata.audio_length) AS min, round(quantile_cont(metadata.audio_length, 0.5), 6) AS p50,
round(quantile_cont(metadata.audio_length, 0.9), 6) AS p90, round(quantile_cont(metadata.audio_length, 0.99), 6) AS p99, max(metadata.audio_length) AS max FROM cur GROUP BY dataset""")
def quantiles_by_dataset(spark, d):
    """Exact quantiles of the length."""
    out = profile.quantiles(cur(spark, d, "dataset", "metadata.audio_length"), ["dataset"], F.col("metadata.audio_length"))
    return out.withColumns({c: F.round(c, 6) for c in ("p50", "p90", "p99")})


@query(f"""WITH {CUR}, q AS (SELECT dataset, quantile_cont(metadata.audio_length, 0.25) AS q1, quantile_cont(metadata.audio_length, 0.5) AS median, quantile_cont(metadata.audio_length, 0.75) AS q3,
min(metadata.audio_length) AS lo, max(metadata.audio_length) AS hi FROM cur GROUP BY dataset)
SELECT dataset, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(greatest(q1 - 1.5::DOUBLE * (q3 - q1), lo), 6) AS low, round(least(q3 + 1.5::DOUBLE * (q3 - q1), hi), 6) AS high FROM q""")
def box_stats(spark, d):
    """Quartiles and whiskers of the length."""
    out = profile.box_stats(cur(spark, d, "dataset", "metadata.audio_length"), ["dataset"], F.col("metadata.audio_length"))
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "low", "high")})


@query("""WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents)
SELECT CAST(least(floor((n_chars - lo) / (hi - lo) * 40) + 1, 40) AS INT) AS bin, count(*) AS n FROM documents, e WHERE n_chars IS NOT NULL GROUP BY 1""")
def histogram_n_chars(spark, d):
    """40 bins of equal width."""
    return profile.histogram(table(spark, d, "documents"), F.col("n_chars"), 40)


@query(f"""WITH {CUR} SELECT CASE WHEN grouping(dataset) = 1 THEN 'TOTAL' ELSE dataset END AS dataset, count(*) AS n, count(*) FILTER (metadata.audio_length > 20) AS "over" FROM cur GROUP BY ROLLUP (dataset)""")
def records_over_cap(spark, d):
    """Records beyond a length, per data set and in all."""
    return profile.over_cap(cur(spark, d, "dataset", "metadata.audio_length"), "dataset", F.col("metadata.audio_length"), 20)


@query(f"""WITH {CUR}, c AS (SELECT labels.sentiment_6 AS label, count(*) AS n FROM cur WHERE labels.sentiment_6 IS NOT NULL GROUP BY 1),
w AS (SELECT label, n, n * 100.0::DOUBLE / sum(n) OVER () AS pct, (max(n) OVER ())::DOUBLE / n AS ratio FROM c)
SELECT label, n, round(pct, 6) AS pct, round(ratio, 6) AS ratio, CASE WHEN ratio > 10 THEN 'ratio' WHEN pct < 5 THEN 'rare' END AS warning FROM w""")
def imbalance_warnings(spark, d):
    """Classes far from the largest or below a share."""
    u = cur(spark, d, "labels.sentiment_6").select(F.col("labels.sentiment_6").alias("label"))
    return profile.imbalance(u, "label", 10, 5).withColumns({"pct": F.round("pct", 6), "ratio": F.round("ratio", 6)})


@query(f"""WITH {CUR}, t AS (SELECT count(*) AS n FROM cur),
m AS (SELECT 'start_t' AS field, count(*) FILTER (start_t IS NULL) AS n_missing FROM cur UNION ALL SELECT 'split', count(*) FILTER (split IS NULL) FROM cur
UNION ALL SELECT 'speaker', count(*) FILTER (speaker IS NULL) FROM cur UNION ALL SELECT 'audio_length', count(*) FILTER (metadata.audio_length IS NULL) FROM cur
UNION ALL SELECT 'filled_pauses', count(*) FILTER (metadata.filled_pauses IS NULL) FROM cur)
SELECT field, n_missing, round(n_missing * 100.0::DOUBLE / n, 6) AS pct FROM m, t""")
def missing_fields(spark, d):
    """NULLs of several fields in one pass."""
    fields = {"start_t": "start_t", "split": "split", "speaker": "speaker", "audio_length": "metadata.audio_length", "filled_pauses": "metadata.filled_pauses"}
    out = profile.missing_fields(cur(spark, d, "start_t", "split", "speaker", "metadata.audio_length", "metadata.filled_pauses"), {k: F.col(v) for k, v in fields.items()})
    return out.withColumn("pct", F.round("pct", 6))


@query(f"""WITH {CUR} SELECT count(try_cast(CAST(labels.sentiment_logit AS VARCHAR) AS DOUBLE)) = count(labels.sentiment_logit) AND count(DISTINCT labels.sentiment_logit) > 12 AS "numeric",
count(DISTINCT labels.sentiment_logit) AS n_distinct FROM cur WHERE labels.sentiment_logit IS NOT NULL""")
def numeric_label(spark, d):
    """Whether a label is a number or a class."""
    return profile.numeric_label(cur(spark, d, "labels.sentiment_logit"), F.col("labels.sentiment_logit"))


@query("""SELECT tier, count(DISTINCT file_id) AS files, count(*) AS intervals, count(*) FILTER (trim(coalesce(label, '')) <> '') AS annotated,
count(DISTINCT CASE WHEN trim(coalesce(label, '')) <> '' THEN label END) AS labels FROM tier_intervals GROUP BY tier""")
def tier_overview(spark, d):
    """Files, intervals and labels of each tier."""
    return profile.tier_overview(table(spark, d, "tier_intervals"), "tier", "file_id", "label")


@query("""SELECT file_id, count(*) FILTER (label = 'eem') AS eem, count(*) FILTER (label = 'mm') AS mm FROM tier_intervals WHERE label IN ('eem', 'mm') GROUP BY file_id""")
def per_file_label_counts(spark, d):
    """Labels of each file, wide."""
    return profile.per_file_counts(table(spark, d, "tier_intervals"), "file_id", "label", ["eem", "mm"])


@query(f"""WITH {CUR} SELECT labels.speaker_gender AS gender, speaker, CAST(sum(labels.filled_pause_count) AS BIGINT) AS total FROM cur WHERE speaker IS NOT NULL AND labels.filled_pause_count IS NOT NULL
GROUP BY 1, 2 ORDER BY total DESC, gender NULLS FIRST, speaker LIMIT 10""")
def top_speakers_by_pauses(spark, d):
    """Gender and speaker with the most filled pauses."""
    u = cur(spark, d, "speaker", "labels.speaker_gender", "labels.filled_pause_count").where("speaker is not null and labels.filled_pause_count is not null")
    return profile.top_by_sum(u.select(F.col("labels.speaker_gender").alias("gender"), "speaker", F.col("labels.filled_pause_count").alias("n")), ["gender", "speaker"], "n")


@query(f"""WITH {CUR}, c AS (SELECT split, file_id, count(*) AS n FROM cur WHERE split IN ('train','dev','test') GROUP BY ALL)
SELECT split, file_id, n, CAST(r AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY n DESC, file_id) AS r FROM c) WHERE r <= 5""")
def top_files_per_split(spark, d):
    """The five largest recordings of each split."""
    u = cur(spark, d, "split", "file_id").where(F.col("split").isin("train", "dev", "test"))
    return profile.top_per_group(u, "split", "file_id", 5)


@query("""SELECT count(*) FILTER (label IN ('eem','mm','hm','ə')) AS valid, count(*) FILTER (label = '?') AS pending, count(*) FILTER (label NOT IN ('eem','mm','hm','ə','?')) AS invalid
FROM tier_intervals WHERE trim(coalesce(label, '')) <> ''""")
def annotation_status(spark, d):
    """Valid, pending and invalid labels."""
    return profile.annotation_status(table(spark, d, "tier_intervals"), "label", ["eem", "mm", "hm", "ə"])


@query(f"WITH {CUR} SELECT min(labels.speaker_age) AS min, max(labels.speaker_age) AS max, round(avg(labels.speaker_age), 6) AS mean, count(labels.speaker_age) AS n FROM cur")
def age_range(spark, d):
    """Span and mean of the age."""
    return profile.range_summary(cur(spark, d, "labels.speaker_age"), F.col("labels.speaker_age")).withColumn("mean", F.round("mean", 6))


@query("""SELECT split, count(*) AS records, CAST(sum(len(list_filter(labels.filled_pause, lambda x: x = 0))) AS BIGINT) AS frames_0,
CAST(sum(len(list_filter(labels.filled_pause, lambda x: x = 1))) AS BIGINT) AS frames_1 FROM (SELECT DISTINCT * FROM frame_records) WHERE labels.filled_pause IS NOT NULL GROUP BY split""")
def frame_tokens(spark, d):
    """Frames of each class by split."""
    return profile.frame_tokens(table(spark, d, "frame_records").distinct(), "split", F.col("labels.filled_pause"))


@query("""WITH l AS (SELECT CAST(raw AS JSON) -> '$.labels' AS labels FROM record_lines WHERE json_valid(raw)), k AS (SELECT labels, unnest(json_keys(labels)) AS k FROM l WHERE json_type(labels) = 'OBJECT')
SELECT list_sort(list(DISTINCT k)) AS keys FROM k WHERE json_type(json_extract(labels, '$."' || k || '"')) <> 'ARRAY'""")
def scalar_label_keys(spark, d):
    """Label keys of raw lines that are no lists."""
    return profile.scalar_label_keys(table(spark, d, "record_lines"))


# --- labels -----------------------------------------------------------------------


@query(f"""WITH {CUR}, t AS (SELECT instance_id, split, labels.dialogue_act_function AS label FROM cur),
n AS (SELECT label, count(*) AS n FROM t WHERE split = 'train' AND label IS NOT NULL GROUP BY 1), k AS (SELECT label FROM n WHERE n >= (SELECT max(n) FROM n) / 20.0::DOUBLE)
SELECT coalesce(CASE WHEN label IS NULL OR label IN (SELECT label FROM k) THEN label ELSE 'Other' END, 'NONE') AS label, split, count(*) AS n FROM t GROUP BY ALL""")
def rare_class_collapse(spark, d):
    """Classes rare in train become Other everywhere."""
    u = cur(spark, d, "split", "labels.dialogue_act_function").select("instance_id", "split", F.col("labels.dialogue_act_function").alias("label"))
    out = labels.collapse_rare(u, "label", 20)
    return out.groupBy(F.coalesce("label", F.lit("NONE")).alias("label"), "split").agg(F.count(F.lit(1)).alias("n"))


_ORDER = ["NeutralNeg", "NeutralPos", "Negative", "Positive", "M_Negative", "M_Positive", "Absent"]


@query(f"""WITH {CUR}, o AS (SELECT unnest({_ORDER}) AS label, unnest(range(7)) AS id), c AS (SELECT labels.sentiment_6 AS label, count(*) AS n FROM cur WHERE split = 'train' GROUP BY 1),
j AS (SELECT CAST(id AS INT) AS id, label, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN 1 / sqrt(n) END AS w FROM o LEFT JOIN c USING (label))
SELECT id, label, n, round(coalesce(w / avg(w) OVER (), 0), 6) AS weight FROM j""")
def class_weights(spark, d):
    """Weights by the root of the class size, mean 1."""
    u = cur(spark, d, "split", "labels.sentiment_6").where("split = 'train'").select(F.col("labels.sentiment_6").alias("label"))
    return labels.class_weights(u, "label", _ORDER, root=True).withColumn("weight", F.round("weight", 6))


@query(f"WITH {CUR} SELECT list_sort(list(DISTINCT labels.speaker_gender)) AS labels FROM cur WHERE labels.speaker_gender IS NOT NULL")
def label_order(spark, d):
    """The distinct labels in order."""
    return labels.label_order(cur(spark, d, "labels.speaker_gender").select(F.col("labels.speaker_gender").alias("label")), "label")


@query(f"""WITH {CUR}, f AS (SELECT avg(labels.sentiment_logit) AS m, stddev_pop(labels.sentiment_logit) AS s FROM cur WHERE split = 'train')
SELECT instance_id, round((labels.sentiment_logit - m) / s, 5) AS z FROM cur, f WHERE labels.sentiment_logit IS NOT NULL""")
def zscore_train(spark, d):
    """A label normalised by train's mean and deviation."""
    u = cur(spark, d, "split", "labels.sentiment_logit").select("instance_id", "split", F.col("labels.sentiment_logit").alias("v")).where("v is not null")
    return labels.zscore(u, "v").select("instance_id", F.round("z", 5).alias("z"))


_SCALE = {"M_Negative": 0.0, "Negative": 1.0, "NeutralNeg": 2.0, "NeutralPos": 3.0, "Positive": 4.0, "M_Positive": 5.0}


@query(f"""WITH {CUR} SELECT instance_id, CASE labels.speaker_gender WHEN 'F' THEN 'female' WHEN 'M' THEN 'male' ELSE labels.speaker_gender END AS gender,
CASE labels.sentiment_6 WHEN 'M_Negative' THEN 0.0 WHEN 'Negative' THEN 1.0 WHEN 'NeutralNeg' THEN 2.0 WHEN 'NeutralPos' THEN 3.0 WHEN 'Positive' THEN 4.0 WHEN 'M_Positive' THEN 5.0 END::DOUBLE AS score,
CAST(nullif(list_position(['NeutralNeg','NeutralPos'], labels.sentiment_6), 0) - 1 AS INT) AS label_id FROM cur""")
def label_remap_scale(spark, d):
    """Labels remapped, put on a scale and numbered."""
    s = "labels.sentiment_6"
    return cur(spark, d, "labels.speaker_gender", "labels.sentiment_6").select(
        "instance_id", values.remap("labels.speaker_gender", {"F": "female", "M": "male"}).alias("gender"),
        values.scaled(s, _SCALE).alias("score"), values.label_index(s, ["NeutralNeg", "NeutralPos"]).alias("label_id"),
    )


@query(f"""WITH {CUR} SELECT instance_id, CASE WHEN metadata.speaker_info.speaker_gender IN ('M','F') THEN metadata.speaker_info.speaker_gender END AS gender,
try_cast(substr(metadata.speaker_info.date, 1, 4) AS INT) - try_cast(metadata.speaker_info.speaker_birth AS INT) AS age,
CAST(len(metadata.filled_pauses) AS INT) AS pauses, upper(substr(labels.dialogue_act_function, 1, 1)) || lower(substr(labels.dialogue_act_function, 2)) AS act,
coalesce(nullif(metadata.speaker_info.speaker_id, ''), nullif(metadata.speaker_info.speaker_name, ''), 'UNKNOWN') AS who FROM cur""")
def derive_labels(spark, d):
    """Gender, age, pause count, capitalised act and speaker of each utterance."""
    i = "metadata.speaker_info."
    return cur(spark, d, "metadata.filled_pauses", "labels.dialogue_act_function", "metadata.speaker_info.speaker_gender", "metadata.speaker_info.date", "metadata.speaker_info.speaker_birth", "metadata.speaker_info.speaker_id", "metadata.speaker_info.speaker_name").select(
        "instance_id", values.known_gender(i + "speaker_gender").alias("gender"), values.age(i + "date", i + "speaker_birth").alias("age"),
        values.count_or_null("metadata.filled_pauses").alias("pauses"), values.capitalise("labels.dialogue_act_function").alias("act"),
        values.first_filled(i + "speaker_id", i + "speaker_name", default="UNKNOWN").alias("who"),
    )


@query(f"""WITH {CUR} SELECT instance_id,
concat_ws('_', regexp_replace(dataset, '[^A-Za-z0-9._\\-]+', '-', 'g'), regexp_replace(file_id, '[^A-Za-z0-9._\\-]+', '-', 'g'), regexp_replace(speaker, '[^A-Za-z0-9._\\-]+', '-', 'g'),
  CASE WHEN start_t IS NOT NULL THEN printf('%.3f', start_t) END, CASE WHEN end_t IS NOT NULL THEN printf('%.3f', end_t) END) AS canonical,
regexp_extract(instance_id, '^(.*)_[^_]*$', 1) AS prefix, regexp_replace(regexp_extract(audio_path, '[^/]*$'), '(.)\\.[^.]*$', '\\1') AS stem,
regexp_replace(audio_path, '^data/', '') AS below FROM cur""")
def derive_ids(spark, d):
    """Canonical ids, prefixes, stems and relative paths."""
    return cur(spark, d, "dataset", "file_id", "speaker", "start_t", "end_t", "audio_path").select(
        "instance_id", ids.instance_id("dataset", "file_id", "speaker", "start_t", "end_t").alias("canonical"),
        ids.before_last("instance_id").alias("prefix"), ids.stem("audio_path").alias("stem"), ids.relative_to("audio_path", "data").alias("below"),
    )


# --- look-ups and set joins -----------------------------------------------------------


@query(f"""WITH {CUR}, p AS (SELECT DISTINCT speaker, split FROM cur WHERE speaker IS NOT NULL AND split IN ('train','dev','test'))
SELECT a.split AS group_a, b.split AS group_b, count(*) AS n FROM p a JOIN p b ON a.speaker = b.speaker AND a.split < b.split GROUP BY ALL""")
def speakers_shared(spark, d):
    """How many speakers each two splits share."""
    return joins.shared_between(cur(spark, d, "speaker", "split").where(F.col("split").isin("train", "dev", "test")), "speaker", "split")


@query(f"""WITH {CUR} SELECT instance_id FROM cur WHERE NOT EXISTS (SELECT 1 FROM frame_records f WHERE f.instance_id = cur.instance_id)""")
def anti_resume(spark, d):
    """Utterances without a frame record yet."""
    return joins.todo(cur(spark, d), table(spark, d, "frame_records"), "instance_id").select("instance_id")


@query("""SELECT file_id FROM tier_intervals WHERE tier IN ('norm','FilledPauses','sentimentCurated') GROUP BY file_id HAVING count(DISTINCT tier) = 3""")
def layer_division(spark, d):
    """Recordings with all the needed tiers."""
    return joins.has_all(table(spark, d, "tier_intervals"), "file_id", "tier", ["norm", "FilledPauses", "sentimentCurated"])


@query(f"""WITH {CUR}, f AS (SELECT file_id, min(split) AS b FROM frame_records GROUP BY 1), u AS (SELECT file_id, min(split) AS a FROM cur GROUP BY 1)
SELECT file_id, a AS split_a, b AS split_b FROM u JOIN f USING (file_id) WHERE a <> b""")
def split_conflicts(spark, d):
    """Recordings whose split differs between two tables."""
    return joins.split_conflicts(cur(spark, d, "file_id", "split"), table(spark, d, "frame_records"))


@query(f"""WITH {CUR}, i AS (SELECT file_id AS stem, min(audio_path) AS path FROM frame_records GROUP BY 1) SELECT instance_id, path FROM cur JOIN i ON i.stem = cur.file_id""")
def resolve_sources(spark, d):
    """A source path for each record, the first of the index; unresolved records drop out."""
    index = table(spark, d, "frame_records").select("file_id", F.col("audio_path").alias("path"))
    return joins.resolve(cur(spark, d, "file_id").select("instance_id", "file_id"), index, "file_id", ["path"]).select("instance_id", "path")


@query(f"""WITH {CUR}, f AS (SELECT DISTINCT instance_id, frame_rate_hz FROM frame_records),
p AS (SELECT instance_id, speaker AS p_speaker, labels.speaker_gender AS g FROM cur) SELECT instance_id, frame_rate_hz, p_speaker, g AS p_gender FROM f LEFT JOIN p USING (instance_id)""")
def parent_join(spark, d):
    """Frame records with facts of their last parent."""
    parents = table(spark, d, "utterances").select("instance_id", "speaker", F.col("labels.speaker_gender").alias("gender"), "ingested_at")
    f = table(spark, d, "frame_records").select("instance_id", "frame_rate_hz").distinct()
    return joins.parent_of(f, parents, "instance_id", ["ingested_at"], keep_orphans=True).drop("p_ingested_at")


@query("""SELECT o_orderpriority, c_mktsegment, n_regionkey, count(*) AS n, round(CAST(sum(CAST(round_even(o_totalprice * 100, 0) AS BIGINT)) AS DOUBLE) / 100, 2) AS total FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def manifest_join(spark, d):
    """All rows of a manifest with what its look-ups know of them, summed."""
    t = lambda n, *c: table(spark, d, n).select(*c)
    look_ups = [(t("customer", "c_custkey", "c_nationkey", "c_mktsegment"), "o_custkey", "c_custkey"), (t("nation", "n_nationkey", "n_regionkey"), "c_nationkey", "n_nationkey")]
    j = joins.manifest(t("orders", "o_custkey", "o_orderpriority", "o_totalprice"), look_ups)
    cents = F.sum(F.rint(F.col("o_totalprice") * 100).cast("bigint"))
    return j.groupBy("o_orderpriority", "c_mktsegment", "n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.round(cents.cast("double") / 100, 2).alias("total"))
