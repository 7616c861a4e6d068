"""Queries of the time operators: interval joins, frames, events, reshaping, metrics.

Frames and probabilities for the frame operators come from frame_records and from
the 64 numbers of each embedding, which stand for scores of 64 frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.common import ms, table
from tierflow.functions import frames, ids
from tierflow.operators import events, joins, metrics, reshape
from tierflow.plans.corpus import CUR, cur

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_MS = "CAST(round_even({0} * 1000, 0) AS BIGINT)"
_TIERS = f"""tiers AS (SELECT DISTINCT file_id, tier, speaker, idx, {_MS.format('start_t')} AS s, {_MS.format('end_t')} AS e, label FROM tier_intervals
  WHERE start_t IS NOT NULL AND end_t IS NOT NULL AND {_MS.format('end_t')} >= {_MS.format('start_t')})"""


def tiers(spark, d, *names):
    t = table(spark, d, "tier_intervals").select("file_id", "tier", "speaker", "idx", ms("start_t").alias("start_ms"), ms("end_t").alias("end_ms"), "label")
    t = t.where("start_ms is not null and end_ms is not null and end_ms >= start_ms").distinct()
    return t.where(F.col("tier").isin(*names)) if names else t


# --- interval joins -----------------------------------------------------------------


@query(f"""WITH {_TIERS}, r AS (SELECT * FROM tiers WHERE tier = 'dialogueActsIsoDimension' QUALIFY row_number() OVER (PARTITION BY file_id, speaker, s, e ORDER BY idx DESC, label DESC NULLS LAST) = 1)
SELECT a.file_id, a.idx, a.label AS norm, r.label AS act FROM tiers a LEFT JOIN r ON r.file_id = a.file_id AND r.s = a.s AND r.e = a.e AND r.speaker IS NOT DISTINCT FROM a.speaker WHERE a.tier = 'norm'""")
def aligned_join_last_wins(spark, d):
    """Labels of another tier at the same place; the last duplicate wins."""
    out = joins.align_tiers(tiers(spark, d, "norm"), {"act": tiers(spark, d, "dialogueActsIsoDimension")}, ["idx", "label"])
    return out.select("file_id", "idx", F.col("label").alias("norm"), "act")


@query(f"""WITH {_TIERS}, p AS (SELECT a.file_id, a.idx, a.s, a.e, a.speaker, nullif(o.label, '') AS outer_label, row_number() OVER (PARTITION BY a.file_id, a.idx, a.s, a.e, a.speaker, a.label ORDER BY o.idx, o.s, o.e, o.label) AS r
FROM tiers a JOIN tiers o ON o.tier = 'sentimentCurated' AND o.file_id = a.file_id AND o.s - 1 <= a.s AND a.e <= o.e + 1 WHERE a.tier = 'FilledPauses')
SELECT a.file_id, a.idx, p.outer_label FROM (SELECT DISTINCT file_id, idx, s, e FROM tiers WHERE tier = 'FilledPauses') a LEFT JOIN (SELECT * FROM p WHERE r = 1) p USING (file_id, idx, s, e)""")
def interval_contains(spark, d):
    """The first span of a tier that holds an interval."""
    out = joins.containing_label(tiers(spark, d, "FilledPauses"), tiers(spark, d, "sentimentCurated"), ["file_id"], ["file_id", "idx", "start_ms", "end_ms"])
    return out.select("file_id", "idx", "outer_label")


@query(f"""WITH {_TIERS}, n AS (SELECT a.file_id, a.idx, count(*) AS n FROM tiers a JOIN tiers o ON o.tier = 'vocalDisfluency' AND o.file_id = a.file_id AND o.speaker = a.speaker AND o.e + 1 >= a.s AND o.s - 1 <= a.e
WHERE a.tier = 'norm' GROUP BY ALL) SELECT a.file_id, a.idx, coalesce(n, 0) AS n, CAST(coalesce(n, 0) > 0 AS INT) AS flag FROM tiers a LEFT JOIN n USING (file_id, idx) WHERE a.tier = 'norm'""")
def interval_overlap_count(spark, d):
    """How many disfluencies of the speaker overlap an interval."""
    out = joins.overlap_counts(tiers(spark, d, "norm"), tiers(spark, d, "vocalDisfluency"), ["file_id", "speaker"], ["file_id", "idx"])
    return out.select("file_id", "idx", "n", "flag")


@query(f"""WITH {_TIERS}, p AS (SELECT m.file_id, m.idx, w.idx AS w, CASE WHEN w.s - 1 <= m.s AND m.e <= w.e + 1 THEN 0 WHEN (m.s + m.e) / 2.0 BETWEEN w.s AND w.e THEN 1 END AS t
FROM tiers m JOIN tiers w ON w.tier = 'norm' AND w.file_id = m.file_id WHERE m.tier = 'FilledPauses'),
b AS (SELECT file_id, idx, w, row_number() OVER (PARTITION BY file_id, idx ORDER BY t, w) AS r FROM p WHERE t IS NOT NULL)
SELECT m.file_id, m.idx, b.w AS word_idx, CASE WHEN b.w IS NULL THEN 'stress_outside_word' END AS note FROM tiers m LEFT JOIN (SELECT * FROM b WHERE r = 1) b USING (file_id, idx) WHERE m.tier = 'FilledPauses'""")
def point_in_interval_fallback(spark, d):
    """The word that holds a mark, else the one that holds its middle."""
    out = joins.marks_in_words(tiers(spark, d, "FilledPauses"), tiers(spark, d, "norm"), ["file_id"], ["file_id", "idx"])
    return out.select("file_id", "idx", "word_idx", "note")


@query(f"""WITH {CUR} SELECT instance_id, list_transform(list_filter(metadata.filled_pauses, lambda g: g.time_e > 1.0::DOUBLE + 1e-3::DOUBLE AND g.time_s < 5.0::DOUBLE - 1e-3::DOUBLE),
lambda g: CAST(round_even(round(least(greatest(g.time_s - 1.0::DOUBLE, 0), 4.0::DOUBLE) * 1000, 6), 0) AS BIGINT)) AS starts,
list_transform(list_filter(metadata.filled_pauses, lambda g: g.time_e > 1.0::DOUBLE + 1e-3::DOUBLE AND g.time_s < 5.0::DOUBLE - 1e-3::DOUBLE),
lambda g: CAST(round_even(round(least(greatest(g.time_e - 1.0::DOUBLE, 0), 4.0::DOUBLE) * 1000, 6), 0) AS BIGINT)) AS ends FROM cur WHERE len(metadata.filled_pauses) > 0""")
def slice_rebased(spark, d):
    """Intervals within a window, counted from its start."""
    got = joins.slice_within(F.col("metadata.filled_pauses"), F.lit(1.0), F.lit(5.0))
    u = cur(spark, d, "metadata.filled_pauses").where("size(metadata.filled_pauses) > 0")
    whole = lambda t: F.transform(got, lambda g: F.rint(g[t] * 1000).cast("bigint"))
    return u.select("instance_id", whole("time_s").alias("starts"), whole("time_e").alias("ends"))


# --- frames ---------------------------------------------------------------------------

_FP = f"""WITH {CUR}, f AS (SELECT instance_id, metadata.filled_pauses AS fp, metadata.audio_length AS d FROM cur WHERE len(metadata.filled_pauses) > 0 AND metadata.audio_length IS NOT NULL
AND list_bool_and(list_transform(metadata.filled_pauses, lambda p: p.time_s IS NOT NULL AND p.time_e IS NOT NULL)))"""


def _pauses(spark, d):
    p = F.col("metadata.filled_pauses")
    whole = F.forall(p, lambda x: x["time_s"].isNotNull() & x["time_e"].isNotNull())
    u = cur(spark, d, "metadata.filled_pauses", "metadata.audio_length").where((F.size(p) > 0) & F.col("metadata.audio_length").isNotNull() & whole)
    return u.select("instance_id", p.alias("fp"), F.col("metadata.audio_length").alias("d"))


@query(_FP + """ SELECT instance_id, list_transform(range(CAST(round_even(d * 50, 0) AS BIGINT)),
lambda t: CAST(len(list_filter(fp, lambda p: t >= round_even(p.time_s * 50, 0) AND t < round_even(p.time_e * 50, 0))) > 0 AS INT)) AS frames FROM f""")
def frame_labels_round(spark, d):
    """Intervals as frames, edges rounded half to even."""
    return _pauses(spark, d).select("instance_id", frames.rasterise_rounded("fp", "d", 50).alias("frames"))


@query(_FP + """ SELECT instance_id, list_transform(range(CAST(floor(d * 50) AS BIGINT)),
lambda t: CAST(len(list_filter(fp, lambda p: p.time_e > p.time_s AND t >= floor(p.time_s * 50) AND t < ceil(p.time_e * 50))) > 0 AS INT)) AS frames FROM f""")
def frame_labels_floor(spark, d):
    """Intervals as frames, every touched frame counts."""
    return _pauses(spark, d).select("instance_id", frames.rasterise_touched("fp", "d", 50).alias("frames"))


@query(_FP + """, w AS (SELECT *, round_even(round(greatest(0, fp[1].time_s - 2) * 1000, 6), 0) / 1000 AS window_start, round_even(round(least(d, fp[len(fp)].time_e + 2) * 1000, 6), 0) / 1000 AS window_end FROM f)
SELECT instance_id, window_start, window_end, list_transform(range(CAST(greatest(round_even(window_start * 50, 0), 0) AS BIGINT), CAST(least(round_even(window_end * 50, 0), round_even(d * 50, 0)) AS BIGINT)),
lambda t: CAST(len(list_filter(fp, lambda p: t >= round_even(p.time_s * 50, 0) AND t < round_even(p.time_e * 50, 0))) > 0 AS INT)) AS filled_pause FROM w WHERE window_end >= window_start""")
def window_around_events(spark, d):
    """The window around a recording's events, and its frames."""
    out = reshape.window_records(_pauses(spark, d), F.col("fp"), F.col("d"), 2.0, 50).where("window_end >= window_start")
    return out.select("instance_id", "window_start", "window_end", "filled_pause")


_BITS = "bits AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INT)) AS b FROM embeddings)"


def _bits(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: (x > 0).cast("int")).alias("b"), "embedding")


@query(f"WITH {_BITS} SELECT vec_id, list_transform(range(100), lambda j: b[least((j * 64) // 100, 63) + 1]) AS resized FROM bits")
def frame_resize(spark, d):
    """64 frames stretched to 100."""
    return _bits(spark, d).select("vec_id", frames.resize("b", F.lit(100)).alias("resized"))


@query("""WITH RECURSIVE l(doc_id, i, n) AS (SELECT doc_id, 0, n_chars * 16 FROM documents WHERE n_chars IS NOT NULL
UNION ALL SELECT doc_id, i + 1, CAST(floor((n - [10,3,3,3,3,2,2][i + 1]) / [5,2,2,2,2,2,2][i + 1]::DOUBLE) + 1 AS BIGINT) FROM l WHERE i < 7)
SELECT doc_id, greatest(n, 0) AS frames FROM l WHERE i = 7""")
def conv_output_length(spark, d):
    """Frames that a stack of convolutions makes of so many samples."""
    n = frames.conv_length(F.col("n_chars") * 16, [10, 3, 3, 3, 3, 2, 2], [5, 2, 2, 2, 2, 2, 2])
    return table(spark, d, "documents").where("n_chars is not null").select("doc_id", n.cast("bigint").alias("frames"))


@query(f"WITH {_BITS} SELECT vec_id, b || list_transform(range(16), lambda i: -100) AS padded, b[1:50] AS trimmed, b[11:20] AS sliced FROM bits")
def frame_pad_slice(spark, d):
    """Frames padded with the ignored label, cut to a length, and sliced by time."""
    return _bits(spark, d).select(
        "vec_id", frames.pad("b", F.lit(80)).alias("padded"), frames.pad("b", F.lit(50)).alias("trimmed"),
        frames.frame_slice("b", F.lit(0.2), F.lit(0.4), F.lit(50)).alias("sliced"),
    )


@query("""WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings), m AS (SELECT vec_id, e, list_max(e) AS t FROM x),
s AS (SELECT vec_id, list_position(e, t) - 1 AS best, 1 / list_sum(list_transform(e, lambda v: exp(v - t))) AS p FROM m) SELECT vec_id, CAST(best AS INT) AS best, round(p, 6) AS prob FROM s""")
def softmax_argmax(spark, d):
    """The winning class and its probability."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", frames.argmax(e).alias("best"), F.round(F.array_max(frames.softmax(e)), 6).alias("prob"))


@query(f"""WITH {_BITS} SELECT vec_id, CAST(list_sum(b) AS BIGINT) AS ones, list_sum(b) > 0 AS any_one, CAST(len(list_filter(range(1, 33), lambda i: b[i] <> b[i + 32])) AS INT) AS wrong,
len(list_filter(range(1, 33), lambda i: b[i] <> b[i + 32])) / 32.0::DOUBLE AS rate, list_transform(range(1, 33), lambda i: CASE WHEN b[i] = 1 AND b[i + 32] = 1 THEN 'hit' WHEN b[i] = 1 THEN 'miss' WHEN b[i + 32] = 1 THEN 'false' ELSE 'none' END) AS outcome FROM bits""")
def frame_errors(spark, d):
    """Sums, mismatches and outcomes of frames against other frames."""
    g, p = F.slice("b", 1, 32), F.slice("b", 33, 32)
    return _bits(spark, d).select(
        "vec_id", frames.total("b").alias("ones"), frames.any_positive("b").alias("any_one"), frames.mismatches(g, p).alias("wrong"),
        frames.error_rate(g, p).alias("rate"), frames.outcome(g, p).alias("outcome"),
    )


@query(f"WITH {_BITS} SELECT vec_id, b[1:least(20, CAST(list_sum(b) AS BIGINT))] AS trimmed, round(list_sum(list_transform(range(1, 65), lambda i: b[i] * embedding[i]::DOUBLE)) / list_sum(b), 5) AS pooled FROM bits JOIN embeddings USING (vec_id) WHERE list_sum(b) > 0")
def mask_trim_pool(spark, d):
    """Frames trimmed to a mask's length, and values averaged under it."""
    b = _bits(spark, d).where(frames.total("b") > 0)
    pooled = frames.masked_mean(F.transform("embedding", lambda v: v.cast("double")), F.col("b"))
    return b.select("vec_id", frames.trim_to_mask("b", F.col("b"), F.lit(20)).alias("trimmed"), F.round(pooled, 5).alias("pooled"))


# --- events ---------------------------------------------------------------------------

_RUNS = f"""{_BITS}, one AS (SELECT vec_id, unnest(range(64)) AS i, unnest(b) AS v FROM bits), k AS (SELECT *, i - row_number() OVER (PARTITION BY vec_id, v ORDER BY i) AS g FROM one),
ev AS (SELECT vec_id, min(i) AS a, max(i) + 1 AS z FROM k WHERE v = 1 GROUP BY vec_id, g)"""


def _events(spark, d):
    e = events.frames_to_events("b", F.transform("b", lambda x: F.lit(0.5)), {1: "fp"}, F.lit(0.02))
    return _bits(spark, d).select("vec_id", e.alias("e"))


@query(f"WITH {_RUNS} SELECT vec_id, round_even(a * 20, 0) / 1000 AS start_s, round_even(z * 20, 0) / 1000 AS end_s, 'fp' AS label, 0.5::DOUBLE AS mean_prob FROM ev")
def frames_to_events(spark, d):
    """Runs of positive frames as events."""
    return _events(spark, d).select("vec_id", F.inline_outer("e")).where("start_s is not null")


@query(f"WITH {_RUNS} SELECT vec_id, count(*) AS events, round(sum((z - a) * 20) / 1000, 6) AS event_s FROM ev WHERE a <> 0 AND z * 20 < 1260 AND (z - a) * 20 >= 80 GROUP BY vec_id")
def event_postprocess(spark, d):
    """Events without those at the edges and the short ones, summed."""
    # lengths are multiples of 20 ms: the bound lies between two of them
    kept = events.postprocess("e", F.lit(1.28), shortest=0.07)
    long = _events(spark, d).select("vec_id", F.inline_outer(kept)).where("start_s is not null")
    return events.totals(long, "vec_id").withColumn("event_s", F.round("event_s", 6))


@query(f"""WITH {_RUNS}, g AS (SELECT vec_id, coalesce(lag(z) OVER (PARTITION BY vec_id ORDER BY a), 0) AS a, a AS z FROM ev UNION ALL SELECT vec_id, max(z), 64 FROM ev GROUP BY vec_id)
SELECT vec_id, CAST(a * 20 AS BIGINT) AS start_ms, CAST(z * 20 AS BIGINT) AS end_ms, label FROM (SELECT vec_id, a, z, 'fp' AS label FROM ev UNION ALL SELECT vec_id, a, z, '' FROM g WHERE z > a)""")
def gap_fill(spark, d):
    """Events with the gaps between, before and after them."""
    long = _events(spark, d).select("vec_id", F.inline_outer("e")).where("start_s is not null").withColumn("duration", F.lit(1.28))
    return events.fill_gaps(long, "vec_id", "duration").select("vec_id", ms("start_s").alias("start_ms"), ms("end_s").alias("end_ms"), "label")


@query("""SELECT doc_id, i * 500.0::DOUBLE AS start_s, least(n_chars, (i + 1) * 500.0::DOUBLE) AS end_s FROM (SELECT doc_id, n_chars, unnest(range(greatest(1, CAST(ceil(n_chars / 500.0::DOUBLE) AS BIGINT)))) AS i FROM documents WHERE n_chars IS NOT NULL)""")
def chunk_windows(spark, d):
    """Fixed chunks, the last one partial."""
    docs = table(spark, d, "documents").where("n_chars is not null")
    return docs.select("doc_id", F.inline(events.chunk_spans(F.col("n_chars").cast("double"), 500)))


@query("""WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS j FROM events)
SELECT event_type, n, count(*) AS islands FROM (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY user_id, event_type, i - j) GROUP BY ALL""")
def islands_event_type(spark, d):
    """Runs of one event type of each user, by length."""
    runs = events.islands(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return runs.groupBy("event_type", "n").agg(F.count(F.lit(1)).alias("islands"))


# --- reshaping --------------------------------------------------------------------------


@query(f"""WITH {CUR} SELECT instance_id, task, label, split FROM (SELECT instance_id, 'gender' AS task, labels.speaker_gender AS label, split FROM cur UNION ALL SELECT instance_id, 'age', CAST(labels.speaker_age AS VARCHAR), split FROM cur
UNION ALL SELECT instance_id, 'act', labels.dialogue_act_function, split FROM cur) WHERE label IS NOT NULL AND coalesce(split, '') <> ''""")
def unpivot_tasks(spark, d):
    """One row per record and task."""
    u = cur(spark, d, "split", "labels.speaker_gender", "labels.speaker_age", "labels.dialogue_act_function").select("instance_id", "split", F.col("labels.speaker_gender").alias("g"), F.col("labels.speaker_age").alias("a"), F.col("labels.dialogue_act_function").alias("f"))
    return reshape.unpivot_tasks(u, {"gender": ("g", "split"), "age": ("a", "split"), "act": ("f", "split")}, ["instance_id"])


@query(f"""WITH {CUR}, x AS (SELECT instance_id, dataset, file_id, speaker, split, coalesce(start_t, 0.0::DOUBLE) AS b, unnest(list_transform(metadata.filled_pauses, lambda p, i: {{'s': p.time_s, 'e': p.time_e, 'i': i}})) AS p FROM cur WHERE len(metadata.filled_pauses) > 0),
y AS (SELECT *, round_even(round(p.s * 1000, 6), 0) / 1000 AS a, round_even(round(p.e * 1000, 6), 0) / 1000 AS z FROM x)
SELECT instance_id || '_ev' || lpad(CAST(p.i AS VARCHAR), CAST(greatest(2, length(CAST(p.i AS VARCHAR))) AS INT), '0') || '_' || coalesce(printf('%.3f', a), 'null') || '-' || coalesce(printf('%.3f', z), 'null') AS instance_id,
instance_id AS source_utterance_id, dataset, file_id, speaker, split, CAST(p.i AS INT) AS event_index,
round_even(round((b + a) * 1000, 5), 0) / 1000 AS start_t, round_even(round((b + z) * 1000, 5), 0) / 1000 AS end_t, NULL::VARCHAR AS fp_type, '?' AS raw_label FROM y""")
def event_explode(spark, d):
    """One row per event of an utterance."""
    e = F.transform("metadata.filled_pauses", lambda p: F.struct(p["time_s"].alias("start_s"), p["time_e"].alias("end_s"), F.lit("?").alias("label")))
    u = cur(spark, d, "metadata.filled_pauses", "dataset", "file_id", "speaker", "split", "start_t")
    return reshape.event_rows(u, e)


@query(f"""WITH {_TIERS}, n AS (SELECT DISTINCT file_id, tier FROM tiers WHERE tier IN ('norm', 'FilledPauses', 'instructions')), m AS (SELECT file_id, min(s) AS start_t, max(e) AS end_t FROM tiers WHERE tier IN ('norm', 'FilledPauses', 'instructions') GROUP BY 1)
SELECT file_id, tier AS layer, CAST(row_number() OVER (PARTITION BY file_id ORDER BY list_position(['FilledPauses', 'norm', 'instructions'], tier)) AS INT) AS place,
CASE WHEN row_number() OVER (PARTITION BY file_id ORDER BY list_position(['FilledPauses', 'norm', 'instructions'], tier)) > 1 THEN tier || '_words' ELSE 'words' END AS new_tier, start_t, end_t FROM n JOIN m USING (file_id)""")
def tier_merge(spark, d):
    """Layers with one tier name merged by recipe: later ones are renamed."""
    t = tiers(spark, d, "norm", "FilledPauses", "instructions").select(
        F.col("file_id").alias("base"), F.col("tier").alias("layer"), F.lit("words").alias("tier"), F.lit(1).alias("tier_pos"), F.col("start_ms").alias("start_t"), F.col("end_ms").alias("end_t")
    )
    merged = reshape.merge_tiers(t, ["FilledPauses", "norm", "instructions"]).select(F.col("base").alias("file_id"), "layer", "place", "new_tier").distinct()
    return merged.join(reshape.domains(t).withColumnRenamed("base", "file_id"), "file_id")


@query(f"WITH {_TIERS} SELECT file_id, idx, CASE WHEN trim(coalesce(label, '')) <> '' THEN '?' ELSE '' END AS label FROM tiers WHERE tier = 'norm'")
def tier_mimic(spark, d):
    """A tier to be filled in: the same places, placeholders for labels."""
    return reshape.mimic_tier(tiers(spark, d, "norm"), "copy").select("file_id", "idx", "label")


@query("SELECT doc_id, lang, NULL::INT AS extra FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, NULL, 1 FROM documents WHERE doc_id % 2 = 1")
def pool_union(spark, d):
    """Tables of different columns as one."""
    t = table(spark, d, "documents")
    return reshape.pool(t.where("doc_id % 2 = 0").select("doc_id", "lang"), t.where("doc_id % 2 = 1").select("doc_id", F.lit(1).alias("extra")))


# --- metrics ------------------------------------------------------------------------------

_CONF = f"""WITH {CUR}, c AS (SELECT labels.sentiment_6 AS gold, CASE WHEN labels.sentiment_logit > 0 THEN 'Positive' WHEN labels.sentiment_logit <= 0 THEN 'Negative' END AS pred, count(*) AS n FROM cur
WHERE labels.sentiment_6 IS NOT NULL AND labels.sentiment_logit IS NOT NULL GROUP BY 1, 2),
l AS (SELECT gold AS label FROM c UNION SELECT pred FROM c),
f AS (SELECT label, coalesce((SELECT sum(n) FROM c WHERE gold = label AND pred = label), 0) AS tp, coalesce((SELECT sum(n) FROM c WHERE gold = label), 0) AS g, coalesce((SELECT sum(n) FROM c WHERE pred = label), 0) AS p FROM l)"""


def _confusion(spark, d):
    u = cur(spark, d, "labels.sentiment_6", "labels.sentiment_logit").where(F.col("labels.sentiment_6").isNotNull() & F.col("labels.sentiment_logit").isNotNull())
    pred = F.when(F.col("labels.sentiment_logit") > 0, "Positive").otherwise("Negative")
    return metrics.confusion(u.select(F.col("labels.sentiment_6").alias("g"), pred.alias("p")), "g", "p")


@query(_CONF + """, o AS (SELECT label AS x FROM l), cell AS (SELECT a.x AS gold, b.x AS pred, coalesce(n, 0) AS n FROM o a CROSS JOIN o b LEFT JOIN c ON c.gold = a.x AND c.pred = b.x)
SELECT gold, pred, n, round(coalesce(n * 100.0::DOUBLE / nullif(sum(n) OVER (PARTITION BY gold), 0), 0), 6) AS pct FROM cell""")
def confusion_matrix(spark, d):
    """Every cell with its count and share of the gold row."""
    return metrics.full_confusion(_confusion(spark, d)).withColumn("pct", F.round("pct", 6))


@query(_CONF + """ SELECT (SELECT round(sum(n) FILTER (gold = pred) / sum(n), 6) FROM c) AS accuracy, round(avg(CASE WHEN g + p > 0 THEN 2.0::DOUBLE * tp / (g + p) ELSE 0 END), 6) AS macro_f1 FROM f""")
def macro_f1(spark, d):
    """Accuracy and macro-F1."""
    return metrics.classification_metrics(_confusion(spark, d)).select(F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


@query(_CONF + """, r AS (SELECT label, g, coalesce(tp / nullif(p, 0), 0)::DOUBLE AS precision, coalesce(tp / nullif(g, 0), 0)::DOUBLE AS recall, coalesce(2.0::DOUBLE * tp / nullif(g + p, 0), 0)::DOUBLE AS f1 FROM f)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(g AS BIGINT) AS support FROM r
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(g) AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg', round(sum(precision * g) / sum(g), 6), round(sum(recall * g) / sum(g), 6), round(sum(f1 * g) / sum(g), 6), CAST(sum(g) AS BIGINT) FROM r""")
def class_report(spark, d):
    """Precision, recall, F1 and support of each class and on average."""
    out = metrics.report_with_averages(_confusion(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""WITH {_BITS}, p AS (SELECT unnest(b[1:32]) AS g, unnest(b[33:64]) AS p FROM bits), s AS (SELECT sum(CAST(g = p AS INT)) / count(*) AS acc, sum(g * p) AS tp, sum(g) AS g1, sum(p) AS p1, count(*) AS n, sum((1 - g) * (1 - p)) AS tn FROM p)
SELECT round(acc, 6) AS accuracy, round((2.0::DOUBLE * tp / (g1 + p1) + 2.0::DOUBLE * tn / (2 * n - g1 - p1)) / 2, 6) AS macro_f1, round(2.0::DOUBLE * tp / (g1 + p1), 6) AS f1_positive FROM s""")
def frame_metrics(spark, d):
    """Accuracy, macro-F1 and F1 of the positive class over frames."""
    conf = metrics.frame_confusion(_bits(spark, d), F.slice("b", 1, 32), F.slice("b", 33, 32))
    return metrics.frame_metrics(conf, 1).select(*[F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "f1_positive")])


@query("""WITH r AS (SELECT rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY user_id) + (count(*) OVER (PARTITION BY user_id) - 1) / 2.0::DOUBLE AS b FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL)
SELECT round(corr(a, b), 6) AS rho FROM r""")
def spearman(spark, d):
    """Rank correlation with average ranks."""
    return metrics.spearman(table(spark, d, "events"), "value", "user_id").select(F.round("rho", 6).alias("rho"))


@query("""WITH r AS (SELECT l_extendedprice AS g, l_quantity * 1500 AS p FROM lineitem), k AS (SELECT g, p, rank() OVER (ORDER BY g) + (count(*) OVER (PARTITION BY g) - 1) / 2.0::DOUBLE AS a, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS b FROM r)
SELECT round(avg((p - g) * (p - g)), 2) AS mse, round(avg(abs(p - g)), 4) AS mae, round(corr(a, b), 6) AS rho FROM k""")
def regression_metrics(spark, d):
    """Squared and absolute error and rank correlation."""
    t = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("g"), (F.col("l_quantity") * 1500).alias("p"))
    return metrics.regression_metrics(t, "g", "p").select(F.round("mse", 2).alias("mse"), F.round("mae", 4).alias("mae"), F.round("rho", 6).alias("rho"))


_EPOCHS = """WITH e AS (SELECT event_type AS run, CAST(day(ts) AS INT) AS epoch, round(CAST(sum(CAST(round_even(value * 100, 0) AS BIGINT)) AS DOUBLE) / count(*) / 100, 3) AS metric FROM events GROUP BY 1, 2)"""


def _epochs(spark, d):
    cents = F.sum(F.rint(F.col("value") * 100).cast("bigint")).cast("double") / F.count(F.lit(1)) / 100
    return table(spark, d, "events").groupBy(F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch")).agg(F.round(cents, 3).alias("metric"))


@query(_EPOCHS + " SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY run ORDER BY metric DESC NULLS LAST, epoch) = 1")
def best_epoch(spark, d):
    """The best epoch of each run."""
    return metrics.best_epoch(_epochs(spark, d), "run", "epoch", "metric")


@query(_EPOCHS + """, b AS (SELECT *, max(metric) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e)
SELECT run, epoch, metric, greatest(before, metric) AS best_so_far, coalesce(metric > before, true) AS improved FROM b""")
def running_best(spark, d):
    """Where a run got better."""
    return metrics.running_best(_epochs(spark, d), "run", "epoch", "metric")


@query("""SELECT DISTINCT instance_id, regexp_replace(instance_id, '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe FROM frame_records""")
def safe_names(spark, d):
    """Names for files."""
    return table(spark, d, "frame_records").select("instance_id", ids.sanitise_unicode("instance_id").alias("safe")).distinct()


@query(f"""WITH {CUR}, p AS (SELECT metadata.source_audio AS a, split_part(metadata.source_audio, '/', 1) AS first, regexp_replace(regexp_extract(metadata.source_audio, '[^/]*$'), '(.)\\.[^.]*$', '\\1') AS stem FROM cur)
SELECT CASE WHEN contains(a, '/') AND first NOT IN ('', 'audio') THEN first ELSE coalesce(nullif(regexp_extract(stem, '(?s)^(.*)_[^_]*$', 1), ''), nullif(substr(stem, 1, 2), ''), 'misc') END AS bucket, count(*) AS n FROM p GROUP BY 1""")
def audio_buckets(spark, d):
    """Folders of sources by their path."""
    b = cur(spark, d, "metadata.source_audio").select(ids.audio_bucket("metadata.source_audio").alias("bucket"))
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT file_id, min(start_t) AS start_t, max(end_t) AS end_t, count(*) AS n FROM tier_intervals GROUP BY file_id")
def file_domains(spark, d):
    """The span of each recording's tiers."""
    t = table(spark, d, "tier_intervals")
    return reshape.domains(t, "file_id").join(t.groupBy("file_id").agg(F.count(F.lit(1)).alias("n")), "file_id")


@query(f"""WITH {_TIERS}, f AS (SELECT file_id, max(e) / 1000.0::DOUBLE AS d FROM tiers GROUP BY 1), p AS (SELECT file_id, s / 1000.0::DOUBLE AS s, e / 1000.0::DOUBLE AS e FROM tiers WHERE tier = 'FilledPauses' AND e > s),
x AS (SELECT file_id, unnest(range(CAST(floor(d * 50) AS BIGINT))) AS t FROM f), h AS (SELECT DISTINCT x.file_id, t FROM x JOIN p ON p.file_id = x.file_id AND t >= floor(s * 50) AND t < ceil(e * 50))
SELECT x.file_id, list(CAST(h.t IS NOT NULL AS INT) ORDER BY x.t) AS frames FROM x LEFT JOIN h ON h.file_id = x.file_id AND h.t = x.t GROUP BY x.file_id
UNION ALL SELECT file_id, []::INT[] FROM f WHERE floor(d * 50) <= 0""")
def file_frames(spark, d):
    """One frame record per recording; recordings without events are all zero."""
    t = tiers(spark, d)
    files = t.groupBy("file_id").agg((F.max("end_ms") / 1000.0).alias("duration"))
    spans = tiers(spark, d, "FilledPauses").select("file_id", (F.col("start_ms") / 1000.0).alias("start_t"), (F.col("end_ms") / 1000.0).alias("end_t"))
    return reshape.file_frames(files, spans, rate=50).select("file_id", "frames")


@query(f"""WITH {_BITS}, e AS (SELECT vec_id, len(list_filter(range(1, 33), lambda i: b[i] <> b[i + 32])) / 32.0::DOUBLE AS err, 32 AS n, md5('speech-ml-pipeline::' || CAST(vec_id AS VARCHAR)) AS h FROM bits),
b AS (SELECT * FROM e ORDER BY err, vec_id LIMIT 5), w AS (SELECT * FROM e WHERE vec_id NOT IN (SELECT vec_id FROM b) ORDER BY err DESC, vec_id LIMIT 5),
r AS (SELECT * FROM e WHERE vec_id NOT IN (SELECT vec_id FROM b) AND vec_id NOT IN (SELECT vec_id FROM w) ORDER BY h LIMIT 5)
SELECT vec_id, err, n, 'best' AS tier FROM b UNION ALL SELECT vec_id, err, n, 'worst' FROM w UNION ALL SELECT vec_id, err, n, 'random' FROM r""")
def error_tiers(spark, d):
    """The best, the worst and some other records by frame error."""
    from tierflow.operators.splits import tiers as by_error

    g, p = F.slice("b", 1, 32), F.slice("b", 33, 32)
    e = _bits(spark, d).select("vec_id", frames.error_rate(g, p).alias("err"), F.lit(32).alias("n"))
    return by_error(e, "err", "n", "vec_id", 5)


