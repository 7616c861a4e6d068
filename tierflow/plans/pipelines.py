"""Whole runs put together from the operators: preparation, subsets, inference, annotation packs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import values
from tierflow.functions.ids import draw
from tierflow.operators import clean, events, joins, reshape, splits

#: The six classes of sentiment on a scale.
SENTIMENT_SCALE = {"M_Negative": 0.0, "Negative": 1.0, "NeutralNeg": 2.0, "NeutralPos": 3.0, "Positive": 4.0, "M_Positive": 5.0}


def prepare_corpus(raw: DataFrame, rate: int = 50, shortest: float = 0.1, context: float = 2.0) -> dict[str, DataFrame]:
    """Recipes of a corpus: 'utterance' records and 'frames' around the filled pauses.

    ``raw`` has the canonical columns. Records shorter than ``shortest`` are dropped,
    labels derived, missing splits assigned by recording; a recording without
    filled_pauses (NULL, not []) has no frames."""
    info = F.col("metadata.speaker_info")
    length = F.col("metadata.audio_length")
    pauses = F.col("metadata.filled_pauses")
    kept = raw.where(F.bround(length, 3) >= shortest)
    labelled = kept.withColumn(
        "labels",
        F.struct(
            values.known_gender(info["speaker_gender"]).alias("speaker_gender"),
            values.age(info["date"], info["speaker_birth"]).alias("speaker_age"),
            F.when(pauses.isNotNull(), (F.size(pauses) > 0).cast("int")).alias("filled_pause_present"),
            values.count_or_null(pauses).alias("filled_pause_count"),
            F.col("labels.sentiment_logit").alias("sentiment_logit"),
            F.col("labels.sentiment_6").alias("sentiment_6"),
        ),
    )
    records = splits.assign_splits(labelled, "file_id")
    frames = reshape.window_records(records.where(length.isNotNull()), pauses, length, context, rate)
    framed = frames.select(
        "instance_id", "dataset", "file_id", "audio_path", "split", "speaker",
        F.col("window_start").alias("start_t"), F.col("window_end").alias("end_t"), F.lit(rate).alias("frame_rate_hz"),
        F.struct("filled_pause").alias("labels"),
        F.struct((F.col("window_end") - F.col("window_start")).alias("audio_length"), length.alias("full_audio_length")).alias("metadata"),
    )
    return {"utterance": records, "frames": framed}


def build_subset(
    tables: list[DataFrame], duration: tuple[float, float], ratio: tuple[float, float, float], speaker_disjoint: bool = True,
    balance: list[Column] | None = None, hours: float | None = None, n: int | None = None, seed: str = splits.SEED,
) -> DataFrame:
    """A subset of several corpora: length bounds, sentiment as a number, new splits, balanced train, capped.

    Rows in seeded order. A target of hours is enforced as a fraction of rows."""
    df = reshape.pool(*tables)
    length = F.col("metadata.audio_length")
    df = clean.duration_filter(df, length, *duration).where("reason is null").drop("reason")
    df = df.withColumn("sentiment_f", values.scaled("labels.sentiment_6", SENTIMENT_SCALE))
    if speaker_disjoint:
        who = splits.speaker_disjoint(df, "speaker", ratio, seed).withColumnRenamed("split", "_split").drop("n")
        df = df.join(who.withColumnRenamed("speaker", "_who"), F.col("speaker").eqNullSafe(F.col("_who"))).withColumn("split", F.col("_split")).drop("_split", "_who")
    else:
        df = df.withColumn("split", splits.hash_split(F.lit(None), F.col("instance_id"), ratio, seed))
    if balance:
        df = splits.balance_train(df, balance, seed=seed)
    if hours is not None:
        df = splits.cap_fraction(df, splits.fraction_for_hours(df, length, hours), seed=seed)
    if n is not None:
        df = splits.cap_fraction(df, min(1.0, n / max(df.count(), 1)), seed=seed)
    return df.orderBy(draw(seed, "instance_id"))


def infer_events(
    audio: DataFrame, done: DataFrame | None, model: Callable[[DataFrame], DataFrame], labels: dict[int, str], frame_s: float,
    chunk_s: float = 30.0, shortest: float | None = 0.08,
) -> DataFrame:
    """Events of recordings (audio_path, duration_s) not yet done: chunk, model, runs, post-filters.

    ``model`` maps chunks (audio_path, chunk, start_s, end_s) to chunks with preds
    and probs. Runs never go on in another chunk."""
    todo = audio if done is None else joins.todo(audio, done, "audio_path")
    chunks = todo.select("audio_path", "duration_s", F.posexplode(events.chunk_spans("duration_s", chunk_s)).alias("chunk", "_c")).select(
        "audio_path", "duration_s", "chunk", "_c.start_s", "_c.end_s"
    )
    found = model(chunks).withColumn("_e", events.frames_to_events("preds", "probs", labels, F.lit(frame_s), chunk_start=F.col("start_s")))
    per_file = found.groupBy("audio_path", "duration_s").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "start_s", "end_s", "_e"))).alias("_chunks")
    )
    raw = F.flatten(F.transform("_chunks", lambda c: c["_e"]))
    return per_file.select(
        "audio_path", "duration_s", F.transform("_chunks", lambda c: F.struct(c["start_s"], c["end_s"])).alias("chunks"),
        raw.alias("raw_events"), events.postprocess(raw, "duration_s", shortest=shortest).alias("postproc_events"),
    )


def eligible_for_annotation(df: DataFrame, least_events: int, duration: tuple[float, float], synonyms: dict[str, str]) -> DataFrame:
    """``df`` with gender and reason: 'few_events', 'short', 'long', 'no_gender' (the first that holds) or NULL."""
    length = F.coalesce(F.col("metadata.audio_length"), F.lit(0.0))
    gender = values.mapped_gender("metadata.speaker_info.speaker_gender", synonyms)
    reason = (
        F.when(F.coalesce(F.size("metadata.filled_pauses"), F.lit(0)) < least_events, "few_events")
        .when(length < duration[0], "short").when(length > duration[1], "long").when(gender.isNull(), "no_gender")
    )
    return df.withColumn("gender", gender).withColumn("reason", reason)


def annotation_pack(df: DataFrame, quotas: dict[str, int], least_events: int = 1, duration: tuple[float, float] = (2.0, 15.0), synonyms: dict[str, str] | None = None, per_folder: int = 50) -> DataFrame:
    """The manifest of an annotation pack: eligible records, quotas wide before deep, numbered and foldered."""
    words = synonyms or {"f": "F", "m": "M"}
    ok = eligible_for_annotation(df, least_events, duration, words).where("reason is null and speaker is not null")
    chosen = splits.interleave(splits.select_quota(ok, "gender", "speaker", quotas), "gender", per_folder=per_folder)
    name = F.format_string("%s_%s_fp%d", "number", "instance_id", F.size("metadata.filled_pauses"))
    return chosen.select("index", "folder", name.alias("name"), "instance_id", "gender", "speaker", "audio_path", F.col("metadata.audio_length").alias("audio_length"), F.size("metadata.filled_pauses").alias("n_pauses"))


def drop_long(df: DataFrame, headers: DataFrame, longest: float, key: str = "audio_path") -> DataFrame:
    """``df`` without the rows whose file header says they are too long; unreadable files stay."""
    known = headers.select(F.col("path").alias(key), F.col("duration").alias("_d"))
    return df.join(known, key, "left").where(F.col("_d").isNull() | (F.col("_d") <= longest)).drop("_d")


def stress_words(words: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words with n_marks, and notes ('stress_outside_word', 'multiple_primary_per_word').

    Both have file_id, idx, start_ms, end_ms, label; only marks labelled '1' count, blank words are none."""
    filled = words.where(F.trim(F.coalesce("label", F.lit(""))) != "")
    placed = joins.marks_in_words(marks.where("label = '1'"), filled, ["file_id"], ["file_id", "idx"])
    per = placed.where("word_idx is not null").groupBy("file_id", F.col("word_idx").alias("idx")).agg(F.count(F.lit(1)).alias("n_marks"))
    out = filled.join(per, ["file_id", "idx"], "left").withColumn("n_marks", F.coalesce("n_marks", F.lit(0)))
    many = out.where("n_marks > 1").select("file_id", "idx", F.lit("multiple_primary_per_word").alias("note"))
    return out, placed.where("note is not null").select("file_id", "idx", "note").unionByName(many)
