"""Unions, unpivots, explosions and tier surgery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions import frames as fr
from tierflow.functions import ids
from tierflow.functions.values import word_text
from tierflow.operators.periods import periods_and_gaps


def pool(*tables: DataFrame) -> DataFrame:
    """All rows of several tables; columns that one lacks are NULL there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def unpivot_tasks(df: DataFrame, tasks: dict[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """keep, task, label (as text), split of each task's (label, split) columns; rows without either drop out."""
    one = [F.struct(F.lit(t).alias("task"), F.col(a).cast("string").alias("label"), F.col(b).cast("string").alias("split")) for t, (a, b) in tasks.items()]
    long = df.select(*keep, F.inline(F.array(*one)))
    return long.where("label is not null and coalesce(split, '') <> ''")


def word_rows(df: DataFrame, words: Column, stress: Column, rate: int) -> DataFrame:
    """One row per word: instance_id#wN, its text and its stress frames.

    ``words``: array<struct<time_s,time_e,char_s,char_e,text>>, ``stress``:
    array<struct<words_align_idx,raw array<double>>>. Marks outside the words or
    without two bounds give no frames; words shorter than a frame have no row."""
    marks = lambda i: F.filter(stress, lambda p: (p["words_align_idx"] == i) & (F.size(p["raw"]) == 2))
    rows = F.transform(
        words,
        lambda w, i: F.struct(
            i.alias("word_idx"), w.alias("word"),
            F.transform(marks(i), lambda p: F.struct(p["raw"][0].alias("time_s"), p["raw"][1].alias("time_e"))).alias("marks"),
        ),
    )
    long = df.select("instance_id", "text", F.inline_outer(rows)).where("word is not null")
    length = F.col("word.time_e") - F.col("word.time_s")
    return (
        long.withColumn("primary_stress", fr.rasterise_rounded("marks", length, rate, offset=F.col("word.time_s")))
        .where(F.size("primary_stress") > 0)
        .select(
            F.concat_ws("#w", "instance_id", F.col("word_idx").cast("string")).alias("instance_id"),
            word_text("text", "word.char_s", "word.char_e", F.col("word.text")).alias("text"),
            "word_idx", F.bround(length, 3).alias("audio_length"), F.size("marks").alias("n_stress_marks"),
            (F.size("marks") > 1).alias("multistress"), "primary_stress",
        )
    )


def event_rows(parents: DataFrame, events: Column, label: str = "fp_type", placeholder: str = "?") -> DataFrame:
    """One row per event of a parent: its id, absolute times (parents without start_t begin at 0), the label
    (placeholder is NULL), and what it takes over from the parent."""
    rows = parents.select("*", F.posexplode(events).alias("_i", "_e"))
    base = F.coalesce("start_t", F.lit(0.0))
    a, b = F.bround(F.col("_e.start_s"), 3), F.bround(F.col("_e.end_s"), 3)
    return rows.select(
        ids.event_id("instance_id", F.col("_i") + 1, a, b).alias("instance_id"), F.col("instance_id").alias("source_utterance_id"),
        "dataset", "file_id", "speaker", "split", (F.col("_i") + 1).alias("event_index"),
        F.bround(base + a, 3).alias("start_t"), F.bround(base + b, 3).alias("end_t"),
        F.nullif(F.col("_e.label"), F.lit(placeholder)).alias(label), F.col("_e.label").alias("raw_label"),
    )


def merge_tiers(tiers: DataFrame, recipe: list[str]) -> DataFrame:
    """Layers in the order of the recipe as tiers of one file; a tier name met before becomes layer_tier.

    ``tiers``: base, layer, tier, tier_pos, and interval columns. Adds new_tier, place."""
    at = F.array_position(F.array(*[F.lit(x) for x in recipe]), F.col("layer"))
    names = tiers.where(F.col("layer").isin(*recipe)).select("base", "layer", "tier", "tier_pos", at.alias("_r")).distinct()
    w = Window.partitionBy("base", "tier").orderBy("_r", "tier_pos")
    p = Window.partitionBy("base").orderBy("_r", "tier_pos")
    named = names.withColumn("new_tier", F.when(F.row_number().over(w) > 1, F.concat_ws("_", "layer", "tier")).otherwise(F.col("tier"))).withColumn("place", F.row_number().over(p))
    return tiers.join(named.drop("_r"), ["base", "layer", "tier", "tier_pos"])


def domains(tiers: DataFrame, base: str = "base") -> DataFrame:
    """Per file the span of all its layers."""
    return tiers.groupBy(base).agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"))


def mimic_tier(tier: DataFrame, name: str, placeholder: str = "?") -> DataFrame:
    """The same boundaries under another name; filled labels become the placeholder."""
    filled = F.trim(F.coalesce("label", F.lit(""))) != ""
    return tier.withColumn("tier", F.lit(name)).withColumn("label", F.when(filled, placeholder).otherwise(""))


def instruction_tier(spans: DataFrame, name: str, text: str) -> DataFrame:
    """One interval over the whole span of each file."""
    return spans.withColumn("tier", F.lit(name)).withColumn("idx", F.lit(1)).withColumn("label", F.lit(text))


def window_records(df: DataFrame, pauses: Column, duration: Column, context: float, rate: int) -> DataFrame:
    """``df`` with start_t, end_t of the window around its events and filled_pause, the frames of the window."""
    w = df.withColumn("_w", fr.window_around(pauses, duration, F.lit(context)))
    frames = fr.rasterise_rounded(pauses, duration, rate)
    return w.select(
        *df.columns, F.col("_w.lo").alias("window_start"), F.col("_w.hi").alias("window_end"),
        fr.frame_slice(frames, F.col("_w.lo"), F.col("_w.hi"), F.lit(rate)).alias("filled_pause"),
    ).where("filled_pause is not null")


def file_frames(files: DataFrame, spans: DataFrame, key: str = "file_id", rate: int = 50) -> DataFrame:
    """One frame record per file: any overlap of any speaker's span counts; no spans give zeros, no duration no row.

    Spans are put in frames and merged first, so that what meets in a file's row is
    no longer than its frames, however many spans it has."""
    touched = spans.where("end_t > start_t").select(
        F.col(key).alias("item"), F.lit("frames").alias("layer"),
        F.floor(F.col("start_t") * rate).alias("start_ms"), F.ceil(F.col("end_t") * rate).alias("end_ms"),
    )
    merged = periods_and_gaps(touched).where("kind = 'period'")
    last = F.lit((1 << 31) - 1)
    place = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), last).cast("int")
    per = merged.groupBy(F.col("item").alias(key)).agg(F.collect_list(F.struct(place("start_ms").alias("first"), place("end_ms").alias("past"))).alias("_spans"))
    joined = files.join(per, key, "left").where("duration is not null")
    every = F.coalesce("_spans", F.array().cast("array<struct<first:int,past:int>>"))
    return joined.withColumn("frames", fr.covered(every, F.floor(F.col("duration") * rate).cast("int"))).drop("_spans")
