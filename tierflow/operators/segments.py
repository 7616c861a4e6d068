"""Records of annotated dialogue: the segments of a driving tier with what other tiers say of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import ids
from tierflow.functions.values import first_filled
from tierflow.operators import joins

ITEM = ["file_id", "speaker", "idx", "start_ms", "end_ms"]


def annotated_segments(tiers: DataFrame, driving: str = "norm", order: list[str] | None = None) -> DataFrame:
    """The driving tier's intervals with colloq, act_function, act_dimension (labels at the same
    place of the same speaker), curated, annotated (the first span that holds them) and disfluencies (how many overlap).

    ``tiers``: file_id, tier, speaker, idx, start_ms, end_ms, label; what a corpus lacks is NULL or 0."""
    of = lambda name: tiers.where(F.col("tier") == name).drop("tier")
    same = {"colloq": of("colloq"), "act_function": of("dialogueActsIsoFunction"), "act_dimension": of("dialogueActsIsoDimension")}
    out = joins.align_tiers(of(driving), same, order or ["idx", "label"])
    for name, tier in (("curated", "sentimentCurated"), ("annotated", "sentimentAnnotated")):
        out = joins.containing_label(out, of(tier), ["file_id"], ITEM).withColumnRenamed("outer_label", name)
    return joins.overlap_counts(out, of("vocalDisfluency"), ["file_id", "speaker"], ITEM).withColumnRenamed("n", "disfluencies").drop("flag")


def segment_records(segments: DataFrame, dataset: str, folder: str, least_chars: int = 0) -> DataFrame:
    """Canonical records of annotated_segments.

    text: the driving label, else the colloquial one, else ''. The curated sentiment
    goes before the annotated one; empty labels are NULL. Records with less than
    ``least_chars`` characters drop out. All begin in the train split."""
    t = lambda c: F.col(c) / F.lit(1000.0)
    time = lambda c: F.format_string("%.3f", t(c))
    filled = lambda *c: first_filled(*c)
    name = F.concat_ws("_", "file_id", F.coalesce("speaker", F.lit("")), time("start_ms"), time("end_ms"))
    out = segments.select(
        ids.instance_id(F.lit(dataset), "file_id", "speaker", t("start_ms"), t("end_ms")).alias("instance_id"),
        F.lit(dataset).alias("dataset"), "file_id", F.concat(F.lit(f"{folder.rstrip('/')}/"), name, F.lit(".wav")).alias("audio_path"),
        F.lit("train").alias("split"), "speaker", t("start_ms").alias("start_t"), t("end_ms").alias("end_t"),
        F.coalesce(filled("label", "colloq"), F.lit("")).alias("text"),
        F.struct(
            filled("curated", "annotated").alias("sentiment"), filled("annotated").alias("sentiment_annotated"),
            filled("act_function").alias("dialogue_act_function"), filled("act_dimension").alias("dialogue_act_dimension"),
            (F.col("disfluencies") > 0).cast("int").alias("filled_pause_present"), F.col("disfluencies").cast("int").alias("disfluency_count"),
        ).alias("labels"),
        F.struct(F.concat("file_id", F.lit(".exb")).alias("source_file"), F.lit("EXB").alias("source_format"), F.col("colloq").alias("colloq_text")).alias("metadata"),
    )
    return out.where(F.length("text") >= least_chars)
