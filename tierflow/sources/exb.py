"""EXMARaLDA annotation files by the built-in XML source, with an explicit schema.

One row per file; timeline, tiers and speakers are arrays that higher-order
functions turn into long tables, so a file's parts never need a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.values import strip

_UD = "ARRAY<STRUCT<`_attribute-name`: STRING, _VALUE: STRING>>"
SCHEMA = f"""
head STRUCT<
  `meta-information`: STRUCT<`referenced-file`: ARRAY<STRUCT<_url: STRING>>, `ud-meta-information`: STRUCT<`ud-information`: {_UD}>>,
  speakertable: STRUCT<speaker: ARRAY<STRUCT<_id: STRING, abbreviation: STRING, sex: STRUCT<_value: STRING>,
    `ud-speaker-information`: STRUCT<`ud-information`: {_UD}>>>>>,
`basic-body` STRUCT<
  `common-timeline`: STRUCT<tli: ARRAY<STRUCT<_id: STRING, _time: DOUBLE>>>,
  tier: ARRAY<STRUCT<_id: STRING, _speaker: STRING, _category: STRING, event: ARRAY<STRUCT<_start: STRING, _end: STRING, _VALUE: STRING>>>>>
"""
META = "head.`meta-information`"
TLI = "`basic-body`.`common-timeline`.tli"


def read_exb(spark: SparkSession, path: str) -> DataFrame:
    """path and the parsed file."""
    return spark.read.format("xml").option("rowTag", "basic-transcription").option("ignoreSurroundingSpaces", False).schema(SCHEMA).load(path).select(
        F.col("_metadata.file_path").alias("path"), "head", "basic-body"
    )


def timeline() -> Column:
    """map of time point id -> seconds; points without a time are left out."""
    timed = F.filter(F.coalesce(F.col(TLI), F.array()), lambda t: t["_time"].isNotNull())
    return F.map_from_entries(F.transform(timed, lambda t: F.struct(t["_id"], t["_time"])))


def intervals(files: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """path, tier, speaker, idx, start_t, end_t, label: every event; unresolved bounds are NULL, labels stripped."""
    tiers = files.select("path", timeline().alias("_t"), F.explode("`basic-body`.tier").alias("tier"))
    if categories is not None:
        tiers = tiers.where(F.col("tier._category").isin(*categories))
    time = lambda c: F.bround(F.try_element_at("_t", F.col(c)), 3)
    return tiers.select("path", "_t", F.col("tier._category").alias("tier"), F.col("tier._speaker").alias("speaker"), F.posexplode("tier.event").alias("idx", "e")).select(
        "path", "tier", "speaker", "idx", time("e._start").alias("start_t"), time("e._end").alias("end_t"),
        strip(F.coalesce("e._VALUE", F.lit(""))).alias("label"),
    )


def _entries(ud: Column) -> Column:
    return F.map_from_entries(F.transform(F.coalesce(ud, F.array()), lambda u: F.struct(u["_attribute-name"], u["_VALUE"])))


def speakers(files: DataFrame) -> DataFrame:
    """path, speaker, sex, abbreviation, info (map of the open attributes)."""
    s = files.select("path", F.explode("head.speakertable.speaker").alias("s"))
    return s.select("path", F.col("s._id").alias("speaker"), F.col("s.sex._value").alias("sex"), "s.abbreviation", _entries(F.col("s.`ud-speaker-information`.`ud-information`")).alias("info"))


def file_facts(files: DataFrame, unknown: str = "unknown") -> DataFrame:
    """path, subcorpus, audio (first referenced file), duration (last time point), categories."""
    meta = _entries(F.col(f"{META}.`ud-meta-information`.`ud-information`"))
    return files.select(
        "path", F.coalesce(F.try_element_at(meta, F.lit("SUBCORPUS")), F.lit(unknown)).alias("subcorpus"),
        F.try_element_at(F.col(f"{META}.`referenced-file`"), F.lit(1))["_url"].alias("audio"),
        F.array_max(F.transform(TLI, lambda t: t["_time"])).alias("duration"),
        F.array_sort(F.array_distinct(F.transform("`basic-body`.tier", lambda t: F.coalesce(t["_category"], F.lit("<none>"))))).alias("categories"),
    )


def coverage(facts: DataFrame) -> DataFrame:
    """Files per tier category and subcorpus."""
    return facts.select("path", "subcorpus", F.explode("categories").alias("category")).groupBy("category", "subcorpus").agg(F.count_distinct("path").alias("files"))
