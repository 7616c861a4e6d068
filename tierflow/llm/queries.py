"""Queries of the operators for training data, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.common import cut, current, ms, table
from tierflow.llm import encode, encoding_repair, group_split, mix, packing, pieces, quota_sample, vocabulary


def _current(spark: SparkSession, sf_dir: str, *paths: str) -> DataFrame:
    return current(table(spark, sf_dir, "utterances"), payload=paths)


def _limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pack_limits").select("dataset", ms("capacity_s").alias("capacity_ms"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = packing.utterance_lengths(_current(spark, sf_dir, "dataset", "metadata.audio_length", "start_t", "end_t"))
    return packing.pack(lengths, _limits(spark, sf_dir))


def p1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """container, instance_id, dataset, part, parts, start_ms, end_ms of every part of every utterance."""
    return _packed(spark, sf_dir)


def p1_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and free room per data set."""
    return packing.fill_report(cut(_packed(spark, sf_dir)), _limits(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The utterances that the packing put into more than one container."""
    return packing.divided(_packed(spark, sf_dir))


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, term, id, occurrences, records, mark."""
    fields = ["speaker", "sentiment_6", "dialogue_act_function", "fp_type"]
    return vocabulary.term_frequencies(vocabulary.utterance_terms(_current(spark, sf_dir, "speaker", *[f"labels.{f}" for f in fields[1:]])), fields)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_terms(spark, sf_dir).where("mark is not null").select("field", "term", "mark")


def _sample(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = cut(quota_sample.eligible(_current(spark, sf_dir, "metadata.speaker_info.lang", "metadata.speaker_info.speaker_gender", "labels.sentiment_6")))
    targets = quota_sample.targets_of(table(spark, sf_dir, "sample_targets"))
    return quota_sample.quota_sample(rows, targets, ["lang", "gender", "sentiment_6"])


def p4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """instance_id, lang, gender, sentiment_6 of the drawn utterances."""
    return _sample(spark, sf_dir)[0]


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir)[1]


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir)[1].where("short").select("lang", "gender", "sentiment_6")


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_split.entities(_current(spark, sf_dir, "file_id", "speaker", "split"), table(spark, sf_dir, "speakers"))


def p5_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """instance_id, kind, entity, new_split; no entity is in two splits."""
    members = cut(_members(spark, sf_dir))
    return group_split.assign(members, [("train", 0.8), ("dev", 0.1), ("test", 0.1)]).select(
        "instance_id", "kind", "entity", "new_split"
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_split.straddling(_members(spark, sf_dir)).select("entity").distinct()


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every frame record with its bounds and labels."""
    return pieces.pieces(table(spark, sf_dir, "frame_records"), table(spark, sf_dir, "pack_limits"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that were cut."""
    return p6_pieces(spark, sf_dir).where("piece = 1").select("instance_id").distinct()


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_texts(table(spark, sf_dir, "documents"), "text", "ids", keep=["doc_id"])


def _mixture(spark: SparkSession, sf_dir: str) -> mix.Mixture:
    return mix.Mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens, copies."""
    return _mixture(spark, sf_dir).copies()


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).report()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).targets_report().where("short").select("source")


def p10_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, status, chain, words, text of the documents with garbled stretches."""
    documents = table(spark, sf_dir, "documents")
    return encoding_repair.repair(documents, encoding_repair.fit(documents)).where("status <> 'clean'")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_repair(spark, sf_dir).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_pack, p1_fill, p2_found, p2_terms, p4_found, p4_sample, p4_report, p5_found, p5_split,
        p6_found, p6_pieces, p8_ids, p9_found, p9_mix, p9_report, p10_found, p10_repair,
    )
}
