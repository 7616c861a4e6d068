"""Whole runs on small tables."""

from pyspark.sql import functions as F

from tierflow.common import current, table
from tierflow.operators import splits
from tierflow.plans import pipelines

DIR = "/root/testdata/sf0.001"


def test_prepare_corpus(spark):
    raw = current(table(spark, DIR, "utterances"))
    out = pipelines.prepare_corpus(raw)
    records, frames = out["utterance"], out["frames"]
    assert records.where("not split in ('train', 'dev', 'test')").count() == 0
    null = records.where("metadata.filled_pauses is null and labels.filled_pause_count is not null").count()
    assert null == 0 and frames.join(records.where("metadata.filled_pauses is null"), "instance_id").count() == 0
    off = F.abs(F.size("labels.filled_pause") - F.rint(F.col("metadata.audio_length") * 50)) > 1
    assert frames.where("metadata.audio_length > 0").where(off).count() == 0


def test_build_subset(spark):
    u = current(table(spark, DIR, "utterances")).where("speaker is not null")
    out = pipelines.build_subset([u], (1.0, 15.0), (0.8, 0.1, 0.1), n=200)
    assert splits.leaks(out, "speaker").count() == 0
    assert abs(out.count() - 200) <= 3
    assert out.where("metadata.audio_length < 1 or metadata.audio_length > 15").count() == 0


def test_inference_goes_on_where_it_stopped(spark):
    audio = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "audio_path string, duration_s double")
    done = audio.where("audio_path = 'b'")

    def model(chunks):
        preds = F.array(*[F.lit(int(x)) for x in "0111000111"])
        return chunks.withColumn("preds", preds).withColumn("probs", F.transform(preds, lambda p: p.cast("double")))

    out = pipelines.infer_events(audio, done, model, {1: "fp"}, 0.1, chunk_s=1.0).collect()
    assert [r.audio_path for r in out] == ["a"]
    spans = [(e.start_s, e.end_s) for e in out[0].raw_events]
    assert spans == [(0.1, 0.4), (0.7, 1.0), (1.1, 1.4), (1.7, 2.0)]  # runs end with their chunk
    assert [(e.start_s, e.end_s) for e in out[0].postproc_events] == spans[:3]


def test_annotation_pack(spark):
    u = current(table(spark, DIR, "utterances"))
    out = pipelines.annotation_pack(u, {"F": 8, "M": 8}, per_folder=4).collect()
    assert [r["index"] for r in sorted(out, key=lambda r: r["index"])] == list(range(len(out)))
    assert {r.folder for r in out} <= {f"batch_0{i}" for i in range(4)} and all(r.n_pauses >= 1 for r in out)


def test_stress_words(spark):
    schema = "file_id string, idx int, start_ms bigint, end_ms bigint, label string"
    words = spark.createDataFrame([("f", 0, 0, 100, "da"), ("f", 1, 100, 200, " "), ("f", 2, 200, 300, "ne")], schema)
    marks = spark.createDataFrame([("f", 0, 10, 20, "1"), ("f", 1, 30, 40, "1"), ("f", 2, 120, 130, "1"), ("f", 3, 210, 220, "0")], schema)
    out, notes = pipelines.stress_words(words, marks)
    assert {r.idx: r.n_marks for r in out.collect()} == {0: 2, 2: 0}
    assert sorted((r.idx, r.note) for r in notes.collect()) == [(0, "multiple_primary_per_word"), (2, "stress_outside_word")]


def test_files_too_long_by_their_header(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "audio_path string")
    heads = spark.createDataFrame([("a", 1.0), ("b", 99.0)], "path string, duration double")
    assert sorted(r.audio_path for r in pipelines.drop_long(df, heads, 10).collect()) == ["a", "c"]
