"""Readers, writers, codecs, streams and configuration."""

import wave

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import config
from tierflow.sources import audio, exb, records, textgrid
from tierflow.streaming import incremental

EXB = """<?xml version="1.0" encoding="UTF-8"?>
<basic-transcription><head><meta-information><referenced-file url="a.wav"/><ud-meta-information>
<ud-information attribute-name="SUBCORPUS">Art</ud-information></ud-meta-information></meta-information>
<speakertable><speaker id="S0"><abbreviation>A</abbreviation><sex value="f"/><ud-speaker-information><ud-information attribute-name="age">30</ud-information></ud-speaker-information></speaker></speakertable></head>
<basic-body><common-timeline><tli id="T0" time="0.0"/><tli id="T1" time="1.2345"/><tli id="T2"/></common-timeline>
<tier id="TIE0" speaker="S0" category="norm"><event start="T0" end="T1"> da </event><event start="T1" end="T2">ne</event></tier>
<tier id="TIE1" speaker="S0" category="colloq"><event start="T0" end="T9">x</event></tier></basic-body></basic-transcription>"""


def test_jsonl_readers(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1, "n": null}\n\n{"a": 2}\n{"a": \n', "utf-8")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    tolerant = records.read_jsonl_tolerant(spark, str(p), schema).cache()
    assert tolerant.where("_broken is not null").count() == 1 and tolerant.where("a is not null").count() == 2
    with pytest.raises((PySparkException, Py4JJavaError)):
        records.read_jsonl(spark, str(p), schema).collect()
    keys = records.read_raw(spark, str(p)).select(F.json_object_keys(F.to_json("v"))).collect()
    assert sorted(map(str, (k[0] for k in keys))) == ["None", "['a', 'n']", "['a']"]


def test_jsonl_writer_counts_and_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "č")], "a int, b string")
    assert records.write_jsonl(df, str(tmp_path / "out")) == 2
    text = "".join(f.read_text("utf-8") for f in (tmp_path / "out").glob("part-*"))
    assert '"b":null' in text and "č" in text
    assert records.write_recipes({"x": df, "empty": df.limit(0)}, str(tmp_path / "r")) == {"x": 2}
    assert not (tmp_path / "r/empty").exists()


def test_lookup_checks_its_columns(spark, tmp_path):
    p = tmp_path / "l.csv"
    p.write_text("file_id,split\na,train\nb,nope\n")
    with pytest.raises(ValueError):
        records.read_lookup(spark, str(p), "wav_stem")
    with pytest.raises((PySparkException, Py4JJavaError)):
        records.read_lookup(spark, str(p), "file_id").collect()


def test_split_partitions_are_pruned(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, "train").otherwise("dev").alias("split"))
    records.write_by(df, str(tmp_path / "t"), "split")
    part = spark.read.parquet(str(tmp_path / "t")).where("split = 'dev'")
    assert part.count() == 50
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_exb(spark, tmp_path):
    (tmp_path / "a.exb").write_text(EXB, "utf-8")
    files = exb.read_exb(spark, str(tmp_path))
    rows = {(r.tier, r.idx): (r.start_t, r.end_t, r.label) for r in exb.intervals(files).collect()}
    assert rows == {("norm", 0): (0.0, 1.234, "da"), ("norm", 1): (1.234, None, "ne"), ("colloq", 0): (0.0, None, "x")}
    s = exb.speakers(files).first()
    assert (s.speaker, s.sex, s.abbreviation, s["info"]) == ("S0", "f", "A", {"age": "30"})
    f = exb.file_facts(files).first()
    assert (f.subcorpus, f.audio, f.duration, f.categories) == ("Art", "a.wav", 1.2345, ["colloq", "norm"])
    assert exb.coverage(exb.file_facts(files)).count() == 2


@pytest.mark.parametrize("encoding", ["utf-8", "utf-16", "latin-1"])
def test_textgrid_round_trip(spark, tmp_path, encoding):
    rows = [("f", 1, "words", 0, 0.0, 0.5, 'a "b" é 12'), ("f", 1, "words", 1, 0.5, 1.0, ""), ("f", 2, "words", 0, 0.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "base string, place int, tier string, idx int, start_t double, end_t double, label string")
    content = textgrid.to_textgrid(df).first().content
    (tmp_path / "f.l.TextGrid").write_bytes(content.encode(encoding))
    back = sorted(tuple(r)[1:] for r in textgrid.read_textgrids(spark, str(tmp_path)).collect())
    assert back == [
        ("words", "interval", 0, 0.0, 0.5, 'a "b" é 12'), ("words", "interval", 1, 0.5, 1.0, ""), ("words_2", "interval", 0, 0.0, 1.0, "x")
    ]


def test_wav_headers_and_cutting(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setparams((1, 2, 16000, 0, "NONE", ""))
        w.writeframes(b"\0\0" * 24000)
    (tmp_path / "b.wav").write_bytes(b"no audio")
    got = {r.path.rsplit("/", 1)[-1]: (r.duration, r.error is None) for r in audio.wav_durations(spark, str(tmp_path)).collect()}
    assert got == {"a.wav": (1.5, True), "b.wav": (None, False)}
    rows = [("s", 0.0, 1.0, "new"), ("s", 0.0, 1.0, "there"), (None, 0.0, 1.0, "gone"), ("s", 1.0, 1.0, "empty")]
    df = spark.createDataFrame(rows, "source_path string, start_t double, end_t double, audio_path string")
    out = audio.cut_dataset(df, lambda *a: None, lambda p: p == "there")
    assert {r.audio_path: r.outcome for r in out.collect()} == {"new": "kept", "there": "skipped_existing", "gone": "missing_source", "empty": "cut_failed"}


def test_streams_work_on_new_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"a": 1}\n')
    run = lambda: incremental.run_once(records.stream_jsonl(spark, str(tmp_path / "in"), "a int"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    run()
    (tmp_path / "in/2.json").write_text('{"a": 2}\n')
    run()
    assert sorted(r.a for r in spark.read.schema("a int").json(str(tmp_path / "out")).collect()) == [1, 2]


def test_windowed_counts_take_timestamps_without_zone(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:01:00' as ts, 'x' as k union all select timestamp_ntz'2024-01-01 00:07:00', 'x'")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = incremental.windowed_counts(stream, "ts", "5 minutes", "1 minute", "k").writeStream.format("memory").queryName("wc").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.sql("select n from wc").collect()) == [1, 1]


def test_config_layers_and_guards():
    t = config.layered(config.Task, {"name": "x", "paths": ("a",), "label": "y"}, {"label": "z", "_note": 1})
    assert t.label == "z"
    with pytest.raises(ValueError):
        config.layered(config.Task, {"name": "x", "paths": (), "label": "y", "labl": 1})
    with pytest.raises(ValueError):
        config.Task("x", (), "y", kind="other")
    assert config.parse_ratio("8:1:1") == (0.8, 0.1, 0.1) and config.parse_range("2-15") == (2.0, 15.0)
    assert config.expand(["all", "a"], {"all": ["a", "b"]}) == ["a", "b"]


def test_download_plan(spark):
    files = spark.createDataFrame([("d", "a", 10.0, False), ("d", "b", 20.0, False), ("e", "c", 99.0, True)], "dataset string, name string, size_mb double, is_large boolean")
    have = spark.createDataFrame([("d", "a", 10.0), ("d", "b", 5.0)], "dataset string, name string, size_mb double")
    plan = config.download_plan(files, have, skip_large=True)
    assert {r.name: r.action for r in plan.collect()} == {"a": "skip", "b": "resume", "c": "skip"}
    assert {r.dataset: r.mb_to_fetch for r in config.plan_totals(plan).collect()} == {"d": 15.0, "e": 0.0, "TOTAL": 15.0}


def test_markdown_refuses_long_tables(spark):
    assert records.markdown(spark.createDataFrame([("a|b", 1.5, None)], "x string, y double, z int")).splitlines()[2] == "| a\\|b | 1.500 |  |"
    with pytest.raises(ValueError):
        records.markdown(spark.range(5), most=4)
