"""Sources and sinks, codecs, islands, ranks, scores and plans added to the core."""

import random
import wave

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tierflow import common, config
from tierflow.functions import frames, values
from tierflow.operators import clean, events, joins, metrics, profile, splits
from tierflow.plans import registry
from tierflow.sources import audio, records, textgrid


def test_pcm_is_cut_and_resampled(tmp_path):
    rate, source = 44_100, str(tmp_path / "a.wav")
    tone = 0.5 * np.sin(np.arange(rate * 2) * 2 * np.pi * 200 / rate)
    audio.write_pcm16(source, tone, rate)
    audio.cut_pcm(source, 0.5, 1.25, str(tmp_path / "b.wav"))
    out, own = audio.pcm_samples(str(tmp_path / "b.wav"))
    assert own == 16_000 and len(out) == 12_000
    want = 0.5 * np.sin((np.arange(12_000) / 16_000 + 0.5) * 2 * np.pi * 200)
    assert np.abs(out - want).max() < 2e-3
    with pytest.raises(ValueError):
        audio.cut_pcm(source, 5, 6, str(tmp_path / "c.wav"))


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_pcm_of_every_width_and_stereo(tmp_path, width):
    path, top = str(tmp_path / "w.wav"), 2 ** (8 * width - 1)
    values_ = [-top, 0, top // 2, top - 1]
    raw = b"".join((v + (128 if width == 1 else 0)).to_bytes(width, "little", signed=width > 1) * 2 for v in values_)
    with wave.open(path, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(width)
        w.setframerate(8000)
        w.writeframes(raw)
    np.testing.assert_allclose(audio.pcm_samples(path)[0], [v / top for v in values_], atol=1e-6)


def test_long_headers_are_read(spark, tmp_path):
    audio.write_pcm16(str(tmp_path / "x.wav"), np.zeros(16_000), 16_000)
    raw = (tmp_path / "x.wav").read_bytes()
    extra = b"LIST" + (5000).to_bytes(4, "little") + bytes(5000)
    (tmp_path / "x.wav").write_bytes(raw[:4] + (len(raw) + len(extra) - 8).to_bytes(4, "little") + raw[8:12] + extra + raw[12:])
    assert audio.wav_durations(spark, str(tmp_path)).first().duration == 1.0


def test_reports_of_broken_lines_and_small_tables(spark):
    lines = spark.createDataFrame([('{"a":1}',), ("",), (None,), ('{"a":',), ("[1]",)], "raw string")
    assert tuple(records.read_with_broken(lines).first()) == (5, 2, 2)
    one = spark.createDataFrame([("x", 1)], "label string, n int")
    assert "## counts" in records.write_report({"counts": one}, "Title") and '"n": 1' in records.summary_json({"counts": one})


def test_short_textgrid_is_read_back(spark):
    rows = [("b", "w", 1, 0, 0.0, 0.5, 'da "x"'), ("b", "w", 1, 1, 0.5, 1.0, ""), ("b", "s", 2, 0, 0.0, 1.0, "1")]
    df = spark.createDataFrame(rows, "base string, tier string, place int, idx int, start_t double, end_t double, label string")
    content = textgrid.to_textgrid(df, short=True).first().content
    assert "xmin" not in content
    assert textgrid.parse(content) == [("w", "interval", 0, 0.0, 0.5, 'da "x"'), ("w", "interval", 1, 0.5, 1.0, ""), ("s", "interval", 0, 0.0, 1.0, "1")]


def test_islands_over_the_borders_of_tasks(spark):
    rng = random.Random(4)
    rows = [("hot" if i < 900 else f"k{i % 7}" if i % 5 else None, i, rng.choice([None, "a", "a", "a", "b"]) if i % 300 > 150 else "a") for i in range(1200)]
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(6)
    want, last = [], {}
    for k, _, v in rows:
        if k in last and last[k][1] == v:
            last[k][2] += 1
        else:
            last[k] = [k, v, 1]
            want.append(last[k])
    got = events.islands(df, ["k"], ["t"], "v").select("k", "v", "n").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_frames_of_any_spans(spark):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        spans = [(rng.uniform(-1, 9), rng.uniform(-1, 9)) for _ in range(rng.randint(0, 8))] + ([(None, 2.0)] if i % 5 == 0 else [])
        rows.append((i, spans if i else None, rng.choice([0.0, 3.3, 8.0])))
    df = spark.createDataFrame(rows, "id int, fp array<struct<time_s:double,time_e:double>>, d double")
    out = df.select("id", frames.rasterise_rounded("fp", "d", 10).alias("r"), frames.rasterise_touched("fp", "d", 10).alias("t")).collect()
    for (_, spans, d), row in zip(rows, sorted(out)):
        if spans is None:
            assert row.r is None and row.t is None
            continue
        whole = [(a, z) for a, z in spans if a is not None]
        assert row.r == [int(any(round(a * 10) <= t < round(z * 10) for a, z in whole)) for t in range(round(d * 10))]
        assert row.t == [int(any(z > a and np.floor(a * 10) <= t < np.ceil(z * 10) for a, z in whole)) for t in range(int(d * 10))]


def test_overlap_counts_against_brute_force(spark):
    rng = random.Random(9)
    make = lambda n: [(rng.choice(["f", "g", None]), i, *sorted((rng.randint(0, 50), rng.randint(0, 50)))) for i in range(n)]
    a, b = make(80), make(60) + [("f", 1, None, 3)]
    schema = "k string, idx int, start_ms bigint, end_ms bigint"
    out = joins.overlap_counts(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], ["k", "idx"], 1).collect()
    want = {i: sum(k is not None and k == q and x is not None and y + 1 >= s and x - 1 <= e for q, _, x, y in b) for k, i, s, e in a}
    assert {r.idx: r.n for r in out} == {i: (n if a[i][0] is not None else 0) for i, n in want.items()}


def test_quantiles_of_any_group(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", 5.0), ("n", None), (None, 1.0), (None, 2.0)]
    out = {r.k: r for r in profile.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], F.col("v")).collect()}
    assert (out["a"].p50, out["a"].p90, out["a"].p99, out["a"].max) == (50.0, 90.0, 99.0, 100.0)
    assert out["b"].p99 == 5.0 and out["n"].n == 0 and out["n"].p50 is None and out[None].p50 == 1.5


def test_p_value_and_units(spark):
    # reference values of Student's t
    assert abs(metrics.t_tail(0.5, 10) - 0.14111328125) < 1e-9 and abs(metrics.t_tail(0.0, 30) - 1) < 1e-12 and metrics.t_tail(1.0, 5) == 0
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(10)], "g double, p double")
    r = metrics.regression_metrics(df, "g", "p", 3.0, 2.0).first()
    assert abs(r.mae - 2 * sum(abs(i * i - i) for i in range(10)) / 10) < 1e-9 and r.rho == 1.0 and r.p_value == 0.0


def test_small_rules(spark):
    df = spark.createDataFrame([("a", "3.5", None, "train"), ("b", None, "Low", "dev"), ("c", "x", "?", "test")], "t string, n string, l string, split string")
    got = [r[0] for r in df.select(values.regression_label("n", "l", {"Low": 1.0})).collect()]
    assert got == [3.5, 1.0, None] and df.where(clean.long_enough("t", 2)).count() == 0
    assert splits.for_training(df).count() == 2 and splits.trial_rows(df, ["t"], 1).first().t == "a"
    assert frames.family_of("wav2vec2") == "convolutions"
    with pytest.raises(ValueError):
        frames.family_of("other")
    n = spark.range(1).select(frames.output_length(F.lit(16_000), "wav2vec2", [10, 3, 3, 3, 3, 2, 2], [5, 2, 2, 2, 2, 2, 2]), frames.output_length(F.lit(100), "wav2vec2-bert", adapter=(1, 3, 2)))
    assert tuple(n.first()) == (49, 49)
    assert config.subset_name(["ParlaSpeech-HR"], hours=5, duration=(2, 15)) == "ps-hr_5h_2-15s"
    assert metrics.recalibrated_eta(10, 5.0, 30) == 15.0
    task = config.Task("x", ("p",), "l")
    assert config.available({"x": task}, lambda p: False) == ([], ["x"])
    with pytest.raises(ValueError):
        config.with_mode({}, {}, {"demo": {}}, "full")


def test_download_plan_of_a_dry_run_and_by_force(spark):
    files = spark.createDataFrame([("d", "a", 5.0, False), ("d", "b", 5.0, True)], "dataset string, name string, size_mb double, is_large boolean")
    have = spark.createDataFrame([("d", "a", 5.0)], "dataset string, name string, size_mb double")
    of = lambda **k: {r.name: (r.action, r.reason) for r in config.download_plan(files, have, **k).collect()}
    assert of(dry_run=True) == {"a": ("skip", "dry_run"), "b": ("skip", "dry_run")}
    assert of(force=True, skip_large=True) == {"a": ("fetch", "forced"), "b": ("skip", "large")}


DIR = "/root/testdata/sf0.001"


def test_queries_read_only_their_columns(spark):
    if not common.Path(DIR).exists():
        pytest.skip("no test tables")
    scan = [x for x in plan_of(registry.QUERIES["value_counts"](spark, DIR)).splitlines() if "ReadSchema" in x]
    assert scan and all("ReadSchema: struct<instance_id:string,dataset:string,ingested_at:timestamp_ntz>" in x for x in scan)
