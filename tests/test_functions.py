"""Ids, values and frame arrays against hand-made vectors and brute force."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.functions import frames, ids, values


def one(spark, col, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("row", "want"),
    [(("ROG", "Art-S01-V01", "SPK0", 2.19, 4.58), "ROG_Art-S01-V01_SPK0_2.190_4.580"), (("GOS", "Artur-N-G0001", None, None, None), "GOS_Artur-N-G0001")],
)
def test_instance_id(spark, row, want):
    assert one(spark, ids.instance_id("d", "f", "s", "a", "b"), "d string, f string, s string, a double, b double", row) == want


def test_sanitise(spark):
    assert one(spark, ids.sanitise(F.lit("Art S01/V01 č"))) == "Art-S01-V01-"
    assert one(spark, ids.sanitise_unicode(F.lit("a č/1"))) == "a_č_1"


@pytest.mark.parametrize(
    ("path", "want"),
    [("rec1/x_1.flac", "rec1"), ("audio/hash_12.flac", "hash"), ("ab.flac", "ab"), ("audio/.flac", ".f"), ("", "misc"), ("/x_1.wav", "x")],
)
def test_audio_bucket(spark, path, want):
    assert one(spark, ids.audio_bucket(F.lit(path))) == want


def test_names_of_annotation_files(spark):
    assert one(spark, ids.layer_of(F.lit("d/base.v1.merged.TextGrid"))).asDict() == {"base": "base.v1", "layer": "merged"}
    assert one(spark, ids.layer_of(F.lit("base.TextGrid"))) is None
    got = one(spark, ids.stress_file(F.lit("GosVL01_spk3_1_250-2_5.TextGrid"), {"GosVL": "GOS"})).asDict()
    assert got == {"source_id": "GosVL01", "speaker": "spk3", "start_t": 1.25, "end_t": 2.5, "corpus": "GOS"}


def test_stable_hash_equals_the_md5_rule(spark):
    want = int(hashlib.md5(b"speech-ml-pipeline::x").hexdigest()[:8], 16) / 0xFFFFFFFF
    assert one(spark, ids.stable_hash(F.lit("speech-ml-pipeline::x"))) == want


def test_values(spark):
    assert one(spark, values.age(F.lit("2020-12-29"), F.lit("1981"))) == 39
    assert one(spark, values.age(F.lit("2020-12-29"), F.lit("-"))) is None
    assert one(spark, values.known_gender(F.lit("-"))) is None
    assert one(spark, values.mapped_gender(F.lit(" Žena "), {"žena": "F"})) == "F"
    assert one(spark, values.capitalise(F.lit("tURN take"))) == "Turn take"
    assert one(spark, values.count_or_null(F.lit(None).cast("array<int>"))) is None
    assert one(spark, values.count_or_null(F.array())) == 0
    assert one(spark, values.strip(F.lit(" \t a \n"))) == "a"
    assert one(spark, values.word_text(F.lit("dobar dan"), F.lit(6), F.lit(9))) == "dan"
    assert one(spark, values.scaled(F.lit("2.5"), {"a": 1.0})) == 2.5


def test_rasterise_vectors(spark):
    arr = lambda a, b: F.array(F.struct(F.lit(a).alias("time_s"), F.lit(b).alias("time_e")))
    for rule in (frames.rasterise_rounded, frames.rasterise_touched):
        assert [i for i, v in enumerate(one(spark, rule(arr(0.05, 0.11), F.lit(0.2), F.lit(50)))) if v] == [2, 3, 4, 5]
    assert sum(one(spark, frames.rasterise_rounded(arr(0.03, 0.05), F.lit(0.2), F.lit(50)))) == 0
    assert [i for i, v in enumerate(one(spark, frames.rasterise_touched(arr(0.03, 0.05), F.lit(0.2), F.lit(50)))) if v] == [1, 2]
    assert one(spark, frames.rasterise_rounded(arr(0.0, 1.0), F.lit(0.0), F.lit(50))) == []


def test_frame_vectors(spark):
    a = lambda *x: F.array(*map(F.lit, x))
    assert one(spark, frames.resize(a(0, 1, 1), F.lit(5))) == [0, 0, 1, 1, 1]
    assert one(spark, frames.resize(F.array().cast("array<int>"), F.lit(5))) == []
    assert one(spark, frames.conv_length(F.lit(16000), [10, 3, 3, 3, 3, 2, 2], [5, 2, 2, 2, 2, 2, 2])) == 49
    assert one(spark, frames.conv_length(F.lit(0), [10, 3], [5, 2])) == 0
    assert one(spark, frames.pad(a(1, 0), F.lit(4))) == [1, 0, -100, -100]
    assert one(spark, frames.pad(a(1, 0, 1), F.lit(2))) == [1, 0]
    assert one(spark, frames.argmax(a(0.1, 0.7, 0.7))) == 1
    assert math.isclose(sum(one(spark, frames.softmax(a(1.0, 2.0, 3.0)))), 1)
    assert one(spark, frames.trim_to_mask(a(5, 6, 7), a(1, 1, 0))) == [5, 6]
    assert one(spark, frames.error_rate(a(1, 0, 1), a(1, 1, 1))) == pytest.approx(1 / 3)
    assert one(spark, frames.error_rate(F.array().cast("array<int>"), a(1))) is None
    assert [tuple(x) for x in one(spark, frames.unmasked(a(1, -100, 0), a(0, 1, 0)))] == [(1, 0), (0, 0)]
    assert one(spark, frames.indices(F.lit(0))) == []


def test_window_around_events(spark):
    ev = F.array(F.struct(F.lit(3.0).alias("time_s"), F.lit(3.5).alias("time_e")))
    assert tuple(one(spark, frames.window_around(ev, F.lit(5.0), F.lit(2.0)))) == (1.0, 5.0)
    none = F.array().cast("array<struct<time_s:double,time_e:double>>")
    assert tuple(one(spark, frames.window_around(none, F.lit(10.0), F.lit(2.0)))) == (0.0, 4.0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=20))
def test_runs_against_brute_force(spark, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>").select("i", frames.runs("x").alias("r"))
    for row in df.collect():
        want, x = [], lists[row.i]
        for k, v in enumerate(x):
            if want and want[-1][0] == v:
                want[-1][2] = k + 1
            else:
                want.append([v, k, k + 1])
        assert [list(r) for r in row.r] == want
