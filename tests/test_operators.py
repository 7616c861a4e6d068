"""Cleaning, splits, joins, events, labels and metrics on small tables."""

from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import plan_of
from tierflow.operators import clean, events, joins, labels, metrics, profile, reshape, splits

RECORD = "instance_id string, dataset string, audio_path string, split string, labels struct<s:string,f:array<int>>, metadata struct<x:int>, file_id string, start_t double, end_t double, speaker string, text string, frame_rate_hz int"


def record(i, split="train", start=2.19, end=4.58, frames=None, rate=None, text="Tudi.", label="neutralPositive"):
    return (i, "ROG", "data/example.wav", split, (label, frames), (1,), "Art-S01-V01", start, end, "SPK0", text, rate)


def test_validation(spark):
    rows = [record("ok"), record("bad", "invalid"), record("late", start=5.0), record("rate", rate=50), record("seq", frames=[0], rate=50), record(None), record("nul", None)]
    df = spark.createDataFrame(rows, RECORD)
    got = {r[0]: r[1] for r in df.select("instance_id", clean.errors_of(df)).collect()}
    assert got["ok"] == [] and got["seq"] == []
    assert "split" in got["bad"][0] and "end_t" in got["late"][0] and "frame_rate_hz" in got["rate"][0]
    assert len(got["nul"]) == 2 and "instance_id" in got[None][0]
    assert clean.validation_summary(df).first().asDict() == {"n_total": 7, "n_valid": 2}
    assert clean.drop_invalid(df).count() == 2


def test_raw_validation_tells_absent_from_null(spark):
    base = '"instance_id":"a","dataset":"d","audio_path":"p","split":"dev","labels":{"x":"y"},"metadata":{}'
    lines = ["{%s}" % base, "{%s,\"text\":null}" % base, "{%s,\"frame_rate_hz\":50}" % base, '{"instance_id":"a"}', "{%s,\"start_t\":\"1\"}" % base]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, raw string")
    out = {r[0]: r[1] for r in df.select("i", F.try_parse_json("raw").alias("v")).select("i", clean.errors_of_variant(F.col("v"))).collect()}
    assert out[0] == [] and out[1] == ["optional 'text' has wrong type"]
    assert out[2] == ["frame_rate_hz set but no sequence labels"]
    assert len(out[3]) == 6 and out[4] == ["optional 'start_t' has wrong type"]


def test_clean_keeps_the_first_and_counts_each_step(spark):
    rows = [record("a", label=" "), record("a"), record("b", "x"), record("c", text=" "), record("d")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RECORD + ", _seq int")
    kept, steps = clean.clean(df, ["_seq"], F.col("labels.s"), True)
    assert [r.instance_id for r in kept.collect()] == ["d"]
    assert {r.step: r.n for r in steps.collect()} == {"input": 5, "valid": 4, "unique": 3, "kept": 1}


def test_hash_split_keeps_groups_together_without_shuffle(spark):
    df = spark.range(900).select(F.col("id").cast("string").alias("instance_id"), F.concat(F.lit("file_"), (F.col("id") / 3).cast("int").cast("string")).alias("file_id"))
    out = splits.assign_splits(df, ratios=(0.6, 0.2, 0.2), overwrite=True)
    assert splits.leaks(out, "file_id").count() == 0
    assert out.select("split").distinct().count() == 3
    assert "Exchange" not in plan_of(out)


def test_speaker_disjoint_quotas(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("string").alias("speaker"))
    out = splits.speaker_disjoint(df).groupBy("split").agg(F.sum("n").alias("n")).collect()
    got = {r.split: r.n for r in out}
    assert sum(got.values()) == 1000 and abs(got["train"] - 800) < 25 and abs(got["dev"] - 100) < 25


def test_balance_gives_back_tables_without_classes(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "instance_id string, c string")
    assert splits.balance_classes(df, F.col("c")).count() == 2
    assert splits.balance_classes(df.limit(0), F.col("c")).count() == 0


def test_cap_balanced_takes_turns(spark):
    rows = [(f"{d}{i}", d) for d, n in (("a", 50), ("b", 3), ("c", 10)) for i in range(n)]
    df = spark.createDataFrame(rows, "instance_id string, dataset string")
    n = {r.dataset: r["count"] for r in splits.cap_balanced(df, 15, "dataset").groupBy("dataset").count().collect()}
    assert n == {"a": 6, "b": 3, "c": 6}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 15), st.sampled_from("xy")), max_size=14), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 15), st.sampled_from("xy")), max_size=14))
def test_overlap_pairs_against_brute_force(spark, left, right):
    make = lambda rows: spark.createDataFrame([(k, i, s, s + n) for i, (s, n, k) in enumerate(rows)], "k string, i int, start_ms bigint, end_ms bigint")
    got = sorted((r.i, r.r_i) for r in joins.overlap_pairs(make(left), make(right), ["k"], tolerance=1, width=7).collect())
    want = sorted((i, j) for i, (s, n, k) in enumerate(left) for j, (t, m, q) in enumerate(right) if k == q and t + m + 1 >= s and t - 1 <= s + n)
    assert got == want


def test_interval_joins_are_no_nested_loops(spark):
    a = spark.createDataFrame([("f", 1, 0, 10)], "k string, i int, start_ms bigint, end_ms bigint")
    plan = plan_of(joins.overlap_pairs(a, a, ["k"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_marks_fall_back_to_the_middle(spark):
    w = spark.createDataFrame([("f", 0, 0, 100, ""), ("f", 1, 100, 200, "")], "file_id string, idx int, start_ms bigint, end_ms bigint, label string")
    m = spark.createDataFrame([("f", 0, 10, 20), ("f", 1, 90, 150), ("f", 2, 500, 600)], "file_id string, idx int, start_ms bigint, end_ms bigint")
    out = {r.idx: (r.word_idx, r.note) for r in joins.marks_in_words(m, w, ["file_id"], ["file_id", "idx"]).collect()}
    assert out == {0: (0, None), 1: (1, None), 2: (None, "stress_outside_word")}


def test_frames_to_events_and_post_filters(spark):
    df = spark.createDataFrame([([0, 1, 1, 0, 1], [0.1, 0.8, 0.9, 0.2, 0.7])], "p array<int>, q array<double>")
    e = events.frames_to_events("p", "q", {1: "fp"}, F.lit(0.02))
    assert [tuple(x) for x in df.select(e).first()[0]] == [(0.02, 0.06, "fp", 0.85), (0.08, 0.1, "fp", 0.7)]
    kept = df.select(events.postprocess(e, F.lit(0.1), shortest=0.03)).first()[0]
    assert [tuple(x)[:2] for x in kept] == [(0.02, 0.06)]


def test_fill_gaps_covers_the_recording(spark):
    df = spark.createDataFrame([("f", 0.0, 0.5, "a", 3.0), ("f", 1.0, 2.0, "b", 3.0)], "k string, start_s double, end_s double, label string, d double")
    out = sorted(tuple(r)[1:] for r in events.fill_gaps(df, "k", "d").collect())
    assert out == [(0.0, 0.5, "a"), (0.5, 1.0, ""), (1.0, 2.0, "b"), (2.0, 3.0, "")]


def test_chunks(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.5,)], "d double")
    out = [[tuple(x) for x in r[0]] for r in df.select(events.chunk_spans("d", 1.0)).collect()]
    assert out == [[(0.0, 0.0)], [(0.0, 1.0)], [(0.0, 1.0), (1.0, 2.0), (2.0, 2.5)]]


def test_rare_classes_unseen_in_train_become_other(spark):
    rows = [("train", "a")] * 20 + [("train", "b")] + [("dev", "c"), ("dev", "a"), ("dev", None)]
    df = spark.createDataFrame(rows, "split string, y string")
    out = {(r.split, r.y): r["count"] for r in labels.collapse_rare(df, "y", 10).groupBy("split", "y").count().collect()}
    assert out == {("train", "a"): 20, ("train", "Other"): 1, ("dev", "Other"): 1, ("dev", "a"): 1, ("dev", None): 1}


def test_best_epoch_ignores_nan_and_prefers_the_first(spark):
    df = spark.createDataFrame([("r", 1, float("nan")), ("r", 2, 0.5), ("r", 3, 0.5), ("n", 1, None)], "run string, epoch int, m double")
    out = {r.run: r.epoch for r in metrics.best_epoch(df, "run", "epoch", "m").collect()}
    assert out == {"r": 2, "n": 1}
    low = metrics.best_epoch(df, "run", "epoch", "m", lower_is_better=True)
    assert {r.run: r.epoch for r in low.collect()}["r"] == 2


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    assert metrics.spearman(df, "a", "b").first().rho is None
    assert metrics.spearman(df.withColumn("b", F.col("a") * F.col("a")), "a", "b").first().rho == 1.0


def test_macro_f1_counts_labels_seen_only_in_predictions(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c")], "g string, p string")
    got = metrics.classification_metrics(metrics.confusion(df, "g", "p")).first()
    assert got.accuracy == 0.5 and abs(got.macro_f1 - (2 / 3) / 2) < 1e-9


def test_histogram_of_one_value_and_none(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [tuple(r) for r in profile.histogram(df, F.col("x"), 4).collect()] == [(1, 2)]
    assert profile.histogram(df.limit(0), F.col("x"), 4).count() == 0


def test_word_rows_mark_stress_within_the_word(spark):
    words = [(0.0, 0.2, 0, 3, None), (0.2, 0.4, 4, 7, "dan"), None]
    stress = [(0, [0.0, 0.1]), (0, [0.1, 0.2]), (7, [0.0, 1.0]), (1, [0.3])]
    schema = "instance_id string, text string, w array<struct<time_s:double,time_e:double,char_s:int,char_e:int,text:string>>, s array<struct<words_align_idx:int,raw:array<double>>>"
    df = spark.createDataFrame([("u", "dob xxx", words, stress)], schema)
    out = {r.instance_id: r for r in reshape.word_rows(df, F.col("w"), F.col("s"), 50).collect()}
    assert set(out) == {"u#w0", "u#w1"}
    assert out["u#w0"].text == "dob" and out["u#w0"].multistress and sum(out["u#w0"].primary_stress) == 10
    assert out["u#w1"].text == "dan" and sum(out["u#w1"].primary_stress) == 0


def test_tier_names_met_before_are_renamed(spark):
    rows = [("b", "l1", "t", 1, 0.0, 1.0), ("b", "l2", "t", 1, 0.0, 2.0), ("b", "l3", "u", 1, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "base string, layer string, tier string, tier_pos int, start_t double, end_t double")
    out = {r.layer: (r.new_tier, r.place) for r in reshape.merge_tiers(df, ["l2", "l1"]).collect()}
    assert out == {"l2": ("t", 1), "l1": ("l1_t", 2)}
