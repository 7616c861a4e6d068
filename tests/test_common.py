"""Shared terms: times, normalisation, current rows, ranks, tables."""

import unicodedata
from datetime import datetime

from pyspark.sql import functions as F

from tierflow import common


def test_ms_rounds_half_to_even_and_nulls_what_is_no_time(spark):
    df = spark.createDataFrame([(0.0005,), (0.0015,), (1.2346,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert [r[0] for r in df.select(common.ms("x")).collect()] == [0, 2, 1235, None, None, None]


def test_normalised_composes_strips_and_lowers(spark):
    texts = ["  Čabe ", "ČABE", "\tx ", None, "", " - ", "UNKNOWN", "İ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(common.normalised("t").alias("n"))
    out = [r[0] for r in df.collect()]
    assert out == [None if t is None else unicodedata.normalize("NFC", t).strip(" ").lower() for t in texts]
    missing = [r[0] for r in df.select(common.is_missing(F.col("n"))).collect()]
    assert missing == [False, False, False, True, True, True, True, False]


def test_nfc_all_keeps_null_lists_and_entries(spark):
    df = spark.createDataFrame([(["č", None],), (None,), ([],)], "a array<string>")
    assert [r[0] for r in df.select(common.nfc_all("a")).collect()] == [["č", None], None, []]


def test_current_takes_the_latest_and_drops_null_keys(spark):
    at = lambda d: datetime(2024, 1, d)
    rows = [("a", 1, at(1)), ("a", 2, at(3)), ("a", 2, at(3)), ("b", 3, None), (None, 4, at(9))]
    df = spark.createDataFrame(rows, "instance_id string, v int, ingested_at timestamp_ntz")
    assert sorted((r.instance_id, r.v) for r in common.current(df).collect()) == [("a", 2), ("b", 3)]
    assert common.current(df.limit(0)).count() == 0


def test_current_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("instance_id"), F.col("id").alias("ingested_at"))
    plan = common.current(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_bucketed_rank_is_exact_for_any_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").when(F.col("id") < 4990, "warm").alias("g"), F.xxhash64("id").alias("d"), "id")
    ranked = common.bucketed_rank(df, ["g"], "d", "rank", buckets=64).toPandas()
    for _, part in ranked.groupby("g", dropna=False):
        assert part.sort_values("d")["rank"].tolist() == list(range(1, len(part) + 1))


def test_bucketed_rank_breaks_ties_and_takes_clashing_names(spark):
    df = spark.createDataFrame([("a", 7, 1, 0), ("a", 7, 2, 0), ("a", -(1 << 63), 3, 0)], "g string, d bigint, id int, _bucket int")
    out = {r.id: r["rank"] for r in common.bucketed_rank(df, ["g"], "d").collect()}
    assert out[3] == 1 and sorted(out.values()) == [1, 2, 3]


def test_cut_gives_the_same_rows_without_lineage(spark):
    df = spark.range(10).select("id", (F.col("id") * 2).alias("x"))
    out = common.cut(df)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    assert "Range" not in out._jdf.queryExecution().executedPlan().toString()


def test_spread_join_is_the_join(spark, monkeypatch):
    left = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), "id", F.lit(1).alias("_salt"))
    right = spark.createDataFrame([("hot", 1), ("6", 2), ("x", 3)], "k string, v int")
    want = sorted(map(repr, left.join(right, "k", "left").collect()))
    assert sorted(map(repr, common.spread_join(left, right, ["k"]).collect())) == want
    monkeypatch.setattr(common, "small", lambda df: df)
    assert sorted(map(repr, common.spread_join(left, right, ["k"]).collect())) == want


def test_picked_columns_are_all_that_is_read(spark, tmp_path):
    spark.range(5).selectExpr("cast(id as string) as instance_id", "id as ingested_at", "struct(id as a, struct(id as x, id as y) as i) as m", "id as z").write.parquet(str(tmp_path / "t"))
    out = common.current(spark.read.parquet(str(tmp_path / "t")), payload=["m.i.y"])
    assert out.schema.simpleString() == "struct<instance_id:string,ingested_at:bigint,m:struct<i:struct<y:bigint>>>"
    plan = out.select("m.i.y")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<instance_id:string,ingested_at:bigint,m:struct<i:struct<y:bigint>>>" in plan


def test_tables_can_be_discarded(spark):
    out = common.cut(spark.range(3))
    assert out.count() == 3 and common.discard_tables(spark) >= 1 and common.discard_tables(spark) == 0
