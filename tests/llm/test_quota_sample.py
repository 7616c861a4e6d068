"""Quotas, draws and reports."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import quota_sample as q


def test_sample_follows_quotas_and_reports_shortfalls(spark):
    rows = [(f"i{k}", "a" if k < 700 else "b" if k < 990 else "c") for k in range(1000)]
    df = spark.createDataFrame(rows, "instance_id string, cat string")
    targets = spark.createDataFrame([("a", 500, 1), ("b", 450, 1), ("c", 50, 40), ("d", 1, 0), ("e", 0, 0)], "cat string, permille bigint, floor bigint")
    sample, report = q.quota_sample(df, targets, ["cat"])
    got = {r.cat: r for r in report.collect()}
    assert {c: (r.quota, r.drawn) for c, r in got.items()} == {"a": (100, 100), "b": (90, 90), "c": (10, 10), "d": (0, 0), "e": (0, 0)}
    assert {c for c, r in got.items() if r.short} == {"c", "d"}
    assert {r.cat: r["count"] for r in sample.groupBy("cat").count().collect()} == {"a": 100, "b": 90, "c": 10}
    assert sample.columns == df.columns and sample.distinct().count() == 200
    again, _ = q.quota_sample(df.repartition(7), targets, ["cat"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sample.collect()))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "instance_id string, cat string")
    targets = spark.createDataFrame([("a", 500, 2)], "cat string, permille bigint, floor bigint")
    sample, report = q.quota_sample(df, targets, ["cat"])
    assert sample.count() == 0 and report.first().short
    sample, report = q.quota_sample(df, targets.limit(0), ["cat"])
    assert sample.count() == 0 and report.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=8), st.integers(0, 500))
def test_largest_remainder(shares, n):
    rows = [{"permille": s, "floor": 0, "available": 10**9} for s in shares]
    quotas = q.allocate(rows, n)
    assert sum(quotas) == n * sum(shares) // 1000
    assert all(abs(x - n * s / 1000) < 1 for x, s in zip(quotas, shares))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 30), st.integers(0, 120)), min_size=1, max_size=8), st.integers(0, 500))
def test_places_of_capped_categories_go_to_others(cells, n):
    rows = [{"permille": p, "floor": f, "available": a} for p, f, a in cells]
    quotas = q.allocate(rows, n)
    assert all(min(f, a) <= x <= a for x, (_, f, a) in zip(quotas, cells))
    # no place is left while a category with a share has rows
    no_floor = q.allocate([r | {"floor": 0} for r in rows], n)
    total = n * sum(r["permille"] for r in rows) // 1000
    assert sum(no_floor) == min(total, sum(a for p, _, a in cells if p))
    # below its own share, rounded down, only if all rows are drawn
    assert all(x == a for x, (p, _, a) in zip(quotas, cells) if x < n * p // 1000)
    short = [a < max(f, -(-n * p // 1000)) for p, f, a in cells]
    assert short == [x == a and x < max(f, -(-n * p // 1000)) for x, (p, f, a) in zip(quotas, cells)]


def test_eligible_needs_all_three(spark):
    schema = "instance_id string, labels struct<sentiment_6:string>, metadata struct<speaker_info:struct<lang:string,speaker_gender:string>>"
    rows = [("a", ("Positive ",), (("HR", "f"),)), ("b", ("-",), (("hr", "F"),)), ("c", None, (("hr", "F"),)), ("d", ("x",), None)]
    assert [tuple(r) for r in q.eligible(spark.createDataFrame(rows, schema)).collect()] == [("a", "hr", "f", "positive")]


def test_columns_of_any_name_are_kept(spark):
    rows = [(f"i{k}", "a", k, -k, 7, None) for k in range(50)]
    df = spark.createDataFrame(rows, "instance_id string, cat string, quota int, _draw int, _rank int, available int")
    targets = spark.createDataFrame([("a", 1000, 0)], "cat string, permille bigint, floor bigint")
    sample, _ = q.quota_sample(df, targets, ["cat"])
    out = sample.collect()
    assert len(out) == 10 and all((r.quota, r._draw, r._rank) == (int(r.instance_id[1:]), -int(r.instance_id[1:]), 7) for r in out)
