"""Nested records and periods: edge cases and brute force."""

import json
import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.operators import nested, periods

LINES = "line_no bigint, source_file string, ingested_at timestamp_ntz, raw string"
AT = datetime(2024, 1, 1)


def kids(spark, *records):
    rows = [(i, "f", AT, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)]
    out = nested.child_positions(nested.records(spark.createDataFrame(rows, LINES)))
    return sorted((r.instance_id, r.child, r.parent_pos, r.pos) for r in out.collect())


def test_null_entries_keep_their_place(spark):
    r = {"instance_id": "a", "metadata": {"words_align": [None, {"t": 1}], "primary_stress": [{"words_align_idx": 0}, {"words_align_idx": 1}, None, {"words_align_idx": 9}, {}]}}
    assert kids(spark, r) == [
        ("a", "primary_stress", -1, 0), ("a", "primary_stress", -1, 3), ("a", "primary_stress", -1, 4), ("a", "primary_stress", 1, 1), ("a", "words_align", -1, 1)
    ]


def test_lone_values_and_json_strings(spark):
    person = {"Memberships": {"p": 1, "Roles": "chair"}}
    r = {"instance_id": "a", "labels": {"x": "[1,2]", "y": [1, None, 2], "z": None, "e": []}, "metadata": json.dumps({"filled_pauses": {"time_s": 1}, "speaker_info": json.dumps(person)})}
    assert kids(spark, r) == [
        ("a", "filled_pauses", -1, 0), ("a", "labels.x", -1, 0), ("a", "labels.y", -1, 0), ("a", "labels.y", -1, 2), ("a", "memberships", -1, 0), ("a", "roles", 0, 0)
    ]


def test_roles_know_their_membership(spark):
    r = {"instance_id": "a", "metadata": {"speaker_info": {"Memberships": [None, {"Roles": [{"r": 1}, None, {"r": 2}]}, {"Roles": None}]}}}
    assert kids(spark, r) == [("a", "memberships", -1, 1), ("a", "memberships", -1, 2), ("a", "roles", 1, 0), ("a", "roles", 1, 2)]


def test_the_latest_valid_line_counts(spark):
    old, new = {"instance_id": "a", "labels": {"x": 1}}, {"instance_id": "a", "labels": {"y": 1}}
    assert kids(spark, old, new, '{"instance_id": "a", "labels": {"z"', None, "", "[1]", {"labels": {"q": 1}}) == [("a", "labels.y", -1, 0)]
    assert kids(spark) == []


def test_flat_tables_are_linked(spark):
    r = {"instance_id": "a", "dataset": "d", "metadata": {"words_align": [{"time_s": 0.5, "text": "da"}], "speaker_info": {"Memberships": [{"Speaker_party": "P"}]}}}
    recs = nested.records(spark.createDataFrame([(1, "f", AT, json.dumps(r))], LINES))
    words = nested.child_table(recs, "words_align").first()
    assert (words.instance_id, words.pos, words.time_s, words.text) == ("a", 0, 0.5, "da")
    assert nested.child_table(recs, "memberships").first().party == "P"
    assert nested.record_table(recs).first().dataset == "d"


def test_flat_tables_hold_the_whole_content(spark):
    stress = [{"words_align_idx": 3, "raw": [1.11, 1.19]}, {"words_align_idx": 4, "raw": "[2, 2.5]"}, {"words_align_idx": None, "raw": None}, {"raw": [1, None]}]
    person = {"Lang": "sl", "Memberships": [{"Speaker_party": "P", "Roles": [{"Role": "member", "Since": "1998"}, "chair"]}]}
    r = {"instance_id": "a", "metadata": {"lang": "hr", "primary_stress": stress, "speaker_info": person}}
    recs = nested.records(spark.createDataFrame([(1, "f", AT, json.dumps(r))], LINES))
    table = lambda c: nested.child_table(recs, c).orderBy("pos").collect()
    assert [(x.words_align_idx, x.raw) for x in table("primary_stress")] == [(3, [1.11, 1.19]), (4, [2.0, 2.5]), (None, None), (None, [1.0, None])]
    assert [(x.role, x.since) for x in table("roles")] == [("member", "1998"), (None, None)] and table("roles")[1].value == "chair"
    assert (nested.record_table(recs).first().lang, nested.record_table(recs).first().speaker_lang) == ("hr", "sl")


def brute(rows):
    groups = {}
    for item, layer, s, e in rows:
        if item is not None and s is not None and e is not None and e > s:
            groups.setdefault((item, layer), []).append((s, e))
    out = []
    for (item, layer), spans in groups.items():
        merged = []
        for s, e in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(item, layer, "period", s, e) for s, e in merged]
        out += [(item, layer, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:])]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "item string, layer string, start_ms bigint, end_ms bigint")


@pytest.mark.parametrize("block, parts, batch", [(1, 4, 10_000), (37, 16, 3), (600_000, 4, 7)])
def test_periods_against_brute_force(spark, block, parts, batch):
    rng = random.Random(block)
    time = lambda: rng.choice([None, *[rng.randint(-30, 200) for _ in range(9)]])
    rows = [(rng.choice([f"a{k}", f"b{k}", None]), rng.choice(["x", None]), time(), time()) for k in range(200) for _ in range(rng.randint(0, 30))]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        assert sorted(map(tuple, periods.periods_and_gaps(frame(spark, rows), block).collect()), key=repr) == brute(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_hot_item_is_spread_over_nodes(spark):
    rows = [("hot", "x", i * 1000, i * 1000 + (1500 if i % 10 else 500)) for i in range(3000)] * 2
    long = [*rows, ("hot", "x", 900_000, 2_400_000), ("hot", "x", -5, 0), ("zz", None, 1, 2)]  # one that reaches over nodes
    for part in (rows, long):
        assert sorted(map(tuple, periods.periods_and_gaps(frame(spark, part), 60_000).collect()), key=repr) == brute(part)


def test_no_intervals_no_periods(spark):
    assert periods.periods_and_gaps(frame(spark, [])).count() == 0
    assert periods.periods_and_gaps(frame(spark, [("a", "x", 5, 5), (None, "x", 1, 2), ("a", "x", None, 2)])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-30, 60), st.integers(1, 40)), max_size=40))
def test_merging_is_the_same_in_any_order(rows):
    rows = [(str(g), "x", s, s + n) for g, s, n in rows]
    one = lambda part: periods.merged(*(np.array([int(r[i]) for r in part], np.int64) for i in (0, 2, 3)))
    a, b = one(rows[::2]), one(rows[1::2])
    both = periods.merged(*(np.concatenate(x) for x in zip(a, b)))
    want = sorted(r for r in brute(rows) if r[2] == "period")
    assert sorted((str(g), "x", "period", s, e) for g, s, e in zip(*(c.tolist() for c in both))) == want
