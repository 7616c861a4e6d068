"""Cuts: limits, overlaps, natural places."""

import random

import numpy as np

from tierflow.llm import pieces as p


def check(labels, rate, size, limit, overlap):
    cuts = p.cut_places(np.array(labels, np.int32), rate, size, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == size
    assert all(b - a <= limit for a, b in cuts)
    assert all(d == b - overlap for (_, b), (d, _) in zip(cuts, cuts[1:]))
    assert all(a < c for (a, _), (c, _) in zip(cuts, cuts[1:]))
    return cuts


def test_random_records_hold_every_rule():
    rng = random.Random(7)
    for _ in range(300):
        rate = rng.choice([25, 50, 100])
        labels = []
        while len(labels) < rng.randint(0, 900):
            labels += [rng.randint(0, 1)] * rng.randint(1, 60)
        size = max(len(labels) * 1000 // rate, rng.randint(1, 30_000))
        check(labels, rate, size, rng.randint(800, 9000), rng.choice([0, 100, 250]))


def test_cuts_lie_outside_events_where_possible():
    labels = [0] * 40 + [1] * 20 + [0] * 40  # an event from 0.8 to 1.2 s
    assert check(labels, 50, 2000, 1000, 0)[0] == (0, 800)
    # with an overlap both the end and the next start lie outside
    cuts = check(labels, 50, 2000, 1500, 200)
    assert cuts[0][1] == 1500 and cuts[1][0] == 1300
    assert check(labels, 50, 2000, 1300, 200)[0] == (0, 800)
    # nowhere outside: a hard cut
    assert check([1] * 200, 50, 4000, 1000, 0)[0] == (0, 1000)


def test_records(spark):
    schema = "instance_id string, dataset string, audio_path string, frame_rate_hz int, labels struct<filled_pause:array<int>>, metadata struct<audio_length:double>, piece int"
    rows = [
        ("long", "d", "p", 50, ([0] * 100 + [1] * 10 + [0] * 90,), (3.9,), 5), ("long", "d", "p", 50, ([0] * 100 + [1] * 10 + [0] * 90,), (3.9,), 5),
        ("audio", "d", "p", 50, ([0, 1],), (4.5,), 0), ("null", "d", None, None, None, None, 0), ("none", "d", None, 50, (None,), (2.5,), 0),
        ("rate0", "d", None, 0, ([1] * 500,), (None,), 0), ("other", "e", None, 50, ([0] * 500,), (9.0,), 0), ("nods", None, None, 50, ([],), (9.0,), 0),
    ]
    limits = spark.createDataFrame([("d", 2.0, 0.5)], "dataset string, max_piece_s double, overlap_s double")
    out = p.pieces(spark.createDataFrame(rows, schema), limits).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.instance_id, r.piece)):
        by.setdefault(r.instance_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"long": 3, "audio": 3, "null": 1, "none": 2, "rate0": 1, "other": 1, "nods": 1}
    assert by["long"][0].size_ms == 4000 and len(by["long"][0].labels) == 100
    first, second = by["long"][:2]
    assert second.first_frame * 20 == second.start_ms and second.start_ms == first.end_ms - 500
    assert by["none"][0].labels is None and by["nods"][0].labels == []
    assert p.pieces(spark.createDataFrame([], schema), limits).count() == 0
