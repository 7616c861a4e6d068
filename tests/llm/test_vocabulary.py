"""Term frequencies against a plain count."""

import random
from collections import Counter

from tierflow.llm import vocabulary


def test_counts_against_brute_force(spark):
    rng = random.Random(2)
    rows = [([rng.choice("abc")] if rng.random() < 0.9 else [], [f"t{rng.randint(0, 30)}" for _ in range(rng.randint(0, 5))]) for _ in range(400)]
    df = spark.createDataFrame(rows, "x array<string>, y array<string>").repartition(5)
    out = vocabulary.term_frequencies(df, ["x", "y"]).collect()
    for k, f in enumerate("xy"):
        occ, rec = Counter(), Counter()
        for r in rows:
            occ.update(r[k])
            rec.update(set(r[k]))
        got = {r.term: (r.occurrences, r.records) for r in out if r.field == f}
        assert got == {t: (n, rec[t]) for t, n in occ.items()}
        assert all(r.mark == ("rare" if r.records < 3 else "common" if r.records > 80 else None) for r in out)
    assert sorted(r.id for r in out) == list(range(len(out)))


def test_sums_by_range_cross_range_borders(spark):
    rows = [(i, 1, 1) for i in range(50)] * 3
    df = spark.createDataFrame(rows, "id bigint, occurrences bigint, records bigint").repartition(4)
    assert {r.id: (r.occurrences, r.records) for r in vocabulary.sum_ranges(df, 8).collect()} == {i: (3, 3) for i in range(50)}


def test_terms_are_normalised_and_missing_ones_are_none(spark):
    schema = "instance_id string, speaker string, labels struct<sentiment_6:string,dialogue_act_function:string,fp_type:array<string>>"
    rows = [("1", " Čabe", ("-", "Unknown", ["EEM ", None, "eem", ""])), ("2", "čabe", (None, None, None)), ("3", None, None)]
    df = vocabulary.utterance_terms(spark.createDataFrame(rows, schema))
    out = {(r.field, r.term): (r.occurrences, r.records) for r in vocabulary.term_frequencies(df, df.columns).collect()}
    assert out == {("speaker", "čabe"): (2, 2), ("fp_type", "eem"): (2, 1)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "x array<string>")
    assert vocabulary.term_frequencies(df, ["x"]).count() == 0
