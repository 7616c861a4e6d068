"""Raking, caps, drawn shares and shortfalls."""

import random

import numpy as np

from tierflow.llm import mix

SCHEMA = "doc_id bigint, text string, lang string, source string"
TARGETS = "source string, target_permille int, max_repeats int"


def test_raking_meets_sources_within_caps():
    rng = np.random.default_rng(1)
    places = np.array([[s, i, t] for s in range(4) for i in range(3) for t in range(2)]).T
    tokens = rng.integers(0, 1000, 24).astype(float)
    want = tokens.sum() / 2 * np.array([0.4, 0.3, 0.2, 0.1])
    repeats = np.array([2.0, 1.0, 3.0, 1.0])
    out = mix.rake(tokens, places, want, repeats)
    most = tokens * repeats[places[0]]
    assert (out <= most + 1e-6).all() and (out >= 0).all()
    per = lambda x: np.bincount(places[0], x)
    np.testing.assert_allclose(per(out), np.minimum(want, per(most)), rtol=1e-6)


def test_open_sources_are_within_one_percent(spark):
    rng = random.Random(2)
    langs = ["hr", "sr", "sl", *[f"l{k}" for k in range(80)]]  # more than any fixed number of levels
    rows = [(i, "riječ " * rng.randint(1, 200), rng.choice(langs) if i % 3 else "hr", "big" if i % 4 else "other") for i in range(6000)]
    targets = [("big", 300, 2), ("other", 500, 1)]
    m = mix.Mixture(spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(targets, TARGETS))
    report = {r.source: r for r in m.report().collect()}
    assert abs(report["big"].reached_tokens / report["big"].wanted_tokens - 1) < 0.01
    assert report["other"].short and report["other"].reached_tokens == report["other"].own_tokens
    assert m.copies().count() == 6000


def test_mixture(spark):
    rows = [(i, "riječ " * 20, "hr", "a") for i in range(300)] + [(300 + i, "slovo " * 20, "sr", " B ") for i in range(50)] + [(400, None, None, "b"), (401, "x", "en", None), (402, "x", "en", "other")]
    targets = [("a", 500, 1), ("b", 500, 3), ("B", 10, 1), ("gone", 0, 2), ("absent", 50, 2)]
    m = mix.Mixture(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(targets, TARGETS))
    copies = m.copies().toPandas()
    assert len(copies) == len(rows) and copies.set_index("doc_id").loc[[401, 402], "copies"].sum() == 0
    assert copies[copies.source == "a"]["copies"].max() <= 1 and copies[copies.source == "b"]["copies"].max() <= 3
    report = {r.source: r for r in m.report().collect()}
    own = {s: g.tokens.sum() for s, g in copies.groupby("source")}
    total = own["a"] + own["b"]
    assert report["a"].wanted_tokens == total / 4 and not report["a"].short
    assert report["b"].short == (own["b"] * 3 * 2000 < total * 500)
    assert report["absent"].short and not report["gone"].short
    assert abs(report["a"].reached_tokens / report["a"].wanted_tokens - 1) < 0.2


def test_empty_tables(spark):
    docs, targets = spark.createDataFrame([], SCHEMA), spark.createDataFrame([("a", 500, 1)], TARGETS)
    m = mix.Mixture(docs, targets)
    assert m.copies().count() == 0 and m.report().first().reached_tokens == 0
    none = mix.Mixture(spark.createDataFrame([(1, "x", "hr", "a")], SCHEMA), targets.limit(0))
    assert none.copies().first().copies == 0 and none.report().count() == 0
