"""Components, persons and leak-free assignment."""

import random

import pytest

from tierflow.llm import group_split as g


def brute(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent if find(x) != x}


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_components_by_forests_and_by_stars(spark, bound):
    rng = random.Random(4)
    pairs = [(f"n{rng.randint(0, 300)}", f"n{rng.randint(0, 300)}") for _ in range(220)] + [(f"c{i}", f"c{i + 1}") for i in range(40)]
    links = spark.createDataFrame([*pairs, ("x", None), ("y", "y")], "a string, b string").repartition(6)
    got = {r.node: r.root for r in g.components(links, bound).collect()}
    assert got == brute([p for p in pairs if p[0] != p[1]])


def test_persons_and_entities(spark):
    reg = spark.createDataFrame([("B", "C"), ("c", None), ("A", " b"), ("Z", "-"), (None, "A"), ("Čab", "unlisted0")], "speaker_id string, same_as string")
    rows = [("1", "f1", " A", "train"), ("2", "f1", "C", "Dev "), ("3", "f2", "-", "train"), ("4", "f2", None, "test"), ("5", None, None, "dev"), ("6", "f", "new", "x"), ("7", "f", "unlisted0", "dev")]
    u = spark.createDataFrame(rows, "instance_id string, file_id string, speaker string, split string")
    out = {r.instance_id: (r.entity, r.kind) for r in g.entities(u, reg).collect()}
    assert out == {"1": ("a", "person"), "2": ("a", "person"), "3": ("f2", "recording"), "4": ("f2", "recording"), "5": ("5", "record"), "6": ("new", "person"), "7": ("čab", "person")}
    assert sorted(r.entity for r in g.straddling(g.entities(u, reg)).collect()) == ["a", "f2"]
    alone = g.entities(u, reg.limit(0))
    assert {r.instance_id: r.entity for r in alone.collect()}["1"] == "a"


def sequential(sizes, shares):
    gaps = [sum(s * n for s, n in sizes) * x for x in shares]
    out = []
    for size, n in sorted(sizes, reverse=True):
        got = [0] * len(shares)
        for _ in range(n):
            i = max(range(len(gaps)), key=lambda i: (gaps[i], -i))
            got[i] += 1
            gaps[i] -= size
        out.append((size, got))
    return out


def test_greedy_by_size_is_the_sequential_course():
    rng = random.Random(9)
    for _ in range(200):
        sizes = [(s, rng.choice([1, 3, 70, 500])) for s in rng.sample(range(1, 60), rng.randint(1, 6))]
        shares = rng.choice([[0.8, 0.1, 0.1], [0.5, 0.5], [0.34, 0.33, 0.33]])
        assert g.greedy(sizes, shares) == sequential(sizes, shares)


def test_assignment_keeps_groups_and_shares(spark):
    rng = random.Random(2)
    rows = [(str(i), "person", f"p{min(int(rng.expovariate(0.05)), 80)}") for i in range(3000)] + [(f"h{i}", "person", "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "instance_id string, kind string, entity string")
    out = g.assign(df, [("train", 0.8), ("dev", 0.1), ("test", 0.1)]).toPandas()
    assert len(out) == len(rows) and out.groupby("entity").new_split.nunique().max() == 1
    share = out.new_split.value_counts(normalize=True)
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["dev"] - 0.1) < 0.02


def test_empty_tables_and_clashing_columns(spark):
    reg = spark.createDataFrame([], "speaker_id string, same_as string")
    u = spark.createDataFrame([], "instance_id string, file_id string, speaker string, split string")
    members = g.entities(u, reg)
    assert members.count() == 0 and g.straddling(members).count() == 0
    assert g.assign(members, [("train", 0.8), ("test", 0.2)]).count() == 0
    clash = spark.createDataFrame([("1", "person", "a", "old", 3)], "instance_id string, kind string, entity string, new_split string, size int")
    out = g.assign(clash, [("train", 0.8), ("test", 0.2)]).first()
    assert out.new_split == "train" and out["size"] == 3
