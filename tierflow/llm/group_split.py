"""Problem 5: splits that keep related records together.

Method: distributed union-find. Each task builds a local forest over its links
and keeps only one link per node to its root; the forests are merged
hierarchically, fewer tasks each time, as long as the fullest task's share stays
below ``FOREST_LINKS``. Beyond that, the rest is resolved by
alternating large-star and small-star steps, which never hold a component in
one task. Groups are then assigned greedily, largest first, each to the split
furthest below its target. Groups of equal size are interchangeable, so the
greedy course is computed on the number of groups of each size (at most
sqrt(2 x records) different sizes) and groups draw their place among those of
their size.

Defined results: links from or to a missing value are none; a record whose
speaker is missing belongs to its recording (file_id), and alone to itself if
that is NULL too; an empty register leaves every speaker alone; a component's
name is its least normalised id in code point order among the registered ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.common import MISSING, bucketed_rank, cut, is_missing, nfc_all, spread_join

#: Most links that one task merges.
FOREST_LINKS = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (node, root), the root being the least node of its tree."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.string()), pa.array([find(x) for x in nodes], pa.string())], names=["node", "root"]
    )


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours that are larger (or not) than a node link to its least neighbour."""
    both = links.select(F.col("node").alias("u"), F.col("root").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = spread_join(both, least, ["u"], "inner")  # a star may hold a third of all links
    if large:
        out = joined.where("v > u").select(F.col("v").alias("node"), F.col("m").alias("root"))
    else:
        out = joined.select(F.col("v").alias("node"), F.col("m").alias("root")).unionByName(
            least.select(F.col("u").alias("node"), F.col("m").alias("root"))
        )
    return out.where("node <> root").distinct()


def components(links: DataFrame, forest_links: int = FOREST_LINKS) -> DataFrame:
    """node, root for every node of ``links`` (columns a, b) but the roots themselves."""
    pairs = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    schema = "node string, root string"
    forest = cut(pairs.select("a", "b").mapInArrow(_forest, schema))
    tasks = max(1, forest.rdd.getNumPartitions())
    size = forest.count()
    while tasks > 1 and size:
        fewer = max(1, tasks // 8)
        # trees of one root meet in one task: the fullest one counts, not the sum
        goes_to = F.xxhash64("root")
        fullest = forest.groupBy(F.pmod(F.hash(goes_to), F.lit(fewer)).alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
        if fullest.agg(F.max("_n")).first()[0] > forest_links:
            break
        merged = forest.repartition(fewer, goes_to) if fewer > 1 else forest.coalesce(1)
        forest = cut(merged.mapInArrow(_forest, schema))
        tasks, size = fewer, forest.count()
    if tasks > 1 and size:
        while True:
            step = cut(_star(_star(forest, True), False))
            changed = step.exceptAll(forest).limit(1).count() or forest.exceptAll(step).limit(1).count()
            forest = step
            if not changed:
                break
    return forest


def persons(speakers: DataFrame) -> DataFrame:
    """id (normalised, of register or link), person: the name of its component."""
    pair = speakers.select(nfc_all(F.array("speaker_id", "same_as")).alias("_v")).select(
        *[F.lower(F.trim(F.col("_v")[i])).alias(c) for i, c in enumerate("ab")]
    )
    pair = cut(pair.where(~is_missing(F.col("a"))))
    roots = components(pair.where(~is_missing(F.col("b"))))
    registered = pair.select(F.col("a").alias("id")).distinct().withColumn("listed", F.lit(True))
    linked = roots.select(F.col("node").alias("id"), "root").unionByName(
        roots.select(F.col("root").alias("id"), "root").distinct()
    )
    everyone = cut(registered.join(linked, "id", "full").withColumn("root", F.coalesce("root", "id")))
    names = everyone.groupBy("root").agg(F.min(F.when(F.col("listed"), F.col("id"))).alias("least"))
    return spread_join(everyone, names, ["root"], "inner").select("id", F.coalesce("least", "root").alias("person"))


def entities(current_utterances: DataFrame, speakers: DataFrame) -> DataFrame:
    """instance_id, entity, kind ('person', 'recording', 'record'), split (normalised)."""
    rows = current_utterances.select(
        "instance_id", "file_id", nfc_all(F.array("speaker", "split")).alias("_v")
    ).select("instance_id", "file_id", *[F.lower(F.trim(F.col("_v")[i])).alias(c) for i, c in enumerate(["who", "split"])])
    known = rows.withColumn("who", F.when(F.col("who").isin(*MISSING), None).otherwise(F.col("who")))
    # only speakers whose name isn't their own id need a look-up; all others keep theirs
    renamed = cut(persons(speakers).where("id <> person")).withColumnRenamed("id", "who")
    return spread_join(known, renamed, ["who"]).select(
        "instance_id",
        F.coalesce("person", "who", "file_id", "instance_id").alias("entity"),
        F.when(F.col("who").isNotNull(), "person").when(F.col("file_id").isNotNull(), "recording").otherwise("record").alias("kind"),
        "split",
    )


def greedy(sizes: list[tuple[int, int]], shares: list[float]) -> list[tuple[int, list[int]]]:
    """For each (size, groups), largest first: how many of the groups each split gets.

    The split with the largest gap to its target takes the next group. For many
    groups of one size the course is that of merging falling sequences, so all
    but the last few are given out at once."""
    total = sum(s * n for s, n in sizes)
    gaps = [total * share for share in shares]
    out = []
    for size, groups in sorted(sizes, reverse=True):
        got = [0] * len(gaps)
        if groups > 64:
            # level to which `groups` steps of `size` can lower the gaps, kept a step per split high
            order = sorted(range(len(gaps)), key=lambda i: -gaps[i])
            for k in range(len(order), 0, -1):
                top = order[:k]
                level = (sum(gaps[i] for i in top) - size * groups) / k
                if level <= gaps[top[-1]]:
                    break
            for i in top:
                got[i] = max(0, int((gaps[i] - level) // size) - 1)
        for i in range(len(gaps)):
            gaps[i] -= size * got[i]
        for _ in range(groups - sum(got)):
            i = max(range(len(gaps)), key=lambda i: (gaps[i], -i))
            got[i] += 1
            gaps[i] -= size
        out.append((size, got))
    return out


def assign(members: DataFrame, splits: list[tuple[str, float]], seed: str = "split") -> DataFrame:
    """``members`` (instance_id, kind, entity and others) with new_split; one that is there is replaced."""
    members = members.drop("new_split")
    groups = cut(members.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("size")))
    sizes = groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # at most sqrt(2 x records) rows
    plan = [
        (size, name, low + 1, low + n)
        for size, got in greedy([(r["size"], r["n"]) for r in sizes], [share for _, share in splits])
        for (name, _), n, low in zip(splits, got, np.cumsum([0, *got[:-1]]).tolist())
        if n
    ]
    spark = members.sparkSession
    ranges = spark.createDataFrame(plan, "size bigint, new_split string, low bigint, high bigint")
    placed = bucketed_rank(groups.withColumn("_draw", F.xxhash64(F.lit(seed), "kind", "entity")), ["size"], "_draw", "_place")
    chosen = placed.join(F.broadcast(ranges), "size").where("_place between low and high").select("kind", "entity", "new_split")
    return spread_join(members, cut(chosen), ["kind", "entity"], "inner")


def straddling(members: DataFrame, splits: tuple[str, ...] = ("train", "dev", "test")) -> DataFrame:
    """kind, entity of the groups that now lie in more than one of ``splits``."""
    bit = F.lit(0)
    for i, name in enumerate(splits):
        bit = F.when(F.col("split") == name, 1 << i).otherwise(bit)
    return (
        members.groupBy("kind", "entity").agg(F.bit_or(bit).alias("_b")).where(F.bit_count("_b") > 1).select("kind", "entity")
    )

