"""Joins of time-aligned tiers, look-ups and coverage.

Every interval join has the recording as an equi key and tests the times in the
same join condition, so it is planned as a hash or sort-merge join. For long
recordings ``overlap_pairs`` adds a time block to the key: an interval is
repeated in each block it touches and a pair is kept in the block where it
begins, so that one recording with a third of all rows is spread over its
blocks. Times are compared in whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import before_in_order, small

BLOCK_MS = 60_000


def last_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def align_tiers(driving: DataFrame, others: dict[str, DataFrame], order: list[str]) -> DataFrame:
    """Labels of other tiers with the same file, speaker, start_ms and end_ms; the last duplicate wins.

    Driving rows without a bound are dropped; a missing label is NULL. A NULL
    speaker only meets a NULL speaker."""
    key = ["file_id", "_who", "start_ms", "end_ms"]
    who = F.struct("speaker")  # never NULL, so that the join can hash it
    out = driving.where("start_ms is not null and end_ms is not null").withColumn("_who", who)
    for name, tier in others.items():
        right = last_of(tier.where("start_ms is not null and end_ms is not null").withColumn("_who", who), key, order)
        out = out.join(right.select(*key, F.col("label").alias(name)), key, "left")
    return out.drop("_who")


def blocks(df: DataFrame, start: Column, end: Column, width: int = BLOCK_MS) -> DataFrame:
    """``df`` once per time block that [start, end] touches, as column _block."""
    a, b = F.floor(start / width), F.floor(F.greatest(end, start) / width)
    return df.withColumn("_block", F.explode(F.sequence(a, b)))


def overlap_pairs(left: DataFrame, right: DataFrame, keys: list[str], tolerance: int = 0, width: int = BLOCK_MS) -> DataFrame:
    """Pairs with right.end + tol >= left.start and right.start - tol <= left.end.

    ``left`` and ``right`` have the keys, start_ms and end_ms; right's columns come
    with the prefix r_. Rows without a bound have no pairs."""
    ok = "start_ms is not null and end_ms is not null and end_ms >= start_ms"
    r = right.where(ok).select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    lo, hi = F.col("r_start_ms") - tolerance, F.col("r_end_ms") + tolerance
    a = blocks(left.where(ok), F.col("start_ms"), F.col("end_ms"), width)
    b = blocks(r, lo, hi, width)
    meet = F.floor(F.greatest(F.col("start_ms"), lo) / width)
    return a.join(b, [*keys, "_block"]).where((hi >= F.col("start_ms")) & (lo <= F.col("end_ms")) & (F.col("_block") == meet)).drop("_block")


def overlap_counts(left: DataFrame, right: DataFrame, keys: list[str], item: list[str], tolerance: int = 1) -> DataFrame:
    """``left`` with n (overlapping rows of right) and flag (0 or 1).

    No pair is made: of the rows of right that begin by an interval's end, those that
    ended before its start are taken off. Both numbers are sums over the times in
    order, by ranges, so a recording of any size is spread."""
    ok = "start_ms is not null and end_ms is not null and end_ms >= start_ms"
    known = " and ".join(f"`{k}` is not null" for k in keys)
    a = left.where(ok).where(known).select(*dict.fromkeys([*keys, *item, "start_ms", "end_ms"]))
    b = right.where(ok).where(known).select(*keys, "start_ms", "end_ms")
    who = F.struct(*item)
    none = F.lit(None).cast(a.select(who.alias("w")).schema["w"].dataType)
    place = lambda sign, t, late, w, one: F.struct(F.lit(sign).alias("_sign"), t.alias("_t"), F.lit(late).alias("_late"), w.alias("_who"), F.lit(one).cast("bigint").alias("_one"))
    # an own place follows what begins at its time, and precedes what ends there
    asked = a.select(*keys, F.inline(F.array(place(1, F.col("end_ms") + tolerance, 1, who, 0), place(-1, F.col("start_ms") - tolerance, 0, who, 0))))
    given = b.select(*keys, F.inline(F.array(place(1, F.col("start_ms"), 0, none, 1), place(-1, F.col("end_ms"), 1, none, 1))))
    line = before_in_order(asked.unionByName(given), ["_sign", *keys, "_t", "_late"], "_one", "_n")
    # all ends come before all begins in that order, and what other keys hold is the same in both
    total = b.agg(F.count(F.lit(1)).alias("_all"))
    per = line.where("_who is not null").groupBy("_who").agg(F.sum(F.col("_sign") * F.col("_n")).alias("_d"))
    counts = per.crossJoin(F.broadcast(total)).select("_who.*", (F.col("_d") - F.col("_all")).alias("n"))  # one row
    return left.join(counts, item, "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("flag", (F.col("n") > 0).cast("int"))


def containing_label(inner: DataFrame, outer: DataFrame, keys: list[str], item: list[str], order: str = "idx", tolerance: int = 1) -> DataFrame:
    """``inner`` with label of the first (by ``order``) outer interval that holds it within the tolerance; '' is NULL."""
    pairs = overlap_pairs(inner.select(*dict.fromkeys([*keys, *item, "start_ms", "end_ms"])), outer, keys, tolerance)
    held = pairs.where((F.col("r_start_ms") - tolerance <= F.col("start_ms")) & (F.col("end_ms") <= F.col("r_end_ms") + tolerance))
    best = held.groupBy(*item).agg(F.min_by(F.struct("r_label"), F.struct(f"r_{order}", "r_start_ms", "r_end_ms", "r_label")).alias("_b"))
    return inner.join(best, item, "left").withColumn("outer_label", F.nullif(F.col("_b.r_label"), F.lit(""))).drop("_b")


def marks_in_words(marks: DataFrame, words: DataFrame, keys: list[str], item: list[str], tolerance: int = 1) -> DataFrame:
    """``marks`` with word_idx: the first word that holds the mark, else the first that holds its
    middle, else NULL; and note: 'stress_outside_word' for the latter."""
    pairs = overlap_pairs(marks.select(*dict.fromkeys([*keys, *item, "start_ms", "end_ms"])), words, keys, tolerance)
    full = (F.col("r_start_ms") - tolerance <= F.col("start_ms")) & (F.col("end_ms") <= F.col("r_end_ms") + tolerance)
    middle = (F.col("start_ms") + F.col("end_ms")) / 2
    half = middle.between(F.col("r_start_ms"), F.col("r_end_ms"))
    best = (
        pairs.withColumn("_tier", F.when(full, 0).when(half, 1))
        .where("_tier is not null")
        .groupBy(*item)
        .agg(F.min(F.struct("_tier", "r_idx")).alias("_b"))
    )
    return marks.join(best, item, "left").withColumn("word_idx", F.col("_b.r_idx")).drop("_b").withColumn("note", F.when(F.col("word_idx").isNull(), "stress_outside_word"))


def slice_within(items: Column, lo: Column, hi: Column, start: str = "time_s", end: str = "time_e", tolerance: float = 1e-3) -> Column:
    """The intervals of an array that overlap [lo, hi], counted from lo and cut to it. No shuffle."""
    inside = F.filter(items, lambda g: (g[end] > lo + tolerance) & (g[start] < hi - tolerance))
    place = lambda t: F.bround(F.least(F.greatest(t - lo, F.lit(0.0)), hi - lo), 3)
    return F.transform(inside, lambda g: g.withField(start, place(g[start])).withField(end, place(g[end])))


def parent_of(events: DataFrame, parents: DataFrame, key: str, order: list[str], keep_orphans: bool = False) -> DataFrame:
    """Events with their parent (prefix p_), the last parent of a key; orphans dropped or kept."""
    right = last_of(parents.where(F.col(key).isNotNull()), [key], order)
    named = right.select(key, *[F.col(c).alias(f"p_{c}") for c in parents.columns if c != key])
    return events.join(named, key, "left" if keep_orphans else "inner")


def resolve(records: DataFrame, index: DataFrame, key: str, preference: list[str]) -> DataFrame:
    """Records with the path of their key: the first of the index by ``preference``; unresolved rows drop out."""
    first = index.groupBy(key).agg(F.min(F.struct(*preference, F.col("path").alias("_path")))["_path"].alias("path"))
    return records.join(small(first), key)


def resolve_chain(records: DataFrame, index: DataFrame, tries: list[tuple[Column, str]], preference: list[str]) -> DataFrame:
    """Records with path and found_by of the first try that is in the index; unresolved rows have NULLs.

    ``tries``: (key of a record, column of the index), in order: its stem, an explicit
    path, a base name. Of several paths of one key the first by ``preference`` wins.
    All tries are looked up in one join: the keys are rows, the earliest hit is kept."""
    of = lambda n, key: F.struct(F.lit(n).alias("_try"), key.cast("string").alias("_key"))
    listed = index.select(F.struct(*preference, F.col("path").alias("_path")).alias("_p"), F.inline(F.array(*[of(i, F.col(c)) for i, (_, c) in enumerate(tries)])))
    first = listed.where("_key is not null").groupBy("_try", "_key").agg(F.min("_p")["_path"].alias("path"))
    marked = records.withColumn("_row", F.struct(*records.columns))
    asked = marked.select("_row", F.inline(F.array(*[of(i, k) for i, (k, _) in enumerate(tries)]))).distinct()
    hits = asked.join(small(first), ["_try", "_key"]).groupBy("_row").agg(F.min_by(F.struct("path", "_try"), "_try").alias("_hit"))
    names = F.array(*[F.lit(c) for _, c in tries])
    return marked.join(hits, "_row", "left").select(*records.columns, F.col("_hit.path").alias("path"), F.get(names, F.col("_hit._try")).alias("found_by"))


def first_existing(records: DataFrame, candidates: Column, files: DataFrame, item: list[str]) -> DataFrame:
    """Records with path: the first of an array of candidate paths that is among ``files`` (path); NULL if none is."""
    asked = records.select(*item, F.posexplode(candidates).alias("_pos", "path"))
    there = asked.join(files.select("path").distinct(), "path").groupBy(*item).agg(F.min_by("path", "_pos").alias("path"))
    return records.join(there, item, "left")


def manifest(df: DataFrame, look_ups: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """``df`` left-joined to look-ups (table, key here, key there) one after the other; of a repeated key one row counts."""
    for other, here, there in look_ups:
        df = df.join(small(other.where(F.col(there).isNotNull()).dropDuplicates([there])), F.col(here) == F.col(there), "left")
    return df


def collisions(index: DataFrame, key: str) -> DataFrame:
    """Keys with several paths, and how many."""
    return index.groupBy(key).agg(F.count_distinct("path").alias("n_paths")).where("n_paths > 1")


def has_all(df: DataFrame, base: str, layer: str, needed: list[str]) -> DataFrame:
    """Bases that have every needed layer."""
    return (
        df.where(F.col(layer).isin(*needed)).groupBy(base).agg(F.count_distinct(layer).alias("_n")).where(F.col("_n") == len(set(needed))).select(base)
    )


def todo(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items not yet done (NULL keys are never done)."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def shared_between(df: DataFrame, key: str, group: str) -> DataFrame:
    """group_a, group_b, n: how many keys two groups share. Pairs are of the groups of one key, few as splits are."""
    sets = df.where(F.col(key).isNotNull() & F.col(group).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(group)).alias("g"))
    pairs = F.flatten(F.transform("g", lambda a: F.transform(F.filter("g", lambda b: b > a), lambda b: F.struct(a.alias("group_a"), b.alias("group_b")))))
    return sets.select(F.inline(pairs)).groupBy("group_a", "group_b").agg(F.count(F.lit(1)).alias("n"))


def split_conflicts(a: DataFrame, b: DataFrame, key: str = "file_id") -> DataFrame:
    """Keys whose split differs between two tables."""
    left = a.groupBy(key).agg(F.min("split").alias("split_a"))
    right = b.groupBy(key).agg(F.min("split").alias("split_b"))
    return left.join(right, key).where("split_a <> split_b")


def not_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The distinct values of a column that another table lacks: missing categories, unknown labels."""
    return a.where(F.col(key).isNotNull()).select(key).distinct().join(b.select(key), key, "left_anti")


def shared_and_all(df: DataFrame, key: str, group: str) -> DataFrame:
    """shared_between with n_either (keys of one group or the other) and share."""
    sizes = df.where(F.col(key).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(key).alias("_k"))
    side = lambda g: sizes.select(F.col(group).alias(g), F.col("_k").alias(f"_{g}"))
    both = shared_between(df, key, group).join(side("group_a"), "group_a").join(side("group_b"), "group_b")
    either = F.col("_group_a") + F.col("_group_b") - F.col("n")
    return both.select("group_a", "group_b", "n", either.alias("n_either"), (F.col("n") / either).alias("share"))
