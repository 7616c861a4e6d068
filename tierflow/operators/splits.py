"""Train, dev and test splits, balancing, caps and quota selection.

Random orders are hashes of seed and id, so that a result does not depend on the
plan. Ranks within classes, splits or data sets are worked out by
``bucketed_rank``: no class is sorted in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import bucketed_rank, with_totals
from tierflow.functions.ids import draw, stable_hash
from tierflow.schema import SPLITS

#: Fixed value: the default seed of hash splits, part of every hashed key.
SEED = "speech-ml-pipeline"


def hash_split(group: Column, item: Column, ratios=(0.8, 0.1, 0.1), seed: str = SEED) -> Column:
    """Split of a record by the hash of its group (of its id if the group is NULL or empty)."""
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError(f"ratios must sum to 1, got {ratios}")
    key = F.concat(F.lit(f"{seed}::"), F.coalesce(F.nullif(group.cast("string"), F.lit("")), item.cast("string"), F.lit("")))
    x = stable_hash(key)
    return F.when(x < ratios[0], "train").when(x < ratios[0] + ratios[1], "dev").otherwise("test")


def assign_splits(df: DataFrame, group: str = "file_id", item: str = "instance_id", ratios=(0.8, 0.1, 0.1), seed: str = SEED, overwrite: bool = False) -> DataFrame:
    """``df`` with split; valid splits stay unless ``overwrite``. No shuffle."""
    new = hash_split(F.col(group), F.col(item), ratios, seed)
    if overwrite or "split" not in df.columns:
        return df.withColumn("split", new)
    return df.withColumn("split", F.when(F.col("split").isin(*SPLITS), F.col("split")).otherwise(new))


def split_summary(df: DataFrame) -> DataFrame:
    """split, n for train, dev, test and other, zeros included."""
    name = F.when(F.col("split").isin(*SPLITS), F.col("split")).otherwise("other")
    every = df.sparkSession.createDataFrame([(s,) for s in (*SPLITS, "other")], "split string")
    counts = df.groupBy(name.alias("split")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))


def override_split(df: DataFrame, by_file: DataFrame, by_stem: DataFrame, stem: Column, fallback: Column) -> DataFrame:
    """Split of a look-up by file_id, else of one by audio stem (first row of a key), else ``fallback``."""
    one = lambda d, k: d.groupBy(k).agg(F.min("split").alias(f"_{k}_split"))
    out = df.withColumn("wav_stem", stem).join(one(by_file, "file_id"), "file_id", "left").join(one(by_stem, "wav_stem"), "wav_stem", "left")
    return out.withColumn("split", F.coalesce("_file_id_split", "_wav_stem_split", fallback)).drop("_file_id_split", "_wav_stem_split", "wav_stem")


def leaks(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """key, n_splits of the keys that lie in more than one split: must be empty."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def speaker_disjoint(df: DataFrame, speaker: str = "speaker", ratios=(0.8, 0.1, 0.1), seed: str = SEED) -> DataFrame:
    """speaker, n, split: shuffled speakers go one by one to the split with the lowest count / quota.

    Quotas are round(ratio x rows), test takes what rounding leaves; ties go to train,
    then dev. The course is inherently sequential over speakers (not rows): one task
    reads their sorted counts once and holds nothing but the three loads."""
    counts = df.groupBy(speaker).agg(F.count(F.lit(1)).alias("n"))
    ordered = with_totals(counts, _t=F.sum("n")).withColumn("_o", draw(seed, F.coalesce(speaker, F.lit(""))))
    kind = df.schema[speaker].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load, quota = [0, 0, 0], None
        for batch in batches:
            goes = []
            for n, total in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if quota is None:
                    quota = [round(ratios[0] * total), round(ratios[1] * total)]
                    quota = [max(1, q) for q in (*quota, total - sum(quota))]
                i = min(range(3), key=lambda i: load[i] / quota[i])
                load[i] += n
                goes.append(SPLITS[i])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(goes, pa.string())], names=[speaker, "n", "split"])

    one = ordered.repartition(1).sortWithinPartitions("_o", speaker).select(speaker, "n", "_t")
    return one.mapInArrow(run, f"`{speaker}` {kind}, n bigint, split string")


def _number(seed: str, item: Column | str) -> Column:
    """draw as a BIGINT in the same order (its first 60 bits)."""
    return F.conv(F.substring(draw(seed, item), 1, 15), 16, 10).cast("bigint") * 8 - F.lit((1 << 63) - 1) - 1


def _ranked(df: DataFrame, group: list[str], item: str, seed: str) -> DataFrame:
    return bucketed_rank(df.withColumn("_draw", _number(seed, item)), group, "_draw", "_rank").drop("_draw")


def balance_classes(df: DataFrame, label: Column, item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """As many rows of each class as the smallest has; rows without a class are dropped,
    and without any class the input comes back. The drawn rows have the least MD5 of seed::id."""
    marked = df.withColumn("_class", label)
    counts = marked.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    least = counts.agg(F.min(F.when(F.col("_class").isNotNull(), F.col("_n"))).alias("_least"))
    ranked = _ranked(marked, ["_class"], item, seed).crossJoin(F.broadcast(least))  # one row
    return ranked.where("_least is null or (_class is not null and _rank <= _least)").drop("_rank", "_least", "_class")


def balance_train(df: DataFrame, labels: list[Column], item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """balance_classes of the train rows by one label after the other; dev and test stay."""
    train = df.where("split = 'train'")
    for label in labels:
        train = balance_classes(train, label, item, seed)
    return train.unionByName(df.where("split is null or split <> 'train'"))


def cap_fraction(df: DataFrame, fraction: float, item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """Of each split max(1, round(rows x fraction)) rows, drawn by hash."""
    sizes = df.groupBy("split").agg(F.greatest(F.lit(1), F.rint(F.count(F.lit(1)) * F.lit(fraction))).cast("bigint").alias("_keep"))
    ranked = _ranked(df, ["split"], item, seed)
    same = ranked["split"].eqNullSafe(sizes["split"])
    return ranked.join(F.broadcast(sizes), same).where("_rank <= _keep").select(*[ranked[c] for c in df.columns])  # one row per split


def fraction_for_hours(df: DataFrame, seconds: Column, hours: float) -> float:
    """The fraction of rows that stands for a target of hours (a row fraction, at most 1)."""
    total = df.agg(F.sum(seconds) / 3600).first()[0] or 0.0
    return min(1.0, hours / total) if total else 1.0


def cap_balanced(df: DataFrame, n: int, by: str, item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """n rows, one of each value of ``by`` in turn (sorted), each value's rows in drawn order."""
    return _ranked(df, [by], item, seed).orderBy("_rank", by).limit(n).drop("_rank")


def cap_plain(df: DataFrame, n: int, item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """n rows in drawn order."""
    return df.orderBy(draw(seed, item)).limit(n)


def cap_per_split(df: DataFrame, caps: dict[str, int], item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """At most caps[split] rows of each named split."""
    most = F.coalesce(*[F.when(F.col("split") == s, n) for s, n in caps.items()], F.lit(0))
    return _ranked(df.where(F.col("split").isin(*caps)), ["split"], item, seed).where(F.col("_rank") <= most).drop("_rank")


def select_quota(df: DataFrame, group: str, speaker: str, quotas: dict[str, int], item: str = "instance_id", seed: str = SEED) -> DataFrame:
    """Per group, speakers in turn (wide before deep) until the quota is met.

    Adds turn (which of the speaker's items) and place (in the group). The constant
    bounds let Spark cut speakers and groups down before they are shuffled."""
    bound = max(quotas.values(), default=0)
    most = F.coalesce(*[F.when(F.col(group) == g, n) for g, n in quotas.items()], F.lit(0))
    turns = Window.partitionBy(group, speaker).orderBy(draw(seed, item), item)
    seen = df.where(F.col(group).isin(*quotas)).withColumn("turn", F.row_number().over(turns)).where(F.col("turn") <= bound).where(F.col("turn") <= most)
    places = Window.partitionBy(group).orderBy("turn", draw(seed, speaker), speaker)
    return seen.withColumn("place", F.row_number().over(places)).where(F.col("place") <= bound).where(F.col("place") <= most)


def quota_report(eligible: DataFrame, selected: DataFrame, group: str, speaker: str, quotas: dict[str, int], ideal: int) -> DataFrame:
    """Per group: eligible speakers, used speakers, selected, most and median per speaker, over_ideal, quota_met."""
    per = selected.groupBy(group, speaker).agg(F.count(F.lit(1)).alias("n"))
    used = per.groupBy(group).agg(
        F.count(F.lit(1)).alias("speakers_used"), F.sum("n").alias("selected"), F.max("n").alias("most"),
        F.median("n").alias("median"), F.count_if(F.col("n") > ideal).alias("over_ideal"),
    )
    pool = eligible.where(F.col(group).isin(*quotas)).groupBy(group).agg(F.count_distinct(speaker).alias("speakers_eligible"))
    want = F.coalesce(*[F.when(F.col(group) == g, n) for g, n in quotas.items()])
    return pool.join(used, group, "left").withColumn("quota_met", F.coalesce(F.col("selected") >= want, F.lit(False)))


def interleave(selected: DataFrame, group: str, place: str = "place", per_folder: int = 50) -> DataFrame:
    """index (from 0) of the groups' rows in turn, folder batch_NN and name part NNNN."""
    w = Window.orderBy(place, group)  # the selection is bounded by its quotas
    out = selected.withColumn("index", F.row_number().over(w) - 1)
    return out.withColumn("folder", F.format_string("batch_%02d", F.floor(F.col("index") / per_folder).cast("int"))).withColumn("number", F.lpad(F.col("index").cast("string"), 4, "0"))


def tiers(df: DataFrame, error: str, size: str, item: str, k: int, seed: str = SEED) -> DataFrame:
    """k best, k worst and k other rows by error, with tier; a row is in one tier only."""
    best = df.orderBy(F.col(error), F.col(size).desc(), item).limit(k).withColumn("tier", F.lit("best"))
    rest = df.join(best.select(item), item, "left_anti")
    worst = rest.orderBy(F.col(error).desc(), F.col(size).desc(), item).limit(k).withColumn("tier", F.lit("worst"))
    other = rest.join(worst.select(item), item, "left_anti").orderBy(draw(seed, item)).limit(k).withColumn("tier", F.lit("random"))
    return best.unionByName(worst).unionByName(other)


def trial_rows(df: DataFrame, order: list[str], n: int | None = 10) -> DataFrame:
    """The first n rows in order for a trial run; all of them if n is None."""
    return df if n is None else df.orderBy(*order).limit(n)


def for_training(df: DataFrame, with_dev: bool = True) -> DataFrame:
    """Train rows, and dev rows with them for a final fit."""
    return df.where(F.col("split").isin(*(("train", "dev") if with_dev else ("train",))))
