"""From frames to events and back: runs, post-filters, gap filling, chunks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import cut, ms
from tierflow.functions.frames import runs
from tierflow.functions.values import col
from tierflow.operators.periods import periods_and_gaps


def frames_to_events(preds: Column | str, probs: Column | str, labels: dict[int, str], frame_s, background: int = 0, chunk_start=0.0) -> Column:
    """array<struct<start_s, end_s, label, mean_prob>>: maximal runs of one class but the background.

    Runs never go on in another chunk. Times have three decimals, probabilities four."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    time = lambda i: F.bround(col(chunk_start) + i * col(frame_s), 3)
    mean = lambda r: F.bround(
        F.aggregate(F.slice(col(probs), r["first"] + 1, r["past"] - r["first"]), F.lit(0.0), lambda a, x: a + x) / (r["past"] - r["first"]), 4
    )
    kept = F.filter(runs(preds), lambda r: r["value"] != background)
    return F.transform(
        kept,
        lambda r: F.struct(
            time(r["first"]).alias("start_s"), time(r["past"]).alias("end_s"),
            F.try_element_at(names, r["value"]).alias("label"), mean(r).alias("mean_prob"),
        ),
    )


def postprocess(events: Column | str, duration, drop_initial: bool = True, drop_final: bool = True, shortest: float | None = 0.08, epsilon: float = 0.02) -> Column:
    """Events without those at the very start, at the end of the file and the short ones."""
    keep = lambda e: (
        (F.lit(not drop_initial) | (e["start_s"] != 0))
        & (F.lit(not drop_final) | (e["end_s"] < col(duration) - epsilon))
        & (F.lit(True) if shortest is None else e["end_s"] - e["start_s"] >= shortest)
    )
    return F.filter(col(events), keep)


def fill_gaps(events: DataFrame, key: str, duration: str, start: str = "start_s", end: str = "end_s", label: str = "label") -> DataFrame:
    """key, start, end, label: the events of a recording and '' for all between, before and after them.

    What lies between comes from the periods of the events, in whole milliseconds: a
    recording of any size is spread. Events that don't end after their start drop out."""
    kind = events.schema[key].dataType
    spans = events.select(F.col(key).cast("string").alias("item"), F.lit(label).alias("layer"), ms(start).alias("start_ms"), ms(end).alias("end_ms"))
    gaps = periods_and_gaps(spans).where("kind = 'gap'")
    between = gaps.select(F.col("item").cast(kind).alias(key), (F.col("start_ms") / 1000).alias(start), (F.col("end_ms") / 1000).alias(end))
    ok = events.where(F.col(end) > F.col(start))
    ends = ok.groupBy(key).agg(F.min(start).alias("_a"), F.max(end).alias("_z"), F.max(duration).alias("_d"))
    part = lambda a, b: F.struct(a.alias(start), b.alias(end))
    around = ends.select(key, F.inline(F.array(part(F.lit(0.0), F.col("_a")), part(F.col("_z"), F.col("_d"))))).where(F.col(end) > F.col(start))
    return ok.select(key, start, end, label).unionByName(between.unionByName(around).withColumn(label, F.lit("")))


def chunk_spans(duration: Column | str, length: float) -> Column:
    """array<struct<start_s, end_s>> of fixed length; one chunk for short recordings or length <= 0."""
    d = col(duration)
    if length <= 0:
        return F.array(F.struct(F.lit(0.0).alias("start_s"), d.alias("end_s")))
    n = F.greatest(F.ceil(d / F.lit(float(length))), F.lit(1)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct((i * F.lit(float(length))).alias("start_s"), F.least(d, (i + 1) * F.lit(float(length))).alias("end_s")),
    )


def islands(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Maximal runs of equal values in a long table: key, island (ascending in order), value, n.

    Rows are put in order by ranges, so that a key of any size is spread; each task
    counts its own runs, and only the first and last run of each task are compared
    with those of the next, two rows a task."""
    names = [*key, value]
    placed = cut(df.select(*dict.fromkeys([*key, *order, value])).repartitionByRange(*key, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*key, *order)
    same = lambda w: functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.lag(c).over(w)) for c in names])
    new = ~same(inside) | (F.row_number().over(inside) == 1)
    local = placed.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(inside))
    runs_ = cut(local.groupBy("_part", "_run", *names).agg(F.count(F.lit(1)).alias("n")))
    last = runs_.groupBy("_part").agg(F.max("_run").alias("_last"))
    marked = runs_.join(F.broadcast(last), "_part")  # a row a task
    at = F.shiftleft(F.col("_part").cast("bigint"), 33) + F.col("_run")
    edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_last"))
    line = Window.partitionBy(F.lit(0)).orderBy("_part", "_run")
    goes_on = same(line) & (F.col("_run") == 1) & (F.lag("_part").over(line) < F.col("_part"))
    chained = marked.where(edge).withColumn("_island", at).withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("_chain", F.sum("_new").over(line))
    joined = chained.groupBy("_chain", *names).agg(F.min("_island").alias("island"), F.sum("n").alias("n"))
    return marked.where(~edge).select(*key, at.alias("island"), value, "n").unionByName(joined.select(*key, "island", value, "n"))


def totals(events: DataFrame, key: str, start: str = "start_s", end: str = "end_s") -> DataFrame:
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(end) - F.col(start)).alias("event_s"))
