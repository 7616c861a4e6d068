"""Label machinery: rare classes, weights, orders, normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import small, with_totals


def collapse_rare(df: DataFrame, label: str, max_ratio: float, other: str = "Other") -> DataFrame:
    """``df`` with labels below (largest train class / max_ratio) replaced by ``other``, unseen ones too."""
    counts = df.where("split = 'train'").where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    kept = with_totals(counts, _top=F.max("_n")).where(F.col("_n") >= F.col("_top") / max_ratio)
    marked = df.join(small(kept.select(label, F.lit(True).alias("_kept"))), label, "left")
    value = F.when(F.col(label).isNull() | F.col("_kept"), F.col(label)).otherwise(other)
    return marked.withColumn(label, value).drop("_kept").select(*df.columns)


def class_weights(df: DataFrame, label: str, order: list[str], root: bool = False) -> DataFrame:
    """label, n, weight: 1/n (or its root), with mean 1 over the classes that occur; 0 for the others."""
    names = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(order)], f"id int, `{label}` string")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    n = names.join(counts, label, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    raw = F.when(F.col("n") > 0, 1 / (F.sqrt("n") if root else F.col("n")))
    return n.withColumn("_w", raw).withColumn("weight", F.coalesce(F.col("_w") / F.avg("_w").over(Window.partitionBy()), F.lit(0.0))).drop("_w")


def label_order(df: DataFrame, label: str) -> DataFrame:
    """One row, labels: the distinct labels as strings, sorted."""
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("_l")).distinct().agg(F.array_sort(F.collect_set("_l")).alias("labels"))


def zscore(df: DataFrame, value: str, fit_on: str = "train") -> DataFrame:
    """``df`` with z: (value - mean) / std of the split ``fit_on``; population std, below 1e-8 it is 1."""
    fit = df.where(F.col("split") == fit_on).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    safe = F.when(F.col("_s") < 1e-8, F.lit(1.0)).otherwise(F.col("_s"))
    return df.crossJoin(F.broadcast(fit)).withColumn("z", (F.col(value) - F.col("_m")) / safe).drop("_m", "_s")  # one row


def unzscore(df: DataFrame, z: str, mean: float, std: float) -> DataFrame:
    return df.withColumn("value", F.col(z) * (std if std >= 1e-8 else 1.0) + mean)
