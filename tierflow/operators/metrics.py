"""Scores of predictions, all from one small confusion table or one aggregate."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import before_in_order, cut
from tierflow.functions.frames import unmasked


def confusion(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """gold, pred, n."""
    return df.groupBy(F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def frame_confusion(df: DataFrame, gold: Column, pred: Column) -> DataFrame:
    """confusion over the frames that aren't masked."""
    pairs = df.select(F.inline(unmasked(gold, pred)))
    return pairs.groupBy("gold", "pred").agg(F.count(F.lit(1)).alias("n"))


def full_confusion(conf: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Every cell of the label order (else of all labels seen) with n (0 if empty) and pct of its gold row (0 for empty rows)."""
    if order is None:
        seen = conf.select("gold").union(conf.select("pred")).distinct()
        names = seen.crossJoin(seen.withColumnRenamed("gold", "pred"))
    else:
        names = conf.sparkSession.createDataFrame([(a, b) for a in order for b in order], conf.select("gold", "pred").schema)
    row = Window.partitionBy("gold")
    cells = names.join(conf, ["gold", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return cells.withColumn("pct", F.coalesce(F.col("n") * 100.0 / F.nullif(F.sum("n").over(row), F.lit(0)), F.lit(0.0)))


def class_report(conf: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support of every label seen in gold or predictions; empty ones count 0."""
    hit = F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0))
    g = conf.groupBy(F.col("gold").alias("label")).agg(F.sum("n").alias("support"), hit.alias("tp"))
    p = conf.groupBy(F.col("pred").alias("label")).agg(F.sum("n").alias("predicted"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    both = g.join(p, "label", "full").select("label", *[zero(F.col(c)).alias(c) for c in ("support", "tp", "predicted")])
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return both.select(
        "label", ratio(F.col("tp"), F.col("predicted")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support",
    )


def classification_metrics(conf: DataFrame) -> DataFrame:
    """One row: accuracy, macro_f1 over the labels seen in gold or predictions."""
    acc = conf.agg((F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    return acc.crossJoin(F.broadcast(class_report(conf).agg(F.avg("f1").alias("macro_f1"))))  # one row each


def frame_metrics(conf: DataFrame, positive) -> DataFrame:
    """One row: accuracy, macro_f1, f1_positive (0 if the class does not occur)."""
    f1 = class_report(conf).agg(F.coalesce(F.max(F.when(F.col("label") == positive, F.col("f1"))), F.lit(0.0)).alias("f1_positive"))
    return classification_metrics(conf).crossJoin(F.broadcast(f1))  # one row each


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct pairs of two numbers with their counts, as a table that is read several times."""
    return cut(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n")))


def _rho(pairs: DataFrame) -> DataFrame:
    """One row: rho, n. Ranks are worked out on the distinct values and their counts, by
    ranges of values, so that no task sorts all of them."""

    def ranks(c: str, name: str) -> DataFrame:
        per = before_in_order(pairs.groupBy(c).agg(F.sum("n").alias("_k")), [c], "_k", "_before")
        return per.select(c, (F.col("_before") + (F.col("_k") + 1) / 2).alias(name))

    r = pairs.join(ranks("a", "_ra"), "a").join(ranks("b", "_rb"), "b")
    n, sa, sb = F.sum("n"), F.sum(F.col("n") * F.col("_ra")), F.sum(F.col("n") * F.col("_rb"))
    cov = F.sum(F.col("n") * F.col("_ra") * F.col("_rb")) - sa * sb / n
    va = F.sum(F.col("n") * F.col("_ra") * F.col("_ra")) - sa * sa / n
    vb = F.sum(F.col("n") * F.col("_rb") * F.col("_rb")) - sb * sb / n
    return r.agg((cov / F.sqrt(F.nullif(va, F.lit(0.0)) * F.nullif(vb, F.lit(0.0)))).alias("rho"), n.alias("n"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rho, average ranks for ties; NULL if either side is constant."""
    return _rho(_pairs(df, a, b)).select("rho")


def p_value(rho: Column, n: Column) -> Column:
    """Two-sided p of a rank correlation by Student's t with n - 2 degrees of freedom; NULL for n < 3.

    The t distribution is the regularised incomplete beta function, worked out on
    one row by its continued fraction (a Python call; there is no built-in one)."""

    @F.pandas_udf("double")
    def tail(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) or pd.isna(m) or m < 3 else t_tail(float(x), int(m)) for x, m in zip(r, k)])

    return tail(rho, n)


def t_tail(rho: float, n: int) -> float:
    free = n - 2
    if abs(rho) >= 1:
        return 0.0
    # P(|T| > t) = I_x(free / 2, 1 / 2) with x = free / (free + t^2) = 1 - rho^2
    return beta_share(1 - rho * rho, free / 2, 0.5)


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    out = d
    for m in range(1, 10_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or tiny)
            c = (1 + top / c) or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * out


def regression_metrics(df: DataFrame, gold: str, pred: str, mean: float = 0.0, std: float = 1.0) -> DataFrame:
    """One row: mse, mae in the label's own unit (``mean`` and ``std`` undo a normalisation), rho and its p_value."""
    pairs = _pairs(df, gold, pred)
    d = (F.col("b") - F.col("a")) * F.lit(float(std if std >= 1e-8 else 1.0))
    n = F.sum("n")
    errors = pairs.agg((F.sum(d * d * F.col("n")) / n).alias("mse"), (F.sum(F.abs(d) * F.col("n")) / n).alias("mae"))
    rho = _rho(pairs).select("rho", p_value(F.col("rho"), F.col("n")).alias("p_value"))
    return errors.crossJoin(F.broadcast(rho))  # one row each


def predictions(df: DataFrame, gold: str, pred: str, order: list[str] | None = None, scale: tuple[float, float] | None = None) -> DataFrame:
    """What is exported of a model's predictions: ids, bounds, gold_label, pred_label and the raw values.

    Class numbers become names by ``order``; numbers are put back into the label's
    unit by ``scale`` (mean, std). Columns the input lacks are NULL."""
    have = lambda c, kind: (F.col(c) if c in df.columns else F.lit(None).cast(kind)).alias(c)
    if order is not None:
        names = F.array(*[F.lit(x) for x in order])
        named = lambda c: F.get(names, F.col(c).cast("int"))
    elif scale is not None:
        mean, std = scale
        named = lambda c: F.col(c) * F.lit(float(std if std >= 1e-8 else 1.0)) + F.lit(float(mean))
    else:
        named = F.col
    return df.select(
        have("instance_id", "string"), have("file_id", "string"), have("start_t", "double"), have("end_t", "double"),
        named(gold).alias("gold_label"), named(pred).alias("pred_label"), F.col(gold).alias("gold_raw"), F.col(pred).alias("pred_raw"),
    )


def frame_predictions(df: DataFrame, gold: str, pred: str, probs: str | None = None) -> DataFrame:
    """Exported frames: n_frames, gold and pred without the masked frames, both raw, and the positive class's probabilities."""
    kept = unmasked(gold, pred)
    return df.select(
        "instance_id", "file_id", F.size(kept).alias("n_frames"), F.transform(kept, lambda x: x["gold"]).alias("gold"),
        F.transform(kept, lambda x: x["pred"]).alias("pred"), F.col(gold).alias("gold_raw"), F.col(pred).alias("pred_raw"),
        (F.col(probs) if probs else F.lit(None).cast("array<double>")).alias("prob_pos"),
    )


def report_with_averages(conf: DataFrame) -> DataFrame:
    """class_report with the rows 'macro avg' (each class counts once) and 'weighted avg' (by support)."""
    per = class_report(conf)
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per.agg(*[(F.sum(F.col(c) * F.col("support")) / F.nullif(F.sum("support"), F.lit(0))).alias(c) for c in names], F.sum("support").alias("support"))
    named = lambda d, n: d.select(F.lit(n).alias("label"), *names, "support")
    return per.select(F.col("label").cast("string").alias("label"), *names, "support").unionByName(named(macro, "macro avg")).unionByName(named(weighted, "weighted avg"))


def best_epoch(df: DataFrame, run: str, epoch: str, metric: str, lower_is_better: bool = False) -> DataFrame:
    """The best epoch of each run; NaN and NULL never win, the earlier wins ties."""
    worst = float("inf") if lower_is_better else float("-inf")
    value = F.coalesce(F.nanvl(F.col(metric), F.lit(worst)), F.lit(worst))
    w = Window.partitionBy(run).orderBy(value.asc() if lower_is_better else value.desc(), epoch)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def running_best(df: DataFrame, run: str, epoch: str, metric: str) -> DataFrame:
    """``df`` with best_so_far and improved."""
    w = Window.partitionBy(run).orderBy(epoch)
    before = F.max(F.nanvl(metric, F.lit(None).cast("double"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    value = F.nanvl(F.col(metric), F.lit(None).cast("double"))
    return df.withColumn("best_so_far", F.greatest(before, value)).withColumn("improved", value.isNotNull() & F.coalesce(value > before, F.lit(True)))


def ranking(df: DataFrame, metric: str, error: str = "error") -> DataFrame:
    """Runs without an error and with a number, worst first."""
    value = F.col(metric).try_cast("double")
    return df.where((F.coalesce(error, F.lit("")) == "") & value.isNotNull()).orderBy(value)


def eta_seconds(n_train: int, n_dev: int, epochs: int, rate: float) -> float:
    """Rough time of both phases: train, then train and dev, at ``rate`` records a second."""
    return (n_train * epochs + (n_train + n_dev) * epochs) / rate


def recalibrated_eta(done: int, elapsed: float, left: int) -> float:
    """Seconds still needed for ``left`` records at the rate seen so far."""
    return left * elapsed / done if done else float("inf")
