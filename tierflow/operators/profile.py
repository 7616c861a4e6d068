"""Profiles of tables: counts, shares, quantiles, histograms, warnings.

All are hash aggregates with map-side combine; shares come from one row of totals,
ranks from windows over the aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import before_in_order, with_totals


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """keys, n and pct of all rows."""
    n = with_totals(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), _total=F.sum("n"))
    return n.withColumn("pct", F.col("n") * 100.0 / F.greatest("_total", F.lit(1))).drop("_total")


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of row x column with zeros for empty cells."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0, values)


def hours(df: DataFrame, key: str, seconds: Column) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), (F.sum(seconds) / 3600).alias("hours"))


def _at_shares(df: DataFrame, keys: list[str], value: Column, shares: list[float]) -> DataFrame:
    """keys, n, lo, hi and q (array): exact quantiles with linear interpolation of the values that aren't NULL.

    Values are counted first, then placed by running counts over ranges of values: no
    task holds the values of a group."""
    counted = df.select(F.struct(*keys).alias("_g"), value.cast("double").alias("_v")).groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_k"))
    line = before_in_order(counted.where("_v is not null"), ["_g", "_v"], "_k", "_before")
    sums = line.groupBy("_g").agg(F.min("_before").alias("_off"), F.sum("_k").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    first = F.col("_before") - F.col("_off")
    at = lambda i: F.max(F.when((first <= i) & (i < first + F.col("_k")), F.col("_v")))

    def quantile(share: float) -> Column:
        place = F.lit(share) * (F.col("_n") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    found = line.join(sums, "_g").groupBy("_g").agg(
        F.max("_n").alias("n"), F.max("_lo").alias("lo"), F.max("_hi").alias("hi"), F.array(*[quantile(s) for s in shares]).alias("q")
    )
    every = df.select(F.struct(*keys).alias("_g")).distinct()  # groups of NULLs alone, too
    return every.join(found, "_g", "left").select("_g.*", F.coalesce("n", F.lit(0)).alias("n"), "lo", "hi", "q")


def quantiles(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """min, p50, p90, p99, max: exact, with linear interpolation."""
    q = F.col("q")
    return _at_shares(df, keys, value, [0.5, 0.9, 0.99]).select(
        *keys, "n", F.col("lo").alias("min"), q[0].alias("p50"), q[1].alias("p90"), q[2].alias("p99"), F.col("hi").alias("max")
    )


def box_stats(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Quartiles and the whiskers at 1.5 times their distance, within the data; groups without values drop out."""
    q = F.col("q")
    reach = (q[2] - q[0]) * 1.5
    return _at_shares(df.where(value.isNotNull()), keys, value, [0.25, 0.5, 0.75]).select(
        *keys, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        F.greatest(q[0] - reach, F.col("lo")).alias("low"), F.least(q[2] + reach, F.col("hi")).alias("high"),
    )


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """bin (1..bins), n over equal widths between min and max; the last bin holds the max."""
    ends = df.agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((value - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins) + 1, F.lit(bins))).otherwise(1)
    return (
        df.where(value.isNotNull()).crossJoin(F.broadcast(ends))  # one row
        .groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )


def over_cap(df: DataFrame, key: str, value: Column, cap: float, total: str = "TOTAL") -> DataFrame:
    """key, n, over per key and in total."""
    agg = df.rollup(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(value > cap).alias("over"), F.grouping(key).alias("_g"))
    return agg.select(F.when(F.col("_g") == 1, total).otherwise(F.col(key)).alias(key), "n", "over")


def imbalance(df: DataFrame, label: str, most_ratio: float, least_pct: float) -> DataFrame:
    """label, n, pct, ratio (largest class to this), warning ('ratio', 'rare') or NULL."""
    n = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    all_ = with_totals(n, _sum=F.sum("n"), _max=F.max("n"))
    out = all_.withColumn("pct", F.col("n") * 100.0 / F.col("_sum")).withColumn("ratio", F.col("_max") / F.col("n")).drop("_sum", "_max")
    return out.withColumn("warning", F.when(F.col("ratio") > most_ratio, "ratio").when(F.col("pct") < least_pct, "rare"))


def missing_fields(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """field, n_missing, pct in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c.isNull()).alias(f) for f, c in fields.items()])
    pair = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("n_missing")) for f in fields])
    return one.select("_n", F.inline(pair)).select("field", "n_missing", (F.col("n_missing") * 100.0 / F.greatest("_n", F.lit(1))).alias("pct"))


def numeric_label(df: DataFrame, label: Column, more_than: int = 12) -> DataFrame:
    """One row: whether all labels are numbers and more than so many differ."""
    number = label.cast("string").try_cast("double")
    return df.where(label.isNotNull()).agg(
        ((F.count_if(number.isNull()) == 0) & (F.count_distinct(label) > more_than)).alias("numeric"), F.count_distinct(label).alias("n_distinct")
    )


def tier_overview(df: DataFrame, tier: str, file: str, label: str) -> DataFrame:
    """Per tier: files, intervals, annotated (label not blank), distinct labels."""
    blank = F.trim(F.coalesce(label, F.lit(""))) == ""
    return df.groupBy(tier).agg(
        F.count_distinct(file).alias("files"), F.count(F.lit(1)).alias("intervals"), F.count_if(~blank).alias("annotated"),
        F.count_distinct(F.when(~blank, F.col(label))).alias("labels"),
    )


def per_file_counts(df: DataFrame, file: str, label: str, labels: list[str]) -> DataFrame:
    return crosstab(df.where(F.col(label).isin(*labels)), file, label, labels)


def top_by_sum(df: DataFrame, keys: list[str], value: str, k: int = 10) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), *keys).limit(k)


def top_per_group(df: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """group, key, n, place of the k most frequent keys of each group (ties by key)."""
    w = Window.partitionBy(group).orderBy(F.desc("n"), key)
    return df.groupBy(group, key).agg(F.count(F.lit(1)).alias("n")).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def annotation_status(df: DataFrame, label: str, valid: list[str], pending: str = "?") -> DataFrame:
    """One row: valid, pending, invalid among the filled labels."""
    filled = F.trim(F.coalesce(label, F.lit(""))) != ""
    ok, open_ = F.col(label).isin(*valid), F.col(label) == pending
    return df.where(filled).agg(F.count_if(ok).alias("valid"), F.count_if(open_).alias("pending"), F.count_if(~ok & ~open_).alias("invalid"))


def range_summary(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.count(value).alias("n"))


def frame_tokens(df: DataFrame, key: str, frames: Column, values: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Per key: how many frames have each value. Counted within the arrays; nothing is exploded."""
    of = lambda v: F.sum(F.size(F.filter(frames, lambda x: x == v)))
    return df.where(frames.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("records"), *[of(v).alias(f"frames_{v}") for v in values])


def scalar_label_keys(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """One row, keys: label keys of raw records whose value is no list, sorted."""
    labels = F.try_variant_get(F.try_parse_json(raw), "$.labels", "map<string,variant>")
    keys = F.map_keys(F.map_filter(labels, lambda k, v: ~F.schema_of_variant(v).startswith("ARRAY")))
    return lines.select(F.explode(keys).alias("key")).distinct().agg(F.array_sort(F.collect_set("key")).alias("keys"))
