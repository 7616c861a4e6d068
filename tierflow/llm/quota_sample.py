"""Problem 4: a sample whose category shares follow targets.

Method: categories are counted, integer quotas are allocated by largest
remainder with floors and availability caps (what capped categories leave goes to
the others), the rows with the smallest random keys of each category are drawn,
and shortfalls are reported from what was drawn.

The draw ranks rows by a hash of their id within (category, hash bucket) after
counting the buckets, so a category of a third of all rows is spread over many
tasks and is never sorted as one group.

Defined results: rows in which a category field is missing are not eligible;
categories without a target are not drawn; targets of a category not in the data
get quota 0 and are reported with everything wanted; repeated targets of one
category keep the larger permille; of an empty table nothing is drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import MISSING, SMALL_ROWS, bucketed_rank, cut, fresh, nfc_all, with_totals


def eligible(current_utterances: DataFrame) -> DataFrame:
    """instance_id, lang, gender, sentiment_6 (normalised), none of them missing."""
    flat = nfc_all(F.array("metadata.speaker_info.lang", "metadata.speaker_info.speaker_gender", "labels.sentiment_6"))
    names = ["lang", "gender", "sentiment_6"]
    tidy = current_utterances.select("instance_id", flat.alias("_v")).select(
        "instance_id", *[F.lower(F.trim(F.col("_v")[i])).alias(c) for i, c in enumerate(names)]
    )
    for c in names:
        tidy = tidy.where(F.col(c).isNotNull() & ~F.col(c).isin(*MISSING))
    return tidy


def _by_remainder(shares: list[int], whole: int) -> list[int]:
    """shares / whole in whole numbers: rounded down, the places left go to the largest remainders (ties: the earlier)."""
    out = [s // whole for s in shares]
    for i in sorted(range(len(shares)), key=lambda i: (-(shares[i] % whole), i))[: sum(shares) // whole - sum(out)]:
        out[i] += 1
    return out


def allocate(rows: list[dict], n: int) -> list[int]:
    """Quotas of categories with permille, floor, available: largest remainder.

    The shares of n are allotted; what a category can't take for want of rows is
    allotted again among those that still have some, in proportion to their
    permille, until nothing is left to give or to take. Then every quota is raised
    to its floor, as far as there are rows: a floor adds to the sample and takes
    nothing from others, so that a quota is below its share only if all rows are drawn."""
    asked = _by_remainder([n * r["permille"] for r in rows], 1000)
    quotas = [min(q, r["available"]) for q, r in zip(asked, rows)]
    left = sum(asked) - sum(quotas)
    while left > 0:
        open_ = [r["permille"] if q < r["available"] else 0 for q, r in zip(quotas, rows)]
        if not any(open_):
            break
        before = sum(quotas)
        more = _by_remainder([left * p for p in open_], sum(open_))
        quotas = [min(q + m, r["available"]) for q, m, r in zip(quotas, more, rows)]
        left -= sum(quotas) - before
    return [max(q, min(r["floor"], r["available"])) for q, r in zip(quotas, rows)]


def quota_sample(
    rows: DataFrame, targets: DataFrame, category: list[str], part: int = 5, seed: str = "sample", item: str = "instance_id"
) -> tuple[DataFrame, DataFrame]:
    """The sample (rows of ``rows``) and the report.

    ``targets``: category columns (normalised), permille, floor. n is the number
    of rows divided by ``part``, rounded down. Report, one row per target:
    permille, floor, available, quota, wanted (the larger of floor and the share
    of n rounded up), drawn (counted in the sample), reached_permille (its share of
    the sample) and short (all rows of the category are drawn and are fewer than wanted)."""
    counts = cut(rows.groupBy(*category).agg(F.count(F.lit(1)).alias("available")))
    n = counts.agg(F.coalesce(F.sum("available"), F.lit(0))).first()[0] // part
    best = Window.partitionBy(*category).orderBy(F.col("permille").desc(), F.col("floor").desc())
    goals = targets.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
    if goals.limit(SMALL_ROWS + 1).count() > SMALL_ROWS:
        raise ValueError(f"more than {SMALL_ROWS} categories have targets")
    joined = goals.join(counts, category, "left").withColumn("available", F.coalesce("available", F.lit(0)))
    listed = [r.asDict() for r in joined.orderBy(*category).collect()]
    quotas = allocate(listed, n)
    plan = rows.sparkSession.createDataFrame(
        [
            (*(r[c] for c in category), r["permille"], r["floor"], r["available"], q, max(r["floor"], -(-n * r["permille"] // 1000)))
            for r, q in zip(listed, quotas)
        ],
        ", ".join(f"`{c}` string" for c in category) + ", permille bigint, floor bigint, available bigint, quota bigint, wanted bigint",
    )
    key, place, most = fresh(rows, "_draw", "_rank", "_quota")  # the rows may have columns of any name
    wanted = F.broadcast(plan.where("quota > 0").select(*category, F.col("quota").alias(most)))
    keyed = rows.withColumn(key, F.xxhash64(F.lit(seed), item)).join(wanted, category)
    sample = bucketed_rank(keyed, category, key, place).where(F.col(place) <= F.col(most)).select(*rows.columns)
    drawn = sample.groupBy(*category).agg(F.count(F.lit(1)).alias("drawn"))
    report = with_totals(plan.join(drawn, category, "left").withColumn("drawn", F.coalesce("drawn", F.lit(0))), _all=F.sum("drawn"))
    report = report.withColumn("reached_permille", F.when(F.col("_all") > 0, F.col("drawn") * 1000 / F.col("_all")).otherwise(0.0)).drop("_all")
    return sample, report.withColumn("short", (F.col("drawn") == F.col("available")) & (F.col("drawn") < F.col("wanted")))


def targets_of(sample_targets: DataFrame) -> DataFrame:
    """sample_targets with normalised categories, permille and floor."""
    names = ["lang", "gender", "sentiment_6"]
    return sample_targets.select(nfc_all(F.array(*names)).alias("_v"), "target_permille", "min_rows").select(
        *[F.lower(F.trim(F.col("_v")[i])).alias(c) for i, c in enumerate(names)],
        F.greatest(F.coalesce("target_permille", F.lit(0)), F.lit(0)).cast("bigint").alias("permille"),
        F.greatest(F.coalesce("min_rows", F.lit(0)), F.lit(0)).cast("bigint").alias("floor"),
    )
