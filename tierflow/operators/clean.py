"""Validation, cleaning and first-wins deduplication of records.

All are narrow but deduplication, whose window is cut down to one row per key and
task before its shuffle. "First" is the least of an explicit order column: rows
of distributed files have no other stable order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.values import col, strip
from tierflow.schema import OPTIONAL, REQUIRED, SPLITS


#: What the checks of a record say.
MISSING_KEY, WRONG_TYPE, WRONG_OPTIONAL = "missing required key '{}'", "'{}' has wrong type", "optional '{}' has wrong type"
BAD_SPLIT, BAD_ORDER, NO_SEQUENCE = "split must be one of train, dev, test", "end_t before start_t", "frame_rate_hz set but no sequence labels"


def _messages(*checks: tuple[Column, Column]) -> Column:
    made = F.array(*[F.when(F.coalesce(bad, F.lit(False)), text) for bad, text in checks])
    return F.filter(made, lambda m: m.isNotNull())


def errors_of(df: DataFrame) -> Column:
    """array<string>: what is wrong with a typed record. In a typed table a NULL stands for a missing key."""
    who = F.coalesce(F.col("instance_id"), F.lit("<no instance_id>"))
    say = lambda *t: F.concat(who, F.lit(": "), *[x if isinstance(x, Column) else F.lit(x) for x in t])
    checks = [(F.col(k).isNull(), say(MISSING_KEY.format(k))) for k in REQUIRED if k in df.columns]
    checks.append(
        (~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False)), say(f"{BAD_SPLIT}, got ", F.coalesce("split", F.lit("NULL"))))
    )
    if {"start_t", "end_t"} <= set(df.columns):
        checks.append((F.col("end_t") < F.col("start_t"), say(BAD_ORDER)))
    if "frame_rate_hz" in df.columns:
        labels = df.schema["labels"].dataType
        lists = [F.col(f"labels.`{f.name}`") for f in labels if f.dataType.typeName() == "array"]
        some = F.coalesce(*lists).isNotNull() if len(lists) > 1 else lists[0].isNotNull() if lists else F.lit(False)
        checks.append((F.col("frame_rate_hz").isNotNull() & ~some, say(NO_SEQUENCE)))
    return _messages(*checks)


def errors_of_variant(v: Column) -> Column:
    """array<string>: what is wrong with a raw record (VARIANT); tells absent keys from null ones."""
    kind_ok = {
        "string": lambda t: t == "STRING",
        "object": lambda t: t.startswith("OBJECT"),
        "number": lambda t: t.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"),
        "integer": lambda t: t.rlike("^(BIGINT|BOOLEAN)"),
    }
    node = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    checks = []
    for k, kind in REQUIRED.items():
        checks.append((node(k).isNull(), F.lit(MISSING_KEY.format(k))))
        checks.append((node(k).isNotNull() & ~kind_ok[kind](F.schema_of_variant(node(k))), F.lit(WRONG_TYPE.format(k))))
    for k, kind in OPTIONAL.items():
        checks.append((node(k).isNotNull() & ~kind_ok[kind](F.schema_of_variant(node(k))), F.lit(WRONG_OPTIONAL.format(k))))
    split = F.try_variant_get(v, "$.split", "string")
    checks.append((~F.coalesce(split.isin(*SPLITS), F.lit(False)), F.lit(BAD_SPLIT)))
    start, end = (F.try_variant_get(v, f"$.{k}", "double") for k in ("start_t", "end_t"))
    checks.append((end < start, F.lit(BAD_ORDER)))
    values = F.map_values(F.try_variant_get(v, "$.labels", "map<string,variant>"))
    has_list = F.coalesce(F.exists(values, lambda x: F.schema_of_variant(x).startswith("ARRAY")), F.lit(False))
    checks.append((node("frame_rate_hz").isNotNull() & ~has_list, F.lit(NO_SEQUENCE)))
    return _messages(*checks)


def validation_summary(df: DataFrame, errors: Column | None = None) -> DataFrame:
    """One row: n_total, n_valid."""
    e = errors_of(df) if errors is None else errors
    return df.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.size(e) == 0).alias("n_valid"))


def report_errors(df: DataFrame, most: int = 20, errors: Column | None = None) -> DataFrame:
    """The first ``most`` errors by id: a report's limit."""
    e = errors_of(df) if errors is None else errors
    return df.select("instance_id", F.explode(e).alias("error")).orderBy("instance_id", "error").limit(most)


def require_valid(df: DataFrame) -> DataFrame:
    """``df``; reading it fails at the first invalid record."""
    e = errors_of(df)
    return df.where(F.when(F.size(e) > 0, F.raise_error(F.get(e, F.lit(0))).cast("boolean")).otherwise(True))


def drop_invalid(df: DataFrame) -> DataFrame:
    return df.where(F.size(errors_of(df)) == 0)


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; rows with a NULL key are dropped."""
    for k in key:
        df = df.where(F.col(k).isNotNull())
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def has_label(label: Column | str) -> Column:
    """Neither NULL nor blank."""
    return F.coalesce(strip(col(label).cast("string")) != "", F.lit(False))


def has_text(text: Column | str = "text") -> Column:
    return F.coalesce(strip(text) != "", F.lit(False))


def drop_reasons(df: DataFrame, label: Column | str | None = None, require_text: bool = False) -> DataFrame:
    """``df`` with drop_reason: 'invalid', 'no_label', 'no_text' (the first that holds) or NULL."""
    reason = F.when(F.size(errors_of(df)) > 0, "invalid")
    if label is not None:
        reason = reason.when(~has_label(label), "no_label")
    if require_text:
        reason = reason.when(~has_text(), "no_text")
    return df.withColumn("drop_reason", reason)


def clean(df: DataFrame, order: list[str], label: Column | str | None = None, require_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid, first of their instance_id, labelled (and with text); and step, n of what was dropped.

    Steps follow one another: a duplicate of an invalid row is no duplicate."""
    valid = drop_invalid(df)
    first = first_of(valid, ["instance_id"], order)
    kept = drop_reasons(first, label, require_text)
    step = lambda d, name: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("step"), "n")
    totals = step(df, "input").unionByName(step(valid, "valid")).unionByName(step(first, "unique"))
    return kept.where("drop_reason is null").drop("drop_reason"), totals.unionByName(step(kept.where("drop_reason is null"), "kept"))


def duration_filter(df: DataFrame, seconds: Column, low: float, high: float, required: Column | None = None) -> DataFrame:
    """``df`` with reason 'short', 'long', 'no_label' (first match) or NULL; unknown lengths are short."""
    s = F.coalesce(seconds, F.lit(0.0))
    reason = F.when(s < low, "short").when(s > high, "long")
    if required is not None:
        reason = reason.when(~has_label(required), "no_label")
    return df.withColumn("reason", reason)


def load_split(df: DataFrame, split: str, label: Column, seconds: Column, longest: float | None = None, shortest: float = 0.0, drop_values: list[str] | None = None) -> DataFrame:
    """Rows of a split fit for training on a label; an unknown length passes both bounds."""
    s = F.coalesce(seconds, F.lit(0.0))
    out = df.where((F.col("split") == split) & label.isNotNull())
    if drop_values:
        out = out.where(~label.isin(*drop_values))
    if longest is not None:
        out = out.where(s <= longest)
    return out.where(~((s > 0) & (s < shortest)))


def load_frame_split(df: DataFrame, split: str, frames: Column, seconds: Column, longest: float, multistress: Column | None = None, require_positive: bool = False) -> DataFrame:
    """``df`` rows of a split with reason: 'no_frames', 'multistress', 'long', 'all_zero' or NULL (kept)."""
    reason = F.when(F.coalesce(F.size(frames), F.lit(0)) == 0, "no_frames")
    if multistress is not None:
        reason = reason.when(F.coalesce(multistress, F.lit(False)), "multistress")
    reason = reason.when(seconds > longest, "long")
    if require_positive:
        reason = reason.when(~F.exists(frames, lambda x: x != 0), "all_zero")
    return df.where(F.col("split") == split).withColumn("reason", reason)


def frame_length_off(frames: Column, seconds: Column, rate: Column, tolerance: int = 1) -> Column:
    """Whether the number of frames and the length disagree by more than the tolerance."""
    return F.abs(F.size(frames) - F.rint(seconds * rate)) > tolerance


def rate_gate(df: DataFrame, hz: int) -> DataFrame:
    """One row: rows, wrong (missing or another rate), rates found."""
    rate = F.col("frame_rate_hz")
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~rate.eqNullSafe(F.lit(hz))).alias("n_wrong"),
        F.array_sort(F.collect_set(rate)).alias("rates"),
    )


def long_enough(text: Column | str, n: int) -> Column:
    """Whether a text has at least n characters; NULL has none."""
    return F.coalesce(F.length(col(text)), F.lit(0)) >= n


def span_off(seconds: Column, start: Column, end: Column, tolerance: float = 0.05) -> Column:
    """Whether a file's length and the bounds it was cut by disagree by more than the tolerance; NULL if one is unknown."""
    return F.abs(seconds - (end - start)) > tolerance


def is_frame_record(labels: Column) -> Column:
    """Whether any value of a record's labels (VARIANT object) is a list."""
    values = F.map_values(F.try_variant_get(labels, "$", "map<string,variant>"))
    return F.coalesce(F.exists(values, lambda x: F.coalesce(F.schema_of_variant(x).startswith("ARRAY"), F.lit(False))), F.lit(False))
