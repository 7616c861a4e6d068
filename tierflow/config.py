"""Layered configuration, the task registry and the download plan."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field, fields
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Task:
    """What a training or scoring task reads."""

    name: str
    paths: tuple[str, ...]
    label: str
    kind: str = "classification"
    label_order: tuple[str, ...] = ()
    label_remap: dict[str, str] = field(default_factory=dict)
    label_scale: dict[str, float] = field(default_factory=dict)
    drop_values: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in ("classification", "regression", "frame"):
            raise ValueError(f"{self.name}: kind {self.kind!r}")
        if len(set(self.label_order)) != len(self.label_order):
            raise ValueError(f"{self.name}: label_order has duplicates")


def layered(cls, *layers: dict):
    """``cls`` with the values of the layers, later ones winning; unknown keys are errors."""
    names = {f.name for f in fields(cls)}
    values: dict = {}
    for layer in layers:
        if unknown := {k for k in layer if not k.startswith("_")} - names:
            raise ValueError(f"unknown keys {sorted(unknown)}; known are {sorted(names)}")
        values |= {k: v for k, v in layer.items() if not k.startswith("_")}
    return cls(**values)


def changed(task, **values):
    return dataclasses.replace(task, **values)


def parse_range(text: str) -> tuple[float, float]:
    """'2-15' as (2, 15)."""
    low, high = (float(x) for x in text.split("-"))
    if low > high:
        raise ValueError(f"{text}: the first is above the second")
    return low, high


def parse_ratio(text: str) -> tuple[float, ...]:
    """'8:1:1' as shares that sum to 1."""
    parts = [float(x) for x in text.replace("/", ":").split(":")]
    if len(parts) != 3 or min(parts) < 0 or sum(parts) <= 0:
        raise ValueError(f"{text}: three shares are needed")
    return tuple(p / sum(parts) for p in parts)


def run_name(data: str, model: str, task: str, at: datetime) -> str:
    """20240131-0930_data_model_task; a model is its last path part."""
    return f"{at:%Y%m%d-%H%M}_{data}_{model.rstrip('/').rsplit('/', 1)[-1]}_{task}"


def expand(names: list[str], shorthands: dict[str, list[str]]) -> list[str]:
    """Names with shorthands replaced, each once, in order."""
    return list(dict.fromkeys(x for n in names for x in shorthands.get(n, [n])))


def download_plan(files: DataFrame, present: DataFrame, skip_large: bool = False, force: bool = False, dry_run: bool = False) -> DataFrame:
    """``files`` (dataset, name, size_mb, is_large) with action and reason, from ``present`` (dataset, name, size_mb).

    The first reason that holds counts: nothing is fetched in a dry run, large files
    need consent (skip_large=False), ``force`` fetches anew what is there."""
    have = present.select("dataset", "name", F.col("size_mb").alias("have_mb"))
    first = F.when(F.lit(dry_run), "dry_run").when(F.lit(force) & F.col("is_large") & F.lit(skip_large), "large").when(F.lit(force), "forced")
    reason = (
        first.when(F.col("have_mb").isNotNull() & (F.abs(F.col("have_mb") - F.col("size_mb")) <= 1), "complete")
        .when(F.col("have_mb").isNotNull(), "partial")
        .when(F.col("is_large") & F.lit(skip_large), "large")
        .otherwise("absent")
    )
    action = F.when(F.col("reason").isin("complete", "large", "dry_run"), "skip").when(F.col("reason") == "partial", "resume").otherwise("fetch")
    return files.join(have, ["dataset", "name"], "left").withColumn("reason", reason).withColumn("action", action)


def plan_totals(plan: DataFrame) -> DataFrame:
    """MB on disk and to fetch per data set and in all (dataset 'TOTAL')."""
    fetch = F.col("action") != "skip"
    agg = plan.rollup("dataset").agg(
        F.sum(F.coalesce("have_mb", F.lit(0.0))).alias("mb_present"), F.sum(F.when(fetch, F.col("size_mb") - F.coalesce("have_mb", F.lit(0.0))).otherwise(0.0)).alias("mb_to_fetch"),
        F.grouping("dataset").alias("_g"),
    )
    return agg.select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("dataset")).alias("dataset"), "mb_present", "mb_to_fetch")


def with_mode(task: dict, shared: dict, modes: dict[str, dict], mode: str) -> dict:
    """Shared values, the task's and the mode's, later ones winning; an unknown mode is an error."""
    if mode not in modes:
        raise ValueError(f"mode {mode!r}; known are {sorted(modes)}")
    return {**shared, **task, **modes[mode]}


def available(tasks: dict[str, Task], exists) -> tuple[list[str], list[str]]:
    """Names of the tasks whose files all exist, and of those that lack some."""
    have = [n for n, t in tasks.items() if all(map(exists, t.paths))]
    return have, [n for n in tasks if n not in have]


def run_folders(root: str, name: str, test: bool = False) -> dict[str, str]:
    """Where a run keeps its things; trial runs stand apart."""
    base = f"{root.rstrip('/')}/{'test_' if test else ''}{name}"
    return {"run": base, **{k: f"{base}/{k}" for k in ("model", "predictions", "reports", "logs")}}


def subset_name(corpora: list[str], hours: float | None = None, n: int | None = None, duration: tuple[float, float] | None = None) -> str:
    """A name that says what a subset was made of: ps-hr_ps-rs_5h_2-15s."""
    size = [f"{hours:g}h"] if hours is not None else [f"{n}rows"] if n is not None else []
    return "_".join([*(c.lower().replace("parlaspeech", "ps") for c in corpora), *size, *([f"{duration[0]:g}-{duration[1]:g}s"] if duration else [])])
