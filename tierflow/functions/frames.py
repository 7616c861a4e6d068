"""Frame labels: arrays of numbers at a fixed rate, as Column expressions.

Everything is a higher-order function of the JVM; no row is exploded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierflow.functions.values import col, let

IGNORED = -100


def indices(n: Column | str) -> Column:
    """[0, ..., n-1]; empty for n <= 0."""
    n = col(n)
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def covered(spans: Column, n: Column) -> Column:
    """0/1 frames of [first, past) spans in any order; linear in the number of frames.

    The spans are taken by their start; each appends the free frames up to it and its own."""
    runs_ = "array<array<int>>"
    state = F.struct(F.lit(0).alias("at"), F.array().cast(runs_).alias("runs"))

    def append(s: Column, x: Column) -> Column:
        a, z = F.greatest(x["first"], s["at"]), F.least(x["past"], n)
        more = F.concat(s["runs"], F.array(F.array_repeat(F.lit(0), a - s["at"]), F.array_repeat(F.lit(1), z - a)))
        return F.when(z > a, F.struct(z.alias("at"), more.alias("runs"))).otherwise(s).cast(f"struct<at:int,runs:{runs_}>")

    finish = lambda s: F.concat(F.flatten(s["runs"]), F.array_repeat(F.lit(0), F.greatest(n - s["at"], F.lit(0))))
    return F.aggregate(F.array_sort(spans), state.cast(f"struct<at:int,runs:{runs_}>"), append, finish)


def _rasterised(intervals: Column, n: Column, first, past, counts) -> Column:
    """0/1 frames; ``first`` and ``past`` of an interval are frame numbers (any number, NULLs don't count)."""
    def clipped(t):
        return F.least(F.greatest(t, F.lit(0.0)), n.cast("double")).cast("int")

    spans = F.transform(intervals, lambda f: F.when(counts(f), F.struct(clipped(first(f).cast("double")).alias("first"), clipped(past(f).cast("double")).alias("past"))))
    return F.when(intervals.isNotNull() & n.isNotNull(), covered(F.filter(spans, lambda s: s["past"] > s["first"]), n))


def rasterise_rounded(intervals: Column | str, duration, rate, start: str = "time_s", end: str = "time_e", offset=0.0) -> Column:
    """0/1 frames: an interval covers [round(start x rate), round(end x rate)), halves to even.

    Frames: round(duration x rate). NULL intervals or duration give NULL; intervals without a bound cover nothing."""
    n = F.rint(col(duration) * col(rate)).cast("int")
    edge = lambda t: F.rint((t - col(offset)) * col(rate))
    return _rasterised(col(intervals), n, lambda f: edge(f[start]), lambda f: edge(f[end]), lambda f: f[start].isNotNull() & f[end].isNotNull())


def rasterise_touched(intervals: Column | str, duration, rate, start: str = "time_s", end: str = "time_e") -> Column:
    """0/1 frames: every frame an interval touches, [floor(start x rate), ceil(end x rate)).

    Frames: floor(duration x rate). Intervals that don't end after their start don't count."""
    n = F.floor(col(duration) * col(rate)).cast("int")
    return _rasterised(col(intervals), n, lambda f: F.floor(f[start] * col(rate)), lambda f: F.ceil(f[end] * col(rate)), lambda f: f[end] > f[start])


def window_around(events: Column | str, duration, context, start: str = "time_s", end: str = "time_e") -> Column:
    """struct(lo, hi): from ``context`` before the first to after the last event, within
    the recording; without events its first two contexts. Three decimals."""
    first, last = F.try_element_at(col(events), F.lit(1)), F.try_element_at(col(events), F.lit(-1))
    none = F.coalesce(F.size(col(events)), F.lit(0)) == 0
    lo = F.when(none, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), first[start] - col(context)))
    hi = F.when(none, F.least(col(duration), 2 * col(context))).otherwise(F.least(col(duration), last[end] + col(context)))
    return F.struct(F.bround(lo, 3).alias("lo"), F.bround(hi, 3).alias("hi"))


def frame_slice(frames: Column | str, lo, hi, rate) -> Column:
    """The frames of the window [lo, hi) in seconds."""
    a, b = (F.rint(col(t) * col(rate)).cast("int") for t in (lo, hi))
    return F.slice(col(frames), F.greatest(a, F.lit(0)) + 1, F.greatest(b - F.greatest(a, F.lit(0)), F.lit(0)))


def resize(frames: Column | str, n) -> Column:
    """Nearest-neighbour resize to n frames; an empty sequence stays empty."""
    size = F.size(col(frames))
    at = lambda j: F.least((j.cast("bigint") * size) / F.greatest(col(n), F.lit(1)), (size - 1).cast("double"))
    return F.when(size > 0, F.transform(indices(n), lambda j: F.get(col(frames), F.floor(at(j)).cast("int")))).otherwise(
        F.slice(col(frames), 1, 0)
    )


def conv_length(samples: Column | str, kernels: Sequence[int], strides: Sequence[int]) -> Column:
    """Output length of stacked convolutions: floor((n - k) / s) + 1 a layer, not below 0."""
    n = col(samples).cast("bigint")
    for k, s in zip(kernels, strides):
        n = F.floor((n - k) / F.lit(float(s))) + 1
    return F.greatest(n, F.lit(0))


def pad(frames: Column | str, n, value: int = IGNORED) -> Column:
    """Cut or filled up with ``value`` to n entries."""
    missing = F.greatest(col(n) - F.size(col(frames)), F.lit(0))
    return F.concat(F.slice(col(frames), F.lit(1), col(n).cast("int")), F.array_repeat(F.lit(value), missing.cast("int")))


def unmasked(gold: Column | str, pred: Column | str, ignored: int = IGNORED) -> Column:
    """array<struct<gold, pred>> of the entries whose gold label isn't the ignored one."""
    pairs = F.zip_with(col(gold), col(pred), lambda g, p: F.struct(g.alias("gold"), p.alias("pred")))
    return F.filter(pairs, lambda x: x["gold"].isNotNull() & x["pred"].isNotNull() & (x["gold"] != ignored))


def softmax(logits: Column | str) -> Column:
    top = F.array_max(col(logits))
    total = F.aggregate(F.transform(col(logits), lambda x: F.exp((x - top).cast("double"))), F.lit(0.0), lambda a, x: a + x)
    return F.transform(col(logits), lambda x: F.exp((x - top).cast("double")) / total)


def argmax(values: Column | str) -> Column:
    """Index of the first largest value; NULL for an empty array."""
    return F.nullif(F.array_position(col(values), F.array_max(col(values))), F.lit(0)).cast("int") - 1


def trim_to_mask(frames: Column | str, mask: Column | str, most=None) -> Column:
    """As many leading entries as the mask has ones, and not more than ``most``."""
    n = total(mask)
    n = n if most is None else F.least(n, col(most))
    return F.slice(col(frames), F.lit(1), F.least(n, F.size(col(frames))).cast("int"))


def masked_mean(values: Column | str, mask: Column | str) -> Column:
    """Mean of the values where the mask is 1; NULL if it is nowhere."""
    kept = F.aggregate(F.zip_with(col(values), col(mask), lambda v, m: v * m), F.lit(0.0), lambda a, x: a + x)
    return F.when(total(mask) > 0, kept / total(mask))


def total(values: Column | str) -> Column:
    return F.aggregate(col(values), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def any_positive(values: Column | str) -> Column:
    return F.exists(col(values), lambda x: x != 0)


def mismatches(gold: Column | str, pred: Column | str) -> Column:
    """How many entries differ; the shorter array counts."""
    n = F.least(F.size(col(gold)), F.size(col(pred)))
    a, b = (F.slice(col(x), F.lit(1), n) for x in (gold, pred))
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)


def error_rate(gold: Column | str, pred: Column | str) -> Column:
    n = F.least(F.size(col(gold)), F.size(col(pred)))
    return F.when(n > 0, mismatches(gold, pred) / n)


def outcome(gold: Column | str, pred: Column | str) -> Column:
    """Per frame: 'hit', 'miss', 'false' or 'none'."""
    return F.zip_with(
        col(gold), col(pred),
        lambda g, p: F.when((g != 0) & (p != 0), "hit").when(g != 0, "miss").when(p != 0, "false").otherwise("none"),
    )


def runs(values: Column | str) -> Column:
    """array<struct<value, first, past>>: maximal runs of equal values, in order.

    Runs begin where an entry differs from the one before; their ends are the next beginnings."""
    v = col(values)
    changes = F.filter(indices(F.size(v)), lambda i: (i == 0) | ~F.get(v, i).eqNullSafe(F.get(v, i - 1)))
    one = lambda c, i, k: F.struct(
        F.get(v, i).alias("value"), i.alias("first"), F.coalesce(F.get(c, k + 1), F.size(v)).alias("past")
    )
    return let(changes, lambda c: F.transform(c, lambda i, k: one(c, i, k)))


#: Model types and how their frames come about.
FAMILIES = {"wav2vec2": "convolutions", "wav2vec2-bert": "adapter"}


def family_of(model_type: str) -> str:
    if model_type not in FAMILIES:
        raise ValueError(f"unknown model type {model_type!r}; known are {sorted(FAMILIES)}")
    return FAMILIES[model_type]


def output_length(inputs: Column | str, model_type: str, kernels: Sequence[int] = (), strides: Sequence[int] = (), adapter: tuple[int, int, int] | None = None) -> Column:
    """Frames of a model: of stacked convolutions over samples, or of filter-bank frames that only an
    adapter (layers, kernel, stride) makes fewer."""
    if family_of(model_type) == "convolutions":
        return conv_length(inputs, kernels, strides)
    layers, kernel, stride = adapter or (0, 1, 1)
    return conv_length(inputs, [kernel] * layers, [stride] * layers)
