"""Problem 9: a mixture of sources with target shares of the tokens.

Method: iterative proportional fitting. Token counts of the documents are summed
into a table of source x language x topic; the table is raked in turn to the
source targets, the language shares and the topic shares; the weight of a cell
over its tokens is the calibrated rate at which its documents occur. Documents are
drawn systematically: in order of source and tokens, one occurs as often as the
running sum of the rates passes a whole number there, which is floor(rate) or one
more, never more than max_repeats; the tokens of a source follow its rates but for
about one document.

Source targets win: raking ends with the sources, and no cell goes beyond
max_repeats (what is cut off goes to the other cells of the source). Language
and topic shares are those of all documents of the target sources; they are
met as far as the source targets allow. A topic is any column; the query uses
the form of the text (timed transcript, list, prose) as no topic is in the data.

Defined results: NULL, blank and zero-token documents count as 0 tokens and
occur by the rate of their cell; sources without a target get 0 copies and stay
in the result; targets without documents are reported short (unless the target
is 0); repeated targets of one normalised source keep the one with the larger
permille; an empty table gives an empty mixture and a report.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.common import before_in_order, cut, normalised, small, with_totals
from tierflow.llm.encode import VOCABULARY, count_tokens

#: Most cells (source with a target, language, topic) of the raked table, which the driver holds; more are an error.
MAX_CELLS = 5_000_000
#: Rates are whole multiples of one over this, so that their sums are exact.
UNIT = 1 << 24

CELLS = ["source", "lang", "topic"]


def form_of(text: str = "text"):
    """'timed' (lines with times), 'list' (bullets or numbers) or 'prose'."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(t.rlike(r"\[\d+\.\d{3}"), "timed").when(t.rlike(r"(?m)^\s*(?:[*•-]|\d+\))\s"), "list").otherwise("prose")
    )


def targets_of(mix_targets: DataFrame) -> DataFrame:
    """source (normalised), permille, repeats: one row per source."""
    best = Window.partitionBy("source").orderBy(F.col("permille").desc(), F.col("repeats").desc())
    return (
        mix_targets.select(
            normalised("source").alias("source"),
            F.greatest(F.coalesce("target_permille", F.lit(0)), F.lit(0)).cast("bigint").alias("permille"),
            F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).cast("bigint").alias("repeats"),
        )
        .where("source is not null")
        .withColumn("_n", F.row_number().over(best))
        .where("_n = 1")
        .drop("_n")
    )


def sized(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, source and lang (normalised), topic, tokens of every document."""
    rows = documents.select(
        "doc_id",
        normalised("source").alias("source"),
        F.coalesce(normalised("lang"), F.lit("")).alias("lang"),
        form_of("text").alias("topic"),
        "text",
    )
    return count_tokens(rows, "text", "tokens", keep=["doc_id", *CELLS], path=path)


def filled(want: np.ndarray, source: np.ndarray, weights: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Scales the weights of each source's cells to the sum ``want``, none above ``most``; the rest is spread again."""
    n, out = len(want), np.zeros_like(weights)
    sums = lambda x: np.bincount(source, x, n)
    goal = np.minimum(want, sums(most))
    while True:
        left = goal - sums(out)
        open_ = (most - out > 1e-9 * np.maximum(most, 1.0)) & (left > 1e-9 * np.maximum(goal, 1.0))[source]
        if not open_.any():
            return out
        w = np.where(open_, weights, 0.0)
        empty = (sums(w) <= 0)[source] & open_  # cells without weight are filled by their room
        w = np.where(empty, most - out, w)
        step = np.minimum(w / np.where(sums(w) > 0, sums(w), 1.0)[source] * left[source], most - out)
        step = np.where(open_, step, 0.0)
        if step.sum() <= 1e-12 * max(goal.sum(), 1.0):
            return out
        out = out + step


def rake(
    tokens: np.ndarray, places: np.ndarray, want: np.ndarray, repeats: np.ndarray, rounds: int = 50, tolerance: float = 1e-6
) -> np.ndarray:
    """Tokens of each cell in the mixture. ``tokens`` of the cells; ``places``: their source, language and topic, numbered."""
    total = tokens.sum()
    if total <= 0:
        return np.zeros_like(tokens)
    source = places[0]
    most = tokens * repeats[source]
    mixture = min(float(want.sum()), float(most.sum()))
    weights = tokens.copy()
    for _ in range(rounds):
        before = weights
        weights = filled(want, source, weights, most)
        for place in places[1:]:
            have, goal = np.bincount(place, weights), np.bincount(place, tokens) / total * mixture
            weights = weights * np.divide(goal, have, out=np.ones_like(have), where=have > 0)[place]
        if np.abs(weights - before).max() <= tolerance * max(mixture, 1.0):
            break
    return filled(want, source, weights, most)


class Mixture:
    """The fitted mixture of ``documents``; see the module's text.

    copies(): doc_id, source, tokens, copies of every document.
    report(): one row per target source."""

    def __init__(
        self, documents: DataFrame, mix_targets: DataFrame, share: float = 0.5, seed: str = "mix", path: str = VOCABULARY
    ) -> None:
        self.spark, self.seed, self.share = documents.sparkSession, seed, share
        self.targets = targets_of(mix_targets)
        goals = sorted(self.targets.limit(MAX_CELLS + 1).collect(), key=lambda r: r["source"])
        self.sizes = cut(sized(documents, path))  # each text is tokenised once
        counted = self.sizes.groupBy(*CELLS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
        cells = counted.join(small(self.targets.select("source")), "source", "left_semi").limit(MAX_CELLS + 1).toArrow()
        if len(goals) > MAX_CELLS or cells.num_rows > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic")
        names = {c: cells.column(c).to_pylist() for c in CELLS}
        numbers = {c: {v: i for i, v in enumerate(dict.fromkeys(names[c]))} for c in CELLS} | {"source": {r["source"]: i for i, r in enumerate(goals)}}
        places = np.array([[numbers[c][v] for v in names[c]] for c in CELLS], np.int64).reshape(3, -1)
        tokens = cells.column("tokens").to_numpy().astype(float)
        self.total = int(tokens.sum())
        want = np.array([share * self.total * r["permille"] / 1000 for r in goals])
        repeats = np.array([float(r["repeats"]) for r in goals])
        fitted = rake(tokens, places, want, repeats) if goals and len(tokens) else np.zeros_like(tokens)
        rates = np.divide(fitted, tokens, out=np.zeros_like(fitted), where=tokens > 0)
        text = [T.StructField(c, T.StringType()) for c in CELLS]
        self.rates = self.spark.createDataFrame(
            list(zip(*names.values(), np.rint(rates * UNIT).astype(int).tolist())), T.StructType([*text, T.StructField("rate", T.LongType())])
        )
        raked = np.bincount(places[0], fitted, len(goals)) if len(tokens) else np.zeros(len(goals))
        self.raked = self.spark.createDataFrame(
            [(r["source"], float(x)) for r, x in zip(goals, raked)], T.StructType([text[0], T.StructField("raked_tokens", T.DoubleType())])
        )

    def copies(self) -> DataFrame:
        """How many times each document occurs; 0 for documents out of the mixture.

        Systematic sampling: the documents of a source are put in order of their tokens,
        their cells' rates are summed up, and one occurs as often as its rate crosses a
        whole number: the tokens of a source are off by about one document."""
        rated = self.sizes.join(small(self.rates), CELLS, "left").withColumn("rate", F.coalesce("rate", F.lit(0)))
        drawn = rated.where("rate > 0").withColumn("_draw", F.xxhash64(F.lit(self.seed), "doc_id"))
        order = ["source", "tokens", "lang", "topic", "_draw", "doc_id"]
        summed = before_in_order(drawn, order, "rate", "_sum")
        whole = lambda x: F.floor((x + UNIT // 2) / F.lit(UNIT))
        occurs = whole(F.col("_sum") + F.col("rate")) - whole(F.col("_sum"))
        none = rated.where("rate <= 0").select("doc_id", "source", "tokens", F.lit(0).alias("copies"))
        return summed.select("doc_id", "source", "tokens", occurs.cast("int").alias("copies")).unionByName(none)

    def targets_report(self) -> DataFrame:
        """source, own_tokens, most_tokens (with repeats), wanted_tokens, raked_tokens, short.

        short: raking filled all cells of the source to their most and, by whole numbers, that isn't enough."""
        own = self.sizes.groupBy("source").agg(F.sum("tokens").alias("own_tokens"))
        halves = F.lit(round(1000 / self.share))
        full = F.col("raked_tokens") >= F.col("most_tokens") * (1 - 1e-6)
        return (
            self.targets.join(own, "source", "left").join(self.raked, "source", "left")
            .withColumn("own_tokens", F.coalesce("own_tokens", F.lit(0)))
            .withColumn("most_tokens", F.col("own_tokens") * F.col("repeats"))
            .withColumn("wanted_tokens", F.lit(self.share * self.total) * F.col("permille") / F.lit(1000.0))
            .withColumn("short", full & (F.col("most_tokens") * halves < F.lit(self.total) * F.col("permille")))
        )

    def report(self) -> DataFrame:
        """targets_report with the tokens and the permille reached by the drawn copies."""
        drawn = self.copies().where("copies > 0").groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("reached_tokens"))
        listed = self.targets_report().join(drawn, "source", "left").withColumn("reached_tokens", F.coalesce("reached_tokens", F.lit(0)))
        reached = with_totals(listed, _all=F.sum("reached_tokens"))
        permille = F.when(F.col("_all") > 0, F.col("reached_tokens") * 1000 / F.col("_all")).otherwise(0.0)
        return reached.withColumn("reached_permille", permille).drop("_all")
