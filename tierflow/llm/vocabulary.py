"""Problem 2: how often every distinct value or term occurs, and in how many records.

Method: a global integer dictionary of the terms is built, terms are encoded,
count arrays (occurrences, records) are accumulated blockwise, and the arrays
are summed by identifier range.

* Blocks: each task counts its rows per distinct term (a local dictionary and
  two count arrays); only these leave the task, so a term that holds a third of
  all rows is a few numbers per task.
* Dictionary: the distinct terms, range-partitioned and numbered without gaps
  (offsets of the partitions plus place in the partition), written once.
* Ranges: encoded block counts become arrays over ``width`` identifiers, summed
  per range; a range is one small array whatever the number of blocks, as blocks
  of one range are summed in two steps (by a salt, then all).

Defined results: missing values are no terms; a term repeated in one record
counts each time for occurrences and once for records; an empty table gives no
rows. Marks: 'rare' below ``rare`` records, 'common' above ``common`` of all
records, else NULL.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.common import MISSING, cut, nfc_all

#: Identifiers of one count array.
RANGE_WIDTH = 4096
#: Blocks of one range are first summed in so many groups.
SALT = 32


def block_counts(records: DataFrame, fields: list[str]) -> DataFrame:
    """field, term, occurrences, records: counts of each task's rows.

    ``records`` has one row per record and an array of normalised terms per field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences = [Counter() for _ in fields]
        present = [Counter() for _ in fields]
        total = 0
        for batch in batches:
            total += batch.num_rows
            for i in range(len(fields)):
                lists = batch.column(i)
                values = lists.flatten()
                parents = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
                codes = values.dictionary_encode()
                ids, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
                occurrences[i].update(dict(zip(names, np.bincount(ids, minlength=len(names)).tolist())))
                once = np.unique(parents * max(len(names), 1) + ids) % max(len(names), 1)
                present[i].update(dict(zip(names, np.bincount(once, minlength=len(names)).tolist())))
        rows = [(f, t, n, present[i][t]) for i, f in enumerate(fields) for t, n in occurrences[i].items()]
        rows.append((None, None, total, total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
            names=["field", "term", "occurrences", "records"],
        )

    return records.select(*fields).mapInArrow(run, "field string, term string, occurrences bigint, records bigint")


def number(terms: DataFrame) -> DataFrame:
    """``terms`` (distinct field, term) with ``id`` 0, 1, ...; no gaps, no single-task sort."""
    placed = cut(terms.repartitionByRange("field", "term").withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))  # one row per partition
    inside = Window.partitionBy("part").orderBy("field", "term")
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(offsets, "part")
        .select("field", "term", (F.col("offset") + F.col("place")).alias("id"))
    )


def sum_ranges(encoded: DataFrame, width: int = RANGE_WIDTH) -> DataFrame:
    """id, occurrences, records from encoded block counts, summed as arrays by range."""

    def add(keys: list[str], out: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple, list] = {}
            done = []

            def flush(key):
                occurrences, records = sums.pop(key)
                at = np.flatnonzero(records)
                done.append((key, at, occurrences[at], records[at]))

            for batch in batches:
                if not batch.num_rows:
                    continue
                names = list(zip(*(batch.column(i).to_pylist() for i in range(len(keys)))))
                ids, occ, rec = (batch.column(len(keys) + i).to_numpy() for i in range(3))
                edges = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
                for a, b in zip(edges, edges[1:]):
                    key = names[a]
                    if key not in sums:
                        for other in list(sums):  # rows are sorted by key: others are complete
                            flush(other)
                        sums[key] = [np.zeros(width, np.int64), np.zeros(width, np.int64)]
                    np.add.at(sums[key][0], ids[a:b] % width, occ[a:b])
                    np.add.at(sums[key][1], ids[a:b] % width, rec[a:b])
                for key, at, o, r in done:
                    yield pa.RecordBatch.from_arrays([pa.array(at + key[0] * width), pa.array(o), pa.array(r)], names=out)
                done.clear()
            for key in list(sums):
                flush(key)
            for key, at, o, r in done:
                yield pa.RecordBatch.from_arrays([pa.array(at + key[0] * width), pa.array(o), pa.array(r)], names=out)

        return run

    schema = "id bigint, occurrences bigint, records bigint"
    out = ["id", "occurrences", "records"]
    spread = encoded.select(
        F.floor(F.col("id") / width).alias("range"), F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).alias("salt"), *out
    )
    salted = spread.repartition("range", "salt").sortWithinPartitions("range", "salt").mapInArrow(add(["range", "salt"], out), schema)
    ranged = salted.select(F.floor(F.col("id") / width).alias("range"), *out)
    return ranged.repartition("range").sortWithinPartitions("range").mapInArrow(add(["range"], out), schema)


def term_frequencies(records: DataFrame, fields: list[str], rare: int = 3, common: float = 0.2) -> DataFrame:
    """field, term, id, occurrences, records, mark of every distinct term."""
    blocks = cut(block_counts(records, fields))
    total = blocks.where("field is null").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    counts = blocks.where("field is not null")
    dictionary = cut(number(counts.select("field", "term").distinct()))
    encoded = counts.join(dictionary, ["field", "term"]).select("id", "occurrences", "records")
    mark = F.when(F.col("records") < rare, "rare").when(F.col("records") > F.lit(common * total), "common")
    return (
        sum_ranges(encoded)
        .join(dictionary, "id")
        .select("field", "term", "id", "occurrences", "records", mark.alias("mark"))
    )


def utterance_terms(current_utterances: DataFrame) -> DataFrame:
    """Arrays of normalised terms of speaker, sentiment_6, dialogue_act_function, fp_type."""
    scalars = ["speaker", "labels.sentiment_6", "labels.dialogue_act_function"]
    fields = ["speaker", "sentiment_6", "dialogue_act_function", "fp_type"]
    tidy = lambda a: F.filter(F.transform(a, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & ~x.isin(*MISSING))
    several = F.coalesce(F.col("labels.fp_type"), F.array().cast("array<string>"))
    flat = nfc_all(F.concat(F.array(*scalars), several))
    return current_utterances.select(flat.alias("_v")).select(
        *[tidy(F.slice("_v", i + 1, 1)).alias(fields[i]) for i in range(3)],
        tidy(F.slice(F.col("_v"), F.lit(4), F.greatest(F.size("_v") - 3, F.lit(0)))).alias(fields[3]),
    )
