"""Continuous periods and the gaps between them (problem 7).

Method: a mergeable aggregate whose state is a list of sorted disjoint intervals,
combined by linear merge in a reduction tree.

1. Leaves: every task merges its own intervals into one list per item, layer and
   block of time (``block_ms``, by the start). Repeated and nested rows are gone
   before anything is shuffled; a list has at most one interval a millisecond.
2. Inner nodes: the lists are put in order of item, layer and block, by ranges, so
   that an item of any size is spread over many nodes; each node merges the lists
   that came to it, one item after the other, and holds one block's lists at a time.
3. Root: two nodes can only share the period that is open where one ends and the
   next begins. These open ends, one row a node, are folded from left to right.
4. Every node's periods are emitted with the gap before them; those that an open
   end reaches are joined to it, dropped or left to the node where they close.

Intervals that overlap or touch are one period; a gap lies between consecutive
periods. Defined results: intervals with a NULL or unusable bound or an end not
after the start don't count; rows without an item are left out, a NULL layer is
a layer; an item with no interval that counts has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.common import cut

#: Ten minutes.
BLOCK_MS = 600_000
#: Intervals that a leaf takes in before it hands out its lists.
LEAF_ROWS = 1_000_000


def merged(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """group, start, end of the periods of each group; groups ascend in the result.

    A stable sort of lists that are sorted already is a linear merge."""
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    # the latest end so far within a group, as a running maximum of the ends' ranks
    ends, rank = np.unique(end, return_inverse=True)
    number = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if len(group) else group
    reach = ends[np.maximum.accumulate(rank + number * len(ends)) - number * len(ends)] if len(group) else end
    head = np.ones(len(group), bool)
    head[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(head)
    return group[at], start[at], reach[np.concatenate([at[1:] - 1, [len(group) - 1]])] if len(at) else end


def _codes(*columns: pa.ChunkedArray) -> np.ndarray:
    """A number per row, equal for equal rows (NULL is a value)."""
    out = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        coded = c.combine_chunks().dictionary_encode("encode")
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        out = out * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
    return out


LISTS = "item string, layer string, block bigint, starts array<bigint>, ends array<bigint>"
KEY = ["item", "layer", "block"]


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.RecordBatch] = []

    def lists() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(waiting)
        waiting.clear()
        item, layer, block = (t.column(c) for c in KEY)
        code = np.unique(_codes(item, layer, block), return_inverse=True)[1]
        group, start, end = merged(code, t.column("start_ms").to_numpy(), t.column("end_ms").to_numpy())
        first = np.zeros(code.max() + 1, np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]  # a row of each group, for its names
        ends = np.cumsum(np.concatenate([[0], np.bincount(group)]))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int64())) for x in (start, end)]
        names = t.select(KEY).take(pa.array(first)).combine_chunks()
        yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in names.columns), *lists], names=[*KEY, "starts", "ends"])

    held = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            held += batch.num_rows
        if held >= LEAF_ROWS:
            held = 0
            yield from lists()
    if waiting:
        yield from lists()


PERIODS = "item string, layer string, start_ms bigint, end_ms bigint, previous bigint, node bigint, is_first boolean, is_last boolean"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The periods of a node's lists, which come in order of item, layer and block.

    ``previous``: end of the period before, NULL for the first of an item in the node.
    is_first: of the node's first item. is_last: the node's very last period."""
    opened: tuple | None = None  # item, layer, start, end of the one period that may go on, and the end before it
    node, first_item = None, True  # whether ``opened`` is of the node's first item

    def emit(item, layer, start, end, previous, first, last=False) -> pa.RecordBatch:
        n = len(start)
        columns = [item, layer, pa.array(start, pa.int64()), pa.array(end, pa.int64()), previous, pa.array([node] * n, pa.int64()), pa.array(first, pa.bool_()), pa.array([last] * n, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PERIODS.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if node is None:
            node = t.column("node")[0].as_py()
        lengths = pc.list_value_length(t.column("starts")).to_numpy()
        item, layer = t.column("item").combine_chunks(), t.column("layer").combine_chunks()
        codes = _codes(t.column("item"), t.column("layer"))
        number = np.cumsum(np.concatenate([[0], codes[1:] != codes[:-1]]))  # in the order they come
        start = pc.list_flatten(t.column("starts")).to_numpy()
        end = pc.list_flatten(t.column("ends")).to_numpy()
        group = np.repeat(number, lengths)
        name = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))  # a row of each group
        before = None  # end of the period before the open one
        if opened is not None:
            same = opened[0] == item[0].as_py() and opened[1] == layer[0].as_py()
            if same:
                start, end, group = np.concatenate([[opened[2]], start]), np.concatenate([[opened[3]], end]), np.concatenate([[0], group])
                before = opened[4]
            else:
                yield emit(pa.array([opened[0]], pa.string()), pa.array([opened[1]], pa.string()), [opened[2]], [opened[3]], pa.array([opened[4]], pa.int64()), [first_item])
                first_item = False
        group, start, end = merged(group, start, end)
        fresh = np.concatenate([[True], group[1:] != group[:-1]])
        previous = pa.array(np.concatenate([[0], end[:-1]]), pa.int64(), mask=fresh)
        if before is not None:
            previous = pa.concat_arrays([pa.array([before], pa.int64()), previous[1:]])
        rows = pa.array(name[group])
        first = (group == 0) & first_item
        last = len(group) - 1
        opened = (item[int(name[group[last]])].as_py(), layer[int(name[group[last]])].as_py(), int(start[last]), int(end[last]), previous[last].as_py())
        if last:
            out = rows[:last]
            yield emit(item.take(out), layer.take(out), start[:last], end[:last], previous[:last], first[:last])
        first_item = bool(first[last])
    if opened is not None:
        yield emit(pa.array([opened[0]], pa.string()), pa.array([opened[1]], pa.string()), [opened[2]], [opened[3]], pa.array([opened[4]], pa.int64()), [first_item], True)


OPEN = "node bigint, in_start bigint, in_end bigint, in_previous bigint, goes_on boolean"


def _root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node the period open where it begins, and whether its last item goes on in the next node."""
    nodes = [r for b in batches for r in b.to_pylist()]
    nodes.sort(key=lambda r: r["node"])
    out: list[tuple] = []
    state: tuple | None = None
    for k, n in enumerate(nodes):
        last = (n["item"], n["layer"])
        goes_on = k + 1 < len(nodes) and (nodes[k + 1]["first_item"], nodes[k + 1]["first_layer"]) == last
        out.append((n["node"], *(state or (None, None, None)), goes_on))
        mine = (n["start_ms"], n["end_ms"], n["previous"])
        if state is not None and (n["first_item"], n["first_layer"]) == last:
            if n["end_ms"] <= state[1]:
                mine = state
            elif n["start_ms"] <= state[1]:
                mine = (state[0], n["end_ms"], state[2])
            else:
                mine = (n["start_ms"], n["end_ms"], max(n["previous"] if n["previous"] is not None else state[1], state[1]))
        state = mine if goes_on else None
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = [pa.int64()] * 4 + [pa.bool_()]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in OPEN.split(", ")])


def periods_and_gaps(intervals: DataFrame, block_ms: int = BLOCK_MS) -> DataFrame:
    """item, layer, kind ('period' or 'gap'), start_ms, end_ms of item, layer, start_ms, end_ms."""
    counted = intervals.where("item is not null and end_ms > start_ms").select(
        "item", "layer", F.floor(F.col("start_ms") / F.lit(block_ms)).cast("bigint").alias("block"), "start_ms", "end_ms"
    )
    lists = cut(counted.mapInArrow(_leaves, LISTS))  # written, as ranges are drawn from a first look at them
    ordered = lists.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("node", F.spark_partition_id().cast("bigint"))
    nodes = cut(ordered.mapInArrow(_nodes, PERIODS))
    lasts = nodes.where("is_last").select("node", "item", "layer", "start_ms", "end_ms", "previous")
    firsts = nodes.where("is_first").groupBy("node").agg(F.first("item").alias("first_item"), F.first("layer").alias("first_layer"))
    opens = lasts.join(firsts, "node").coalesce(1).mapInArrow(_root, OPEN)  # a row a node
    reached = F.col("is_first") & F.col("in_end").isNotNull()
    ends_here = ~F.col("is_last") | ~F.col("goes_on")
    span = lambda a, b, before: F.struct(a.alias("start_ms"), b.alias("end_ms"), before.alias("previous"))
    s, e, before = F.col("start_ms"), F.col("end_ms"), F.col("previous")
    opened = span(F.col("in_start"), F.col("in_end"), F.col("in_previous"))
    own = lambda c: F.when(ends_here, c)
    kept = (
        F.when(~reached, F.array(own(span(s, e, before))))
        .when(e <= F.col("in_end"), F.array(F.when(F.col("is_last") & ~F.col("goes_on"), opened)))
        .when(s <= F.col("in_end"), F.array(own(span(F.col("in_start"), e, F.col("in_previous")))))
        .when(before.isNull() | (before <= F.col("in_end")), F.array(opened, own(span(s, e, F.col("in_end")))))
        .otherwise(F.array(own(span(s, e, before))))
    )
    row = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start_ms"), b.alias("end_ms"))
    out = F.flatten(
        F.transform(
            F.filter(kept, lambda x: x.isNotNull()),
            lambda x: F.filter(F.array(F.when(x["previous"].isNotNull(), row("gap", x["previous"], x["start_ms"])), row("period", x["start_ms"], x["end_ms"])), lambda y: y.isNotNull()),
        )
    )
    return nodes.join(F.broadcast(opens), "node").select("item", "layer", F.inline(out))
