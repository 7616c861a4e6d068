"""Problem 6: oversized frame records cut into pieces at natural boundaries.

Method: offsets of the frames as prefix sums (frame i begins at i / rate), a
sorted array of boundaries (frame edges that don't lie inside a labelled event),
binary search for the last boundary within the limit, a step back by the overlap
for the next piece, and a hard cut where no boundary helps.

A cut is looked for in this order: the last place within the limit where both
the end of the piece and the start of the next (the end less the overlap) lie
outside events; the last where the end does; the limit itself. Every cut moves
on by at least a frame, so pieces never grow in number without end.

One narrow pass over Arrow batches, no shuffle but the one that makes repeated
rows one. Times are whole milliseconds. Pieces hold the labels of the frames
that begin in them.

Defined results: the size is the larger of audio_length and the number of
labels / frame_rate_hz, NULL counts as 0 (so does a rate that is not above 0);
places beyond the labels are free of events, NULL labels too; a record not over
its limit, or of a data set without a positive limit, is one piece; an overlap
that is missing or negative is 0, one not below the limit is cut to half of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.common import ms, small


def event_runs(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last frame of every run of non-zero labels."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], labels != 0, [0]])))
    return edges[::2], edges[1::2]


def cut_places(labels: np.ndarray, rate: int, size: int, limit: int, overlap: int) -> list[tuple[int, int]]:
    """start and end, in ms, of the pieces of one record."""
    if limit <= 0 or size <= limit:
        return [(0, size)]
    starts, ends = event_runs(labels)
    offsets = np.arange(len(labels) + 1) * 1000 // rate if rate > 0 else np.zeros(1, np.int64)
    inside = np.zeros(len(offsets), bool)
    for a, b in zip(starts, ends):
        inside[a + 1 : b] = True
    boundaries = offsets[~inside]  # sorted; beyond the last every millisecond is one
    from_ms, to_ms = (offsets[starts], offsets[ends]) if len(starts) else (starts, ends)
    last = int(offsets[-1])

    def boundary(at: int) -> int:
        """The last boundary not after a time."""
        return at if at >= last else int(boundaries[np.searchsorted(boundaries, at, "right") - 1])

    def cut_between(least: int, most: int) -> int:
        at = most
        while (end := boundary(at)) >= least:
            k = int(np.searchsorted(from_ms, end - overlap, "left")) - 1
            if k < 0 or end - overlap >= to_ms[k]:
                return end
            at = int(from_ms[k]) + overlap  # the next piece would begin inside this event: before it
        end = boundary(most)
        return end if end >= least else most

    step = max(1, 1000 // rate) if rate > 0 else 1
    pieces, start = [], 0
    while size - start > limit:
        end = cut_between(start + overlap + step, start + limit)
        pieces.append((start, end))
        start = end - overlap
    return [*pieces, (start, size)]


def pieces(frame_records: DataFrame, limits: DataFrame) -> DataFrame:
    """instance_id, dataset, audio_path, piece, pieces, start_ms, end_ms, first_frame, labels, size_ms, limit_ms.

    ``limits``: dataset, max_piece_s, overlap_s, one row per data set. Identical
    rows of one instance_id are one record."""
    rate = F.col("frame_rate_hz")
    n = F.coalesce(F.size("labels.filled_pause"), F.lit(0))
    counted = F.when((rate > 0) & (n > 0), n / rate)
    size = F.greatest(
        F.coalesce(ms("metadata.audio_length"), F.lit(0)), F.coalesce(ms(counted), F.lit(0)), F.lit(0)
    )
    rows = frame_records.select(
        "instance_id", "dataset", "audio_path",
        F.coalesce(rate, F.lit(0)).cast("int").alias("rate"), size.cast("bigint").alias("size_ms"),
        F.col("labels.filled_pause").alias("labels"),
    ).distinct()
    bounds = limits.select(
        "dataset",
        F.coalesce(ms("max_piece_s"), F.lit(0)).alias("limit_ms"),
        F.greatest(F.coalesce(ms("overlap_s"), F.lit(0)), F.lit(0)).alias("overlap_ms"),
    )
    joined = rows.join(small(bounds), "dataset", "left").select(
        "instance_id", "dataset", "audio_path", "rate", "size_ms", "labels",
        F.coalesce("limit_ms", F.lit(0)).alias("limit_ms"), F.coalesce("overlap_ms", F.lit(0)).alias("overlap_ms"),
    )
    schema = (
        "instance_id string, dataset string, audio_path string, piece int, pieces int, start_ms bigint, end_ms bigint,"
        " first_frame int, labels array<int>, size_ms bigint, limit_ms bigint"
    )
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    ints = lambda x, t: pa.array(np.asarray(x, np.int64)).cast(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rates, sizes, limits, overlaps = (batch.column(i).to_numpy() for i in (3, 4, 6, 7))
            lists = batch.column(5)
            held = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], np.cumsum(lengths)])
            out: list[tuple] = []  # row, piece, pieces, start, end, first frame, place of its labels in ``held``
            for i, (rate, size, limit) in enumerate(zip(rates.tolist(), sizes.tolist(), limits.tolist())):
                low, high = int(begins[i]), int(begins[i + 1])
                if limit <= 0 or size <= limit:
                    out.append((i, 0, 1, 0, size, 0, low, high))
                    continue
                overlap = int(overlaps[i]) if overlaps[i] < limit else limit // 2
                cuts = cut_places(held[low:high], rate, size, limit, overlap)
                for k, (a, b) in enumerate(cuts):
                    first, past = (min(-(-t * rate // 1000), high - low) if rate > 0 else 0 for t in (a, b))
                    out.append((i, k, len(cuts), a, b, first, low + first, high if k == len(cuts) - 1 else low + max(first, past)))
            row, piece, n, a, b, first, low, high = (np.array(c, np.int64) for c in zip(*out))
            ends = np.concatenate([[0], np.cumsum(high - low)])
            labels = np.concatenate([held[x:y] for x, y in zip(low.tolist(), high.tolist())])
            gone = lists.is_null().to_numpy(zero_copy_only=False)[row]
            own = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), mask=np.append(gone, False)), pa.array(labels).cast(pa.int32()))
            heads = [batch.column(c).take(pa.array(row)) for c in (0, 1, 2)]
            yield pa.RecordBatch.from_arrays(
                [*heads, ints(piece, pa.int32()), ints(n, pa.int32()), ints(a, pa.int64()), ints(b, pa.int64()), ints(first, pa.int32()), own,
                 ints(sizes[row], pa.int64()), ints(limits[row], pa.int64())], names=names,
            )

    return joined.mapInArrow(run, schema)
