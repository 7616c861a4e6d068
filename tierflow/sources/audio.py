"""Audio: header facts by the standard library, cutting by a pluggable codec."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_SCHEMA = "path string, duration double, rate int, channels int, error string"


def wav_header(content: bytes) -> tuple[float, int, int]:
    with wave.open(io.BytesIO(content)) as w:
        return w.getnframes() / w.getframerate(), w.getframerate(), w.getnchannels()


def wav_durations(spark: SparkSession, path: str) -> DataFrame:
    """path, duration, rate, channels of WAV files; unreadable ones have an error and NULLs."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, c in zip(batch["path"], batch["content"]):
                try:
                    rows.append((p, *wav_header(c), None))
                except (wave.Error, EOFError, ZeroDivisionError) as e:
                    rows.append((p, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in HEADER_SCHEMA.split(", ")])

    return files.select("path", "content").mapInPandas(run, HEADER_SCHEMA)  # chunks of any length may come before the samples


OUTCOMES = ("kept", "skipped_existing", "missing_source", "cut_failed")


def cut_dataset(records: DataFrame, cut: Callable[[str, float | None, float | None, str], None], exists: Callable[[str], bool], force: bool = False, shortest: float = 0.0) -> DataFrame:
    """``records`` with outcome and error. Needs source_path, start_t, end_t, audio_path.

    ``cut`` writes one slice and raises if it can't (error says why); ``exists`` tells
    what is there already. Rows of ten minutes of one source are brought together and
    sorted, so that a codec can keep the source open and a long or much used source is
    spread; a slice not above ``shortest`` seconds fails."""
    columns = records.columns
    schema = records.schema.simpleString()[len("struct<") : -1] + ",outcome:string,error:string"
    stretch = F.floor(F.coalesce("start_t", F.lit(0.0)) / 600)
    rows = records.repartition("source_path", stretch).sortWithinPartitions("source_path", "start_t")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            outcomes, errors = [], []
            for source, a, b, target in zip(*(batch[c] for c in ("source_path", "start_t", "end_t", "audio_path"))):
                a, b = (None if pd.isna(t) else t for t in (a, b))
                errors.append(None)
                if not force and exists(target):
                    outcomes.append("skipped_existing")
                elif not source:
                    outcomes.append("missing_source")
                else:
                    try:
                        if a is not None and b is not None and b - a <= shortest:
                            raise ValueError("empty slice")
                        cut(source, a, b, target)
                        outcomes.append("kept")
                    except Exception as e:  # whatever a codec raises is reported with its row
                        outcomes.append("cut_failed")
                        errors[-1] = f"{type(e).__name__}: {e}"
            yield batch[columns].assign(outcome=outcomes, error=errors)

    return rows.mapInPandas(run, schema)


def model_frames(files: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The plug for a model's forward pass: Arrow batches in, frames out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield model(batch)

    return files.mapInPandas(run, schema)


def outcome_counts(cut_records: DataFrame) -> DataFrame:
    """outcome, n of a run of cut_dataset, zeros included."""
    every = cut_records.sparkSession.createDataFrame([(o,) for o in OUTCOMES], "outcome string")
    return every.join(cut_records.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


def pcm_samples(path: str, start: float | None = None, end: float | None = None) -> tuple[np.ndarray, int]:
    """Mono samples from -1 to 1 and the rate of a PCM WAV file of 8, 16, 24 or 32 bits, or of a stretch of it in seconds."""
    with wave.open(path) as w:
        rate, width, channels = w.getframerate(), w.getsampwidth(), w.getnchannels()
        first = min(max(round((start or 0.0) * rate), 0), w.getnframes())
        past = w.getnframes() if end is None else min(max(round(end * rate), first), w.getnframes())
        w.setpos(first)
        raw = np.frombuffer(w.readframes(past - first), np.uint8).reshape(-1, width)
    if width == 1:
        values = raw[:, 0].astype(np.float32) - 128
    else:
        wide = np.zeros((len(raw), 4), np.uint8)
        wide[:, 4 - width :] = raw  # the sign is in the last byte
        values = wide.view("<i4")[:, 0].astype(np.float32) / 2.0 ** (32 - 8 * width)
    return values.reshape(-1, channels).mean(1) / 2.0 ** (8 * width - 1), rate


def write_pcm16(path: str, samples: np.ndarray, rate: int) -> None:
    """Samples from -1 to 1 as mono PCM of 16 bits; louder ones are cut."""
    with wave.open(path, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.rint(np.clip(samples, -1, 32767 / 32768) * 32768).astype("<i2").tobytes())


def cut_pcm(source: str, start: float | None, end: float | None, target: str, rate: int = 16_000) -> None:
    """A codec for cut_dataset: a stretch of a PCM WAV file as 16 kHz mono of 16 bits, by linear interpolation."""
    samples, own = pcm_samples(source, start, end)
    if not len(samples):
        raise ValueError("empty slice")
    if own != rate:
        at = np.arange(round(len(samples) * rate / own)) * (own / rate)
        samples = np.interp(at, np.arange(len(samples)), samples)
    write_pcm16(target, samples, rate)
