"""The canonical record and its rules."""

from __future__ import annotations

from pyspark.sql import types as T

#: Keys of a record with their kinds.
REQUIRED = {"instance_id": "string", "dataset": "string", "audio_path": "string", "split": "string", "labels": "object", "metadata": "object"}
OPTIONAL = {"file_id": "string", "start_t": "number", "end_t": "number", "speaker": "string", "text": "string", "frame_rate_hz": "integer"}
SPLITS = ("train", "dev", "test")
FRAME_RATE_HZ = 50


def record(labels: T.StructType, metadata: T.StructType) -> T.StructType:
    """Schema of a canonical table with these label and metadata structs."""
    kinds = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.IntegerType(), "object": None}
    fields = [T.StructField(k, kinds[v]) for k, v in REQUIRED.items() if v != "object"]
    fields += [T.StructField("labels", labels), T.StructField("metadata", metadata)]
    return T.StructType(fields + [T.StructField(k, kinds[v]) for k, v in OPTIONAL.items()])


UTTERANCE_LABELS = "struct<speaker_gender:string,speaker_age:int,filled_pause_present:int,filled_pause_count:int,sentiment_logit:double,sentiment_6:string>"
FRAME_LABELS = "struct<filled_pause:array<int>>"
WORD_FRAME_LABELS = "struct<primary_stress:array<int>>"
EVENT_LABELS = "struct<fp_type:string>"
