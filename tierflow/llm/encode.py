"""Problem 8: the ids of a public byte-level BPE for every text.

Method: a sentencepiece BPE model is serialised directly from the vocabulary
(byte-mapped pieces, score = minus rank, identity normalisation). Texts are cut
into the pre-tokens of the vocabulary's pattern, pre-tokens are encoded by that
model, and ids are decoded by the inverse byte mapping.

The encoder works on Arrow batches. Text is cut at every U+0020 that is followed
by a non-space; at these places the pattern always starts a new pre-token, so
the stretches between them can be encoded one by one and kept in a cache that
belongs to the task. A batch then needs one dictionary lookup per stretch, and
its ids are gathered with numpy.

Defined results: NULL and empty texts give an empty list; strings of special
tokens are ordinary text; blanks, very long texts and long runs without a space
are encoded whole.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary file lies; a parameter of every operator here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A task's cache is emptied when it holds so many stretches; the result does not depend on it.
CACHE_STRETCHES = 500_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 stands for
    itself, every other byte for the next free code point from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_vocabulary(path: str) -> list[bytes]:
    """The tokens of a rank file, in order of rank (ranks are 0..n-1)."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    return [ranked[i] for i in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, varint or 32-bit float by the value's type."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is token i; the unknown piece comes last."""
    alphabet = byte_alphabet()
    normal, unknown, bpe = 1, 2, 2  # values of the public model format
    pieces = [
        _field(1, _field(1, "".join(alphabet[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, normal))
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(
        _field(n, 2**64 - 1) for n in (41, 42, 43)
    )
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class _Stretches(dict):
    """Stretch of text -> its index; an unknown one gets the next index and is left to be encoded."""

    def __init__(self, owner: Encoder, lead: str) -> None:
        self.owner, self.lead = owner, lead

    def __missing__(self, key: str) -> int:
        self[key] = index = self.owner.known + len(self.owner.pending)
        self.owner.pending.append(self.lead + key)
        return index


class Encoder:
    """Encodes and decodes by one vocabulary; keeps what it has encoded."""

    def __init__(self, path: str = VOCABULARY) -> None:
        import sentencepiece

        self.tokens = read_vocabulary(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.to_piece = {b: c for b, c in enumerate(byte_alphabet())}
        self.pre_token = regex.compile(PATTERN)
        self.odd = re.compile(r" (?:\s|$)").search
        self.pieces: dict[str, list[int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.first = _Stretches(self, "")
        self.later = _Stretches(self, " ")
        self.pending: list[str] = []
        self.known = 0
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1, np.int32)

    def _pre_token_ids(self, pre_tokens: set[str]) -> None:
        new = [p for p in pre_tokens if p not in self.pieces]
        if len(self.pieces) + len(new) > CACHE_STRETCHES:
            self.pieces, new = {}, list(pre_tokens)
        mapped = [p.encode().decode("latin-1").translate(self.to_piece) for p in new]
        self.pieces.update(zip(new, self.model.encode(mapped, out_type=int, num_threads=1) if mapped else []))

    def _learn(self) -> None:
        """Encodes the pending stretches."""
        if not self.pending:
            return
        found = [self.pre_token.findall(key) for key in self.pending]
        self._pre_token_ids({p for ps in found for p in ps})
        ids = [[i for p in ps for i in self.pieces[p]] for ps in found]
        ends = int(self.starts[-1]) + np.cumsum([len(x) for x in ids])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.starts[-1] : ends[-1]] = [i for x in ids for i in x]
        self.starts = np.concatenate([self.starts, ends.astype(np.int32)])
        self.known += len(self.pending)
        self.pending = []

    def _cut(self, text: str) -> list[str]:
        """Stretches; all but the first have lost the one space before them."""
        parts = text.split(" ")
        if not self.odd(text):
            return parts
        # Python's white space holds the pattern's, so a cut is never wrong, at most left out.
        out = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                out.append(p)
            else:
                out[-1] += " " + p
        return out

    def _lengths(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index and length of each stretch, and where the ids of each text begin and end."""
        if self.known > CACHE_STRETCHES:
            self._reset()
        index: list[int] = []
        ends = [0]
        first, later = self.first.__getitem__, self.later.__getitem__
        for text in texts:
            if text:
                parts = iter(self._cut(text))
                index.append(first(next(parts)))
                index.extend(map(later, parts))
            ends.append(len(index))
        self._learn()
        picked = np.array(index, np.int32)
        lengths = np.diff(self.starts)[picked]
        return picked, lengths, np.concatenate([[0], np.cumsum(lengths)])[ends]

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        return np.diff(self._lengths(texts)[2])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts, one after the other."""
        index, lengths, bounds = self._lengths(texts)
        total = int(bounds[-1])
        shift = self.starts[index] - (np.cumsum(lengths, dtype=np.int32) - lengths)
        return bounds, self.flat[np.repeat(shift, lengths) + np.arange(total, dtype=np.int32)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; inverse of encode for every valid string."""
        return b"".join(self.tokens[i] for i in ids).decode()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary."""
    return Encoder(path)


#: Rows in a slice of a batch: bounds the memory of long texts.
SLICE_CHARS = 4_000_000


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about SLICE_CHARS characters; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encode_texts(
    df: DataFrame, text: str = "text", ids: str = "ids", keep: list[str] | None = None, path: str = VOCABULARY
) -> DataFrame:
    """``keep`` columns (default: all others) and ``ids``, the ids of ``text``.

    One narrow pass, no shuffle. NULL and empty texts give []. A column of
    ``df`` named as ``ids`` is replaced."""
    keep = [c for c in (df.columns if keep is None else keep) if c != ids and (keep is not None or c != text)]
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in slices(texts):
                offsets, values = e.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), lists], names=[*keep, ids])

    return source.mapInArrow(run, schema)


def count_tokens(
    df: DataFrame, text: str = "text", tokens: str = "tokens", keep: list[str] | None = None, path: str = VOCABULARY
) -> DataFrame:
    """As encode_texts, with the number of ids instead of the ids."""
    keep = [c for c in (df.columns if keep is None else keep) if c != tokens and (keep is not None or c != text)]
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(tokens, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            counts = np.concatenate([e.count(texts[a:b]) for a, b in slices(texts)] or [np.zeros(0, np.int64)])
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*keep, tokens])

    return source.mapInArrow(run, schema)


def decode_ids(df: DataFrame, ids: str = "ids", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The other columns and the ``text`` of ``ids``; NULL ids give NULL."""
    keep = [c for c in df.columns if c not in (ids, text)]
    source = df.select(*keep, F.col(ids).alias("__ids"))
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = [None if x is None else e.decode(x) for x in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*keep, text])

    return source.mapInArrow(run, schema)
