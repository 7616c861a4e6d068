"""Encoding: equal to the public tokenizer, round trips, edge cases."""

import base64
import random

import pytest
import tiktoken

from tierflow.llm import encode


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(encode.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=encode.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(reference, texts):
    e = encode.Encoder()
    offsets, ids = e.encode(texts)
    for i, t in enumerate(texts):
        got = ids[offsets[i] : offsets[i + 1]].tolist()
        assert got == reference.encode_ordinary(t or ""), t
        assert e.decode(got) == (t or "")
    assert e.count(texts).tolist() == [offsets[i + 1] - offsets[i] for i in range(len(texts))]


def test_edge_texts(reference):
    same(reference, [None, "", " ", "\n", "  a  b ", "a \n b", "don't I'LL we've", "<|endoftext|>", "č̌ ž", "日程👏🏽", "\x00\x1c \x85x", "a\r\n\r\n b"])


def test_random_texts(reference):
    rng = random.Random(1)
    letters = " \n\t\r  \xa0　ab1'sstčЖ—<|>\x1c\x85 é́😀"
    same(reference, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)])


def test_every_code_point_between_letters_and_spaces(reference):
    same(reference, [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)} x  {chr(c)}\n{chr(c)}" for c in range(1, 0x3000)])


def test_long_text_and_full_cache(reference, monkeypatch):
    monkeypatch.setattr(encode, "CACHE_STRETCHES", 50)
    monkeypatch.setattr(encode, "SLICE_CHARS", 100)
    same(reference, ["x" * 20_000, " ".join(f"w{i}" for i in range(500)), "y" * 300])
    same(reference, [" ".join(f"w{i}" for i in range(k, k + 40)) for k in range(0, 400, 40)])


def test_tables(spark, reference):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (3, "", "z"), (1, "a b", "x")], "doc_id bigint, text string, extra string")
    out = encode.encode_texts(df)
    assert out.columns == ["doc_id", "extra", "ids"]
    assert sorted((r.doc_id, r.ids) for r in out.collect()) == [(1, [64, 275]), (1, [64, 275]), (2, []), (3, [])]
    assert sorted((r.doc_id, r.tokens) for r in encode.count_tokens(df, keep=["doc_id"]).collect()) == [(1, 2), (1, 2), (2, 0), (3, 0)]
    back = encode.decode_ids(out.select("doc_id", "ids"))
    assert {r.doc_id: r.text for r in back.collect()} == {1: "a b", 2: "", 3: ""}
    assert encode.encode_texts(df.limit(0)).count() == 0
    clash = encode.encode_texts(df.withColumnRenamed("extra", "ids"), keep=["doc_id", "ids"])
    assert clash.columns == ["doc_id", "ids"] and clash.where("doc_id = 1").first().ids == [64, 275]


def test_long_rows_are_cut_into_slices(monkeypatch):
    monkeypatch.setattr(encode, "SLICE_CHARS", 10)
    assert list(encode.slices(["a" * 4, "b" * 4, "c" * 30, None, "d"])) == [(0, 2), (2, 3), (3, 5)]
    assert list(encode.slices([])) == []
