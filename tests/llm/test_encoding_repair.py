"""Garbled texts made from clean ones: found, restored, and clean ones left alone."""

import random

import numpy as np
import pytest

from tierflow.llm import encoding_repair as r

WORDS = "točka županija služba prihvaća podržava uređuje većina članak povećanje škola šuma čišćenje iduće građana još obnovu cijenu grijanja klub rok za i na predsjednik vodovod općina željezničke močvarna".split()
CYR = "Седница тачка служба подржава правилник обнову библиотека предлог закона општина удружење".split()
FOREIGN = ["Crêpelière.", "Ångmåla.", "Niccolè.", "naïve", "½", "§", "€", "日程", "Sæbygård."]


def garble(text, written, read, times=1):
    for _ in range(times):
        text = text.encode(written).decode(read, "replace")
    return text


def corpus():
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(400):
        words = [rng.choice(WORDS if i % 4 else CYR) for _ in range(40)]
        if i % 3 == 0:
            words.insert(rng.randint(0, 39), rng.choice(FOREIGN))
        rows.append([i, " ".join(words), "s1" if i % 2 else "s2"])
    kinds = [("utf-8", "cp1250", 1), ("utf-8", "latin-1", 1), ("utf-8", "latin-1", 2), ("cp1250", "latin-1", 1), ("utf-8", "mac_roman", 1)]
    for k, i in enumerate(range(1, 400, 16)):
        written, read, times = kinds[k % len(kinds)]
        clean = " ".join(w for w in rows[i][1].split(" ") if w not in FOREIGN)
        truth[i] = clean
        a, b = clean[:60].rsplit(" ", 1)[0], clean[60 - len(clean[:60].rsplit(" ", 1)[1]) - 1 :]
        rows[i][1] = garble(a, written, read, times) + clean[len(a) :] if k % 2 else garble(clean, written, read, times)
        assert b is not None
    rows += [[1000, None, "s1"], [1001, "", None], [1002, "to�ka slu�ba", "s1"], [1003, " ", "s1"], [1004, "ascii only", "s1"], [1005, "č" * 20000, "s1"]]
    return rows, truth


@pytest.fixture(scope="module")
def repaired(spark):
    rows, truth = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    return {x.doc_id: x for x in r.repair(df, r.fit(df)).collect()}, truth, {x[0]: x[1] for x in rows}


def test_all_garbled_texts_are_found_and_no_clean_one(repaired):
    out, truth, _ = repaired
    found = {i for i, x in out.items() if x.status != "clean"}
    assert found == set(truth) | {1002}


def test_texts_are_restored(repaired):
    out, truth, _ = repaired
    right = sum(out[i].text == t for i, t in truth.items())
    assert right >= 0.9 * len(truth), [(out[i].chain, out[i].text[:80], t[:80]) for i, t in truth.items() if out[i].text != t][:3]


def test_edge_texts(repaired):
    out, _, texts = repaired
    assert len(out) == len(texts)
    assert [out[i].status for i in (1000, 1001, 1003, 1004)] == ["clean"] * 4 and out[1000].text is None
    assert out[1002].status == "lost" and out[1002].text == texts[1002]


@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "cp1250", "cp852", "cp437", "mac_roman"])
def test_chains_undo_what_they_name(codec):
    chain = r.Utf8Chain(codec)
    word = "čišćenje–đ"
    read = "".join(chr(b) if b < 0x80 else r.byte_map(codec)[b] for b in word.encode())
    assert chain.undo(read) == word


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert r.repair(df, r.fit(df)).count() == 0


def test_words_of_one_character(spark):
    rng = random.Random(5)
    rows = [[i, " ".join(rng.choice([*(CYR if i % 2 else WORDS), *("уо–" if i % 2 else "–")]) for _ in range(40)), "s"] for i in range(300)]
    clean = "Седница у служба – правилник о обнову у библиотека о закона"
    other = "klub – rok za grijanja – predsjednik"
    rows += [[1000, garble(clean, "cp1251", "cp1252"), "s"], [1001, other.replace("–", "\x96"), "s"], [1002, "klub ó rok za î grijanja", "s"]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {x.doc_id: (x.status, x.text) for x in r.repair(df, r.fit(df)).collect()}
    assert out[1000] == ("restored", clean) and out[1001] == ("restored", other)
    assert out[1002] == ("clean", rows[-1][1])
    assert {i for i, x in out.items() if x[0] != "clean"} == {1000, 1001}


@pytest.mark.parametrize("word", ["реструктурирање", "реструктурирање" * 40])
def test_all_dropped_bytes_are_filled_in(word):
    sums = r.Counts()
    for w in [word, *CYR, *WORDS]:
        sums.add(w, 50.0)
    chars = r.Counter(c for w in [word, *CYR, *WORDS] for c in w.lower() if c > "\x7f")
    at, _, values = map(np.array, sums.columns(1 << 18))
    model = r.Model({c: 50.0 * n for c, n in chars.items()}, r.to_tables(1 << 18, at, values))
    damaged = "".join(c for c in garble(word, "utf-8", "latin-1") if not "\x80" <= c <= "\x9f")
    assert model.candidates(damaged)["utf-8>latin-1-"] == word
