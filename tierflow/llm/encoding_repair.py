"""Problem 10: text decoded with the wrong character encoding.

Method: expectation-maximisation with latent encoding chains. A chain says in
which encoding bytes were written and in which they were read (once or more);
undoing it gives a candidate for the original of a word. Each occurrence of a
word has a latent chain (or none); the weights of the chains are pooled per
source, and one language model of clean text is pooled over all records. E: the
posterior of each chain for each suspicious word. M: chain weights per source,
and the language model from the words as they read clean.

Records are then repaired by posterior. A record has a latent chain or none, and
under a chain each of the words it would change is damaged with a latent share
(``SHARES``), all of them or only a stretch: the odds are the chain's weight times
the mixture over the shares of the product of (1 - share + share x likelihood
ratio) over these words, those that speak against the chain included. The sum of
the ratios that speak for it bounds this from above, so only records that pass
that bound are worked out in full.

What is held at once: counts of words, trigrams and bigrams in hashed tables, four
to eight buckets a word of the dictionary (``buckets_for``; beyond 1 million words
counts of rare words blur, as in any count-min sketch, and the trigrams decide),
character counts (at most one per code point) and 16 bytes a source for its
weights. So both EM and repair are passes over tasks' own rows with these
broadcast; the corpus is read twice, the suspicious words of its dictionary once an
iteration, and nothing but sums is shuffled.

Only words with a suspicious character are tested: one for which some chain
gives a more frequent character, or that begins a multi-byte sequence in some
reading. A candidate is scored only if it raises the likelihood of the single
characters. In words beyond ``LONG`` characters repeated trigrams count once.

U+FFFD and C1 control characters that no chain explains mark damage that can't
be undone; such records are found and come out with status 'lost'.

Defined results: NULL, empty and blank texts are clean; text of one long word is
tested like any other; records that need no repair come out as they are.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.common import cut, normalised

#: Readings under which UTF-8 bytes turn into other characters.
UTF8_READ_AS = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp852", "cp437", "mac_roman", "mac_latin2", "koi8-r"]
#: Readings whose unseen characters may have been dropped on the way.
MAY_DROP = ["cp1252", "latin-1", "cp1250"]
#: Fixed values: (written, read) for encodings of one byte a character.
SINGLE_BYTE = [
    ("cp1250", "cp1252"), ("cp1250", "latin-1"), ("iso8859-2", "latin-1"), ("iso8859-2", "cp1252"),
    ("iso8859-2", "cp1250"), ("cp1250", "iso8859-2"), ("cp852", "cp1250"), ("cp852", "cp1252"),
    ("cp852", "latin-1"), ("cp1250", "cp852"), ("cp1250", "cp437"), ("cp1251", "cp1252"),
    ("cp1251", "latin-1"), ("cp1251", "cp1250"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"),
    ("cp1251", "cp866"), ("cp866", "cp1251"), ("iso8859-5", "cp1251"), ("mac_latin2", "cp1250"),
    ("cp1250", "mac_latin2"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1250", "mac_roman"),
]

#: Most sources whose weights are held (16 bytes each); more are an error.
MAX_SOURCES = 20_000_000
#: Sources whose counts of one word meet in a row of the expectation step.
SOURCES_A_ROW = 1000
#: Shares of a record's words that are damaged, alike before anything is known, and the words of a record that its chain's weight stands for.
SHARES, RECORD_WORDS = (1 / 50, 1 / 4, 0.999), 50
#: Length of words in which repeated trigrams count once.
LONG = 64
#: Characters that separate words (a no-break space does not: it is half of some sequences).
SPACES = " \n\r\t"
PUNCTUATION = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~„“”‘’–—…•«»"
LOST = "lost"
#: Words that are odd whatever their letters: capitals after small letters, two scripts; each costs ODD.
MIXED_CASE = re.compile("[a-zß-öø-ÿа-џšžčćđłńśźżąęěřůňťď][A-ZÀ-ÖØ-ÞЀ-ЯŠŽČĆĐŁŃŚŹŻĄĘĚŘŮŇŤĎ]")
#: Those of them that are worth a test: a capital beyond ASCII.
SMALL = "abcdefghijklmnopqrstuvwxyzšžčćđłńśźżąęěřůňťďáéíóúý"
CAPITAL = "ŠŽČĆĐŁŃŚŹŻĄĘĚŘŮŇŤĎÁÉÍÓÚÝ"
LATIN, CYRILLIC, ODD = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]"), re.compile("[Ѐ-ԯ]"), 20.0
#: Beginnings of a word kept while lone lead characters are filled in; one character has at most 34 completions.
BEAM = 40
#: Start of the weight of each chain.
PRIOR = 1e-3
#: C1 controls but NEL, which ends lines; a clean text has none, so one that a chain turns into a sign counts SIGN for it.
CONTROL, SIGN = re.compile("[\x80-\x84\x86-\x9f]"), 25.0


def byte_map(codec: str) -> dict[int, str]:
    """Byte 0x80-0xFF -> character as read; undefined bytes stay C1 controls."""
    return {b: bytes([b]).decode(codec, "ignore") or chr(b) for b in range(0x80, 0x100)}


class Utf8Chain:
    """UTF-8 bytes read in a one-byte encoding; undone sequence by sequence."""

    def __init__(self, codec: str) -> None:
        self.name = f"utf-8>{codec}"
        read = byte_map(codec)
        self.byte = {c: b for b, c in read.items()}
        for b in range(0x80, 0xA0):  # C1 controls pass through lenient readers
            self.byte.setdefault(chr(b), b)
        group = lambda a, z: "[" + "".join(re.escape(c) for c, b in self.byte.items() if a <= b < z) + "]"
        self.more = more = group(0x80, 0xC0)
        self.leads = {c for c, b in self.byte.items() if 0xC2 <= b < 0xF5}
        self.pattern = re.compile(f"{group(0xC2, 0xE0)}{more}|{group(0xE0, 0xF0)}{more}{{2}}|{group(0xF0, 0xF5)}{more}{{3}}")
        # bytes without a visible character may have been dropped: a lone lead stands for one of these
        unseen = [b for b, c in byte_map(codec).items() if 0x80 <= b < 0xC0 and (c < "\xa1" or c == "\xad")]
        self.dropped = {
            c: sorted({bytes([self.byte[c], b]).decode() for b in unseen}) for c in self.leads if self.byte[c] < 0xE0
        }
        self.lone = re.compile("[" + "".join(map(re.escape, self.dropped)) + "]") if codec in MAY_DROP else re.compile("(?!)")

    def _one(self, m: re.Match) -> str:
        try:
            return bytes(map(self.byte.__getitem__, m[0])).decode()
        except UnicodeDecodeError:
            return m[0]

    def undo(self, word: str) -> str:
        return self.pattern.sub(self._one, word)


class TableChain:
    """One-byte encodings mixed up: character by character."""

    def __init__(self, written: str, read: str) -> None:
        self.name = f"{written}>{read}"
        to = byte_map(written)
        self.table = {ord(c): to[b] for b, c in byte_map(read).items() if c != to[b]}
        # what a word read so can hold; signs may stand at the edge of the damage
        self.reads = {*byte_map(read).values(), *map(chr, range(0x80, 0xA0)), *PUNCTUATION, "�"}
        self.table = {c: t for c, t in self.table.items() if not "\x80" <= t <= "\x9f"}

    def undo(self, word: str) -> str:
        return word.translate(self.table)


@functools.lru_cache(maxsize=1)
def chains() -> tuple[list[Utf8Chain], list[TableChain]]:
    return [Utf8Chain(c) for c in UTF8_READ_AS], [TableChain(*p) for p in SINGLE_BYTE]


def buckets_for(words: int) -> int:
    """Buckets of a table: a power of two of at least four a word, 2^18 to 2^22 (so that a pass's sums fit a driver)."""
    return 1 << max(18, min(22, math.ceil(math.log2(max(words, 1) * 4))))


def code_of(s: str, seed: int = 0) -> int:
    """Its rest by the number of buckets is a key's bucket."""
    return zlib.crc32(s.encode("utf-8", "surrogatepass"), seed)


def trigrams(word: str) -> list[str]:
    """With marks for beginning and end; beyond LONG characters each once."""
    s = f"\x02\x02{word.lower()}\x03"
    out = [s[i - 2 : i + 1] for i in range(2, len(s))]
    return out if len(out) <= LONG else list(dict.fromkeys(out))


class Counts:
    """Sums of one task: of words, trigrams and texts. Bigrams follow from the trigrams they begin."""

    def __init__(self) -> None:
        self.words: Counter = Counter()
        self.held: Counter = Counter()  # words kept apart from the others
        self.threes: Counter = Counter()
        self.text: Counter = Counter()

    def add(self, word: str, n: float) -> None:
        self.words[core(word)] += n
        threes = self.threes
        for t in trigrams(word):
            threes[t] += n

    def columns(self, buckets: int) -> tuple[list[int | None], list[str | None], list[float]]:
        """Bucket (table x buckets + bucket), text and value of every sum."""
        twos: Counter = Counter()
        for t, n in self.threes.items():
            twos[t[:2]] += n
        at: Counter = Counter()
        for table, counts, seed in ((0, self.words, 0), (1, self.words, 1), (2, self.threes, 0), (3, twos, 0), (4, self.held, 0), (5, self.held, 1)):
            for key, n in counts.items():
                at[table * buckets + code_of(key, seed) % buckets] += n
        return [*at, *[None] * len(self.text)], [*[None] * len(at), *self.text], [*at.values(), *self.text.values()]


class Weights:
    """Weights of the chains: overall, and per source (a hash of its name) drawn to those by 1000 words' worth."""

    def __init__(self, overall: dict[str, float], ids: np.ndarray, totals: np.ndarray, own: dict[tuple[int, str], float]) -> None:
        self.overall, self.own = overall, own
        order = np.argsort(ids)
        self.ids, self.totals = ids[order], totals[order]

    def of(self, source: int, chain: str) -> float:
        shared = self.overall.get(chain, 1e-9)
        k = int(np.searchsorted(self.ids, source))
        if k == len(self.ids) or self.ids[k] != source:
            return shared
        return (self.own.get((source, chain), 0.0) + 1000 * shared) / (float(self.totals[k]) + 1000)


def core(word: str) -> str:
    """What a word is counted under: without punctuation, lower case unless its case is odd."""
    bare = word.strip(PUNCTUATION)
    return bare if MIXED_CASE.search(bare) else bare.lower()


def words_of(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")


def base_chain(chain: str) -> str:
    """The chain without how often it was undone and whether something was filled in."""
    return re.sub(r"(\*\d+)?-?$", "", chain)


class Model:
    """Language model of clean text (hashed counts) and chain weights."""

    def __init__(self, chars: dict[str, float], tables: np.ndarray, weights: Weights | None = None) -> None:
        self.counts = chars
        self.total_chars = sum(chars.values()) + 1.0
        self.chars = {c: math.log((n + 0.01) / self.total_chars) for c, n in chars.items()}
        self.no_char = math.log(0.01 / self.total_chars)
        self.words, self.again, self.three, self.two = tables
        self.buckets = len(self.words)
        self.total_words = float(self.words.sum()) + 1.0
        self.weights = weights
        self.known: dict[str, tuple[float, float, float]] = {}
        utf8, singles = chains()
        if weights:  # chains without weight need no test
            used = {base_chain(c) for c in weights.overall}
            utf8, singles = ([c for c in cs if c.name in used] for cs in (utf8, singles))
        self.utf8 = utf8
        # what one character gains under a table, and the characters worth a test
        self.gain = []
        # controls that stand for signs
        self.signs = {chain.name: {chr(c) for c, t in chain.table.items() if t in PUNCTUATION and CONTROL.match(chr(c))} for chain in singles}
        unsafe = {"�", *map(chr, range(0x80, 0xA0))}
        for chain in singles:
            gains = {chr(c): self.char(t) - self.char(chr(c)) for c, t in chain.table.items()}
            self.gain.append((chain, gains))
            unsafe |= {c for c, g in gains.items() if g > 0.7}
        # of a sequence that begins with a rare character the beginning is enough, of others the whole is needed
        rare = math.log(2e-3)
        sequences = []
        for chain in utf8:
            unsafe |= {c for c in chain.leads if self.char(c) < rare}
            for length, low, high in ((1, 0xC2, 0xE0), (2, 0xE0, 0xF0), (3, 0xF0, 0xF5)):
                often = [c for c in chain.leads - unsafe if low <= chain.byte[c] < high]
                if often:
                    sequences.append((sorted(often), sorted(c for c, b in chain.byte.items() if 0x80 <= b < 0xC0), length))
        quoted = lambda cs: "[" + "".join(map(re.escape, cs)) + "]"
        either = lambda q: "|".join([q(sorted(unsafe)), *(q(a) + q(b) + f"{{{n}}}" for a, b, n in sequences), q(SMALL) + q(CAPITAL)])
        self.suspicious = re.compile(either(quoted))

    def __getstate__(self) -> tuple:
        """What a broadcast holds: counts that aren't 0, compressed."""
        tables = np.stack([self.words, self.again, self.three, self.two]).ravel()
        at = np.flatnonzero(tables).astype(np.int32)
        return self.counts, self.buckets, zlib.compress(at.tobytes(), 1), zlib.compress(tables[at].tobytes(), 1), self.weights

    def __setstate__(self, state: tuple) -> None:
        chars, buckets, at, values, weights = state
        tables = np.zeros(4 * buckets, np.float32)
        tables[np.frombuffer(zlib.decompress(at), np.int32)] = np.frombuffer(zlib.decompress(values), np.float32)
        self.__init__(chars, tables.reshape(4, buckets), weights)

    def char(self, c: str) -> float:
        return self.chars.get(c.lower(), self.no_char) if c > "\x7f" else -3.5

    def count(self, key: str) -> float:
        """Of a word; the smaller of two hashed counts, as others may share its buckets."""
        return min(float(self.words[code_of(key) % self.buckets]), float(self.again[code_of(key, 1) % self.buckets]))

    def rarest(self, chars: set[str]) -> float:
        return min((self.char(c) for c in chars if ord(c) > 127), default=0.0)

    def plausible(self, word: str, original: str) -> bool:
        """Whether what came in is no rarer than what it stands for."""
        a, b = set(word), set(original)
        return self.rarest(b - a) + 1.0 >= self.rarest(a - b)

    def _counts(self, t: str) -> tuple[float, float, float]:
        """Of a trigram, of its beginning, and what its last character counts besides."""
        if len(self.known) > 200_000:
            self.known.clear()
        found = self.known[t] = (float(self.three[code_of(t) % self.buckets]), float(self.two[code_of(t[:2]) % self.buckets]), 2.0 * math.exp(self.char(t[-1])))
        return found

    def log_p(self, word: str, own: float) -> float:
        """Log probability of a word; ``own`` of its counts are its own and left out."""
        key = core(word)
        whole = max(self.count(key) - own, 0.0) / self.total_words
        out, product = 0.0, 1.0
        known = self.known
        for t in trigrams(word):
            found = known.get(t)
            if found is None:
                found = self._counts(t)
            c3, c2, base = found
            if own:
                c3, c2 = c3 - own if c3 > own else 0.0, c2 - own if c2 > own else 0.0
            product *= (c3 + base) / ((c2 if c2 > c3 else c3) + 2.0)
            if product < 1e-200:
                out, product = out + math.log(product), 1.0
        out += math.log(product)
        odd = ODD * (bool(MIXED_CASE.search(word)) + bool(LATIN.search(word) and CYRILLIC.search(word)))
        if not own:
            whole *= math.exp(-odd)
        out -= odd
        return math.log(0.5 * whole + 0.5 * math.exp(max(out, -600.0)) + 1e-300)

    def _restore_dropped(self, chain: Utf8Chain, word: str) -> str:
        """The likeliest completion of all lone lead characters; work is linear in the word's length.

        From left to right the BEAM likeliest beginnings are kept by their trigrams; of whole words the likeliest is taken."""
        ways: list[tuple] = [(0.0, "\x02\x02", None)]  # score, last two characters, (character, what is before it)
        for c in [*word, "\x03"]:
            options = chain.dropped.get(c) or [c]
            more = []
            for score, last, before in ways:
                for o in options:
                    t = last + o.lower()
                    c3, c2, base = self.known.get(t) or self._counts(t)
                    more.append((score + math.log((c3 + base) / (max(c3, c2) + 2.0)), t[-2:], (o, before)))
            ways = more if len(more) <= BEAM else heapq.nlargest(BEAM, more, key=lambda x: x[0])

        def whole(way: tuple) -> str:
            out, link = [], way[2][1]  # without the end mark
            while link:
                out.append(link[0])
                link = link[1]
            return "".join(reversed(out))

        return max(map(whole, ways), key=lambda w: self.log_p(w, 0.0))

    def candidates(self, word: str) -> dict[str, str]:
        """chain -> what the word would be without it."""
        utf8 = self.utf8
        out: dict[str, str] = {}
        for chain in utf8:
            if chain.leads.isdisjoint(word):
                continue
            r = chain.undo(word)
            if r != word:
                again = 1
                # every undoing makes the word shorter
                while twice := sorted(t for t in {c.undo(r) for c in utf8 if not c.leads.isdisjoint(r)} if len(t) < len(r)):
                    r, again = twice[0] if len(twice) == 1 else max(twice, key=lambda w: self.log_p(w, 0.0)), again + 1
                    out[f"{chain.name}*{again}"] = r
                out.setdefault(chain.name, chain.undo(word))
            if chain.lone.search(r) and self.char(chain.lone.search(r)[0]) < math.log(1e-3):
                d = self._restore_dropped(chain, r)
                if d != r:
                    out[f"{chain.name}-"] = d
        if len(core(word)) > 1:
            out |= self._by_table(word)
        elif CONTROL.search(word):  # of characters alone only controls speak for a chain, see ``lone``
            out |= {c: r for c, r in self._by_table(word).items() if self.makes_signs(c, word)}
        return self._likely(word, out)

    def _by_table(self, word: str) -> dict[str, str]:
        out: dict[str, str] = {}
        odd = [c for c in word if c > "\x7f"]
        mixed = MIXED_CASE.search(word)
        for chain, gains in self.gain:
            if chain.reads.issuperset(odd):
                if sum([gains.get(c, 0.0) for c in odd]) > 0.7:
                    out[chain.name] = word.translate(chain.table)
                elif mixed and not MIXED_CASE.search(r := word.translate(chain.table)):
                    out[chain.name] = r
        return out

    def _likely(self, word: str, found: dict[str, str]) -> dict[str, str]:
        likely = {r for r in set(found.values()) if self.plausible(word, r)}
        return {c: r for c, r in found.items() if r in likely}

    def makes_signs(self, chain: str, word: str) -> bool:
        """Whether a one-byte chain turns the controls of a word, and it has some, into signs."""
        controls = set(CONTROL.findall(word))
        return bool(controls) and controls <= self.signs.get(chain, set())

    def lone(self, word: str) -> dict[str, tuple[float, str]]:
        """chain -> (log-likelihood ratio, original) of a word of one character, {} for others.

        It says nothing of an encoding, but is undone where the words beside it have made the chain sure."""
        if word.isascii() or len(core(word)) > 1:
            return {}
        odd = [c for c in word if c > "\x7f"]
        found = {chain.name: r for chain, _ in self.gain if chain.reads.issuperset(odd) and (r := word.translate(chain.table)) != word}
        clean = self.log_p(word, 1.0) if found else 0.0
        return {c: (self.log_p(r, 0.0) - clean, r) for c, r in found.items()}

    def evidence(self, word: str, own: float = 1.0, found: dict[str, str] | None = None) -> dict[str, tuple[float, str]]:
        """chain -> (log-likelihood ratio against 'clean', original). Damage has the chain LOST.

        ``found``: the word's candidates, if they have been worked out before."""
        if found is None:
            found = self.candidates(word)
        clean = self.log_p(word, own) if found else 0.0
        scored = {r: self.log_p(r, 0.0) - clean for r in set(found.values())}
        out = {c: (scored[r], r) for c, r in found.items()}
        if CONTROL.search(word) and not any(c.startswith("utf-8") for c in found):
            out = {c: (x + SIGN * self.makes_signs(c, word), r) for c, (x, r) in out.items()}
        if "�" in word or CONTROL.search(word):
            best = max((x[0] for x in out.values()), default=-1.0)
            out[LOST] = (25.0 if "�" in word else 8.0 if best <= 0 else 0.0, word)
        return out

    def tested(self, word: str) -> dict[str, tuple[float, str]]:
        """The evidence of a word of a text; {} where there is nothing to test."""
        return {} if word.isascii() or not self.suspicious.search(word) else self.evidence(word)

    def weight(self, source: int, chain: str) -> float:
        return self.weights.of(source, chain) if self.weights else PRIOR

    def posterior(self, weight: float, ratios: list[float]) -> float:
        """Log odds that a chain of this weight has damaged a record, from the ratios of all words that it would change."""
        shares = []
        for share in SHARES:
            low = math.log1p(-share)
            shares.append(sum(x + math.log(share) if x > 30 else math.log1p(share * math.expm1(x)) if x > -30 else low for x in ratios))
        top = max(shares)
        prior = min(0.5, weight * RECORD_WORDS)
        return math.log(prior / (1 - prior)) + top + math.log(sum(math.exp(x - top) for x in shares) / len(shares))


def source_id(source: str) -> Column:
    """A number for the normalised source; NULL is a source."""
    return F.xxhash64(F.coalesce(normalised(source), F.lit("\x01")))


def dictionary(documents: DataFrame, text: str, source: str) -> DataFrame:
    """word, source, n: in how many records of a source (a number) each word beyond ASCII occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}
        for batch in batches:
            for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t and not t.isascii():
                    counts.setdefault(s, Counter()).update({w for w in words_of(t) if not w.isascii()})
            if sum(map(len, counts.values())) > 300_000:
                yield flush(counts)
        yield flush(counts)

    def flush(counts: dict) -> pa.RecordBatch:
        rows = [(w, s, n) for s, c in counts.items() for w, n in c.items()]
        counts.clear()
        columns = zip(*rows) if rows else ([], [], [])
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["word", "source", "n"])

    rows = documents.select(source, text).mapInArrow(run, "word string, source bigint, n bigint")
    return rows.groupBy("word", "source").agg(F.sum("n").alias("n"))


def _sums(rows: DataFrame, make, buckets: int = 1) -> tuple[np.ndarray, np.ndarray, dict[str, float]]:
    """Sums of what ``make`` adds to the Counts of its task, over all rows: buckets with their values, and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Counts()
        for batch in batches:
            make(batch.to_pydict(), sums)
        kinds = (pa.int64(), pa.string(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(sums.columns(buckets), kinds)], names=["i", "k", "v"])

    got = rows.mapInArrow(run, "i bigint, k string, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).toArrow()
    place = got.column("i").is_valid()
    counts, texts = got.filter(place), got.filter(pc.invert(place))
    return counts.column("i").to_numpy(), counts.column("v").to_numpy(), dict(zip(texts.column("k").to_pylist(), texts.column("v").to_pylist()))


def count_chars(words: DataFrame) -> dict[str, float]:
    def make(rows: dict, sums: Counts) -> None:
        for w, n in zip(rows["word"], rows["n"]):
            for c in w.lower():
                if c > "\x7f":
                    sums.text[c] += n

    return _sums(words, make)[2]


def to_tables(buckets: int, at: np.ndarray, values: np.ndarray, first: int = 0) -> np.ndarray:
    """Four tables of the buckets from the table number ``first`` on."""
    out = np.zeros(4 * buckets, np.float32)
    own = (at >= first * buckets) & (at < (first + 4) * buckets)
    out[at[own] - first * buckets] = values[own]
    return out.reshape(4, buckets)


def fit(documents: DataFrame, text: str = "text", source: str = "source", rounds: int = 2) -> Model:
    """The model of a corpus. ``source``: the column chain weights are pooled by."""
    spark = documents.sparkSession
    words = cut(dictionary(documents.select(source_id(source).alias("_s"), F.col(text).alias("_t")), "_t", "_s"))
    per_source = words.groupBy("source").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).toArrow()
    if per_source.num_rows > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: pool them before")
    ids, totals = per_source.column("source").to_numpy(), per_source.column("n").to_numpy().astype(np.float32)
    per_word = cut(words.groupBy("word").agg(F.sum("n").alias("n")))
    chars = count_chars(per_word)
    buckets = buckets_for(per_word.count())

    def passed(model: Model, rows: DataFrame, make) -> tuple:
        """Sums of make(model, rows, sums) with the model broadcast for this pass only."""
        box = spark.sparkContext.broadcast(model)
        out = _sums(rows, lambda r, sums: make(box.value, r, sums), buckets)
        box.destroy()
        return out

    def split(m: Model, rows: dict, sums: Counts) -> None:
        for w, n in zip(rows["word"], rows["n"]):
            if m.suspicious.search(w):
                sums.held[core(w)] += n
            else:
                sums.add(w, n)

    def start(m: Model, rows: dict, sums: Counts) -> None:
        # a suspicious word is clean to begin with if no original is more frequent and none is multi-byte
        for w, n, names, originals in zip(*(rows[c] for c in ("word", "n", "chains", "originals"))):
            likely = max((m.count(core(r)) for r in set(originals)), default=0.0)
            multi = any(c.startswith("utf-8") and not c.endswith("-") for c in names)
            if "�" not in w and not multi and likely < n:
                sums.add(w, n)

    def expect(m: Model, rows: dict, sums: Counts) -> None:
        for w, places, names, originals in zip(*(rows[c] for c in ("word", "places", "chains", "originals"))):
            found = m.evidence(w, found=dict(zip(names, originals)))
            if not found:
                sums.add(w, sum(p["n"] for p in places))
                continue
            clean_n, fixed = 0.0, Counter()
            for p in places:
                own, k = p["source"], p["n"]
                scores = {c: math.log(m.weight(own, c)) + e for c, (e, _) in found.items()}
                top = max(0.0, *scores.values())
                mass = {c: math.exp(x - top) for c, x in scores.items()}
                whole = math.exp(-top) + sum(mass.values())
                clean_n += k * math.exp(-top) / whole
                for c, x in mass.items():
                    if x / whole > 1e-3:
                        sums.text[f"{c}\x00{own}"] += k * x / whole
                        fixed[c] += k * x / whole
            if clean_n > 1e-3:
                sums.add(w, clean_n)
            for c, k in fixed.items():
                if c != LOST:
                    sums.add(found[c][1], k)

    first = Model(chars, np.zeros((4, buckets), np.float32))
    at, values, _ = passed(first, per_word, split)
    base = to_tables(buckets, at, values)
    every = base.copy()
    every[:2] += to_tables(buckets, at, values, 4)[:2]
    everything, first_pattern = Model(chars, every), first.suspicious
    box = spark.sparkContext.broadcast(everything)

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspicious = first_pattern.search
        for batch in batches:
            batch = batch.filter(pa.array([suspicious(w) is not None for w in batch.column(0).to_pylist()], pa.bool_()))
            found = [box.value.candidates(w) for w in batch.column(0).to_pylist()]
            texts = pa.list_(pa.string())
            more = [pa.array([list(x) for x in found], texts), pa.array([list(x.values()) for x in found], texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "chains", "originals"])

    # the candidates of a suspicious word don't change from round to round
    suspects = cut(per_word.mapInArrow(propose, "word string, n bigint, chains array<string>, originals array<string>"))
    box.destroy()
    # the counts of a word in its sources, in as many rows as there are thousands of sources
    row = F.pmod("source", F.lit(len(ids) // SOURCES_A_ROW + 1))
    places = words.join(suspects.select("word"), "word").groupBy("word", row.alias("_row")).agg(F.collect_list(F.struct("source", "n")).alias("places"))
    spread = cut(places.join(suspects.drop("n"), "word").select("word", "places", "chains", "originals"))
    at, values, _ = passed(everything, suspects, start)
    model = Model(chars, base + to_tables(buckets, at, values))
    all_n = float(totals.sum()) + 1.0
    for _ in range(rounds):
        at, values, masses = passed(model, spread, expect)
        overall: Counter = Counter()
        own: dict[tuple[int, str], float] = {}
        for key, v in masses.items():
            c, _, s = key.partition("\x00")
            overall[c] += v
            own[int(s), c] = v
        # a chain that explains no word of the corpus keeps no weight
        kept = {c: v / all_n for c, v in overall.items() if v > 0.5 or c == LOST}
        model = Model(chars, base + to_tables(buckets, at, values), Weights(kept, ids, totals, own))
    return model


def repair(documents: DataFrame, model: Model, item: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``item``, status ('clean', 'restored', 'partly', 'lost'), chain, words, restored text.

    One pass, no shuffle. 'partly': something is lost besides what was restored."""
    box = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(item, source_id(source).alias("_s"), F.col(text).alias("_t"))
    kind = rows.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = box.value
        tested: dict[str, dict] = {}  # all evidence of the words met, and what of it speaks for a chain
        positive: dict[str, dict] = {}
        weigh: dict[tuple, float] = {}
        lone = functools.lru_cache(10_000)(m.lone)
        for batch in batches:
            out: list[tuple] = []
            for s, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not t or t.isascii():
                    out.append(("clean", None, 0, t))
                    continue
                words = {w for w in words_of(t) if not w.isascii()}
                found: dict[str, dict] = {}
                for w in words:
                    e = positive.get(w)
                    if e is None:
                        if len(positive) > 300_000:
                            positive.clear()
                            tested.clear()
                        every = m.tested(w)
                        e = positive[w] = {c: x for c, x in every.items() if x[0] > 0}
                        if every:
                            tested[w] = every
                    if e:
                        found[w] = e
                bound: Counter = Counter()
                for e in found.values():
                    for c, (x, _) in e.items():
                        bound[c] += x
                sure: dict[str, float] = {}
                for c, x in bound.items():
                    if (s, c) not in weigh:
                        weigh[s, c] = m.weight(s, c)
                    if math.log(weigh[s, c] * 2 * RECORD_WORDS) + x > 0:  # what speaks against the chain can only lower this
                        ratios = [tested[w][c][0] for w in words if c in tested.get(w, ())]
                        odds = m.posterior(weigh[s, c], ratios)
                        if odds > 0:
                            sure[c] = odds
                if not sure:
                    out.append(("clean", None, 0, t))
                    continue
                changed, used = {}, Counter()
                for w, e in found.items():
                    ways = {c: x for c, x in e.items() if c in sure and c != LOST}
                    if ways:
                        c, (_, changed[w]) = max(ways.items(), key=lambda x: (sure[x[0]], x[0]))
                        used[c] += 1
                if used:
                    for w in words - changed.keys():
                        # the more words a chain has changed, the likelier it has hit this one
                        ways = {c: r for c, (x, r) in lone(w).items() if used[c] and x + math.log(used[c]) > 0}
                        if ways:
                            changed[w] = max(ways.items(), key=lambda x: (sure[x[0]], x[0]))[1]
                fixed = re.sub(f"[^{SPACES}]+", lambda x: changed.get(x[0], x[0]), t) if changed else t
                status = ("partly" if LOST in sure else "restored") if changed else LOST
                out.append((status, max(sure, key=lambda c: (sure[c], c)), len(changed), fixed))
            columns = list(zip(*out)) if out else [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                names=[item, "status", "chain", "words", text],
            )

    return rows.mapInArrow(run, f"`{item}` {kind}, status string, chain string, words int, `{text}` string")
