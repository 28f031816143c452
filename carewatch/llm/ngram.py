"""Operator 8: n-gram language model in Elias-Fano tries.

Counts come from all training documents; the model is of order three with absolute
discounting, interpolated down to the unigrams, which have 0.1 added to every count. Every
word, pair and triple of the training documents is in the model, whatever the corpus (floors as
a share of all tokens are parameters, 0 by default; the mass of what they leave out goes to the
back-offs, so probabilities still add up to one).

The model is dealt over tries of about `TRIE` tokens each, by the middle word of a triple:
the triple's context (first, second) and the pair it backs off to (second, third) meet there.
A middle word with more than one trie's share of all tokens is divided by the first word, and
its pairs go to each of its tries. Training pieces send their distinct triples with counts to
the tries, documents send theirs with the documents that hold them (at once, if the same rows are
learnt from and scored). A task gets its tries' rows in the order of the tries, builds one at a
time, packs it into a memory map, answers from the map, and returns one sum a document.

Words are 62-bit digests from the start (of 10^9 different words, about 0.1 pairs share one and
count as one word). Only the `HELD` most frequent ones have small ids; a worker knows them as one
sorted array, in which the different words of a piece are searched together, and has their
counts from the same broadcast. The counts of the others are joined to the answers.

Each level of a trie is one monotone sequence in Elias-Fano form: entry = context * width +
symbol, with the low bits packed and the high bits in unary. A query is a successor search: one
select on the high bits finds the few entries with the same high part, a bisection over their
low bits finds the entry. At the third level a symbol is the rank of the word among the
followers of the context's last word, which the second level's monotone pointers give. Log10
probabilities and back-offs are quantised to 16 bits.

Defined cases: a null text is empty and has one token, its end; rows with a null doc_id are
held out; equal rows get equal rows of results; without training documents every token is
unknown and log10(0.1 / 0.1) = 0 is its probability; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import json
import math
import mmap
import pickle
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, shuffle_width

ADD = 0.1
DISCOUNT = 0.75
VOCABULARY_SHARE = NGRAM_SHARE = 0.0
HELD = 500_000
HOLD_OUT = 10
END = b"\n"  # no word holds a line feed
FLUSH = 400_000
#: Tokens of the documents that are dealt out together, and distinct triples answered together.
PIECE, ANSWERED = 2_000_000, 200_000
#: Tokens of a trie, bytes of sums that a task gathers, and bytes of triples sent at once.
TRIE, SUMS, SENT = 600_000, 16 << 20, 2 << 20
#: Codes of words: ids of the held ones, RARE + digest of the others; NONE is no word.
NONE, RARE = -1, 1 << 62


def held_out(id_col):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HOLD_OUT == 0, F.lit(True))


def tokens(text: str | None) -> list[bytes]:
    words = text.encode("utf-8").lower().split() if text else []
    words.append(END)
    return words


# ---------------------------------------------------------------- Elias-Fano


class EliasFano:
    """A monotone sequence of n numbers below `universe`."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        #: zeros before each 64-bit word of the high part
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (universe // max(1, n)).bit_length() - 1)
        v = values.astype(np.uint64)
        low = np.zeros((n * bits + 63) // 64 + 2, np.uint64)
        if bits and n:
            part = v & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        length = n + (universe >> bits) + 2
        high = np.zeros(length // 64 + 2, np.uint64)
        at = (v >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        np.bitwise_or.at(high, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))[:-1]
        return cls(n, bits, low, high, ones)

    @staticmethod
    def _select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit (from 0) of each 64-bit word."""
        place = np.zeros(len(word), np.uint64)
        k = k.astype(np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            part = (word >> place) & np.uint64((1 << half) - 1)
            below = np.bitwise_count(part).astype(np.int64)
            right = k >= below
            k = np.where(right, k - below, k)
            place += np.where(right, np.uint64(half), np.uint64(0))
        return place.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | left) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places `i`."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = self._select(self.high[word], i - self.ones[word]) + word * 64
        return ((place - i) << self.low_bits) | self._low(i).astype(np.int64)

    def _first(self, high: np.ndarray) -> np.ndarray:
        """Number of entries whose high part is below `high`."""
        k = np.maximum(high - 1, 0)
        word = np.searchsorted(self.zeros, k, "right") - 1
        place = self._select(~self.high[word], k - self.zeros[word]) + word * 64
        return np.where(high > 0, place + 1 - high, 0)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first entry >= x (n if none); x must be below the universe."""
        high = x >> self.low_bits
        want = (x & ((1 << self.low_bits) - 1)).astype(np.uint64)
        low, stop = self._first(high), self._first(high + 1)
        top = stop.copy()
        while (open_ := np.flatnonzero(low < top)).size:
            mid = (low[open_] + top[open_]) >> 1
            less = self._low(mid) < want[open_]
            low[open_] = np.where(less, mid + 1, low[open_])
            top[open_] = np.where(less, top[open_], mid)
        return low

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each x, or -1."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        at = self.successor(x)
        ok = at < self.n
        ok[ok] = self.access(at[ok]) == x[ok]
        return np.where(ok, at, -1)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit codes and (smallest value, step)."""
    low = float(values.min()) if len(values) else 0.0
    step = ((float(values.max()) - low) / 65535 if len(values) else 0.0) or 1.0
    return np.round((values - low) / step).astype(np.uint16), np.array([low, step])


class Trie:
    """The model's arrays by name; `pack` and `open` turn it into bytes and back."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays
        self.v = int(arrays["sizes"][0])
        self.total, self.types = int(arrays["sizes"][1]), int(arrays["sizes"][2])
        self.two, self.three, self.starts = (EliasFano(
            int(arrays[f"{k}.n"][0]), int(arrays[f"{k}.n"][1]), arrays[f"{k}.low"], arrays[f"{k}.high"],
            arrays[f"{k}.ones"]) for k in ("two", "three", "starts"))

    @staticmethod
    def arrays_of(name: str, ef: EliasFano) -> dict[str, np.ndarray]:
        return {f"{name}.n": np.array([ef.n, ef.low_bits]), f"{name}.low": ef.low, f"{name}.high": ef.high,
                f"{name}.ones": ef.ones}

    def pack(self) -> bytes:
        head, parts, at = {}, [], 0
        for k, x in self.a.items():
            data = np.ascontiguousarray(x).tobytes()
            head[k] = (x.dtype.str, at, len(x))
            data += b"\0" * (-len(data) % 8)
            parts.append(data)
            at += len(data)
        top = json.dumps(head).encode()
        top += b" " * (-len(top) % 8)
        return len(top).to_bytes(8, "little") + top + b"".join(parts)

    @classmethod
    def open(cls, data: bytes) -> Trie:
        """The packed trie in a memory map of its own (of no file: nothing is left on an executor),
        which goes with the trie."""
        held = mmap.mmap(-1, len(data))
        held.write(data)
        n = int.from_bytes(held[:8], "little")
        return cls({k: np.frombuffer(held, np.dtype(t), count, 8 + n + at)
                    for k, (t, at, count) in json.loads(held[8:8 + n]).items()})

    def value(self, name: str, i: np.ndarray) -> np.ndarray:
        low, step = self.a[f"{name}.scale"]
        return low + step * self.a[name][i]

    def pairs(self, ids: np.ndarray) -> np.ndarray:
        """For each position the place of (word before, word) at level two, or -1. A document
        ends with the end token, which no context holds; -1 marks unknown words."""
        out = np.full(len(ids), -1, np.int64)
        a, b = ids[:-1], ids[1:]
        ok = np.flatnonzero((a > 0) & (b >= 0))
        out[ok + 1] = self.two.find(a[ok] * self.v + b[ok])
        return out

    def triples(self, ids: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose two words before are listed, and key of the third word relative to
        the followers of the second (-1: not among them)."""
        at = np.flatnonzero(pair[:-1] >= 0) + 1
        at = at[ids[at - 1] > 0]
        now = pair[at]
        key = np.full(len(at), -1, np.int64)
        ok = now >= 0
        key[ok] = pair[at[ok] - 1] * self.v + now[ok] - self.starts.access(ids[at[ok] - 1])
        return at, key

    def score(self, ids: np.ndarray) -> np.ndarray:
        """log10 probability of each token; for unknown words (-1) only their back-offs."""
        known = ids >= 0
        one = np.where(known, self.a["one"][np.maximum(ids, 0)], 0.0)
        out = one.copy()
        pair = self.pairs(ids)
        before = np.concatenate(([-1], ids[:-1]))
        ctx = before > 0
        out[ctx] += self.a["back"][before[ctx]]
        listed = pair >= 0
        out[listed] = self.value("two.p", pair[listed])
        at, key = self.triples(ids, pair)
        hit = np.full(len(at), -1, np.int64)
        ok = key >= 0
        hit[ok] = self.three.find(key[ok])
        miss = hit < 0
        out[at[miss]] += self.value("two.back", pair[at[miss] - 1])
        out[at[~miss]] = self.value("three.p", hit[~miss])
        return out

    def look_up(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of what the entries list for w after u v (-inf: nothing), and log10 of the
        back-off to the unigram of w. Below 0: a word that the trie does not know."""
        def found(ef, ok, key):
            out = np.full(len(w), -1, np.int64)
            key, which = np.unique(key, return_inverse=True)  # searched in order
            out[ok] = ef.find(key)[which]
            return out

        ok = np.flatnonzero((v > 0) & (w >= 0))
        vw = found(self.two, ok, v[ok] * self.v + w[ok])
        ok = np.flatnonzero((u > 0) & (v > 0))
        uv = found(self.two, ok, u[ok] * self.v + v[ok])
        ok = np.flatnonzero((uv >= 0) & (vw >= 0))
        own, which = np.unique(v[ok], return_inverse=True)
        hit = found(self.three, ok, uv[ok] * self.v + vw[ok] - self.starts.access(own)[which])
        back, listed = np.zeros(len(w)), np.full(len(w), -np.inf)
        ok = uv >= 0
        back[ok] = self.value("two.back", uv[ok])
        ok = vw >= 0
        listed[ok] = self.value("two.p", vw[ok]) + back[ok]
        ok = hit >= 0
        listed[ok] = self.value("three.p", hit[ok])
        return listed, back + np.where(v >= 0, self.a["back"][np.maximum(v, 0)], 0.0)


# ---------------------------------------------------------------- training


def digests(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64) >> np.uint64(2)


def unigrams(rows: DataFrame) -> DataFrame:
    """(digest, c) of the words of `rows` (text), the end of each text included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(digests(held).astype(np.int64)), pa.array(list(held.values()), pa.int64())], names=["digest", "c"])
            held.clear()
            return out

        for rb in batches:
            for text in rb.column(0).to_pylist():
                held.update(tokens(text))
                if len(held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return rows.mapInArrow(count, "digest long, c long").groupBy("digest").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Ids and counts of the held words: 0 is the end, then words by falling count."""

    def __init__(self, digest: np.ndarray, counts: np.ndarray):
        self.counts, self.ids = counts, np.argsort(digest).astype(np.int32)
        self.digest = digest[self.ids]

    def codes(self, digest: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.digest, digest), len(self.digest) - 1)
        return np.where(self.digest[at] == digest, self.ids[at], RARE + digest)


class _Places(dict):
    """Words in the order in which a piece first has them."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


_state: dict[int, Vocabulary] = {}


def _opened(shared) -> Vocabulary:
    """The held words from a broadcast, opened once a worker."""
    if shared.id not in _state:
        _state.clear()
        _state[shared.id] = Vocabulary(*shared.value)
    return _state[shared.id]


class _Shared:
    """A broadcast with a name of its own, so that workers know it again."""

    def __init__(self, spark, value):
        self.handle = spark.sparkContext.broadcast(value)
        self.id = self.handle._jbroadcast.id()

    def __getstate__(self):
        return {"handle": self.handle, "id": self.id}

    @property
    def value(self):
        return self.handle.value


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Evenly spread numbers from codes."""
    x = codes.astype(np.uint64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(2)).astype(np.int64)


class Deal:
    """Which of the `n` tries holds what: the triples of a middle word are in one, those of a
    word with more than 1 / n of all tokens in several, by the first word."""

    def __init__(self, n: int, counts: np.ndarray, total: int):
        self.n = n
        self.parts = np.clip(np.ceil(counts * (n / max(1, total))), 1, n).astype(np.int64)

    def divided(self, v: np.ndarray) -> np.ndarray:
        """Number of tries over which middle words are divided."""
        return np.where(v < RARE, self.parts[np.where((v >= 0) & (v < RARE), v, 0)], 1)

    def place(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return (_mixed(v) % self.n + _mixed(u) % self.divided(v)) % self.n


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary):
    """(doc_ids, whether learnt from, sorted different codes, each token's place in them, end of
    each document) for pieces of the rows (doc_id, text, learn)."""
    ids, learn, flat, ends, places = [], [], array("i"), [], _Places()

    def piece():
        codes, at = np.unique(vocabulary.codes(digests(places).astype(np.int64)), return_inverse=True)
        out = ids[:], np.array(learn), codes, at.astype(np.int32)[np.frombuffer(flat, np.int32)], np.array(ends)
        places.clear()
        return out

    for rb in batches:
        for doc_id, text, own in zip(*[rb.column(k).to_pylist() for k in range(3)], strict=True):
            flat.extend(map(places.__getitem__, tokens(text)))
            ids.append(doc_id)
            learn.append(own)
            ends.append(len(flat))
            if len(flat) >= PIECE:
                yield piece()
                ids, learn, flat, ends = [], [], array("i"), []
    if ids:
        yield piece()


def _before(words: np.ndarray, w: np.ndarray, ends: np.ndarray, whole: bool):
    """Places of the two words before each token (NONE: none, or one outside the model)."""
    begins = np.concatenate(([0], ends[:-1]))
    none = np.array([NONE], np.int32)
    v = np.concatenate((none, w[:-1]))
    v[begins] = NONE
    u = np.concatenate((none, v[:-1]))
    u[begins] = NONE
    if not whole:
        for x in (u, v):
            x[(x >= 0) & (words[x] >= RARE)] = NONE
    return u, v


def _keys(u: np.ndarray, v: np.ndarray, w: np.ndarray, size: int) -> np.ndarray:
    """One number for each different triple of numbers from -1 to size - 1."""
    pair = (v.astype(np.int64) + 1) * (size + 1) + u + 1
    if size >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    return pair * size + w


def _code(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at >= 0, words[np.maximum(at, 0)], NONE)


def _packed(words: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, *more: np.ndarray) -> bytes:
    """Triples with a word list of their own, small ids and numbers in few bytes."""
    own, at = np.unique(np.concatenate((u, v, w)), return_inverse=True)
    codes = _code(words, own)
    held = int(np.searchsorted(codes, RARE))

    def few(x):
        return x.astype(np.min_scalar_type(int(x.max(initial=0))))
    data = pickle.dumps((few(codes[:held] + 1), codes[held:], *few(at).reshape(3, -1), *map(few, more)), 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> tuple:
    """(codes, u, v, w, ...) as `_packed` got them, triples as places in the codes."""
    held, rare, *rest = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"))
    return np.concatenate((held.astype(np.int64) - 1, rare)), *[x.astype(np.int64) for x in rest]


def _by_place(place: np.ndarray):
    """(place, its rows) in order."""
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(place[rows[0]]), rows


DEALT = "place int, kind int, batch long, data binary"
HEAD, TRIPLES = 0, 1


class Model:
    """Codes and counts of the held words for the workers; as Spark tables `docs`, whose rows
    (doc_id, text, learn) are learnt from where `learn` says so, and the counts of the rare words
    (digest, c)."""

    def __init__(self, docs: DataFrame, source: tuple, digest: np.ndarray, counts: np.ndarray, total: int, types: int,
                 rare: DataFrame, whole: bool, least: float):
        self.docs, self.source, self.rare, self.counts = docs, source, rare, counts
        self.total, self.types, self.whole, self.least = total, types, whole, least
        self.shared = _Shared(docs.sparkSession, (digest, counts))


def _pairs_of_divided(deal: Deal, words: np.ndarray, v: np.ndarray, w: np.ndarray, c: np.ndarray) -> list[tuple]:
    """(place, blob) with the pairs of divided words, as triples without a first word, for all
    tries of each."""
    pair, which = np.unique(v * len(words) + w, return_inverse=True)
    v, w = pair // len(words), pair % len(words)
    c = np.bincount(which, c, len(pair)).astype(np.int64)
    times = deal.divided(words[v])
    copy = np.repeat(np.arange(len(pair)), times)
    part = np.arange(len(copy)) - np.repeat(np.cumsum(times) - times, times)
    v, w, c, none = v[copy], w[copy], c[copy], np.zeros(0, np.int64)
    place = (_mixed(words[v]) % deal.n + part) % deal.n
    return [(p, _packed(words, np.full(len(i), NONE), v[i], w[i], c[i], 0 * i, none, none)) for p, i in _by_place(place)]


def _dealt(rows: DataFrame, model: Model, n: int, asked: bool) -> DataFrame:
    """The distinct triples of each piece of `rows` (doc_id, text, learn), dealt to their n tries:
    how often documents that are learnt from hold them and, if `asked`, the documents that hold
    them and how often; then also a head for each piece, with what needs no trie."""
    shared, whole, total, types = model.shared, model.whole, model.total, model.types

    def sent_on(rows) -> Iterator[pa.RecordBatch]:
        """Rows as batches of a few megabytes, the first ones gone before the last are made."""
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[3])
            if size >= SENT:
                yield table_of(held)
                held, size = [], 0
        if held:
            yield table_of(held)

    def table_of(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
            names=["place", "kind", "batch", "data"])

    def made(batch, counts, deal, unit, ids, learn, words, w, ends):
        u, v = _before(words, w, ends, whole)
        size = np.diff(ends, prepend=0)
        begins, doc = ends - size, np.repeat(np.arange(len(ends), dtype=np.int32), size)
        held = words < RARE  # of each different word
        if asked:
            at = np.where(held, words, 0)
            one = np.where(held, unit[at], 0.0)[w]
            yield (batch % n, HEAD, batch, pickle.dumps((
                ids, size, np.add.reduceat((held & (counts[at] > 0))[w], begins, dtype=np.int64),
                np.add.reduceat(one, begins), np.add.reduceat(np.where(v < 0, one, 0.0), begins)), 5))
            del one
        sent = np.flatnonzero((v >= 0) | (asked & ~held[w]))
        u, v, w, doc = u[sent], v[sent], w[sent], doc[sent]
        key = _keys(u, v, w, len(words))
        order = np.argsort(key, kind="stable").astype(np.int32)  # documents stay in order
        key, doc = key[order], doc[order]
        fresh = np.diff(key, prepend=-1) != 0
        del sent, key
        cell = np.flatnonzero(fresh | (np.diff(doc, prepend=-1) != 0))  # a triple in a document
        times, doc = np.diff(cell, append=len(doc)), doc[cell]
        first = np.flatnonzero(fresh[cell])
        docs_of = np.diff(first, append=len(cell))
        u, v, w = (x[order[cell[first]]].astype(np.int64) for x in (u, v, w))
        c = np.add.reduceat(times * learn[doc], first) if len(first) else first
        del order, fresh, cell
        c[v < 0] = 0
        place = deal.place(_code(words, u), _code(words, np.where(v >= 0, v, w)))
        many = np.flatnonzero((deal.divided(_code(words, v)) > 1) & (c > 0))
        for p, data in _pairs_of_divided(deal, words, v[many], w[many], c[many]):
            yield p, TRIPLES, -1, data
        c[many[u[many] < 0]] = 0
        for p, i in _by_place(place):
            if asked:
                k = docs_of[i]
                cells = np.repeat(first[i] - np.cumsum(k) + k, k) + np.arange(k.sum())
            else:
                i = i[c[i] > 0]
                k, cells = 0 * i, i[:0]
            yield p, TRIPLES, batch, _packed(words, u[i], v[i], w[i], c[i], k, doc[cells], times[cells])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _opened(shared)
        counts = vocabulary.counts
        deal = Deal(n, counts, total)
        unit = np.log10((counts + ADD) / (total + ADD * (types + 1)))
        batch = TaskContext.get().partitionId() << 40  # the same when a task runs again
        for piece in _pieces(batches, vocabulary):
            yield from sent_on(made(batch, counts, deal, unit, *piece))
            del piece
            batch += 1

    return rows.mapInArrow(run, DEALT)


def _built(blobs: list[bytes], counts: np.ndarray, deal: Deal, total: int, types: int, whole: bool,
           least: float) -> tuple[np.ndarray, Trie]:
    """Codes of the words and the trie of one place. Entries of rare words leave out their
    unigram, whose count is not known here."""
    parts = []
    for blob in blobs:
        own, *triple = _unpacked(blob)[:5]
        learnt = triple[3] > 0
        parts.append((own, *[x[learnt].astype(np.int32) for x in triple]))
    codes, at = np.unique(np.concatenate([[0], *[p[0] for p in parts]]).astype(np.int64), return_inverse=True)
    if codes[0] == NONE:
        codes, at = codes[1:], at - 1
    size, at = len(codes), at.astype(np.int32)
    shift = np.cumsum([1, *[len(p[0]) for p in parts]])
    u, v, w = (np.concatenate([np.zeros(0, np.int32), *[at[s + p[k]] for s, p in zip(shift[:-1], parts, strict=True)]])
               for k in (1, 2, 3))
    c = np.concatenate([np.zeros(0, np.int32), *[p[4] for p in parts]])
    del parts, at

    def summed(key, c):
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        return key[first], np.add.reduceat(c[order], first, dtype=np.int64) if len(key) else np.zeros(0, np.int64)

    def pair(a, b):
        return a * np.int64(size) + b

    own = (u < 0) | (deal.divided(codes[v]) == 1)  # a divided word's pairs come on their own
    k2, c2 = summed(pair(v[own], w[own]), c[own])
    ctx = u >= 0
    u, v, w, c = (x[ctx] for x in (u, v, w, c))
    contexts, context_c = summed(pair(u, v), c)
    k2, first = np.unique(np.concatenate((k2, contexts)), return_index=True)
    c2 = np.concatenate((c2, context_c))[first]  # the same count, if a pair is both
    known = codes < RARE
    count = np.where(known, counts[np.where(known, codes, 0)], np.bincount(k2 // size, c2, size).astype(np.int64))
    count = np.maximum(1, count)
    listed = (c2 >= least) & (whole | known[k2 % size])
    k2, c2 = k2[listed], c2[listed]
    starts = np.searchsorted(k2, np.arange(size + 1) * size)
    if len(k2):
        place, symbol = (np.minimum(np.searchsorted(k2, pair(*x)), len(k2) - 1) for x in ((u, v), (v, w)))
        ok = (k2[place] == pair(u, v)) & (k2[symbol] == pair(v, w))
    else:
        place, symbol, ok = u, w, np.zeros(len(u), bool)
    k3, c3 = summed(pair(place[ok], symbol[ok] - starts[v[ok]]), c[ok])
    listed = c3 >= least
    p1 = np.where(known, (count + ADD) / (total + ADD * (types + 1)), 0.0)
    return codes, _trie(count, total, types, (k2, c2), (k3[listed], c3[listed]), p1)


def _trie(counts: np.ndarray, total: int, types: int, pairs=None, triples=None, p1=None) -> Trie:
    """The trie from counts by id, and from (keys, counts) of pairs and triples."""
    v = len(counts)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    (k2, c2), (k3, c3) = pairs or none, triples or none
    if p1 is None:
        p1 = (counts + ADD) / (total + ADD * (types + 1)) if total else np.ones(v)
    starts = np.searchsorted(k2, np.arange(v + 1) * v)
    a, b = k2 // v, k2 % v
    taken = (c2 - DISCOUNT) / counts[a] if len(k2) else np.zeros(0)
    back1 = np.clip(1 - np.bincount(a, taken, v), 1e-12, 1) if len(k2) else np.ones(v)
    p2 = taken + back1[a] * p1[b]
    ctx = k3 // v
    last = starts[b[ctx]] + k3 % v  # place of (second, third) at level two
    taken3 = (c3 - DISCOUNT) / c2[ctx] if len(k3) else np.zeros(0)
    back2 = np.clip(1 - np.bincount(ctx, taken3, len(k2)), 1e-12, 1) if len(k3) else np.ones(len(k2))
    p3 = taken3 + back2[ctx] * p2[last] if len(k3) else np.zeros(0)
    out = {"sizes": np.array([v, total, types]), "count": counts.astype(np.int64), "one": np.log10(np.maximum(p1, 1e-300)),
           "back": np.log10(back1)}
    for name, x in (("two.p", p2), ("two.back", back2), ("three.p", p3)):
        out[name], out[f"{name}.scale"] = quantise(np.log10(x))
    out |= Trie.arrays_of("two", EliasFano.build(k2, v * v))
    out |= Trie.arrays_of("three", EliasFano.build(k3, max(1, len(k2)) * v))
    out |= Trie.arrays_of("starts", EliasFano.build(starts, len(k2) + 1))
    return Trie(out)


def train(docs: DataFrame, *, id_col="doc_id", text_col="text", vocabulary_share=VOCABULARY_SHARE,
          ngram_share=NGRAM_SHARE, held=HELD) -> Model:
    """The model of the training rows of `docs`. With a `vocabulary_share`, words below it are in
    no pair or triple; with an `ngram_share`, pairs and triples below it are not listed."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       (~held_out(id_col)).alias("learn"))
    words = checkpointed(unigrams(rows.filter("learn").select("text")))
    # at most sqrt(2 total) different counts
    levels = sorted(((r[0], r[1]) for r in words.groupBy("c").agg(F.count("*")).collect()), reverse=True)
    total, types = sum(c * k for c, k in levels), sum(k for _, k in levels)
    least, above = 1 + max((c for c, _ in levels), default=0), 0
    for c, k in levels:
        if (above := above + k) > held:
            break
        least = c
    if vocabulary_share:
        least = vocabulary_share * total
    end = int(digests([END])[0])
    t = words.filter((F.col("c") >= least) & (F.col("digest") != end)).toArrow()  # at most `held` rows
    digest, count = (t.column(k).to_numpy() for k in (0, 1))
    order = np.lexsort((digest, -count))
    ends = words.filter(F.col("digest") == end).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    rare = words.filter((F.col("c") < least) & (F.col("digest") != end))
    return Model(rows, (docs, id_col, text_col), np.concatenate(([end], digest[order])).astype(np.int64),
                 np.concatenate(([ends], count[order])).astype(np.int64), total, types, rare, not vocabulary_share,
                 max(1, ngram_share * total))


# ---------------------------------------------------------------- scoring

ANSWERS = "batch long, word long, doc int, times long, listed double, back double, data binary"
SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _answered(dealt: DataFrame, model: Model, n: int) -> DataFrame:
    """For each piece and task the documents' sums; a row for each triple of a document whose
    last word is rare; the heads."""
    shared, whole, total, types, least = model.shared, model.whole, model.total, model.types, model.least

    def batch_of(blobs: list[tuple], rare: list[np.ndarray]) -> pa.RecordBatch:
        """`blobs`: (batch, data); `rare`: columns batch, word, doc, times, listed, back."""
        m = len(blobs)
        columns = [np.concatenate(x) for x in zip(*rare, strict=True)] if rare else [np.zeros(0)] * 6
        k = len(columns[0])
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
        arrays = [pa.concat_arrays([pa.array([b[0] for b in blobs], t) if j == 0 else pa.nulls(m, t),
                                    pa.array(c.astype(t.to_pandas_dtype()))])
                  for j, (c, t) in enumerate(zip(columns, types, strict=True))]
        arrays.append(pa.concat_arrays([pa.array([b[1] for b in blobs], pa.binary()), pa.nulls(k, pa.binary())]))
        return pa.RecordBatch.from_arrays(arrays, names=["batch", "word", "doc", "times", "listed", "back", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        _state.clear()  # here the counts are enough
        counts = shared.value[1]
        deal = Deal(n, counts, total)
        unit = np.log10((counts + ADD) / (total + ADD * (types + 1)))

        def answered(blobs: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Build one trie, and answer what the documents ask it."""
            words, trie = _built([data for _, data in blobs], counts, deal, total, types, whole, least)
            trie = Trie.open(trie.pack())
            while blobs:
                group, size = [], 0
                while blobs and size < ANSWERED:
                    batch, data = blobs.pop()
                    part = _unpacked(data)
                    if len(part[6]):
                        group.append((batch, part))
                        size += len(part[1])
                if not group:
                    break
                own = []
                for _, (codes, *_rest) in group:
                    at = np.minimum(np.searchsorted(words, codes), len(words) - 1)
                    own.append(np.where(words[at] == codes, at, -1))
                listed, back = trie.look_up(*[np.concatenate([x[g[1][k]] for x, g in zip(own, group, strict=True)])
                                              for k in (1, 2, 3)])
                begin, rare = 0, []
                for batch, (codes, _u, _v, w, _c, k, doc, times) in group:
                    a, b = listed[begin:begin + len(w)], back[begin:begin + len(w)]
                    begin += len(w)
                    word = codes[w]
                    small = word < RARE
                    score = np.where(np.isfinite(a), a, b + unit[np.where(small, word, 0)])
                    of = np.repeat(np.arange(len(w)), k)  # the triple of each cell
                    known = small[of]
                    got = np.bincount(doc[known], times[known] * score[of[known]])
                    old = sums.get(batch, got[:0])
                    if len(old) < len(got):
                        old, got = got, old
                    old[:len(got)] += got
                    sums[batch] = old
                    other = np.flatnonzero(~known)
                    if len(other):
                        t = of[other]
                        rare.append([np.full(len(t), batch), word[t] - RARE, doc[other], times[other], 10.0 ** a[t], 10.0 ** b[t]])
                if rare:
                    yield batch_of([], rare)
                if sum(len(x) for x in sums.values()) > SUMS // 8:
                    yield batch_of([(k, b"s" + x.tobytes()) for k, x in sums.items()], [])
                    sums.clear()

        current, blobs = None, []
        for rb in batches:  # in the order of the tries
            heads = []
            for place, kind, batch, data in zip(*[c.to_pylist() for c in rb.columns], strict=True):
                if kind == HEAD:
                    heads.append((batch, data))
                    continue
                if place != current and blobs:
                    yield from answered(blobs)
                    blobs = []
                current = place
                blobs.append((batch, data))
            if heads:
                yield batch_of(heads, [])
        if blobs:
            yield from answered(blobs)
        if sums:
            yield batch_of([(k, b"s" + x.tobytes()) for k, x in sums.items()], [])

    width = shuffle_width(dealt.sparkSession)
    return (dealt.repartitionById(width, F.pmod("place", F.lit(width)).cast("int")).sortWithinPartitions("place")
            .mapInArrow(run, ANSWERS))


def n_tries(model: Model) -> int:
    """Tries of `TRIE` tokens, at least one for each partition of a shuffle."""
    return max(shuffle_width(model.docs.sparkSession), -(-model.total // TRIE))


def score_documents(docs: DataFrame, model: Model, *, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each
    row of `docs`."""
    n, tries = shuffle_width(docs.sparkSession), n_tries(model)
    total, types = model.total, model.types
    if model.source[0] is docs and model.source[1:] == (id_col, text_col):
        dealt = _dealt(model.docs, model, tries, True)
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                           F.lit(False).alias("learn"))
        dealt = _dealt(model.docs.filter("learn"), model, tries, False).unionByName(_dealt(rows, model, tries, True))
    answers = _answered(dealt, model, tries)
    # rows without a word are spread, and match nothing
    answers = answers.withColumn("__key", F.coalesce("word", F.xxhash64("batch", "data")))
    met = answers.join(model.rare, (F.col("__key") == F.col("digest")) & F.col("word").isNotNull(), "left").select(
        "batch", "doc", "times", "listed", "back", "data", F.coalesce("c", F.lit(0)).alias("c"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[int, tuple] = {}
        sums: dict[tuple[int, str], np.ndarray] = {}

        def add(batch, name, x):
            old = sums.get((batch, name))
            if old is None or len(old) < len(x):
                old, x = x.copy(), old
            if x is not None:
                old[:len(x)] += x
            sums[batch, name] = old

        for rb in batches:
            batch, data = rb.column(0).to_numpy(), rb.column(5)
            word = rb.column(1).is_valid().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~word).tolist():
                blob = data[i].as_py()
                if blob[:1] == b"s":
                    add(int(batch[i]), "score", np.frombuffer(blob, offset=1))
                else:
                    heads[int(batch[i])] = pickle.loads(blob)
            for b in np.unique(batch[word]).tolist():
                of = np.flatnonzero(word & (batch == b))
                doc, times, listed, back, c = (rb.column(k).take(pa.array(of)).to_numpy() for k in (1, 2, 3, 4, 6))
                p1 = (c + ADD) / (total + ADD * (types + 1))
                add(b, "score", np.bincount(doc, times * np.log10(listed + back * p1)))
                add(b, "base", np.bincount(doc, times * np.log10(p1)))
                add(b, "known", np.bincount(doc, times * (c > 0)))
        for b, (ids, n_tokens, known, base, score) in heads.items():
            more = {k: np.zeros(len(ids)) for k in ("score", "base", "known")}
            for k, x in more.items():
                if (got := sums.get((b, k))) is not None:
                    x[:len(got)] = got
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_tokens), pa.array(known + np.round(more["known"]).astype(np.int64)),
                 pa.array(base + more["base"]), pa.array(score + more["score"])],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return (met.repartition(n, "batch").mapInArrow(finish, SCORES)
            .select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known",
                    F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))
