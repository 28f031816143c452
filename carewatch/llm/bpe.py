"""Operator 2: byte-level BPE encoding and decoding with a given vocabulary of ranks.

A text is cut by a pattern into pieces, and each piece is encoded by backtracking instead
of merging. An automaton (pyahocorasick over the bytes read as Latin-1) gives the longest
token at every position; the encoder takes it if it is compatible with the token before,
tries the next shorter token otherwise, and steps back where none fits. Two adjacent tokens
are compatible if merging by rank would leave the border between them standing; answers are
memoised. A position that once failed is never entered again, so the work is linear in the
piece. The result equals that of merging pairs in rank order.

Pieces repeat, so each Python worker remembers encoded pieces, `MEMO` in each of two
generations; that bounds memory and never changes a result.

Defined cases: a null text is encoded as empty (no ids, no bytes); other columns pass
through; repeated rows are encoded alike; very long pieces take linear time; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without

MEMO = 80_000
ROWS_OUT = 256
LONGEST_MEMO = 64
PLAIN_MARKS = frozenset(",.;:!?")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Fits(dict):
    """(token before, token) -> the token, or the longest shorter one that begins it, that may
    stand after the token before (-1: none). Memoised; emptied when full."""

    def __init__(self, stands, shorter: list[int]):
        super().__init__()
        self.stands, self.shorter = stands, shorter

    def __missing__(self, pair: tuple[int, int]) -> int:
        before, token = pair
        if before >= 0:
            while token >= 0 and not self.stands(before, token):
                token = self.shorter[token]
        if len(self) >= 4 * MEMO:
            self.clear()
        self[pair] = token
        return token


class Vocabulary:
    """Tables of one vocabulary: token strings (Latin-1), the pair each token is merged from,
    the next shorter token that begins each token, and the automaton."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        size = max(ranks.values()) + 1
        self.token: list[str] = [""] * size
        self.length = [0] * size
        for b, i in ranks.items():
            self.token[i] = b.decode("latin-1")
            self.length[i] = len(b)
        self.bytes = [t.encode("latin-1") for t in self.token]
        self.ids = {t: i for i, t in enumerate(self.token) if t}
        self.shorter = [-1] * size
        for t, i in self.ids.items():
            for n in range(len(t) - 1, 0, -1):
                if (j := self.ids.get(t[:n])) is not None:
                    self.shorter[i] = j
                    break
        # the pair whose merge makes a token, in rank order; a byte is made of nothing
        self.merge: dict[tuple[int, int], int] = {}
        self.parts = [(i, i) for i in range(size)]
        for i in sorted(self.ids.values()):
            t, left = self.token[i], self.shorter[i]
            while left >= 0:
                right = self.ids.get(t[self.length[left]:])
                if right is not None and left < i and right < i and self._stands(left, right):
                    self.merge[left, right] = i
                    self.parts[i] = (left, right)
                    break
                left = self.shorter[left]
        self._fits = Fits(self._stands, self.shorter)
        self.automaton = ahocorasick.Automaton()
        # a node keeps its branches in the order of insertion and scans them, so the pairs merged
        # first (the frequent ones) go in before the single bytes
        for i in sorted(self.ids.values(), key=lambda i: (self.length[i] < 2, i)):
            self.automaton.add_word(self.token[i], i)
        self.automaton.make_automaton()

    def _stands(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps the border between two tokens: undo the later of
        both merges step by step; the border falls if the pair that then meets at it would
        have been merged before the merge just undone."""
        limit = sys.maxsize
        while True:
            made = self.merge.get((left, right))
            if made is not None and made < limit:
                return False
            if left > right:
                limit = left
                left = self.parts[left][1]
                if left == limit:
                    limit = right + 1
                    right = self.parts[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = self.parts[right][0]
                if right + 1 == limit:
                    limit = left
                    left = self.parts[left][1]
                    if left == limit:
                        return True

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece given as Latin-1 text of its bytes."""
        whole = self.ids.get(piece)
        if whole is not None:
            return (whole,)
        length, shorter, fits, search = self.length, self.shorter, self._fits, self.automaton.iter_long
        out: list[int] = []
        pos, last, closed, found = 0, -1, set(), search(piece)
        while True:
            for _, token in found:  # the longest tokens from `pos` on
                fit = fits[last, token]
                if fit != token or (closed and pos + length[token] in closed):
                    break
                out.append(token)
                pos += length[token]
                last = token
            else:
                break
            while True:
                while fit >= 0 and pos + length[fit] in closed:
                    fit = fits[last, shorter[fit]]
                if fit >= 0:
                    break
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                closed.add(pos)  # no token leads on from here: step back
                dropped = out.pop()
                pos -= length[dropped]
                last = out[-1] if out else -1
                fit = fits[last, shorter[dropped]]
            out.append(fit)
            pos += length[fit]
            last = fit
            found = search(piece, pos)
        if pos != len(piece):
            raise ValueError("the vocabulary lacks a byte of the text")
        return tuple(out)


class Memo(dict):
    """Results by string, in two generations: when the younger is full it becomes the older
    and strings in use move over, so at most 2 * MEMO results are held."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def fresh(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        return self.make(piece) if ids is None else ids

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.fresh(piece)
        if len(piece) <= LONGEST_MEMO:
            self[piece] = ids
        return ids

    def trim(self) -> None:
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Encodes texts; keeps the ids of pieces seen before."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        compiled = regex.compile(pattern)
        self.findall, self.finditer = compiled.findall, compiled.finditer
        self.pieces = Memo(lambda piece: vocabulary.encode_piece(piece.encode("utf-8").decode("latin-1")))
        self.chunks = Memo(self._encode_chunk)
        # With the patterns of this family a piece holds a blank only at its start, and a
        # blank before a visible character always starts one; so a text is the sum of the
        # chunks that such blanks begin, and chunks can be remembered whole.
        self.splits = " ?" in pattern
        self.odd_blank = regex.compile(r" (?:\s|\Z)").search

    def _encode_chunk(self, chunk: str) -> tuple[int, ...]:
        # plain words, and words with one mark behind them, need no pattern
        word = chunk[1:]
        if word.isalpha() and max(word) < "\u0250" and self.splits:
            return self.pieces.fresh(chunk)
        word, mark = chunk[1:-1], chunk[-1:]
        if mark in PLAIN_MARKS and word.isalpha() and max(word) < "\u0250" and self.splits:
            return self.pieces.fresh(chunk[:-1]) + self.pieces[mark]
        found, pieces = self.findall(chunk), self.pieces
        if len(found) == 1:
            return pieces.fresh(found[0])  # remembered as a chunk
        return tuple([i for piece in found for i in pieces[piece]])

    def encode(self, text: str) -> list[int]:
        self.pieces.trim()
        self.chunks.trim()
        out: list[int] = []
        extend = out.extend
        if self.splits and not self.odd_blank(text):
            first, *rest = text.split(" ")
            for piece in self.findall(first):
                extend(self.pieces[piece])
            chunks = self.chunks
            for chunk in rest:
                extend(chunks[" " + chunk])
        else:
            pieces = self.pieces
            for piece in self.findall(text):
                extend(pieces[piece])
        return out

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def _token_bytes(rank_lines: bytes) -> dict[int, bytes]:
    return {int(b): base64.b64decode(a) for a, b in map(bytes.split, rank_lines.splitlines())}


@lru_cache(maxsize=4)
def _encoder(rank_lines: bytes, pattern: str) -> Encoder:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_lines.splitlines())}
    return Encoder(Vocabulary(ranks), pattern)


class Tokenizer:
    """One vocabulary on Spark. The rank file (under a megabyte, fixed size) is read
    by the driver and broadcast, so executors need no file of their own."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self.lines = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern

    def encoder(self):
        """A function for the workers that gives their encoder, built once a worker."""
        lines, pattern = self.lines, self.pattern
        return lambda: _encoder(lines.value, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, *, text_col="text", keep_text=True) -> DataFrame:
    """`docs` with `ids` (array<int>), and without the text if `keep_text` is false."""
    encoder = Tokenizer(docs.sparkSession, path, pattern).encoder()
    docs = without(docs, ("ids",), keep=(text_col,))
    at = docs.columns.index(text_col)
    out = [f for i, f in enumerate(docs.schema.fields) if keep_text or i != at]
    schema = T.StructType([*out, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for rb in batches:
            # small results: ids take more room than their text
            for start in range(0, rb.num_rows, ROWS_OUT):
                part = rb.slice(start, ROWS_OUT)
                flat, ends = array("i"), [0]
                before, own = None, []
                for t in part.column(at).to_pylist():
                    if t != before:  # copies often follow each other
                        before, own = t, enc.encode(t) if t else []
                    flat.extend(own)
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
                columns = [c for i, c in enumerate(part.columns) if keep_text or i != at]
                yield pa.RecordBatch.from_arrays([*columns, ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encoded` with `decoded` (the bytes of `ids`; null ids: no bytes)."""
    lines = Tokenizer(encoded.sparkSession, path, pattern).lines
    encoded = without(encoded, ("decoded",))
    at = encoded.columns.index("ids")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _token_bytes(lines.value).__getitem__
        for rb in batches:
            for start in range(0, rb.num_rows, ROWS_OUT):
                part = rb.slice(start, ROWS_OUT)
                ids = part.column(at)
                flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                done = pa.array([b"".join(map(token, flat[a:b].tolist())) for a, b in
                                 zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, done], names=schema.names)

    return encoded.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens and digests of ids and decoded bytes."""
    return (encoded.withColumn("n_tokens", F.size("ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256))
            .withColumn("decoded_sha256", F.sha2(F.col("decoded"), 256)))
