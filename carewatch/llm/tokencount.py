"""Operator 7: edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: leaves are blocks of consecutive
pre-tokens with their ends and token counts, inner nodes hold the sums of characters and
tokens below. An edit finds its leaves by the character sums, cuts the text anew from the last
pre-token border that the edit cannot have moved until a border of the old text is met again,
encodes only those pre-tokens, and updates the sums on the way up.

How far an edit reaches: a pre-token's end depends on the text up to `LOOK` code points behind
it, so borders at least that far before the edit stand. Behind the edit the same text follows,
and cutting depends only on what follows, so from the first common border on all is as before.

Defined cases: a null text is empty; positions beyond the text are clamped to its end; edits
apply in order, each to the text left by the one before; a document without edits keeps its
tree; equal rows get equal results; an empty table gives an empty result; other columns
pass through, and those named like a result are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, Tokenizer
from .common import without

BLOCK = 64
LOOK = 2
EDIT = "array<struct<start:int,length:int,insert:string>>"


class Tree:
    """The pre-tokens of one text in a segment tree."""

    def __init__(self, text: str, encoder: Encoder):
        self.text, self.encoder = text, encoder
        self.encoded = 0
        lengths, counts = self._cut(text)
        self._build(lengths, counts)

    def _count(self, piece: str) -> int:
        self.encoded += 1
        return len(self.encoder.pieces[piece])

    def _cut(self, text: str) -> tuple[list[int], list[int]]:
        pieces = self.encoder.findall(text)
        return list(map(len, pieces)), list(map(self._count, pieces))

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.leaves = [(lengths[i:i + BLOCK], counts[i:i + BLOCK]) for i in range(0, len(lengths), BLOCK)] or [([], [])]
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.chars, self.tokens = [0] * (2 * size), [0] * (2 * size)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[size + i], self.tokens[size + i] = sum(a), sum(b)
        for i in range(size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at` (the last one for the end), and where it begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if at >= begin + self.chars[i] and self.chars[i + 1]:
                begin += self.chars[i]
                i += 1
        return i - self.size, begin

    def _set(self, k: int, lengths: list[int], counts: list[int]) -> None:
        self.leaves[k] = (lengths, counts)
        i = self.size + k
        self.chars[i], self.tokens[i] = sum(lengths), sum(counts)
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace `length` code points at `start` by `insert`."""
        text = self.text
        start = min(max(0, start), len(text))
        length = min(max(0, length), len(text) - start)
        self.text = text = text[:start] + insert + text[start + length:]
        shift = len(insert) - length
        # the last border that stands before the edit
        first, begin = self._leaf(max(0, start - LOOK))
        keep, at = 0, begin
        for n in self.leaves[first][0]:
            if at + n + LOOK > start:
                break
            at += n
            keep += 1
        # old borders from the end of the edit on, leaf by leaf
        last, last_begin = self._leaf(start + length)
        borders = self._borders(last, last_begin)
        lengths, counts = [], []
        pos = at
        finditer = self.encoder.finditer(text, at)
        k, border = last, None
        while pos < len(text):
            if pos >= start + len(insert):
                while k < len(self.leaves) and (not borders or borders[-1] < pos - shift):
                    k += 1
                    if k == len(self.leaves):
                        break
                    last_begin = borders[-1] if borders else last_begin
                    borders = self._borders(k, last_begin)
                if k < len(self.leaves):
                    i = bisect_right(borders, pos - shift) - 1
                    if i >= 0 and borders[i] == pos - shift:
                        border = i
                        break
            piece = next(finditer).group()
            lengths.append(len(piece))
            counts.append(self._count(piece))
            pos += len(piece)
        a, b = self.leaves[first]
        head = (a[:keep] + lengths, b[:keep] + counts)
        if border is None:
            stop = len(self.leaves)
        else:
            # the leaf of the common border keeps what stands behind it
            c, d = self.leaves[k]
            head = (head[0] + c[border:], head[1] + d[border:])
            stop = k + 1
        if len(head[0]) > 4 * BLOCK:  # a leaf that has grown is dealt out again
            rest = self.leaves[:first] + [head] + self.leaves[stop:]
            self._build([n for x in rest for n in x[0]], [n for x in rest for n in x[1]])
            return
        self._set(first, *head)
        for j in range(first + 1, stop):
            if self.leaves[j][0]:
                self._set(j, [], [])

    def _borders(self, k: int, begin: int) -> list[int]:
        """Where the pre-tokens of leaf `k` begin, and where the leaf ends."""
        out = [begin]
        for n in self.leaves[k][0]:
            out.append(out[-1] + n)
        return out


OUTPUTS = ("n_tokens", "n_pretokens", "edited_tokens", "edited_chars", "reencoded")


def count_with_edits(docs: DataFrame, edits: Column, path: str, pattern: str, *, text_col="text") -> DataFrame:
    """`docs` with n_tokens and n_pretokens of each text, edited_tokens and edited_chars after
    `edits` (an array of start, length, insert), and reencoded: the pre-tokens encoded for them."""
    docs = without(docs, OUTPUTS, keep=(text_col,))
    encoder = Tokenizer(docs.sparkSession, path, pattern).encoder()
    schema = ", ".join(f"{c} long" for c in OUTPUTS)

    @F.pandas_udf(schema)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        enc = encoder()
        for texts, changes in batches:
            rows = []
            for text, change in zip(texts, changes, strict=True):
                enc.pieces.trim()
                tree = Tree(text or "", enc)
                n, m = tree.n_tokens, tree.encoded
                for e in () if change is None else change:
                    tree.edit(e["start"], e["length"], e["insert"] or "")
                rows.append((n, m, tree.n_tokens, len(tree.text), tree.encoded - m))
            yield pd.DataFrame(rows, columns=list(OUTPUTS))

    return (docs.withColumn("__c", run(F.col(text_col), edits.cast(EDIT)))
            .select(*[f"`{c}`" for c in docs.columns], *[F.col(f"__c.{c}").alias(c) for c in OUTPUTS]))


def usual_edits(text: Column) -> Column:
    """Three edits of any text: its first 20 code points go in at a third, 15 code points
    go out at two thirds of its length, and a mark replaces the middle code point."""
    n = F.coalesce(F.char_length(text), F.lit(0))
    return F.array(
        F.struct((n / 3).cast("int").alias("start"), F.lit(0).alias("length"), F.substring(text, 1, 20).alias("insert")),
        F.struct((n * 2 / 3).cast("int").alias("start"), F.lit(15).alias("length"), F.lit("").alias("insert")),
        F.struct((n / 2).cast("int").alias("start"), F.lit(1).alias("length"), F.lit("'s").alias("insert")))
