"""Operator 9: near-duplicates by SimHash fingerprints and anchor points of a covering code.

A fingerprint has 64 bits; a bit is set if more than half of the text's shingle hashes have
it. Anchors are the words of a product of perfect codes over the first bits (two Golay
codes of 23 bits with covering radius 3 by default): every fingerprint has exactly one home
anchor within the covering radius of each block. It is replicated to every anchor within
covering radius plus threshold, where the threshold is shared among the blocks, so
fingerprints x and y that differ in at most `max_bits` bits meet at the home anchor of x.
Each anchor compares its home fingerprints with all that came to it.

Equal fingerprints are one row before they are replicated, so copies cost nothing. Anchors
compare in blocks: an anchor with many fingerprints is cut into pairs of blocks that are
dealt out anew over all tasks, and a block returns a spanning forest of the links it finds
instead of all of them (the components are the same). Components are found on Spark.

The copies per fingerprint depend on the codes alone (61 for two Golay codes and 2 bits);
with more than about 10^9 different fingerprints, add `HAMMING15` as a third block: about
150 copies, and 2048 times as many anchors.

Defined cases: a null text is empty; a text without words has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle of all words; equal rows are in
one component; a null doc_id never names a component unless it has no other member (then
component_id is null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, without
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
HASHES_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Code:
    """A perfect cyclic code: bits, generator polynomial, covering radius."""
    bits: int
    generator: int
    radius: int


GOLAY = Code(23, 0b101011100011, 3)
HAMMING15 = Code(15, 0b10011, 1)
CODES = (GOLAY, GOLAY)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of one whole text, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(
            starts[at:at + HASHES_AT_ONCE], stops[at:at + HASHES_AT_ONCE], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprints as bigint (the same 64 bits, signed)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts],
                                     np.uint64).view(np.int64))

    return run(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---------------------------------------------------------------- anchors


@lru_cache(maxsize=8)
def _patterns(code: Code, threshold: int):
    """By syndrome and excess e: the bit patterns whose removal leads to a word of the code at
    distance up to the radius (e = 0) or exactly radius + e. Returns the syndrome of every
    power of x, and for each e (start, count, flat patterns)."""
    deg = code.generator.bit_length() - 1
    powers = []
    for i in range(code.bits):
        r = 1 << i
        for j in range(i, deg - 1, -1):
            if r >> j & 1:
                r ^= code.generator << (j - deg)
        powers.append(r)
    by: list[list[list[int]]] = [[[] for _ in range(1 << deg)] for _ in range(threshold + 1)]
    for weight in range(code.radius + threshold + 1):
        for bits in combinations(range(code.bits), weight):
            s = p = 0
            for b in bits:
                s ^= powers[b]
                p |= 1 << b
            by[max(0, weight - code.radius)][s].append(p)
    tables = []
    for rows in by:
        count = np.array([len(r) for r in rows], np.int64)
        tables.append((np.cumsum(count) - count, count,
                       np.array([p for r in rows for p in r], np.int64)))
    return np.array(powers, np.int64), tables


def replicate(fps: np.ndarray, threshold: int = MAX_BITS, codes=CODES):
    """(anchor, index of the fingerprint, whether it is its home) for all anchors of `fps`
    (uint64). An anchor is the blocks' code words side by side."""
    blocks, shift = [], 0
    for code in codes:
        powers, tables = _patterns(code, threshold)
        x = ((fps >> np.uint64(shift)) & np.uint64((1 << code.bits) - 1)).astype(np.int64)
        syndrome = np.zeros(len(x), np.int64)
        for i in range(code.bits):
            syndrome ^= np.where(x >> i & 1, powers[i], 0)
        blocks.append((shift, x, syndrome, tables))
        shift += code.bits
    out = []
    for excess in product(range(threshold + 1), repeat=len(codes)):
        if sum(excess) > threshold:
            continue
        row = np.arange(len(fps))
        anchor = np.zeros(len(fps), np.int64)
        for e, (at, x, syndrome, tables) in zip(excess, blocks, strict=True):
            start, count, flat = tables[e]
            n = count[syndrome[row]]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            row, anchor = np.repeat(row, n), np.repeat(anchor, n)
            anchor |= (x[row] ^ flat[start[syndrome[row]] + k]) << at
        out.append((anchor, row, np.full(len(row), sum(excess) == 0)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a, b) as links to the smallest node of each tree."""
    if not len(a):
        return a, b
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[:len(a)], inverse[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, root[x], root[y])
        np.minimum.at(low, root[y], root[x])
        while True:
            jump = low[low]
            if (jump == low).all():
                break
            low = jump
        new = low[root]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _compare(homes: np.ndarray, others: np.ndarray, threshold: int, both_home: bool):
    """Links between two sets of fingerprints of one anchor, each pair taken at the home of
    its smaller member (pairs of two home members: once)."""
    far = np.bitwise_count(homes[:, None] ^ others[None, :])
    i, j = np.nonzero((far <= threshold) & (homes[:, None] < others[None, :]) if not both_home
                      else (far <= threshold) & (homes[:, None] != others[None, :]))
    return homes[i], others[j]


BLOCK = 2048
LINK_SCHEMA = "deal long, a long, b long, homes binary, others binary, both boolean"


def _meet(threshold: int):
    """Rows sorted by (anchor, home first) -> links of small anchors, and pairs of blocks of
    large anchors for `_compare_blocks`."""

    def batch(deal, a, b, homes, others, both):
        return pa.RecordBatch.from_pydict({
            "deal": pa.array(deal, pa.int64()), "a": pa.array(a, pa.int64()),
            "b": pa.array(b, pa.int64()), "homes": pa.array(homes, pa.binary()),
            "others": pa.array(others, pa.binary()), "both": pa.array(both, pa.bool_())})

    def links(a, b):
        a, b = forest(a.view(np.int64), b.view(np.int64))
        n = len(a)
        return batch(a ^ b, a, b, [None] * n, [None] * n, [None] * n)

    def block(homes, others, both):
        return batch([int(homes[0] ^ others[-1]) >> 1], [None], [None], [homes.tobytes()],
                     [others.tobytes()], [both])

    def pairs(homes, others):
        """Blocks of a large anchor; `homes` all, `others` the next part of the rest."""
        for i in range(0, len(homes), BLOCK):
            yield block(homes[i:i + BLOCK], others, False)

    def small(anchor, fp, home):
        """Links inside whole groups, all groups of the batch at once."""
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        size = np.diff(np.concatenate((starts, [len(anchor)])))
        group = np.repeat(np.arange(len(starts)), size)
        h = np.flatnonzero(home & (size[group] > 1))
        n = size[group[h]]
        step = max(1, (1 << 22) // max(1, int(n.max(initial=1))))
        found = []
        for at in range(0, len(h), step):
            hh, nn = h[at:at + step], n[at:at + step]
            left = np.repeat(hh, nn)
            right = np.arange(nn.sum()) - np.repeat(np.cumsum(nn) - nn, nn) + np.repeat(starts[group[hh]], nn)
            near = (fp[left] < fp[right]) & (np.bitwise_count(fp[left] ^ fp[right]) <= threshold)
            found.append((fp[left[near]], fp[right[near]]))
        if found:
            return links(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        return None

    def run(batches):
        # `rest`: the last group seen, until it is complete or becomes large
        rest = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
        large = None  # (anchor, home fingerprints) of a large group being read
        for rb in batches:
            anchor = rb.column(0).to_numpy(zero_copy_only=False)
            fp = rb.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            home = rb.column(2).to_numpy(zero_copy_only=False)
            if large is not None:
                n = int(np.searchsorted(anchor, large[0], "right"))
                for i in range(0, n, BLOCK):
                    yield from pairs(large[1], fp[i:min(n, i + BLOCK)])
                anchor, fp, home = anchor[n:], fp[n:], home[n:]
                if not len(anchor):
                    continue
                large = None
            if not len(anchor):
                continue
            anchor, fp, home = (np.concatenate(x) for x in zip(rest, (anchor, fp, home), strict=True))
            last = int(np.searchsorted(anchor, anchor[-1], "left"))
            if last and (out := small(anchor[:last], fp[:last], home[:last])) is not None:
                yield out
            rest = tuple(x[last:] for x in (anchor, fp, home))
            # a large group is cut into blocks once all its home fingerprints are here
            if len(rest[0]) > 2 * BLOCK and not rest[2][-1]:
                n = int(rest[2].sum())
                if n:
                    homes, others = rest[1][:n], rest[1][n:]
                    for i in range(0, n, BLOCK):
                        for j in range(i, n, BLOCK):
                            yield block(homes[i:i + BLOCK], homes[j:j + BLOCK], True)
                    for i in range(0, len(others), BLOCK):
                        yield from pairs(homes, others[i:i + BLOCK])
                else:
                    homes = rest[1][:0]
                large = (rest[0][0], homes)
                rest = tuple(x[:0] for x in rest)
        if len(rest[0]) and (out := small(*rest)) is not None:
            yield out

    return run


def _compare_blocks(threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for rb in batches:
            a, b, homes, others, both = (rb.column(i) for i in range(1, 6))
            plain = a.is_valid()
            yield pa.RecordBatch.from_arrays([a.filter(plain), b.filter(plain)], schema=schema)
            for k in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)):
                x = np.frombuffer(homes[int(k)].as_py(), np.uint64)
                y = np.frombuffer(others[int(k)].as_py(), np.uint64)
                i, j = forest(*(v.view(np.int64) for v in _compare(x, y, threshold, both[int(k)].as_py())))
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)], schema=schema)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, codes=CODES) -> DataFrame:
    """`fps` (fp: long, all different) -> links (a, b) that connect exactly the fingerprints
    which chains of differences of at most `max_bits` bits connect."""

    def spread(batches):
        for rb in batches:
            fp = rb.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                anchor, row, home = replicate(part, max_bits, codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[row].view(np.int64)), pa.array(home)],
                    names=["anchor", "fp", "home"])

    copies = fps.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")
    met = (copies.repartition("anchor").sortWithinPartitions("anchor", F.col("home").desc())
           .mapInArrow(_meet(max_bits), LINK_SCHEMA))
    return met.repartition("deal").mapInArrow(_compare_blocks(max_bits), "a long, b long")


# ---------------------------------------------------------------- operator


def components_of(ids: DataFrame, max_bits: int = MAX_BITS, codes=CODES) -> DataFrame:
    """`ids` (doc_id, fp) -> (fp, component_id): the smallest doc_id of all documents that
    chains of links reach from the fingerprint."""
    known = checkpointed(ids.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(known, max_bits, codes))
    placed = known.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    return placed.select("fp", "root").join(lowest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", shingle=SHINGLE,
                    max_bits=MAX_BITS, seed=SEED, codes=CODES) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of `docs`."""
    ids = checkpointed(docs.select(F.col(id_col).alias("doc_id"),
                                   fingerprint_column(F.col(text_col), shingle, seed).alias("fp")))
    parts = components_of(ids, max_bits, codes)
    return ids.join(parts, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, *, id_col="doc_id", text_col="text", shingle=SHINGLE,
                 max_bits=MAX_BITS, seed=SEED, codes=CODES) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest doc_id (null
    last; among equal ids the smallest text hash), exactly one row of it."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ids = checkpointed(docs.select(
        F.col(id_col).alias("doc_id"), text_hash.alias("text_hash"),
        fingerprint_column(F.col(text_col), shingle, seed).alias("fp")))
    known = checkpointed(ids.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("low")))
    roots = connected_components(fingerprint_links(known, max_bits, codes))
    keep = (known.join(roots, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low"))
            .select(F.col("low.doc_id").alias("__id"), F.col("low.text_hash").alias("__hash")).distinct())
    kept = docs.withColumn("__own", text_hash).join(
        keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left_semi")
    one = W.partitionBy(id_col, "__own").orderBy(F.lit(0))
    return kept.withColumn("__n", F.row_number().over(one)).filter("__n = 1").drop("__own", "__n")
