"""Operator 5: shards of near-equal bytes for indivisible groups of documents
(Karmarkar-Karp differencing).

Equal texts form one group and stay in one shard (law `bytes`). A partial partition is a
tuple of k sums; differencing combines the two partial partitions with the largest spread,
largest sum against smallest, until one is left. It runs in rounds of tasks: in the first, every
task differences the groups of its own cell and returns one tuple of k sums; in each further one,
a task differences the tuples of `CELLS_A_ROUND` cells, until one tuple is left. The rounds'
permutations are then joined from the top down. So no task or driver step sees all groups, and
groups of any number of rows are one row.

Groups that a cell could not even out, those with more than a `GIANT`-th of a shard's share (a
few hundred at most), are differenced first. If they leave the shards uneven, every cell also gets its
part of that unevenness as one more tuple, and so fills the shards up to one level; its tuples
are bound to shards then, and the rounds are left out.

Defined cases: a null text has no bytes and is equal to an empty text; a size is UTF-8
bytes + 1, so empty texts count; a null doc_id is numbered like any other; equal rows get
different slots; an empty table gives an empty result. A group larger than total / k
bytes cannot be split, so the balance is then bounded by that group.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, shuffle_width, without

OUTPUTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
GROUPS_A_CELL = 50_000
CELLS_A_ROUND = 1_000
GIANT = 64


def difference(parts: list[np.ndarray], k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Karmarkar-Karp over `parts`, each an array of k sums. Returns for every part the
    shard that each of its k positions ends in, and the k sums of the shards."""
    if not parts:
        return [], np.zeros(k, np.int64)
    tick = itertools.count()
    heap, joins = [], []
    total = [0] * k
    for i, sums in enumerate(parts):
        order = sorted(range(k), key=lambda j: -sums[j])
        low = int(sums[order[-1]])
        state = [int(sums[j]) - low for j in order]
        heap.append((-state[0], next(tick), state, (i, order)))
    heapq.heapify(heap)
    # a node is (left, left positions, right, right positions); a leaf is (part, order)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b), strict=True)]
        order = sorted(range(k), key=lambda j: -sums[j])
        low = sums[order[-1]]
        joins.append((left, right))
        heapq.heappush(heap, (low - sums[order[0]], next(tick), [sums[j] - low for j in order],
                              (~(len(joins) - 1), order)))
    places: list[np.ndarray] = [None] * len(parts)  # type: ignore[list-item]
    todo = [(heap[0][3], list(range(k)))]
    while todo:
        (node, order), shard_of = todo.pop()
        # position p of the sorted state is position order[p] of the node's own positions
        own = [0] * k
        for p, j in enumerate(order):
            own[j] = shard_of[p]
        if node >= 0:
            places[node] = np.array(own, np.int32)
            for j in range(k):
                total[own[j]] += int(parts[node][j])
        else:
            left, right = joins[~node]
            todo.append((left, own))
            todo.append((right, own[::-1]))
    return places, np.array(total, np.int64)


def _cells(k: int, ballast: np.ndarray, rest: int):
    def run(key, pdf):
        sizes = pdf["bytes"].to_numpy()
        order = np.argsort(pdf["group"].to_numpy(), kind="stable")  # reruns agree
        parts = [np.round(ballast * (sizes.sum() / max(1, rest))).astype(np.int64)]
        for s in sizes[order]:
            row = np.zeros(k, np.int64)
            row[0] = s
            parts.append(row)
        places, _ = difference(parts, k)
        shard_of = np.argsort(places[0])  # where the ballast of each shard has gone
        local = np.empty(len(sizes), np.int32)
        local[order] = [shard_of[p[0]] for p in places[1:]]
        return pd.DataFrame({"group": pdf["group"], "cell": key[0], "local": local, "bytes": sizes})
    return run


def _uneven(giants: np.ndarray, rest: int) -> np.ndarray:
    """What the giants' sums leave uneven if `rest` bytes fill the shards up to one level: each shard's
    bytes above the least one, up to that level."""
    level, low = 0.0, np.sort(giants)
    for n in range(len(low), 0, -1):  # the n lowest shards take all of the rest
        level = (rest + low[:n].sum()) / n
        if level >= low[n - 1]:
            break
    out = np.minimum(giants, level)
    return out - out.min()


def _tuples(k: int):
    def run(key, pdf):
        nodes, at = np.unique(pdf["node"].to_numpy(), return_inverse=True)  # reruns agree
        sums = np.zeros((len(nodes), k), np.int64)
        sums[at, pdf["local"].to_numpy()] = pdf["bytes"].to_numpy()
        places, _ = difference(list(sums), k)
        return pd.DataFrame({"node": np.repeat(nodes, k), "local": np.tile(np.arange(k, dtype=np.int32), len(nodes)),
                             "parent": key[0], "place": np.concatenate(places), "bytes": sums.ravel()})
    return run


def _shards_of_cells(local: DataFrame, cells: int, shards: int, cells_a_round: int) -> DataFrame:
    """(node, local, shard): the shard in which each position of each cell's tuple ends."""
    sums = local.groupBy(F.col("cell").alias("node"), "local").agg(F.sum("bytes").alias("bytes"))
    rounds = []
    while cells > 1:
        moved = checkpointed(sums.groupBy(F.floor(F.col("node") / cells_a_round).cast("int").alias("parent")).applyInPandas(
            _tuples(shards), "node int, local int, parent int, place int, bytes long"))
        rounds.append(moved)
        sums = moved.groupBy(F.col("parent").alias("node"), F.col("place").alias("local")).agg(F.sum("bytes").alias("bytes"))
        cells = -(-cells // cells_a_round)
    out = rounds.pop().select("node", "local", F.col("place").alias("shard"))
    while rounds:
        above = out.select(F.col("node").alias("parent"), F.col("local").alias("place"), "shard")
        out = rounds.pop().join(above, ["parent", "place"]).select("node", "local", "shard")
    return out


def shard_documents(docs: DataFrame, shards: int = 8, *, id_col="doc_id", text_col="text",
                    groups_a_cell: int = GROUPS_A_CELL, cells_a_round: int = CELLS_A_ROUND) -> DataFrame:
    """`docs` with size, text_crc32, law (`bytes`), shard, slot and grown_shard (null: the law
    `bytes` has no rule for one more shard)."""
    spark = docs.sparkSession
    docs = without(docs, OUTPUTS, keep=(id_col, text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = (docs.withColumn("size", F.octet_length(text).cast("long") + 1)
            .withColumn("text_crc32", F.crc32(text))
            .withColumn("__group", F.sha2(text, 256)))
    # one small row a group; hot groups shrink in the map-side combine
    groups = checkpointed(rows.groupBy(F.col("__group").alias("group"))
                          .agg(F.sum("size").alias("bytes")))
    sizes = groups.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    total = sizes["bytes"] or 0
    large = F.col("bytes") > total / (shards * GIANT)
    giants = sorted(map(tuple, groups.filter(large).collect()))  # fewer than shards * GIANT
    places, sums = difference([np.array([b] + [0] * (shards - 1)) for _, b in giants], shards)
    rest = int(total - sums.sum())
    ballast = _uneven(sums, rest)
    cells = max(1, -(-(sizes["n"] - len(giants)) // groups_a_cell))
    groups = groups.filter(~large).withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(cells)).cast("int"))
    local = checkpointed(groups.groupBy("cell").applyInPandas(
        _cells(shards, ballast, rest), "group string, cell int, local int, bytes long"))
    if cells > 1 and not ballast.any():
        ends = _shards_of_cells(local, cells, shards, cells_a_round)
        assigned = local.join(ends, (F.col("cell") == F.col("node")) & (local["local"] == ends["local"])).select(
            F.col("group").alias("__g"), "shard")
    else:
        assigned = local.select(F.col("group").alias("__g"), F.col("local").alias("shard"))
    if giants:
        assigned = assigned.unionByName(spark.createDataFrame(
            [(g, int(p[0])) for (g, _), p in zip(giants, places, strict=True)], "__g string, shard int"))
    placed = rows.join(assigned, F.col("__group") == F.col("__g")).drop("__g")
    # gapless slots without a task a shard: counts of (shard, lane), then numbers inside a lane
    lanes = shuffle_width(spark)
    placed = placed.withColumn("__lane", F.pmod(F.xxhash64(id_col, "__group"), F.lit(lanes)).cast("int"))
    starts = (placed.groupBy(F.col("shard").alias("__s"), F.col("__lane").alias("__l"))
              .agg(F.count("*").alias("__n"))
              .withColumn("__start", F.coalesce(F.sum("__n").over(
                  W.partitionBy("__s").orderBy("__l").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("__n"))
    inside = W.partitionBy("shard", "__lane").orderBy(id_col, "__group")
    return (placed.join(starts, (F.col("shard") == F.col("__s")) & (F.col("__lane") == F.col("__l")))
            .withColumn("slot", (F.row_number().over(inside) - 1 + F.col("__start")).cast("long"))
            .withColumn("law", F.lit("bytes"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .select(*[f"`{c}`" for c in docs.columns], *OUTPUTS))
