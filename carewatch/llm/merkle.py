"""Operator 12: Merkle manifest of a dataset with a proof for every row (octopus multiproof).

The tree: a row's leaf is the digest of its fields; the leaves of a source, in order of their ids,
are folded in runs of 16 until one node is left, the source's subroot; the subroots, in order of
the sources, are folded likewise into the root. Digests are lowercase hex SHA-256 throughout.

* Order without a single task: rows are range-partitioned by (source, id, leaf) and written once;
  numbers inside a partition plus a window over one count a partition give every row its place.
  Sources are numbered the same way. A source with a third of all rows spans many partitions.
* Levels: one aggregate a level, 16 nodes to one, each written; a tree of n leaves has log16(n).
* Proofs: leaves go out in partitions of `LEAVES` consecutive ones. Each computes the least set of
  nodes that it cannot derive from its own leaves (level by level: members of the touched runs less
  the nodes that are known), all are fetched in one join, the shared interior nodes are derived
  once, and every leaf's proof is expanded inside the partition. A partition of consecutive
  leaves lacks at most 30 nodes a level, and none below the top of a source that it holds whole.

Defined cases: each null field is `-`, an empty one `0:`; null ids come first in their source, equal ids
follow their leaves; equal rows are leaves of their own; a null source is a source and the first one;
texts are hashed whole; other columns are not read, so clashing names do no harm; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, shuffle_width

RUN, SHIFT = 16, 4
#: Leaves of one partition of the proofs.
LEAVES = 4_096
#: The tree of the subroots; sources are trees 0, 1, 2, ...
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """Digest of fields: each `-` if null, else its UTF-8 byte count, `:` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


# ------------------------------------------------------------------ places

def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` with their place in the order of `order` (nulls first) as `name`. Rows equal in all of
    `order` are spread too, so no key is too frequent for a partition. Written once, so that
    places stay when an executor is lost."""
    dealt = checkpointed(
        rows.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_width(rows.sparkSession), *order, "__tie")
        .sortWithinPartitions(*order, "__tie")
        .withColumn("__at", F.monotonically_increasing_id()))  # partition, and number in it from bit 33 down
    part = F.shiftright("__at", 33)
    starts = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__n")).select("__part", F.coalesce(
        F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    # one row a partition of the exchange above: its number is the session's shuffle width at most
    return (dealt.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn(name, F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1))
            .drop("__part", "__start", "__tie", "__at"))


# ------------------------------------------------------------------- tree

def fold(nodes: DataFrame, widest: int) -> list[DataFrame]:
    """All levels above `nodes` (tree, level 0, idx, width, digest): nodes of trees of one width
    are tops and fold no further. `width` is the number of nodes of the tree's level and
    `widest` the largest of them."""
    levels, below, level = [], nodes, 0
    while widest > 1:
        level, widest = level + 1, -(-widest // RUN)
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))  # 16 at most
        below = checkpointed(
            below.where("width > 1").groupBy("tree", F.shiftright("idx", SHIFT).alias("idx")).agg(
                F.max("width").alias("width"), run.alias("run"))
            .select("tree", F.lit(level).alias("level"), "idx",
                    F.shiftright(F.col("width") + (RUN - 1), SHIFT).alias("width"),
                    F.sha2(F.array_join(F.transform("run", lambda x: x["digest"]), ""), 256).alias("digest")))
        levels.append(below)
    return levels


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest(docs: DataFrame, *, fields=FIELDS, changed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes). Leaves: doc_id, source, leaf, changed_leaf (of the row with `changed` as its
    text; null where that is null), tree and idx (the leaf's coordinates), width (leaves of the source),
    top_width (sources), place (in the whole dataset). Nodes: tree, level, idx, width, digest of all
    leaves and interior nodes; the subroot of source t is at level 0, idx t of the tree `TOP`."""
    ident, source, text = fields[0], fields[1], fields[-1]
    own = [F.col(f) for f in fields]
    other = F.when(changed.isNotNull(), leaf_digest(*own[:-1], changed)) if changed is not None else F.lit(None)
    rows = docs.select(F.col(ident).alias("doc_id"), F.col(source).alias("source"), leaf_digest(*own).alias("leaf"),
                       other.cast("string").alias("changed_leaf"))
    rows = placed(rows, ["source", "doc_id", "leaf"], "place")
    spans = rows.groupBy("source").agg(F.min("place").alias("first"), F.count("*").alias("width"))
    spans = checkpointed(placed(spans, ["source"], "tree"))
    sizes = spans.agg(F.max("width").alias("widest"), F.count("*").alias("n")).first()  # two numbers
    spans = spans.withColumnRenamed("source", "__source")
    leaves = checkpointed(
        rows.join(spans, F.col("source").eqNullSafe(F.col("__source")))
        .select("doc_id", "source", "leaf", "changed_leaf", "tree", (F.col("place") - F.col("first")).alias("idx"),
                "width", F.lit(sizes["n"]).cast("long").alias("top_width"), "place"))
    ground = leaves.select("tree", F.lit(0).alias("level"), "idx", "width", F.col("leaf").alias("digest"))
    under = [ground, *fold(ground, sizes["widest"] or 0)]
    tops = _union(under).where("width = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
        F.lit(sizes["n"]).cast("long").alias("width"), "digest")
    return leaves, _union([*under, tops, *fold(tops, sizes["n"])])


# ------------------------------------------------------------------ proofs

def lacking(idx: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, indices) of the nodes that the known leaves `idx` of one tree of `width` leaves cannot
    derive, up to its top: on each level the members of the touched runs less the known nodes."""
    known, level = np.unique(idx), 0
    while width > 1:
        runs = np.unique(known >> SHIFT)
        members = ((runs[:, None] << SHIFT) + np.arange(RUN)).ravel()
        yield level, np.setdiff1d(members[members < width], known, assume_unique=True)
        known, width, level = runs, -(-width // RUN), level + 1


def _trees(table: pa.Table) -> Iterator[tuple[int, np.ndarray, int]]:
    """(tree, indices of its leaves, width) of a partition's leaves."""
    tree, idx, width = (table[c].to_numpy() for c in ("tree", "idx", "width"))
    for t in np.unique(tree):
        own = tree == t
        yield int(t), idx[own], int(width[own][0])


def _coordinates(key, table):
    out = [(t, level, ids) for t, idx, width in _trees(table) for level, ids in lacking(idx, width)]
    out += [(TOP, level, ids) for level, ids in lacking(table["tree"].to_numpy(), table["top_width"][0].as_py())]
    n = [len(ids) for _, _, ids in out]
    return pa.table({"part": np.full(sum(n), key[0].as_py(), np.int64), "tree": np.repeat(np.array([o[0] for o in out], np.int64), n),
                     "level": np.repeat(np.array([o[1] for o in out], np.int32), n),
                     "idx": np.concatenate([o[2] for o in out] or [np.empty(0, np.int64)]).astype(np.int64)})


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Octopus:
    """Nodes one partition knows: its leaves, what it fetched, and the interior nodes of both."""

    def __init__(self, nodes: dict[tuple[int, int, int], str]):
        self.nodes, self.runs = nodes, {}

    def derive(self, tree: int, idx: np.ndarray, width: int) -> str:
        """Interior nodes above the leaves `idx` of a tree; returns its top."""
        known, level = np.unique(idx), 0
        while width > 1:
            known = np.unique(known >> SHIFT)
            for i in known.tolist():
                first = i << SHIFT
                run = [self.nodes[tree, level, k] for k in range(first, min(first + RUN, width))]
                self.runs[tree, level, i] = run
                self.nodes[tree, level + 1, i] = _hash("".join(run))
            width, level = -(-width // RUN), level + 1
        return self.nodes[tree, level, 0]

    def path(self, tree: int, idx: int, width: int) -> list[tuple[list[str], int]]:
        """(run, own position in it) from a leaf of a tree to its top."""
        out, level = [], 0
        while width > 1:
            out.append((self.runs[tree, level, idx >> SHIFT], idx & (RUN - 1)))
            idx, width, level = idx >> SHIFT, -(-width // RUN), level + 1
        return out


def folded(leaf: str, path: list[tuple[list[str], int]]) -> str:
    """The root that a leaf and the other members of its runs give."""
    for run, at in path:
        leaf = _hash("".join([*run[:at], leaf, *run[at + 1:]]))
    return leaf


RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, source string")


def _expand(with_proofs: bool):
    def run(key, leaves, fetched):
        places = zip(*[fetched[c].to_pylist() for c in ("tree", "level", "idx")], strict=True)
        nodes = dict(zip(places, fetched["digest"].to_pylist(), strict=True))
        rows = list(zip(*[leaves[c].to_pylist() for c in ("tree", "idx", "leaf", "changed_leaf")], strict=True))
        nodes |= {(t, 0, i): leaf for t, i, leaf, _ in rows}
        octopus, subroots, widths = Octopus(nodes), {}, {}
        for tree, idx, width in _trees(leaves):
            widths[tree] = width
            subroots[tree] = nodes[TOP, 0, tree] = octopus.derive(tree, idx, width)
        sources = leaves["top_width"][0].as_py()
        root = octopus.derive(TOP, np.array(list(subroots)), sources)
        top = {t: octopus.path(TOP, t, sources) for t in subroots}
        above: dict[tuple[int, int], tuple[list, str]] = {}  # what the leaves of one run share
        proofs, roots, paths = [], [], []
        for tree, idx, leaf, changed in rows:
            at, low = (tree, idx >> SHIFT), []
            if widths[tree] > 1:
                low = [(octopus.runs[tree, 0, idx >> SHIFT], idx & (RUN - 1))]
            if at not in above:
                rest = octopus.path(tree, idx, widths[tree])[len(low):] + top[tree]
                above[at] = rest, "".join("".join(r[:p] + r[p + 1:]) for r, p in rest)
            rest, text = above[at]
            proofs.append(_hash("".join("".join(r[:p] + r[p + 1:]) for r, p in low) + text))
            roots.append(folded(leaf if changed is None else changed, low + rest))
            if with_proofs:
                paths.append([r[:p] + r[p + 1:] for r, p in low + rest])
        out = {"doc_id": leaves["doc_id"], "leaf": leaves["leaf"], "subroot": [subroots[t] for t, *_ in rows],
               "root": [root] * len(rows), "proof_sha256": proofs, "folded_root": roots,
               "verified": [r == root for r in roots], "source": leaves["source"]}
        return pa.table(out | ({"proof": pa.array(paths, pa.list_(pa.list_(pa.string())))} if with_proofs else {}))
    return run


def prove(leaves: DataFrame, nodes: DataFrame, *, with_proofs: bool = False, leaves_a_part: int = LEAVES) -> DataFrame:
    """Proofs of `leaves` (all of a manifest's or any of them): doc_id, leaf, subroot, root, the digest
    of all siblings from the leaf to the root, the root folded from the leaf (the changed one if
    there is one) and those siblings, and whether it is the root; with `with_proofs` the siblings
    themselves, an array for each run on the way up."""
    parts = leaves.withColumn("part", F.floor(F.col("place") / leaves_a_part).cast("long"))
    wanted = parts.select("part", "tree", "idx", "width", "top_width").groupBy("part").applyInArrow(
        _coordinates, "part long, tree long, level int, idx long")
    fetched = wanted.join(nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])
    schema = RESULT + (", proof array<array<string>>" if with_proofs else "")
    return parts.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_expand(with_proofs), schema)


def proofs_after_edits(docs: DataFrame, changed: Column, **options) -> DataFrame:
    """Manifest of `docs` and the proofs of all its rows against texts replaced by `changed` (null:
    not replaced)."""
    return prove(*manifest(docs, changed=changed), **options)
