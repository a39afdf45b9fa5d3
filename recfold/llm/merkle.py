"""Merkle manifest of a table, proved by octopus multiproofs.

Every row is a leaf. The leaves of one source form a tree in the order of
doc_id: of each level, every ``FAN`` consecutive nodes become their hash until
one is left, the subroot. The subroots, ordered by source, form the top tree
in the same way; what is left of it is the root of the manifest.

1. Leaf hashes are SQL expressions; each text is read once.
2. The leaves are range partitioned by (source, doc_id, hash, row), so a source
   of any size is spread over tasks. A leaf's number in its tree is its place
   in its range plus the rows of the source in earlier ranges; only counts per
   range and source are summed for that.
3. ``climb`` hashes three levels at a time in groups of ``FAN ** 3`` nodes.
4. Octopus proof: a partition of leaves finds, level by level, the nodes which
   its leaves and what they derive don't give (the minimal union), fetches each
   of them once by a join, derives the shared interior nodes, and expands the
   proof of every leaf from them without further reads.

Defined results: a null column is encoded as ``-`` and differs from an empty
text; texts of any length are one leaf; repeated rows are leaves of their own
(equal hashes are interchangeable, any order gives the same tree); rows with a
null doc_id come first in their source, ordered by leaf hash; a null source is
a source of its own, before all others; an empty table has no node, no root
and no proof; other columns of the table are not part of a leaf and may have any
name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recfold.llm.common import materialize

#: Nodes that become one.
FAN = 16
#: Leaves of one partition, the unit of a multiproof.
LEAVES = 65_536
#: Tree number of the tree over the subroots.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NODE = "tree long, m long, level int, idx long, digest string"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    parts = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*parts, _field(text)).cast("binary"), 256)


def is_tampered() -> Column:
    """Rows whose doc_id's decimal text (null: empty) has a crc32 that 5 divides."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """Rows (tree, m, idx, part, doc_id, leaf, changed): the leaf's number in
    its tree of ``m`` leaves, the range it lies in, and for tampered rows the
    hash of what the row was changed to."""
    changed = F.when(is_tampered(), _leaf(F.translate("text", UPPER, LOWER)))
    hashed = docs.select("doc_id", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("skey"),
                         _leaf(F.col("text")).alias("leaf"), changed.alias("changed"))
    hashed = materialize(hashed.withColumn("row", F.monotonically_increasing_id()), "leaves")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(hashed.count() / LEAVES))
    order = ["skey", "doc_id", "leaf", "row"]
    ranged = hashed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "skey", "leaf", "changed", F.spark_partition_id().alias("part"),
                           F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("pos"))
    ranged = materialize(ranged, "ranges")
    return materialize(ranged.join(_places(ranged), ["part", "skey"]).select(
        "tree", "m", (F.col("before") + F.col("pos")).alias("idx"), "part", "doc_id", "leaf", "changed"), "numbered")


def _places(ranged: DataFrame) -> DataFrame:
    """Per range and source: the tree's number and size, and what to add to a
    row's place in the range to get its number in the tree."""
    spark = ranged.sparkSession
    runs = materialize(ranged.groupBy("part", "skey").agg(F.count("*").alias("n"), F.min("pos").alias("start")), "runs")
    of_source = Window.partitionBy("skey")  # as many rows as the source has ranges
    earlier = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "skey", F.sum("n").over(of_source).alias("m"),
                       (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start")).alias("before"),
                       F.min("part").over(of_source).alias("first"))
    runs = materialize(runs, "runs")
    begun = runs.filter("part = first")
    total, rows = 0, []
    for r in begun.groupBy("part").count().orderBy("part").collect():  # one row per range
        rows.append((r["part"], total))
        total += r["count"]
    base = spark.createDataFrame(rows, "first int, base long")
    within = F.row_number().over(Window.partitionBy("first").orderBy("skey")) - 1
    trees = begun.withColumn("within", within).join(F.broadcast(base), "first").select(
        "skey", (F.col("base") + F.col("within")).alias("tree"))
    return runs.join(trees, "skey").select("part", "skey", "tree", "m", "before")


# --------------------------------------------------------------------------
# the nodes
# --------------------------------------------------------------------------

def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _climb_group(table: pa.Table) -> pa.Table:
    """Up to three levels over one aligned group of at most FAN ** 3 nodes."""
    tree, m, level = (table.column(c)[0].as_py() for c in ("tree", "m", "level"))
    order = np.argsort(table.column("idx").to_numpy())
    idx = table.column("idx").to_numpy()[order]
    nodes = table.column("digest").take(pa.array(order)).to_pylist()
    first, out = int(idx[0]), ([], [], [], [])
    for _ in range(3):
        if m <= 1:
            break
        nodes = [digest(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
        first, m, level = first // FAN, -(-m // FAN), level + 1
        out[0].extend([m] * len(nodes)), out[1].extend([level] * len(nodes))
        out[2].extend(range(first, first + len(nodes))), out[3].extend(nodes)
    return pa.table({"tree": pa.array([tree] * len(out[0]), pa.int64()), "m": pa.array(out[0], pa.int64()),
                     "level": pa.array(out[1], pa.int32()), "idx": pa.array(out[2], pa.int64()),
                     "digest": pa.array(out[3], pa.string())})


def climb(nodes: DataFrame) -> DataFrame:
    """All nodes (tree, m, level, idx, digest) of the trees over level-0
    ``nodes`` of the same columns, level 0 included; ``m`` is the number of
    nodes of the tree on that level."""
    largest = nodes.agg(F.max("m")).first()[0] or 0
    below, levels, level = nodes, [nodes], 0
    while largest > 1:
        cell = F.expr(f"idx div {FAN ** 3}").alias("cell")
        got = below.filter("m > 1").groupBy("tree", cell).applyInArrow(_climb_group, _NODE)
        got = materialize(got, "nodes")
        levels.append(got)
        level, largest = level + 3, -(-largest // FAN ** 3)
        below = got.filter(F.col("level") == level)
    out = levels[0]
    for x in levels[1:]:
        out = out.union(x)
    return out


def manifest(docs: DataFrame) -> dict:
    """The manifest: ``leaves`` (see there), ``nodes`` of all trees, the number
    of ``trees`` and the ``root`` (None for an empty table)."""
    rows = leaves(docs)
    low = climb(rows.select("tree", "m", F.lit(0).alias("level"), "idx", F.col("leaf").alias("digest")))
    trees = (rows.agg(F.max("tree")).first()[0] if rows.head(1) else -1) + 1
    tops = low.filter("m = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("m"),
                                      F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest")
    high = climb(materialize(tops, "subroots"))
    root = high.filter("m = 1").first() if trees else None
    return {"leaves": rows, "nodes": low.union(high), "trees": trees, "root": root["digest"] if root else None}


# --------------------------------------------------------------------------
# multiproofs
# --------------------------------------------------------------------------

def missing_nodes(idx: np.ndarray, m: int) -> list[tuple[int, np.ndarray]]:
    """Per level the node numbers that the leaves ``idx`` of a tree of ``m``
    leaves, and the nodes derived from them, leave open."""
    out, level, known = [], 0, np.unique(idx)
    while m > 1:
        runs = np.unique(known // FAN)
        if len(known) < m:
            every = (runs[:, None] * FAN + np.arange(FAN)).ravel()
            every = every[every < m]
            lack = every[~np.isin(every, known, assume_unique=True)]
            if len(lack):
                out.append((level, lack))
        known, m, level = runs, -(-m // FAN), level + 1
    return out


def _by_tree(tree: np.ndarray):
    """Start and end of every run of equal values."""
    edge = np.concatenate(([0], np.flatnonzero(tree[1:] != tree[:-1]) + 1, [len(tree)])) if len(tree) else np.zeros(1, int)
    return zip(edge[:-1].tolist(), edge[1:].tolist())


def requests(rows: DataFrame, trees: int) -> DataFrame:
    """Node coordinates (part, tree, level, idx) that each partition of leaves has to fetch."""

    def ask(table):
        part = table.column("part")[0].as_py()
        order = np.lexsort((table.column("idx").to_numpy(), table.column("tree").to_numpy()))
        tree, idx, m = (table.column(c).to_numpy()[order] for c in ("tree", "idx", "m"))
        found = [(int(tree[a]), level, lack) for a, b in _by_tree(tree) for level, lack in missing_nodes(idx[a:b], int(m[a]))]
        found += [(TOP, level, lack) for level, lack in missing_nodes(tree, trees)]
        size = np.array([len(x) for _, _, x in found], np.int64)
        return pa.table({"part": pa.array([part] * int(size.sum()), pa.int32()),
                         "tree": pa.array(np.repeat(np.array([t for t, _, _ in found], np.int64), size)),
                         "level": pa.array(np.repeat(np.array([k for _, k, _ in found], np.int32), size)),
                         "idx": pa.array(np.concatenate([x for _, _, x in found]) if found else np.zeros(0, np.int64), pa.int64())})

    return rows.select("part", "tree", "m", "idx").groupBy("part").applyInArrow(ask, "part int, tree long, level int, idx long")


class Grown:
    """A tree grown from some of its leaves and fetched nodes: ``runs[level]``
    holds the nodes of every run that lies on a path."""

    def __init__(self, m: int, known: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.runs: list[dict[int, list[str]]] = []
        level = 0
        while m > 1:
            runs, above = {}, {}
            for r in sorted({i // FAN for i in known}):
                runs[r] = [known[i] if i in known else fetched[level, i] for i in range(FAN * r, min(FAN * r + FAN, m))]
                above[r] = digest(runs[r])
            self.runs.append(runs)
            known, m, level = above, -(-m // FAN), level + 1
        self.root = known[0]

    def siblings(self, leaf: int) -> list[tuple[int, list[str]]]:
        """Per level the leaf's place in its run and the whole run."""
        out = []
        for runs in self.runs:
            out.append((leaf % FAN, runs[leaf // FAN]))
            leaf //= FAN
        return out


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, run in path:
        leaf = digest([*run[:place], leaf, *run[place + 1:]])
    return leaf


def proof_text(path: list[tuple[int, list[str]]]) -> str:
    return "".join(x for place, run in path for x in (*run[:place], *run[place + 1:]))


def prove(book: dict, rows: DataFrame | None = None, keep_proof: bool = False) -> DataFrame:
    """Proofs of the given rows of ``book['leaves']`` (default: all): doc_id,
    leaf, subroot, root, the proof's hash, the root folded from the changed
    leaf (else the leaf itself) and whether it is the manifest's;
    ``keep_proof`` adds the siblings' hashes as one text."""
    rows = book["leaves"] if rows is None else rows
    trees, root = book["trees"], book["root"]
    asked = requests(rows, trees)
    fetched = asked.join(book["nodes"].select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])

    def expand(mine: pa.Table, other: pa.Table) -> pa.Table:
        nodes: dict[int, dict[tuple[int, int], str]] = {}
        for t, k, i, d in zip(*(other.column(c).to_pylist() for c in ("tree", "level", "idx", "digest"))):
            nodes.setdefault(t, {})[k, i] = d
        order = np.lexsort((mine.column("idx").to_numpy(), mine.column("tree").to_numpy()))
        mine = mine.take(pa.array(order))
        tree, idx, m = (mine.column(c).to_numpy() for c in ("tree", "idx", "m"))
        leaf, changed = mine.column("leaf").to_pylist(), mine.column("changed").to_pylist()
        grown = [(a, b, Grown(int(m[a]), dict(zip(idx[a:b].tolist(), leaf[a:b])), nodes.get(int(tree[a]), {})))
                 for a, b in _by_tree(tree)]
        top = Grown(trees, {int(tree[a]): g.root for a, b, g in grown}, nodes.get(TOP, {}))
        sub, proof, folded = [], [], []
        for a, b, g in grown:
            tail = top.siblings(int(tree[a]))
            tail_text, above, above_text, run = proof_text(tail), [], "", -1
            for j in range(a, b):
                i = int(idx[j])
                if g.runs and i // FAN != run:  # leaves of one run share all but their first siblings
                    run = i // FAN
                    above = g.siblings(i)[1:]
                    above_text = proof_text(above) + tail_text
                    above = above + tail
                own = [(i % FAN, g.runs[0][run])] if g.runs else []
                path = own + (above if g.runs else tail)
                proof.append(proof_text(own) + (above_text if g.runs else tail_text))
                folded.append(fold(changed[j] or leaf[j], path))
                sub.append(g.root)
        out = {"doc_id": mine.column("doc_id"), "leaf": mine.column("leaf"), "subroot": pa.array(sub, pa.string()),
               "root": pa.array([root] * len(sub), pa.string()),
               "proof_sha256": pa.array([digest([p]) for p in proof], pa.string()),
               "folded_root": pa.array(folded, pa.string()),
               "verified": pa.array([f == root for f in folded], pa.bool_())}
        if keep_proof:
            out["proof"] = pa.array(proof, pa.string())
        return pa.table(out)

    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean" + (", proof string" if keep_proof else ""))
    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(expand, schema)


def report(docs: DataFrame) -> DataFrame:
    return prove(manifest(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")))
