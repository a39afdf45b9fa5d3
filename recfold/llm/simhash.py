"""SimHash near-duplicates by the generalised pigeonhole rule.

Fingerprints (64 bits) of lower-cased word shingles are linked when they
differ in at most ``max_bits`` bits. The search works on distinct
fingerprints, so exact copies never meet each other:

1. The 64 x 64 bit co-occurrence counts over all fingerprints give bit
   correlations; correlated bits are grouped into partitions.
2. For every partition the number of pairs within 0..max_bits differing bits
   is estimated from value histograms of 8-bit chunks over all fingerprints.
   A dynamic programme allots thresholds t_i >= -1 with
   ``sum(t_i + 1) = max_bits + 1`` that minimise probes plus candidates; by
   the generalised pigeonhole rule two linked fingerprints are within t_i in
   some partition i. The number of partitions is chosen the same way.
3. A fingerprint is filed under every key "partition value with t_i bits
   masked"; equal keys are candidates, verified on all 64 bits. A key with
   very many members is dealt out as a grid of block pairs, so no task holds
   more than two blocks. Only a spanning set of the links is written.
4. Connected components by alternating large-star / small-star rounds over
   tables in the shared folder, until nothing changes.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer words than the shingle length make
one shingle; repeated rows are answered row by row; the component id is the
smallest non-null doc_id of the component (null when all are null).
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.llm.common import drop_columns, materialize

BITS = 64
#: Members of one key that a task compares at once; larger keys become a grid of block pairs.
BLOCK = 20_000
#: Relative cost of writing one probe key and of verifying one candidate pair.
PROBE_COST, PAIR_COST = 1.0, 0.01


def _bit_columns(fps: np.ndarray) -> np.ndarray:
    """(n, 64) array of bits, bit 0 = least significant."""
    return np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split() if text else []  # bytes: lowers A-Z, splits at \x20 \x09-\x0D
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(norm[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())],
                      np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += _bit_columns(hashes[i:i + (1 << 16)]).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, out: str = "fp",
                 keep_text: bool = True) -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column ``out``; the text
    column is left out unless ``keep_text``."""
    base = drop_columns(docs, [out])
    kept = [f for f in base.schema if keep_text or f.name != text_col]

    def work(batches):
        for b in batches:
            col = b.column(b.schema.names.index(text_col)).cast(pa.large_binary())
            fps = np.array([fingerprint(x.as_py(), shingle) for x in col], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index(f.name)) for f in kept] + [pa.array(fps)],
                                             names=[f.name for f in kept] + [out])

    return base.mapInArrow(work, T.StructType(kept + [T.StructField(out, T.LongType())]))


# --------------------------------------------------------------------------
# partitions and thresholds
# --------------------------------------------------------------------------

def bit_statistics(fps: DataFrame, col: str = "fp") -> tuple[int, np.ndarray]:
    """Count and 64 x 64 co-occurrence counts of set bits over all rows, summed
    per task before they are sent (4096 numbers)."""

    def partial(batches):
        n, co = 0, np.zeros((BITS, BITS))
        for b in batches:
            bits = _bit_columns(np.asarray(b.column(0)).view(np.uint64)).astype(np.float32)
            n, co = n + len(bits), co + bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([co.ravel().tolist()], pa.list_(pa.float64()))],
                                         names=["n", "co"])

    rows = (fps.select(col).mapInArrow(partial, "n long, co array<double>")
            .select("n", F.posexplode("co").alias("i", "v")).groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    co = np.zeros(BITS * BITS)
    for r in rows:
        co[r["i"]] = r["v"]
    return (rows[0]["n"] if rows else 0), co.reshape(BITS, BITS)


def group_bits(n: int, co: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy grouping of correlated bits into ``parts`` equal partitions: each
    partition starts at the most skewed free bit and takes the bits that are
    most correlated with those it has."""
    p = co.diagonal() / max(n, 1)
    var = np.maximum(p * (1 - p), 1e-9)
    corr = np.abs((co / max(n, 1) - np.outer(p, p)) / np.sqrt(np.outer(var, var)))
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [min(free, key=lambda b: (var[b], b))]
        free.discard(group[0])
        while len(group) < size:
            nxt = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            free.discard(nxt)
        out.append(sorted(group))
    return out


def _take_bits(x: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    for i, b in enumerate(bits):
        out |= ((x >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def chunk_histograms(fps: DataFrame, chunks: list[list[int]], col: str = "fp") -> list[np.ndarray]:
    """256-value histogram of every 8-bit chunk over all rows."""

    def partial(batches):
        total = np.zeros(256 * len(chunks), np.int64)
        for b in batches:
            x = np.asarray(b.column(0)).view(np.uint64)
            for c, bits in enumerate(chunks):
                total[256 * c:256 * c + 256] += np.bincount(_take_bits(x, bits).astype(np.int64), minlength=256)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "v"])

    out = np.zeros(256 * len(chunks))
    for r in fps.select(col).mapInArrow(partial, "i long, v long").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return list(out.reshape(len(chunks), 256))


_CHUNK_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint16)[:, None] ^ np.arange(256, dtype=np.uint16))


def distance_shares(histograms: list[np.ndarray], upto: int) -> np.ndarray:
    """Share of pairs at 0..upto differing bits in the chunks together, each
    chunk's shares being exact and chunks taken as independent."""
    total = np.array([1.0])
    for h in histograms:
        q = h / max(h.sum(), 1)
        one = np.bincount(_CHUNK_DISTANCE.ravel(), weights=np.outer(q, q).ravel(), minlength=9)
        total = np.convolve(total, one)
    return np.concatenate((total, np.zeros(upto + 1)))[:upto + 1]


def allot(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 of least total
    cost; ``costs[i][t + 1]`` is the cost of t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, min(max_bits, len(c) - 2) + 1):
                u = used + t + 1
                if u <= max_bits + 1 and (u not in step or cost + c[t + 1] < step[u][0]):
                    step[u] = (cost + c[t + 1], [*ts, t])
        best = step
    return best[max_bits + 1]


def plan(fps: DataFrame, max_bits: int, col: str = "fp") -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, the cheapest over 2..max_bits+1 partitions."""
    n, co = bit_statistics(fps, col)
    options = [group_bits(n, co, m) for m in range(2, min(max_bits + 1, 16) + 1)] or [[list(range(BITS))]]
    cut = [[[g[i:i + 8] for i in range(0, len(g), 8)] for g in groups] for groups in options]
    hists = iter(chunk_histograms(fps, [c for groups in cut for g in groups for c in g], col))
    best = (math.inf, [])
    for groups, chunks in zip(options, cut):
        costs = []
        for g, cs in zip(groups, chunks):
            shares = distance_shares([next(hists) for _ in cs], max_bits)
            # a pair at d differing bits meets under every mask that covers them
            meet = [sum(shares[d] * math.comb(len(g) - d, t - d) for d in range(min(t, len(g)) + 1))
                    for t in range(max_bits + 1)]
            costs.append([0.0] + [PROBE_COST * n * math.comb(len(g), t) + PAIR_COST * n * n / 2 * meet[t]
                                  for t in range(max_bits + 1)])
        cost, ts = allot(costs, max_bits)
        if cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


# --------------------------------------------------------------------------
# probing and verification
# --------------------------------------------------------------------------

def _keys(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Rows (key, fp): one per partition and choice of masked bits."""
    masks = [(np.uint64(sum(1 << b for b in bits) & ~sum(1 << b for b in drop)), j)
             for j, (bits, drop) in enumerate((bits, drop) for bits, t in parts
                                              for drop in itertools.combinations(bits, t))]

    def work(batches):
        for b in batches:
            x = np.asarray(b.column(0)).view(np.uint64)
            for i in range(0, len(x), 4096):
                part = x[i:i + 4096]
                for mask, j in masks:
                    # multiplying by an odd number is one-to-one; the mask number keeps families apart
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), j, np.int32)), pa.array((part & mask).view(np.int64)),
                         pa.array(part.view(np.int64))], names=["family", "key", "fp"])

    return fps.select("fp").mapInArrow(work, "family int, key long, fp long")


def _star_links(x: np.ndarray, max_bits: int):
    """Spanning links (smallest reached from, reached) among distinct
    fingerprints: breadth-first search over what is not yet reached."""
    left = np.sort(x)
    while len(left) > 1:
        seed, left = left[0], left[1:]
        frontier = np.array([seed], np.uint64)
        while len(frontier) and len(left):
            cur, frontier = frontier[0], frontier[1:]
            near = np.bitwise_count(left ^ cur) <= max_bits
            if near.any():
                hit = left[near]
                yield np.full(len(hit), cur), hit
                frontier = np.concatenate((frontier, hit))
                left = left[~near]


def links(fps: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp``
    reachable from each other over steps of at most ``max_bits`` bits."""
    parts = plan(fps, max_bits)
    keys = _keys(fps, parts)
    counts = keys.groupBy("family", "key").agg(F.count("*").alias("n")).filter("n > 1")
    side = F.ceil(F.col("n") / block).cast("int")
    met = keys.join(counts, ["family", "key"]).withColumn("side", side)
    own = F.pmod(F.xxhash64("fp"), F.col("side")).cast("int")
    # cell (i, j), i <= j, holds blocks i and j; a key of one block has the cell (0, 0)
    cells = met.withColumn("own", own).select(
        "family", "key", "fp",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("side") - 1),
                              lambda o: F.struct(F.least(o, F.col("own")).alias("i"),
                                                 F.greatest(o, F.col("own")).alias("j")))).alias("cell"))
    cells = cells.select("family", "key", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "fp")

    def verify(batches):
        held: list[np.ndarray] = []

        def flush(rows):
            a, b = [], []
            if len(rows):
                cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
                for g in np.split(rows[:, 4], cut):
                    x = g.view(np.uint64)
                    if len(x) == 2:
                        if int(x[0] ^ x[1]).bit_count() <= max_bits:
                            a.append(x[:1]), b.append(x[1:])
                    else:
                        for u, v in _star_links(x, max_bits):
                            a.append(u), b.append(v)
            a = np.concatenate(a) if a else np.zeros(0, np.uint64)
            b = np.concatenate(b) if b else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in range(5)], 1)
            if not len(rows):
                continue
            edge = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1))
            if len(edge) == 0 and held and (held[-1][-1, :4] == rows[0, :4]).all():
                held.append(rows)
                continue
            last = edge[-1] + 1 if len(edge) else 0
            yield flush(np.concatenate([*held, rows[:last]]))
            held = [rows[last:]]
        if held:
            yield flush(np.concatenate(held))

    order = ["family", "key", "i", "j"]
    found = cells.repartition(*order).sortWithinPartitions(*order).mapInArrow(verify, "a long, b long")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges (a, b)``; root is the
    smallest node of the component. Alternating large-star and small-star
    rounds; every round is a table in the shared folder."""

    def state(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    e = materialize(e.distinct(), "edges")
    before = state(e)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        e2 = (small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
              .union(least.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(e2, "edges")
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: ``id_col``, ``tid`` (64-bit hash of the text),
    ``fp``, ``component_id`` and ``root``, the component's smallest fingerprint."""
    texts = docs.select(id_col, text_col, F.xxhash64(text_col).alias("tid"))
    fps = materialize(fingerprints(texts, text_col, shingle, keep_text=False), "fingerprints")
    classes = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("first")), "classes")
    roots = components(links(classes, max_bits, block))
    named = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = named.join(ids, "root").select("fp", "component_id", "root")
    return fps.join(ids, "fp").select(id_col, "tid", "fp", "component_id", "root")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of every near-duplicate component, with the columns of ``docs``:
    a row with the component's smallest doc_id. A component without any
    doc_id keeps one of its rows. The texts are shuffled once."""
    key = ["__none", "__id", "__tid"]

    def keyed(df, tid):
        return df.withColumns({"__none": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)), "__tid": tid})

    found = near_duplicates(docs, shingle, max_bits).filter("doc_id <=> component_id")
    winners = found.groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("tid").alias("tid"))
    winners = keyed(winners, F.col("tid")).select(key).distinct()
    mine = keyed(docs, F.xxhash64("text")).join(winners, key, "left_semi").dropDuplicates(key)
    return mine.select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    found = near_duplicates(docs, shingle, max_bits)
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")
