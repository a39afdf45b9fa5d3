"""MinHash near-duplicates by an LSH forest, confirmed on full sets.

A document's set holds the distinct shingles of ``SHINGLE`` lower-cased words.
Documents are linked when 100 * intersection >= 80 * union.

1. One scan gives every document its set size, a 128-bit digest of the set, a
   signature of ``TREES * DEPTH`` minima and a sketch (two low bits of each
   minimum). Equal sets form a class; everything below works on classes, so
   copies never meet each other.
2. Forest: ``TREES`` sorted orders, each over ``DEPTH`` minima of its own. In an
   order, classes with the longest common prefix stand next to each other. A
   region of equal prefix is taken at the least depth (from 2) at which it has at
   most ``REGION`` classes, and at full depth else, so sparse parts are searched
   more widely than dense ones. All classes of a region are candidates of each
   other; a region of any size is dealt out as a grid of block pairs.
3. Candidates whose sizes allow the similarity and whose sketches differ in at
   most ``MISMATCH`` minima are joined to families. Within a cell only a spanning
   set of these pairs is written.
4. Confirmation: the sets of the families' classes are read again from the
   texts. A family is compared within cells of bounded bytes, every candidate
   pair on its full sets, except pairs that confirmed links join already.
5. Components of the confirmed links give the groups.

Chance: a pair of similarity 0.8 shares no region at depth 4 in 32 orders with
probability 5e-8, and is beyond 48 of 128 mismatches with less than 4e-9;
greater similarities are safer still. Found links are exact (shingles are
compared by 64-bit hashes).

Defined results: null and empty texts and those without words have an empty
set and are linked with nothing; with fewer words than a shingle the whole
sequence is one shingle; texts of any length are read whole; repeated rows are
answered row by row; a component's id is its smallest non-null doc_id (null
when all are null, ``kept`` is then true); an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfold.llm.common import join_counted, materialize, mix64
from recfold.llm.simhash import components

SHINGLE, PERCENT = 2, 80
TREES, DEPTH = 32, 4
#: Classes of a region that are compared without going deeper.
REGION = 16
#: Classes of a region that a task compares at once.
BLOCK = 4_096
#: Differing minima (of TREES * DEPTH, by two bits each) up to which a pair stays a candidate.
MISMATCH = 48
#: Bytes of sets in one block of a family, and of text read at once.
SET_BYTES, PIECE_BYTES = 4 << 20, 256 << 10
#: Bits of the fixed-size filter for the second reading of the texts.
FILTER_BITS = 1 << 24

_N = TREES * DEPTH
_A = mix64(np.arange(1, _N + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix64(np.arange(1_001, _N + 1_001, dtype=np.uint64))
_C1, _C2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


# --------------------------------------------------------------------------
# sets
# --------------------------------------------------------------------------

def _pieces(col: pa.Array):
    sizes = np.cumsum(np.concatenate(([0], pc.binary_length(col).to_numpy(zero_copy_only=False))))
    i = 0
    while i < len(col):
        j = min(len(col), max(i + 1, int(np.searchsorted(sizes, sizes[i] + PIECE_BYTES, side="right")) - 1))
        yield i, col.slice(i, j - i)
        i = j


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE):
    """Distinct shingle hashes of every text, sorted: a flat array and the offsets of the texts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    enc = words.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in enc.dictionary.to_pylist()], np.uint64)
    code, row = enc.indices.to_numpy(zero_copy_only=False)[real], row[real]
    n = np.bincount(row, minlength=len(texts))
    k = np.minimum(n, shingle)[row]  # words of the shingles of a word's text
    first = np.cumsum(n) - n
    h = mix64(known[code]) if len(code) else np.zeros(0, np.uint64)
    out = h.copy()
    for d in range(1, shingle):
        has = np.flatnonzero(k > d)
        has = has[has + d < len(h)]
        out[has] = mix64(out[has] * _C1 + h[has + d] * _C2 + np.uint64(d))
    starts = np.arange(len(h)) - first[row] <= n[row] - k if len(h) else np.zeros(0, bool)
    out, row = out[starts], row[starts]
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.concatenate(([0], np.cumsum(np.bincount(row[new], minlength=len(texts)))))


def _minima(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, TREES * DEPTH) minima of the sets, none of which is empty."""
    best = np.full((len(off) - 1, _N), 0xFFFFFFFF, np.uint32)
    step = 1 << 15
    for a in range(0, len(flat), step):
        part = flat[a:a + step]
        lo = int(np.searchsorted(off, a, side="right")) - 1
        hi = int(np.searchsorted(off, a + len(part), side="left"))
        cut = np.maximum(off[lo:hi] - a, 0)
        for j in range(_N):
            v = ((part * _A[j] + _B[j]) >> np.uint64(32)).astype(np.uint32)
            best[lo:hi, j] = np.minimum(best[lo:hi, j], np.minimum.reduceat(v, cut))
    return best


def _sketch(minima: np.ndarray) -> np.ndarray:
    """Two planes of TREES * DEPTH bits: (texts, 4) words."""
    planes = [np.packbits((minima >> np.uint32(b)) & np.uint32(1), axis=1, bitorder="little").view("<u8") for b in (0, 1)]
    return np.concatenate(planes, axis=1)


def _digests(flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    raw = flat.tobytes()
    out = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return np.frombuffer(b"".join(out), "<i8").reshape(-1, 2)


def _text(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pc.fill_null(batch.column(batch.schema.names.index(name)).cast(pa.large_string()), "")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, rkey, n, hi, lo, trees, sketch) per document with words, without the last four else."""

    def work(batches):
        for b in batches:
            for i, col in _pieces(_text(b, "text")):
                flat, off = shingle_sets(col)
                n = np.diff(off)
                some = np.flatnonzero(n)
                dense = np.concatenate(([0], np.cumsum(n[some])))
                minima, digest = _minima(flat, dense), np.zeros((len(n), 2), np.int64)
                digest[some] = _digests(flat, dense)
                trees = minima.view(np.int32)
                place = np.full(len(n), -1, np.int64)
                place[some] = np.arange(len(some))
                take = pa.array(place, mask=place < 0)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * w, pa.int32()), pa.array(x.ravel())).take(take)
                         for x, w in ((trees, _N), (_sketch(minima).view(np.int64) if len(some) else np.zeros((0, 4), np.int64), 4))]
                part = b.slice(i, len(col))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n.astype(np.int64)), pa.array(digest[:, 0], mask=n == 0),
                                                  pa.array(digest[:, 1], mask=n == 0), *lists],
                                                 names=["doc_id", "rkey", "n", "hi", "lo", "trees", "sketch"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("rkey"), "text")
    return source.mapInArrow(work, "doc_id long, rkey long, n long, hi long, lo long, trees array<int>, sketch array<long>")


def _row_key():
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


# --------------------------------------------------------------------------
# the forest
# --------------------------------------------------------------------------

def _ordered(classes: DataFrame) -> DataFrame:
    """Rows (k2, v3 .., cid, n, s0..s3): every class in every order, ``k2`` standing for the order and its first two minima."""
    sketch = [F.col("sketch")[i].alias(f"s{i}") for i in range(4)]
    each = F.expr(f"transform(sequence(0, {TREES - 1}), t -> slice(trees, t * {DEPTH} + 1, {DEPTH}))")
    rows = classes.select("cid", F.col("n").cast("int").alias("n"), *sketch, F.posexplode(each).alias("tree", "v"))
    return rows.select(F.xxhash64("tree", F.col("v")[0], F.col("v")[1]).alias("k2"),
                       *[F.col("v")[d - 1].alias(f"v{d}") for d in range(3, DEPTH + 1)], "cid", "n", "s0", "s1", "s2", "s3")


def _keyed(rows: DataFrame, block: int) -> tuple[DataFrame, bool]:
    """Rows with the ``key`` by which they are shuffled and the number of blocks (``side``) of that key: the prefix of two
    minima, and for prefixes of more than a block of classes a longer one, which narrows the region, up to the full depth.
    Also whether any key has several blocks."""
    rows = rows.withColumns({"key": F.col("k2"), "side": F.lit(1)})
    for d in range(3, DEPTH + 2):
        sizes = rows.filter("side = 1") if d == 3 else rows.filter("side = 0")
        large = materialize(sizes.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > block), "large")
        if not large.head(1):
            break
        rows = rows.join(large, "key", "left")
        if d <= DEPTH:
            hot = F.col("size").isNotNull()
            rows = rows.withColumns({"key": F.when(hot, F.xxhash64("key", f"v{d}")).otherwise(F.col("key")),
                                     "side": F.when(hot, F.lit(0)).otherwise(F.lit(1))}).drop("size")
        else:
            return rows.withColumn("side", F.coalesce(F.ceil(F.col("size") / block), F.lit(1)).cast("int")).drop("size"), True
    return rows, False


def candidates(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Candidate pairs (a, b) of all regions, of regions beyond ``REGION`` a spanning set."""
    deeper = [f"v{d}" for d in range(3, DEPTH + 1)]
    rows, grid = _keyed(_ordered(classes), block)
    rest = [*deeper, "cid", "n", "s0", "s1", "s2", "s3"]
    if grid:
        rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("side")).cast("int"))
        cells = F.transform(F.sequence(F.lit(0), F.col("side") - 1),
                            lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
        rows = rows.select("key", F.explode(cells).alias("cell"), *rest)
        rows = rows.select("key", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), *rest)
    else:
        rows = rows.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), *rest)
    keys = ["key", "i", "j"]

    def search(batches):
        for x in _groups(batches, 3):
            start, size = regions(x[:, :3 + len(deeper)])
            got = [_spanning(x[a:a + n, -6:]) for a, n in zip(start[size > REGION].tolist(), size[size > REGION].tolist())]
            got += _diagonals(x[:, -6:], start, size)
            a, b = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    found = rows.repartition(*keys).sortWithinPartitions(*keys, *deeper).mapInArrow(search, "a long, b long")
    return found.distinct()


def regions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the regions of sorted rows (key, i, j, v3, ..): a run of equal prefix is divided by its next
    minimum as long as it is larger than ``REGION``."""
    new = np.ones(len(x), bool)
    new[1:] = (x[1:, :3] != x[:-1, :3]).any(axis=1)
    for c in range(3, x.shape[1]):
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(x)))
        differs = np.zeros(len(x), bool)
        differs[1:] = x[1:, c] != x[:-1, c]
        new |= differs & np.repeat(size > REGION, size)
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(x)))


def _diagonals(x: np.ndarray, start: np.ndarray, size: np.ndarray):
    """All candidate pairs of the small regions: every row with the one d places further on."""
    end = np.repeat(np.where(size <= REGION, start + size, 0), size)
    at, out = np.arange(len(x)), []
    for d in range(1, REGION):
        at = at[at + d < end[at]]
        if not len(at):
            break
        for k in range(0, len(at), 1 << 15):
            p = at[k:k + (1 << 15)]
            p = p[_alike(x[p, 1:], x[p + d, 1:])]
            out.append((x[p, 0], x[p + d, 0]))
    return out


def _groups(batches, keys: int):
    """Numeric rows of whole groups (equal first ``keys`` columns), batch by batch."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([np.asarray(c).astype(np.int64) for c in batch.columns], 1)
        if not len(rows):
            continue
        edge = np.flatnonzero((rows[1:, :keys] != rows[:-1, :keys]).any(axis=1))
        if held and (held[-1][-1, :keys] == rows[0, :keys]).all() and not len(edge):
            held.append(rows)
            continue
        last = edge[-1] + 1 if len(edge) else 0
        if last or held:
            whole = np.concatenate([*held, rows[:last]])
            if len(whole):
                yield whole
        held = [rows[last:]]
    if held:
        yield np.concatenate(held)


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows (n, s0..s3) may be linked: sizes within the similarity, few differing minima."""
    size = np.minimum(x[..., 0], y[..., 0]) * 100 >= PERCENT * np.maximum(x[..., 0], y[..., 0])
    d = (x[..., 1:3] ^ y[..., 1:3]) | (x[..., 3:5] ^ y[..., 3:5])
    return size & (np.bitwise_count(d.view(np.uint64)).sum(axis=-1) <= MISMATCH)


def _spanning(x: np.ndarray):
    """Spanning pairs of the candidates among the rows (cid, n, s0..s3) of a region: a search over what is not yet reached."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left = x
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            cur = front.pop()
            near = _alike(left[:, 1:], cur[None, 1:])
            if near.any():
                hit = left[near]
                a.append(np.full(len(hit), cur[0])), b.append(hit[:, 0])
                front.extend(hit)
                left = left[~near]
    return np.concatenate(a), np.concatenate(b)


# --------------------------------------------------------------------------
# confirmation on full sets
# --------------------------------------------------------------------------

def _row_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit table of the hashed row keys: of fixed size, a superset of the keys."""
    place = F.pmod(F.col("rkey"), F.lit(bits))
    rows = (keys.select((place % 32_768).cast("int").alias("p"), F.expr(f"pmod(rkey, {bits}) div 32768").alias("w"))
            .groupBy("w").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    table = np.zeros(bits // 8, np.uint8)
    for r in rows:
        table[r["w"] * 4096:(r["w"] + 1) * 4096] = np.frombuffer(r["m"], np.uint8)
    return table


def full_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(cid, set) of the members (cid, rkey, hi, lo): the texts are read a second time, all but the rows that may be one
    of these classes' are skipped by a bit table, and what passes is matched by its digest."""
    table = docs.sparkSession.sparkContext.broadcast(_row_filter(members))

    def work(batches):
        bits = table.value
        for b in batches:
            at = np.asarray(b.column(0)).astype(np.int64) % FILTER_BITS
            b = b.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for i, col in _pieces(_text(b, "text")):
                flat, off = shingle_sets(col)
                some = np.flatnonzero(np.diff(off))
                if not len(some):
                    continue
                edge = np.concatenate((off[some], off[-1:]))
                digest, raw = _digests(flat, edge), flat.tobytes()
                sets = [raw[8 * a:8 * z] for a, z in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, len(col)).take(pa.array(some)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(sets, pa.binary())],
                    names=["rkey", "hi", "lo", "set"])

    read = docs.select(_row_key().alias("rkey"), "text").mapInArrow(work, "rkey long, hi long, lo long, set binary")
    # repeated rows give the same set several times; one of them is enough
    read = read.groupBy("rkey", "hi", "lo").agg(F.first("set").alias("set"))
    return read.join(members, ["rkey", "hi", "lo"]).select("cid", "set")


def confirm(docs: DataFrame, classes: DataFrame, pairs: DataFrame, set_bytes: int = SET_BYTES) -> DataFrame:
    """Links (a, b) between classes that span the confirmed pairs of each family."""
    family = components(pairs)
    members = classes.join(family.select(F.col("node").alias("cid"), F.col("root").alias("family")), "cid")
    members = materialize(members.select("cid", "family", "n", "rkey", "hi", "lo", "sketch"), "members")
    sizes = members.groupBy("family").agg((F.sum("n") * 8).alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // set_bytes))
    sizes = sizes.select("family", F.greatest(F.lit(1), F.ceil(F.col("bytes") / set_bytes)).cast("int").alias("side"))
    rows = members.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("side")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("side") - 1),
                        lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    # a family of one block shares a bucket with others; a cell of a larger one has a bucket of its own
    bucket = F.when(F.col("side") == 1, F.pmod(F.xxhash64("family"), F.lit(buckets))).otherwise(-F.col("family") - 1)
    sets = full_sets(docs, members.select("cid", "rkey", "hi", "lo"))
    rows = rows.join(sets, "cid").select(bucket.alias("bucket"), F.explode(cells).alias("cell"), "family", "own", "cid", "n", "sketch", "set")
    rows = rows.select("bucket", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "family", "own", "cid", "n", "sketch", "set")
    return rows.groupBy("bucket", "i", "j").applyInArrow(_confirm_cell, "a long, b long")


def _confirm_cell(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    family, own, cid, n, i, j = (table.column(c).to_numpy().astype(np.int64) for c in ("family", "own", "cid", "n", "i", "j"))
    sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, 4)
    sets = table.column("set").combine_chunks()
    order = np.lexsort((cid, family))
    cut = np.concatenate(([0], np.flatnonzero(family[order][1:] != family[order][:-1]) + 1, [len(order)]))
    a, b = [], []
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
        of = order[s:e]
        side = own[of] if i[of[0]] != j[of[0]] else None
        for x, y in confirmed(n[of], sketch[of], [np.frombuffer(sets[int(k)].as_buffer(), "<u8") for k in of], side):
            a.append(cid[of[x]]), b.append(cid[of[y]])
    return pa.table({"a": pa.array(np.array(a, np.int64)), "b": pa.array(np.array(b, np.int64))})


def confirmed(n: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None):
    """Spanning confirmed pairs among sorted sets; with ``side`` only pairs of different sides. A pair that confirmed
    links already join is not compared."""
    k = len(sets)
    flat = np.concatenate(sets)
    off = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    _, flat = np.unique(flat, return_inverse=True)
    mark = np.zeros(int(flat.max(initial=0)) + 1, bool)
    rows = np.concatenate((n[:, None], sketch), axis=1)
    label = np.arange(k)
    for x in range(k - 1):
        rest = np.arange(x + 1, k)
        rest = rest[label[rest] != label[x]]
        if side is not None:
            rest = rest[side[rest] != side[x]]
        rest = rest[_alike(rows[rest], rows[x][None])]
        if not len(rest):
            continue
        mark[flat[off[x]:off[x + 1]]] = True
        size = n[rest]
        edge = np.cumsum(size) - size
        at = np.repeat(off[rest] - edge, size) + np.arange(int(size.sum()))
        both = np.add.reduceat(mark[flat[at]].astype(np.int64), edge)
        mark[flat[off[x]:off[x + 1]]] = False
        for y in rest[100 * both >= PERCENT * (n[x] + size - both)].tolist():
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                yield x, y


# --------------------------------------------------------------------------
# groups
# --------------------------------------------------------------------------

def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = docs.select("doc_id", "text")
    signed = materialize(signatures(docs), "signatures")
    classes = signed.filter("n > 0").groupBy("hi", "lo").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first"), F.min("rkey").alias("rkey"),
        F.first("n").alias("n"), F.first("trees").alias("trees"), F.first("sketch").alias("sketch"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    pairs = materialize(candidates(classes), "candidates")
    links = materialize(confirm(docs, classes, pairs), "links")
    roots = components(links)
    named = classes.join(roots, classes.cid == roots.node, "left").select("hi", "lo", "copies", "first", F.coalesce("root", "cid").alias("root"))
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(named.join(ids, "root").select("hi", "lo", "copies", "component_id"), "components")
    full = join_counted(signed.filter("n > 0").select("doc_id", "n", "hi", "lo"), named, ["hi", "lo"], "copies")
    full = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))


def report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
