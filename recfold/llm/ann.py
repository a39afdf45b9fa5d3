"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are centred, normalised, filled up with zeros to ``CODE_BITS``
dimensions (more, if they have more) and turned by a random rotation; the signs
of the turned coordinates are the code, packed to bits, kept with two correction
scalars: the distance to the centre and the inner product of the unit vector
with its code. A query is turned likewise and its coordinates rounded (at
random, without bias) to ``QUERY_BITS`` bits, so that its inner product with a
code is a few bit counts of packed words. Divided by the code's own inner
product c it estimates that of the vectors with a standard error of
``sqrt((1 - c^2) / c^2 / (D - 1))`` (D: code length) and that of the rounding;
``EPSILON`` times both together bound it for all but a few pairs. The bounds give each candidate a least and a most
cosine; candidates whose most reaches the k-th largest least are reranked by
exact cosines in double precision on the original vectors.

The centre is the mean of all vectors, the rotation is drawn from a seed.
Every vector is indexed; there is no cap on candidates. Equal vectors are one
entry with their k + 1 smallest ids, so thousands of copies cost one.

Search runs on a grid: queries in blocks, vectors in groups; a task holds one
block and one group (both of bounded size) and returns k rows per query. The
k best over the groups are chosen by a window that is limited before its shuffle.

Defined results: null vectors, vectors with a null or non-finite component,
all-zero ones and those of a length other than the most common one take no
part, neither as query nor as candidate; a row is no candidate of its own
query, but an equal vector under another id is; rows that repeat an id are one
candidate for each of their vectors; ties go to the smaller id; fewer
candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from recfold.llm.common import materialize

K = 5
QUERY_BITS = 4
CODE_BITS = 256
EPSILON = 2.0
SEED = 11
#: Rows of a block of queries and (about) of a group of vectors; pairs that a task estimates at once.
QUERY_BLOCK, VECTOR_GROUP, PAIRS = 2_048, 32_768, 1 << 22


def rotation(dims: int, seed: int = SEED, bits: int = CODE_BITS) -> np.ndarray:
    """The first ``dims`` rows of a random orthogonal matrix of the code's
    length, uniform over rotations and reflections."""
    size = max(bits, -(-dims // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:dims]


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """Packed codes (n, words), distances to the centre, own inner products."""
    rest = x - centre
    away = np.linalg.norm(rest, axis=1)
    unit = rest / np.maximum(away, 1e-300)[:, None]
    turned = unit @ turn
    bits = turned > 0
    own = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return _pack(bits), away, np.maximum(own, 1e-9)


def _pack(bits: np.ndarray) -> np.ndarray:
    pad = -bits.shape[-1] % 64
    bits = np.concatenate((bits, np.zeros((*bits.shape[:-1], pad), bool)), -1)
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


class Query:
    """A block of turned, rounded queries."""

    def __init__(self, q: np.ndarray, centre: np.ndarray, turn: np.ndarray, bits: int = QUERY_BITS, seed: int = SEED):
        rest = q - centre
        self.away = np.linalg.norm(rest, axis=1)
        turned = rest / np.maximum(self.away, 1e-300)[:, None] @ turn
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << bits) - 1), 1e-12)
        noise = np.random.default_rng(seed).random(turned.shape)
        whole = np.clip(np.floor((turned - self.low[:, None]) / self.step[:, None] + noise), 0, (1 << bits) - 1).astype(np.int64)
        self.total = whole.sum(axis=1)
        self.planes = [_pack((whole >> b & 1).astype(bool)) for b in range(bits)]
        self.dims = turned.shape[1]

    def products(self, codes: np.ndarray) -> np.ndarray:
        """Estimated inner products of unit queries with code vectors (queries, codes)."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        met = np.zeros((len(self.total), len(codes)))
        for b, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                met += np.bitwise_count(plane[:, w, None] & codes[None, :, w]) * float(1 << b)
        step, low = self.step[:, None], self.low[:, None]
        return (2 * step * met + 2 * low * ones - step * self.total[:, None] - self.dims * low) / np.sqrt(self.dims)


def bounds(query: Query, q: np.ndarray, codes, away, own, centre_dot, length, centre: np.ndarray,
           epsilon: float = EPSILON):
    """Least and most cosine of every (query, code) pair."""
    d = query.dims
    inner = query.products(codes) / own
    # of the code, and of the rounding of the query (each coordinate by at most a step, without bias)
    code, rounding = np.maximum(1 - own ** 2, 0) / max(d - 1, 1), query.step[:, None] ** 2 / 6
    error = epsilon * np.sqrt(code + rounding) / own
    scale = query.away[:, None] * away
    # <q, x> = <q - c, x - c> + <q, c> + <x, c> - <c, c>
    base = (q @ centre)[:, None] + centre_dot - centre @ centre
    norm = np.linalg.norm(q, axis=1)[:, None] * length
    slack = 1e-9
    return (scale * (inner - error) + base) / norm - slack, (scale * (inner + error) + base) / norm + slack


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col)
    real = F.transform(v, lambda x: F.coalesce(x.cast("double"), F.lit(float("nan"))))
    rows = vectors.filter(v.isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), real.alias("v"))
    fine = ~F.exists("v", lambda x: F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0.0)
    return rows.filter(fine)


def search(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
           group: int = VECTOR_GROUP, block: int = QUERY_BLOCK, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine of each row that
    ``is_query`` (a condition on ``id``) picks."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vec_col)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dims = sizes[0]["d"] if sizes else 1
    rows = materialize(rows.filter(F.size("v") == dims), "vectors")
    # -0.0 and 0.0 are the same component
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    nth = W.partitionBy("v").orderBy("id")
    entries = (rows.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = materialize(entries, "entries")
    n = entries.count()
    queries = rows.filter(is_query)
    n_queries = queries.count()
    if n == 0 or n_queries == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def partial_sum(batches):
        total, count = np.zeros(dims), 0
        for b in batches:
            x = _rows(b.column(0), dims)
            total, count = total + x.sum(axis=0), count + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total), pa.array(np.full(dims, count))], names=["i", "s", "n"])

    mean = np.zeros(dims)
    for r in entries.select("v").mapInArrow(partial_sum, "i long, s double, n long").groupBy("i").agg(
            (F.sum("s") / F.sum("n")).alias("m")).collect():
        mean[r["i"]] = r["m"]
    shared = spark.sparkContext.broadcast((mean, rotation(dims)))

    groups, blocks = -(-n // group), -(-n_queries // block)
    scatter = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    index = entries.select("v", "ids", scatter("v", groups).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    asked = queries.select("id", "v", scatter("id", blocks).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        centre, turn = shared.value
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            x, q = _rows(left.column("v"), dims), _rows(right.column("v"), dims)
            ids = left.column("ids").to_pylist()
            first = np.array([i[0] for i in ids])
            many = np.array([len(i) for i in ids])
            q_id = right.column("id").to_numpy()
            codes, away, own = encode(x, centre, turn)
            length, centre_dot = np.linalg.norm(x, axis=1), x @ centre
            step = max(1, PAIRS // len(x))
            for a in range(0, len(q), step):
                part, part_id = q[a:a + step], q_id[a:a + step]
                least, most = bounds(Query(part, centre, turn), part, codes, away, own, centre_dot, length, centre, epsilon)
                self_only = (many == 1) & (first == part_id[:, None])
                least[self_only] = most[self_only] = -np.inf
                kth = min(k, len(x)) - 1
                floor = -np.partition(-least, kth, axis=1)[:, kth] if len(x) > kth else np.full(len(part), -np.inf)
                for i in range(len(part)):
                    near = np.flatnonzero((most[i] >= floor[i]) & (most[i] > -np.inf))
                    score = (x[near] * part[i]).sum(axis=1) / (length[near] * np.sqrt((part[i] * part[i]).sum()))
                    found = []
                    for j in np.lexsort((first[near], -score)):
                        if len(found) >= k and score[j] < found[k - 1][0]:
                            break
                        found += [(float(score[j]), c) for c in ids[near[j]] if c != part_id[i]]
                    found.sort(key=lambda f: (-f[0], f[1]))
                    for s, c in found[:k]:
                        out[0].append(int(part_id[i])), out[1].append(c), out[2].append(s)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = index.groupBy("g", "b").cogroup(asked.groupBy("g", "b")).applyInArrow(cell, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rows(column, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def report(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("id") % 50 == 0)
