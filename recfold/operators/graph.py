"""Interaction matrix and bipartite-graph operators.

Embeddings come and go in long form (node, dim, val); inside a propagation a
row holds 16 dimensions of a node, and a layer is a grid of edge cells, each of
which meets the vectors of its targets. Nothing collects a node's neighbour list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash

_RANK_SHIFT = 16


def interactions(df: DataFrame, binarize: bool = False, user: str = "user_id",
                 item: str = "movie_id", value: str = "rating") -> DataFrame:
    """G1: (user, item, value) with duplicate pairs summed; ``binarize`` sets
    each input to 1 before summing (so a duplicated pair gives 2)."""
    v = F.lit(1.0) if binarize else F.col(value).cast("double")
    return df.groupBy(user, item).agg(F.sum(v).alias("value"))


def position_within(df: DataFrame, group: str, order: str,
                    shift: int = _RANK_SHIFT) -> DataFrame:
    """0-based position of ``order`` inside ``group`` (ascending), without a
    window over a whole group: values are bucketed (``order >> shift``), bucket
    sizes per group get a running sum and rows are numbered inside their
    (group, bucket), which holds at most 2^shift distinct values."""
    b = df.withColumn("_b", F.shiftright(F.col(order), shift))
    sizes = b.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    sizes = sizes.withColumn("_o", F.coalesce(F.sum("_c").over(
        Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    rn = F.row_number().over(Window.partitionBy(group, "_b").orderBy(order))
    return (b.join(sizes.select(group, "_b", "_o"), [group, "_b"])
            .withColumn("pos", (F.col("_o") + rn - 1).cast("bigint")).drop("_b", "_o"))


def neighbours(df: DataFrame, by: str = "user_id", other: str = "movie_id",
               value: str | None = "rating") -> DataFrame:
    """G2 long form: (by, pos, other[, value]) with neighbours in ascending id
    order; a point lookup is a filter on ``by``."""
    cols = [by, other] + ([value] if value else [])
    return position_within(df.select(*cols), by, other).select(by, "pos", *cols[1:])


def edges(df: DataFrame, n_users: Column | int, user: str = "user_idx",
          item: str = "movie_idx") -> DataFrame:
    """Bidirectional edge list (src, dst); item node = item index + n_users.
    Duplicate interactions stay as multi-edges."""
    off = F.lit(n_users) if isinstance(n_users, int) else n_users
    fwd = df.select(F.col(user).cast("bigint").alias("src"),
                    (F.col(item) + off).cast("bigint").alias("dst"))
    return fwd.unionByName(fwd.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def normalise(edge_df: DataFrame, binarize: bool = False) -> DataFrame:
    """Weight 1/sqrt(deg(src) * deg(dst)), degree = incident edge rows
    (multi-edges counted). ``binarize`` first keeps one edge per pair (the
    matrix form, R > 0)."""
    e = edge_df.select("src", "dst")
    if binarize:
        e = e.distinct()
    deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    ds = deg.select(F.col("src"), F.col("deg").alias("_ds"))
    dt = deg.select(F.col("src").alias("dst"), F.col("deg").alias("_dt"))
    w = e.join(ds, "src").join(dt, "dst")
    return w.select("src", "dst", (F.lit(1.0) / F.sqrt(F.col("_ds") * F.col("_dt"))).alias("weight"))


def to_long(vecs: DataFrame, node: str, emb: str = "emb", dims: int | None = None) -> DataFrame:
    """(node, ARRAY) -> (node, dim, val); ``dims`` keeps the first dims only."""
    e = F.col(emb).cast("array<double>")
    if dims is not None:
        e = F.slice(e, 1, dims)
    return vecs.select(F.col(node).cast("bigint").alias("node"),
                       F.posexplode(e).alias("dim", "val"))


#: Dimensions in one row of a propagation. More sums in one aggregate make a
#: generated method that the JVM does not compile.
BLOCK = 16
_COLS = [f"v{k}" for k in range(BLOCK)]
#: Edges of one cell of a layer's grid, and bytes of the vectors it meets.
CELL_EDGES, CELL_BYTES = 6_000_000, 128 << 20
#: Bytes of the sums that a cell returns, and of what one job of a layer shuffles.
SUM_BYTES, JOB_BYTES = 160 << 20, 12 << 30
#: Bytes of a shuffled vector of one block, of an edge and of a pair.
_VEC_BYTES, _EDGE_BYTES, _PAIR_ROW_BYTES = 8 * (BLOCK + 3), 40, 64
#: Bytes of one side's vectors in a cell of pairs.
PAIR_BYTES = 96 << 20


def _blocks(long_df: DataFrame) -> DataFrame:
    """(node, dim, val) -> (node, blk, v0..v15), absent entries 0."""
    at = F.col("dim") % BLOCK
    return long_df.groupBy("node", F.floor(F.col("dim") / BLOCK).cast("int").alias("blk")).agg(
        *[F.sum(F.when(at == k, F.col("val")).otherwise(0.0)).alias(c) for k, c in enumerate(_COLS)])


def _array_blocks(vecs: DataFrame) -> DataFrame:
    """(node, emb ARRAY) -> (node, blk, v0..v15) row by row, without a shuffle;
    missing and null entries 0, empty and null arrays have no block."""
    e = F.col("emb").cast("array<double>")
    last = F.floor((F.size("emb") - 1) / BLOCK).cast("int")
    cut = vecs.where(F.size("emb") > 0).select("node", e.alias("emb"), F.explode(F.sequence(F.lit(0), last)).alias("blk"))
    return cut.select("node", "blk", *[F.coalesce(F.get("emb", F.col("blk") * BLOCK + k), F.lit(0.0)).alias(c)
                                       for k, c in enumerate(_COLS)])


def _cell_sums(edges: pa.Table, vecs: pa.Table) -> pa.Table:
    """Weighted sums over the edges of one cell for one block of dimensions:
    (node, blk, v0..v15) per source that has an edge to one of the vectors."""
    schema = pa.schema([("node", pa.int64()), ("blk", pa.int32())] + [(c, pa.float64()) for c in _COLS])
    known = vecs["node"].combine_chunks().dictionary_encode()
    at = pc.index_in(edges["node"], value_set=known.dictionary)
    met = pc.and_(pc.is_valid(at), pc.is_valid(edges["node"]))
    at, weight, src = (x.filter(met).combine_chunks() for x in (at, edges["weight"], edges["src"]))
    if not len(at):
        return schema.empty_table()
    ends = src.dictionary_encode(null_encoding="encode")
    at, to, weight = at.to_numpy(), ends.indices.to_numpy(), weight.fill_null(0.0).to_numpy()
    row, n = known.indices.fill_null(-1).to_numpy() + 1, len(ends.dictionary)  # row 0: vectors of a null node
    sums = []
    for c in _COLS:
        x = np.bincount(row, weights=vecs[c].fill_null(0.0).to_numpy(), minlength=len(known.dictionary) + 1)[1:]
        sums.append(pa.array(np.bincount(to, weights=weight * x[at], minlength=n)))
    blk = pa.array(np.full(n, vecs["blk"][0].as_py(), np.int32))
    out = pa.Table.from_arrays([ends.dictionary, blk, *sums], schema=schema)
    return pa.Table.from_batches(out.to_batches(max_chunksize=65_536), schema)  # few rows at once go to the JVM


def _grid(n_nodes: int, n_edges: int, n_blocks: int, slots: int, n_sources: int) -> tuple[int, int]:
    """Numbers of groups of edge sources and of vector nodes: a cell's vectors,
    edges and sums stay within bounds, and there is a cell for every slot."""
    cols = max(1, -(-n_nodes * 8 * (BLOCK + 1) // CELL_BYTES))
    return max(1, -(-n_edges // (cols * CELL_EDGES)), -(-slots // (cols * max(n_blocks, 1))),
               -(-n_sources * 8 * (BLOCK + 1) // SUM_BYTES)), cols


def _jobs(n_nodes: int, n_edges: int, n_sources: int, rows: int, cols: int, n_blocks: int) -> tuple[list[range], list[range]]:
    """Blocks and groups of sources in the runs of both that one job computes: all, unless it would shuffle more than
    ``JOB_BYTES``; then fewer blocks, and if one block is too much, fewer groups of sources. A group's edges, vectors and
    sums lie on the disks at once."""
    group = _VEC_BYTES * (n_nodes + cols * n_sources // rows) + _EDGE_BYTES * n_edges // rows
    at_once = [min(n, max(1, int(JOB_BYTES // max(1, x)))) for n, x in ((n_blocks, rows * group), (rows, group))]
    return tuple([range(a, min(a + k, n)) for a in range(0, n, k)] for n, k in zip((n_blocks, rows), at_once))


def _layer(w: DataFrame, cur: DataFrame, rows: int, cols: int, blocks: range, some: range | None = None) -> DataFrame:
    """A_hat times (node, blk, v0..v15) of the ``blocks``; for ``some`` groups of sources only, if given."""
    some = range(rows) if some is None else some

    def group(c: str, n: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = (w.where(F.col("node").isNotNull())
            .select("src", "node", "weight", group("src", rows).alias("_r"), group("node", cols).alias("_c"))
            .where(F.col("_r").between(some.start, some.stop - 1))
            .withColumn("blk", F.explode(F.sequence(F.lit(blocks.start), F.lit(blocks.stop - 1)))))
    right = cur.withColumn("_c", group("node", cols)).withColumn("_r", F.explode(F.sequence(F.lit(some.start), F.lit(some.stop - 1))))
    tasks = min(4 * len(some) * cols * len(blocks), 20_000)  # several, as cells that hash alike share a task
    cells = [x.repartition(tasks, "_r", "_c", "blk").groupBy("_r", "_c", "blk") for x in (left, right)]
    out = cells[0].cogroup(cells[1]).applyInArrow(
        _cell_sums, "node long, blk int, " + ", ".join(f"{c} double" for c in _COLS))
    return out if cols == 1 else out.groupBy("node", "blk").agg(*[F.sum(c).alias(c) for c in _COLS])


def neighbour_sums(weighted: DataFrame, vectors: DataFrame) -> DataFrame:
    """(src, blk, v0..v15): per source, the weighted sum of the vectors (node, emb ARRAY or dim, val) of its rows
    (src, node, weight), by one layer's grid. Sources without a vector have no row; entries beyond a vector's end are 0."""
    from recfold.session import materialize
    w = materialize(weighted.select(F.col("src").cast("bigint").alias("src"), F.col("node").cast("bigint").alias("node"),
                                    F.col("weight").cast("double").alias("weight")).where(F.col("src").isNotNull()), "edges")
    cur = _array_blocks(vectors) if "emb" in vectors.columns else _blocks(vectors.select("node", "dim", "val"))
    cur = materialize(cur.withColumn("node", F.col("node").cast("bigint")), "layer")
    last = cur.agg(F.max("blk")).first()[0]
    n_blocks = 0 if last is None else last + 1
    slots = cur.sparkSession.sparkContext.defaultParallelism
    n_edges, sources = w.agg(F.count(F.lit(1)), F.approx_count_distinct("src")).first()
    rows, cols = _grid(-(-cur.count() // max(n_blocks, 1)), n_edges, n_blocks, slots if n_edges > CELL_EDGES // 60 else 1, sources)
    return _layer(w, cur, rows, cols, range(max(n_blocks, 1))).withColumnRenamed("node", "src")


def propagate_blocks(weighted_edges: DataFrame, emb0: DataFrame, layers: int = 3,
                     materialize: bool = True, inputs_written: bool = False) -> tuple[DataFrame, int]:
    """G5 in blocks: ((node, blk, v0..v15), number of dimensions)."""
    from recfold.session import discard
    from recfold.session import materialize as write_table
    w = weighted_edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("node"),
                              F.col("weight").cast("double").alias("weight"))
    arrays = "emb" in emb0.columns
    cur = _array_blocks(emb0) if arrays else _blocks(emb0.select("node", "dim", "val"))
    cur = cur.withColumn("node", F.col("node").cast("bigint"))
    if materialize:
        cur = write_table(cur, "layer")
        w = w if inputs_written else write_table(w, "edges")
    last = emb0.agg(F.max(F.size("emb") - 1 if arrays else F.col("dim"))).first()[0]
    n_dims = 0 if last is None else last + 1
    if n_dims <= 0:
        return _mean_of_layers(cur, layers), n_dims
    n_blocks = -(-n_dims // BLOCK)
    n_edges, ends = w.agg(F.count(F.lit(1)), F.approx_count_distinct("src")).first()
    slots = cur.sparkSession.sparkContext.defaultParallelism if n_edges > CELL_EDGES // 60 else 1
    n_nodes = max(ends, -(-cur.count() // n_blocks))
    rows, cols = _grid(n_nodes, n_edges, n_blocks, slots, ends)
    runs, parts = _jobs(n_nodes, n_edges, ends, rows, cols, n_blocks) if materialize else ([range(n_blocks)], [range(rows)])
    out = None
    for blocks in runs:
        now = first = cur if len(runs) == 1 else cur.where(F.col("blk").between(blocks.start, blocks.stop - 1))
        acc, written = first, []
        for _ in range(layers):
            made = None
            for some in parts:
                part = _layer(w, now, rows, cols, blocks, some)
                if materialize:
                    part = write_table(part, "layer")
                    written.append(part)
                made = part if made is None else made.unionByName(part)
            now, acc = made, acc.unionByName(made)
        mean = _mean_of_layers(acc, layers)
        if len(runs) > 1:  # a run's layers go before the next run's come
            mean = write_table(mean, "mean")
            for table in written:
                discard(table)
        out = mean if out is None else out.unionByName(mean)
    return out, n_dims


def _mean_of_layers(acc: DataFrame, layers: int) -> DataFrame:
    # by node alone, so that a node's blocks can be put together without another shuffle
    return acc.repartition("node").groupBy("node", "blk").agg(*[(F.sum(c) / F.lit(float(layers + 1))).alias(c) for c in _COLS])


def block_arrays(blocks: DataFrame, n_dims: int) -> DataFrame:
    """(node, blk, v0..v15) -> (node, emb ARRAY<DOUBLE>) of ``n_dims`` numbers; absent blocks 0."""
    held = blocks.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("blk", F.array(*_COLS)))).alias("m"))
    parts = [F.coalesce(F.col("m")[k], F.array_repeat(F.lit(0.0), BLOCK)) for k in range(-(-n_dims // BLOCK))]
    emb = F.slice(F.concat(*parts), 1, n_dims) if parts else F.array().cast("array<double>")
    return held.select("node", emb.alias("emb"))


def propagate(weighted_edges: DataFrame, emb0: DataFrame, layers: int = 3,
              materialize: bool = True, inputs_written: bool = False) -> DataFrame:
    """E(k) = A_hat E(k-1); final = sum of layers 0..L / (L+1) per (node,
    dim). An isolated node keeps only its layer-0 row, hence sum / (L+1).

    A layer is a grid: edges are dealt by hashes of their two ends into cells,
    and a cell meets the vectors of its targets, 16 dimensions at a time, and
    returns one sum per source. So an edge never becomes a row with a vector:
    what is shuffled is the edge list once per 16 dimensions, and every vector
    once per row of the grid. A hub's edges are summed in several cells.
    ``emb0`` is (node, emb ARRAY), which is cut into blocks where it is read,
    or (node, dim, val), which is grouped into them.

    With ``materialize`` the weighted edges and every layer are written as
    Parquet to the session's checkpoint folder: each layer is computed once,
    the plan of layer k does not contain layers 0..k-1, and a lost executor
    only recomputes the current layer. ``inputs_written`` says the edges
    already are such a table (training loops)."""
    out, n_dims = propagate_blocks(weighted_edges, emb0, layers, materialize, inputs_written)
    return (out.select("node", "blk", F.posexplode(F.array(*_COLS)).alias("k", "val"))
            .select("node", (F.col("blk") * BLOCK + F.col("k")).cast("int").alias("dim"), "val")
            .where(F.col("dim") < n_dims))


def _nth_unseen(draws: DataFrame, seen: DataFrame) -> DataFrame:
    """(u, i, neg): the ``j``-th (from 0) item that ``u`` has not seen, by ascending
    id. The r-th seen item s leaves s - r unseen ones below it, so neg is j plus
    the number of seen items with s - r <= j: a running count over both, sorted
    together per user (at most twice a user's items)."""
    pos = F.row_number().over(Window.partitionBy("u").orderBy("s")) - 1
    marks = seen.select("u", F.lit(None).cast("bigint").alias("i"), (F.col("s") - pos).alias("at"), F.lit(0).alias("kind"))
    asks = draws.select("u", "i", F.col("j").alias("at"), F.lit(1).alias("kind"))
    run = Window.partitionBy("u").orderBy("at", "kind").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = marks.unionByName(asks).withColumn("below", F.sum(F.lit(1) - F.col("kind")).over(run))
    return both.where("kind = 1").select("u", "i", (F.col("at") + F.col("below")).alias("neg"))


def sample_negatives(pos: DataFrame, n_items: int, seed: int = 42, reject: str = "all",
                     user: str = "user_id", item: str = "movie_id") -> DataFrame:
    """One negative item in [0, n_items) per positive row, drawn without
    rejection rounds, so it is found whenever there is one.

    With h = hash(user, item): ``reject='all'`` takes the (h mod n)-th of the n
    items the user never interacted with; ``reject='same'`` the (h mod
    (n_items - 1))-th item other than the positive. Null only if there is no
    such item."""
    pairs = pos.select(F.col(user).cast("bigint").alias("u"), F.col(item).cast("bigint").alias("i")).distinct()
    h = portable_hash("u", "i", seed)
    if reject == "all":
        seen = pairs.where((F.col("i") >= 0) & (F.col("i") < n_items)).select("u", F.col("i").alias("s"))
        left = seen.groupBy("u").agg((F.lit(n_items) - F.count(F.lit(1))).alias("n"))
        open_ = pairs.join(left, "u", "left").withColumn("n", F.coalesce("n", F.lit(n_items).cast("bigint")))
        found = _nth_unseen(open_.where("n > 0").select("u", "i", (h % F.col("n")).alias("j")), seen)
    else:
        j = h % max(n_items - 1, 1)
        found = pairs.select("u", "i", (j + F.when(j >= F.col("i"), 1).otherwise(0)).alias("neg"))
        found = found if n_items > 1 else found.where(F.lit(False))
    return pos.join(found.select(F.col("u").alias(user), F.col("i").alias(item), "neg"), [user, item], "left")


def _arrays(long_df: DataFrame) -> DataFrame:
    """(node, dim, val) -> (node, emb): entries at their dims, absent ones 0."""
    last = long_df.agg(F.max("dim")).first()[0]
    return block_arrays(_blocks(long_df), 0 if last is None else last + 1)


def _cell_dots(left: str, right: str, columns: list[str]):
    def dots(pairs: pa.Table, vecs: pa.Table) -> pa.Table:
        sides = []
        for name, kind in ((left, 0), (right, 1)):
            mine = vecs.filter(pc.equal(vecs["kind"], kind))
            emb = mine["emb"].combine_chunks()
            at = pc.index_in(pairs[name], value_set=mine["node"].combine_chunks())
            sides.append((at, pc.list_flatten(emb).to_numpy().reshape(len(emb), len(emb[0]) if len(emb) else 0)))
        met = pc.and_(pc.is_valid(sides[0][0]), pc.is_valid(sides[1][0]))
        kept = pairs.select(columns).filter(met)
        (i, a), (j, b) = ((at.filter(met).to_numpy(), x) for at, x in sides)
        out = np.empty(kept.num_rows)
        for k in range(0, len(out), 65_536):
            some = slice(k, k + 65_536)
            out[some] = np.einsum("ij,ij->i", a[i[some]], b[j[some]])
        return kept.append_column("dot", pa.array(out))
    return dots


def pair_dots(pairs: DataFrame, vectors: DataFrame, left: str, right: str) -> DataFrame:
    """``pairs`` with ``dot``, the inner product of the vectors (node, emb; one
    length, a row per node) that its columns ``left`` and ``right`` name; pairs
    with an unknown node are left out. Pairs are dealt by hashes of both ends
    into a grid of cells, and a cell gets the vectors of its two groups of
    nodes, so no pair carries a vector through a shuffle. A grid that would
    shuffle more than ``JOB_BYTES`` is computed by some of its rows at a time."""
    from recfold.session import materialize
    vectors = materialize(vectors.where(F.col("node").isNotNull()), "vectors")
    spark = vectors.sparkSession
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("emb"))).first()
    ends = pairs.agg(F.approx_count_distinct(left), F.approx_count_distinct(right)).first()
    groups = [max(1, -(-min(n, int(1.2 * x) + 1) * 8 * (1 + (width or 0)) // PAIR_BYTES)) for x in ends]
    groups[0] = max(groups[0], -(-spark.sparkContext.defaultParallelism // groups[1]))

    def dealt(c: str, k: int) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(groups[k])).cast("int")

    columns = pairs.columns
    # what lies on the disks per group of left ends: their vectors for every right group, all right ones once, the pairs
    sizes = [min(n, int(1.2 * x) + 1) * 8 * (6 + (width or 0)) for x in ends]
    held = -(-sizes[0] // groups[0]) * groups[1] + sizes[1] + -(-pairs.count() // groups[0]) * _PAIR_ROW_BYTES
    step = max(1, min(groups[0], JOB_BYTES // max(1, held)))
    a = pairs.withColumn("_l", dealt(left, 0)).withColumn("_r", dealt(right, 1))
    named = []
    for name in (left, right):
        side = vectors.join(pairs.select(F.col(name).cast("bigint").alias("node")).distinct(), "node", "left_semi")
        named.append(side if step >= groups[0] else materialize(side, "named"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields] + ["dot double"])

    def job(start: int, stop: int) -> DataFrame:
        """The pairs of some groups of left ends."""
        mine = named[0].withColumn("kind", F.lit(0)).withColumn("_l", dealt("node", 0)).where(F.col("_l").between(start, stop - 1)).withColumn(
            "_r", F.explode(F.sequence(F.lit(0), F.lit(groups[1] - 1))))
        other = named[1].withColumn("kind", F.lit(1)).withColumn("_r", dealt("node", 1)).withColumn(
            "_l", F.explode(F.sequence(F.lit(start), F.lit(stop - 1))))
        tasks = min(2 * (stop - start) * groups[1], 20_000)
        some = a.where(F.col("_l").between(start, stop - 1))
        cells = [x.repartition(tasks, "_l", "_r").groupBy("_l", "_r") for x in (some, mine.unionByName(other))]
        return cells[0].cogroup(cells[1]).applyInArrow(_cell_dots(left, right, columns), schema)

    if step >= groups[0]:
        return job(0, groups[0])
    out = None
    for k in range(0, groups[0], step):
        part = materialize(job(k, min(k + step, groups[0])), "dots")
        out = part if out is None else out.unionByName(part)
    return out


def bpr_loss(triples: DataFrame, final_emb: DataFrame, emb0: DataFrame, reg: float = 1e-4,
             variant: str = "module") -> DataFrame:
    """G8 over triples (user, pos, neg) of node ids and long embeddings
    (``final_emb`` may be (node, emb) instead).

    module: -mean(logsigmoid(s_pos - s_neg)) + reg * (sum of squared layer-0
    norms of u, pos, neg) / (2B); script: -mean(log(sigmoid(x) + 1e-10)) and
    no factor 2."""
    # distinct triples with their multiplicity: a deterministic key for the
    # per-triple dot products (no generated row ids), written as it is read twice
    from recfold.session import materialize
    t = materialize(triples.groupBy(F.col("user").alias("u"), F.col("pos").alias("p"),
                                    F.col("neg").alias("n")).agg(F.count(F.lit(1)).alias("w")), "triples")
    sides = F.explode(F.array(F.struct(F.col("p").alias("i"), F.lit(1.0).alias("sign")),
                              F.struct(F.col("n").alias("i"), F.lit(-1.0).alias("sign"))))
    final = final_emb if "emb" in final_emb.columns else _arrays(final_emb)
    dots = pair_dots(t.withColumn("s", sides).select("u", "p", "n", "w", "s.i", "s.sign"), final, "u", "i")
    s = (dots.groupBy("u", "p", "n", "w").agg(F.sum(F.col("sign") * F.col("dot")).alias("x"), F.count(F.lit(1)).alias("_both"))
         .where("_both = 2"))
    x = F.col("x")
    if variant == "module":
        term = F.least(x, F.lit(0.0)) - F.log(F.lit(1.0) + F.exp(-F.abs(x)))
    else:
        term = F.log(F.lit(1.0) / (F.lit(1.0) + F.exp(-x)) + F.lit(1e-10))
    loss = s.agg((F.sum(term * F.col("w")) / F.sum("w")).alias("m"), F.sum("w").alias("b"))
    sq = emb0.groupBy("node").agg(F.sum(F.col("val") * F.col("val")).alias("sq"))
    l2 = (t.join(sq.select(F.col("node").alias("u"), F.col("sq").alias("a")), "u")
          .join(sq.select(F.col("node").alias("p"), F.col("sq").alias("b2")), "p")
          .join(sq.select(F.col("node").alias("n"), F.col("sq").alias("c")), "n")
          .agg(F.sum((F.col("a") + F.col("b2") + F.col("c")) * F.col("w")).alias("l2")))
    denom = 2.0 if variant == "module" else 1.0
    return loss.select(
        (-F.col("m") + F.lit(float(reg)) * l2.select("l2").scalar() / (F.lit(denom) * F.col("b")))
        .alias("loss"), F.col("b").alias("n_triples"))
