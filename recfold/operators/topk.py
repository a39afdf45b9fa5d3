"""Top-K recommendation.

``top_k`` scores every catalogue item for every requested user without ever
materialising the user x item pairs as rows, and without the driver: hashed
blocks of users meet hashed blocks of items in a grid, one cogroup per cell.
Inside a cell the items are ordered by a bound of their score and read tile by
tile (``mu + b_u + b_i + P Q^T`` per model, optionally blended); a tile is left
out for the users whose k-th score so far is above anything it can hold. Each
cell keeps k rows per user. The plan is the same for every size: a larger
catalogue has more item blocks, whose winners are merged by a
``row_number() <= k`` window (k rows per user and block, so bounded).

Ties are broken by ascending movie id, the reference's stable sort over an
ascending catalogue.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.operators.models import RatingModel, numpy_finish
from recfold.session import materialize

REC_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])
MANY_SCHEMA = T.StructType([T.StructField("component", T.IntegerType())] + REC_SCHEMA.fields)

#: Bytes that a task holds of one item block: the table, its sorted columns and the order of its tiles.
BLOCK_BYTES = 176 * 1024 * 1024
#: Bytes of one user block (terms, factors, seen items, kept lists), and fewest users where blocks are made for the sake of
#: parallel tasks. Items are sent once per user block, so blocks are as large as a task can hold if they have factors, and
#: smaller if an item is an id and a term: an executor keeps the memory of all its Python workers, busy or not.
USER_BYTES, PLAIN_USER_BYTES, USERS_LEAST = 256 * 1024 * 1024, 64 * 1024 * 1024, 128
#: Items of a tile, and users scored against it at once (8 MB of scores).
TILE_ITEMS, TILE_USERS = 1024, 1024
#: Room for rounding between a score and its bound.
SLACK = 1e-8


@dataclass
class Blend:
    """Weighted sum of model scores, then clip and round."""

    models: list
    weights: list
    lo: float | None = 1.0
    hi: float | None = 5.0
    digits: int | None = 9


@dataclass
class _Component:
    """What a cell needs to know of one model."""

    mu: float
    rank: int
    finish: tuple
    same_for_users: bool


@dataclass
class _List:
    """One ranked list: components with weights; ``finish`` of a blend, None for a single model."""

    parts: list
    finish: tuple | None


def _top_rows_finished(raw: np.ndarray, k: int, lo, hi, digits):
    """Top k of finish(raw) per row (ties by column) without finishing the
    whole block: finish (clip, round) is monotone, so every entry that can
    tie or beat the k-th after finishing lies within one rounding step of the
    k-th raw value, or anywhere when the k-th sits on the lower clip bound.
    Only those candidates are finished and ranked exactly."""
    B, n = raw.shape
    m = min(k, n)
    if m <= 0 or B == 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int32), np.empty(0))
    if m < n:
        kth = np.partition(raw, n - m, axis=1)[:, n - m]
        eps = 0.0 if digits is None else 2.0 * 10.0 ** (-digits)
        thr = kth.copy()
        if lo is not None:
            thr = np.minimum(thr, hi)
            thr = np.where(kth <= lo + eps, -np.inf, thr)
        rows, cols = np.nonzero(raw >= (thr - eps)[:, None])
    else:
        rows, cols = np.nonzero(np.ones_like(raw, dtype=bool))
    vals = numpy_finish(raw[rows, cols], lo, hi, digits)
    ok = np.isfinite(raw[rows, cols])
    rows, cols, vals = rows[ok], cols[ok], vals[ok]
    order = np.lexsort((cols, -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    starts = np.searchsorted(rows, np.arange(B))
    rank = np.arange(rows.shape[0]) - starts[rows] + 1
    keep = rank <= m
    return rows[keep], cols[keep], rank[keep].astype(np.int32), vals[keep]


def _matrix(column: pa.ChunkedArray, rank: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(-1, rank)


class _Cell:
    """One block of users against one block of items."""

    def __init__(self, left: pa.Table, right: pa.Table, components: list[_Component], k: int):
        self.k, self.components = k, components
        self.users = left["user_id"].to_numpy()
        ids = right["movie_id"].to_numpy()
        ascending = np.argsort(ids)
        self.items = ids[ascending]
        self.u = [c.mu + left[f"u{i}"].to_numpy() for i, c in enumerate(components)]
        self.i = [right[f"i{i}"].to_numpy()[ascending] for i, _ in enumerate(components)]
        self.p = [_matrix(left[f"p{i}"], c.rank) if c.rank else None for i, c in enumerate(components)]
        self.q = [_matrix(right[f"q{i}"], c.rank)[ascending] if c.rank else None for i, c in enumerate(components)]
        self.p_norm = [0.0 if m is None else np.linalg.norm(m, axis=1) for m in self.p]
        self.q_norm = [np.zeros(len(self.items)) if m is None else np.linalg.norm(m, axis=1) for m in self.q]
        # seen pairs as (user row, item position), users ascending
        lengths = pc.fill_null(pc.list_value_length(left["seen"]), 0).to_numpy()
        seen = pc.list_flatten(left["seen"]).to_numpy()
        rows = np.repeat(np.arange(len(self.users)), lengths)
        at = np.searchsorted(self.items, seen)
        known = at < len(self.items)
        rows, at, seen = rows[known], at[known], seen[known]
        hit = self.items[at] == seen
        self.seen = rows[hit], at[hit]

    def _score(self, part, rows, cols):
        c, weight, blended = part
        base = self.u[c][rows[:1] if blended and self.components[c].same_for_users and self.p[c] is None else rows][:, None] + self.i[c][cols]
        if self.p[c] is not None:
            base = base + self.p[c][rows] @ self.q[c][cols].T
        return weight * numpy_finish(base, *self.components[c].finish) if blended else base

    def _bound(self, ranked: _List, cols) -> np.ndarray:
        """Per user, a value that no finished score of the tile exceeds."""
        total = 0.0
        for c, weight, blended in ranked.parts:
            reach = self.p_norm[c] * self.q_norm[c][cols].max()
            x = (self.u[c] + self.i[c][cols].max() + reach + SLACK if weight >= 0
                 else self.u[c] + self.i[c][cols].min() - reach - SLACK)
            x = numpy_finish(x, *self.components[c].finish)
            total = total + (weight * x if blended else x)
        return (total if ranked.finish is None else numpy_finish(total + SLACK, *ranked.finish)) + SLACK

    def top(self, ranked: _List):
        """(user row, rank, item position, score) of the k best items of every user."""
        n, k = len(self.users), self.k
        finish = ranked.finish or self.components[ranked.parts[0][0]].finish
        worth = sum(w * (self.i[c] + self.q_norm[c] * np.mean(self.p_norm[c])) for c, w, _ in ranked.parts)
        order = np.argsort(-worth, kind="stable")
        del worth
        best = np.full((n, k), -np.inf)
        at = np.full((n, k), len(self.items))
        tile_of = np.empty(len(self.items), np.int64)
        tile_of[order] = np.arange(len(order)) // TILE_ITEMS
        seen_rows, seen_at = self.seen
        by_tile = np.argsort(tile_of[seen_at], kind="stable")  # rows stay ascending inside a tile
        ends = np.searchsorted(tile_of[seen_at][by_tile], np.arange(len(order) // TILE_ITEMS + 2))
        for t, start in enumerate(range(0, len(order), TILE_ITEMS)):
            cols = np.sort(order[start:start + TILE_ITEMS])  # ascending ids decide ties
            open_rows = np.nonzero(self._bound(ranked, cols) >= best[:, -1])[0]
            mine = by_tile[ends[t]:ends[t + 1]]
            for first in range(0, len(open_rows), TILE_USERS):
                rows = open_rows[first:first + TILE_USERS]
                total = 0.0
                for part in ranked.parts:
                    total = total + self._score(part, rows, cols)
                total = np.broadcast_to(total, (len(rows), len(cols))).copy()
                lo, hi = np.searchsorted(seen_rows[mine], (rows[0], rows[-1] + 1))
                hidden_rows, hidden_at = seen_rows[mine[lo:hi]], seen_at[mine[lo:hi]]
                row = np.searchsorted(rows, hidden_rows)
                held = rows[row] == hidden_rows
                total[row[held], np.searchsorted(cols, hidden_at[held])] = -np.inf
                r, c, rank, values = _top_rows_finished(total, k, *finish)
                new = np.full((len(rows), k), -np.inf)
                where = np.full((len(rows), k), len(self.items))
                new[r, rank - 1], where[r, rank - 1] = values, cols[c]
                new, where = np.hstack([best[rows], new]), np.hstack([at[rows], where])
                keep = np.lexsort((where, -new))[:, :k]
                best[rows], at[rows] = np.take_along_axis(new, keep, 1), np.take_along_axis(where, keep, 1)
        row, rank = np.nonzero(at < len(self.items))
        return row, rank + 1, at[row, rank], best[row, rank]


def _cell_ranker(components: list[_Component], lists: list[_List], k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            cell = _Cell(left, right, components, k)
            for number, ranked in enumerate(lists):
                row, rank, at, score = cell.top(ranked)
                out.append(pa.table({"component": pa.array(np.full(len(row), number), pa.int32()), "user_id": cell.users[row],
                                     "rank": pa.array(rank, pa.int32()), "movie_id": cell.items[at], "score": score}))
        empty = {"component": pa.int32(), "user_id": pa.int64(), "rank": pa.int32(), "movie_id": pa.int64(), "score": pa.float64()}
        return pa.concat_tables(out) if out else pa.schema(list(empty.items())).empty_table()
    return run


def _catalogue_items(models: list[RatingModel], catalogue: DataFrame) -> DataFrame:
    items = catalogue.select("movie_id").distinct()
    cols = ["movie_id"]
    for c, model in enumerate(models):
        i_fill = model._scalar(model.i_fill)
        if model.items is not None:
            sel = [F.col("movie_id"), F.col("i_term").alias(f"i{c}")]
            if model.rank > 0:
                sel.append(F.col("q").alias(f"q{c}"))
            items = items.join(model.items.select(*sel), "movie_id", "left")
            items = items.withColumn(f"i{c}", F.coalesce(F.col(f"i{c}"), i_fill))
        else:
            items = items.withColumn(f"i{c}", i_fill)
        cols.append(f"i{c}")
        if model.rank > 0:
            zero = F.array_repeat(F.lit(0.0), model.rank)
            items = items.withColumn(f"q{c}", F.coalesce(F.col(f"q{c}").cast("array<double>"), zero))
            cols.append(f"q{c}")
    return items.select(*cols)


def _user_rows(models: list[RatingModel], u: DataFrame, seen: DataFrame | None) -> DataFrame:
    cols = ["user_id"]
    for c, model in enumerate(models):
        u_fill = model._scalar(model.u_fill)
        if model.users is not None:
            sel = [F.col("user_id"), F.col("u_term").alias(f"u{c}")]
            if model.rank > 0:
                sel.append(F.col("p").alias(f"p{c}"))
            u = u.join(model.users.select(*sel), "user_id", "left")
            u = u.withColumn(f"u{c}", F.coalesce(F.col(f"u{c}"), u_fill))
        else:
            u = u.withColumn(f"u{c}", u_fill)
        cols.append(f"u{c}")
        if model.rank > 0:
            zero = F.array_repeat(F.lit(0.0), model.rank)
            u = u.withColumn(f"p{c}", F.coalesce(F.col(f"p{c}").cast("array<double>"), zero))
            cols.append(f"p{c}")
    if seen is not None:
        # a user's seen list is bounded by the catalogue
        lists = seen.where(F.col("movie_id").isNotNull()).groupBy("user_id").agg(F.collect_list("movie_id").alias("seen"))
        u = u.join(lists.withColumn("seen", F.col("seen").cast("array<bigint>")), "user_id", "left")
    else:
        u = u.withColumn("seen", F.lit(None).cast("array<bigint>"))
    cols.append("seen")
    return u.select(*cols)


def _grid(n_users: int, user_bytes: float, n_items: int, item_bytes: int, block_bytes: int, slots: int,
          most: int = USER_BYTES) -> tuple[int, int]:
    """Numbers of user blocks of at most ``most`` bytes and of item blocks."""
    item_blocks = max(1, -(-n_items * item_bytes // block_bytes))
    wanted = -(-2 * slots // item_blocks)
    return max(1, math.ceil(n_users * user_bytes / most), min(wanted, -(-n_users // USERS_LEAST))), item_blocks


def _block(col: str, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def top_k(model: RatingModel | Blend | list, users: DataFrame, catalogue: DataFrame,
          seen: DataFrame | None = None, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(user_id, rank, movie_id, score) for every user in
    ``users`` over the ``catalogue`` items. ``seen`` (user_id, movie_id) rows
    are excluded (T1); None keeps them (T2, model-level form). A list of
    models gives each model's own lists in one pass over the users, with a
    leading ``model`` column. Null ids take no part."""
    if k <= 0:
        raise ValueError("k must be positive")
    spark = users.sparkSession
    many = isinstance(model, (list, tuple))
    models = list(model.models) if isinstance(model, Blend) else list(model) if many else [model]
    # every model's global offset in one job (scalar subqueries of one row)
    mus = [m.mu.scalar().cast("double") if m.mu is not None else F.lit(0.0) for m in models]
    offsets = spark.range(1).select(*[c.alias(f"mu{i}") for i, c in enumerate(mus)]).first()
    components = [_Component(float(mu or 0.0), m.rank, m.finish_params(), m.users is None) for m, mu in zip(models, offsets)]
    if isinstance(model, Blend):
        lists = [_List([(c, float(w), True) for c, w in enumerate(model.weights)], (model.lo, model.hi, model.digits))]
    else:
        lists = [_List([(c, 1.0, False)], None) for c in range(len(models))]
    # written: the grid reads the items once per user block
    items = materialize(_catalogue_items(models, catalogue.where(F.col("movie_id").isNotNull())), "catalogue")
    asked = users.select(F.col("user_id").cast("bigint").alias("user_id")).where(F.col("user_id").isNotNull()).distinct()
    slots = spark.sparkContext.defaultParallelism
    terms = sum(1 + m.rank for m in models)
    width = 8 * (1 + terms)
    count = asked.count()
    # a user's vectors twice (rows and matrices), seen items as three numbers, best items and the lists given out
    user_bytes = 2 * width + k * (16 + 28 * len(lists)) + (24 * seen.count() / max(count, 1) if seen is not None else 0)
    # an item's columns as received, joined and in order, and its place among the tiles
    most = USER_BYTES if any(m.rank for m in models) else PLAIN_USER_BYTES
    n_users, n_items = _grid(count, user_bytes, items.count(), 64 + 24 * terms, block_bytes, slots, most)
    left = _user_rows(models, asked, seen).withColumn("_u", _block("user_id", n_users))
    left = left.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n_items - 1))))
    if n_items > 1:
        left = left.withColumn("seen", F.filter("seen", lambda m: F.pmod(F.xxhash64(m), F.lit(n_items)) == F.col("_i")))
    right = (items.withColumn("movie_id", F.col("movie_id").cast("bigint")).withColumn("_i", _block("movie_id", n_items))
             .withColumn("_u", F.explode(F.sequence(F.lit(0), F.lit(n_users - 1)))))
    # scoring is CPU-bound and its input small, so the number of tasks is given (AQE keeps it)
    tasks = min(2 * n_users * n_items, 20_000)
    cells = [side.repartition(tasks, "_u", "_i").groupBy("_u", "_i") for side in (left, right)]
    out = cells[0].cogroup(cells[1]).applyInArrow(_cell_ranker(components, lists, k), MANY_SCHEMA)
    if n_items > 1:  # the item blocks' winners
        best = Window.partitionBy("component", "user_id").orderBy(F.col("score").desc(), F.col("movie_id"))
        out = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if not many:
        return out.select("user_id", "rank", "movie_id", "score")
    names = F.element_at(F.array(*[F.lit(m.name) for m in models]), F.col("component") + 1)
    return out.select(names.alias("model"), "user_id", "rank", "movie_id", "score")


def rank_top(scored: DataFrame, k: int, score: str = "score",
             user: str = "user_id", item: str = "movie_id") -> DataFrame:
    """Relational top-K over scored candidates: row_number() <= k by score desc,
    item asc. Catalyst plans it as WindowGroupLimit (partial limit before the
    shuffle)."""
    w = Window.partitionBy(user).orderBy(F.col(score).desc(), F.col(item).asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select(user, F.col("rank").cast("int").alias("rank"), item, score))


def with_titles(recs: DataFrame, titles: DataFrame, missing: str = "Unknown") -> DataFrame:
    """Recommendation listing with title and year; a missing title shows
    ``missing`` and a missing year ``?``. The join to the title dimension is
    left to AQE, which broadcasts it when its measured size is small."""
    t = titles.select("movie_id", "title", "year")
    return (recs.join(t, "movie_id", "left")
            .select("user_id", "rank", "movie_id", "score",
                    F.coalesce(F.col("title"), F.lit(missing)).alias("title"),
                    F.coalesce(F.col("year").cast("string"), F.lit("?")).alias("year")))
