"""Spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: exactly then the lengths of their common prefix and common
suffix add up to at least the longer length minus one. Blocks of words are
held as padded code-point matrices and compared pair by pair, one column at a
time from both ends.

Only tiles that can hold a pair are built. With ``L`` the longer length, a near
pair has either its first ``ceil((L - 1) / 2)`` code points in common or its last
``floor((L - 1) / 2) + 1``. So every word is filed under its prefix and its
suffix of these lengths, once as the longer (or an equal) and once as the
shorter word of a pair, and tiles are taken within one key. The suffix keys
leave out pairs whose prefix is long enough, so each pair is counted once. A
key with many words is dealt out as a grid of block pairs. A task keeps per
word the number of near words and the best of them, never the pairs.

A word's form is its most frequent near word if that is ``RATIO`` times as
frequent. Counts grow along forms, so these links have no cycle; roots are found
by pointer doubling over tables in the shared folder.

Defined results: null and empty texts have no words; a null doc_id counts as
an empty text in the damage rule; texts and words of any length are taken
whole; repeated rows count each; ties go to the word that is smallest in
code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfold.llm.common import materialize

WORD = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO, DAMAGE = 6, 5, 5, 199
#: Words of one key that a task compares at once, and rows of a tile.
BLOCK, TILE = 4_096, 512
#: Keys with at most so many words are compared together, by distance in the sorted order.
SMALL = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(doc_id: Column, run: Column, every: int = DAMAGE) -> Column:
    """The run without code point ``h % length`` where ``every`` divides h, the
    crc32 of ``<doc_id>:<run>``; else the run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run))))\
        .otherwise(run)


def vocabulary(docs: DataFrame, every: int = DAMAGE, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words (word, n) after damage that are long and frequent enough, over all
    texts; counts are summed in the tasks before the shuffle."""
    lower = F.translate(F.col(text_col), UPPER, LOWER)
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))).alias("run"))
    words = runs.select(damaged(F.col("id"), F.col("run"), every).alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# --------------------------------------------------------------------------
# tiles
# --------------------------------------------------------------------------

def code_points(words: list[str], width: int) -> np.ndarray:
    """Padded matrix of code points, one row per word (all code points are below 256)."""
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("latin-1"), np.uint8)
    return flat.reshape(len(words), width)


class _Best:
    """Number of near words and the best of them, per word of a task's table."""

    def __init__(self, n: np.ndarray, rank: np.ndarray):
        # a greater value is a better near word: more frequent, then smaller in code-point order
        order = np.lexsort((-rank, n))
        self.value = np.empty(len(n), np.int64)
        self.value[order] = np.arange(len(n))
        self.word = order
        self.count, self.best = np.zeros(len(n), np.int64), np.full(len(n), -1, np.int64)

    def add(self, a: np.ndarray, b: np.ndarray):
        for x, y in ((a, b), (b, a)):
            self.count += np.bincount(x, minlength=len(self.count))
            np.maximum.at(self.best, x, self.value[y])


def near_rows(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, tail: bool, head: int) -> np.ndarray:
    """Which rows of two code-point matrices of equal shape are near; for suffix keys (``tail``) without those that
    share ``head`` code points at the front. Matrices of a suffix key are padded in front."""
    longer = np.maximum(size_a, size_b)
    same = a == b
    width = a.shape[1]
    prefix, suffix = _common(a, b, size_a, size_b, same, width, tail)
    ok = (prefix + suffix >= longer - 1) & (longer == width)
    return ok & (prefix < head) if tail else ok


def _common(a, b, size_a, size_b, same, width, tail):
    """Lengths of the common prefix and suffix of rows, for pairs whose longer word fills the width. For the end at which
    a shorter word is padded, that word is moved by one column."""
    shift = size_a - size_b

    def run(eq):
        return np.where(eq.all(axis=1), width, np.argmin(eq, axis=1))

    def moved(x):
        out = np.zeros_like(x)
        if tail:
            out[:, :-1] = x[:, 1:]
        else:
            out[:, 1:] = x[:, :-1]
        return out

    a2 = np.where((shift < 0)[:, None], moved(a), a)
    b2 = np.where((shift > 0)[:, None], moved(b), b)
    other = a2 == b2
    front, back = (other, same) if tail else (same, other)
    shorter = np.minimum(size_a, size_b)
    return np.minimum(run(front), shorter), np.minimum(run(back[:, ::-1]), shorter)


def _tile(m: np.ndarray, size: np.ndarray, rows: np.ndarray, cols: np.ndarray, tail: bool, head: int):
    """Near pairs (row, column) of one tile, by running prefix and suffix lengths over the columns."""
    width = m.shape[1]
    a, b = m[rows], m[cols]
    sa, sb = size[rows], size[cols]
    shape = (len(rows), len(cols))
    ends = []
    for from_back in (False, True):
        aligned = from_back == tail
        alive, length = np.ones(shape, bool), np.zeros(shape, np.int32)
        at_a, at_b = (np.zeros(len(rows), np.int64), np.zeros(len(cols), np.int64)) if aligned else (
            (width - sa), (width - sb))  # an end that is padded starts inside by the word's padding
        for c in range(width):
            x, y = np.minimum(at_a + c, width - 1), np.minimum(at_b + c, width - 1)
            left = a[np.arange(len(rows)), (width - 1 - x) if from_back else x]
            right = b[np.arange(len(cols)), (width - 1 - y) if from_back else y]
            alive &= (left[:, None] == right[None, :]) & (c < np.minimum(sa[:, None], sb[None, :]))
            if not alive.any():
                break
            length += alive
        ends.append(length)
    longer = np.maximum(sa[:, None], sb[None, :])
    ok = (ends[0] + ends[1] >= longer - 1) & (longer == width)
    if tail:
        ok &= ends[0] < head
    i, j = np.nonzero(ok)
    return rows[i], cols[j]


def _compare(table: pa.Table) -> pa.Table:
    """Partial results of one bucket of keys: all its (key, cell) groups, each a block or a pair of blocks."""
    table = table.combine_chunks()
    enc = table.column("word").combine_chunks().dictionary_encode()
    words, code = enc.dictionary.to_pylist(), enc.indices.to_numpy()
    n = np.zeros(len(words), np.int64)
    n[code] = table.column("n").to_numpy()
    # code-point order is byte order of UTF-8, which Latin-1 letters keep
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    best = _Best(n, rank)
    longest, tail = table.column("longest").to_numpy(), table.column("tail").to_numpy(zero_copy_only=False)
    group = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    i, j, own = (table.column(c).to_numpy().astype(np.int64) for c in ("i", "j", "own"))
    for ln in np.unique(longest):
        for t in (False, True):
            of = np.flatnonzero((longest == ln) & (tail == t))
            if len(of):
                order = of[np.lexsort((code[of], own[of], j[of], i[of], group[of]))]
                _one_width(int(ln), t, order, code, group, i, j, own, words, size, best)
    at = np.flatnonzero(best.count)
    top = best.word[best.best[at]]
    take = pa.array(words, pa.string())
    return pa.table({"word": take.take(pa.array(at)), "n_near": pa.array(best.count[at]),
                     "form": take.take(pa.array(top)), "form_n": pa.array(n[top])})


def _one_width(width, tail, order, code, group, i, j, own, words, size, best):
    code, group, i, j, own = code[order], group[order], i[order], j[order], own[order]
    text = [words[c] for c in code.tolist()]
    mat = code_points([w.rjust(width, "\0") for w in text] if tail else text, width)
    sz, head = size[code], width // 2  # ceil((width - 1) / 2)
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(code))
    count = end - start
    # small groups together: every row with the one d places further on
    cell = np.cumsum(new) - 1
    small = (count <= SMALL) & (i[start] == j[start])
    of = np.flatnonzero(small[cell])
    for d in range(1, int(count[small].max(initial=1))):
        at = of[of + d < len(cell)]
        at = at[cell[at] == cell[at + d]]
        for x in range(0, len(at), 65_536):
            p = at[x:x + 65_536]
            ok = near_rows(mat[p], mat[p + d], sz[p], sz[p + d], tail, head)
            best.add(code[p[ok]], code[p[ok] + d])
    for s, e, two in zip(start[~small].tolist(), end[~small].tolist(), (i != j)[start[~small]].tolist()):
        if two:  # a pair of different blocks
            cut = s + int(np.searchsorted(own[s:e], j[s]))
            tiles = [(r, c) for r in range(s, cut, TILE) for c in range(cut, e, TILE)]
            stop = (cut, e)
        else:
            tiles = [(r, c) for r in range(s, e, TILE) for c in range(r, e, TILE)]
            stop = (e, e)
        for r, c in tiles:
            rows, cols = np.arange(r, min(r + TILE, stop[0])), np.arange(c, min(c + TILE, stop[1]))
            a, b = _tile(mat, sz, rows, cols, tail, head)
            if r == c:
                a, b = a[a < b], b[a < b]
            best.add(code[a], code[b])


def _filed(words: DataFrame) -> DataFrame:
    """Words under their keys (longest, tail, key): as the longer or equal word of a pair and as the shorter one."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longest"))
    front = F.expr("longest div 2")
    back = F.expr("(longest - 1) div 2 + 1")
    rows = rows.select("word", "n", "longest", F.explode(F.array(F.lit(False), F.lit(True))).alias("tail"), front.alias("f"), back.alias("b"))
    key = F.when(F.col("tail"), F.substring(F.col("word"), F.char_length("word") - F.col("b") + 1, F.col("b"))).otherwise(
        F.substring(F.col("word"), F.lit(1), F.col("f")))
    return rows.select("word", "n", "longest", "tail", key.alias("key"))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per word that has near words: their number and the best of them (form, form_n)."""
    filed = _filed(words)
    keys = ["longest", "tail", "key"]
    sizes = filed.groupBy(*keys).agg(F.count("*").alias("size"), F.max(F.char_length("word") == F.col("longest")).alias("full"))
    sizes = materialize(sizes.filter("size > 1 AND full").drop("full"), "keys")
    rows = filed.join(sizes, keys).withColumn("side", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("side")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("side") - 1),
                        lambda o: F.struct(F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    rows = rows.withColumn("cell", F.explode(cells)).select("word", "n", *keys, "own", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"))
    # cells of small keys share a bucket, about two blocks of rows each; a cell of a large key is a bucket of its own
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // (8 * block))
    bucket = F.pmod(F.xxhash64(*keys, "i", "j"), F.lit(buckets))
    part = rows.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        _compare, "word string, n_near long, form string, form_n long")
    merged = part.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("form_n")).alias("k"), F.col("form").alias("w"))).alias("top"))
    return merged.select("word", "n_near", F.col("top.w").alias("form"), (-F.col("top.k")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without cycles: every round joins the pointers with themselves, so a chain of
    length k takes log2(k) rounds."""
    far = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = far.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(far.join(nxt, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "roots")
        far = step.select("word", "root")
        if not step.filter("moved").head(1):
            return far


def variants(docs: DataFrame, every: int = DAMAGE, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Words with their form and root: word, form, root, n, n_near, form_n."""
    words = materialize(vocabulary(docs, every, min_length, min_count), "vocabulary")
    near = near_words(words, block)
    rows = words.join(near, "word", "left")
    has = F.col("form_n") >= ratio * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("form")).alias("form"),
                       F.when(has, F.col("form_n")).alias("form_n"))
    rows = materialize(rows, "variants")
    far = roots(rows.filter("form IS NOT NULL"))
    return rows.join(far, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return variants(docs.select("doc_id", "text"))
