"""Benchmark decontamination.

Test items are cut into windows of ``n`` consecutive normalised words (an item
of fewer words, but not none, is one window). The distinct windows form a hash
set that is broadcast in slices of bounded size; every document is scanned
whole, its token windows are looked up by hash, and each hit is verified on
the words themselves. Documents are never shuffled.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. All
excluded characters are ASCII, so the scan works on UTF-8 bytes.

Defined results: a null or empty text has no words and is clean; a null item
text has no windows; an item id that repeats counts once; windows of items
with a null id mark words as hit but are not listed in ``items``; repeated
document rows are answered row by row; texts of any length are read whole,
long ones in overlapping pieces; extra columns pass through, those named
like a result column are replaced; an empty benchmark leaves all clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.llm.common import ascii_lower, materialize, mix64, share, text_pieces

WINDOW = 10
#: Text that is scanned at once; longer texts are scanned in overlapping pieces.
PIECE_BYTES = 256 << 10
#: A broadcast slice holds at most so many distinct windows and so many bytes of window text.
SLICE_WINDOWS = 200_000
SLICE_BYTES = 32 << 20

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))


class _Powers:
    """Powers of the hash radix and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 1 << 16)
            one = np.ones(size, np.uint64)
            up, down = one.copy(), one.copy()
            up[1:], down[1:] = _RADIX, _INVERSE
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up, self.down


def _span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hash (mod 2^64) of ``values[start:end]`` for many spans."""
    up, down = powers.upto(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], dtype=np.uint64, out=total[1:])
    return mix64((total[end] - total[start]) * down[start])


def tokenize(buf: np.ndarray, off: np.ndarray, powers: _Powers):
    """Words of a run of texts: lower-cased bytes, starts, ends, row of each
    word and word hashes. A word never crosses a row."""
    low = ascii_lower(buf)
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = _WORD[low]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    edge = off[:-1][off[:-1] < len(low)]
    begins[edge] = inside[edge]
    start = np.flatnonzero(begins)
    stops = inside[:-1] & ~inside[1:]
    last = off[1:][off[1:] > 0] - 1
    stops[last] = inside[last]
    end = np.flatnonzero(stops) + 1
    row = np.searchsorted(off, start, side="right") - 1
    return low, start, end, row, _span_hash(_BYTE[low], start, end, powers)


def gram_hashes(word_hash: np.ndarray, n: int, powers: _Powers) -> np.ndarray:
    first = np.arange(len(word_hash) - n + 1)
    return _span_hash(word_hash, first, first + n, powers)


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 n: int = WINDOW) -> DataFrame:
    """Distinct windows of the test items: ``len`` words, joined ``gram``
    text and the sorted ids (as strings) of the items that hold it."""

    def cut(batches):
        powers = _Powers()
        for batch in batches:
            ids = batch.column(0)
            for first, off, buf in text_pieces(batch, "text", PIECE_BYTES):
                low, s, e, row, _ = tokenize(buf, off, powers)
                text, out = low.tobytes(), ([], [], [])
                bounds = np.searchsorted(row, np.arange(len(off)))
                for r in range(len(off) - 1):
                    words = [text[a:b].decode() for a, b in zip(s[bounds[r]:bounds[r + 1]], e[bounds[r]:bounds[r + 1]])]
                    k = min(n, len(words))
                    for g in {" ".join(words[i:i + k]) for i in range(len(words) - k + 1)} if k else ():
                        out[0].append(k), out[1].append(g), out[2].append(ids[first + r].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                    names=["len", "gram", "item"])

    source = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    windows = source.mapInArrow(cut, "len int, gram string, item string")
    return windows.groupBy("len", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _HashSet:
    """Windows of one slice by length: a bit table over the top hash bits, the
    sorted hashes, and the window texts with their items."""

    def __init__(self, rows):
        powers = _Powers()
        self.texts: dict[bytes, list[str]] = {r["gram"].encode(): r["items"] for r in rows}
        self.by_len: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in sorted({r["len"] for r in rows}):
            grams = [r["gram"].encode() for r in rows if r["len"] == k]
            hashes = []
            for g in grams:
                buf = np.frombuffer(g, np.uint8)
                _, _, _, _, h = tokenize(buf, np.array([0, len(buf)]), powers)
                hashes.append(gram_hashes(h, k, powers)[0])
            known = np.unique(np.array(hashes, np.uint64))
            table = np.zeros(1 << 20, bool)
            table[known >> np.uint64(44)] = True
            self.by_len[k] = (table, known)

    def hits(self, low: np.ndarray, start, end, row, hashes, powers):
        """Verified hits as ``(first_word, n_words, items)``."""
        for k, (table, known) in self.by_len.items():
            if len(hashes) < k:
                continue
            grams = gram_hashes(hashes, k, powers)
            maybe = np.flatnonzero(table[grams >> np.uint64(44)])
            maybe = maybe[row[maybe] == row[maybe + k - 1]]
            at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
            for i in maybe[known[at] == grams[maybe]]:
                gram = b" ".join(low[a:b].tobytes() for a, b in zip(start[i:i + k], end[i:i + k]))
                if (items := self.texts.get(gram)) is not None:
                    yield int(i), k, items


_FOUND = T.StructType([T.StructField("__n_words", T.LongType()), T.StructField("__words", T.ArrayType(T.LongType())),
                       T.StructField("__items", T.ArrayType(T.StringType())),
                       T.StructField("__spans", T.ArrayType(T.LongType()))])


def _scan_long(buf: np.ndarray, grams: _HashSet, powers: _Powers):
    """Word count, hit words, items and byte spans of one text, read in pieces that end between words and begin with the
    last words of the piece before, as many as a window has less one."""
    overlap = max(grams.by_len, default=1) - 1
    at, n_before, spans, items, n, size = 0, 0, {}, set(), 0, PIECE_BYTES
    while at < len(buf):
        stop = min(at + size, len(buf))
        while stop < len(buf) and _WORD[ascii_lower(buf[stop - 1:stop])[0]]:
            inside = _WORD[ascii_lower(buf[stop:stop + PIECE_BYTES])]
            stop += int(np.argmin(inside)) + 1 if not inside.all() else len(inside)
        low, s, e, row, h = tokenize(buf[at:stop], np.array([0, stop - at]), powers)
        if len(s) <= overlap and stop < len(buf):  # a piece must go beyond the overlap
            size *= 2
            continue
        for i, k, ids in grams.hits(low, s, e, row, h, powers):
            for w in range(i, i + k):
                spans[n_before + w] = (int(s[w]) + at, int(e[w]) + at)
            items.update(x for x in ids if x is not None)
        n = n_before + len(s)
        if stop == len(buf):
            break
        n_before, size = n - overlap, PIECE_BYTES
        at = at + int(s[len(s) - overlap]) if overlap else stop
    words = sorted(spans)
    return n, words, sorted(items), [v for w in words for v in spans[w]]


def _scan(docs: DataFrame, text_col: str, hash_set) -> DataFrame:
    """Add hit word numbers, their byte spans and the matched items; merges
    with what an earlier slice found."""
    schema = T.StructType([f for f in docs.schema if f.name not in _FOUND.names] + list(_FOUND))

    def scan(batches):
        powers, grams = _Powers(), hash_set.value
        for batch in batches:
            n = batch.num_rows
            names = batch.schema.names
            again = "__words" in names
            old = [batch.column(names.index(c)).to_pylist() if again else [None] * n for c in _FOUND.names]
            count, words, items, spans = [0] * n, [None] * n, [None] * n, [None] * n
            for first, off, buf in text_pieces(batch, text_col, PIECE_BYTES):
                if len(buf) > PIECE_BYTES:  # one long text
                    count[first], w, it, at = _scan_long(buf, grams, powers)
                    if w:
                        words[first], items[first], spans[first] = w, it, at
                    continue
                low, s, e, row, h = tokenize(buf, off, powers)
                lo = np.searchsorted(row, np.arange(len(off)))
                for r in range(len(off) - 1):
                    count[first + r] = int(lo[r + 1] - lo[r])
                found: dict[int, tuple[set, set]] = {}
                for i, k, ids in grams.hits(low, s, e, row, h, powers):
                    w, it = found.setdefault(int(row[i]), (set(), set()))
                    w.update(range(i, i + k))
                    it.update(x for x in ids if x is not None)
                for r, (w, it) in found.items():
                    g = first + r
                    w = np.array(sorted(w))
                    words[g] = (w - lo[r]).tolist()
                    items[g] = sorted(it)
                    spans[g] = np.stack([s[w] - off[r], e[w] - off[r]], 1).ravel().tolist()
            for g in range(n):
                if again and old[1][g]:
                    both = {x: old[3][g][2 * j:2 * j + 2] for j, x in enumerate(old[1][g])}
                    both |= {x: spans[g][2 * j:2 * j + 2] for j, x in enumerate(words[g] or [])}
                    words[g] = sorted(both)
                    spans[g] = [v for x in words[g] for v in both[x]]
                    items[g] = sorted({*old[2][g], *(items[g] or [])})
            keep = [batch.column(j) for j, c in enumerate(names) if c not in _FOUND.names]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(count, pa.int64()), pa.array([x or [] for x in words], pa.list_(pa.int64())),
                        pa.array([x or [] for x in items], pa.list_(pa.string())),
                        pa.array([x or [] for x in spans], pa.list_(pa.int64()))],
                names=schema.names)

    return docs.mapInArrow(scan, schema)


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", n: int = WINDOW,
              item_id: str = "item_id", item_text: str = "text",
              slice_windows: int = SLICE_WINDOWS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``__n_words``, hit word numbers ``__words``, their byte
    spans ``__spans`` (start, end, start, end ...) and matched ``__items``.

    The window set is counted first; it is broadcast as one slice when it is
    within the bound and else in several, one scan of the documents each, with
    the findings written to the shared folder in between.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(items, item_id, item_text, n), "windows")
    total = windows.agg(F.count("*").alias("n"),
                        F.coalesce(F.sum(F.octet_length("gram") + F.size("items") * 16), F.lit(0)).alias("b")).first()
    slices = max(1, -(-total["n"] // slice_windows), -(-total["b"] // slice_bytes))
    part = F.pmod(F.xxhash64("len", "gram"), F.lit(slices))
    found = docs
    for k in range(slices):
        rows = windows.filter(part == k).collect()
        found = _scan(found, text_col, share(spark, _HashSet(rows)))
        if k < slices - 1:
            found = materialize(found, "hits")
    return found


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document: word and hit counts, items found, their digest."""
    found = find_hits(docs.select("doc_id", "text"), items, n=n)
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.size("__words").cast("long").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "__items").cast("binary"), 256).alias("items_sha256"),
        (F.size("__words") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, n: int = WINDOW, remove: str = "documents",
                  text_col: str = "text") -> DataFrame:
    """Remove what the test items contaminate and keep the columns of
    ``docs``: ``remove="documents"`` drops every document with a hit,
    ``remove="spans"`` cuts the hit words out of the text and leaves the rest
    (a document that loses all its words stays, with what is between them)."""
    names = docs.columns
    found = find_hits(docs, items, text_col=text_col, n=n)
    if remove == "documents":
        return found.filter(F.size("__words") == 0).select(*[F.col(f"`{c}`") for c in names])
    if remove != "spans":
        raise ValueError(f"remove={remove!r}")

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        out = []
        for t, s in zip(text, spans):
            if t is not None and len(s):
                raw, at, kept = t.encode(), 0, []
                for a, b in zip(s[::2], s[1::2]):
                    kept.append(raw[at:a])
                    at = b
                t = b"".join([*kept, raw[at:]]).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    return found.withColumn(text_col, cut(F.col(text_col), "__spans")).select(*[F.col(f"`{c}`") for c in names])
