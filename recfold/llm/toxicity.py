"""Toxicity by a subsequence string kernel with Nystroem landmarks.

The kernel of two words, with marks for their beginning and end, counts their
common three-letter subsequences, each weighted by ``DECAY`` for every letter
that it spans (at most ``SPAN``), and is normalised to 1 for equal words, so a gap or an inserted letter lowers
it only little. Full gaps and embedding do not: every word is also read without
its inner punctuation (``i.d.i.o.t``), letters that stand alone in a row
(``i d i o t``) as one word, and of a word longer than a landmark also each
window of the landmark's length (``youareanidiot``) as a word of its own.

Training. At most ``TRAIN_ROWS`` labelled documents outside the held-out fold
(those with the smallest hash of their id) are written once to the shared
folder, one row per id. Landmarks are words that toxic documents hold more often than
chance explains (exact binomial tail times the number of words looked at). They
are chosen one by one, each by the documents that hold no earlier one, so
words that merely stand beside insults or in copies of one toxic text are not
chosen; a word too like an earlier one only counts its documents as held. A sentence is the vector of its words' best kernel value with each landmark,
mapped by the inverse root of the landmarks' kernel matrix (Nystroem). A
linear support vector machine (squared hinge, Newton) learns on sentences:
all kept sentences of clean documents against, for each toxic one, its
sentence of largest margin (chosen again for some rounds). A document's score
is a logistic of its sentences' largest margin, of the number of sentences
beyond the margin (softly counted) and of their share of the text.

Scoring reads each whole text once and shuffles nothing. Kernel values below
``FLOOR`` count as 0, so only few words of a text make a vector.

Defined results: null and empty texts have no sentence and get the score of
an all-zero one; with no toxic or no clean training row every score is 0;
repeated rows are answered row by row; extra columns pass through
``score_texts``; a label row without document or a null label is ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.llm.common import drop_columns, held_out, materialize, share

#: Bounds of the training sample: documents, sentences kept of each, words looked at, landmarks.
TRAIN_ROWS, SENTENCES, CANDIDATES, LANDMARKS = 20_000, 12, 2_000, 64
#: The kernel: weight per spanned letter, longest span, least value that counts.
DECAY, SPAN, FLOOR = 0.7, 7, 0.40
#: Landmarks are less alike than this.
APART = 0.75
#: Words for each sentence of a text's share.
WORDS = 15
LONGEST = 64
PIECE_BYTES = 1 << 20
#: A word is a landmark only if chance gives fewer than so many such words among all words of the sample.
BY_CHANCE = 0.01
#: Words without a value that a task remembers.
REMEMBERED = 200_000
#: Words and windows whose kernel values are taken at once.
KERNEL_WORDS = 4_096
_TRIM = ".,;:!?\"'()[]|&%$#*"
_INNER = r"[^\p{L}\p{M}\p{N}]+"
_BEGIN, _END = "\x02", "\x03"
_SHAPES = [(j, k) for j, k in itertools.combinations(range(1, SPAN), 2)]


# --------------------------------------------------------------------------
# the kernel
# --------------------------------------------------------------------------

def _letters(words: list[str]):
    words = [_BEGIN + w + _END for w in words]
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, words), np.int64, len(words))
    return flat, np.repeat(np.arange(len(words)), size)


def _weights(words: list[str]) -> list[dict[str, float]]:
    """Weight of every three-letter subsequence of each word."""
    out = []
    for w in words:
        w = _BEGIN + w + _END
        d: dict[str, float] = {}
        for i in range(len(w)):
            for j, k in _SHAPES:
                if i + k < len(w):
                    g = w[i] + w[i + j] + w[i + k]
                    d[g] = d.get(g, 0.0) + DECAY ** (k + 1)
        out.append(d)
    return out


class Landmarks:
    """The landmark words as an inverted table from subsequences to weights."""

    def __init__(self, words: list[str]):
        self.words = words
        self.blank: set[str] = set()  # words known to have no value
        self.size = np.array([len(w) for w in words])
        vectors = _weights(words)
        self.norm = np.array([sum(v * v for v in d.values()) for d in vectors])
        alphabet = sorted({*"".join(words), _BEGIN, _END})
        self.base = len(alphabet) + 1
        self.place = np.zeros(0x110000, np.int32)
        self.place[[ord(c) for c in alphabet]] = np.arange(1, self.base)
        self.bounds = [self._bound(w, d) for w, d in zip(words, vectors)]
        number = {c: i + 1 for i, c in enumerate(alphabet)}
        entries: dict[int, list[tuple[int, float]]] = {}
        for l, d in enumerate(vectors):
            for g, v in d.items():
                a, b, c = (number[x] for x in g)
                entries.setdefault((a * self.base + b) * self.base + c, []).append((l, v))
        codes = sorted(entries)
        self.table = np.full(self.base ** 3, -1, np.int32)
        self.table[codes] = np.arange(len(codes))
        self.start = np.cumsum([0] + [len(entries[c]) for c in codes])
        self.many = np.diff(self.start)
        self.landmark = np.array([l for c in codes for l, _ in entries[c]], np.int64)
        self.weight = np.array([v for c in codes for _, v in entries[c]])

    def kernel(self, words: list[str]):
        """Values of at least FLOOR as (word, landmark, value)."""
        m = len(self.words)
        flat, word = _letters(words)
        cls = self.place[flat]
        total = np.zeros(len(words) * m)
        for k in range(2, SPAN):
            n = len(flat) - k
            if n <= 0:
                continue
            ok = np.flatnonzero((word[:n] == word[k:]) & (cls[:n] > 0) & (cls[k:] > 0))
            first, last, keys, rows = cls[ok] * self.base, cls[ok + k], [], []
            for j in range(1, k):
                code = self.table[(first + cls[ok + j]) * self.base + last]  # a letter of no landmark has no entry
                hit = np.flatnonzero(code >= 0)
                code = code[hit]
                size = self.many[code]
                at = np.repeat(self.start[code] - (np.cumsum(size) - size), size)
                at += np.arange(len(at))
                keys.append(np.repeat(word[ok[hit]] * m, size) + self.landmark[at])
                rows.append(at)
            total += np.bincount(np.concatenate(keys), weights=self.weight[np.concatenate(rows)] * DECAY ** (k + 1), minlength=len(total))
        # a word's kernel with itself is at least what its places alone give
        chars = np.fromiter(map(len, words), np.int64, len(words)) + 2
        least = sum(np.maximum(chars - k, 0) * DECAY ** (2 * (k + 1)) for _, k in _SHAPES)
        pair = np.flatnonzero(total >= (FLOOR * np.sqrt(least)[:, None] * np.sqrt(self.norm) - 1e-12).ravel())
        w, l = pair // m, pair % m
        some = np.unique(w)
        norm = np.zeros(len(words))
        norm[some] = _norms([words[i] for i in some])
        value = total[pair] / np.sqrt(norm[w] * self.norm[l])
        keep = value >= FLOOR
        return w[keep], l[keep], np.minimum(value[keep], 1.0)

    def _bound(self, word: str, vector: dict[str, float]):
        """The word's letters and, for every set of them, whether it reaches FLOOR."""
        letters = sorted(set(word))[:16]  # a rarer letter counts as present
        bit = {c: 1 << i for i, c in enumerate(letters)}
        total = np.zeros(1 << len(letters))
        for g, v in vector.items():
            total[sum({bit.get(c, 0) for c in g})] += v * v
        for i in range(len(letters)):  # sums over subsets
            t = total.reshape(-1, 2, 1 << i)
            t[:, 1] += t[:, 0]
        return [int(self.place[ord(c)]) for c in letters], np.sqrt(total / total[-1]) >= FLOOR - 1e-9

    def within(self, words: list[str]):
        """Best values of each word and of its windows of a landmark's length,
        a window with landmarks of its length only, as (word, landmark, value)."""
        m, known = len(self.words), []
        window, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cls = self.place[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        length = np.fromiter(map(len, words), np.int64, len(words))
        word_of, first = np.repeat(np.arange(len(words)), length), np.cumsum(length) - length
        for n in sorted(set(self.size.tolist())):
            count = len(cls) - n + 1
            if count <= 0:
                continue
            inside = np.flatnonzero((word_of[:count] == word_of[n - 1:]) & (length[word_of[:count]] > n))
            # by Cauchy and Schwarz a value is at most the share of the landmark's norm in subsequences of the window's letters
            can = np.zeros(len(inside), bool)
            for l in np.flatnonzero(self.size == n):
                letters, enough = self.bounds[l]
                bit = np.zeros(self.base, np.uint16)
                bit[letters] = 1 << np.arange(len(letters))
                has, wide = bit[cls], 1
                while wide < n:  # letters of runs twice as long, up to n
                    step = min(wide, n - wide)
                    has, wide = has[:-step] | has[step:], wide + step
                can |= enough[has[inside]]
            start = inside[can]
            mine = word_of[start]
            place: dict[str, int] = {}
            number = [place.setdefault(words[i][a:a + n], len(place)) for i, a in zip(mine.tolist(), (start - first[mine]).tolist())]
            window.append(np.array(number, np.int64) + len(known))
            owner.append(mine)
            known += place
        window, owner = np.concatenate(window), np.concatenate(owner)
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for x in range(0, len(words), KERNEL_WORDS):
            w, l, v = self.kernel(words[x:x + KERNEL_WORDS])
            keys.append((w + x) * m + l)
            values.append(v)
        # the words that hold each window, by window
        owner, edge = owner[np.argsort(window, kind="stable")], np.cumsum(np.bincount(window, minlength=len(known)))
        for x in range(0, len(known), KERNEL_WORDS):
            part = known[x:x + KERNEL_WORDS]
            w, l, v = self.kernel(part)
            same = np.fromiter(map(len, part), np.int64, len(part))[w] == self.size[l]
            w, l, v = w[same] + x, l[same], v[same]
            start = np.where(w > 0, edge[w - 1], 0)
            n = edge[w] - start
            at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys.append(owner[at] * m + np.repeat(l, n))
            values.append(np.repeat(v, n))
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.lexsort((-value, key))
        key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
        return key[first] // m, key[first] % m, value[first]

    def matrix(self) -> np.ndarray:
        vectors = _weights(self.words)
        k = np.array([[sum(v * b.get(g, 0.0) for g, v in a.items()) for b in vectors] for a in vectors])
        return k / np.sqrt(np.outer(self.norm, self.norm))


def _norms(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself."""
    flat, word = _letters(words)
    flat = flat.astype(np.uint64)
    codes, weights = [], []
    for j, k in _SHAPES:
        n = max(0, len(flat) - k)
        ok = np.flatnonzero(word[:n] == word[k:k + n])
        gram = (flat[ok] << np.uint64(42)) | (flat[ok + j] << np.uint64(21)) | flat[ok + k]
        codes.append(np.stack([word[ok].astype(np.uint64), gram], 1))
        weights.append(np.full(len(ok), DECAY ** (k + 1)))
    codes, weights = np.concatenate(codes), np.concatenate(weights)
    order = np.lexsort((codes[:, 1], codes[:, 0]))
    codes, weights = codes[order], weights[order]
    out = np.zeros(len(words))
    if len(codes):
        cut = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]).any(axis=1))))
        np.add.at(out, codes[cut, 0].astype(np.int64), np.add.reduceat(weights, cut) ** 2)
    return out


# --------------------------------------------------------------------------
# words and sentences of texts
# --------------------------------------------------------------------------

def _tokens(texts: pa.Array):
    """Distinct words, and of every token: word number, row, sentence number.
    A word with inner punctuation makes one more token without it, and so do
    single letters in a row."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    words, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(row[pc.binary_length(words).to_numpy(zero_copy_only=False) > 0], minlength=len(texts))
    ends = pc.match_substring_regex(words, r"[.!?]$").to_numpy(zero_copy_only=False)
    enc = pc.utf8_trim(words, _TRIM).dictionary_encode()
    words, code = enc.dictionary, enc.indices.to_numpy(zero_copy_only=False)
    bare = pc.replace_substring_regex(words, _INNER, "")
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)[code]
    bare_size = pc.utf8_length(bare).to_numpy(zero_copy_only=False)[code]
    other = pc.not_equal(words, bare).to_numpy(zero_copy_only=False)[code]
    words, bare = words.take(enc.indices), bare.take(enc.indices)
    sentence = np.cumsum(np.concatenate(([False], ends[:-1]))) + row if len(row) else row
    joined, at = [], []

    def parts(text, from_):
        """A long text is read to its end in overlapping parts."""
        for x in range(0, max(1, len(text) - LONGEST // 2), LONGEST // 2):
            joined.append(text[x:x + LONGEST])
            at.append(from_[x])

    single = np.concatenate(([False], bare_size <= 1, [False]))
    edge = np.flatnonzero(single[1:] != single[:-1])
    long_runs = edge[1::2] - edge[::2] >= 3
    for a, b in zip(edge[::2][long_runs], edge[1::2][long_runs]):
        for x, y in _same_row(row, a, b):
            # the letters alone, and with the signs that stand between them
            runs = {tuple(col.slice(x, y - x).to_pylist()) for col in (bare, words)}
            for letters in sorted(runs):
                run, from_ = "".join(letters), np.repeat(np.arange(x, y), [len(c) for c in letters])
                if len(run) >= 3:
                    parts(run, from_)
    keep = np.flatnonzero((size >= 3) & (size <= LONGEST))
    clear = np.flatnonzero(other & (bare_size >= 3) & (bare_size <= LONGEST))
    for col, long in ((words, size > LONGEST), (bare, other & (bare_size > LONGEST))):
        for i in np.flatnonzero(long):
            w = col[int(i)].as_py()
            parts(w, np.full(len(w), i))
    index = np.concatenate((keep, clear, np.array(at, np.int64))).astype(np.int64)
    words = pa.concat_arrays([words.take(pa.array(keep)).cast(pa.large_string()), bare.take(pa.array(clear)).cast(pa.large_string()),
                              pa.array(joined, pa.large_string())])
    enc = words.dictionary_encode()
    return enc.dictionary.to_pylist(), enc.indices.to_numpy(), row[index], sentence[index], n_words


def _same_row(row, a, b):
    cut = [a, *(np.flatnonzero(row[a + 1:b] != row[a:b - 1]) + a + 1), b]
    return zip(cut[:-1], cut[1:])


def _pieces(batch: pa.RecordBatch, column: str):
    """Runs of whole rows of at most PIECE_BYTES (one row at least)."""
    col = pc.fill_null(batch.column(batch.schema.names.index(column)).cast(pa.large_string()), "")
    sizes = np.cumsum(np.concatenate(([0], pc.binary_length(col).to_numpy(zero_copy_only=False))))
    i = 0
    while i < len(col):
        j = min(len(col), max(i + 1, int(np.searchsorted(sizes, sizes[i] + PIECE_BYTES, side="right")) - 1))
        yield i, col.slice(i, j - i)
        i = j


def sentence_vectors(texts: pa.Array, marks: Landmarks):
    """Non-zero sentence vectors: row of each, an array (sentences, landmarks);
    and the number of words of every row."""
    words, code, row, sentence, n_words = _tokens(texts)
    m = len(marks.words)
    if not words:
        return np.zeros(0, np.int64), np.zeros((0, m)), n_words
    new = [i for i, x in enumerate(words) if x not in marks.blank]
    w, l, v = marks.within([words[i] for i in new])
    w = np.array(new, np.int64)[w]
    if len(marks.blank) < REMEMBERED:
        marks.blank.update(words[i] for i in np.setdiff1d(new, w).tolist())
    rich = np.zeros(len(words), bool)
    rich[w] = True
    at = np.flatnonzero(rich[code])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros((0, m)), n_words
    number = np.cumsum(rich) - 1
    table = np.zeros((int(rich.sum()), m))
    table[number[w], l] = v
    at = at[np.lexsort((sentence[at], row[at]))]
    cut = np.flatnonzero(np.concatenate(([True], (sentence[at][1:] != sentence[at][:-1]) | (row[at][1:] != row[at][:-1]))))
    return row[at[cut]], np.maximum.reduceat(table[number[code[at]]], cut, axis=0), n_words


# --------------------------------------------------------------------------
# training
# --------------------------------------------------------------------------

def training_sample(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the fold;
    of rows with the same id the one with the smallest text hash.
    The chosen ids are at most ``rows`` and are broadcast; texts are not shuffled."""
    spark = docs.sparkSession
    seen = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, fold))
    seen = seen.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    known = share(spark, (np.array([r["doc_id"] for r in some], np.int64), np.array([r["toxic"] for r in some], np.int32)))

    def pick(batches):
        ids, toxic = known.value
        order = np.argsort(ids)
        ids, toxic = ids[order], toxic[order]
        for b in batches:
            mine = pc.fill_null(b.column(0), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(ids, mine), max(len(ids) - 1, 0))
            hit = (ids[at] == mine) & b.column(0).is_valid().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(len(mine), bool)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(hit)), b.column(1).filter(pa.array(hit)),
                                              pa.array(toxic[at[hit]], pa.int32())], names=["doc_id", "text", "toxic"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        pick, "doc_id long, text string, toxic int")
    one = picked.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    return materialize(one.select("text", "toxic"), "toxicity-sample")


def choose_landmarks(sample: DataFrame, n: int = LANDMARKS, candidates: int = CANDIDATES) -> Landmarks | None:
    """Words that toxic documents hold more often, none too like another."""

    def distinct(batches):
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False)
            for first, col in _pieces(b, "text"):
                words, code, row, _, _ = _tokens(col)
                pair = np.unique(row * max(len(words), 1) + code)
                r, w = pair // max(len(words), 1), pair % max(len(words), 1)
                hot = np.bincount(w[toxic[first + r] == 1], minlength=len(words))
                all_ = np.bincount(w, minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(hot, pa.int64()), pa.array(all_, pa.int64())],
                                                 names=["word", "hot", "n"])

    size = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("hot")).first()
    if not 0 < size["hot"] < size["n"]:
        return None
    share = size["hot"] / size["n"]
    counts = materialize(sample.mapInArrow(distinct, "word string, hot long, n long").groupBy("word").agg(
        F.sum("hot").alias("hot"), F.sum("n").alias("n")), "toxicity-words")
    # how far the toxic documents among those with the word exceed their share, in standard deviations
    z = (F.col("hot") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    rows = counts.filter("hot >= 3").withColumn("z", z).filter("z > 0").orderBy(F.desc("z"), "word").limit(candidates).collect()
    words, tests = [r["word"] for r in rows], counts.count()
    if not words:
        return None
    toxic, held = _holders(sample, words)
    chosen: list[str] = []
    vectors: list[tuple[dict, float]] = []
    free = np.ones(len(toxic), bool)
    log_fact = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, len(toxic) + 1)))))
    while len(chosen) < n:
        doc, word = held[0][free[held[0]]], held[1][free[held[0]]]
        share = toxic[free].mean() if free.any() else 0.0
        if not 0 < share < 1:
            share = min(max(share, 1 / (free.sum() + 2)), 1 - 1 / (free.sum() + 2))
        all_ = np.bincount(word, minlength=len(words))
        hot = np.bincount(word[toxic[doc] == 1], minlength=len(words))
        z = np.where(hot >= 3, (hot - all_ * share) / np.sqrt(np.maximum(all_, 1) * share * (1 - share)), 0.0)
        some = np.argsort(-z, kind="stable")[:50]  # the least tail is among the greatest deviations
        tails = {int(i): _tail(int(hot[i]), int(all_[i]), share, log_fact) if z[i] > 0 else 1.0 for i in some}
        best = min(tails, key=lambda i: (tails[i], i))
        if tails[best] * tests > BY_CHANCE:
            break
        d = _weights([words[best]])[0]
        own = sum(v * v for v in d.values())
        if all(sum(v * b.get(g, 0.0) for g, v in d.items()) / math.sqrt(own * bn) < APART for b, bn in vectors):
            chosen.append(words[best])
            vectors.append((d, own))
        free[held[0][held[1] == best]] = False
    return Landmarks(chosen) if chosen else None


def _holders(sample: DataFrame, words: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Label of every sampled document, and the pairs (document, candidate word) of the candidates it holds."""
    shared = share(sample.sparkSession, {w: i for i, w in enumerate(words)})

    def find(batches):
        number = shared.value
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False)
            for first, col in _pieces(b, "text"):
                known, code, row, _, _ = _tokens(col)
                at = np.array([number.get(w, -1) for w in known], np.int64)
                mine = [[] for _ in range(len(col))]
                if len(known):
                    hit = at[code] >= 0
                    for r, w in set(zip(row[hit].tolist(), at[code[hit]].tolist())):
                        mine[r].append(w)
                yield pa.RecordBatch.from_arrays([pa.array(toxic[first:first + len(col)], pa.int32()), pa.array(mine, pa.list_(pa.int32()))],
                                                 names=["toxic", "words"])

    got = sample.mapInArrow(find, "toxic int, words array<int>").toArrow()
    lists = got.column("words").combine_chunks()
    return got.column("toxic").to_numpy(), (pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64),
                                            lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))


def _tail(hot: int, n: int, share: float, log_fact: np.ndarray) -> float:
    """Probability of at least ``hot`` toxic documents among ``n``."""
    k = np.arange(hot, n + 1)
    return float(np.exp(log_fact[n] - log_fact[k] - log_fact[n - k] + k * math.log(share) + (n - k) * math.log(1 - share)).sum())


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear squared-hinge machine by Newton steps; the last weight is the bias."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    reg = np.ones(x.shape[1])
    reg[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        on = slack > 0
        xo, co = x[on], c[on]
        grad = reg * w - 2 * xo.T @ (co * y[on] * slack[on])
        step = np.linalg.solve(np.diag(reg) + 2 * xo.T @ (co[:, None] * xo), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _document_features(row: np.ndarray, margin: np.ndarray, n_words: np.ndarray, bias: float) -> np.ndarray:
    best = np.full(len(n_words), bias)
    np.maximum.at(best, row, margin)
    many = np.bincount(row, weights=1 / (1 + np.exp(-np.clip(4 * margin, -30, 30))), minlength=len(n_words))
    return np.stack([best, np.log1p(many), np.sqrt(many / (1 + n_words / WORDS))], 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps; the last weight is the offset."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    w = np.zeros(x.shape[1])
    ridge = np.array([1e-3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge + 1e-9)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Landmarks, weights on kernel values (the Nystroem map is folded in), and
    the logistic over a document's features."""

    def __init__(self, marks: Landmarks, weights: np.ndarray, bias: float, logistic: np.ndarray):
        self.marks, self.weights, self.bias, self.logistic = marks, weights, bias, logistic

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, x, n_words = sentence_vectors(texts, self.marks)
        f = _document_features(row, x @ self.weights + self.bias, n_words, self.bias)
        return 1 / (1 + np.exp(-np.clip(f @ self.logistic[:-1] + self.logistic[-1], -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, rows: int = TRAIN_ROWS) -> Model | None:
    """Train on a bounded sample; None if it has no toxic or no clean text."""
    sample = training_sample(docs, labels, folds, fold, rows)
    marks = choose_landmarks(sample)
    if marks is None:
        return None
    shared = share(sample.sparkSession, marks)

    def vectors(batches):
        for b in batches:
            toxic = b.column(1).to_numpy(zero_copy_only=False)
            for first, col in _pieces(b, "text"):
                row, x, n_words = sentence_vectors(col, shared.value)
                order = np.lexsort((-x.max(axis=1, initial=0.0), row))
                row, x = row[order], x[order]
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                row, x = row[nth < SENTENCES], x[nth < SENTENCES]
                none = np.setdiff1d(np.arange(len(col)), row)
                row, x = np.append(row, none), np.concatenate((x, np.zeros((len(none), x.shape[1]))))
                order = np.argsort(row, kind="stable")
                row, x = row[order], x[order]
                edge = np.searchsorted(row, np.arange(len(col) + 1))
                flat = pa.ListArray.from_arrays(pa.array(edge * x.shape[1], pa.int32()), pa.array(x.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([pa.array(toxic[first:first + len(col)], pa.int32()), flat,
                                                  pa.array(n_words.astype(np.int64))], names=["toxic", "x", "words"])

    got = sample.mapInArrow(vectors, "toxic int, x array<float>, words long").toArrow()
    toxic = got.column("toxic").to_numpy()
    lists = got.column("x").combine_chunks()
    m = len(marks.words)
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, m).astype(float)
    doc = np.repeat(np.arange(len(toxic)), pc.list_value_length(lists).to_numpy(zero_copy_only=False) // m)
    values, basis = np.linalg.eigh(marks.matrix())
    values = np.maximum(values, 1e-6)
    root = basis @ np.diag(values ** -0.5) @ basis.T
    z = x @ root
    clean = np.flatnonzero(toxic[doc] == 0)
    bags = np.flatnonzero(toxic == 1)
    margin = x.max(axis=1)
    for _ in range(4):
        order = np.lexsort((-margin, doc))
        witness = order[np.searchsorted(doc[order], bags)]
        part = np.concatenate((clean, witness))
        y = np.concatenate((-np.ones(len(clean)), np.ones(len(witness))))
        c = np.full(len(part), 10.0 / math.sqrt(len(part)))
        w = _svm(z[part], y, c)
        margin = z @ w[:-1] + w[-1]
    real = x.any(axis=1)
    features = _document_features(doc[real], margin[real], got.column("words").to_numpy(), float(w[-1]))
    return Model(marks, root @ w[:-1], float(w[-1]), _logistic(features, toxic.astype(float)))


def score_texts(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score column (one of that name is replaced)."""
    base = drop_columns(docs, [out])
    schema = T.StructType([*base.schema, T.StructField(out, T.DoubleType())])
    shared = share(docs.sparkSession, model)

    def work(batches):
        for b in batches:
            score = np.zeros(b.num_rows)
            for first, col in _pieces(b, text_col) if shared.value is not None else ():
                score[first:first + len(col)] = shared.value.scores(col)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=schema.names)

    return base.mapInArrow(work, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_texts(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "score")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that score below 0.5, with the columns of ``docs``."""
    names = docs.columns
    scored = score_texts(docs, fit(docs, labels), out="__toxic")
    return scored.filter("__toxic < 0.5").select(*[F.col(f"`{c}`") for c in names])
