"""Subword lattice likelihood of whole texts.

A text is its lower-cased (A-Z) white-space words and one end token. Each word
is spelled by pieces of an existing subword vocabulary (a mark before the
first letter, byte pieces for letters without a piece of their own). Pieces
are drawn independently, so the probability of a word is the sum over *all*
its segmentations of the product of piece probabilities; a log-space forward
recursion over the lattice gives it in one pass. The text's score is the sum
over its words plus the end token, in log10.

The vocabulary is given; its unigram scores are learned from the training
documents: every distinct training word is segmented once, weighted by its
count, and smoothed by ``ALPHA``. Word counts, piece counts and document
counts come from all training documents.

Distribution. Words are counted with a partial sum per task. The word table
(word, count, log-probability) is written once; each distinct word runs
through the lattice once. A document's sum takes its frequent words from a
broadcast table of at most ``FREQUENT`` words of at most ``LONG`` bytes and
all other words from a shuffle join on the word, so a hot word is never
shuffled and the rest of the vocabulary may grow without bound.

Defined results: a null or empty text is the end token alone; repeated rows
are answered row by row; a null id hashes as the empty text; with no training
document all counts are zero and pieces are equally likely.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfold.llm.common import held_out, materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 0.1
FREQUENT = 100_000
LONG = 64
#: Text bytes handled at once in a task.
PIECE_BYTES = 8 << 20
MARK = "▁"
LOG10 = math.log(10)


# --------------------------------------------------------------------------
# words
# --------------------------------------------------------------------------

def _word_lists(batch: pa.RecordBatch, column: str):
    """Cut a batch into runs of at most PIECE_BYTES text bytes (one row at
    least) and yield ``(first_row, rows, words, row_of_word)``."""
    col = pc.fill_null(batch.column(batch.schema.names.index(column)).cast(pa.large_string()), "")
    sizes = np.cumsum(np.concatenate(([0], pc.binary_length(col).to_numpy(zero_copy_only=False))))
    i = 0
    while i < len(col):
        j = min(len(col), max(i + 1, int(np.searchsorted(sizes, sizes[i] + PIECE_BYTES, side="right")) - 1))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(col.slice(i, j - i)))
        words, row = lists.flatten(), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(words), 0)
        yield i, j - i, words.filter(real), row.filter(real).to_numpy(zero_copy_only=False)
        i = j


def word_counts(docs: DataFrame, text_col: str, train_col: str) -> DataFrame:
    """``word`` (binary), ``c``: its tokens in training rows (0 for words of
    other rows only)."""

    def count(batches):
        for b in batches:
            train = np.asarray(b.column(1).to_numpy(zero_copy_only=False), bool)
            for first, _, words, row in _word_lists(b, "text"):
                enc = words.cast(pa.large_binary()).dictionary_encode()
                codes = enc.indices.to_numpy()
                c = np.bincount(codes[train[first + row]], minlength=len(enc.dictionary))
                yield pa.RecordBatch.from_arrays([enc.dictionary.cast(pa.binary()), pa.array(c.astype(np.int64))],
                                                 names=["word", "c"])

    src = docs.select(F.col(text_col).alias("text"), F.col(train_col).alias("train"))
    return src.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


# --------------------------------------------------------------------------
# the piece model
# --------------------------------------------------------------------------

class Pieces:
    """Vocabulary pieces with natural-log probabilities."""

    def __init__(self, names: list[str], byte_ids: dict[int, int], end_id: int, counts: np.ndarray):
        used = np.array([i for i, p in enumerate(names) if p] + [*byte_ids.values(), end_id])
        logp = np.log((counts + ALPHA) / (counts[used].sum() + ALPHA * len(used)))
        self.logp = {p: float(logp[i]) for i, p in enumerate(names) if p}
        self.byte = {b: float(logp[i]) for b, i in byte_ids.items()}
        self.end = float(logp[end_id])
        self.longest = max(map(len, self.logp))

    def word(self, word: str) -> float:
        """Natural log of the summed probability of all segmentations."""
        s = MARK + word
        n, longest, get = len(s), self.longest, self.logp.get
        alpha: list[list[float]] = [[] for _ in range(n + 1)]
        alpha[0] = [0.0]
        for i in range(n):
            into = alpha[i]
            if not into:
                continue
            if len(into) == 1:
                a = into[0]
            else:
                top = max(into)
                a = top + math.log(sum([math.exp(x - top) for x in into]))
            for j in range(i + 1, min(n, i + longest) + 1):
                p = get(s[i:j])
                if p is not None:
                    alpha[j].append(a + p)
            if get(s[i]) is None:
                alpha[i + 1].append(a + sum(self.byte[b] for b in s[i].encode()))
            alpha[i] = ()
        top = max(alpha[n])
        return top + math.log(sum(math.exp(x - top) for x in alpha[n]))


def read_vocabulary(path: str):
    """Model bytes, usable piece texts by id ('' if not usable), ids of the
    byte pieces, id of the end piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names, byte_ids = [], {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:-1], 16)] = i
        plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        names.append(p if plain and MARK not in p[1:] else "")
    return sp.serialized_model_proto(), names, byte_ids, sp.eos_id()


def piece_counts(counts: DataFrame, model: bytes, size: int) -> np.ndarray:
    """Counts of the pieces that spell the training words, each distinct word
    segmented once; per-task sums, ``size`` numbers to the driver."""
    proto = counts.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto.value)
        total = np.zeros(size, np.int64)
        for b in batches:
            words = [w.decode() for w in b.column(0).to_pylist()]
            c = np.asarray(b.column(1))
            for i in range(0, len(words), 4096):
                ids = sp.encode(words[i:i + 4096], out_type=int, num_threads=1)
                lens = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((x for y in ids for x in y), np.int64, int(lens.sum()))
                np.add.at(total, flat, np.repeat(c[i:i + 4096], lens))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    rows = counts.filter("c > 0").mapInArrow(count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for r in rows.collect():
        out[r["piece"]] = r["n"]
    return out


def word_table(counts: DataFrame, pieces: Pieces) -> DataFrame:
    """``counts`` with ``lp``, the log10 probability of each word."""
    model = counts.sparkSession.sparkContext.broadcast(pieces)

    def spell(batches):
        word = model.value.word
        for b in batches:
            lp = [word(w.decode()) / LOG10 for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lp, pa.float64())],
                                             names=["word", "c", "lp"])

    return counts.mapInArrow(spell, "word binary, c long, lp double")


# --------------------------------------------------------------------------
# documents
# --------------------------------------------------------------------------

def score(docs: DataFrame, vocabulary: str = VOCABULARY, folds: int = 5, fold: int = 1, id_col: str = "doc_id",
          text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      held_out(id_col, folds, fold).alias("held"))
    counts = materialize(word_counts(src.withColumn("train", ~F.col("held")), "text", "train"), "words")
    n_docs = src.filter(~F.col("held")).count()
    known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    tokens, kinds = known["n"] + n_docs, known["v"] + (1 if n_docs else 0)

    proto, names, byte_ids, end_id = read_vocabulary(vocabulary)
    piece_n = piece_counts(counts, proto, len(names))
    piece_n[end_id] += n_docs
    pieces = Pieces(names, byte_ids, end_id, piece_n)
    words = materialize(word_table(counts, pieces), "word-scores")

    top = (words.filter(F.octet_length("word") <= LONG).orderBy(F.desc("c"), "word").limit(frequent)).toArrow()
    shared = spark.sparkContext.broadcast((top.column("word").combine_chunks(), top.column("c").to_numpy(),
                                           top.column("lp").to_numpy()))
    norm = math.log10(tokens + 0.5 * (kinds + 1))
    end = (math.log10(n_docs + 0.5) - norm, pieces.end / LOG10, int(n_docs > 0))

    def scan(batches):
        value, c_of, lp_of = shared.value
        value = value.cast(pa.large_binary())
        base_of = np.log10(c_of + 0.5) - norm if len(c_of) else np.zeros(0)
        fields = ["id", "tid", "word", "tf", "rows", "tokens", "known", "base", "lp"]
        for b in batches:
            ids, tids = b.column(0), b.column(2)
            for first, rows, ws, row in _word_lists(b, "text"):
                enc = ws.cast(pa.large_binary()).dictionary_encode()
                codes = enc.indices.to_numpy().astype(np.int64)
                at = pc.index_in(enc.dictionary, value_set=value).to_numpy(zero_copy_only=False)
                at = np.where(np.isnan(at), -1, at).astype(np.int64) if at.dtype.kind == "f" else at.astype(np.int64)
                here = at[codes]
                hit = here >= 0
                sums = [np.bincount(row, minlength=rows) + 1]
                for of in (c_of > 0, base_of, lp_of):
                    sums.append(np.bincount(row[hit], weights=of[here[hit]], minlength=rows) if hit.any()
                                else np.zeros(rows))
                # a row's own sums join no word: a key with a space in it, spread over the partitions
                none = pa.array([b" %d" % x for x in tids.slice(first, rows).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, rows), tids.slice(first, rows), none, pa.array(np.zeros(rows, np.int64)),
                     pa.array(np.ones(rows, np.int64)), pa.array(sums[0].astype(np.int64)),
                     pa.array(np.rint(sums[1]).astype(np.int64) + end[2]), pa.array(sums[2] + end[0]),
                     pa.array(sums[3] + end[1])], names=fields)
                pair, tf = np.unique(row[~hit] * len(enc.dictionary) + codes[~hit], return_counts=True)
                if len(pair):
                    r, w = pair // len(enc.dictionary), pair % len(enc.dictionary)
                    zero = pa.array(np.zeros(len(r), np.int64))
                    zero_f = pa.array(np.zeros(len(r)))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(first + r)), tids.take(pa.array(first + r)),
                         enc.dictionary.take(pa.array(w)).cast(pa.binary()), pa.array(tf.astype(np.int64)),
                         zero, zero, zero, zero_f, zero_f], names=fields)

    parts = src.select("id", "text", F.xxhash64("text").alias("tid")).mapInArrow(
        scan, f"id {src.schema['id'].dataType.simpleString()}, tid long, word binary, tf long, rows long, tokens long, known long, base double, lp double")
    rest = words.select("word", F.col("c").alias("wc"), F.col("lp").alias("wlp"))
    both = parts.join(rest, "word", "left")
    rare = F.col("tf") > 0
    sums = both.groupBy("id", "tid").agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"),
        (F.sum("known") + F.sum(F.when(rare & (F.col("wc") > 0), F.col("tf")).otherwise(0))).alias("known"),
        (F.sum("base") + F.sum(F.when(rare, F.col("tf") * (F.log10(F.col("wc") + 0.5) - F.lit(norm))).otherwise(0.0))).alias("base"),
        (F.sum("lp") + F.sum(F.when(rare, F.col("tf") * F.col("wlp")).otherwise(0.0))).alias("lp"))
    each = F.col("rows")
    out = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), each)))
    return out.select(
        F.col("id").alias(id_col), held_out("id", folds, fold).alias("held_out"),
        (F.col("tokens") / each).cast("long").alias("n_tokens"), (F.col("known") / each).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") / each).alias("base_score"),
        (F.col("lp") / each).alias("score"))
