import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recfold.llm import lattice_lm as L

DOCS = [(i, t) for i, t in enumerate(["The cat sat", "the cat  ran\taway", "A dog ran", "zzzqx ünïcode 漢字 cat", None, "", " \n", "the the the the",
                                      "cat " * 3000, "x" * 9000, "dog sat the mat", "unseen words alone here"])] + [(3, "zzzqx"), (3, "zzzqx"), (None, "cat dog")]


def spell(word, pieces):
    """Sum over all segmentations, in plain probabilities."""
    s = L.MARK + word
    p = [1.0] + [0.0] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(j):
            if s[i:j] in pieces.logp:
                p[j] += p[i] * math.exp(pieces.logp[s[i:j]])
        if s[j - 1] not in pieces.logp:
            p[j] += p[j - 1] * math.exp(sum(pieces.byte[b] for b in s[j - 1].encode()))
    return p[-1]


def test_forward_recursion_sums_all_segmentations():
    _, names, byte_ids, end = L.read_vocabulary(L.VOCABULARY)
    counts = np.arange(len(names), dtype=float) % 17
    pieces = L.Pieces(names, byte_ids, end, counts)
    for w in ("the", "a", "ünïcode", "漢字", "unseenwords", "zz\x00z"):
        assert pieces.word(w) == pytest.approx(math.log(spell(w, pieces)), rel=1e-12)
    total = sum(map(math.exp, [*pieces.logp.values(), *pieces.byte.values(), pieces.end]))
    assert total == pytest.approx(1.0)


@pytest.mark.parametrize("frequent", [L.FREQUENT, 2])
def test_scores_equal_brute_force(spark, frequent):
    docs = spark.createDataFrame([(d, t, 5) for d, t in DOCS], "doc_id long, text string, word int").repartition(3)
    got = L.score(docs, frequent=frequent).collect()
    low = lambda t: re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1
    end = object()
    count = Counter(x for d, t in DOCS if not held(d) for x in [*low(t), end])
    n, v = sum(count.values()), len(count)
    base = lambda t: sum(math.log10((count[x] + .5) / (n + .5 * (v + 1))) for x in [*low(t), end])
    proto, names, byte_ids, end_id = L.read_vocabulary(L.VOCABULARY)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    pc = np.zeros(len(names))
    for w, c in count.items():
        for i in [end_id] if w is end else sp.encode(w, out_type=int):
            pc[i] += c
    pieces = L.Pieces(names, byte_ids, end_id, pc)
    want = sorted((str(d), held(d), len(low(t)) + 1, sum(count[x] > 0 for x in [*low(t), end]), n, round(base(t), 6),
                   round((sum(pieces.word(x) for x in low(t)) + pieces.end) / math.log(10), 6)) for d, t in DOCS)
    have = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
                  for r in got)
    assert have == want


def test_empty(spark):
    assert L.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
