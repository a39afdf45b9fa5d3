import hashlib
import re

import pytest

from recfold.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=10):
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids, any_hit = set(), set(), False
        for item, x in items:
            iw = words(x)
            k = min(n, len(iw))
            for i in range(len(iw) - k + 1) if k else ():
                for j in range(len(w) - k + 1):
                    if w[j:j + k] == iw[i:i + k]:
                        hit.update(range(j, j + k))
                        if item is not None:
                            ids.add(str(item))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it sleeps for a day"), (2, "Short ÜBER item"), (10, "one"),
         (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (3, None), (4, "  ...  "), (None, "null id item words here"),
         (11, "Short ÜBER item")]
DOCS = [(1, "x y the QUICK, brown-fox jumps over the lazy dog and then it ran"), (2, "a short Über! item and short ÜBER item"), (3, None), (4, ""),
        (5, "...%%%"), (6, "one and one"), (6, "one and one"), (None, "null id item words here"), (7, "quick brown fox jumps over"),
        (8, "z " * 30_000 + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda " + "z" * 100_000),
        (9, "item"), (10, "short über"), (11, "éone one1 oneé")]


@pytest.mark.parametrize("slices", [D.SLICE_WINDOWS, 4])
def test_equals_brute_force(spark, slices):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(d, t, "c") for d, t in DOCS], "doc_id long, text string, len string").repartition(3)
    found = D.find_hits(docs, items, slice_windows=slices)
    got = sorted([(r["doc_id"], r["__n_words"], len(r["__words"]), len(r["__items"]),
                   hashlib.sha256(",".join(r["__items"]).encode()).hexdigest(), bool(r["__words"])) for r in found.collect()], key=str)
    assert got == brute(DOCS, ITEMS)


def test_removal(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    clean = {str(x[0]) for x in brute(DOCS, ITEMS) if not x[5]}
    assert {str(r["doc_id"]) for r in D.decontaminate(docs, items).collect()} == clean
    cut = D.decontaminate(docs, items, remove="spans").collect()
    assert len(cut) == len(DOCS)
    assert {r["text"] for r in cut if r["doc_id"] == 6} == {" and "}
    assert [r["text"] for r in cut if r["doc_id"] == 9] == ["item"]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.report(none, items).collect() == []
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    left = D.report(docs, items.limit(0)).collect()
    assert len(left) == len(DOCS) and not any(r["contaminated"] for r in left)


@pytest.mark.parametrize("piece", [16, 50, 300])
def test_long_texts_in_pieces(monkeypatch, piece):
    import numpy as np
    rows = [{"len": k, "gram": g, "items": [i]} for k, g, i in (
        (10, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10", "7"), (2, "short item", "8"), (1, "one", None), (10, "x x x x x x x x x x", "9"))]
    grams = D._HashSet(rows)
    rng = np.random.default_rng(piece)
    for _ in range(20):
        parts = rng.choice(["a1 a2 a3 a4 a5 a6 a7 a8 a9 a10", "short, item", "ONE", "x x x x x x x", "zz" * 40, "... é ", "b c d"], 60)
        buf = np.frombuffer((" ".join(parts) + rng.choice(["", " ", "w" * 400])).encode(), np.uint8)
        monkeypatch.setattr(D, "PIECE_BYTES", 1 << 20)
        whole = D._scan_long(buf, grams, D._Powers())
        monkeypatch.setattr(D, "PIECE_BYTES", piece)
        assert D._scan_long(buf, grams, D._Powers()) == whole and whole[1]
        assert whole[0] == len(words(buf.tobytes().decode()))
