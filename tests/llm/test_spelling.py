import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from recfold.llm import spelling as S

SCHEMA = "doc_id long, text string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[p + 1:] == b[p + 1:]
    a, b = sorted((a, b), key=len)
    return a[p:] == b[p + 1:]


def brute(rows, every=199, min_length=6, min_count=5):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    out = {}
    for w, c in n.items():
        ns = [x for x in n if near(w, x)]
        best = min(ns, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 5 * c else None
        out[w] = [w, form, None, c, len(ns), n[form] if form else None]
    for w, r in out.items():
        x = w
        while out[x][1]:
            x = out[x][1]
        r[2] = x
    return sorted(map(tuple, out.values()))


def run(spark, rows, **kw):
    got = S.variants(spark.createDataFrame(rows, SCHEMA), **kw)
    return sorted(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect())


def texts(seed, n_words=250, docs=60):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abéÿ×"), rng.integers(5, 11))) for _ in range(n_words)]
    for w in base[:80]:  # planted variants
        i = int(rng.integers(len(w)))
        base += [w[:i] + w[i + 1:], w[:i] + "b" + w[i:], w[:i] + "a" + w[i + 1:]]
    freq = rng.zipf(1.3, len(base)).clip(1, 400)
    p = freq / freq.sum()
    return [(d, " ".join(w.upper() if rng.random() < .1 else w for w in rng.choice(base, 300, p=p))) for d in range(docs)]


@pytest.mark.parametrize("block", [4096, 16])
def test_variants_against_definition(spark, block, monkeypatch):
    monkeypatch.setattr(S, "SMALL", 4 if block == 16 else 48)
    monkeypatch.setattr(S, "TILE", 7 if block == 16 else 512)
    rows = texts(block)
    want = brute(rows, every=19)
    assert sum(r[1] is not None for r in want) > 20 and max(r[4] for r in want) > 2
    assert run(spark, rows, every=19, block=block) == want


def test_chain_of_forms_and_ties(spark):
    words = {"abcdefg": 3125, "abcdefx": 625, "abcdexx": 125, "abcdxxx": 25, "abcxxxx": 5, "zbcxxxx": 5, "qqqqqq": 30, "qqqqqqq": 30, "qqqqq1": 9}
    rows = [(1, " ".join(w for w, c in words.items() for _ in range(c)))]
    want = brute(rows, every=10 ** 12)
    assert run(spark, rows, every=10 ** 12) == want
    assert dict((r[0], r[2]) for r in want)["zbcxxxx"] == "abcdefg" or dict((r[0], r[2]) for r in want)["abcxxxx"] == "abcdefg"


def test_damage_rule(spark):
    rows = [(d, "Wordlike ÀÉÎõü× deeper " * 3) for d in range(700)] + [(None, "wordlike" * 2 + " " + "nullword " * 9)]
    assert run(spark, rows) == brute(rows)


def test_empty_null_long_and_repeated(spark):
    assert run(spark, []) == []
    long = "x" * 50_000
    rows = [(1, None), (1, ""), (None, None), (2, "12 .. 7"), (3, " ".join([long, long + "y", long[1:] + "z"] * 5 + ["short"] * 9))]
    rows += [(4, "Repeated repeatEd")] * 6
    want = brute(rows)
    assert run(spark, rows) == want and any(len(r[0]) > 40_000 for r in want)


def test_near_rows_is_single_edit():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(6, 9))) for _ in range(200)})
    for width in (7, 8):
        for tail in (False, True):
            some = [w for w in words if len(w) in (width, width - 1)]
            mat = S.code_points([w.rjust(width, "\0") if tail else w for w in some], width)
            size = np.array([len(w) for w in some])
            got = {(some[i], some[j]) for i, j in zip(*S._tile(mat, size, np.arange(len(some)), np.arange(len(some)), tail, 99)) if i != j}
            want = {(a, b) for a in some for b in some if near(a, b) and max(len(a), len(b)) == width}
            assert got == want
            a, b = np.repeat(np.arange(len(some)), len(some)), np.tile(np.arange(len(some)), len(some))
            ok = S.near_rows(mat[a], mat[b], size[a], size[b], tail, 99) & (a != b)
            assert {(some[i], some[j]) for i, j in zip(a[ok], b[ok])} == want


def test_clashing_columns(spark):
    rows = [(1, "planet planet planet planet planet", 5, "x")]
    df = spark.createDataFrame(rows, SCHEMA + ", word int, n string")
    assert [r.word for r in S.report(df).collect()] == ["planet"]
