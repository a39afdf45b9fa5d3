import numpy as np
import pyarrow as pa
import pytest

from recfold.llm import minhash_forest as L

SCHEMA = "doc_id long, text string"


def shingles(t):
    w = (t or "").encode().lower().split()  # bytes: A-Z only, \x20 \x09-\x0D
    return {tuple(w[i:i + min(2, len(w))]) for i in range(len(w) - min(2, len(w)) + 1)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None]
        c = min(ids, default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def run(spark, rows):
    got = L.report(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def corpus(seed, docs=160, copies=240, words=40):
    """Texts and copies with so many words changed that similarities lie around 0.8."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = [list(rng.choice(vocab, int(rng.integers(1, words * 4)))) for _ in range(docs)]
    for _ in range(copies):
        t = list(texts[int(rng.integers(len(texts)))])
        for _ in range(int(rng.integers(0, 1 + len(t) // 12))):
            t[int(rng.integers(len(t)))] = str(rng.choice(vocab))
        texts.append(t)
    return [(int(i), " ".join(t).title() if rng.random() < .2 else "\n".join(t)) for i, t in zip(rng.permutation(len(texts)), texts)]


@pytest.mark.parametrize("region,block,set_bytes", [(16, 4096, 4 << 20), (2, 8, 2000)])
def test_groups_against_definition(spark, monkeypatch, region, block, set_bytes):
    monkeypatch.setattr(L, "REGION", region)
    monkeypatch.setattr(L.candidates, "__defaults__", (block,))
    monkeypatch.setattr(L.confirm, "__defaults__", (set_bytes,))
    rows = corpus(region)
    want = brute(rows)
    assert 100 < sum(r[3] for r in want) < 330
    assert run(spark, rows) == want


def test_large_group_and_common_line(spark, monkeypatch):
    monkeypatch.setattr(L.candidates, "__defaults__", (32,))
    monkeypatch.setattr(L.confirm, "__defaults__", (3000,))
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:int(rng.integers(50, 60))], f"own{i % 90}"])) for i in range(200)]
    rows += [(200 + i, "this very common line of text " + " ".join(f"x{i}y{k}" for k in range(int(rng.integers(1, 12))))) for i in range(150)]
    rows += [(500 + i, "exact copy of one text here") for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_null_empty_long_repeated_ties(spark):
    assert run(spark, []) == []
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(3, None), (None, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "ONE"), (None, "one"), (None, "only null"), (None, "only  null"),
            (8, long), (9, long + " more"), (9, long + " more"), (2, "É a"), (1, "é a"), (10, "a\x1cb c"), (11, "a b c"), (12, " a b"),
            (13, "word\x0bword word\x0cword"), (14, "word word"), (15, "a b a b a"), (16, "b a b a")]
    assert run(spark, rows) == brute(rows)


def test_shingle_sets_and_chance():
    rows = [t for _, t in corpus(9, 50, 50)] + ["", "x", "x y", "x x x"]
    flat, off = L.shingle_sets(pa.array(rows, pa.large_string()))
    assert np.diff(off).tolist() == [len(shingles(t)) for t in rows]
    # recall at the threshold, and what the sketch lets through
    assert (1 - 0.8 ** L.DEPTH) ** L.TREES < 1e-7
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, (300, 90)).astype(np.uint64)
    b = a.copy()
    b[:, :10] = rng.integers(0, 1 << 63, (300, 10)).astype(np.uint64)  # 80 of 100 in common
    both = np.concatenate([np.sort(x) for pair in zip(a, b) for x in pair])
    m = L._minima(both, np.arange(601) * 90)
    same = (m[::2] == m[1::2]).mean()
    assert abs(same - 0.8) < 0.01
    s = np.concatenate((np.full((600, 1), 90), L._sketch(m).view(np.int64)), axis=1)
    assert L._alike(s[::2], s[1::2]).all()
    assert L._alike(s[:-2:2], s[2::2]).mean() < 0.01
    trees = (m[::2] == m[1::2]).reshape(300, L.TREES, L.DEPTH).all(axis=2).any(axis=1)
    assert trees.all()


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "k"), (2, "a b c", 6, "k")], SCHEMA + ", n int, key string")
    assert sorted(map(tuple, L.report(df).collect())) == [(1, 2, 1, True), (2, 2, 1, False)]
