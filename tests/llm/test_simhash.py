import itertools

import numpy as np
import pytest
import xxhash

from recfold.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string"


def brute_fp(text, k=4):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, max_bits):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= max_bits:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted((d if d is not None else -1, f"{fps[i]:016x}", ids.get(find(i))) for i, (d, _) in enumerate(rows))


def documents():
    rng = np.random.default_rng(3)
    words = ["w%d" % i for i in range(60)] + ["Ünder", "ÉTÉ", "x y"]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choice(words, 120))))
    for i in range(60, 120):  # near copies: one word changed
        base = rows[i % 20][1].split(" ")
        base[int(rng.integers(len(base)))] = "changed%d" % i
        rows.append((i, "\t ".join(base).upper() if i % 3 else " ".join(base)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "one"), (5, rows[5][1]), (5, "other text here it is"),
             (None, rows[7][1]), (None, "lonely words without an id here"), (206, "long " * 30_000)]
    return rows


@pytest.mark.parametrize("max_bits,block", [(4, 20_000), (7, 6)])
def test_components_equal_brute_force(spark, max_bits, block):
    rows = documents()
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    got = S.near_duplicates(df, 4, max_bits, block=block).select("doc_id", S.hex_fingerprint().alias("f"), "component_id")
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in got.collect())
    assert got == brute_components(rows, max_bits)


def test_keep_one_keeps_columns_and_one_row_each(spark):
    rows = documents()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in brute_components(rows, 4)}
    got = [r["doc_id"] for r in kept.collect()]
    assert len(got) == len({r["root"] for r in S.near_duplicates(df).collect()})
    assert {x for x in got if x is not None} == {c for c in want if c is not None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.report(df).collect() == []
    assert S.keep_one(df).collect() == []


def test_thresholds_satisfy_the_pigeonhole_rule():
    costs = [[0, 1, 5, 30, 99, 400], [0, 9, 10, 11, 12, 13], [0, 50, 60, 70, 80, 90]]
    cost, ts = S.allot(costs, 4)
    assert sum(t + 1 for t in ts) == 5
    best = min((sum(c[t + 1] for c, t in zip(costs, x)), x) for x in itertools.product(range(-1, 5), repeat=3)
               if sum(t + 1 for t in x) == 5)
    assert cost == best[0]


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (4000, 64))
    for k in range(8):
        bits[:, 8 * k + 1:8 * k + 8] = bits[:, [8 * k]]
    groups = S.group_bits(4000, (bits.T @ bits).astype(float), 8)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert sorted(groups) == [list(range(8 * k, 8 * k + 8)) for k in range(8)]
