import hashlib
import zlib

import numpy as np
import pytest

from recfold.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*map(enc, (r[0], r[3], r[2], r[4], text)))


def up(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i // 16 * 16
        out.append((i - a, nodes[a:a + 16]))
        i //= 16
    return out


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    groups = {}
    if not rows:
        return []
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        rs = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((rs, up([leaf(r, r[1]) for r in rs])))
    top = up([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for t, (rs, levels) in enumerate(trees):
        for i, r in enumerate(rs):
            p = path(levels, i) + path(top, t)
            proof = "".join(x for at, run in p for x in run[:at] + run[at + 1:])
            h = leaf(r, lower(r[1]) if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 else r[1])
            for at, run in p:
                h = H(*run[:at], h, *run[at + 1:])
            out.append((r[0], leaf(r, r[1]), levels[-1][0], root, H(proof), h, h == root))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def check(spark, rows, schema=SCHEMA):
    got = [tuple(r) for r in M.report(spark.createDataFrame(rows, schema)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    want = brute(rows)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_manifest_against_definition(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(900):
        s = rng.choice(["hot", "hot", "hot", "é", "a", None, f"s{i % 40}"])
        rows.append((int(i * 7 % 1000), "Text ÄÉ %d" % i, rng.choice(["en", None]), s, int(rng.integers(9))))
    rows += [(None, None, None, None, None), (5, "", "", "", 0), (5, "", "", "", 0), (6, None, "en", "z", 2),
             (None, "A" * 300_000, "en", "hot", 1), (None, "b", "en", "hot", 1)] + [(77, "Same", "en", "hot", 4)] * 40
    got = check(spark, rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_one_source_of_each_size(spark, n):
    check(spark, [(i, f"T{i}", "en", "s", i) for i in range(n)])


def test_ranges_smaller_than_runs(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAVES", 7)
    check(spark, [(i, f"T{i}", "en", f"s{i % 3 if i > 9 else i}", i) for i in range(300)])


def test_partial_multiproof(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 2}", i) for i in range(600)]
    book = M.manifest(spark.createDataFrame(rows, SCHEMA))
    some = book["leaves"].filter("doc_id % 97 = 3")
    got = M.prove(book, some, keep_proof=True).collect()
    want = {r[0]: r for r in brute(rows)}
    assert sorted(r.doc_id for r in got) == [i for i in range(600) if i % 97 == 3]
    for r in got:
        assert (r.leaf, r.proof_sha256, r.folded_root) == (want[r.doc_id][1], want[r.doc_id][4], want[r.doc_id][5])
        assert H(r.proof) == r.proof_sha256


def test_missing_nodes_are_minimal():
    # leaves 0..15 of 40 derive node (1, 0); the other two nodes of level 1 are missing, nothing of level 0
    got = M.missing_nodes(np.arange(16), 40)
    assert [(k, x.tolist()) for k, x in got] == [(1, [1, 2])]
    got = M.missing_nodes(np.array([3, 39]), 40)
    assert [(k, x.tolist()) for k, x in got] == [(0, [i for i in range(16) if i != 3] + list(range(32, 39))), (1, [1])]
    assert M.missing_nodes(np.arange(40), 40) == []


def test_clashing_columns(spark):
    rows = [(i, f"t{i}", "en", "s", i, 9, 9) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA + ", leaf int, part int")
    plain = M.report(spark.createDataFrame([r[:5] for r in rows], SCHEMA)).collect()
    assert sorted(M.report(df).collect()) == sorted(plain)
