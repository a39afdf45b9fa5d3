import numpy as np
import pytest
from pyspark.sql import functions as F

from recfold.llm import ann as A


def brute(rows, k, queries):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, q in good:
        if queries(i):
            s = {}
            for j, x in good:
                if j != i:
                    s.setdefault(j, []).append(float((q * x).sum() / np.sqrt((q * q).sum()) / np.sqrt((x * x).sum())))
            best = sorted(((-c, j) for j, cs in s.items() for c in set(cs)))[:k]
            out[i] = [(j, -c) for c, j in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 48))
    v = centres[rng.integers(8, size=700)] + 0.5 * rng.standard_normal((700, 48))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies, ids above and below the query's
    rows += [(2000, None), (2001, [0.0] * 48), (2002, [None] + [1.0] * 47), (2003, [float("nan")] + [1.0] * 47),
             (2004, [float("inf")] * 48), (2005, [1.0, 2.0]), (None, rows[3][1])]
    return rows


def test_recall_order_and_scores(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, id int")
    single = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    want = brute([r for r in single if r[1] is None or len(r[1]) == 48], 5, lambda i: i % 10 == 0)
    got = found(A.search(df, F.col("id") % 10 == 0, group=300, block=25))
    assert set(got) == set(want)
    assert recall(got, want) >= 0.99
    exact = {(q, j): s for q, w in want.items() for j, s in w}
    for q, w in got.items():
        assert [s for _, s in w] == sorted((s for _, s in w), reverse=True)
        assert len(w) == 5 and all(abs(exact.get((q, j), s) - s) < 1e-12 for j, s in w)


def test_ties_go_to_smaller_ids_and_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0])] + [(i, [0.0, 1.0]) for i in (9, 4, 7, 5, 8, 6, 3)], "vec_id long, embedding array<float>")
    assert [j for j, _ in found(A.search(df, F.col("id") == 0))[0]] == [3, 4, 5, 6, 7]
    assert [j for j, _ in found(A.search(df, F.col("id") == 4))[4]] == [3, 5, 6, 7, 8]
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [j for j, _ in found(A.search(two, F.col("id") == 0))[0]] == [1]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert A.report(df).collect() == []


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((3000, 64)), rng.standard_normal((40, 64))
    centre, turn = x.mean(axis=0), A.rotation(64)
    assert turn.shape == (64, 256) and np.allclose(turn @ turn.T, np.eye(64))
    codes, away, own = A.encode(x, centre, turn)
    assert codes.shape == (3000, 4) and codes.dtype == np.uint64
    length = np.linalg.norm(x, axis=1)
    lo, hi = A.bounds(A.Query(q, centre, turn), q, codes, away, own, x @ centre, length, centre)
    cos = q @ x.T / length / np.linalg.norm(q, axis=1)[:, None]
    assert ((lo <= cos) & (cos <= hi)).mean() > 0.94
    assert (hi - lo).mean() < 0.25
