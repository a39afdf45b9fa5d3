"""Preprocessing, splits, matrix and graph cases (FIXTURES A1, A2) plus
invariants and brute-force checks of the scalable rewrites."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recfold.operators import graph as G
from recfold.operators import prep as P
from recfold.operators import splits as S
from recfold.operators import stats as A


def test_kcore_drops_user_2(spark, ratings_a1):
    out = P.k_core(ratings_a1, 3, 1)
    assert sorted({r.user_id for r in out.collect()}) == [1, 3]


def test_dense_ids_contiguous(spark, ratings_a1):
    enc = P.encode(ratings_a1).collect()
    assert sorted({r.user_idx for r in enc}) == [0, 1, 2]
    assert sorted({r.movie_idx for r in enc}) == [0, 1, 2, 3, 4]
    # ascending numeric id order
    assert {(r.movie_id, r.movie_idx) for r in enc} == {(10, 0), (20, 1), (30, 2), (40, 3), (50, 4)}


def test_dense_ids_many_buckets_match_rank(spark):
    ids = np.random.default_rng(1).choice(10**7, 3000, replace=False)
    df = spark.createDataFrame([(int(i),) for i in ids], "user_id long")
    got = {r.orig_id: r.idx for r in P.dense_ids(df, "user_id", shift=8).collect()}
    want = {int(v): i for i, v in enumerate(sorted(ids))}
    assert got == want


def test_sparsity(spark, ratings_a1):
    assert A.sparsity(ratings_a1).first()["sparsity"] == pytest.approx(1 - 10 / 15)


@pytest.mark.parametrize("ratios,expect", [
    ((0.7, 0.1, 0.2), {1: (2, 1, 0), 2: (1, 1, 0), 3: (3, 1, 1)}),
    ((0.6, 0.2, 0.2), {1: (1, 1, 1), 2: (1, 1, 0), 3: (3, 1, 1)}),
])
def test_temporal_split_cuts(spark, ratings_a1, ratios, expect):
    sp = S.split_temporal_per_user(ratings_a1, *ratios).toPandas()
    for u, (tr, va, te) in expect.items():
        g = sp[sp.user_id == u].split.value_counts()
        assert (g.get("train", 0), g.get("val", 0), g.get("test", 0)) == (tr, va, te)


def test_ieee_cut_table(spark):
    # n=20 -> (14, 15) and n=30 -> (21, 23) in DOUBLE arithmetic
    rows = [(1, m, 3, pd.Timestamp("2000-01-01") + pd.Timedelta(days=m)) for m in range(20)] + \
           [(2, m, 3, pd.Timestamp("2000-01-01") + pd.Timedelta(days=m)) for m in range(30)]
    df = spark.createDataFrame([(u, m, r, d.date()) for u, m, r, d in rows],
                               "user_id long, movie_id long, rating int, date date")
    sp = S.split_temporal_per_user(df).toPandas()
    c = sp.groupby(["user_id", "split"]).size()
    assert (c[(1, "train")], c[(1, "val")]) == (14, 1)
    assert (c[(2, "train")], c[(2, "val")]) == (21, 2)


def test_split_integrity(spark, ratings_a1):
    r = S.split_integrity(S.split_temporal_per_user(ratings_a1)).first()
    assert r["n_order_violations"] == 0 and r["n_shared_pairs"] == 0


def _brute_ratings(spark, n_users=60, n_items=80, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(n_users):
        items = rng.choice(n_items, rng.integers(1, 30), replace=False)
        for i in items:
            rows.append((u, int(i), int(rng.integers(1, 6)), pd.Timestamp("2001-01-01") + pd.Timedelta(days=int(rng.integers(0, 40)))))
    pdf = pd.DataFrame(rows, columns=["user_id", "movie_id", "rating", "date"])
    pdf["date"] = pdf["date"].dt.date
    return spark.createDataFrame(pdf, "user_id long, movie_id long, rating int, date date"), pdf


def test_global_temporal_split_exact(spark):
    df, pdf = _brute_ratings(spark)
    sp = S.split_temporal_global(df, 0.1, 0.1).toPandas()
    pdf = pdf.sort_values(["date", "user_id", "movie_id"]).reset_index(drop=True)
    n = len(pdf)
    te, ve = int(n * (1 - 0.1 - 0.1)), int(n * (1 - 0.1))
    want = dict(zip(zip(pdf.user_id, pdf.movie_id), ["train"] * te + ["val"] * (ve - te) + ["test"] * (n - ve)))
    got = dict(zip(zip(sp.user_id, sp.movie_id), sp.split))
    assert got == want


def test_random_splits_sizes(spark):
    df, pdf = _brute_ratings(spark)
    n = len(pdf)
    g = S.split_random_global(df, 0.7, 0.1, 0.2).groupBy("split").count().toPandas().set_index("split")["count"]
    assert g["train"] == int(n * 0.7) and g["train"] + g["val"] == int(n * (0.7 + 0.1))
    w4 = S.split_random_per_user(df, 0.1, 0.1).toPandas()
    for u, grp in w4.groupby("user_id"):
        m = len(grp)
        assert (grp.split == "test").sum() == min(m, max(1, int(m * 0.1)))


def test_interactions_and_edges(spark):
    df = spark.createDataFrame([(0, 0, 5), (0, 1, 4), (1, 0, 3), (1, 2, 5), (2, 1, 4)],
                               "user_idx long, movie_idx long, rating int")
    nb = G.neighbours(df, "user_idx", "movie_idx", "rating").where("user_idx = 0").collect()
    assert sorted(r.movie_idx for r in nb) == [0, 1]
    e = G.edges(df, 3).collect()
    assert len(e) == 10
    assert {r.dst for r in e if r.src < 3} == {3, 4, 5}


def test_binarize_sums_duplicates(spark):
    df = spark.createDataFrame([(0, 0, 5), (0, 0, 4)], "user_id long, movie_id long, rating int")
    assert G.interactions(df, binarize=True).first()["value"] == 2.0
    assert G.interactions(df).first()["value"] == 9.0


def test_propagation_matches_dense(spark, tmp_dir):
    rng = np.random.default_rng(0)
    pairs = [(0, 0), (0, 1), (1, 1), (2, 0), (2, 2), (1, 2)]
    n_u, n_i, dim, L = 3, 3, 4, 3
    df = spark.createDataFrame(pairs, "user_idx long, movie_idx long")
    e = G.normalise(G.edges(df, n_u))
    E0 = rng.normal(size=(n_u + n_i, dim))
    emb0 = spark.createDataFrame([(n, d, float(E0[n, d])) for n in range(n_u + n_i) for d in range(dim)],
                                 "node long, dim int, val double")
    got = G.propagate(e, emb0, L).toPandas()
    A_ = np.zeros((n_u + n_i, n_u + n_i))
    for u, i in pairs:
        A_[u, n_u + i] = A_[n_u + i, u] = 1
    d = A_.sum(1)
    An = A_ / np.sqrt(np.outer(d, d))
    layers = [E0]
    for _ in range(L):
        layers.append(An @ layers[-1])
    want = sum(layers) / (L + 1)
    for r in got.itertuples():
        assert r.val == pytest.approx(want[r.node, r.dim], abs=1e-12)


def test_negative_sampling_rejects_positives(spark):
    pos = spark.createDataFrame([(u, i) for u in range(5) for i in range(0, 20, 2)], "user_id long, movie_id long")
    out = G.sample_negatives(pos, 20, reject="all").collect()
    assert len(out) == 50
    assert all(r.neg is not None and r.neg % 2 == 1 for r in out)
    full = spark.createDataFrame([(0, i) for i in range(4)], "user_id long, movie_id long")
    assert all(r.neg is None for r in G.sample_negatives(full, 4, reject="all").collect())


def test_position_within_large_group(spark):
    df = spark.createDataFrame([(1, int(v)) for v in range(0, 5000, 7)], "g long, o long")
    got = G.position_within(df, "g", "o", shift=4).toPandas().sort_values("o")
    assert list(got.pos) == list(range(len(got)))


def test_quantiles_match_numpy(spark):
    vals = np.random.default_rng(2).integers(1, 40, 501)
    df = spark.createDataFrame([(int(v),) for v in vals], "n long")
    q = A.exact_quantiles(df, "n", [0.25, 0.5, 0.9, 0.99]).first()
    for p, name in [(25, "p25"), (50, "p50"), (90, "p90"), (99, "p99")]:
        assert q[name] == pytest.approx(np.percentile(vals, p))


def test_lorenz_cut_matches_numpy(spark, ratings_a1):
    df, pdf = _brute_ratings(spark, 200, 100, 7)
    got = A.lorenz_cut(df).first()
    act = np.sort(pdf.groupby("user_id").size().values)[::-1]
    cum = np.cumsum(act) / act.sum() * 100
    idx = int(np.searchsorted(cum, 80))
    assert got["position"] == idx
    assert got["top_entity_pct"] == pytest.approx((idx + 1) / len(act) * 100)


def test_validation(spark, ratings_a1):
    from recfold.functions.portable import require_columns, validate_ratios
    with pytest.raises(ValueError):
        validate_ratios(0.7, 0.2, 0.2)
    validate_ratios(0.7, 0.1, 0.2)
    with pytest.raises(ValueError):
        require_columns(ratings_a1, ["user_id", "nope"])
    with pytest.raises(ValueError):
        S.split_temporal_per_user(ratings_a1, 0.5, 0.1, 0.1)


def test_monthly_filled_has_gaps_as_zero(spark, ratings_a1):
    m = A.monthly_filled(ratings_a1).toPandas()
    # Jan 2001 .. Jan 2004 = 37 month ends, most of them empty
    assert len(m) == 37 and m.n_ratings.sum() == 10 and (m.n_ratings == 0).sum() == 37 - 8
    assert str(m.month_end.min()) == "2001-01-31"


def test_kcore_matches_python_loop(spark):
    df, pdf = _brute_ratings(spark, 120, 60, 11)
    got = {(r.user_id, r.movie_id) for r in P.k_core(df, 6, 7).collect()}
    cur = pdf
    prev = -1
    while len(cur) != prev:
        prev = len(cur)
        uc = cur.user_id.value_counts()
        cur = cur[cur.user_id.isin(uc[uc >= 6].index)]
        mc = cur.movie_id.value_counts()
        cur = cur[cur.movie_id.isin(mc[mc >= 7].index)]
    assert got == set(zip(cur.user_id, cur.movie_id))


def test_temporal_split_matches_pandas(spark):
    df, pdf = _brute_ratings(spark, 80, 50, 5)
    got = S.split_temporal_per_user(df).toPandas()
    want = {}
    for u, g in pdf.sort_values(["user_id", "date", "movie_id"]).groupby("user_id"):
        n = len(g)
        te = max(1, int(n * 0.7))
        ve = max(te + 1, int(n * (0.7 + 0.1)))
        for pos, m in enumerate(g.movie_id):
            want[(u, m)] = "train" if pos < te else ("val" if pos < ve else "test")
    assert dict(zip(zip(got.user_id, got.movie_id), got.split)) == want
