"""Top-K against brute force, blocked catalogue path, ensembles, and model
quality bounds on planted low-rank data (FIXTURES D)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recfold.operators import ensemble as E
from recfold.operators import factor_models as FM
from recfold.operators import metrics as V
from recfold.operators import models as M
from recfold.operators import topk as TK
from recfold.operators.splits import split_temporal_per_user


@pytest.fixture(scope="module")
def planted(spark):
    """rating = clip(round(3.2 + b_u + b_i + p.q + noise), 1, 5): 500 users,
    300 items, rank 4, 15% observed, 24 months of dates; split 0.7/0.1/0.2."""
    rng = np.random.default_rng(42)
    nu, ni, r = 500, 300, 4
    bu, bi = rng.normal(0, 0.4, nu), rng.normal(0, 0.4, ni)
    P, Q = rng.normal(0, 0.6, (nu, r)), rng.normal(0, 0.6, (ni, r))
    mask = rng.random((nu, ni)) < 0.15
    u, i = np.nonzero(mask)
    raw = 3.2 + bu[u] + bi[i] + (P[u] * Q[i]).sum(1) + rng.normal(0, 0.3, len(u))
    rating = np.clip(np.round(raw), 1, 5).astype(int)
    days = rng.integers(0, 730, len(u))
    pdf = pd.DataFrame({"user_id": u, "movie_id": i, "rating": rating,
                        "date": (pd.Timestamp("2003-01-01") + pd.to_timedelta(days, unit="D")).date})
    df = spark.createDataFrame(pdf, "user_id long, movie_id long, rating int, date date")
    sp = split_temporal_per_user(df).cache()
    tr = sp.where("split = 'train'").drop("split").cache()
    va = sp.where("split = 'val'").drop("split").cache()
    te = sp.where("split = 'test'").drop("split").cache()
    return tr, va, te


def _rmse(model, test):
    p = model.score(test.select("user_id", "movie_id"))
    return V.rating_metrics(test, p).first()["rmse"]


def test_quality_order(planted):
    tr, va, te = planted
    mean = M.RatingModel("mean", None, None, mu=tr.agg(F.avg("rating")))
    bias = M.fit_bias(tr)
    svd = FM.fit_mf(tr, "svd", rank=4, max_iter=15, reg=0.1)
    nmf = FM.fit_mf(tr, "nmf", rank=4, max_iter=15, reg=0.1)
    r_mean, r_bias, r_svd, r_nmf = (_rmse(m, te) for m in (mean, bias, svd, nmf))
    assert r_svd < r_bias < r_mean
    assert r_nmf < r_mean
    assert nmf.items.select(F.min(F.array_min("q"))).first()[0] >= 0


def test_svdpp_and_grid(planted):
    tr, va, te = planted
    pp = FM.fit_svdpp(tr, rank=4, max_iter=10, reg=0.1)
    assert _rmse(pp, te) < _rmse(M.fit_bias(tr), te)
    res, best = FM.grid_search(tr, {"rank": [2, 4], "max_iter": [5], "reg": [0.1]}, folds=2)
    assert res.count() == 2 and best is not None
    ordered, pivot = FM.grid_views(res)
    assert ordered.first()["rmse"] == res.agg(F.min("rmse")).first()[0]


def test_weight_fit_beats_single_models(planted):
    tr, va, te = planted
    models = [M.fit_item_mean(tr), M.fit_user_mean(tr), M.fit_bias(tr)]
    names = [m.name for m in models]
    vp = M.predict_long(models, va)
    w = E.fit_weights(vp, va, names, "rmse")
    ws = {r.model: r.weight for r in w.collect()}
    assert abs(sum(ws.values()) - 1) < 1e-9 and min(ws.values()) >= 0
    blended = E.blend(vp, w, lo=-1e9, hi=1e9, digits=None)
    r_blend = V.rating_metrics(va, blended).first()["rmse"]
    singles = V.rating_metrics(va, vp, by=("model",)).agg(F.min("rmse")).first()[0]
    assert r_blend <= singles + 1e-9
    mae_w = E.fit_weights(vp, va, names, "mae", steps=10)
    assert abs(sum(r.weight for r in mae_w.collect()) - 1) < 1e-9


def test_stacking(planted):
    tr, va, te = planted
    models = [M.fit_item_mean(tr), M.fit_user_mean(tr), M.fit_bias(tr)]
    names = [m.name for m in models]
    feats = E.meta_features(M.predict_long(models, va), va, va, names)
    va_, gbt = E.fit_stack(feats, va, names, "gbt", max_iter=10)
    out = E.predict_stack(va_, gbt, E.meta_features(M.predict_long(models, te), va, te, names)).toPandas()
    assert out.predicted_rating.between(1, 5).all() and np.isfinite(out.predicted_rating).all()
    _, ridge = E.fit_stack(feats, va, names, "ridge")
    assert len(ridge.coefficients) == len(names) + 4


def _brute_topk(model, users, items, seen, k):
    """Score every pair with the relational scorer and rank in pandas."""
    pairs = users.crossJoin(items)  # brute force, tiny fixture only
    s = model.score(pairs, out="score").toPandas()
    seen_p = set(map(tuple, seen.select("user_id", "movie_id").toPandas().values))
    s = s[[(u, i) not in seen_p for u, i in zip(s.user_id, s.movie_id)]]
    s = s.sort_values(["user_id", "score", "movie_id"], ascending=[True, False, True])
    s["rank"] = s.groupby("user_id").cumcount() + 1
    return s[s["rank"] <= k][["user_id", "rank", "movie_id", "score"]].reset_index(drop=True)


@pytest.mark.parametrize("bound", [None, 800])
def test_topk_matches_brute_force(spark, planted, bound):
    tr, va, te = planted
    users = tr.select("user_id").distinct()
    items = tr.select("movie_id").distinct()
    for model in (M.fit_bias(tr), FM.fit_mf(tr, "svd", rank=4, max_iter=5, reg=0.1)):
        kw = {} if bound is None else {"block_bytes": bound}  # forces catalogue blocks
        got = TK.top_k(model, users, items, seen=tr, k=7, **kw).toPandas()
        got = got.sort_values(["user_id", "rank"]).reset_index(drop=True)
        want = _brute_topk(model, users, items, tr, 7)
        assert list(got.movie_id) == list(want.movie_id)
        assert np.allclose(got.score, want.score, atol=1e-9)


def test_topk_ties_and_invariants(spark):
    # every item clips to 5 for this user: ties resolve by ascending movie id
    items = spark.createDataFrame([(i, 3.0) for i in range(20, 0, -1)], "movie_id long, i_term double")
    users = spark.createDataFrame([(1, 2.0)], "user_id long, u_term double")
    m = M.RatingModel("t", users, items, mu=spark.createDataFrame([(1.0,)], "mu double"))
    seen = spark.createDataFrame([(1, 2), (1, 3)], "user_id long, movie_id long")
    recs = TK.top_k(m, users.select("user_id"), items.select("movie_id"), seen=seen, k=5).toPandas()
    assert list(recs.movie_id) == [1, 4, 5, 6, 7]
    assert list(recs["rank"]) == [1, 2, 3, 4, 5]
    assert (recs.score == 5.0).all()


def test_blend_topk_matches_relational(spark, planted):
    tr, va, te = planted
    models = [M.fit_item_mean(tr), M.fit_user_mean(tr), M.fit_bias(tr)]
    w = [0.2, 0.3, 0.5]
    users = te.select("user_id").distinct().limit(40)
    items = tr.select("movie_id").distinct()
    got = TK.top_k(TK.Blend(models, w), users, items, seen=tr, k=5).toPandas()
    pairs = users.crossJoin(items)  # brute force, tiny fixture only
    preds = M.predict_long(models, pairs)
    wdf = spark.createDataFrame(list(zip([m.name for m in models], w)), "model string, weight double")
    b = E.blend(preds, wdf).join(tr.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")
    want = TK.rank_top(b.withColumnRenamed("predicted_rating", "score"), 5).toPandas()
    key = ["user_id", "rank"]
    g, wnt = got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True)
    assert list(g.movie_id) == list(wnt.movie_id)


def test_many_models_one_pass_equals_separate(spark, planted):
    tr, va, te = planted
    models = [M.fit_item_mean(tr), M.fit_user_mean(tr), M.fit_bias(tr)]
    users = te.select("user_id").distinct()
    items = tr.select("movie_id").distinct()
    many = TK.top_k(models, users, items, seen=tr, k=5).toPandas()
    for m in models:
        one = TK.top_k(m, users, items, seen=tr, k=5).toPandas().sort_values(["user_id", "rank"])
        sub = many[many.model == m.name].sort_values(["user_id", "rank"])
        assert list(sub.movie_id) == list(one.movie_id)
        assert np.allclose(sub.score, one.score)


def test_topk_over_many_tiles_blocks_and_weights(spark, monkeypatch):
    rng = np.random.default_rng(5)
    nu, ni, r = 60, 700, 3
    up = spark.createDataFrame([(u, float(rng.normal(0, 1)), [float(x) for x in rng.normal(0, 1, r)]) for u in range(nu)],
                               "user_id long, u_term double, p array<double>")
    iq = spark.createDataFrame([(i * 7 - 900, float(rng.normal(0, 1)), [float(x) for x in rng.normal(0, 1, r)]) for i in range(ni)],
                               "movie_id long, i_term double, q array<double>")
    m = M.RatingModel("f", up, iq, mu=spark.createDataFrame([(3.0,)], "mu double"), rank=r)
    flat = M.RatingModel("u", up.drop("p"), None, mu=spark.createDataFrame([(2.0,)], "mu double"))
    users, items = up.select("user_id"), iq.select("movie_id")
    seen = spark.createDataFrame([(u, int(i) * 7 - 900) for u in range(nu) for i in rng.integers(0, ni + 5, 80)],
                                 "user_id long, movie_id long")
    monkeypatch.setattr(TK, "TILE_ITEMS", 16)
    monkeypatch.setattr(TK, "TILE_USERS", 7)
    want = _brute_topk(m, users, items, seen, 9)
    for kw in ({}, {"block_bytes": 5000}):
        got = TK.top_k(m, users, items, seen=seen, k=9, **kw).toPandas().sort_values(["user_id", "rank"])
        assert list(got.movie_id) == list(want.movie_id) and np.allclose(got.score, want.score)
    pairs = users.crossJoin(items)  # brute force, tiny fixture only
    for w in ([0.7, 0.3], [1.5, -0.5]):
        s = [x.score(pairs, out="score").toPandas().sort_values(["user_id", "movie_id"]) for x in (m, flat)]
        both = s[0].assign(score=np.round(np.clip(w[0] * s[0].score.to_numpy() + w[1] * s[1].score.to_numpy(), 1, 5), 9))
        both = both.sort_values(["user_id", "score", "movie_id"], ascending=[True, False, True]).groupby("user_id").head(4)
        got = TK.top_k(TK.Blend([m, flat], w), users, items, k=4).toPandas().sort_values(["user_id", "rank"])
        assert list(got.movie_id) == list(both.movie_id) and np.allclose(got.score, both.score)


def test_topk_takes_nulls_empty_tables_and_short_catalogues(spark):
    items = spark.createDataFrame([(3, 1.0), (4, 2.0)], "movie_id long, i_term double")
    m = M.RatingModel("t", None, items)
    users = spark.createDataFrame([(1,), (None,), (1,)], "user_id long")
    cat = spark.createDataFrame([(4,), (3,), (None,), (9,)], "movie_id long")
    got = TK.top_k(m, users, cat, seen=spark.createDataFrame([(1, 4), (1, None)], "user_id long, movie_id long"), k=5).collect()
    assert [(r.user_id, r["rank"], r.movie_id) for r in got] == [(1, 1, 3), (1, 2, 9)]
    assert TK.top_k(m, users.limit(0), cat, k=5).count() == 0 and TK.top_k(m, users, cat.limit(0), k=5).count() == 0


def test_items_are_sent_to_few_user_blocks():
    """At 6 GB: 5.4 million users with 28 seen items each, 7.2 million items of a model without factors."""
    users, items = TK._grid(5_400_000, 2 * 16 + 10 * 44 + 24 * 28, 7_200_000, 16, TK.BLOCK_BYTES, 12)
    assert 7_200_000 * 48 * users + 5_400_000 * 300 * items < 15e9


def test_all_python_workers_of_an_executor_hold_their_cells(spark, monkeypatch):
    """At 6 GB eight workers (four cores, a second one a task) keep below 4 GB: blocks count what a cell holds."""
    asked, grid = [], TK._grid
    monkeypatch.setattr(TK, "_grid", lambda *a: asked.append(a) or grid(*a))
    items = spark.createDataFrame([(i, float(i)) for i in range(1, 40)], "movie_id long, i_term double")
    users = spark.createDataFrame([(1, 2.0), (2, 1.0)], "user_id long, u_term double")
    seen = spark.createDataFrame([(1, 39), (2, 38)], "user_id long, movie_id long")
    got = TK.top_k(M.RatingModel("t", users, items, lo=None), users.select("user_id"), items.select("movie_id"), seen=seen, k=2)
    assert sorted((r.user_id, r["rank"], r.movie_id) for r in got.collect()) == [(1, 1, 38), (1, 2, 37), (2, 1, 39), (2, 2, 37)]
    _, _, _, item_bytes, block_bytes, _, *most = asked[0]
    n_users, n_items = grid(5_400_000, 2 * 16 + 10 * 44 + 24 * 28, 7_200_000, item_bytes, block_bytes, 12, *most)
    # from figures at 60 copies: 112 bytes an item, 1.24 times the estimate for users, 105 MB without either
    assert 8 * (112 * 7.2e6 / n_items + 1.24 * 5.4e6 * 1144 / n_users + 105e6) < 3.5e9
