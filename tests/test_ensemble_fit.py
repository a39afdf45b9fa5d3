"""Weights of the least absolute error with a proven gap, and stacking on out-of-fold features."""

import numpy as np
import pytest

from recfold.operators import ensemble as E
from recfold.operators import models as M

FITS = {"item_mean": M.fit_item_mean, "user_mean": M.fit_user_mean, "bias": M.fit_bias}


def _frames(spark, y, preds):
    truth = spark.createDataFrame([(i, i % 7, float(v)) for i, v in enumerate(y)], "user_id bigint, movie_id bigint, rating double")
    rows = [(f"m{j}", i, i % 7, float(p[i])) for j, p in enumerate(preds) for i in range(len(y))]
    return spark.createDataFrame(rows, "model string, user_id bigint, movie_id bigint, predicted_rating double"), truth


@pytest.mark.parametrize("models", [1, 2, 3])
def test_least_absolute_error_is_proven_and_not_beaten(spark, models):
    rng = np.random.default_rng(models)
    y = rng.integers(1, 6, 400).astype(float)
    preds = [y + rng.normal(0.1 * j, 1 + 0.2 * j, 400) for j in range(models)]
    long, truth = _frames(spark, y, preds)
    names = [f"m{j}" for j in range(models)]
    w, mae, bound = E.least_mae(long, truth, names)
    assert bound <= mae + 1e-12 and mae - bound < 1e-6
    assert abs(w.sum() - 1) < 1e-9 and w.min() >= 0
    assert np.isclose(mae, np.abs(w @ np.array(preds) - y).mean())
    grid = rng.dirichlet(np.ones(models), 3000)
    assert np.abs(grid @ np.array(preds) - y).mean(1).min() >= bound - 1e-9


def test_least_absolute_error_without_common_pairs(spark):
    long, truth = _frames(spark, [], [[], []])
    w, mae, bound = E.least_mae(long, truth, ["m0", "m1"])
    assert list(w) == [0.5, 0.5] and mae is None and bound is None


@pytest.fixture(scope="module")
def noise(spark):
    """Ratings without any structure: what a stacker finds in them is leaked."""
    rng = np.random.default_rng(11)
    pairs = {(int(u), int(i)) for u, i in zip(rng.integers(0, 150, 1500), rng.integers(0, 400, 1500))}
    rows = [(u, i, int(r)) for (u, i), r in zip(sorted(pairs), rng.integers(1, 6, len(pairs)))]
    return spark.createDataFrame(rows, "user_id bigint, movie_id bigint, rating int")


def test_features_never_saw_their_row(spark, noise):
    out = E.out_of_fold_features(noise, FITS, folds=4).toPandas().merge(noise.toPandas(), on=["user_id", "movie_id"])
    assert len(out) == noise.count() and sorted(out.fold.unique()) == [0, 1, 2, 3]
    for (u, m), row in out.set_index(["user_id", "movie_id"]).iloc[:60].iterrows():
        rest = out[out.fold != row.fold]
        mine, its = rest[rest.user_id == u].rating, rest[rest.movie_id == m].rating
        assert row.n_user_ratings == len(mine) and row.n_item_ratings == len(its)
        assert np.isclose(row.item_avg, its.mean() if len(its) else rest.rating.mean())
        assert np.isclose(row.pred_user_mean, mine.mean() if len(mine) else rest.rating.mean())
    inside = E.meta_features(M.predict_long([f(noise) for f in FITS.values()], noise), noise, noise, list(FITS)).toPandas()
    inside = inside.merge(noise.toPandas(), on=["user_id", "movie_id"])
    assert inside.item_avg.corr(inside.rating) > 0.3 > 0.15 > out.item_avg.corr(out.rating)


def test_ridge_solves_its_normal_equations(spark, noise):
    feats = E.out_of_fold_features(noise, FITS, folds=3)
    _, model = E.fit_stack(feats, noise, list(FITS), "ridge", alpha=1.0)
    data = feats.toPandas().merge(noise.toPandas(), on=["user_id", "movie_id"])
    x, y = data[E._features(list(FITS))].to_numpy(float), data.rating.to_numpy(float)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(np.array(model.coefficients), want, atol=1e-5)
    assert np.isclose(model.intercept, y.mean() - x.mean(0) @ want, atol=1e-4)


def test_wide_scores_equal_long_ones_with_few_shuffles(spark, noise):
    models = [f(noise) for f in FITS.values()]
    for m, name in zip(models, FITS):
        m.name = name
    pairs = spark.createDataFrame([(1, 2), (1, 2), (3, 4), (10_000, 4), (3, 10_000), (None, 4), (3, None)], "user_id bigint, movie_id bigint")
    wide = M.predict_wide(models, pairs)
    long = E.wide(M.predict_long(models, pairs), list(FITS))
    want = pairs.join(long, ["user_id", "movie_id"], "left")
    columns = ["user_id", "movie_id", *[f"pred_{m}" for m in FITS]]
    assert sorted(map(str, wide.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    held = noise.select("user_id", "movie_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.predict_wide(models, held, [noise.groupBy("movie_id").count()], [noise.groupBy("user_id").agg({"rating": "max"})])
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
    assert len(joins) >= 6 and all("movie_id" in j for j in joins[-3:])


def test_boosting_reads_written_rows_in_few_parts(spark, noise, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    seen, fit, size = [], GBTRegressor.fit, noise.count()

    def spy(self, data, params=None):
        seen.append((len(data.inputFiles()) > 0, data.rdd.getNumPartitions(), data.count()))
        return fit(self, data, params)

    monkeypatch.setattr(GBTRegressor, "fit", spy)
    feats = E.out_of_fold_features(noise, FITS, folds=2).repartition(6)
    E.fit_stack(feats, noise, list(FITS), "gbt", max_iter=2)
    monkeypatch.setattr(E, "BOOSTED_ROWS", -(-size // 3))
    va, model = E.fit_stack(feats, noise, list(FITS), "gbt", max_iter=2)
    assert seen == [(True, 1, size), (True, 3, size)]
    assert model.getNumTrees == 2 and E.predict_stack(va, model, feats).count() == size
