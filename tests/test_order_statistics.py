"""Numbering, quantiles and splits by selection: any ids, any number of distinct values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recfold.operators import analysis as N
from recfold.operators import prep as P
from recfold.operators import splits as S
from recfold.operators import stats as A
from recfold.operators.factor_models import item_pca
from recfold.sinks.writers import fixed6


@pytest.mark.parametrize("bits", [4, 16, 31])
def test_hashed_ids_are_numbered_in_order(spark, bits):
    ids = spark.range(4000).select(F.xxhash64("id").alias("id"))
    edge = spark.createDataFrame([(-2 ** 63,), (2 ** 63 - 1,), (-1,), (0,), (0,), (None,)], "id bigint")
    rows = P.dense_ids(ids.union(edge), "id", bits).orderBy("orig_id").collect()
    assert [r["idx"] for r in rows] == list(range(4004))
    assert rows[0]["orig_id"] == -2 ** 63 and rows[-1]["orig_id"] == 2 ** 63 - 1


@pytest.mark.parametrize("kind", ["continuous", "wide", "ties", "two", "one", "none"])
def test_quantiles_of_any_column(spark, kind):
    rng = np.random.default_rng(7)
    x = {"continuous": rng.normal(size=20000), "wide": np.exp(rng.normal(0, 80, 5000)) * rng.choice([-1, 1], 5000),
         "ties": np.r_[np.zeros(4000), rng.normal(size=3000), np.ones(5000)], "two": np.repeat([1.0, 2.0], 500),
         "one": np.array([3.5]), "none": np.array([])}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = A.exact_quantiles(df, "x", probs).first()
    want = [None] * 7 if kind == "none" else np.quantile(x, probs)
    for g, w in zip(got, want):
        assert g is w if w is None else math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-300)


def test_order_statistics_at_every_rank(spark):
    x = np.r_[np.arange(60) % 7, np.linspace(2, 5, 41), [float("inf"), float("-inf")]]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    n, at = A.order_statistics(df, "x", lambda n: list(range(n)))
    assert n == len(x) and [at[r] for r in range(n)] == sorted(x)


def test_quantiles_use_no_window(spark):
    df = spark.range(1000).select(F.rand(1).alias("x"))
    plan = A.describe(df, "x")._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_random_split_follows_the_hash_order_inside_a_bucket(spark):
    # 3000 rows in few hash buckets, and pairs that tie on the hash
    df = spark.range(3000).select((F.col("id") % 50).alias("user_id"), F.expr("id div 50").alias("movie_id"), F.lit(3).alias("rating"))
    df = df.union(df.select(F.col("user_id") + 2147483647, "movie_id", "rating"))
    out = S.split_random_global(df, 0.7, 0.1, 0.2).withColumn("h", S.portable_hash("user_id", "movie_id", 42)).toPandas()
    out = out.sort_values(["h", "user_id", "movie_id"])
    cuts = [int(6000 * 0.7), int(6000 * (0.7 + 0.1))]
    assert list(out.split) == ["train"] * cuts[0] + ["val"] * (cuts[1] - cuts[0]) + ["test"] * (6000 - cuts[1])


def test_key_figures_against_pandas(spark, ratings_a1):
    pdf = ratings_a1.toPandas()
    row = A.key_figures(ratings_a1).first()
    assert (row.n_ratings, row.n_users, row.n_movies) == (len(pdf), pdf.user_id.nunique(), pdf.movie_id.nunique())
    assert math.isclose(row.rating_mean, pdf.rating.mean()) and math.isclose(row.sparsity, 1 - 10 / 15)
    assert row.top_movie_share == 1.0


def test_popularity_histograms_and_medians(spark):
    train = spark.createDataFrame([(u, m) for m in range(1, 40) for u in range(m)], "user_id bigint, movie_id bigint")
    recs = spark.createDataFrame([(u, m) for u in range(30) for m in (39, 38, 5, 99)], "user_id bigint, movie_id bigint")
    got = N.popularity_histograms(recs, train, 10).toPandas()
    for series, v in (("catalogue", np.log1p(np.arange(1, 40))), ("recommended", np.log1p(np.tile([39, 38, 5, 0], 30)))):
        part = got[got.series == series].sort_values("bin")
        want = np.histogram(v, 10)[0]
        full = np.zeros(10, int)
        full[part.bin.to_numpy()] = part.n
        assert list(full) == list(want) and math.isclose(part.bin_hi.max(), v.max())
    med = N.popularity_compare(recs, train).first()
    assert math.isclose(med.median_log_pop_catalogue, np.log1p(20)) and math.isclose(
        med.median_log_pop_recs, (np.log1p(38) + np.log1p(5)) / 2)


def test_item_pca_against_the_covariance(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)) @ np.diag([5, 3, 1, .5, .2, .1]) + 7
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "movie_id bigint, emb array<double>")
    proj, share = item_pca(df, 2)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(share, values[::-1][:2] / values.sum())
    want = (x - x.mean(0)) @ vectors[:, ::-1][:, :2]
    got = proj.orderBy("movie_id").select("pc1", "pc2").toPandas().to_numpy()
    assert np.allclose(np.abs(got), np.abs(want))


def test_six_decimals_come_from_the_binary_value(spark):
    x = [3.4548625, 0.5, -0.0000004, 1e12, None, 2.0000005]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, v double").select("i", fixed6(F.col("v")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [None if v is None else f"{v:.6f}" for v in x]
