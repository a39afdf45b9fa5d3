"""Literal metric cases (FIXTURES A3, A4) plus the extra edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from recfold.operators import metrics as V


def _rating(spark, y, p):
    test = spark.createDataFrame([(i, i, float(v)) for i, v in enumerate(y)], "user_id long, movie_id long, rating double")
    preds = spark.createDataFrame([(i, i, float(v)) for i, v in enumerate(p)],
                                  "user_id long, movie_id long, predicted_rating double")
    return V.rating_metrics(test, preds).first()


def test_rmse_mae(spark):
    assert _rating(spark, [3, 4, 5], [2, 3, 4])["rmse"] == pytest.approx(1.0)
    assert _rating(spark, [1, 2, 3], [2, 3, 4])["mae"] == pytest.approx(1.0)
    r = _rating(spark, [1, 2, 3], [1, 2, 3])
    assert r["rmse"] == 0 and r["mae"] == 0


def test_rmse_no_overlap_raises(spark):
    test = spark.createDataFrame([(1, 1, 3.0)], "user_id long, movie_id long, rating double")
    preds = spark.createDataFrame([(2, 2, 3.0)], "user_id long, movie_id long, predicted_rating double")
    with pytest.raises(Exception):
        V.rating_metrics(test, preds).collect()


def _lists(spark, recs: dict, relevant: dict):
    rr = [(u, r + 1, m) for u, items in recs.items() for r, m in enumerate(items)]
    if not rr:
        return (spark.createDataFrame([], "user_id long, rank int, movie_id long"),
                spark.createDataFrame([], "user_id long, movie_id long"),
                spark.createDataFrame([(u,) for u in recs], "user_id long"))
    rel = [(u, m) for u, items in relevant.items() for m in items]
    recs_df = spark.createDataFrame(rr, "user_id long, rank int, movie_id long")
    rel_df = spark.createDataFrame(rel, "user_id long, movie_id long")
    users = spark.createDataFrame([(u,) for u in recs], "user_id long")
    return recs_df, rel_df, users


def _per_user(spark, recommended, relevant, k):
    recs, rel, users = _lists(spark, {1: recommended}, {1: relevant})
    rows = V.ranking_per_user(recs, rel, users, k).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize("rec,rel,k,exp", [
    ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5], 5, 1.0),
    ([1, 2, 3], [10, 11, 12], 3, 0.0),
    ([1, 2, 3, 4], [1, 3], 4, 0.5),
    ([1, 2, 3, 4, 5], [4, 5], 3, 0.0),
])
def test_precision(spark, rec, rel, k, exp):
    assert _per_user(spark, rec, rel, k)["precision"] == pytest.approx(exp)


@pytest.mark.parametrize("rec,rel,k,exp", [
    ([1, 2, 3], [1, 2, 3], 3, 1.0),
    ([1, 2, 3, 4, 5], [1, 2, 10, 11], 5, 0.5),
])
def test_recall(spark, rec, rel, k, exp):
    assert _per_user(spark, rec, rel, k)["recall"] == pytest.approx(exp)


def test_recall_and_ap_without_relevant_items(spark):
    # a user without relevant items is not evaluated at all (0 in the reference's scalar form)
    assert _per_user(spark, [1, 2, 3], [], 3) is None


@pytest.mark.parametrize("rec,rel,k,exp", [
    ([1, 2, 3], [1, 2, 3], 3, 1.0),
    ([1, 2, 3, 4, 5], [1], 5, 1.0),
    ([9, 1, 3, 4, 5], [1], 5, 0.5),
])
def test_ap(spark, rec, rel, k, exp):
    assert _per_user(spark, rec, rel, k)["ap"] == pytest.approx(exp)


def test_map_excludes_users_without_relevant(spark):
    recs, rel, users = _lists(spark, {1: [1, 2, 3], 2: [4, 5, 6]}, {1: [1, 2, 3]})
    test = rel.withColumn("rating", F.lit(5.0))
    rep = V.ranking_report(recs, test, users, 3).first()
    assert rep["map_at_k"] == pytest.approx(1.0)
    assert rep["n_users_evaluated"] == 1


def test_map_empty(spark):
    recs, rel, users = _lists(spark, {}, {})
    users = spark.createDataFrame([], "user_id long")
    rel = spark.createDataFrame([], "user_id long, movie_id long")
    assert V.map_at_k(recs, rel, users, 10).first()["map_at_k"] == 0.0


def test_map_two_users(spark):
    recs, rel, users = _lists(spark, {1: [1, 2, 3], 2: [4, 5, 6]}, {1: [1, 2, 3]})
    assert V.map_at_k(recs, rel, users, 3).first()["map_at_k"] == pytest.approx(1.0)


def test_ndcg_perfect_and_order(spark):
    assert _per_user(spark, [1, 2, 3], [1, 2, 3], 3)["ndcg"] == pytest.approx(1.0)
    a = _per_user(spark, [1, 2, 3], [1, 2, 3], 3)["ndcg"]
    b = _per_user(spark, [3, 2, 1], [1, 2, 3], 3)["ndcg"]
    assert a == pytest.approx(b)


def test_ndcg_value(spark):
    # one hit at rank 2 of 3, two relevant: dcg = 1/log2(3); idcg = 1 + 1/log2(3)
    got = _per_user(spark, [7, 1, 8], [1, 2], 3)["ndcg"]
    assert got == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)))


def test_coverage(spark):
    recs, _, _ = _lists(spark, {1: [1, 2, 3], 2: [4, 5, 6]}, {})
    items = spark.createDataFrame([(i,) for i in range(1, 7)], "movie_id long")
    assert V.coverage(recs, items).first()["coverage"] == pytest.approx(1.0)
    recs1, _, _ = _lists(spark, {1: [1, 2, 3]}, {})
    assert V.coverage(recs1, items).first()["coverage"] == pytest.approx(0.5)


def test_coverage_zero_catalogue_raises(spark):
    recs, _, _ = _lists(spark, {1: [1, 2, 3]}, {})
    items = spark.createDataFrame([], "movie_id long")
    with pytest.raises(Exception):
        V.coverage(recs, items).collect()


@pytest.mark.parametrize("recs,rel,exp", [
    ({1: [1, 2, 3], 2: [4, 5, 6]}, {1: [1], 2: [4]}, 1.0),
    ({1: [1, 2, 3]}, {1: [9, 10]}, 0.0),
    ({1: [1, 2], 2: [3, 4]}, {1: [1]}, 1.0),
])
def test_hit_rate(spark, recs, rel, exp):
    r, rl, users = _lists(spark, recs, rel)
    test = rl.withColumn("rating", F.lit(5.0))
    assert V.ranking_report(r, test, users, 10).first()["hit_rate"] == pytest.approx(exp)


def test_extra_cases(spark):
    # list shorter than k: precision divides by the list length
    assert _per_user(spark, [1, 2], [1], 10)["precision"] == pytest.approx(0.5)
    # empty list with relevant items counts 0
    recs, rel, _ = _lists(spark, {1: []}, {1: [1]})
    users = spark.createDataFrame([(1,)], "user_id long")
    rel = spark.createDataFrame([(1, 1)], "user_id long, movie_id long")
    row = V.ranking_per_user(recs, rel, users, 10).first()
    assert row["precision"] == 0 and row["hit"] == 0
    # hit beyond rank k: counts for hit rate, not for precision
    row = _per_user(spark, [5, 6, 1], [1], 2)
    assert row["precision"] == 0 and row["hit"] == 1


def test_diversity(spark):
    recs, _, _ = _lists(spark, {1: [1, 2], 2: [3]}, {})
    vec = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "movie_id long, emb array<double>")
    out = {r["user_id"]: r["diversity"] for r in V.diversity(recs, vec).collect()}
    assert out[1] == pytest.approx(1.0)   # orthogonal pair
    assert out[2] == 0.0                  # one item
