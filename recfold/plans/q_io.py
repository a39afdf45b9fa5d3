"""Registered queries: sources and sinks (S1-S8, K1-K8) as round trips.

The driver tables hold no block files, CSVs or id-map documents, so each
query writes the Spark-derived ratings (or splits, maps, lists) in the
reference's file format into a fresh folder under the checkpoint directory
and reads it back with the reader under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recfold.operators import prep as P
from recfold.plans import oracle_views as O
from recfold.plans.catalog import bias_recs, topk_sql
from recfold.plans.common import Base, normalize, ratings_once
from recfold.plans.registry import register
from recfold.plans.views import ratings as ratings_view
from recfold.plans.views import titles as titles_view
from recfold.session import ensure_checkpoint_dir
from recfold.sinks import writers as K
from recfold.sources import blocks as SB
from recfold.sources import files as SF

W = O.with_ctes


def _scratch(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/{label}-{uuid.uuid4().hex}"


@register("s1_blocks_strict", W(O.RATINGS) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date FROM ratings")
def q_s1(spark, d):
    path = _scratch(spark, "blocks")
    SB.write_blocks(ratings_view(spark, d), path)
    return normalize(SB.read_blocks(spark, f"{path}/part-*", lenient=False))


@register("s2_blocks_lenient", W(O.RATINGS) + """
SELECT user_id, movie_id, CAST(rating AS DOUBLE) AS rating, strftime(date, '%Y-%m-%d') AS date FROM ratings""")
def q_s2(spark, d):
    path = _scratch(spark, "blocks")
    SB.write_blocks(ratings_view(spark, d), path)
    return normalize(SB.read_blocks(spark, f"{path}/part-*", lenient=True))


@register("s4_ratings_csv", W(O.RATINGS) + """
SELECT user_id, movie_id, CAST(rating AS DOUBLE) AS rating, strftime(date, '%Y-%m-%d') AS date FROM ratings""")
def q_s4(spark, d):
    path = _scratch(spark, "csv")
    r = ratings_view(spark, d)
    r.select("user_id", "movie_id", "rating", F.date_format("date", "yyyy-MM-dd").alias("date")) \
        .write.option("header", True).csv(f"{path}/ratings.csv")
    return normalize(SF.read_ratings_dir(spark, path))


@register("s5_titles", W(O.TITLES) + "SELECT movie_id, CAST(year AS BIGINT) AS year, title FROM titles")
def q_s5(spark, d):
    path = _scratch(spark, "titles")
    t = titles_view(spark, d)
    t.select(F.concat_ws(",", F.col("movie_id").cast("string"), F.col("year").cast("string"), "title")) \
        .write.text(path)
    return normalize(SF.read_titles(spark, path))


@register("s6_k1_parquet", W(O.RATINGS) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date FROM ratings")
def q_s6(spark, d):
    path = _scratch(spark, "parquet")
    K.write_parquet(ratings_view(spark, d), path)
    return normalize(SF.read_parquet(spark, path))


@register("s7_k2_split_load", W(*O.BASE) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date FROM test")
def q_s7(spark, d):
    root = _scratch(spark, "splits")
    K.write_splits(Base(spark, d, materialize=False).split, root)
    return normalize(SF.read_split(spark, f"{root}/splits", "test").select("user_id", "movie_id", "rating", "date"))


@register("s8_k2_id_maps_json", W(O.RATINGS) + """
SELECT DISTINCT user_id AS orig_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS idx FROM ratings""")
def q_s8(spark, d):
    r = ratings_view(spark, d)
    path = _scratch(spark, "idmaps")
    K.write_id_maps_json(P.dense_ids(r, "user_id"), P.dense_ids(r, "movie_id"), path)
    users, _ = SF.read_id_maps(spark, path)
    return normalize(users)


@register("k3_split_csv_stats", W(*O.BASE) + """
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val,
       count(*) FILTER (WHERE split = 'test') AS n_test, count(DISTINCT user_id) AS n_users,
       count(DISTINCT movie_id) AS n_movies FROM split""")
def q_k3(spark, d):
    b = Base(spark, d, materialize=False)
    root = _scratch(spark, "csvsplits")
    K.write_splits_csv(b.split, root)
    return normalize(spark.read.json(f"{root}/stats.json").select("n_train", "n_val", "n_test", "n_users", "n_movies"))


@register("k4_recs_csv", topk_sql() + """
SELECT user_id, rank, movie_id, printf('%.6f', score) AS score FROM recs""")
def q_k4(spark, d):
    b = Base(spark, d)
    path = _scratch(spark, "recs")
    K.write_recs(bias_recs(b), path)
    back = spark.read.option("header", True).schema(
        "user_id BIGINT, rank BIGINT, movie_id BIGINT, score STRING").csv(path)
    return normalize(back)


@register("k5_export_titles", topk_sql(O.TITLES) + """
SELECT r.user_id, r.rank, r.movie_id, printf('%.6f', r.score) AS predicted_score,
       coalesce(t.title, 'Unknown') AS title FROM recs r LEFT JOIN titles t ON t.movie_id = r.movie_id""")
def q_k5(spark, d):
    b = Base(spark, d)
    path = _scratch(spark, "export")
    K.write_export(bias_recs(b), b.titles(), path)
    back = spark.read.option("header", True).schema(
        "user_id BIGINT, rank BIGINT, movie_id BIGINT, predicted_score STRING, title STRING").csv(path)
    return normalize(back)


@register("k8_model_save_load", W(*O.BASE, *O.MODELS) + """
SELECT t.user_id, t.movie_id, """ + O.BIAS_SCORE + """ AS predicted_rating
FROM test t LEFT JOIN bias_users u ON u.user_id = t.user_id LEFT JOIN bias_items i ON i.movie_id = t.movie_id""")
def q_k8(spark, d):
    from recfold.operators.models import fit_bias
    b = Base(spark, d)
    path = _scratch(spark, "model")
    K.save_model(fit_bias(b.train), path)
    m = K.load_model(spark, path)
    return normalize(m.score(b.test.select("user_id", "movie_id")))


@register("k6_results_json", W(*O.BASE, *O.MODELS, O.PREDS) + """
SELECT p.model, 'rmse' AS metric, sqrt(avg((t.rating - p.predicted_rating) * (t.rating - p.predicted_rating))) AS value
FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id GROUP BY p.model
UNION ALL
SELECT p.model, 'mae', avg(abs(t.rating - p.predicted_rating))
FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id GROUP BY p.model""")
def q_k6(spark, d):
    from recfold.operators import metrics as V
    b = Base(spark, d)
    r = V.rating_metrics(b.test, b.preds(), by=("model",))
    long = r.select("model", F.expr("stack(2, 'rmse', rmse, 'mae', mae) AS (metric, value)"))
    path = _scratch(spark, "results")
    K.write_results(long, path, "json")
    return normalize(spark.read.schema("model STRING, metric STRING, value DOUBLE").json(path))


@register("k7_eda_report_json", W(O.RATINGS) + """,
ua AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id),
ma AS (SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id),
ru AS (SELECT n, row_number() OVER (ORDER BY n DESC, user_id) AS rn FROM ua),
rm AS (SELECT n, row_number() OVER (ORDER BY n DESC, movie_id) AS rn FROM ma)
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT movie_id)) AS sparsity,
       avg(CAST(rating AS DOUBLE)) AS rating_mean, stddev_samp(CAST(rating AS DOUBLE)) AS rating_std,
       (SELECT sum(n) FILTER (WHERE rn <= floor((SELECT count(*) FROM ua) * CAST(0.1 AS DOUBLE))) / sum(n) FROM ru)
         AS top_user_share,
       (SELECT sum(n) FILTER (WHERE rn <= 100) / sum(n) FROM rm) AS top_movie_share
FROM ratings""")
def q_k7(spark, d):
    from recfold.operators import stats as A
    path = _scratch(spark, "eda")
    K.write_results(A.key_figures(ratings_once(spark, d)), path, "json")
    schema = ("n_ratings BIGINT, n_users BIGINT, n_movies BIGINT, sparsity DOUBLE, rating_mean DOUBLE, "
              "rating_std DOUBLE, top_user_share DOUBLE, top_movie_share DOUBLE")
    return normalize(spark.read.schema(schema).json(path))
