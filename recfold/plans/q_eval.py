"""Registered queries: models as tables, predictions and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash_sql
from recfold.operators import metrics as V
from recfold.operators import models as M
from recfold.operators.evaluate import full_report, model_recs
from recfold.operators.prep import sample_users
from recfold.plans import oracle_views as O
from recfold.plans.common import Base, normalize
from recfold.plans.oracle_eval import ranking_ctes, recs_cte, report_select
from recfold.plans.registry import register
from recfold.plans.views import vectors as vectors_view

W = O.with_ctes
MODEL_CTES = [*O.BASE, *O.MODELS, O.PREDS]
H_U = portable_hash_sql("user_id", 0, 42)


@register("m1_bias_items", W(*O.BASE, *O.MODELS) + "SELECT movie_id, i_term FROM bias_items")
def q_m1i(spark, d):
    return normalize(M.fit_bias(Base(spark, d).train).items)


@register("m1_bias_users", W(*O.BASE, *O.MODELS) + "SELECT user_id, u_term FROM bias_users")
def q_m1u(spark, d):
    return normalize(M.fit_bias(Base(spark, d).train).users)


@register("m9_predictions", W(*MODEL_CTES) + "SELECT * FROM preds")
def q_m9(spark, d):
    return normalize(Base(spark, d).preds())


@register("v1_v2_rating_metrics", W(*MODEL_CTES) + """
SELECT p.model, sqrt(avg((t.rating - p.predicted_rating) * (t.rating - p.predicted_rating))) AS rmse,
       avg(abs(t.rating - p.predicted_rating)) AS mae, count(*) AS n_predictions
FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id GROUP BY p.model""")
def q_v1(spark, d):
    b = Base(spark, d)
    return normalize(V.rating_metrics(b.test, b.preds(), by=("model",)))


_RECS_ALL = [*O.BASE, *O.MODELS, O.CATALOGUE, O.ALL_USERS, recs_cte("bias", "all_users", "recs"),
             "ev AS (SELECT 'bias' AS model, user_id FROM all_users)"]


def _bias_recs_long(b: Base):
    return model_recs([M.fit_bias(b.train)], b.users(), b.catalogue(), seen=b.train, k=10)


def _all_eval_users(b: Base):
    return b.users().withColumn("model", F.lit("bias"))


@register("v3_v7_ranking_per_user", W(*_RECS_ALL, *ranking_ctes("recs", "ev")) + """
SELECT model, user_id, n_relevant, precision, recall, ap, ndcg, hit FROM per_user""")
def q_v3(spark, d):
    b = Base(spark, d)
    rel = V.relevant_items(b.test, 3.5)
    return normalize(V.ranking_per_user(_bias_recs_long(b), rel, _all_eval_users(b), 10, by=("model",)))


@register("v8_coverage", W(*_RECS_ALL) + """
SELECT model, count(DISTINCT movie_id) / (SELECT count(*) FROM cat) AS coverage FROM recs GROUP BY model""")
def q_v8(spark, d):
    b = Base(spark, d)
    return normalize(V.coverage(_bias_recs_long(b), b.catalogue(), by=("model",)))


@register("v11_ranking_report", W(*_RECS_ALL, *ranking_ctes("recs", "ev")) + report_select("recs"))
def q_v11(spark, d):
    b = Base(spark, d)
    return normalize(V.ranking_report(_bias_recs_long(b), b.test, _all_eval_users(b), 10, 3.5, by=("model",)))


_VEC = """vec AS (SELECT p.p_partkey AS movie_id, CAST(u.i AS BIGINT) AS dim, CAST(u.x AS DOUBLE) AS x
  FROM part p JOIN embeddings e ON e.vec_id = p.p_partkey % (SELECT count(*) FROM embeddings),
  LATERAL (SELECT unnest(range(len(e.embedding))) AS i, unnest(e.embedding) AS x) u)"""


@register("v9_diversity", W(*_RECS_ALL, _VEC) + """,
nv AS (SELECT movie_id, dim, x / sqrt(sum(x * x) OVER (PARTITION BY movie_id)) AS x FROM vec),
pairs AS (SELECT a.user_id, a.movie_id AS ma, b.movie_id AS mb FROM recs a JOIN recs b
          ON a.user_id = b.user_id AND a.rank < b.rank),
sims AS (SELECT p.user_id, p.ma, p.mb, sum(va.x * vb.x) AS sim FROM pairs p
         JOIN nv va ON va.movie_id = p.ma JOIN nv vb ON vb.movie_id = p.mb AND vb.dim = va.dim
         GROUP BY p.user_id, p.ma, p.mb),
n AS (SELECT user_id, count(*) AS n_items FROM recs GROUP BY user_id)
SELECT n.user_id, n.n_items,
       CASE WHEN n.n_items < 2 THEN 0 ELSE (SELECT avg(1 - s.sim) FROM sims s WHERE s.user_id = n.user_id) END
         AS diversity
FROM n""")
def q_v9(spark, d):
    b = Base(spark, d)
    return normalize(V.diversity(_bias_recs_long(b).drop("model"), vectors_view(spark, d)))


_MODELS3 = ("item_mean", "user_mean", "bias")
_FULL_CTES = [*O.BASE, *O.MODELS, O.PREDS, O.CATALOGUE,
              f"su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM test) x ORDER BY {H_U}, user_id LIMIT 500)",
              *[recs_cte(m, "su", f"recs_{m}") for m in _MODELS3],
              "recs AS (" + " UNION ALL ".join(f"SELECT * FROM recs_{m}" for m in _MODELS3) + ")",
              "ev AS (" + " UNION ALL ".join(f"SELECT '{m}' AS model, user_id FROM su" for m in _MODELS3) + ")"]


@register("v12_full_evaluation", W(*_FULL_CTES, *ranking_ctes("recs", "ev")) + """,
rating AS (SELECT p.model, sqrt(avg((t.rating - p.predicted_rating) * (t.rating - p.predicted_rating))) AS rmse,
                  avg(abs(t.rating - p.predicted_rating)) AS mae, count(*) AS n_predictions
           FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id GROUP BY p.model),
rep AS (""" + report_select("recs") + """)
SELECT rating.*, rep.map_at_k, rep.precision_at_k, rep.recall_at_k, rep.ndcg_at_k, rep.hit_rate,
       rep.n_users_evaluated, rep.coverage
FROM rating LEFT JOIN rep ON rep.model = rating.model""")
def q_v12(spark, d):
    b = Base(spark, d)
    return normalize(full_report(b.models(), b.train, b.test, b.catalogue(), 10, 500))


def _rating_long(b: Base):
    r = V.rating_metrics(b.test, b.preds(), by=("model",))
    return r.select("model", F.expr("stack(2, 'rmse', rmse, 'mae', mae) AS (metric, value)"))


_RATING_LONG = W(*MODEL_CTES) + """,
rm AS (SELECT p.model, sqrt(avg((t.rating - p.predicted_rating) * (t.rating - p.predicted_rating))) AS rmse,
              avg(abs(t.rating - p.predicted_rating)) AS mae
       FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id GROUP BY p.model),
lng AS (SELECT model, 'rmse' AS metric, rmse AS value FROM rm UNION ALL SELECT model, 'mae', mae FROM rm)
"""


@register("v13_compare_models", _RATING_LONG + """
SELECT model, first(value) FILTER (WHERE metric = 'mae') AS mae, first(value) FILTER (WHERE metric = 'rmse') AS rmse
FROM lng GROUP BY model""")
def q_v13(spark, d):
    return normalize(V.compare(_rating_long(Base(spark, d))))


@register("v14_best_and_improvement", _RATING_LONG + """,
base AS (SELECT metric, value AS baseline_value FROM lng WHERE model = 'item_mean'),
best AS (SELECT metric, model AS best_model FROM (
           SELECT metric, model, row_number() OVER (PARTITION BY metric ORDER BY value, model) AS r FROM lng) x
         WHERE r = 1)
SELECT l.model, l.metric, l.value, b.baseline_value, bt.best_model, l.value - b.baseline_value AS delta,
       (l.value - b.baseline_value) / b.baseline_value * 100 AS pct_change
FROM lng l LEFT JOIN base b ON b.metric = l.metric JOIN best bt ON bt.metric = l.metric""")
def q_v14(spark, d):
    return normalize(V.best_and_improvement(_rating_long(Base(spark, d)), "item_mean"))
