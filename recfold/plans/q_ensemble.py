"""Registered queries: ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash_sql
from recfold.operators import ensemble as E
from recfold.operators import metrics as V
from recfold.operators import models as M
from recfold.operators import topk as TK
from recfold.plans import oracle_views as O
from recfold.plans.common import Base, normalize
from recfold.plans.registry import register

W = O.with_ctes
NAMES = ["item_mean", "user_mean", "bias"]
ENS = [*O.BASE, *O.MODELS, O.PREDS, O.PREDS_VAL]
WEIGHTS = ["""vr AS (SELECT p.model, sqrt(avg((v.rating - p.predicted_rating) * (v.rating - p.predicted_rating))) AS rmse
             FROM val v JOIN vpreds p ON p.user_id = v.user_id AND p.movie_id = v.movie_id GROUP BY p.model)""",
           "w AS (SELECT model, (1 / rmse) / (SELECT sum(1 / rmse) FROM vr) AS weight FROM vr)"]


def inverse_rmse_weights(b: Base):
    """E1 input derived from the data: raw weight 1 / validation RMSE."""
    vp = M.predict_long(b.models(), b.val)
    r = V.rating_metrics(b.val, vp, by=("model",))
    return E.normalise_weights(r.select("model", (F.lit(1.0) / F.col("rmse")).alias("weight")))


def _weights_dict(b: Base) -> dict[str, float]:
    # three rows (one per model): read on the driver to parameterise blends
    return {r["model"]: float(r["weight"]) for r in inverse_rmse_weights(b).collect()}


@register("e1_normalise_weights", W(*ENS, *WEIGHTS) + "SELECT model, weight FROM w")
def q_e1(spark, d):
    return normalize(inverse_rmse_weights(Base(spark, d)))


@register("e2_weighted_blend", W(*ENS, *WEIGHTS) + """
SELECT p.user_id, p.movie_id, """ + O.clip9("sum(w.weight * p.predicted_rating)") + """ AS predicted_rating
FROM preds p JOIN w ON w.model = p.model GROUP BY p.user_id, p.movie_id""")
def q_e2(spark, d):
    b = Base(spark, d)
    return normalize(E.blend(b.preds(), inverse_rmse_weights(b)))


@register("e3_average", W(*ENS) + """
SELECT user_id, movie_id, round(avg(predicted_rating), 9) AS predicted_rating FROM preds GROUP BY user_id, movie_id""")
def q_e3(spark, d):
    return normalize(E.average(Base(spark, d).preds()))


_WIDE_VAL = """wv AS (SELECT v.user_id, v.movie_id, CAST(v.rating AS DOUBLE) AS y,
       max(p.predicted_rating) FILTER (WHERE p.model = 'item_mean') AS pi,
       max(p.predicted_rating) FILTER (WHERE p.model = 'user_mean') AS pu,
       max(p.predicted_rating) FILTER (WHERE p.model = 'bias') AS pb
     FROM val v JOIN vpreds p ON p.user_id = v.user_id AND p.movie_id = v.movie_id
     GROUP BY v.user_id, v.movie_id, v.rating)"""


@register("e4_fit_weights_rmse", W(*ENS, _WIDE_VAL) + """,
g AS (SELECT sum(pi * pi) AS g11, sum(pi * pb) AS g12, sum(pb * pb) AS g22, sum(pi * y) AS h1, sum(pb * y) AS h2 FROM wv),
ws AS (SELECT least(greatest((g22 - g12 + h1 - h2) / (g11 - 2 * g12 + g22), 0), 1) AS w FROM g)
SELECT 'item_mean' AS model, w AS weight FROM ws UNION ALL SELECT 'bias', 1 - w FROM ws""")
def q_e4(spark, d):
    b = Base(spark, d)
    two = ["item_mean", "bias"]
    vp = M.predict_long([M.fit_item_mean(b.train), M.fit_bias(b.train)], b.val)
    return normalize(E.fit_weights(vp, b.val, two, "rmse"))


@register("e4_fit_weights_rmse_3")
def q_e4b(spark, d):
    b = Base(spark, d)
    return normalize(E.fit_weights(M.predict_long(b.models(), b.val), b.val, NAMES, "rmse"))


@register("e5_fit_weights_mae")
def q_e5(spark, d):
    b = Base(spark, d)
    return normalize(E.fit_weights(M.predict_long(b.models(), b.val), b.val, NAMES, "mae"))


@register("e5_least_mae", W(*ENS, _WIDE_VAL) + """,
kinks AS (SELECT (y - pb) / (pi - pb) AS x, abs(pi - pb) AS m FROM wv WHERE pi <> pb),
run AS (SELECT x, sum(m) OVER (ORDER BY x) AS upto, (SELECT sum(m) FROM kinks) AS total FROM kinks),
ws AS (SELECT least(greatest(min(x), 0), 1) AS w FROM run WHERE 2 * upto >= total)
SELECT avg(abs(w * pi + (1 - w) * pb - y)) AS mae, CAST(1 AS BIGINT) AS proven FROM wv, ws""")
def q_e5m(spark, d):
    # two models: the best weight is a weighted median of the kinks, which the oracle states in SQL
    b = Base(spark, d)
    vp = M.predict_long([M.fit_item_mean(b.train), M.fit_bias(b.train)], b.val)
    _, mae, bound = E.least_mae(vp, b.val, ["item_mean", "bias"])
    rows = [(mae, int(mae - bound <= 1e-6))] if mae is not None else [(None, 1)]
    return normalize(spark.createDataFrame(rows, "mae double, proven bigint"))


@register("e6_weight_sensitivity", W(*ENS, _WIDE_VAL) + """,
grid AS (SELECT i AS step, i * (CAST(0.6 AS DOUBLE) / 24) AS w_bias FROM range(25) t(i)),
gw AS (SELECT step, w_bias, (1 - w_bias) * CAST(0.45 AS DOUBLE) AS w_item_mean,
              (1 - w_bias) * CAST(0.55 AS DOUBLE) AS w_user_mean FROM grid)
SELECT gw.step, gw.w_bias, gw.w_item_mean, gw.w_user_mean,
       sqrt(avg(power(gw.w_bias * wv.pb + gw.w_item_mean * wv.pi + gw.w_user_mean * wv.pu - wv.y, 2))) AS rmse
FROM gw, wv GROUP BY gw.step, gw.w_bias, gw.w_item_mean, gw.w_user_mean""")
def q_e6(spark, d):
    b = Base(spark, d)
    vp = M.predict_long(b.models(), b.val)
    return normalize(E.sensitivity(vp, b.val, "bias", ["item_mean", "user_mean"]))


_WIDE_TEST = """wt AS (SELECT t.user_id, t.movie_id, CAST(t.rating AS DOUBLE) AS y,
       max(p.predicted_rating) FILTER (WHERE p.model = 'item_mean') AS pi,
       max(p.predicted_rating) FILTER (WHERE p.model = 'user_mean') AS pu,
       max(p.predicted_rating) FILTER (WHERE p.model = 'bias') AS pb
     FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id
     GROUP BY t.user_id, t.movie_id, t.rating)"""


def _abl_row(cfg: str, wi: str, wu: str, wb: str) -> str:
    return (f"SELECT '{cfg}' AS config, {wi} AS w_item_mean, {wu} AS w_user_mean, {wb} AS w_bias")


_ABLATION = [
    """wd AS (SELECT max(weight) FILTER (WHERE model = 'item_mean') AS a,
                max(weight) FILTER (WHERE model = 'user_mean') AS b,
                max(weight) FILTER (WHERE model = 'bias') AS c FROM w)""",
    "sets AS (" + " UNION ALL ".join([
        _abl_row("item_mean only", "1.0", "0.0", "0.0") + " FROM wd",
        _abl_row("user_mean only", "0.0", "1.0", "0.0") + " FROM wd",
        _abl_row("bias only", "0.0", "0.0", "1.0") + " FROM wd",
        _abl_row("w/o item_mean", "0.0", "b / (b + c)", "c / (b + c)") + " FROM wd",
        _abl_row("w/o user_mean", "a / (a + c)", "0.0", "c / (a + c)") + " FROM wd",
        _abl_row("w/o bias", "a / (a + b)", "b / (a + b)", "0.0") + " FROM wd",
        _abl_row("full", "a", "b", "c") + " FROM wd"]) + ")"]


@register("e7_ablation", W(*ENS, *WEIGHTS, _WIDE_TEST, *_ABLATION) + """
SELECT s.config, s.w_item_mean, s.w_user_mean, s.w_bias,
       sqrt(avg(power(s.w_item_mean * wt.pi + s.w_user_mean * wt.pu + s.w_bias * wt.pb - wt.y, 2))) AS rmse
FROM sets s, wt GROUP BY s.config, s.w_item_mean, s.w_user_mean, s.w_bias""")
def q_e7(spark, d):
    b = Base(spark, d)
    return normalize(E.ablation(b.preds(), b.test, _weights_dict(b)))


@register("e8_meta_features", W(*ENS) + """,
gm AS (SELECT avg(CAST(rating AS DOUBLE)) AS g FROM val),
us AS (SELECT user_id, avg(CAST(rating AS DOUBLE)) AS user_avg, count(*) AS n_user_ratings FROM val GROUP BY user_id),
ms AS (SELECT movie_id, avg(CAST(rating AS DOUBLE)) AS item_avg, count(*) AS n_item_ratings FROM val GROUP BY movie_id),
wp AS (SELECT user_id, movie_id,
         max(predicted_rating) FILTER (WHERE model = 'item_mean') AS pred_item_mean,
         max(predicted_rating) FILTER (WHERE model = 'user_mean') AS pred_user_mean,
         max(predicted_rating) FILTER (WHERE model = 'bias') AS pred_bias
       FROM vpreds GROUP BY user_id, movie_id)
SELECT v.user_id, v.movie_id, wp.pred_item_mean, wp.pred_user_mean, wp.pred_bias,
       coalesce(us.user_avg, (SELECT g FROM gm)) AS user_avg, coalesce(us.n_user_ratings, 0) AS n_user_ratings,
       coalesce(ms.item_avg, (SELECT g FROM gm)) AS item_avg, coalesce(ms.n_item_ratings, 0) AS n_item_ratings
FROM val v LEFT JOIN wp ON wp.user_id = v.user_id AND wp.movie_id = v.movie_id
LEFT JOIN us ON us.user_id = v.user_id LEFT JOIN ms ON ms.movie_id = v.movie_id""")
def q_e8(spark, d):
    b = Base(spark, d)
    vp = M.predict_long(b.models(), b.val)
    return normalize(E.meta_features(vp, b.val, b.val, NAMES))


def _stack(spark, d, kind: str):
    b = Base(spark, d)
    vp = M.predict_long(b.models(), b.val)
    feats = E.meta_features(vp, b.val, b.val, NAMES)
    va, model = E.fit_stack(feats, b.val, NAMES, kind)
    tp = b.preds()
    tfeats = E.meta_features(tp, b.val, b.test, NAMES)
    return b, va, model, tfeats


@register("e9_stacking_gbt_predictions")
def q_e9(spark, d):
    _, va, model, tfeats = _stack(spark, d, "gbt")
    return normalize(E.predict_stack(va, model, tfeats))


@register("e10_stacking_ridge_coefficients")
def q_e10(spark, d):
    _, va, model, _ = _stack(spark, d, "ridge")
    names = E._features(NAMES) + ["intercept"]
    values = [float(x) for x in model.coefficients] + [float(model.intercept)]
    return spark.createDataFrame(list(zip(names, values)), "feature string, coefficient double")


FITS = {"item_mean": M.fit_item_mean, "user_mean": M.fit_user_mean, "bias": M.fit_bias}
_OOF = [
    f"""dealt AS (SELECT user_id, movie_id, rating, {portable_hash_sql("user_id", "movie_id", 42)} % 5 AS fold FROM train)""",
    """others AS (SELECT CAST(f AS INTEGER) AS fold, d.user_id, d.movie_id, d.rating
                  FROM dealt d, range(5) t(f) WHERE d.fold <> f)""",
    "omu AS (SELECT fold, avg(CAST(rating AS DOUBLE)) AS mu FROM others GROUP BY fold)",
    """oi AS (SELECT o.fold, o.movie_id, avg(CAST(o.rating AS DOUBLE)) AS i_mean, count(*) AS n,
                     (CAST(sum(o.rating) AS DOUBLE) - CAST(count(*) AS DOUBLE) * max(m.mu)) / (CAST(25 AS DOUBLE) + count(*)) AS i_term
              FROM others o JOIN omu m ON m.fold = o.fold GROUP BY o.fold, o.movie_id)""",
    """ou AS (SELECT o.fold, o.user_id, avg(CAST(o.rating AS DOUBLE)) AS u_mean, count(*) AS n,
                     sum(o.rating - m.mu - i.i_term) / (CAST(10 AS DOUBLE) + count(*)) AS u_term
              FROM others o JOIN omu m ON m.fold = o.fold JOIN oi i ON i.fold = o.fold AND i.movie_id = o.movie_id
              GROUP BY o.fold, o.user_id)"""]


@register("e10_out_of_fold_features", W(*O.BASE, *_OOF) + """
SELECT d.user_id, d.movie_id, """ + O.clip9("CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE) + coalesce(i.i_mean, m.mu)") + """ AS pred_item_mean,
       """ + O.clip9("CAST(0 AS DOUBLE) + coalesce(u.u_mean, m.mu) + CAST(0 AS DOUBLE)") + """ AS pred_user_mean,
       """ + O.clip9("m.mu + coalesce(u.u_term, CAST(0 AS DOUBLE)) + coalesce(i.i_term, CAST(0 AS DOUBLE))") + """ AS pred_bias,
       coalesce(u.u_mean, m.mu) AS user_avg, coalesce(u.n, 0) AS n_user_ratings,
       coalesce(i.i_mean, m.mu) AS item_avg, coalesce(i.n, 0) AS n_item_ratings, CAST(d.fold AS BIGINT) AS fold
FROM dealt d JOIN omu m ON m.fold = d.fold
LEFT JOIN oi i ON i.fold = d.fold AND i.movie_id = d.movie_id
LEFT JOIN ou u ON u.fold = d.fold AND u.user_id = d.user_id""")
def q_e10f(spark, d):
    return normalize(E.out_of_fold_features(Base(spark, d).train, FITS))


@register("e10_stacking_out_of_fold")
def q_e10o(spark, d):
    """Ridge on out-of-fold features of the train rows; test rows take the models of all train rows."""
    b = Base(spark, d)
    va, model = E.fit_stack(E.out_of_fold_features(b.train, FITS), b.train, NAMES, "ridge")
    return normalize(E.predict_stack(va, model, E.meta_features(b.preds(), b.train, b.test, NAMES)))


@register("e11_ensemble_topk", W(*ENS, *WEIGHTS, O.CATALOGUE, O.ALL_USERS) + """,
wd AS (SELECT max(weight) FILTER (WHERE model = 'item_mean') AS a,
              max(weight) FILTER (WHERE model = 'user_mean') AS b,
              max(weight) FILTER (WHERE model = 'bias') AS c FROM w),
scored AS (
  SELECT x.user_id, c.movie_id, """ + O.clip9(
    "(SELECT a FROM wd) * " + O.clip9("CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE) + coalesce(im.i_term, (SELECT mu FROM mu))")
    + " + (SELECT b FROM wd) * " + O.clip9("CAST(0 AS DOUBLE) + coalesce(um.u_term, (SELECT mu FROM mu)) + CAST(0 AS DOUBLE)")
    + " + (SELECT c FROM wd) * " + O.BIAS_SCORE) + """ AS score
  FROM all_users x CROSS JOIN cat c
  LEFT JOIN item_means im ON im.movie_id = c.movie_id LEFT JOIN user_means um ON um.user_id = x.user_id
  LEFT JOIN bias_users u ON u.user_id = x.user_id LEFT JOIN bias_items i ON i.movie_id = c.movie_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = x.user_id AND t.movie_id = c.movie_id))
SELECT user_id, CAST(rk AS BIGINT) AS rank, movie_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rk FROM scored) r
WHERE rk <= 10""")
def q_e11(spark, d):
    b = Base(spark, d)
    wts = _weights_dict(b)
    blend = TK.Blend(b.models(), [wts[n] for n in NAMES])
    return normalize(TK.top_k(blend, b.users(), b.catalogue(), seen=b.train, k=10))
