"""Ensembles.

Predictions are long (model, user_id, movie_id, predicted_rating). Linear
blends without a clip (weight search, sensitivity, ablation) need only the
Gram sums X'X, X'y, y'y of one pass over the data: RMSE^2 of any weight
vector is (w'Gw - 2w'h + c) / n, so no weight grid is ever joined to the
predictions.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfold.functions.portable import clip, portable_hash, sql_round
from recfold.operators.models import predict_wide
from recfold.session import discard, materialize

#: Rows of a part that boosting reads: a level of a tree then takes a task some 30 ms.
BOOSTED_ROWS = 100_000


def normalise_weights(weights: DataFrame | None, models: list[str] | None = None) -> DataFrame:
    """Weight / sum(weight); a zero sum raises; no weights -> uniform."""
    if weights is None:
        if not models:
            raise ValueError("need weights or model names")
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([(m, 1.0 / len(models)) for m in models], "model string, weight double")
    total = weights.select(F.sum("weight")).scalar()
    return weights.select("model", F.when(total == 0, F.raise_error(F.lit("weights sum to zero")))
                          .otherwise(F.col("weight") / total).alias("weight"))


def blend(preds: DataFrame, weights: DataFrame, lo: float = 1.0, hi: float = 5.0,
          digits: int | None = 9) -> DataFrame:
    """sum_m w_m * pred_m per (user, movie), then clip to [lo, hi] (and
    the score rounding of the models). The weight table has one row per model
    (a handful), so it is broadcast."""
    j = preds.join(F.broadcast(weights.select("model", "weight")), "model")
    g = j.groupBy("user_id", "movie_id").agg(
        F.sum(F.col("weight") * F.col("predicted_rating")).alias("_s"))
    s = clip("_s", lo, hi)
    if digits is not None:
        s = sql_round(s, digits)
    return g.select("user_id", "movie_id", s.alias("predicted_rating"))


def average(preds: DataFrame, digits: int | None = 9) -> DataFrame:
    """Plain mean over models per (user, movie), no clip (joined by key,
    not by row position)."""
    s = F.avg("predicted_rating")
    if digits is not None:
        s = sql_round(s, digits)
    return preds.groupBy("user_id", "movie_id").agg(s.alias("predicted_rating"))


def wide(preds: DataFrame, models: list[str]) -> DataFrame:
    """One column per model (pred_<name>) by pivot with the model list given,
    so Spark does not scan for the distinct values."""
    p = preds.groupBy("user_id", "movie_id").pivot("model", models).agg(F.first("predicted_rating"))
    return p.select("user_id", "movie_id", *[F.col(m).alias(f"pred_{m}") for m in models])


def gram(preds: DataFrame, truth: DataFrame, models: list[str]) -> DataFrame:
    """One-row aggregate: n, c = sum y^2, h_a = sum p_a y, g_a_b = sum p_a p_b
    over the pairs that every model scored and the truth holds."""
    w = wide(preds, models).join(truth.select("user_id", "movie_id",
                                              F.col("rating").cast("double").alias("y")),
                                 ["user_id", "movie_id"])
    for m in models:
        w = w.where(F.col(f"pred_{m}").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("c")]
    for a in models:
        aggs.append(F.sum(F.col(f"pred_{a}") * F.col("y")).alias(f"h_{a}"))
    for a, b in itertools.combinations_with_replacement(models, 2):
        aggs.append(F.sum(F.col(f"pred_{a}") * F.col(f"pred_{b}")).alias(f"g_{a}_{b}"))
    return w.agg(*aggs)


def _gram_arrays(row, models):
    m = len(models)
    G = np.zeros((m, m))
    for i, a in enumerate(models):
        for j, b in enumerate(models):
            key = f"g_{a}_{b}" if i <= j else f"g_{b}_{a}"
            G[i, j] = row[key]
    h = np.array([row[f"h_{a}"] for a in models])
    return G, h, float(row["c"]), int(row["n"])


def simplex_least_squares(G: np.ndarray, h: np.ndarray) -> np.ndarray:
    """min w'Gw - 2h'w s.t. w >= 0, sum w = 1, exactly: the convex optimum is
    the equality-constrained optimum of some support set; enumerate supports
    (at most 2^12) and keep the best feasible one."""
    m = len(h)
    if m > 12:
        raise ValueError("exact weights enumerate the subsets of at most 12 models")
    best, best_obj = None, np.inf
    for r in range(1, m + 1):
        for s in itertools.combinations(range(m), r):
            idx = list(s)
            A = np.zeros((r + 1, r + 1))
            A[:r, :r] = 2 * G[np.ix_(idx, idx)]
            A[:r, r] = 1.0
            A[r, :r] = 1.0
            rhs = np.concatenate([2 * h[idx], [1.0]])
            try:
                sol = np.linalg.lstsq(A, rhs, rcond=None)[0]
            except np.linalg.LinAlgError:
                continue
            w = np.zeros(m)
            w[idx] = sol[:r]
            if np.any(w < -1e-12):
                continue
            w = np.clip(w, 0.0, None)
            w = w / w.sum()
            obj = w @ G @ w - 2 * h @ w
            if obj < best_obj - 1e-15:
                best, best_obj = w, obj
    return best


def fit_weights(preds: DataFrame, truth: DataFrame, models: list[str],
                metric: str = "rmse", gap: float = 1e-9, steps: int = 200) -> DataFrame:
    """E4 (rmse: exact simplex least squares from one Gram pass) and E5 (mae:
    cutting planes, see ``least_mae``). Both use the pairs that every model
    scored. Returns (model, weight)."""
    spark = preds.sparkSession
    if metric == "rmse":
        row = gram(preds, truth, models).first().asDict()
        G, h, _, _ = _gram_arrays(row, models)
        w = simplex_least_squares(G, h)
    elif metric == "mae":
        w = least_mae(preds, truth, models, gap, steps)[0]
    else:
        raise ValueError(f"unknown metric {metric}")
    return spark.createDataFrame([(m, float(x)) for m, x in zip(models, w)],
                                 "model string, weight double")


def least_mae(preds: DataFrame, truth: DataFrame, models: list[str], gap: float = 1e-9,
              steps: int = 200) -> tuple[np.ndarray, float | None, float | None]:
    """E5: weights on the simplex with the least mean absolute error, that
    error, and a proven lower bound of it.

    The error is convex and piecewise linear in the weights: its value and a
    subgradient at a point are a plane that lies nowhere above it. A round
    evaluates two points in one aggregate over the written wide table: the
    minimum of the highest planes so far, whose value bounds the optimum from
    below, and the middle between it and the best point. The search ends when
    the best error is within ``gap`` of the bound, or after ``steps`` rounds
    (the bound then tells how far it is). The driver holds one row per plane.
    Without a common pair the weights are equal and the errors None.
    """
    data = wide(preds, models).join(
        truth.select("user_id", "movie_id", F.col("rating").cast("double").alias("y")),
        ["user_id", "movie_id"]).dropna(subset=[f"pred_{m}" for m in models])
    data = materialize(data, "mae-rows")
    count = len(models)
    best, least, bound, planes = np.full(count, 1.0 / count), np.inf, -np.inf, []
    points = [best, *np.eye(count)]
    for _ in range(steps):
        aggs = []
        for w in points:
            miss = sum(F.lit(float(x)) * F.col(f"pred_{m}") for x, m in zip(w, models)) - F.col("y")
            aggs += [F.avg(F.abs(miss)), *[F.avg(F.signum(miss) * F.col(f"pred_{m}")) for m in models]]
        row = data.agg(*aggs).first()
        if row[0] is None:
            least = bound = None
            break
        for i, w in enumerate(points):
            value, *slope = row[i * (count + 1):(i + 1) * (count + 1)]
            if value < least:
                best, least = w, value
            planes.append(np.array(slope) + (value - np.dot(slope, w)))
        low, value = _lowest_of_planes(np.array(planes))
        bound = max(bound, value)
        if least - bound <= gap:
            break
        points = [low, (low + best) / 2]
    discard(data)
    return best, least, bound


def _lowest_of_planes(planes: np.ndarray) -> tuple[np.ndarray, float]:
    """min over the simplex of max(planes @ w), one row per plane: a matrix
    game, solved as a linear programme by the simplex method with smallest-index
    pivots (a few dozen rows, one column per model)."""
    shift = 1.0 - planes.min()
    rows, cols = planes.shape
    table = np.zeros((rows + 1, cols + rows + 1))  # max sum(y) with (planes + shift) y <= 1
    table[:rows, :cols] = planes + shift
    table[:rows, cols:-1] = np.eye(rows)
    table[:rows, -1] = 1.0
    table[rows, :cols] = -1.0
    basis = list(range(cols, cols + rows))
    while (falling := np.nonzero(table[rows, :-1] < -1e-12)[0]).size:
        enter = falling[0]
        up = np.nonzero(table[:rows, enter] > 1e-12)[0]
        ratio = table[up, -1] / table[up, enter]
        leave = min(up[ratio <= ratio.min() + 1e-15], key=lambda i: basis[i])
        table[leave] /= table[leave, enter]
        for i in range(rows + 1):
            if i != leave:
                table[i] -= table[i, enter] * table[leave]
        basis[leave] = enter
    y = np.zeros(cols)
    for i, j in enumerate(basis):
        if j < cols:
            y[j] = table[i, -1]
    w = np.maximum(y, 0.0) / np.maximum(y, 0.0).sum()
    # the dual prices mix the planes; the mix's least corner bounds the programme whatever the rounding
    price = np.maximum(table[rows, cols:-1], 0.0)
    return w, float(((price / price.sum()) @ planes).min())


def rmse_of_weight_sets(g: DataFrame, models: list[str], sets: DataFrame) -> DataFrame:
    """RMSE of linear blends (no clip) for each row of ``sets`` (config,
    w_<model> ...), from the one-row Gram table: sqrt((w'Gw - 2w'h + c) / n)."""
    # the Gram table is one row of M*(M+3)/2 + 2 numbers: read it once
    gcols = {c: F.lit(float(v)) for c, v in g.first().asDict().items()}
    quad = F.lit(0.0)
    for i, a in enumerate(models):
        for jdx, b in enumerate(models):
            key = f"g_{a}_{b}" if i <= jdx else f"g_{b}_{a}"
            quad = quad + F.col(f"w_{a}") * F.col(f"w_{b}") * gcols[key]
    lin = F.lit(0.0)
    for a in models:
        lin = lin + F.col(f"w_{a}") * gcols[f"h_{a}"]
    mse = (quad - 2 * lin + gcols["c"]) / gcols["n"]
    return sets.select("*", F.sqrt(F.greatest(mse, F.lit(0.0))).alias("rmse"))


def sensitivity(preds: DataFrame, truth: DataFrame, focus: str, others: list[str],
                split=(0.45, 0.55), n: int = 25, hi: float = 0.6) -> DataFrame:
    """w_focus over linspace(0, hi, n); the remainder split between the
    two other models by ``split``; RMSE of each (linear blend, no clip)."""
    models = [focus, *others]
    g = gram(preds, truth, models)
    spark = preds.sparkSession
    step = hi / (n - 1)
    grid = spark.range(n).select(F.col("id").alias("step"), (F.col("id") * F.lit(step)).alias(f"w_{focus}"))
    grid = grid.withColumn(f"w_{others[0]}", (F.lit(1.0) - F.col(f"w_{focus}")) * split[0]) \
        .withColumn(f"w_{others[1]}", (F.lit(1.0) - F.col(f"w_{focus}")) * split[1])
    return rmse_of_weight_sets(g, models, grid)


def ablation(preds: DataFrame, truth: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Each model alone, each model left out (others renormalised) and
    the full blend; RMSE of each configuration."""
    models = list(weights)
    rows = []
    for m in models:
        rows.append((f"{m} only", *[1.0 if x == m else 0.0 for x in models]))
    for m in models:
        rest = sum(weights[x] for x in models if x != m)
        rows.append((f"w/o {m}", *[0.0 if x == m else weights[x] / rest for x in models]))
    rows.append(("full", *[weights[x] for x in models]))
    schema = T.StructType([T.StructField("config", T.StringType())] +
                          [T.StructField(f"w_{x}", T.DoubleType()) for x in models])
    sets = preds.sparkSession.createDataFrame(rows, schema)
    return rmse_of_weight_sets(gram(preds, truth, models), models, sets)


def meta_features(preds: DataFrame, stats_from: DataFrame, pairs: DataFrame,
                  models: list[str]) -> DataFrame:
    """Per pair the base predictions plus user_avg, n_user_ratings,
    item_avg, n_item_ratings of ``stats_from`` (the frame the stacker is fitted
    on); missing averages take its global mean, missing counts 0."""
    us, it = _averages(stats_from)
    w = pairs.select("user_id", "movie_id").join(wide(preds, models), ["user_id", "movie_id"], "left")
    w = w.join(us, "user_id", "left").join(it, "movie_id", "left")
    return _filled(w, stats_from, models)


def _averages(stats_from: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean rating and number of ratings by user and by item."""
    return tuple(stats_from.groupBy(f"{key}_id").agg(F.avg(F.col("rating").cast("double")).alias(f"{name}_avg"),
                                                     F.count(F.lit(1)).alias(f"n_{name}_ratings"))
                 for key, name in (("user", "user"), ("movie", "item")))


def _filled(w: DataFrame, stats_from: DataFrame, models: list[str]) -> DataFrame:
    gm = stats_from.select(F.avg(F.col("rating").cast("double"))).scalar()
    return w.select("user_id", "movie_id", *[f"pred_{m}" for m in models],
                    F.coalesce("user_avg", gm).alias("user_avg"),
                    F.coalesce("n_user_ratings", F.lit(0)).cast("bigint").alias("n_user_ratings"),
                    F.coalesce("item_avg", gm).alias("item_avg"),
                    F.coalesce("n_item_ratings", F.lit(0)).cast("bigint").alias("n_item_ratings"))


def out_of_fold_features(rows: DataFrame, fits: dict, folds: int = 5, seed: int = 42) -> DataFrame:
    """The meta features of every row of ``rows`` (user_id, movie_id,
    rating), in which neither a base model nor an average has seen the row.

    Rows are dealt into folds by a hash of the pair. For each fold the base
    models (``fits``: name -> function from ratings to a rating model) and the
    user and item averages come from the other folds; the fold's features are
    written before the next fold starts, so a plan holds one fold. A user or
    item that only the fold itself holds counts as unknown. Returns the
    columns of ``meta_features`` and ``fold``."""
    if folds < 2:
        raise ValueError("out-of-fold features need at least two folds")
    names = list(fits)
    fold = (portable_hash("user_id", "movie_id", seed) % F.lit(folds)).cast("int")
    dealt = materialize(rows.select("user_id", "movie_id", "rating", fold.alias("fold")), "folds")
    out = None
    for f in range(folds):
        others = dealt.where(F.col("fold") != f).drop("fold")
        held = dealt.where(F.col("fold") == f).drop("fold")
        models = [fit(others) for fit in fits.values()]
        for model, name in zip(models, names):
            model.name = name
        us, it = _averages(others)
        feats = _filled(predict_wide(models, held, by_item=[it], by_user=[us]), others, names)
        feats = materialize(feats.withColumn("fold", F.lit(f)), f"fold-{f}")
        out = feats if out is None else out.unionByName(feats)
    return out


def _features(models: list[str]) -> list[str]:
    return [f"pred_{m}" for m in models] + ["user_avg", "n_user_ratings", "item_avg", "n_item_ratings"]


def fit_stack(feats: DataFrame, truth: DataFrame, models: list[str], kind: str = "gbt",
              alpha: float = 1.0, max_iter: int = 300, seed: int = 42):
    """Meta-learner on meta features joined to the truth.
    gbt: GBTRegressor(maxIter, stepSize .05, maxDepth 6, subsamplingRate .8,
    featureSubsetStrategy 0.8); ridge: LinearRegression(regParam
    alpha std(label) / n, elasticNetParam 0, standardization off), the solution of
    (X'X + alpha I) w = X'y on centred columns; linear: no penalty."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    data = feats.join(truth.select("user_id", "movie_id", F.col("rating").cast("double").alias("label")),
                      ["user_id", "movie_id"])
    if kind == "gbt":
        # 300 trees are some 2,000 short jobs: they read rows that are written once, in as few parts as keep a level's
        # task busy, as a job's time is that of starting its tasks
        rows = materialize(data.select(*_features(models), "label"), "stack-rows")
        data = rows.coalesce(max(1, -(-rows.count() // BOOSTED_ROWS)))
    va = VectorAssembler(inputCols=_features(models), outputCol="features", handleInvalid="keep")
    d = va.transform(data)
    if kind == "gbt":
        # the boosting state is checkpointed every 10 trees into the session's
        # checkpoint folder, so 300 trees do not build a 300-deep lineage
        from recfold.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(feats.sparkSession)
        est = GBTRegressor(maxIter=max_iter, stepSize=0.05, maxDepth=6, subsamplingRate=0.8,
                           featureSubsetStrategy="0.8", seed=seed, checkpointInterval=10)
    elif kind in ("ridge", "linear"):
        # MLlib divides the label by its standard deviation before it adds the penalty
        n, std = d.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
        est = LinearRegression(regParam=alpha * (std or 0.0) / max(n, 1) if kind == "ridge" else 0.0,
                               elasticNetParam=0.0, standardization=False)
    else:
        raise ValueError(kind)
    model = est.fit(d)
    if kind == "gbt":
        discard(rows)
    return va, model


def predict_stack(va, model, feats: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """E9 predict: meta-model output clipped to [lo, hi]."""
    out = model.transform(va.transform(feats))
    return out.select("user_id", "movie_id", clip("prediction", lo, hi).alias("predicted_rating"))
