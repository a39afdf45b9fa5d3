"""Rating and ranking metrics, all as grouped aggregates.

Ranking inputs are long: ``recs(user_id, rank, movie_id[, score])`` and
``eval_users(user_id)``, the users that were given a list, possibly empty
(an empty list still counts as 0 for users with relevant items).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import exact_avg, require_columns
from recfold.operators.graph import _COLS, neighbour_sums
from recfold.operators.prep import relevant as relevant_items
from recfold.session import materialize

RELEVANCE = 3.5
K = 10


def rating_metrics(test: DataFrame, preds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V1/V2: RMSE, MAE and n_predictions over the inner join of test and
    predictions on (user_id, movie_id), optionally per ``by`` (e.g. model)."""
    require_columns(test, ["user_id", "movie_id", "rating"], "test")
    require_columns(preds, ["user_id", "movie_id", "predicted_rating", *by], "predictions")
    j = test.select("user_id", "movie_id", "rating").join(
        preds.select("user_id", "movie_id", "predicted_rating", *by), ["user_id", "movie_id"])
    e = F.col("rating") - F.col("predicted_rating")
    g = j.groupBy(*by) if by else j
    out = g.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                F.count(F.lit(1)).alias("n_predictions"))
    # no overlapping pair is an error, raised lazily by the aggregate itself
    bad = F.raise_error(F.lit("No overlapping (user_id, movie_id) pairs between test and predictions"))
    return out.select(*by, F.when(F.col("n_predictions") == 0, bad.cast("double"))
                      .otherwise(F.col("rmse")).alias("rmse"), "mae", "n_predictions")


def ranking_per_user(recs: DataFrame, relevant: DataFrame, eval_users: DataFrame | None = None,
                     k: int = K, by: tuple[str, ...] = ()) -> DataFrame:
    """V3-V7, V10 per user: precision, recall, ap, ndcg at k and hit (whole
    list), for users that have a list and at least one relevant item."""
    if k <= 0:
        raise ValueError("k must be positive")
    require_columns(recs, ["user_id", "rank", "movie_id", *by], "recs")
    keys = [*by, "user_id"]
    rel = relevant.select("user_id", "movie_id").withColumn("_rel", F.lit(1))
    r = recs.select(*keys, "rank", "movie_id").join(rel, ["user_id", "movie_id"], "left") \
        .withColumn("_rel", F.coalesce(F.col("_rel"), F.lit(0)))
    cum = F.sum("_rel").over(Window.partitionBy(*keys).orderBy("rank")
                             .rowsBetween(Window.unboundedPreceding, 0))
    r = r.withColumn("_cum", cum)
    in_k = F.col("rank") <= k
    hit_k = in_k & (F.col("_rel") == 1)
    per = r.groupBy(*keys).agg(
        F.count(F.when(in_k, 1)).alias("_ntop"),
        F.sum(F.when(hit_k, 1).otherwise(0)).alias("_hits"),
        F.sum(F.when(hit_k, F.col("_cum") / F.col("rank")).otherwise(0.0)).alias("_ap"),
        F.sum(F.when(hit_k, 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias("_dcg"),
        F.sum("_rel").alias("_hits_all"))
    nrel = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    if eval_users is None:
        eval_users = recs.select(*keys).distinct()
    base = eval_users.select(*keys).distinct().join(nrel, "user_id")
    out = base.join(per, keys, "left").fillna(0, ["_ntop", "_hits", "_ap", "_dcg", "_hits_all"])
    m = F.least(F.col("n_relevant"), F.lit(k))
    idcg = F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(0.0),
                       lambda acc, i: acc + 1.0 / F.log2(i + 1))
    return out.select(
        *keys, "n_relevant",
        F.when(F.col("_ntop") > 0, F.col("_hits") / F.col("_ntop")).otherwise(0.0).alias("precision"),
        (F.col("_hits") / F.col("n_relevant")).alias("recall"),
        (F.col("_ap") / m).alias("ap"),
        (F.col("_dcg") / idcg).alias("ndcg"),
        (F.col("_hits_all") > 0).cast("int").alias("hit"))


def map_at_k(recs: DataFrame, relevant: DataFrame, eval_users: DataFrame | None = None,
             k: int = K) -> DataFrame:
    """V6: mean AP over users with a list and >= 1 relevant item; 0 if none."""
    per = ranking_per_user(recs, relevant, eval_users, k)
    return per.agg(F.coalesce(exact_avg("ap"), F.lit(0.0)).alias("map_at_k"))


def coverage(recs: DataFrame, items: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V8: distinct recommended items (whole lists) / distinct catalogue items."""
    n_total = items.select(F.countDistinct("movie_id")).scalar()
    g = recs.groupBy(*by) if by else recs
    return g.agg((F.countDistinct("movie_id") / n_total).alias("coverage"))


def ranking_report(recs: DataFrame, test: DataFrame, eval_users: DataFrame | None = None,
                   k: int = K, threshold: float = RELEVANCE,
                   by: tuple[str, ...] = ()) -> DataFrame:
    """Map, precision, recall, ndcg at k, hit_rate, coverage (over
    distinct test movies) and n_users_evaluated; one row (per ``by``)."""
    rel = relevant_items(test, threshold)
    per = ranking_per_user(recs, rel, eval_users, k, by)
    g = per.groupBy(*by) if by else per
    agg = g.agg(F.coalesce(exact_avg("ap"), F.lit(0.0)).alias("map_at_k"),
                F.coalesce(exact_avg("precision"), F.lit(0.0)).alias("precision_at_k"),
                F.coalesce(exact_avg("recall"), F.lit(0.0)).alias("recall_at_k"),
                F.coalesce(exact_avg("ndcg"), F.lit(0.0)).alias("ndcg_at_k"),
                F.coalesce(exact_avg("hit"), F.lit(0.0)).alias("hit_rate"),
                F.count(F.lit(1)).alias("n_users_evaluated"))
    cov = coverage(recs, test, by)
    if by:
        return agg.join(cov, list(by), "full")
    return agg.select("*", cov.select("coverage").scalar().alias("coverage"))


def diversity(recs: DataFrame, vectors: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """V9 per user: mean of 1 - cosine over unordered pairs of the list; lists
    shorter than 2 give 0. No pairs are built: with unit vectors n_i,
    sum_{i<j} n_i.n_j = (|sum n_i|^2 - L) / 2, and the sums come from one layer
    of the graph's grid (``graph.neighbour_sums``; with ``by`` from one aggregate
    per list and dim)."""
    keys = [*by, "user_id"]
    v = vectors.select("movie_id", F.col("emb").cast("array<double>").alias("emb"))
    norm = F.sqrt(F.aggregate(F.col("emb"), F.lit(0.0), lambda a, x: a + x * x))
    v = v.select("movie_id", F.transform("emb", lambda x: x / norm).alias("u"))
    if by:
        r = recs.select(*keys, "movie_id").join(v, "movie_id")
        dims = r.select(*keys, F.posexplode("u").alias("d", "x"))
        sums = dims.groupBy(*keys, "d").agg(F.sum("x").alias("s"))
        sq = sums.groupBy(*keys).agg(F.sum(F.col("s") * F.col("s")).alias("ss"))
    else:
        recs = materialize(recs.select("user_id", "movie_id"), "lists")  # the lists are read twice
        rows = recs.select(F.col("user_id").alias("src"), F.col("movie_id").alias("node"), F.lit(1.0).alias("weight"))
        sums = neighbour_sums(rows, v.select(F.col("movie_id").alias("node"), F.col("u").alias("emb")))
        squares = sum((F.col(c) * F.col(c) for c in _COLS), F.lit(0.0))
        sq = sums.groupBy(F.col("src").alias("user_id")).agg(F.sum(squares).alias("ss"))
    n = recs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"))
    out = n.join(sq, keys, "left")
    L = F.col("n_items").cast("double")
    div = F.when(F.col("n_items") < 2, F.lit(0.0)).otherwise(
        F.lit(1.0) - (F.col("ss") - L) / (L * (L - 1)))
    return out.select(*keys, "n_items", div.alias("diversity"))


def compare(results_long: DataFrame) -> DataFrame:
    """Long (model, metric, value) to one row per model, a column per
    metric (the smallest value when a key repeats)."""
    return results_long.groupBy("model").pivot("metric").agg(F.min("value"))


def best_and_improvement(results_long: DataFrame, baseline: str) -> DataFrame:
    """Per metric the best model (min for error metrics, max otherwise)
    and each model's delta and % change against ``baseline``."""
    lower_better = F.col("metric").isin("rmse", "mae")
    base = results_long.where(F.col("model") == baseline).select(
        "metric", F.col("value").alias("baseline_value"))
    order = F.when(lower_better, F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("metric").orderBy(order, F.col("model"))
    best = (results_long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("metric", F.col("model").alias("best_model")))
    out = results_long.join(base, "metric", "left").join(best, "metric")
    return out.select(
        "model", "metric", "value", "baseline_value", "best_model",
        (F.col("value") - F.col("baseline_value")).alias("delta"),
        ((F.col("value") - F.col("baseline_value")) / F.col("baseline_value") * 100.0).alias("pct_change"))
