"""Full evaluation: rating metrics on every test row plus ranking
metrics on top-K lists of a seeded user sample, for several models in one
plan (long predictions, metrics grouped by model)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfold.operators import metrics as V
from recfold.operators.models import RatingModel, predict_long
from recfold.operators.prep import sample_users
from recfold.operators.topk import top_k
from recfold.session import materialize


def model_recs(models: list[RatingModel], users: DataFrame, catalogue: DataFrame,
               seen: DataFrame | None, k: int = 10) -> DataFrame:
    """Top-K lists of several models in long form (model, user_id, rank,
    movie_id, score), ranked in one pass over the user rows."""
    return top_k(list(models), users, catalogue, seen=seen, k=k)


def full_report(models: list[RatingModel], train: DataFrame, test: DataFrame,
                catalogue: DataFrame, k: int = 10, n_sample_users: int = 500,
                threshold: float = V.RELEVANCE, seed: int = 42) -> DataFrame:
    """One row per model: rmse, mae, n_predictions and the V11 ranking report
    over ``n_sample_users`` test users (seeded-hash sample)."""
    preds = predict_long(models, test)
    rating = V.rating_metrics(test, preds, by=("model",))
    users = sample_users(test, n_sample_users, seed)
    # k rows per user and model, read by the list metrics and by coverage: ranked once
    recs = materialize(model_recs(models, users, catalogue, seen=train, k=k), "recs")
    # every sampled user is evaluated for every model, even with an empty list
    eval_users = users.select("user_id", F.explode(F.array(*[F.lit(m.name) for m in models]))
                              .alias("model"))
    ranking = V.ranking_report(recs, test, eval_users, k, threshold, by=("model",))
    return rating.join(ranking, "model", "left")
