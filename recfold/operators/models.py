"""Rating models as tables plus a batch scorer (SURVEY M1, M8, M9 and the
deterministic stand-ins ``item_mean`` / ``user_mean``).

A model is a set of tables: a global offset ``mu`` (a one-row aggregate used as
a scalar subquery), per-user terms and per-item terms, optionally with factor
vectors. Scoring a DataFrame of (user_id, movie_id) pairs is two left joins and
column arithmetic; a pair whose user or item the model does not know takes the
model's fill value (bias 0, zero vector), which is the reference's fallback.
The same model feeds the top-K engine in ``topk`` through ``numpy_scores``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfold.functions.portable import require_columns, sql_round

# Damping of the bias baseline (ours, SURVEY 7.4) and rating scale.
ITEM_DAMPING = 25.0
USER_DAMPING = 10.0
RATING_MIN = 1.0
RATING_MAX = 5.0
SCORE_DIGITS = 9


@dataclass
class RatingModel:
    """score = round(clip(mu + u_term + i_term + p_u . q_i), 9).

    ``users``: (user_id, u_term DOUBLE[, p ARRAY<DOUBLE>]);
    ``items``: (movie_id, i_term DOUBLE[, q ARRAY<DOUBLE>]).
    ``mu`` is a one-row, one-column DataFrame (or None for 0.0).
    ``u_fill`` / ``i_fill``: term for unknown ids (a Column, e.g. the global
    mean for ``item_mean``); ``lo``/``hi`` None means no clip.
    """

    name: str
    users: DataFrame | None
    items: DataFrame | None
    mu: DataFrame | None = None
    u_fill: DataFrame | None = None
    i_fill: DataFrame | None = None
    rank: int = 0
    lo: float | None = RATING_MIN
    hi: float | None = RATING_MAX
    digits: int | None = SCORE_DIGITS
    extra: dict = field(default_factory=dict)

    # -- relational scoring -------------------------------------------------
    def _scalar(self, df: DataFrame | None) -> Column:
        return F.lit(0.0) if df is None else df.scalar().cast("double")

    def score(self, pairs: DataFrame, out: str = "predicted_rating") -> DataFrame:
        """M9 batch predict: pairs + ``out``; unknown ids take the fill value."""
        require_columns(pairs, ["user_id", "movie_id"], "pairs")
        df = pairs
        if self.users is not None:
            df = df.join(self.users.withColumnRenamed("user_id", "_u"),
                         F.col("user_id") == F.col("_u"), "left").drop("_u")
        else:
            df = df.withColumn("u_term", F.lit(None).cast("double"))
        if self.items is not None:
            df = df.join(self.items.withColumnRenamed("movie_id", "_i"),
                         F.col("movie_id") == F.col("_i"), "left").drop("_i")
        else:
            df = df.withColumn("i_term", F.lit(None).cast("double"))
        keep = [c for c in pairs.columns]
        return df.select(*keep, self._value("u_term", "i_term", "p", "q").alias(out))

    def _value(self, u_term: str | None, i_term: str | None, p: str, q: str) -> Column:
        """Finished score from the named columns of joined tables; None: the model has no such table."""
        term = [F.lit(None).cast("double") if c is None else F.col(c) for c in (u_term, i_term)]
        s = (self._scalar(self.mu)
             + F.coalesce(term[0], self._scalar(self.u_fill))
             + F.coalesce(term[1], self._scalar(self.i_fill)))
        if self.rank > 0:
            dot = F.aggregate(F.zip_with(p, q, lambda a, b: a * b), F.lit(0.0),
                              lambda acc, x: acc + x)
            s = s + F.coalesce(dot, F.lit(0.0))
        return self.finish(s)

    def finish(self, s: Column) -> Column:
        if self.lo is not None:
            s = F.least(F.greatest(s, F.lit(self.lo)), F.lit(self.hi))
        if self.digits is not None:
            s = sql_round(s, self.digits)
        return s

    # -- vectorised scoring for the top-K engine ---------------------------
    def finish_params(self) -> tuple:
        return (self.lo, self.hi, self.digits)


def numpy_finish(s: np.ndarray, lo: float | None, hi: float | None,
                 digits: int | None) -> np.ndarray:
    """NumPy twin of ``RatingModel.finish``: clip, then round half away from
    zero on the scaled value (the rule SQL engines use for DOUBLE). Works on a
    copy, in place, to keep the block passes few."""
    s = np.array(s, dtype=np.float64, copy=True)
    if lo is not None:
        np.clip(s, lo, hi, out=s)
    if digits is not None:
        scale = 10.0 ** digits
        if lo is not None and lo >= 0:
            np.multiply(s, scale, out=s)
            s += 0.5
            np.floor(s, out=s)
            s /= scale
        else:
            neg = s < 0
            np.abs(s, out=s)
            np.multiply(s, scale, out=s)
            s += 0.5
            np.floor(s, out=s)
            s /= scale
            s[neg] *= -1.0
    return s


def _global_mean(train: DataFrame) -> DataFrame:
    return train.agg(F.avg(F.col("rating").cast("double")).alias("mu"))


def fit_bias(train: DataFrame, item_damping: float = ITEM_DAMPING,
             user_damping: float = USER_DAMPING) -> RatingModel:
    """M1: mu = avg(r); b_i = sum(r - mu)/(d_i + n_i); b_u = sum(r - mu - b_i)/(d_u + n_u).

    b_i is computed as (sum(r) - n*mu)/(d + n): the exact decimal sum (nine
    decimals, so half-star ratings are whole) makes it independent of summation
    order, so every engine gets the same bits.
    """
    require_columns(train, ["user_id", "movie_id", "rating"], "train")
    mu_df = _global_mean(train)
    mu = mu_df.scalar()
    items = train.groupBy("movie_id").agg(
        F.sum(F.col("rating").cast("decimal(28,9)")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    items = items.select(
        "movie_id",
        ((F.col("_s").cast("double") - F.col("_n").cast("double") * mu)
         / (F.lit(float(item_damping)) + F.col("_n"))).alias("i_term"))
    res = train.join(items.withColumnRenamed("movie_id", "_i"),
                     F.col("movie_id") == F.col("_i"), "left")
    users = res.groupBy("user_id").agg(
        (F.sum(F.col("rating") - mu - F.col("i_term"))
         / (F.lit(float(user_damping)) + F.count(F.lit(1)))).alias("u_term"))
    return RatingModel("bias", users, items, mu=mu_df)


def fit_item_mean(train: DataFrame) -> RatingModel:
    """Item mean; unknown items get the global train mean."""
    items = train.groupBy("movie_id").agg(F.avg(F.col("rating").cast("double")).alias("i_term"))
    return RatingModel("item_mean", None, items, i_fill=_global_mean(train))


def fit_user_mean(train: DataFrame) -> RatingModel:
    """User mean; unknown users get the global train mean."""
    users = train.groupBy("user_id").agg(F.avg(F.col("rating").cast("double")).alias("u_term"))
    return RatingModel("user_mean", users, None, u_fill=_global_mean(train))


def predict_long(models: list[RatingModel], pairs: DataFrame) -> DataFrame:
    """Predictions of several models in long form (model, user_id, movie_id,
    predicted_rating), one plan, so metrics can group by model."""
    out = None
    for m in models:
        p = m.score(pairs.select("user_id", "movie_id")).withColumn("model", F.lit(m.name))
        out = p if out is None else out.unionByName(p)
    return out.select("model", "user_id", "movie_id", "predicted_rating")


def predict_wide(models: list[RatingModel], pairs: DataFrame, by_item: list[DataFrame] = (),
                 by_user: list[DataFrame] = ()) -> DataFrame:
    """The pairs with one column ``pred_<name>`` per model, and the columns of
    further tables by item and by user. Everything of the items is joined before
    everything of the users, so a pair is shuffled twice however many models
    there are (in long form once per model and table, and again for the pivot).
    The tables hold an id once; a pair with a null id has no prediction."""
    df = pairs
    for side, key, letter, vector, more in (("items", "movie_id", "i", "q", by_item), ("users", "user_id", "u", "p", by_user)):
        for k, m in enumerate(models):
            table = getattr(m, side)
            if table is not None:
                cols = [F.col(f"{letter}_term").alias(f"_{letter}{k}")] + ([F.col(vector).alias(f"_{vector}{k}")] if m.rank > 0 else [])
                df = df.join(table.select(key, *cols), key, "left")
        for table in more:
            df = df.join(table, key, "left")
    known = F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()
    preds = [F.when(known, m._value(None if m.users is None else f"_u{k}", None if m.items is None else f"_i{k}", f"_p{k}", f"_q{k}"))
             .alias(f"pred_{m.name}") for k, m in enumerate(models)]
    kept = [c for c in df.columns if c not in {f"_{x}{k}" for x in "iupq" for k in range(len(models))}]
    return df.select(*kept, *preds)
