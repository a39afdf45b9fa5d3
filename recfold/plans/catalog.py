"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

This module holds the top-K family and imports the other plan modules so
that importing it registers everything."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfold.operators import models as M
from recfold.operators import topk as TK
from recfold.plans import oracle_views as O
from recfold.plans.common import Base, normalize

from recfold.plans.registry import ORACLES, QUERIES, register  # noqa: F401


# --------------------------------------------------------------------------
# Flagship top-10 with seen exclusion and titles
# --------------------------------------------------------------------------

_TOPK_BODY = """,
scored AS (
  SELECT a.user_id, c.movie_id, """ + O.BIAS_SCORE + """ AS score
  FROM all_users a CROSS JOIN cat c
  LEFT JOIN bias_users u ON u.user_id = a.user_id
  LEFT JOIN bias_items i ON i.movie_id = c.movie_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = a.user_id AND t.movie_id = c.movie_id)),
recs AS (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS BIGINT) AS rank,
         movie_id, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) <= 10)
"""


def topk_sql(*extra: str) -> str:
    """WITH block ending in ``recs(user_id, rank, movie_id, score)``: bias
    model top-10 for all users over the train+test catalogue, train excluded."""
    return O.with_ctes(*O.BASE, *O.MODELS, O.CATALOGUE, O.ALL_USERS, *extra) + _TOPK_BODY


def bias_recs(b: Base, k: int = 10) -> DataFrame:
    return TK.top_k(M.fit_bias(b.train), b.users(), b.catalogue(), seen=b.train, k=k)


@register("t1_topk_bias", topk_sql() + "SELECT user_id, rank, movie_id, score FROM recs")
def q_t1_topk_bias(spark, d):
    return normalize(bias_recs(Base(spark, d, materialize=True)))


@register("t3_topk_titles", topk_sql(O.TITLES) + """
SELECT r.user_id, r.rank, r.movie_id, r.score,
       coalesce(t.title, 'Unknown') AS title, coalesce(CAST(t.year AS VARCHAR), '?') AS year
FROM recs r LEFT JOIN titles t ON t.movie_id = r.movie_id""")
def q_t3_topk_titles(spark, d):
    b = Base(spark, d, materialize=True)
    return normalize(TK.with_titles(bias_recs(b), b.titles()))


# the other families register themselves on import
from recfold.plans import q_analysis, q_ensemble, q_eval, q_graph, q_io, q_models, q_prep, q_stats  # noqa: E402,F401
