"""SQL builders for the evaluation oracles: per-model scoring, top-K lists
and the ranking report."""

from __future__ import annotations

from recfold.functions.portable import exact_avg_sql as XA
from recfold.plans import oracle_views as O

_JOINS = {
    "bias": ("LEFT JOIN bias_users u ON u.user_id = a.user_id LEFT JOIN bias_items i ON i.movie_id = c.movie_id",
             O.BIAS_SCORE),
    "item_mean": ("LEFT JOIN item_means im ON im.movie_id = c.movie_id",
                  O.clip9("CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE) + coalesce(im.i_term, (SELECT mu FROM mu))")),
    "user_mean": ("LEFT JOIN user_means um ON um.user_id = a.user_id",
                  O.clip9("CAST(0 AS DOUBLE) + coalesce(um.u_term, (SELECT mu FROM mu)) + CAST(0 AS DOUBLE)")),
}


def recs_cte(model: str, users: str, name: str, k: int = 10, exclude: bool = True) -> str:
    """CTE ``name``(model, user_id, rank, movie_id, score): top-k of ``model``
    for users in CTE ``users`` over catalogue ``cat``."""
    joins, score = _JOINS[model]
    ex = ("WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = a.user_id AND t.movie_id = c.movie_id)"
          if exclude else "")
    return f"""{name} AS (
  SELECT '{model}' AS model, user_id, CAST(rk AS BIGINT) AS rank, movie_id, score FROM (
    SELECT user_id, movie_id, score,
           row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rk
    FROM (SELECT a.user_id, c.movie_id, {score} AS score
          FROM {users} a CROSS JOIN cat c {joins} {ex}) s) r
  WHERE rk <= {k})"""


def ranking_ctes(recs: str, eval_users: str, k: int = 10, thr: float = 3.5) -> list[str]:
    """CTEs ending in ``per_user``(model, user_id, n_relevant, precision,
    recall, ap, ndcg, hit) for recs(model, user_id, rank, movie_id) and
    eval_users(model, user_id)."""
    return [
        f"rel AS (SELECT DISTINCT user_id, movie_id FROM test WHERE rating >= {thr})",
        "nrel AS (SELECT user_id, count(*) AS n_relevant FROM rel GROUP BY user_id)",
        f"""rr AS (SELECT r.model, r.user_id, r.rank, CASE WHEN rel.movie_id IS NULL THEN 0 ELSE 1 END AS isrel
           FROM {recs} r LEFT JOIN rel ON rel.user_id = r.user_id AND rel.movie_id = r.movie_id)""",
        """rr2 AS (SELECT *, sum(isrel) OVER (PARTITION BY model, user_id ORDER BY rank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM rr)""",
        f"""per AS (SELECT model, user_id,
             count(*) FILTER (WHERE rank <= {k}) AS ntop,
             sum(CASE WHEN rank <= {k} AND isrel = 1 THEN 1 ELSE 0 END) AS hits,
             sum(CASE WHEN rank <= {k} AND isrel = 1 THEN cum / rank ELSE 0 END) AS ap,
             sum(CASE WHEN rank <= {k} AND isrel = 1 THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg,
             sum(isrel) AS hits_all FROM rr2 GROUP BY model, user_id)""",
        f"""per_user AS (SELECT e.model, e.user_id, n.n_relevant,
             CASE WHEN coalesce(p.ntop, 0) > 0 THEN p.hits / p.ntop ELSE 0 END AS precision,
             coalesce(p.hits, 0) / n.n_relevant AS recall,
             coalesce(p.ap, 0) / least(n.n_relevant, {k}) AS ap,
             coalesce(p.dcg, 0) / list_sum(list_transform(range(1, CAST(least(n.n_relevant, {k}) AS BIGINT) + 1),
                                                          lambda i: 1 / log2(i + 1))) AS ndcg,
             CAST(CASE WHEN coalesce(p.hits_all, 0) > 0 THEN 1 ELSE 0 END AS BIGINT) AS hit
           FROM (SELECT DISTINCT model, user_id FROM {eval_users}) e
           JOIN nrel n ON n.user_id = e.user_id
           LEFT JOIN per p ON p.model = e.model AND p.user_id = e.user_id)""",
    ]


def report_select(recs: str) -> str:
    """Final SELECT of the V11 report per model over ``per_user``."""
    return f"""
SELECT a.model, a.map_at_k, a.precision_at_k, a.recall_at_k, a.ndcg_at_k, a.hit_rate, a.n_users_evaluated,
       c.coverage
FROM (SELECT model, coalesce({XA("ap")}, 0) AS map_at_k, coalesce({XA("precision")}, 0) AS precision_at_k,
             coalesce({XA("recall")}, 0) AS recall_at_k, coalesce({XA("ndcg")}, 0) AS ndcg_at_k,
             coalesce({XA("hit")}, 0) AS hit_rate, count(*) AS n_users_evaluated
      FROM per_user GROUP BY model) a
FULL JOIN (SELECT model, count(DISTINCT movie_id) / (SELECT count(DISTINCT movie_id) FROM test) AS coverage
           FROM {recs} GROUP BY model) c ON a.model = c.model"""
