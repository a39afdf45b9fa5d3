"""SQL text of the fixture views and shared steps, for the DuckDB oracles.

Each constant is one CTE body; ``with_ctes`` joins the ones a query needs.
They mirror ``views``, ``operators.splits.split_temporal_per_user`` and
``operators.models`` exactly (DOUBLE ratios, floor instead of int casts).
"""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT user_id, movie_id, rating, date FROM (
    SELECT o_custkey AS user_id, l_partkey AS movie_id,
           CAST(ceil(l_quantity / 10) AS INTEGER) AS rating,
           CAST(l_shipdate AS DATE) AS date,
           row_number() OVER (PARTITION BY o_custkey, l_partkey
             ORDER BY CAST(l_shipdate AS DATE) DESC, l_quantity DESC) AS rn
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey) t
  WHERE rn = 1)"""

SPLIT = """split AS (
  SELECT user_id, movie_id, rating, date,
         CASE WHEN pos < te THEN 'train' WHEN pos < ve THEN 'val' ELSE 'test' END AS split
  FROM (
    SELECT *, greatest(CAST(1 AS BIGINT), floor(n * CAST(0.7 AS DOUBLE))) AS te,
           greatest(greatest(CAST(1 AS BIGINT), floor(n * CAST(0.7 AS DOUBLE))) + 1,
                    floor(n * (CAST(0.7 AS DOUBLE) + CAST(0.1 AS DOUBLE)))) AS ve
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, movie_id) - 1 AS pos,
                 count(*) OVER (PARTITION BY user_id) AS n
          FROM ratings) a) b)"""

TRAIN = "train AS (SELECT user_id, movie_id, rating, date FROM split WHERE split = 'train')"
VAL = "val AS (SELECT user_id, movie_id, rating, date FROM split WHERE split = 'val')"
TEST = "test AS (SELECT user_id, movie_id, rating, date FROM split WHERE split = 'test')"

TITLES = """titles AS (
  SELECT p_partkey AS movie_id, CAST(1950 + p_size AS INTEGER) AS year, p_name AS title FROM part)"""

MU = "mu AS (SELECT avg(CAST(rating AS DOUBLE)) AS mu FROM train)"

BIAS_ITEMS = """bias_items AS (
  SELECT movie_id, (CAST(sum(rating) AS DOUBLE) - CAST(count(*) AS DOUBLE) * (SELECT mu FROM mu))
                   / (CAST(25 AS DOUBLE) + count(*)) AS i_term
  FROM train GROUP BY movie_id)"""

BIAS_USERS = """bias_users AS (
  SELECT t.user_id, sum(t.rating - (SELECT mu FROM mu) - i.i_term) / (CAST(10 AS DOUBLE) + count(*)) AS u_term
  FROM train t JOIN bias_items i ON t.movie_id = i.movie_id GROUP BY t.user_id)"""

ITEM_MEAN = "item_means AS (SELECT movie_id, avg(CAST(rating AS DOUBLE)) AS i_term FROM train GROUP BY movie_id)"
USER_MEAN = "user_means AS (SELECT user_id, avg(CAST(rating AS DOUBLE)) AS u_term FROM train GROUP BY user_id)"

CATALOGUE = "cat AS (SELECT movie_id FROM train UNION SELECT movie_id FROM test)"
ALL_USERS = "all_users AS (SELECT DISTINCT user_id FROM ratings)"


def clip9(expr: str) -> str:
    return (f"round(least(greatest({expr}, CAST(1 AS DOUBLE)), CAST(5 AS DOUBLE)), 9)")


BIAS_SCORE = clip9("(SELECT mu FROM mu) + coalesce(u.u_term, CAST(0 AS DOUBLE)) + coalesce(i.i_term, CAST(0 AS DOUBLE))")

def preds_cte(src: str = "test", name: str = "preds") -> str:
    """preds(model, user_id, movie_id, predicted_rating): the three
    deterministic models fitted on train, scored on ``src``."""
    return name + """ AS (
  SELECT 'item_mean' AS model, t.user_id, t.movie_id,
         """ + clip9("CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE) + coalesce(im.i_term, (SELECT mu FROM mu))") + """ AS predicted_rating
  FROM """ + src + """ t LEFT JOIN item_means im ON im.movie_id = t.movie_id
  UNION ALL
  SELECT 'user_mean', t.user_id, t.movie_id,
         """ + clip9("CAST(0 AS DOUBLE) + coalesce(um.u_term, (SELECT mu FROM mu)) + CAST(0 AS DOUBLE)") + """
  FROM """ + src + """ t LEFT JOIN user_means um ON um.user_id = t.user_id
  UNION ALL
  SELECT 'bias', t.user_id, t.movie_id, """ + BIAS_SCORE + """
  FROM """ + src + """ t LEFT JOIN bias_users u ON u.user_id = t.user_id LEFT JOIN bias_items i ON i.movie_id = t.movie_id)"""


PREDS = preds_cte("test", "preds")
PREDS_VAL = preds_cte("val", "vpreds")

BASE = [RATINGS, SPLIT, TRAIN, VAL, TEST]
MODELS = [MU, BIAS_ITEMS, BIAS_USERS, ITEM_MEAN, USER_MEAN]


def with_ctes(*ctes: str) -> str:
    seen: list[str] = []
    for c in ctes:
        if c not in seen:
            seen.append(c)
    return "WITH " + ",\n".join(seen) + "\n"
