"""Registered queries: encoding, filters and splits (P, F, W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash_sql
from recfold.operators import models as M
from recfold.operators import prep as P
from recfold.operators import splits as S
from recfold.operators import topk as TK
from recfold.plans import oracle_views as O
from recfold.plans.common import Base, normalize
from recfold.plans.registry import register
from recfold.plans.views import ratings as ratings_view

W = O.with_ctes
H_UM = portable_hash_sql("user_id", "movie_id", 42)
H_U = portable_hash_sql("user_id", 0, 42)
H_M = portable_hash_sql("movie_id", 0, 42)


def core_sql(m: int, n: int, passes: int = 8, src: str = "ratings") -> list[str]:
    """F1 unrolled: ``passes`` rounds of (user filter, movie filter); ends in core."""
    ctes = [f"c0 AS (SELECT * FROM {src})"]
    for p in range(1, passes + 1):
        ctes.append(f"u{p} AS (SELECT * FROM c{p-1} WHERE user_id IN "
                    f"(SELECT user_id FROM c{p-1} GROUP BY user_id HAVING count(*) >= {m}))")
        ctes.append(f"c{p} AS (SELECT * FROM u{p} WHERE movie_id IN "
                    f"(SELECT movie_id FROM u{p} GROUP BY movie_id HAVING count(*) >= {n}))")
    ctes.append(f"core AS (SELECT * FROM c{passes})")
    return ctes


# ---- P1 / P2 / P3 / P5 / P6 ------------------------------------------------

@register("p1_encode_ids", W(O.RATINGS) + """
SELECT user_id, movie_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx,
       CAST(dense_rank() OVER (ORDER BY movie_id) - 1 AS BIGINT) AS movie_idx FROM ratings""")
def q_p1(spark, d):
    r = ratings_view(spark, d)
    return normalize(P.encode(r).select("user_id", "movie_id", "user_idx", "movie_idx"))


@register("p2_decode_ids", W(O.RATINGS) + """
SELECT DISTINCT CAST(dense_rank() OVER (ORDER BY movie_id) - 1 AS BIGINT) AS movie_idx,
       movie_id AS decoded_movie_id FROM ratings""")
def q_p2(spark, d):
    r = ratings_view(spark, d)
    mmap = P.dense_ids(r, "movie_id")
    enc = P.encode(r, movie_map=mmap).select("movie_idx").distinct()
    return normalize(P.decode(enc, "movie_idx", mmap, "decoded_movie_id"))


@register("p3_reencode_compose", W(O.RATINGS, *core_sql(8, 30)) + """
SELECT DISTINCT user_id AS orig_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS idx
FROM core""")
def q_p3(spark, d):
    r = ratings_view(spark, d)
    _, umap, _ = P.reencode_filtered(r, 8, 30)
    return normalize(umap)


@register("p5_universe_counts", W(*O.BASE) + """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       max(user_id) + 1 AS user_id_bound, max(movie_id) + 1 AS movie_id_bound
FROM (SELECT user_id, movie_id FROM train UNION ALL SELECT user_id, movie_id FROM val
      UNION ALL SELECT user_id, movie_id FROM test) u""")
def q_p5(spark, d):
    b = Base(spark, d, materialize=False)
    return normalize(P.universe_counts(b.train, b.val, b.test))


@register("p6_catalogue", W(*O.BASE) + "SELECT movie_id FROM train UNION SELECT movie_id FROM test")
def q_p6(spark, d):
    b = Base(spark, d, materialize=False)
    return normalize(P.catalogue(b.train, b.test))


# ---- F1 - F6 ----------------------------------------------------------------

@register("f1_kcore_8_30", W(O.RATINGS, *core_sql(8, 30)) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date FROM core")
def q_f1(spark, d):
    return normalize(P.k_core(ratings_view(spark, d), 8, 30))


@register("f1_kcore_5_5", W(O.RATINGS, *core_sql(5, 5)) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date FROM core")
def q_f1b(spark, d):
    return normalize(P.k_core(ratings_view(spark, d), 5, 5))


_T2_SQL = W(*O.BASE, *O.MODELS, O.CATALOGUE, O.ALL_USERS) + """,
scored AS (
  SELECT a.user_id, c.movie_id, """ + O.BIAS_SCORE + """ AS score
  FROM all_users a CROSS JOIN cat c
  LEFT JOIN bias_users u ON u.user_id = a.user_id
  LEFT JOIN bias_items i ON i.movie_id = c.movie_id),
cand AS (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS BIGINT) AS rank,
         movie_id, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) <= 20)
"""


@register("f2_exclude_seen", _T2_SQL + """
SELECT c.user_id, c.rank, c.movie_id, c.score FROM cand c
WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = c.user_id AND t.movie_id = c.movie_id)""")
def q_f2(spark, d):
    b = Base(spark, d)
    cand = TK.top_k(M.fit_bias(b.train), b.users(), b.catalogue(), seen=None, k=20)
    return normalize(P.exclude_seen(cand, b.train))


@register("t2_topk_no_exclusion", _T2_SQL + "SELECT user_id, rank, movie_id, score FROM cand")
def q_t2(spark, d):
    b = Base(spark, d)
    return normalize(TK.top_k(M.fit_bias(b.train), b.users(), b.catalogue(), seen=None, k=20))


@register("f3_relevant", W(*O.BASE) + "SELECT DISTINCT user_id, movie_id FROM test WHERE rating >= 3.5")
def q_f3(spark, d):
    return normalize(P.relevant(Base(spark, d, materialize=False).test, 3.5))


@register("f4_sample_users", W(O.RATINGS) + f"""
SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings) u ORDER BY {H_U}, user_id LIMIT 500""")
def q_f4(spark, d):
    return normalize(P.sample_users(ratings_view(spark, d), 500, 42))


@register("f5_activity_pick", W(*O.BASE) + """,
act AS (SELECT user_id, count(*) AS n_train_ratings FROM train GROUP BY user_id),
pos AS (SELECT *, row_number() OVER (ORDER BY user_id) - 1 AS idx, count(*) OVER () AS n FROM act)
SELECT * FROM (SELECT user_id, 'high' AS grp, n_train_ratings FROM act ORDER BY n_train_ratings DESC, user_id LIMIT 3)
UNION ALL
SELECT user_id, 'median', n_train_ratings FROM pos WHERE idx BETWEEN floor(n / 2) - 1 AND floor(n / 2) + 1
UNION ALL
SELECT * FROM (SELECT user_id, 'low', n_train_ratings FROM act ORDER BY n_train_ratings, user_id LIMIT 3)""")
def q_f5(spark, d):
    return normalize(P.activity_pick(Base(spark, d).train))


@register("f6_sampled_sparsity", W(O.RATINGS) + f""",
su AS (SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings) x ORDER BY {H_U}, user_id LIMIT 500),
sm AS (SELECT movie_id FROM (SELECT DISTINCT movie_id FROM ratings) x ORDER BY {H_M}, movie_id LIMIT 500),
sub AS (SELECT * FROM ratings WHERE user_id IN (SELECT user_id FROM su) AND movie_id IN (SELECT movie_id FROM sm))
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       count(DISTINCT (user_id, movie_id)) AS n_cells,
       1 - count(DISTINCT (user_id, movie_id)) / (count(DISTINCT user_id) * count(DISTINCT movie_id)) AS sparsity
FROM sub""")
def q_f6(spark, d):
    return normalize(P.sampled_sparsity(ratings_view(spark, d), 500, 500, 42))


# ---- W1 - W6 ----------------------------------------------------------------

@register("w1_split_temporal_per_user", W(O.RATINGS, O.SPLIT) + "SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date, split FROM split")
def q_w1(spark, d):
    return normalize(Base(spark, d, materialize=False).split)


@register("w2_split_temporal_global", W(O.RATINGS) + """
SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date,
       CASE WHEN pos < floor(n * (CAST(1 AS DOUBLE) - CAST(0.1 AS DOUBLE) - CAST(0.1 AS DOUBLE))) THEN 'train'
            WHEN pos < floor(n * (CAST(1 AS DOUBLE) - CAST(0.1 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY date, user_id, movie_id) - 1 AS pos, count(*) OVER () AS n
      FROM ratings) a""")
def q_w2(spark, d):
    return normalize(S.split_temporal_global(ratings_view(spark, d), 0.1, 0.1))


@register("w3_split_random_global", W(O.RATINGS) + f"""
SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date,
       CASE WHEN pos < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
            WHEN pos < floor(n * (CAST(0.7 AS DOUBLE) + CAST(0.1 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {H_UM}, user_id, movie_id) - 1 AS pos, count(*) OVER () AS n
      FROM ratings) a""")
def q_w3(spark, d):
    return normalize(S.split_random_global(ratings_view(spark, d), 0.7, 0.1, 0.2, 42))


@register("w4_split_random_per_user", W(O.RATINGS) + f"""
SELECT user_id, movie_id, CAST(rating AS BIGINT) AS rating, date,
       CASE WHEN pos < nt THEN 'test' WHEN pos < nt + nv THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, greatest(CAST(1 AS BIGINT), floor(n * CAST(0.1 AS DOUBLE))) AS nt,
             greatest(CAST(1 AS BIGINT), floor(n * CAST(0.1 AS DOUBLE))) AS nv
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {H_UM}, movie_id) - 1 AS pos,
                   count(*) OVER (PARTITION BY user_id) AS n FROM ratings) a) b""")
def q_w4(spark, d):
    return normalize(S.split_random_per_user(ratings_view(spark, d), 0.1, 0.1, 42))


@register("w5_split_summary", W(O.RATINGS, O.SPLIT) + """
SELECT split, count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       avg(rating) AS mean_rating,
       count(*) / (count(DISTINCT user_id) * count(DISTINCT movie_id)) * 100 AS density_pct
FROM split GROUP BY split""")
def q_w5(spark, d):
    return normalize(S.split_summary(Base(spark, d, materialize=False).split))


@register("w6_split_integrity", W(O.RATINGS, O.SPLIT) + """
SELECT (SELECT count(*) FROM (SELECT user_id, max(CASE WHEN split = 'train' THEN date END) AS a,
                                     min(CASE WHEN split = 'test' THEN date END) AS b
                              FROM split GROUP BY user_id) x WHERE a > b) AS n_order_violations,
       (SELECT count(*) FROM (SELECT user_id, movie_id FROM split GROUP BY user_id, movie_id
                              HAVING count(DISTINCT split) > 1) y) AS n_shared_pairs""")
def q_w6(spark, d):
    return normalize(S.split_integrity(Base(spark, d, materialize=False).split))
