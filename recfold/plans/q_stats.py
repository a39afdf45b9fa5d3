"""Registered queries: statistics and EDA aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from recfold.operators import graph as G
from recfold.operators import stats as A
from recfold.plans import oracle_views as O
from recfold.plans.common import Base, normalize, ratings_once
from recfold.plans.registry import register
from recfold.plans.views import ratings as ratings_view
from recfold.plans.views import titles as titles_view
from recfold.session import materialize

W = O.with_ctes
D = "CAST({} AS DOUBLE)".format


def _entity_sql(col: str) -> str:
    return W(O.RATINGS) + f"""
SELECT {col}, count(*) AS n_ratings, avg(CAST(rating AS DOUBLE)) AS avg_rating,
       stddev_samp(CAST(rating AS DOUBLE)) AS std_rating FROM ratings GROUP BY {col}"""


@register("a1_user_stats", _entity_sql("user_id"))
def q_a1(spark, d):
    return normalize(A.entity_stats(ratings_view(spark, d), "user_id"))


@register("a2_movie_stats", _entity_sql("movie_id"))
def q_a2(spark, d):
    return normalize(A.entity_stats(ratings_view(spark, d), "movie_id"))


@register("a3_sparsity", W(O.RATINGS) + """
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT movie_id)) AS sparsity FROM ratings""")
def q_a3(spark, d):
    return normalize(A.sparsity(ratings_view(spark, d)))


@register("a4_rating_distribution", W(O.RATINGS) + """
SELECT CAST(rating AS BIGINT) AS rating, count(*) AS n, count(*) / (SELECT count(*) FROM ratings) * 100 AS pct
FROM ratings GROUP BY rating""")
def q_a4(spark, d):
    return normalize(A.rating_distribution(ratings_once(spark, d)))


def _describe_sql(src: str, col: str, name: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{name}' AS variable, count({col}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, "
            f"min({x}) AS min, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
            f"quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM {src}")


@register("a5_describe", W(O.RATINGS) + """,
ua AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id),
ma AS (SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id)
""" + _describe_sql("ratings", "rating", "rating") + "\nUNION ALL\n" + _describe_sql("ua", "n", "user_activity")
          + "\nUNION ALL\n" + _describe_sql("ma", "n", "movie_popularity"))
def q_a5(spark, d):
    r = ratings_once(spark, d)
    parts = [A.describe(r, "rating").withColumn("variable", F.lit("rating")),
             A.describe(materialize(A.activity(r, "user_id"), "activity"), "n").withColumn("variable", F.lit("user_activity")),
             A.describe(materialize(A.activity(r, "movie_id"), "activity"), "n").withColumn("variable", F.lit("movie_popularity"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return normalize(out.select("variable", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


@register("a6_activity_percentiles", W(O.RATINGS) + """,
ua AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)
SELECT quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, quantile_cont(n, 0.9) AS p90,
       quantile_cont(n, 0.95) AS p95, quantile_cont(n, 0.99) AS p99 FROM ua""")
def q_a6(spark, d):
    return normalize(A.activity_percentiles(ratings_view(spark, d), "user_id"))


def _loghist_sql(col: str) -> str:
    return W(O.RATINGS) + f""",
act AS (SELECT {col}, count(*) AS n FROM ratings GROUP BY {col}),
st AS (SELECT log10(max(n) + {D(1)}) / {D(59)} AS step, quantile_cont(n, 0.5) AS med FROM act),
b AS (SELECT CAST(least(floor(log10(CAST(n AS DOUBLE)) / (SELECT step FROM st)), 58) AS BIGINT) AS bin FROM act)
SELECT bin, pow({D(10)}, bin * (SELECT step FROM st)) AS bin_lo, pow({D(10)}, (bin + 1) * (SELECT step FROM st)) AS bin_hi,
       count(*) AS n_entities, (SELECT med FROM st) AS median FROM b GROUP BY bin"""


@register("a7_log_histogram_users", _loghist_sql("user_id"))
def q_a7u(spark, d):
    return normalize(A.log_histogram(ratings_once(spark, d), "user_id"))


@register("a7_log_histogram_movies", _loghist_sql("movie_id"))
def q_a7m(spark, d):
    return normalize(A.log_histogram(ratings_once(spark, d), "movie_id"))


def _eqhist_sql(src: str, col: str, bins: int) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return f""",
mm AS (SELECT min({x}) AS lo, max({x}) AS hi FROM {src}),
b AS (SELECT CAST(least(CASE WHEN (SELECT hi - lo FROM mm) = 0 THEN 0
        ELSE floor(({x} - (SELECT lo FROM mm)) * {D(bins)} / (SELECT hi - lo FROM mm)) END, {bins - 1}) AS BIGINT) AS bin
      FROM {src} WHERE {col} IS NOT NULL)
SELECT bin, (SELECT lo FROM mm) + (SELECT hi - lo FROM mm) * bin / {D(bins)} AS bin_lo,
       (SELECT lo FROM mm) + (SELECT hi - lo FROM mm) * (bin + 1) / {D(bins)} AS bin_hi, count(*) AS n
FROM b GROUP BY bin"""


@register("a8_equal_width_activity", W(O.RATINGS) + """,
ua AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)""" + _eqhist_sql("ua", "n", 100))
def q_a8a(spark, d):
    return normalize(A.equal_width_histogram(A.activity(ratings_once(spark, d), "user_id"), "n", 100))


@register("a8_equal_width_popularity", W(O.RATINGS) + """,
ma AS (SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id)""" + _eqhist_sql("ma", "n", 100))
def q_a8p(spark, d):
    return normalize(A.equal_width_histogram(A.activity(ratings_once(spark, d), "movie_id"), "n", 100))


@register("a8_equal_width_residuals", W(*O.BASE, *O.MODELS, O.PREDS) + """,
res AS (SELECT t.rating - p.predicted_rating AS e FROM test t JOIN preds p
        ON p.user_id = t.user_id AND p.movie_id = t.movie_id WHERE p.model = 'bias')""" + _eqhist_sql("res", "e", 50))
def q_a8r(spark, d):
    b = Base(spark, d)
    p = b.preds().where(F.col("model") == "bias")
    res = b.test.join(p, ["user_id", "movie_id"]).select((F.col("rating") - F.col("predicted_rating")).alias("e"))
    return normalize(A.equal_width_histogram(res, "e", 50))


_LORENZ = W(O.RATINGS) + """,
act AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id),
g AS (SELECT n, count(*) AS n_entities FROM act GROUP BY n),
r AS (SELECT n, n_entities, sum(n_entities) OVER (ORDER BY n DESC) AS ce,
             sum(n * n_entities) OVER (ORDER BY n DESC) AS cr,
             sum(n_entities) OVER () AS nn, sum(n * n_entities) OVER () AS tt FROM g)
"""


@register("a9_lorenz_curve", _LORENZ + """
SELECT n, n_entities, ce / nn * 100 AS entity_pct, cr / tt * 100 AS rating_pct FROM r""")
def q_a9c(spark, d):
    return normalize(A.lorenz_curve(ratings_once(spark, d), "user_id"))


@register("a9_lorenz_cut", _LORENZ + f""",
c AS (SELECT *, ce - n_entities AS eb, cr - n * n_entities AS rb, {D(80)} * tt / {D(100)} AS need FROM r),
p AS (SELECT eb + greatest(ceil((need - rb) / n) - 1, 0) AS pos, nn FROM c WHERE cr >= need AND rb < need)
SELECT CAST(pos AS BIGINT) AS position, (pos + 1) / nn * 100 AS top_entity_pct FROM p""")
def q_a9x(spark, d):
    return normalize(A.lorenz_cut(ratings_once(spark, d), "user_id"))


@register("a10_top_movies", W(O.RATINGS, O.TITLES) + """,
g AS (SELECT movie_id, count(*) AS n_ratings, avg(CAST(rating AS DOUBLE)) AS avg_rating FROM ratings
      GROUP BY movie_id ORDER BY n_ratings DESC, movie_id LIMIT 20)
SELECT g.movie_id, g.n_ratings, g.avg_rating, coalesce(t.title, 'Movie ' || CAST(g.movie_id AS VARCHAR)) AS title
FROM g LEFT JOIN titles t ON t.movie_id = g.movie_id""")
def q_a10(spark, d):
    return normalize(A.top_movies(ratings_view(spark, d), titles_view(spark, d), 20))


@register("a11_monthly", W(O.RATINGS) + """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_ratings,
       avg(CAST(rating AS DOUBLE)) AS avg_rating FROM ratings WHERE date IS NOT NULL GROUP BY 1""")
def q_a11(spark, d):
    return normalize(A.monthly(ratings_view(spark, d)))


@register("a12_monthly_filled", W(O.RATINGS) + """,
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n FROM ratings
      WHERE date IS NOT NULL GROUP BY 1),
cal AS (SELECT CAST(generate_series AS DATE) AS month FROM generate_series(
          CAST((SELECT min(month) FROM m) AS TIMESTAMP), CAST((SELECT max(month) FROM m) AS TIMESTAMP),
          INTERVAL 1 MONTH))
SELECT last_day(cal.month) AS month_end, coalesce(m.n, 0) AS n_ratings FROM cal LEFT JOIN m ON m.month = cal.month""")
def q_a12(spark, d):
    return normalize(A.monthly_filled(ratings_view(spark, d)))


@register("a13_degree_summary", W(*O.BASE) + """,
mat AS (SELECT user_id, movie_id, sum(CAST(rating AS DOUBLE)) AS value FROM train GROUP BY user_id, movie_id),
ud AS (SELECT user_id, sum(value) AS deg FROM mat GROUP BY user_id),
id AS (SELECT movie_id, sum(value) AS deg FROM mat GROUP BY movie_id)
SELECT 'user' AS side, count(*) AS n_nodes, avg(deg) AS mean_degree, max(deg) AS max_degree FROM ud WHERE deg > 0
UNION ALL
SELECT 'item', count(*), avg(deg), max(deg) FROM id WHERE deg > 0""")
def q_a13(spark, d):
    b = Base(spark, d)
    return normalize(A.degree_summary(G.interactions(b.train)))


@register("a14_key_figures", W(O.RATINGS) + """,
ua AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id),
ma AS (SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id),
ru AS (SELECT n, row_number() OVER (ORDER BY n DESC, user_id) AS rn FROM ua),
rm AS (SELECT n, row_number() OVER (ORDER BY n DESC, movie_id) AS rn FROM ma)
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
       1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT movie_id)) AS sparsity,
       avg(CAST(rating AS DOUBLE)) AS rating_mean, stddev_samp(CAST(rating AS DOUBLE)) AS rating_std,
       (SELECT sum(n) FILTER (WHERE rn <= floor((SELECT count(*) FROM ua) * CAST(0.1 AS DOUBLE))) / sum(n) FROM ru)
         AS top_user_share,
       (SELECT sum(n) FILTER (WHERE rn <= 100) / sum(n) FROM rm) AS top_movie_share
FROM ratings""")
def q_a14(spark, d):
    return normalize(A.key_figures(ratings_once(spark, d)))
