"""Registered queries: recommendation and residual analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from recfold.functions.portable import exact_avg_sql, portable_hash_sql
from recfold.operators import analysis as N
from recfold.operators import models as M
from recfold.operators import topk as TK
from recfold.plans import oracle_views as O
from recfold.plans.catalog import bias_recs, topk_sql
from recfold.plans.common import Base, normalize
from recfold.plans.q_stats import _eqhist_sql as eqhist_sql
from recfold.plans.registry import register
from recfold.session import materialize

W = O.with_ctes
H_UM = portable_hash_sql("user_id", "movie_id", 42)

CT = """ct AS (SELECT r.user_id, count(*) AS n_recs,
         count(*) FILTER (WHERE t.rating >= 3.5) AS n_hits,
         count(*) FILTER (WHERE t.rating < 3.5) AS n_misses
       FROM recs r LEFT JOIN test t ON t.user_id = r.user_id AND t.movie_id = r.movie_id GROUP BY r.user_id),
cases AS (SELECT case_type, CAST(rk AS BIGINT) AS case_rank, user_id, n_hits, n_misses FROM (
   SELECT *, row_number() OVER (PARTITION BY case_type ORDER BY
            CASE WHEN case_type = 'success' THEN -n_hits ELSE -n_misses END, user_id) AS rk
   FROM (SELECT *, CASE WHEN n_hits > 0 THEN 'success' ELSE 'failure' END AS case_type FROM ct) a) b
 WHERE rk <= 20)"""


@register("n1_cases", topk_sql() + "," + CT + "\nSELECT * FROM cases")
def q_n1(spark, d):
    b = Base(spark, d)
    return normalize(N.cases(bias_recs(b), b.test, 20))


@register("n1_case_items", topk_sql(O.TITLES) + "," + CT + """,
items AS (SELECT c.case_type, r.user_id, r.rank, r.movie_id, t.rating,
            CASE WHEN t.rating >= 3.5 THEN 'hit' WHEN t.rating IS NOT NULL THEN 'miss' END AS kind
          FROM recs r JOIN cases c ON c.user_id = r.user_id
          LEFT JOIN test t ON t.user_id = r.user_id AND t.movie_id = r.movie_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY rank) AS pos FROM items WHERE kind IS NOT NULL)
SELECT x.case_type, x.user_id, x.kind, CAST(x.pos AS BIGINT) AS pos, x.movie_id, coalesce(ti.title, 'N/A') AS title,
       CASE WHEN x.kind = 'miss' THEN CAST(x.rating AS BIGINT) END AS actual_rating
FROM ranked x LEFT JOIN titles ti ON ti.movie_id = x.movie_id WHERE x.pos <= 5""")
def q_n1i(spark, d):
    b = Base(spark, d)
    return normalize(N.case_items(bias_recs(b), b.test, b.titles(), 20))


@register("n1_summary", topk_sql() + "," + CT.split(",\ncases AS")[0] + """
SELECT count(*) AS n_users, """ + exact_avg_sql("n_hits / n_recs") + """ AS avg_hit_ratio FROM ct""")
def q_n1s(spark, d):
    b = Base(spark, d)
    return normalize(N.case_summary(bias_recs(b), b.test))


HITS = """hits AS (SELECT r.user_id, r.rank, r.movie_id, r.score, CAST(t.rating AS BIGINT) AS actual_rating,
          CAST(CASE WHEN t.rating >= 4 THEN 1 ELSE 0 END AS BIGINT) AS is_hit
        FROM recs r LEFT JOIN test t ON t.user_id = r.user_id AND t.movie_id = r.movie_id)"""


@register("n2_hit_table", topk_sql() + "," + HITS + "\nSELECT * FROM hits")
def q_n2(spark, d):
    b = Base(spark, d)
    return normalize(N.hit_table(bias_recs(b), b.test))


@register("n2_user_hit_rates", topk_sql() + "," + HITS + "\nSELECT user_id, avg(is_hit) AS hit_rate FROM hits GROUP BY user_id")
def q_n2u(spark, d):
    b = Base(spark, d)
    return normalize(N.user_hit_rates(N.hit_table(bias_recs(b), b.test)))


@register("n3_n4_best_worst_users", topk_sql() + "," + HITS + """,
hr AS (SELECT user_id, avg(is_hit) AS hit_rate FROM hits GROUP BY user_id),
st AS (SELECT user_id, count(*) AS n_train, avg(CAST(rating AS DOUBLE)) AS avg_rating FROM train GROUP BY user_id),
bw AS (SELECT * FROM (SELECT 'best' AS grp, user_id, hit_rate FROM hr ORDER BY hit_rate DESC, user_id LIMIT 3)
       UNION ALL
       SELECT * FROM (SELECT 'worst' AS grp, user_id, hit_rate FROM hr ORDER BY hit_rate ASC, user_id DESC LIMIT 3))
SELECT bw.grp, bw.user_id, bw.hit_rate, coalesce(st.n_train, 0) AS n_train, st.avg_rating,
       CASE WHEN bw.grp = 'worst' THEN
         CASE WHEN coalesce(st.n_train, 0) < 10 THEN 'COLD START' WHEN st.avg_rating < 2.5 THEN 'NEGATIVE BIAS'
              WHEN st.avg_rating > 4.5 THEN 'POSITIVE BIAS' ELSE 'NICHE TASTE' END END AS diagnosis
FROM bw LEFT JOIN st ON st.user_id = bw.user_id""")
def q_n3(spark, d):
    b = Base(spark, d)
    return normalize(N.best_worst_users(N.hit_table(bias_recs(b), b.test), b.train))


@register("n5_coverage_active_users", W(*O.BASE, *O.MODELS, O.CATALOGUE) + """,
act AS (SELECT user_id FROM train GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 500),
scored AS (SELECT a.user_id, c.movie_id, """ + O.BIAS_SCORE + """ AS score FROM act a CROSS JOIN cat c
           LEFT JOIN bias_users u ON u.user_id = a.user_id LEFT JOIN bias_items i ON i.movie_id = c.movie_id
           WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = a.user_id AND t.movie_id = c.movie_id)),
recs AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) <= 10)
SELECT count(DISTINCT movie_id) AS n_unique, count(*) AS n_recs, (SELECT count(*) FROM cat) AS n_items,
       count(DISTINCT movie_id) / (SELECT count(*) FROM cat) AS coverage FROM recs""")
def q_n5(spark, d):
    b = Base(spark, d)
    users = N.most_active(b.train, 500)
    recs = TK.top_k(M.fit_bias(b.train), users, b.catalogue(), seen=b.train, k=10)
    return normalize(N.catalogue_coverage(recs, b.catalogue()))


@register("n6_rec_frequency", topk_sql(O.TITLES) + """
SELECT f.movie_id, f.times_recommended, coalesce(t.title, '?') AS title FROM
  (SELECT movie_id, count(*) AS times_recommended FROM recs GROUP BY movie_id
   ORDER BY times_recommended DESC, movie_id LIMIT 20) f LEFT JOIN titles t ON t.movie_id = f.movie_id""")
def q_n6(spark, d):
    b = Base(spark, d)
    return normalize(N.rec_frequency(bias_recs(b), b.titles(), 20))


@register("n6_frequency_histogram", topk_sql() + """,
rf AS (SELECT movie_id, count(*) AS n FROM recs GROUP BY movie_id)""" + eqhist_sql("rf", "n", 50))
def q_n6h(spark, d):
    return normalize(N.frequency_histogram(bias_recs(Base(spark, d)), 50))


@register("n7_popularity_bias", topk_sql() + """,
pr AS (SELECT movie_id, row_number() OVER (ORDER BY count(*) DESC, movie_id) - 1 AS pop_rank FROM train GROUP BY movie_id),
rp AS (SELECT r.movie_id, p.pop_rank FROM recs r LEFT JOIN pr p ON p.movie_id = r.movie_id),
th AS (SELECT unnest([50, 100, 200, 500, 1000, 2000, 5000]) AS top_t)
SELECT CAST(th.top_t AS BIGINT) AS top_t, count(*) FILTER (WHERE rp.pop_rank < th.top_t) AS n_in_top,
       count(*) FILTER (WHERE rp.pop_rank < th.top_t) / count(*) * 100 AS pct_of_recs
FROM th, rp GROUP BY th.top_t""")
def q_n7(spark, d):
    b = Base(spark, d)
    return normalize(N.popularity_bias(bias_recs(b), b.train))


@register("n8_popularity_compare", topk_sql() + """,
pop AS (SELECT movie_id, count(*) AS n FROM train GROUP BY movie_id)
SELECT (SELECT quantile_cont(ln(1 + CAST(n AS DOUBLE)), 0.5) FROM pop) AS median_log_pop_catalogue,
       (SELECT quantile_cont(ln(1 + CAST(coalesce(p.n, 0) AS DOUBLE)), 0.5) FROM recs r
          LEFT JOIN pop p ON p.movie_id = r.movie_id) AS median_log_pop_recs""")
def q_n8(spark, d):
    b = Base(spark, d)
    return normalize(N.popularity_compare(bias_recs(b), b.train))


def _series(name: str, src: str) -> str:
    x = f"(SELECT lo FROM mm_{name})", f"(SELECT hi - lo FROM mm_{name})"
    return f"""mm_{name} AS (SELECT min(v) AS lo, max(v) AS hi FROM {src}),
b_{name} AS (SELECT CAST(least(CASE WHEN {x[1]} = 0 THEN 0 ELSE floor((v - {x[0]}) * CAST(40 AS DOUBLE) / {x[1]}) END, 39)
                    AS BIGINT) AS bin FROM {src}),
h_{name} AS (SELECT bin, {x[0]} + {x[1]} * bin / CAST(40 AS DOUBLE) AS bin_lo,
                    {x[0]} + {x[1]} * (bin + 1) / CAST(40 AS DOUBLE) AS bin_hi, count(*) AS n, '{name}' AS series
             FROM b_{name} GROUP BY bin)"""


@register("n8_popularity_histograms", topk_sql() + """,
pop AS (SELECT movie_id, count(*) AS n FROM train GROUP BY movie_id),
catv AS (SELECT ln(1 + CAST(n AS DOUBLE)) AS v FROM pop),
recv AS (SELECT ln(1 + CAST(coalesce(p.n, 0) AS DOUBLE)) AS v FROM recs r LEFT JOIN pop p ON p.movie_id = r.movie_id),
""" + _series("catalogue", "catv") + ",\n" + _series("recommended", "recv") + """
SELECT * FROM h_catalogue UNION ALL SELECT * FROM h_recommended""")
def q_n8h(spark, d):
    b = Base(spark, d)
    return normalize(N.popularity_histograms(materialize(bias_recs(b), "recs"), b.train))


@register("n9_hit_rate_by_tier", topk_sql() + "," + HITS + """,
act AS (SELECT user_id, count(*) AS n FROM train GROUP BY user_id),
ht AS (SELECT h.is_hit, CASE WHEN a.n > 0 AND a.n <= 20 THEN 'Cold (<20)' WHEN a.n > 20 AND a.n <= 100 THEN 'Light (20-100)'
                        WHEN a.n > 100 AND a.n <= 500 THEN 'Regular (100-500)'
                        WHEN a.n > 500 THEN 'Power (500+)' END AS tier
       FROM hits h LEFT JOIN act a ON a.user_id = h.user_id)
SELECT tier, avg(is_hit) AS hit_rate, count(*) AS n_recs FROM ht WHERE tier IS NOT NULL GROUP BY tier""")
def q_n9(spark, d):
    b = Base(spark, d)
    return normalize(N.hit_rate_by_tier(N.hit_table(bias_recs(b), b.test), b.train))


_PJ = "FROM test t JOIN preds p ON p.user_id = t.user_id AND p.movie_id = t.movie_id"


@register("n10_residual_stats", W(*O.BASE, *O.MODELS, O.PREDS) + f"""
SELECT p.model, avg(t.rating - p.predicted_rating) AS mean_residual, stddev_pop(t.rating - p.predicted_rating) AS std_residual,
       max(t.rating - p.predicted_rating) AS max_residual, min(t.rating - p.predicted_rating) AS min_residual
{_PJ} GROUP BY p.model""")
def q_n10(spark, d):
    b = Base(spark, d)
    return normalize(N.residual_stats(b.preds(), b.test))


@register("n11_mae_by_rating", W(*O.BASE, *O.MODELS, O.PREDS) + f"""
SELECT p.model, CAST(t.rating AS BIGINT) AS rating, avg(abs(t.rating - p.predicted_rating)) AS mae, count(*) AS n
{_PJ} GROUP BY p.model, t.rating""")
def q_n11(spark, d):
    b = Base(spark, d)
    return normalize(N.mae_by_rating(b.preds(), b.test))


@register("n12_pred_sample", W(*O.BASE, *O.MODELS, O.PREDS) + f"""
SELECT t.user_id, t.movie_id, CAST(t.rating AS BIGINT) AS rating, p.predicted_rating {_PJ}
WHERE p.model = 'bias' ORDER BY {portable_hash_sql('t.user_id', 't.movie_id', 42)}, t.user_id, t.movie_id LIMIT 5000""")
def q_n12(spark, d):
    b = Base(spark, d)
    return normalize(N.pred_sample(b.preds().where(F.col("model") == "bias"), b.test, 5000))
