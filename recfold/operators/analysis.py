"""Recommendation and residual analysis.

``recs`` is the long top-K table (user_id, rank, movie_id, score); a user's
list is at most k rows, so per-user arrays built here are bounded by k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import exact_avg, portable_hash
from recfold.operators.graph import position_within
from recfold.operators.stats import equal_width_histogram, exact_quantiles
from recfold.session import materialize

HIT = 3.5
HIT_NOTEBOOK = 4.0
# fixed values: tier edges and labels, popularity thresholds
TIER_EDGES = (0, 20, 100, 500, float("inf"))
TIER_LABELS = ("Cold (<20)", "Light (20-100)", "Regular (100-500)", "Power (500+)")
POP_THRESHOLDS = (50, 100, 200, 500, 1000, 2000, 5000)


def _last_test(test: DataFrame) -> DataFrame:
    # duplicate (user, movie) test rows: the latest date wins, then the larger
    # rating; with unique pairs this is the row itself
    rank = F.struct("date", "rating") if "date" in test.columns else F.struct("rating")
    return test.groupBy("user_id", "movie_id").agg(F.max_by("rating", rank).alias("actual_rating"))


def case_table(recs: DataFrame, test: DataFrame, threshold: float = HIT) -> DataFrame:
    """N1 per user: n_hits (test rating >= threshold), n_misses (in test,
    below), n_recs, the first 5 hit / miss movie ids by rank."""
    t = _last_test(test)
    r = recs.join(t, ["user_id", "movie_id"], "left")
    hit = F.col("actual_rating") >= threshold
    miss = F.col("actual_rating").isNotNull() & (F.col("actual_rating") < threshold)
    g = r.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.count(F.when(hit, 1)).alias("n_hits"),
        F.count(F.when(miss, 1)).alias("n_misses"),
        F.sort_array(F.collect_list(F.when(hit, F.struct("rank", "movie_id")))).alias("_h"),
        F.sort_array(F.collect_list(F.when(miss, F.struct("rank", "movie_id", "actual_rating")))).alias("_m"))
    return g.select("user_id", "n_recs", "n_hits", "n_misses",
                    F.transform(F.slice("_h", 1, 5), lambda x: x["movie_id"]).alias("hit_items"),
                    F.slice("_m", 1, 5).alias("miss_items"))


def cases(recs: DataFrame, test: DataFrame, n: int = 20, threshold: float = HIT) -> DataFrame:
    """20 success cases (by n_hits desc) and 20 failure cases (no hit, by
    n_misses desc); ties by user id. (case, case_rank, user_id, n_hits, n_misses)."""
    c = case_table(recs, test, threshold)
    c = c.withColumn("case_type", F.when(F.col("n_hits") > 0, "success").otherwise("failure"))
    ws = Window.partitionBy("case_type").orderBy(
        F.when(F.col("case_type") == "success", -F.col("n_hits")).otherwise(-F.col("n_misses")), "user_id")
    # a top-n per case: Catalyst plans this as a WindowGroupLimit
    return (c.withColumn("case_rank", F.row_number().over(ws)).where(F.col("case_rank") <= n)
            .select("case_type", "case_rank", "user_id", "n_hits", "n_misses"))


def case_items(recs: DataFrame, test: DataFrame, titles: DataFrame | None, n: int = 20,
               threshold: float = HIT) -> DataFrame:
    """N1 detail, long form: (case, user_id, kind, pos, movie_id, title,
    actual_rating) for the first 5 hits / misses of each listed case."""
    top = cases(recs, test, n, threshold)
    t = _last_test(test)
    r = recs.join(top.select("case_type", "user_id"), "user_id").join(t, ["user_id", "movie_id"], "left")
    kind = F.when(F.col("actual_rating") >= threshold, "hit").when(F.col("actual_rating").isNotNull(), "miss")
    r = r.withColumn("kind", kind).where(F.col("kind").isNotNull())
    r = r.withColumn("pos", F.row_number().over(Window.partitionBy("user_id", "kind").orderBy("rank")))
    r = r.where(F.col("pos") <= 5)
    if titles is not None:
        r = r.join(titles.select("movie_id", "title"), "movie_id", "left")
    else:
        r = r.withColumn("title", F.lit(None).cast("string"))
    return r.select("case_type", "user_id", "kind", F.col("pos").cast("bigint").alias("pos"), "movie_id",
                    F.coalesce("title", F.lit("N/A")).alias("title"),
                    F.when(F.col("kind") == "miss", F.col("actual_rating")).alias("actual_rating"))


def case_summary(recs: DataFrame, test: DataFrame, threshold: float = HIT) -> DataFrame:
    """N1 summary: users analysed and mean of hits / list length (0 without hit)."""
    c = case_table(recs, test, threshold)
    return c.agg(F.count(F.lit(1)).alias("n_users"),
                 exact_avg(F.col("n_hits") / F.col("n_recs")).alias("avg_hit_ratio"))


def hit_table(recs: DataFrame, test: DataFrame, threshold: float = HIT_NOTEBOOK) -> DataFrame:
    """Per recommendation the actual test rating and is_hit = actual >= 4."""
    t = _last_test(test)
    r = recs.join(t, ["user_id", "movie_id"], "left")
    return r.select("user_id", "rank", "movie_id", "score", "actual_rating",
                    F.coalesce(F.col("actual_rating") >= threshold, F.lit(False)).cast("int").alias("is_hit"))


def user_hit_rates(hits: DataFrame) -> DataFrame:
    """Mean is_hit per user."""
    return hits.groupBy("user_id").agg(F.avg("is_hit").alias("hit_rate"))


def best_worst_users(hits: DataFrame, train: DataFrame, n: int = 3) -> DataFrame:
    """N3 + N4: top n and bottom n users by hit rate, with train count, train
    mean rating and, for the bottom ones, the failure diagnosis."""
    hr = user_hit_rates(hits)
    st = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train"),
                                      F.avg(F.col("rating").cast("double")).alias("avg_rating"))
    best = hr.orderBy(F.col("hit_rate").desc(), "user_id").limit(n).withColumn("grp", F.lit("best"))
    worst = hr.orderBy(F.col("hit_rate").asc(), F.col("user_id").desc()).limit(n) \
        .withColumn("grp", F.lit("worst"))
    out = best.unionByName(worst).join(st, "user_id", "left") \
        .withColumn("n_train", F.coalesce("n_train", F.lit(0)))
    return out.select("grp", "user_id", "hit_rate", "n_train", "avg_rating",
                      F.when(F.col("grp") == "worst", diagnosis("n_train", "avg_rating")).alias("diagnosis"))


def diagnosis(n_train: str, avg_rating: str):
    """Cold start (<10 train ratings), negative bias (mean < 2.5),
    positive bias (mean > 4.5), else niche taste."""
    return (F.when(F.col(n_train) < 10, "COLD START")
            .when(F.col(avg_rating) < 2.5, "NEGATIVE BIAS")
            .when(F.col(avg_rating) > 4.5, "POSITIVE BIAS")
            .otherwise("NICHE TASTE"))


def most_active(train: DataFrame, n: int = 500) -> DataFrame:
    """N5 users: the n most active in train (count desc, id asc)."""
    return (train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.col("_n").desc(), "user_id").limit(n).select("user_id"))


def catalogue_coverage(recs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Unique recommended items / catalogue size."""
    n = catalogue.select(F.countDistinct("movie_id")).scalar()
    return recs.agg(F.countDistinct("movie_id").alias("n_unique"),
                    F.count(F.lit(1)).alias("n_recs")).select(
        "n_unique", "n_recs", n.alias("n_items"), (F.col("n_unique") / n).alias("coverage"))


def rec_frequency(recs: DataFrame, titles: DataFrame | None = None, n: int = 20) -> DataFrame:
    """The n items recommended most often (count desc, id asc), with titles."""
    f = recs.groupBy("movie_id").agg(F.count(F.lit(1)).alias("times_recommended"))
    top = f.orderBy(F.col("times_recommended").desc(), "movie_id").limit(n)
    if titles is not None:
        top = top.join(titles.select("movie_id", "title"), "movie_id", "left") \
            .withColumn("title", F.coalesce("title", F.lit("?")))
    return top


def frequency_histogram(recs: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of how often items are recommended."""
    f = recs.groupBy("movie_id").agg(F.count(F.lit(1)).alias("times_recommended"))
    return equal_width_histogram(f, "times_recommended", bins)


def popularity_histograms(recs: DataFrame, train: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width histograms of log1p(train count), over catalogue items
    and over recommended items (with repeats), in one table by ``series``."""
    cat, rec = (materialize(x, "log-popularity") for x in _log_popularity(recs, train))
    return equal_width_histogram(cat, "v", bins).withColumn("series", F.lit("catalogue")).unionByName(
        equal_width_histogram(rec, "v", bins).withColumn("series", F.lit("recommended")))


def popularity_rank(train: DataFrame) -> DataFrame:
    """0-based popularity position of each train item (count desc, id asc),
    without a global window: offsets per count value (a small table) plus a
    bucketed position inside each count group."""
    pop = train.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_ratings"))
    groups = pop.groupBy("n_ratings").agg(F.count(F.lit(1)).alias("_g"))
    groups = groups.withColumn("_o", F.coalesce(F.sum("_g").over(
        Window.orderBy(F.col("n_ratings").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = position_within(pop, "n_ratings", "movie_id")
    return inner.join(groups.select("n_ratings", "_o"), "n_ratings").select(
        "movie_id", "n_ratings", (F.col("_o") + F.col("pos")).alias("pop_rank"))


def popularity_bias(recs: DataFrame, train: DataFrame, thresholds=POP_THRESHOLDS) -> DataFrame:
    """% of recommendations (with repeats) among the top-t most rated
    train items, for each t."""
    pr = popularity_rank(train)
    r = recs.select("movie_id").join(pr.select("movie_id", "pop_rank"), "movie_id", "left")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for t in thresholds:
        aggs.append(F.count(F.when(F.col("pop_rank") < t, 1)).alias(f"t{t}"))
    a = r.agg(*aggs)
    stack = ", ".join(f"{t}, t{t}" for t in thresholds)
    return a.select("_n", F.expr(f"stack({len(thresholds)}, {stack}) AS (top_t, n_in_top)")) \
        .select(F.col("top_t").cast("bigint").alias("top_t"), "n_in_top",
                (F.col("n_in_top") / F.col("_n") * 100.0).alias("pct_of_recs"))


def _log_popularity(recs: DataFrame, train: DataFrame) -> tuple[DataFrame, DataFrame]:
    pop = train.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"))
    cat = pop.select(F.log1p(F.col("n").cast("double")).alias("v"))
    rec = recs.select("movie_id").join(pop, "movie_id", "left") \
        .select(F.log1p(F.coalesce("n", F.lit(0)).cast("double")).alias("v"))
    return cat, rec


def popularity_compare(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Median log1p(train count) over catalogue items vs over recommended
    items (with repeats; an item without train ratings counts 0)."""
    cat, rec = (materialize(x, "log-popularity") for x in _log_popularity(recs, train))
    a = exact_quantiles(cat, "v", [0.5]).select("p50").scalar()
    b = exact_quantiles(rec, "v", [0.5]).select("p50").scalar()
    return train.sparkSession.range(1).select(a.alias("median_log_pop_catalogue"),
                                            b.alias("median_log_pop_recs"))


def tier(n: str):
    """N9 right-closed bins (0,20] (20,100] (100,500] (500,99999]."""
    e = TIER_EDGES
    c = F.col(n)
    out = None
    for lo, hi, lab in zip(e[:-1], e[1:], TIER_LABELS):
        cond = (c > lo) & (c <= hi)
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def hit_rate_by_tier(hits: DataFrame, train: DataFrame) -> DataFrame:
    """Mean is_hit per activity tier of the user's train count; tiers
    without rows are absent."""
    act = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train_ratings"))
    h = hits.join(act, "user_id", "left").withColumn("tier", tier("n_train_ratings"))
    return h.where(F.col("tier").isNotNull()).groupBy("tier").agg(
        F.avg("is_hit").alias("hit_rate"), F.count(F.lit(1)).alias("n_recs"))


def residual_stats(preds: DataFrame, truth: DataFrame, by=("model",)) -> DataFrame:
    """Mean, population std, max, min of actual - predicted."""
    j = truth.select("user_id", "movie_id", "rating").join(preds, ["user_id", "movie_id"])
    e = F.col("rating") - F.col("predicted_rating")
    return j.groupBy(*by).agg(F.avg(e).alias("mean_residual"), F.stddev_pop(e).alias("std_residual"),
                              F.max(e).alias("max_residual"), F.min(e).alias("min_residual"))


def mae_by_rating(preds: DataFrame, truth: DataFrame, by=("model",)) -> DataFrame:
    """MAE grouped by the true rating."""
    j = truth.select("user_id", "movie_id", "rating").join(preds, ["user_id", "movie_id"])
    return j.groupBy(*by, "rating").agg(
        F.avg(F.abs(F.col("rating") - F.col("predicted_rating"))).alias("mae"),
        F.count(F.lit(1)).alias("n"))


def pred_sample(preds: DataFrame, truth: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """N (actual, predicted) rows without replacement in seeded-hash
    order (a sampling operator: the limit is the feature)."""
    j = truth.select("user_id", "movie_id", "rating").join(
        preds.select("user_id", "movie_id", "predicted_rating"), ["user_id", "movie_id"])
    return (j.withColumn("_h", portable_hash("user_id", "movie_id", seed))
            .orderBy("_h", "user_id", "movie_id").limit(n).drop("_h"))
