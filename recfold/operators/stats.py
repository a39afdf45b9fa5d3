"""Aggregations and statistics.

Quantiles are exact order statistics of columns with any number of distinct
values: each round narrows the range around a wanted rank by an approximate
quantile and counts what lies below it, so neither a sort, nor a window, nor a
buffer of the column is needed. Curves over users (Lorenz, top-share) are
computed on the table of equal counts, which is bounded by the largest count.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import require_columns
from recfold.session import materialize


def entity_stats(df: DataFrame, col: str = "user_id") -> DataFrame:
    """A1/A2: count, mean and sample std of rating per entity (std null for n=1)."""
    require_columns(df, [col, "rating"], "ratings")
    return df.groupBy(col).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg(F.col("rating").cast("double")).alias("avg_rating"),
        F.stddev_samp(F.col("rating").cast("double")).alias("std_rating"))


def sparsity(df: DataFrame) -> DataFrame:
    """A3: 1 - rows / (distinct users * distinct movies) (rows, not pairs)."""
    return df.agg(F.count(F.lit(1)).alias("n_ratings"),
                  F.countDistinct("user_id").alias("n_users"),
                  F.countDistinct("movie_id").alias("n_movies")) \
        .withColumn("sparsity", F.lit(1.0) - F.col("n_ratings") /
                    (F.col("n_users") * F.col("n_movies")))


def rating_distribution(df: DataFrame) -> DataFrame:
    """A4: count and percent per rating value."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy("rating").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("pct", F.col("n") / total * 100.0)


#: Accuracy of the approximate quantiles that narrow a range (rank error 1 / accuracy of its rows).
ACCURACY = 2000


def order_statistics(df: DataFrame, col: str, ranks: Callable[[int], list[int]]) -> tuple[int, dict[int, float]]:
    """The number of non-null values of a numeric column, and its values (as
    DOUBLE) at 0-based ascending ranks; ``ranks`` gives them for a count.

    Every open rank keeps an open interval of values and the number of rows up
    to its lower end. A round takes two values near the rank by
    ``percentile_approx`` inside each interval (one aggregate), then counts the
    rows below, up to, before and through both (one aggregate): the rank is
    settled on one of them or the interval shrinks to what lies between, about
    2 / 1000 of its rows. Only these numbers reach the driver. NaN counts as
    the largest value.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    v = F.col("v")
    n = values.count()
    done: dict[int, float] = {}
    # rank: (value below the interval, value above it, rows up to the interval, rows inside)
    pending = {r: (None, None, 0, n) for r in sorted(set(ranks(n)))} if n else {}
    while pending:
        near = []
        for above, below, start, m in dict.fromkeys(pending.values()):
            inside = (v > F.lit(above) if above is not None else F.lit(True)) & (v < F.lit(below) if below is not None else F.lit(True))
            shares = []
            for r in (r for r, cell in pending.items() if cell == (above, below, start, m)):
                at = (r - start) / max(m - 1, 1)
                shares += [max(at - 2 / ACCURACY, 0.0), min(at + 2 / ACCURACY, 1.0)]
            near.append(F.percentile_approx(F.when(inside, v), shares, ACCURACY))
        guesses = values.agg(*near).first()
        marks = sorted({x for g in guesses for x in g}, key=lambda x: (math.isnan(x), x))
        counts = values.agg(*[F.count(F.when(c, 1)) for x in marks for c in (v < F.lit(x), v <= F.lit(x))]).first()
        left = {}
        for r, (above, below, start, m) in pending.items():
            end = start + m
            for x, lower, upto in zip(marks, counts[0::2], counts[1::2]):
                if lower <= r < upto:
                    done[r] = x
                    break
                if start < upto <= r:
                    above, start = x, upto
                if r < lower < end:
                    below, end = x, lower
            else:
                left[r] = (above, below, start, end - start)
        pending = left
    return n, done


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Linear-interpolation quantiles (numpy default): one row (p<percent> ...), nulls without values."""
    def ends(p, n):
        pos = float(p) * (n - 1)
        return math.floor(pos), math.ceil(pos), pos - math.floor(pos)

    n, at = order_statistics(df, col, lambda n: [r for p in probs for r in ends(p, n)[:2]])
    cols = []
    for p in probs:
        x = None
        if n:
            lo, hi, part = ends(p, n)
            x = at[lo] + (at[hi] - at[lo]) * part if at[lo] != at[hi] else at[lo]
        cols.append(F.lit(x).cast("double").alias(_qname(p)))
    return df.sparkSession.range(1).select(*cols)


def _qname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


def describe(df: DataFrame, col: str) -> DataFrame:
    """A5: count, mean, sample std, min, quartiles, max of one column."""
    base = df.agg(F.count(F.col(col)).alias("count"),
                  F.avg(F.col(col).cast("double")).alias("mean"),
                  F.stddev_samp(F.col(col).cast("double")).alias("std"),
                  F.min(F.col(col).cast("double")).alias("min"),
                  F.max(F.col(col).cast("double")).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    return base.select("count", "mean", "std", "min",
                       q.select("p25").scalar().alias("p25"),
                       q.select("p50").scalar().alias("p50"),
                       q.select("p75").scalar().alias("p75"), "max")


def activity(df: DataFrame, col: str = "user_id") -> DataFrame:
    """Ratings per entity: (col, n)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def activity_percentiles(df: DataFrame, col: str = "user_id",
                         probs=(0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """p50, p75, p90, p95, p99 of ratings per entity."""
    return exact_quantiles(materialize(activity(df, col), "activity"), "n", list(probs))


def log_histogram(df: DataFrame, col: str = "user_id", n_edges: int = 60) -> DataFrame:
    """Counts per entity in bins with edges logspace(0, log10(max+1), n_edges)
    (n_edges - 1 bins, last one right-closed); non-empty bins plus the median."""
    act = activity(df, col)
    mx = act.select(F.max("n")).scalar()
    nb = n_edges - 1
    step = F.log10(mx + F.lit(1.0)) / F.lit(float(nb))
    b = F.least(F.floor(F.log10(F.col("n").cast("double")) / step), F.lit(nb - 1)).cast("bigint")
    act = materialize(act, "activity")
    med = exact_quantiles(act, "n", [0.5]).select("p50").scalar()
    out = act.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_entities"))
    return out.select("bin", F.pow(F.lit(10.0), F.col("bin") * step).alias("bin_lo"),
                      F.pow(F.lit(10.0), (F.col("bin") + 1) * step).alias("bin_hi"),
                      "n_entities", med.alias("median"))


def equal_width_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins over [min, max] (last bin right-closed);
    bin = floor((x - min) * bins / (max - min)). Non-empty bins only."""
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi - lo)
    raw = F.when(width == 0, F.lit(0)).otherwise(F.floor((x - lo) * F.lit(float(bins)) / width))
    b = F.least(raw, F.lit(bins - 1)).cast("bigint")
    out = df.where(x.isNotNull()).select(b.alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"))
    return out.select("bin", (lo + width * F.col("bin") / F.lit(float(bins))).alias("bin_lo"),
                      (lo + width * (F.col("bin") + 1) / F.lit(float(bins))).alias("bin_hi"), "n")


def count_groups(df: DataFrame, col: str = "user_id") -> DataFrame:
    """Entities grouped by equal rating count, with running totals in
    descending count order: (n, n_entities, ent_before, ratings_before)."""
    g = activity(df, col).groupBy("n").agg(F.count(F.lit(1)).alias("n_entities"))
    run = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (g.withColumn("ent_before", F.coalesce(F.sum("n_entities").over(run), F.lit(0)))
            .withColumn("ratings_before",
                        F.coalesce(F.sum(F.col("n") * F.col("n_entities")).over(run), F.lit(0))))


def lorenz_curve(df: DataFrame, col: str = "user_id") -> DataFrame:
    """A9 curve, one point per count group: cumulative % of entities vs %
    of ratings after the group (counts descending)."""
    g = count_groups(df, col)
    tot = Window.partitionBy(F.lit(1))
    n_ent = F.sum("n_entities").over(tot)
    n_rat = F.sum(F.col("n") * F.col("n_entities")).over(tot)
    return g.select("n", "n_entities",
                    ((F.col("ent_before") + F.col("n_entities")) / n_ent * 100.0).alias("entity_pct"),
                    ((F.col("ratings_before") + F.col("n") * F.col("n_entities")) / n_rat * 100.0)
                    .alias("rating_pct"))


def lorenz_cut(df: DataFrame, col: str = "user_id", share_pct: float = 80.0) -> DataFrame:
    """A9 cut: smallest top-x% of entities (by count) holding >= share_pct % of
    ratings; the first position i with cumsum_i * 100 >= share_pct * total,
    found inside the crossing count group by integer arithmetic."""
    g = count_groups(df, col)
    tot = Window.partitionBy(F.lit(1))
    g = (g.withColumn("_N", F.sum("n_entities").over(tot))
         .withColumn("_T", F.sum(F.col("n") * F.col("n_entities")).over(tot)))
    need = F.lit(float(share_pct)) * F.col("_T") / 100.0
    end = F.col("ratings_before") + F.col("n") * F.col("n_entities")
    cross = g.where((end >= need) & (F.col("ratings_before") < need))
    # j = first 0-based index in the group with ratings_before + (j+1)*n >= need
    j = F.greatest(F.ceil((need - F.col("ratings_before")) / F.col("n")) - 1, F.lit(0))
    pos = F.col("ent_before") + j
    return cross.select(pos.cast("bigint").alias("position"),
                        ((pos + 1) / F.col("_N") * 100.0).alias("top_entity_pct"))


def top_share(df: DataFrame, col: str, n_top: Column | int) -> Column:
    """Share of ratings held by the ``n_top`` most active entities (ties
    between equal counts do not change the sum)."""
    g = count_groups(df, col)
    k = F.lit(n_top) if isinstance(n_top, int) else n_top
    take = F.least(F.greatest(k - F.col("ent_before"), F.lit(0)), F.col("n_entities"))
    s = g.agg((F.sum(take * F.col("n")) / F.sum(F.col("n") * F.col("n_entities"))).alias("s"))
    return s.scalar()


def top_movies(df: DataFrame, titles: DataFrame | None = None, n: int = 20) -> DataFrame:
    """A10: n most rated movies (count desc, id asc) with mean and title; title
    falls back to 'Movie <id>' without a titles table."""
    g = df.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_ratings"),
                                    F.avg(F.col("rating").cast("double")).alias("avg_rating"))
    top = g.orderBy(F.col("n_ratings").desc(), "movie_id").limit(n)
    if titles is None:
        return top.withColumn("title", F.concat(F.lit("Movie "), F.col("movie_id").cast("string")))
    return top.join(titles.select("movie_id", "title"), "movie_id", "left") \
        .withColumn("title", F.coalesce("title", F.concat(F.lit("Movie "), F.col("movie_id").cast("string"))))


def monthly(df: DataFrame) -> DataFrame:
    """Ratings and mean rating per calendar month (months with rows only)."""
    return df.where(F.col("date").isNotNull()).groupBy(F.trunc("date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg(F.col("rating").cast("double")).alias("avg_rating"))


def monthly_filled(df: DataFrame) -> DataFrame:
    """Month-end labels from the first to the last month, 0 for empty
    months. The month calendar is generated from min/max (bounded by the date
    range, not by the data volume)."""
    m = monthly(df)
    rng = df.agg(F.trunc(F.min("date"), "month").alias("a"), F.trunc(F.max("date"), "month").alias("b"))
    cal = rng.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return cal.join(m, "month", "left").select(
        F.last_day("month").alias("month_end"),
        F.coalesce(F.col("n_ratings"), F.lit(0)).alias("n_ratings"))


def degree_summary(matrix: DataFrame) -> DataFrame:
    """User and item degree as row / column sums of the interaction
    matrix (user_id, movie_id, value); count, mean and max of positive degrees."""
    out = None
    for side, col in (("user", "user_id"), ("item", "movie_id")):
        d = matrix.groupBy(col).agg(F.sum("value").alias("deg")).where(F.col("deg") > 0)
        s = d.agg(F.count(F.lit(1)).alias("n_nodes"), F.avg(F.col("deg").cast("double")).alias("mean_degree"),
                  F.max(F.col("deg").cast("double")).alias("max_degree")).withColumn("side", F.lit(side))
        out = s if out is None else out.unionByName(s)
    return out.select("side", "n_nodes", "mean_degree", "max_degree")


def key_figures(df: DataFrame, top_user_frac: float = 0.1, top_movies_n: int = 100) -> DataFrame:
    """Counts, sparsity, mean, sample std, share of ratings of the
    top 10% users (int(n_users * 0.1) of them) and of the 100 most rated movies."""
    base = df.agg(F.count(F.lit(1)).alias("n_ratings"),
                  F.avg(F.col("rating").cast("double")).alias("rating_mean"),
                  F.stddev_samp(F.col("rating").cast("double")).alias("rating_std"))
    # the activity tables, which the shares read too, hold the distinct ids
    n_users, n_movies = (activity(df, c).select(F.count(c)).scalar() for c in ("user_id", "movie_id"))
    base = base.withColumn("n_users", n_users).withColumn("n_movies", n_movies)
    k_users = F.floor(n_users * F.lit(float(top_user_frac)))
    return base.select(
        "n_ratings", "n_users", "n_movies",
        (F.lit(1.0) - F.col("n_ratings") / (F.col("n_users") * F.col("n_movies"))).alias("sparsity"),
        "rating_mean", "rating_std",
        top_share(df, "user_id", k_users).alias("top_user_share"),
        top_share(df, "movie_id", top_movies_n).alias("top_movie_share"))
