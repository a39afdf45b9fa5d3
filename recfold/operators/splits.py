"""Train / validation / test splits.

Every split returns the input rows plus a ``split`` column holding
``train``, ``val`` or ``test``; the three frames are filters of it.

Per-user splits use a window partitioned by user: a user's rows are bounded by
the catalogue size because the fact table is unique per (user, movie), so no
window partition can grow with the data. Global splits never use an
unpartitioned window: they count rows per coarse key (date or hash bucket),
take a running sum over that small table and only rank the rows of the at
most two keys a cut falls into (and inside those, per (key, user)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash, require_columns, validate_ratios

TRAIN, VAL, TEST = "train", "val", "test"
_HASH_BUCKET_SHIFT = 16  # 2^31 hash range -> 32768 buckets


def _user_col(df: DataFrame) -> str:
    return "user_idx" if "user_idx" in df.columns else "user_id"


def _item_col(df: DataFrame, user_col: str) -> str:
    if user_col == "user_idx" and "movie_idx" in df.columns:
        return "movie_idx"
    return "movie_id"


def split_temporal_per_user(df: DataFrame, train_ratio: float = 0.7,
                            val_ratio: float = 0.1, test_ratio: float = 0.2) -> DataFrame:
    """Per user by date, ``train_end = max(1, int(n*tr))``,
    ``val_end = max(train_end+1, int(n*(tr+vr)))`` with the ratios added in
    DOUBLE (0.7 + 0.1 = 0.7999999999999999). Ties on date: movie id."""
    validate_ratios(train_ratio, val_ratio, test_ratio)
    u = _user_col(df)
    require_columns(df, [u, "date"], "ratings")
    i = _item_col(df, u)
    tr = float(train_ratio)
    trv = float(train_ratio) + float(val_ratio)
    by_user = Window.partitionBy(u)
    ordered = by_user.orderBy(F.col("date").asc_nulls_last(), F.col(i))
    n = F.count(F.lit(1)).over(by_user)
    pos = F.row_number().over(ordered) - 1
    te = F.greatest(F.lit(1).cast("bigint"), F.floor(n * F.lit(tr)))
    ve = F.greatest(te + 1, F.floor(n * F.lit(trv)))
    return df.withColumn(
        "split", F.when(pos < te, TRAIN).when(pos < ve, VAL).otherwise(TEST))


def split_random_per_user(df: DataFrame, val_frac: float = 0.1, test_frac: float = 0.1,
                          seed: int = 42) -> DataFrame:
    """Per user in seeded-hash order: first ``max(1,int(n*t))`` rows test,
    next ``max(1,int(n*v))`` val, the rest train."""
    u = _user_col(df)
    i = _item_col(df, u)
    by_user = Window.partitionBy(u)
    h = portable_hash(u, i, seed)
    n = F.count(F.lit(1)).over(by_user)
    pos = F.row_number().over(by_user.orderBy(h, F.col(i))) - 1
    n_test = F.greatest(F.lit(1).cast("bigint"), F.floor(n * F.lit(float(test_frac))))
    n_val = F.greatest(F.lit(1).cast("bigint"), F.floor(n * F.lit(float(val_frac))))
    return df.withColumn(
        "split", F.when(pos < n_test, TEST).when(pos < n_test + n_val, VAL).otherwise(TRAIN))


def _label(pos: Column, te: Column, ve: Column) -> Column:
    return F.when(pos < te, TRAIN).when(pos < ve, VAL).otherwise(TEST)


def _exact_global_cut(df: DataFrame, key: Column, order_cols: list[Column],
                      sub: str, te_frac: float, ve_frac: float) -> DataFrame:
    """Label rows by global position in (key, sub, *order_cols) order with
    cut points floor(n*te_frac) and floor(n*ve_frac), without a global window.
    ``sub`` is the level inside the cut keys, which can be hot (a date holding
    a third of all rows): the user for dates, the hash value for hash buckets."""
    base = df.withColumn("_k", key)
    counts = base.groupBy("_k").agg(F.count(F.lit(1)).alias("_c"))
    # The key table is small by construction (calendar days or 2^15 hash
    # buckets); a running sum over it is the only single-partition step.
    run = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(F.lit(1))
    counts = (counts.withColumn("_s", F.coalesce(F.sum("_c").over(run), F.lit(0)))
              .withColumn("_n", F.sum("_c").over(total)))
    te = F.floor(F.col("_n") * F.lit(te_frac))
    ve = F.floor(F.col("_n") * F.lit(ve_frac))
    end = F.col("_s") + F.col("_c")
    counts = counts.select(
        "_k", "_s",
        F.when(end <= te, TRAIN)
        .when((F.col("_s") >= te) & (end <= ve), VAL)
        .when(F.col("_s") >= ve, TEST).alias("_whole"),
        te.alias("_te"), ve.alias("_ve"))
    rows = base.join(F.broadcast(counts), "_k")
    whole = rows.where(F.col("_whole").isNotNull()).withColumn("split", F.col("_whole"))
    cut = rows.where(F.col("_whole").isNull())
    # Inside the (at most two) keys a cut falls in: offsets per (key, sub),
    # then a row_number inside (key, sub), bounded by the catalogue or by ties.
    per_sub = cut.groupBy("_k", sub).agg(F.count(F.lit(1)).alias("_cu"))
    per_sub = per_sub.withColumn(
        "_su", F.coalesce(F.sum("_cu").over(Window.partitionBy("_k").orderBy(sub)
                                            .rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0)))
    cut = cut.join(per_sub.select("_k", sub, "_su"), ["_k", sub])
    rn = F.row_number().over(Window.partitionBy("_k", sub).orderBy(*order_cols))
    pos = F.col("_s") + F.col("_su") + rn - 1
    cut = cut.withColumn("split", _label(pos, F.col("_te"), F.col("_ve")))
    cols = df.columns + ["split"]
    return whole.select(cols).unionByName(cut.select(cols))


def split_temporal_global(df: DataFrame, val_frac: float = 0.1,
                          test_frac: float = 0.1, seed: int = 42) -> DataFrame:
    """All rows by date (ties: user, movie); cut at ``int(n*(1-v-t))`` and
    ``int(n*(1-t))``. Without a date column, or if every date is null, it
    falls back to W4."""
    if "date" not in df.columns or df.where(F.col("date").isNotNull()).isEmpty():
        return split_random_per_user(df, val_frac, test_frac, seed)
    u = _user_col(df)
    i = _item_col(df, u)
    te_frac = 1.0 - float(val_frac) - float(test_frac)
    ve_frac = 1.0 - float(test_frac)
    key = F.coalesce(F.col("date"), F.lit("9999-12-31").cast("date"))
    return _exact_global_cut(df, key, [F.col(i)], u, te_frac, ve_frac)


def split_random_global(df: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.1,
                        test_ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """Seeded permutation with exact sizes ``int(n*tr)``, ``int(n*(tr+vr))``.
    The permutation is the portable hash order (ties: user, movie). Rows are
    counted in 2^15 hash buckets; in the at most two buckets that a cut falls
    into, rows are counted per hash value and ranked only inside one value."""
    validate_ratios(train_ratio, val_ratio, test_ratio)
    u = _user_col(df)
    i = _item_col(df, u)
    h = portable_hash(u, i, seed)
    bucket = F.shiftright(h, _HASH_BUCKET_SHIFT)
    df2 = df.withColumn("_h", h)
    out = _exact_global_cut(df2, bucket, [F.col(u), F.col(i)], "_h",
                            float(train_ratio), float(train_ratio) + float(val_ratio))
    return out.drop("_h")


def split_summary(split_df: DataFrame) -> DataFrame:
    """Rows, users, movies, mean rating per split; density % per split."""
    u = _user_col(split_df)
    i = _item_col(split_df, u)
    g = split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct(u).alias("n_users"),
        F.countDistinct(i).alias("n_movies"),
        F.avg("rating").alias("mean_rating"))
    return g.withColumn(
        "density_pct",
        F.col("n_ratings") / (F.col("n_users") * F.col("n_movies")) * F.lit(100.0))


def split_integrity(split_df: DataFrame) -> DataFrame:
    """Users whose last train date is after their first test date, and
    (user, movie) pairs present in more than one split. Both must be 0."""
    u = _user_col(split_df)
    i = _item_col(split_df, u)
    per_user = split_df.groupBy(u).agg(
        F.max(F.when(F.col("split") == TRAIN, F.col("date"))).alias("train_max"),
        F.min(F.when(F.col("split") == TEST, F.col("date"))).alias("test_min"))
    late = per_user.agg(F.count(F.when(F.col("train_max") > F.col("test_min"), 1))
                        .alias("n_order_violations"))
    shared = (split_df.groupBy(u, i).agg(F.countDistinct("split").alias("_ns"))
              .agg(F.count(F.when(F.col("_ns") > 1, 1))))
    return late.select(F.col("n_order_violations").cast("bigint").alias("n_order_violations"),
                       shared.scalar().cast("bigint").alias("n_shared_pairs"))
