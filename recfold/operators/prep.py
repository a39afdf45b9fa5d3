"""Encoding, filters, semi and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recfold.functions.portable import portable_hash, require_columns
from recfold.session import discard, materialize

#: Bits of an id that one level of the numbering handles; no window of it holds more than 2^16 rows.
_LEVEL_BITS = 16


def dense_ids(df: DataFrame, col: str, shift: int = _LEVEL_BITS) -> DataFrame:
    """P1 map table (orig_id, idx): 0-based index by ascending id.

    The ids are counted in a tree over their leading bits (64-bit ids and 16
    bits a level: ``id >> 48``, ``id >> 32``, ``id >> 16``, ``id``). A node's
    offset is its parent's offset plus a running sum over its siblings, so no
    window holds more than 2^shift rows whether ids are consecutive or hashed
    over the whole range; the only window without a partition key runs over
    the at most 2^16 top nodes. The numbering depends on values alone, not on
    partitioning or task retries.
    """
    ids = (df.select(F.col(col).cast("bigint").alias("orig_id"))
           .where(F.col("orig_id").isNotNull()).distinct())
    levels = [ids.select(F.shiftright("orig_id", shift).alias("_b")).groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))]
    while shift * (len(levels) + 1) < 64:
        up = levels[-1].select(F.shiftright("_b", shift).alias("_b"), "_c")
        levels.append(up.groupBy("_b").agg(F.sum("_c").alias("_c")))
    before = [Window.unboundedPreceding, -1]
    run = F.coalesce(F.sum("_c").over(Window.orderBy("_b").rowsBetween(*before)), F.lit(0))
    offsets = levels[-1].select("_b", run.alias("_o"))
    for level in reversed(levels[:-1]):
        run = F.coalesce(F.sum("_c").over(Window.partitionBy("_p").orderBy("_b").rowsBetween(*before)), F.lit(0))
        nodes = level.withColumn("_p", F.shiftright("_b", shift)).withColumn("_r", run)
        offsets = (nodes.join(offsets.withColumnRenamed("_b", "_p"), "_p")
                   .select("_b", (F.col("_o") + F.col("_r")).alias("_o")))
    within = F.row_number().over(Window.partitionBy("_b").orderBy("orig_id"))
    return (ids.withColumn("_b", F.shiftright("orig_id", shift)).withColumn("_w", within).join(offsets, "_b")
            .select("orig_id", (F.col("_o") + F.col("_w") - 1).cast("bigint").alias("idx")))


def encode(df: DataFrame, user_map: DataFrame | None = None,
           movie_map: DataFrame | None = None) -> DataFrame:
    """Add user_idx / movie_idx by join with the map tables (built from
    ``df`` when not given). Unknown ids map to null."""
    require_columns(df, ["user_id", "movie_id"], "ratings")
    user_map = user_map if user_map is not None else dense_ids(df, "user_id")
    movie_map = movie_map if movie_map is not None else dense_ids(df, "movie_id")
    out = df.join(user_map.select(F.col("orig_id").alias("user_id"),
                                  F.col("idx").alias("user_idx")), "user_id", "left")
    out = out.join(movie_map.select(F.col("orig_id").alias("movie_id"),
                                    F.col("idx").alias("movie_idx")), "movie_id", "left")
    return out.select(*df.columns, "user_idx", "movie_idx")


def decode(df: DataFrame, idx_col: str, id_map: DataFrame, out_col: str) -> DataFrame:
    """Index back to the original id (join on the reverse map)."""
    m = id_map.select(F.col("idx").alias(idx_col), F.col("orig_id").alias(out_col))
    return df.join(m, idx_col, "left")


def compose_maps(first: DataFrame, second: DataFrame) -> DataFrame:
    """Original id -> final index through an intermediate index
    (first: orig_id -> idx; second: idx as orig_id -> idx). Ids dropped in
    between have no row."""
    a = first.select("orig_id", F.col("idx").alias("_mid"))
    b = second.select(F.col("orig_id").alias("_mid"), "idx")
    return a.join(b, "_mid").select("orig_id", "idx")


def reencode_filtered(df: DataFrame, min_user: int,
                      min_movie: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P3 pipeline: encode, k-core filter on the encoded ids, encode again and
    compose original -> final maps. Returns (ratings with final indices,
    user map, movie map)."""
    df = materialize(df, "ratings")  # read by both maps, the encoding and the result
    u1, m1 = dense_ids(df, "user_id"), dense_ids(df, "movie_id")
    enc = encode(df, u1, m1)
    core = k_core(enc.select("user_idx", "movie_idx", "rating", "date")
                  .withColumnRenamed("user_idx", "user_id")
                  .withColumnRenamed("movie_idx", "movie_id"), min_user, min_movie)
    u2, m2 = dense_ids(core, "user_id"), dense_ids(core, "movie_id")
    umap, mmap = compose_maps(u1, u2), compose_maps(m1, m2)
    final = (df.join(umap.select(F.col("orig_id").alias("user_id"), F.col("idx").alias("user_idx")), "user_id")
             .join(mmap.select(F.col("orig_id").alias("movie_id"), F.col("idx").alias("movie_idx")), "movie_id"))
    return final.select(*df.columns, "user_idx", "movie_idx"), umap, mmap


def universe_counts(*frames: DataFrame) -> DataFrame:
    """P5: distinct users and movies over the union of splits, and the
    ``max(id)+1`` sizes the scripts use."""
    ids = None
    for f in frames:
        s = f.select("user_id", "movie_id")
        ids = s if ids is None else ids.unionByName(s)
    return ids.agg(F.countDistinct("user_id").alias("n_users"),
                   F.countDistinct("movie_id").alias("n_movies"),
                   (F.max("user_id") + 1).alias("user_id_bound"),
                   (F.max("movie_id") + 1).alias("movie_id_bound"))


def catalogue(*frames: DataFrame) -> DataFrame:
    """Distinct movie ids of the given splits."""
    out = None
    for f in frames:
        s = f.select("movie_id")
        out = s if out is None else out.unionByName(s)
    return out.distinct()


def k_core(df: DataFrame, min_user: int = 5, min_movie: int = 5) -> DataFrame:
    """repeat (users with >= min_user rows, then movies with >= min_movie
    rows) until nothing is dropped, however many passes that takes. The fixpoint is the unique maximal
    (m, n)-core; rows with a null id are in none. The input and each pass are written as Parquet into the session's
    checkpoint folder, so nothing is computed twice and a lost executor recomputes one pass only. A pass writes the ids
    that it drops and takes them out by anti joins: these ids become few, so that Spark broadcasts them from
    their known size and the ratings are not shuffled."""
    require_columns(df, ["user_id", "movie_id"], "ratings")
    rest = [c for c in df.columns if c not in ("user_id", "movie_id")]
    known = df.where(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull())
    cur = materialize(known.select("movie_id", "user_id", *rest), "kcore")
    while True:
        before, dropped = cur, []
        for key, least in (("user_id", min_user), ("movie_id", min_movie)):
            few = cur.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < least).select(key)
            few = materialize(few, "kcore-few")
            if not few.isEmpty():
                dropped.append(few)
                cur = cur.join(few, key, "left_anti")
        if not dropped:
            return cur
        cur = materialize(cur, "kcore")
        for old in (before, *dropped):
            discard(old)


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """candidates whose (user_id, movie_id) is not in ``seen``."""
    return candidates.join(seen.select("user_id", "movie_id"), ["user_id", "movie_id"], "left_anti")


def relevant(test: DataFrame, threshold: float = 3.5) -> DataFrame:
    """(user_id, movie_id) with rating >= threshold (users with >= 1 only)."""
    return (test.where(F.col("rating") >= F.lit(float(threshold)))
            .select("user_id", "movie_id").distinct())


def sample_users(df: DataFrame, n: int = 500, seed: int = 42, col: str = "user_id") -> DataFrame:
    """n distinct users without replacement in seeded-hash order (all when
    fewer). A sampling operator: the limit is the feature, planned as
    TakeOrderedAndProject (a per-partition top-n, then a merge of n rows each)."""
    users = df.select(col).distinct()
    return (users.withColumn("_h", portable_hash(col, 0, seed))
            .orderBy("_h", col).limit(n).select(col))


def activity_pick(train: DataFrame, n_each: int = 3) -> DataFrame:
    """3 most active users, 3 at the middle position of the id-ordered
    activity table (positions L//2-1 .. L//2+1, as the reference does), and 3
    least active. Output (user_id, grp, n_train_ratings)."""
    act = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train_ratings"))
    top = act.orderBy(F.col("n_train_ratings").desc(), "user_id").limit(n_each) \
        .withColumn("grp", F.lit("high"))
    low = act.orderBy(F.col("n_train_ratings").asc(), "user_id").limit(n_each) \
        .withColumn("grp", F.lit("low"))
    pos = dense_ids(act, "user_id")
    n_users = act.select(F.count(F.lit(1))).scalar()
    half = F.floor(n_users / 2)
    mid = (act.join(pos.select(F.col("orig_id").alias("user_id"), "idx"), "user_id")
           .where((F.col("idx") >= half - 1) & (F.col("idx") <= half + 1))
           .drop("idx").withColumn("grp", F.lit("median")))
    cols = ["user_id", "grp", "n_train_ratings"]
    return top.select(cols).unionByName(mid.select(cols)).unionByName(low.select(cols))


def sampled_sparsity(df: DataFrame, n_users: int = 500, n_movies: int = 500,
                     seed: int = 42) -> DataFrame:
    """sparsity of the sub-matrix of sampled users x sampled movies over the
    rows and columns that keep at least one rating."""
    su = sample_users(df, n_users, seed, "user_id")
    sm = sample_users(df, n_movies, seed, "movie_id")
    sub = df.join(su, "user_id", "left_semi").join(sm, "movie_id", "left_semi")
    g = sub.agg(F.countDistinct("user_id").alias("n_users"),
                F.countDistinct("movie_id").alias("n_movies"),
                F.countDistinct("user_id", "movie_id").alias("n_cells"))
    return g.withColumn("sparsity", F.lit(1.0) - F.col("n_cells") /
                        (F.col("n_users") * F.col("n_movies")))
