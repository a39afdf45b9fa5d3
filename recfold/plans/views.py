"""Fixture views over the driver's tables (FIXTURES.md part B), Spark side.

The driver tables hold no ratings, so a ratings fact table is derived from
orders x lineitem. Every view here has a twin in ``oracle_views`` written as
SQL text; the two must stay identical in meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a part in which ``ratings`` gathers users: a task sorts them twice in some 50 MB, so that it does not spill.
USER_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """ratings(user_id BIGINT, movie_id BIGINT, rating INT, date DATE).

    One row per (customer, part): the latest shipment wins, larger quantity on
    a tied date. Written as an aggregate (max of a struct) instead of a
    row_number window so the dedup gets a map-side partial aggregate and a hot
    customer never lands whole in one sort. ``by_user`` is for readers that
    gather a user's rows anyway (the per-user split): the rows meet by user
    before the aggregate, which then shuffles nothing and serves the reader's
    window, and the join's tasks hold no second sort. Their number of parts
    follows the rows: parts merged by their compressed size are sorted twice
    in more memory than a task has, and spill all rows.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    if by_user:
        parts = -(-items.count() // USER_ROWS)
        dealt = (parts, "o_custkey") if parts > 1 else ("o_custkey",)
        joined = joined.select("o_custkey", "l_partkey", "l_quantity", "l_shipdate").repartition(*dealt)
    latest = joined.groupBy(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id")
    ).agg(F.max(F.struct(F.col("l_shipdate").cast("date").alias("date"),
                         F.col("l_quantity").alias("q"))).alias("m"))
    return latest.select(
        "user_id", "movie_id",
        F.ceil(F.col("m.q") / 10).cast("int").alias("rating"),
        F.col("m.date").alias("date"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """titles(movie_id, year, title) from part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        (F.lit(1950) + F.col("p_size")).cast("int").alias("year"),
        F.col("p_name").alias("title"),
    )


def _vectors_for(keys: DataFrame, key_expr, spark: SparkSession, sf_dir: str,
                 name: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = emb.select(F.count("*")).scalar()
    keyed = keys.withColumn("vec_id", F.pmod(key_expr, n))
    return keyed.join(emb, "vec_id").select(name, F.col("embedding").alias("emb"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vectors(movie_id, emb ARRAY<FLOAT>) by movie_id % count(embeddings)."""
    movies = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movie_id"))
    return _vectors_for(movies, F.col("movie_id"), spark, sf_dir, "movie_id")


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_vectors(user_id, emb) by (user_id * 7 + 3) % count(embeddings)."""
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return _vectors_for(users, F.col("user_id") * 7 + 3, spark, sf_dir, "user_id")


def interactions_implicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implicit events: (user_id, movie_id, ts); repeats kept."""
    ev = table(spark, sf_dir, "events").select("user_id", "props", "ts")
    return ev.select(
        "user_id",
        F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("bigint").alias("movie_id"),
        "ts",
    ).where(F.col("movie_id").isNotNull())
