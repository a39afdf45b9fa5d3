"""Steps that many queries share: how rows are gathered."""

import datetime as dt

from pyspark.sql import functions as F

from recfold.operators import prep as P
from recfold.operators.splits import split_temporal_per_user
from recfold.plans import views as V


def _tables(spark, tmp_dir):
    day = dt.date(1995, 1, 1)
    orders = [(o, o % 5) for o in range(40)] + [(None, 1), (40, None)]
    items = [(o, (o * 7 + i) % 11, float(1 + (o + i) % 50), day + dt.timedelta(days=(o * 3 + i) % 17)) for o in range(41) for i in range(4)]
    items += items[:9] + [(None, 1, 2.0, day), (3, None, 2.0, day), (3, 4, None, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate date").write.parquet(f"{tmp_dir}/lineitem.parquet")


def test_the_split_gathers_the_rows_of_a_user_once(spark, tmp_dir):
    _tables(spark, tmp_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = split_temporal_per_user(V.ratings(spark, tmp_dir, by_user=True), 0.7, 0.1, 0.2)
        plan = split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(o_custkey") + plan.count("Exchange hashpartitioning(user_id") == 1
    assert plan.count("Exchange ") == 3  # orders and items by order, rows by user


def test_both_forms_of_the_ratings_are_equal(spark, tmp_dir):
    _tables(spark, tmp_dir)
    a, b = V.ratings(spark, tmp_dir), V.ratings(spark, tmp_dir, by_user=True)
    assert a.columns == b.columns and a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert b.where(F.col("user_id").isNull()).count() > 0


def test_the_parts_in_which_users_gather_follow_the_rows(spark, tmp_dir, monkeypatch):
    _tables(spark, tmp_dir)
    items = spark.read.parquet(f"{tmp_dir}/lineitem.parquet").count()
    monkeypatch.setattr(V, "USER_ROWS", -(-items // 5), raising=False)
    split = split_temporal_per_user(V.ratings(spark, tmp_dir, by_user=True), 0.7, 0.1, 0.2)
    assert split.rdd.getNumPartitions() == 5  # parts are not merged again by their size
    parts = split.select("user_id", F.spark_partition_id().alias("part")).distinct()
    assert parts.count() == split.select("user_id").distinct().count()


def test_core_reads_its_input_once_and_leaves_out_null_ids(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [(u, m, 3) for u in range(6) for m in range(5)] + [(9, 0, 1), (0, 9, 1)] + [(None, m, 2) for m in range(5)] + [(7, None, 2)] * 5
    df = spark.createDataFrame(rows, "user_id bigint, movie_id bigint, rating int").mapInArrow(count, "user_id bigint, movie_id bigint, rating int")
    core = P.k_core(df, 5, 5)
    assert read.value == len(rows)
    assert core.columns == ["movie_id", "user_id", "rating"]
    assert sorted((r["user_id"], r["movie_id"]) for r in core.collect()) == [(u, m) for u in range(6) for m in range(5)]
