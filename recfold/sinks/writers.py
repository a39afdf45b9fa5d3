"""Writers. All write directories of part files from the
executors; only small result tables (metric rows, one-row reports) are
coalesced into a single file."""

from __future__ import annotations

from pyspark.sql import DataFrame
import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _fixed6(x: pd.Series) -> pd.Series:
    values = x.to_numpy(dtype=np.float64, na_value=np.nan)
    text = pd.Series(np.char.mod("%.6f", values).astype(object))
    return text.mask(np.isnan(values), None)


def fixed6(c):
    """'%.6f' text of a DOUBLE rounded from its exact binary value, as the
    reference's Python formatting does. Spark's ``format_string`` rounds the
    shortest decimal form instead (3.4548625 -> 3.454863, where the binary
    value is just below the half), so this one formatting step runs in an
    Arrow-batched pandas UDF."""
    return _fixed6(c)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """K1: processed ratings as Parquet (a directory; parents are created)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_splits(split_df: DataFrame, root: str, user_map: DataFrame | None = None,
                 movie_map: DataFrame | None = None, mode: str = "overwrite") -> None:
    """K2: the split table partitioned by ``split`` (train/val/test
    directories) and the id maps as Parquet tables."""
    root = root.rstrip("/")
    split_df.write.mode(mode).partitionBy("split").parquet(f"{root}/splits")
    if user_map is not None:
        user_map.write.mode(mode).parquet(f"{root}/user_map")
    if movie_map is not None:
        movie_map.write.mode(mode).parquet(f"{root}/movie_map")


def write_id_maps_json(user_map: DataFrame, movie_map: DataFrame, path: str) -> None:
    """K2 JSON form, re-aimed for scale: JSON Lines written by every task,
    one line per entry ``{"map": "user2idx", "key": "<id>", "idx": n}`` (string
    keys as the reference writes them). The reference's single document would
    put every id of both maps into one row and one task; the counts
    ``n_users`` / ``n_movies`` are the line counts per map."""
    u = user_map.select(F.lit("user2idx").alias("map"), F.col("orig_id").cast("string").alias("key"), "idx")
    m = movie_map.select(F.lit("movie2idx").alias("map"), F.col("orig_id").cast("string").alias("key"), "idx")
    u.unionByName(m).write.mode("overwrite").json(path)


def write_splits_csv(split_df: DataFrame, root: str, user_map: DataFrame | None = None,
                     movie_map: DataFrame | None = None) -> DataFrame:
    """K3: train/val/test CSV with header, ``user_mapping.csv``
    (original_user_id, encoded_user_id), ``movie_mapping.csv`` and a one-row
    stats JSON (rows per split, users, movies). Returns the stats frame."""
    root = root.rstrip("/")
    cols = ["user_id", "movie_id", "rating", "date"]
    for name in ("train", "val", "test"):
        (split_df.where(F.col("split") == name).select(*cols)
         .write.mode("overwrite").option("header", True).csv(f"{root}/{name}.csv"))
    if user_map is not None:
        (user_map.select(F.col("orig_id").alias("original_user_id"), F.col("idx").alias("encoded_user_id"))
         .write.mode("overwrite").option("header", True).csv(f"{root}/user_mapping.csv"))
    if movie_map is not None:
        (movie_map.select(F.col("orig_id").alias("original_movie_id"), F.col("idx").alias("encoded_movie_id"))
         .write.mode("overwrite").option("header", True).csv(f"{root}/movie_mapping.csv"))
    stats = split_df.agg(
        F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
        F.count(F.when(F.col("split") == "val", 1)).alias("n_val"),
        F.count(F.when(F.col("split") == "test", 1)).alias("n_test"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("movie_id").alias("n_movies"))
    stats.coalesce(1).write.mode("overwrite").json(f"{root}/stats.json")
    return stats


def format_recs(recs: DataFrame) -> DataFrame:
    """K4 rows: user_id, rank, movie_id, score with 6 decimals."""
    return recs.select("user_id", "rank", "movie_id",
                       fixed6(F.col("score")).alias("score"))


def write_recs(recs: DataFrame, path: str) -> None:
    """K4: CSV ``user_id,rank,movie_id,score``; users ascending, rank from 1
    (a range-partitioned sort, so part files are in order)."""
    (format_recs(recs).orderBy("user_id", "rank")
     .write.mode("overwrite").option("header", True).csv(path))


def export_with_titles(recs: DataFrame, titles: DataFrame) -> DataFrame:
    """K5 rows: user_id, rank, movie_id, predicted_score (6 decimals), title."""
    t = titles.select("movie_id", "title")
    return recs.join(t, "movie_id", "left").select(
        "user_id", "rank", "movie_id", fixed6(F.col("score")).alias("predicted_score"),
        F.coalesce(F.col("title"), F.lit("Unknown")).alias("title"))


def write_export(recs: DataFrame, titles: DataFrame, path: str) -> None:
    """K5: the export as quoted CSV (titles hold commas)."""
    (export_with_titles(recs, titles).orderBy("user_id", "rank")
     .write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path))


def write_results(results_long: DataFrame, path: str, fmt: str = "json") -> None:
    """K6 / K7: metric results or a report as JSON (or CSV for tables)."""
    w = results_long.coalesce(1).write.mode("overwrite")
    if fmt == "json":
        w.json(path)
    else:
        w.option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """K8: a table model (``RatingModel``) as Parquet tables plus one params
    row; an MLlib model through its own writer."""
    if hasattr(model, "write") and not hasattr(model, "items"):
        model.write().overwrite().save(path)
        return
    root = path.rstrip("/")
    spark = (model.items if model.items is not None else model.users).sparkSession
    if model.items is not None:
        model.items.write.mode("overwrite").parquet(f"{root}/items")
    if model.users is not None:
        model.users.write.mode("overwrite").parquet(f"{root}/users")
    mu = model.mu.first()[0] if model.mu is not None else None
    ufill = model.u_fill.first()[0] if model.u_fill is not None else None
    ifill = model.i_fill.first()[0] if model.i_fill is not None else None
    spark.createDataFrame(
        [(model.name, model.rank, mu, ufill, ifill, model.lo, model.hi, model.digits)],
        "name string, rank int, mu double, u_fill double, i_fill double, lo double, hi double, digits int",
    ).coalesce(1).write.mode("overwrite").parquet(f"{root}/params")


def load_model(spark, path: str):
    """K8 load for table models saved by ``save_model``."""
    from recfold.operators.models import RatingModel
    from recfold.sources.files import _exists
    root = path.rstrip("/")
    p = spark.read.parquet(f"{root}/params").first()
    items = spark.read.parquet(f"{root}/items") if _exists(spark, f"{root}/items") else None
    users = spark.read.parquet(f"{root}/users") if _exists(spark, f"{root}/users") else None

    def one(v):
        return None if v is None else spark.createDataFrame([(float(v),)], "v double")
    return RatingModel(p["name"], users, items, mu=one(p["mu"]), u_fill=one(p["u_fill"]),
                       i_fill=one(p["i_fill"]), rank=p["rank"], lo=p["lo"], hi=p["hi"], digits=p["digits"])


def save_neural(path: str, users, items, weights: dict, dim: int, lo: float | None = 1.0, hi: float | None = 5.0,
                bn: dict | None = None) -> None:
    """K8 for the neural model: embedding tables, dense weights (one row per
    array, with its shape) and a config row."""
    root, spark = path.rstrip("/"), users.sparkSession
    users.write.mode("overwrite").parquet(f"{root}/users")
    items.write.mode("overwrite").parquet(f"{root}/items")
    arrays = [("w", k, v) for k, v in weights.items()] + [("bn", k, v) for k, v in (bn or {}).items()]
    rows = [(kind, k, list(v.shape), [float(x) for x in v.ravel()]) for kind, k, v in arrays]
    spark.createDataFrame(rows, "kind string, name string, shape array<int>, vals array<double>") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/weights")
    spark.createDataFrame([(dim, lo, hi)], "dim int, lo double, hi double") \
        .coalesce(1).write.mode("overwrite").parquet(f"{root}/config")


def load_neural(spark, path: str) -> dict:
    """Keyword arguments of ``neumf.score`` (all but the pairs)."""
    import numpy as np

    root = path.rstrip("/")
    c = spark.read.parquet(f"{root}/config").first()
    parts: dict[str, dict] = {"w": {}, "bn": {}}
    for r in spark.read.parquet(f"{root}/weights").collect():
        parts[r["kind"]][r["name"]] = np.array(r["vals"]).reshape(r["shape"])
    return {"users": spark.read.parquet(f"{root}/users"), "items": spark.read.parquet(f"{root}/items"), "weights": parts["w"],
            "dim": c["dim"], "lo": c["lo"], "hi": c["hi"], "bn": parts["bn"] or None}
