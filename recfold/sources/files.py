"""CSV, titles, Parquet, split and id-map readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfold.functions.portable import require_columns


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return sorted(str(s.getPath().toString()) for s in (found or []))


def read_ratings_dir(spark: SparkSession, data_dir: str, lenient: bool = True) -> DataFrame:
    """S3 + S4: every ``combined_data_*.txt`` of a directory in one read; when
    there is none, the pre-merged ``ratings.csv``; else an error."""
    from recfold.sources.blocks import read_blocks
    d = data_dir.rstrip("/")
    if not _exists(spark, d):
        raise FileNotFoundError(f"not a directory: {d}")
    files = _glob(spark, f"{d}/combined_data_*.txt")
    if files:
        return read_blocks(spark, files, lenient=lenient)
    csv = f"{d}/ratings.csv"
    if _exists(spark, csv):
        return read_ratings_csv(spark, csv)
    raise FileNotFoundError(f"No combined_data_*.txt or ratings.csv found in {d}")


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV that must hold user_id, movie_id, rating (date optional)."""
    df = spark.read.option("header", True).csv(path)
    require_columns(df, ["user_id", "movie_id", "rating"], "ratings.csv")
    cols = [F.col("user_id").try_cast("bigint").alias("user_id"),
            F.col("movie_id").try_cast("bigint").alias("movie_id"),
            F.col("rating").try_cast("double").alias("rating")]
    if "date" in df.columns:
        cols.append(F.col("date"))
    return df.select(*cols)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """ISO-8859-1, no header, split on the first two commas only; lines
    with fewer than 3 parts are skipped; year ``NULL`` or empty is null; the
    title is trimmed. Each line is read whole (a separator that never occurs,
    no quoting) so commas and quotes inside titles survive."""
    raw = (spark.read.option("sep", "\u0001").option("quote", "").option("encoding", "ISO-8859-1")
           .schema("v string").csv(path))
    parts = F.split(F.trim(F.col("v")), ",", 3)
    df = raw.where(F.length(F.trim("v")) > 0).select(parts.alias("p")).where(F.size("p") >= 3)
    year = F.trim(F.col("p")[1])
    return df.select(
        F.trim(F.col("p")[0]).try_cast("bigint").alias("movie_id"),
        F.when((year == "") | (year == "NULL"), F.lit(None)).otherwise(year.try_cast("int"))
        .cast("int").alias("year"),
        F.trim(F.col("p")[2]).alias("title"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet ratings or splits; a missing path raises."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"Parquet path not found: {path}")
    return spark.read.parquet(path)


SPLIT_SCHEMA = "user_id BIGINT, movie_id BIGINT, rating DOUBLE, date STRING"


def read_split(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One split by name, Parquet first (``<name>.parquet`` or a
    ``split=<name>`` partition), then ``<name>.csv``."""
    root = root.rstrip("/")
    for p in (f"{root}/{name}.parquet", f"{root}/split={name}"):
        if _exists(spark, p):
            return spark.read.parquet(p)
    csv = f"{root}/{name}.csv"
    if _exists(spark, csv):
        return spark.read.option("header", True).schema(SPLIT_SCHEMA).csv(csv)
    raise FileNotFoundError(f"split {name} not found under {root}")


ID_MAP_SCHEMA = ("user2idx MAP<STRING, BIGINT>, movie2idx MAP<STRING, BIGINT>, "
                 "n_users BIGINT, n_movies BIGINT")


def read_id_maps(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Id maps to two tables (orig_id, idx) with integer keys restored
    (the reverse map is the same table joined on idx). Reads the JSON Lines
    written by ``write_id_maps_json`` in parallel."""
    lines = spark.read.schema("map STRING, key STRING, idx BIGINT").json(path)

    def one(name: str) -> DataFrame:
        return lines.where(F.col("map") == name).select(
            F.col("key").try_cast("bigint").alias("orig_id"), "idx")
    return one("user2idx"), one("movie2idx")


def read_id_maps_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S8, the reference's single-document ``id_mappings.json``
    ({"user2idx": {"<id>": idx}, "movie2idx": {...}, "n_users", "n_movies"}).
    A JSON document is not splittable, so this is for importing existing
    files; ``write_id_maps_json`` writes the parallel form."""
    doc = spark.read.option("multiLine", True).schema(ID_MAP_SCHEMA).json(path)

    def explode(col: str) -> DataFrame:
        e = doc.select(F.explode(col).alias("k", "idx"))
        return e.select(F.col("k").try_cast("bigint").alias("orig_id"), "idx")
    return explode("user2idx"), explode("movie2idx")


def read_id_map_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S8 (Parquet form written by ``write_splits``): (orig_id, idx)."""
    return spark.read.parquet(path)
