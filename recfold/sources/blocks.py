"""Block-format ratings reader.

A file is a sequence of blocks: a line ``<movie_id>:`` opens a block and the
following ``user_id,rating,date`` lines belong to it. Files are read in
parallel splits; each line knows its file, the byte offset of its split and a
monotonically increasing id (increasing within a split), which together give
file order without a global sort. The header is forward-filled in two levels:
inside a split by a window over that split's lines (bounded by the split
size), and across splits by a carry-in computed on the tiny one-row-per-split
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RATINGS_SCHEMA = "user_id BIGINT, movie_id BIGINT, rating INT, date DATE"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = path if isinstance(path, list) else [path]
    df = spark.read.text(paths).select(
        F.trim(F.col("value")).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"))
    return df.where(F.length("line") > 0)


def read_blocks(spark: SparkSession, path: str | list[str], lenient: bool = False) -> DataFrame:
    """S1 (strict) / S2 (lenient) / S3 (glob or list of files).

    strict: rows need exactly 3 fields; rating INT; date parsed yyyy-MM-dd;
    rows before the first header of a file get movie id -1 (per file).
    lenient: the movie id carries across files in sorted path order (null
    before the first header); rating DOUBLE; 2 or more fields (date optional,
    kept as a string); rows with fewer than 2 fields are skipped.
    """
    lines = _lines(spark, path)
    is_header = F.col("line").endswith(":")
    lines = lines.withColumn(
        "hdr", F.when(is_header, F.expr("try_cast(substring(line, 1, length(line) - 1) AS BIGINT)")))
    # last header inside each split, then carried across the splits of a file
    # (one row per split) and, if lenient, across files in path order (one row
    # per file)
    per_block = (lines.where(F.col("hdr").isNotNull())
                 .groupBy("file", "block").agg(F.max_by("hdr", "pos").alias("last_hdr")))
    blocks = lines.select("file", "block").distinct().join(per_block, ["file", "block"], "left")
    before = [Window.unboundedPreceding, -1]
    blocks = blocks.withColumn("carry", F.last("last_hdr", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(*before)))
    if lenient:
        files = blocks.groupBy("file").agg(F.max_by("last_hdr", F.when(F.col("last_hdr").isNotNull(), F.col("block"))).alias("h"))
        files = files.select("file", F.last("h", ignorenulls=True).over(
            Window.orderBy("file").rowsBetween(*before)).alias("from_files"))
        blocks = blocks.join(files, "file").withColumn("carry", F.coalesce("carry", "from_files"))
    inside = F.last("hdr", ignorenulls=True).over(
        Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    rows = lines.withColumn("movie", inside).where(~is_header)
    rows = rows.join(blocks.select("file", "block", "carry"), ["file", "block"])
    fallback = F.lit(None).cast("bigint") if lenient else F.lit(-1).cast("bigint")
    movie = F.coalesce(F.col("movie"), F.col("carry"), fallback)
    parts = F.split("line", ",")
    n = F.size(parts)
    if lenient:
        return rows.where(n >= 2).select(
            F.expr("try_cast(trim(split(line, ',')[0]) AS BIGINT)").alias("user_id"),
            movie.alias("movie_id"),
            F.expr("try_cast(trim(split(line, ',')[1]) AS DOUBLE)").alias("rating"),
            F.when(n > 2, F.trim(parts[2])).alias("date"))
    return rows.where(n == 3).select(
        F.expr("try_cast(trim(split(line, ',')[0]) AS BIGINT)").alias("user_id"),
        movie.alias("movie_id"),
        F.expr("try_cast(trim(split(line, ',')[1]) AS INT)").alias("rating"),
        F.to_date(F.trim(parts[2]), "yyyy-MM-dd").alias("date"))


def write_blocks(ratings: DataFrame, path: str) -> None:
    """Write ratings in the block format (one block per movie, rows by user),
    spread over the shuffle partitions by movie id. Used to feed the block
    reader from Spark-derived data."""
    r = ratings.select("user_id", "movie_id", "rating", "date")
    heads = r.select("movie_id").distinct().select(
        "movie_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("user_id"),
        F.concat(F.col("movie_id").cast("string"), F.lit(":")).alias("value"))
    body = r.select("movie_id", F.lit(1).alias("kind"), "user_id",
                    F.concat_ws(",", F.col("user_id").cast("string"), F.col("rating").cast("string"),
                                F.date_format("date", "yyyy-MM-dd")).alias("value"))
    lines = heads.unionByName(body)
    (lines.repartition("movie_id")
     .sortWithinPartitions("movie_id", "kind", "user_id")
     .select("value").write.mode("overwrite").text(path))
