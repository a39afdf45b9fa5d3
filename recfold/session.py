"""Session helpers: building a local session for tests and finding the
shared checkpoint folder that iterative operators cut lineage into."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Spark deletes the shuffle files of a job when the job ends, not when the driver next collects its garbage.
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recfold") -> SparkSession:
    """Local session used by tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RECFOLD_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it this raises an error, because executors would write to
    different disks. Only a local master, where there is one disk, gets a fresh
    scratch folder when it is unset (tests).
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="recfold-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def materialize(df, label: str = "table"):
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` (the data lives in the shared
    folder the cluster names, so a lost executor does not recompute it) but
    stores columnar files: later reads prune columns and push filters down,
    which the serialized rows of an RDD checkpoint cannot do. The job's shuffle
    files go with the job: nothing reads them again, and trainings would fill
    the executors' disks with those of all their rounds.
    """
    import uuid

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP_KEY, "false")
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        spark.conf.set(_CLEANUP_KEY, before)
    out = spark.read.parquet(path)
    out.scratch_path = path
    return out


def discard(table) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more (rounds of a training). Other frames are
    left alone."""
    path = getattr(table, "scratch_path", None)
    if path is None:
        return
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
