"""Session construction and lineage cutting.

The library never creates a session behind the caller's back: operators take
DataFrames.  ``build_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on.  Time zone: hour/day/date of a
# TIMESTAMP column are evaluated in the session zone, so it is pinned to UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Accept Parquet TIMESTAMP(NANOS) as a long column (converted in sources.raw).
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "feescope",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's base settings.

    ``shuffle_partitions`` defaults to the local core count for local runs; on a
    cluster pass a value sized to the data (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    On a cluster the folder must be shared storage named in
    ``spark.checkpoint.dir``; only a local-mode session without one (tests,
    the bench) gets a folder below its own warehouse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for reliable checkpoints"
            )
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


_SCRATCH: dict[str, list[str]] = {}


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder through the store's own file system."""
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store holds the path."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for intermediate tables.

    It goes with :func:`release_scratch`, or at the latest when the driver's
    JVM closes its file systems.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch folders that are there now."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, keep=()) -> None:
    """Delete the scratch folders made so far (all but ``keep``).

    Call it once the results that read them are written.
    """
    app = spark.sparkContext.applicationId
    for path in _SCRATCH.get(app, []):
        if path not in keep:
            fs, p = _hadoop(spark, path)
            fs.delete(p, True)
    _SCRATCH[app] = [p for p in _SCRATCH.get(app, []) if p in keep]


def materialize(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Cut lineage with a table written under the shared checkpoint folder.

    Used for small, reused intermediates (rollups, quantiles, model results):
    the plan runs once, the result survives executor loss, and later jobs
    read a few files instead of re-scanning the fact table.  (An eager
    ``DataFrame.checkpoint`` would run the plan twice: once for its count
    and once more to write the checkpoint files.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:  # later filters on it become partition pruning
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # the schema is known: no footer inference (partition column last, as Spark reads it back)
    schema = df.schema
    if partition_by:
        schema = df.select(*[c for c in df.columns if c != partition_by], partition_by).schema
    return spark.read.schema(schema).parquet(path)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path`` (Hadoop FileSystem summary, no scan)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hadoop_path).getLength())


def size_for_input(spark: SparkSession, nbytes: int, per_partition: int = 256 << 20) -> int:
    """Size shuffles for a job that reads ``nbytes``: one partition per
    ``per_partition`` bytes, and at least two per core.

    One formula at every size; AQE coalesces the small aggregate shuffles back
    to partitions of ``advisoryPartitionSizeInBytes``.
    """
    n = max(2 * spark.sparkContext.defaultParallelism, math.ceil(nbytes / per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    return n
