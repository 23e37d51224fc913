"""Session construction and the shared scratch folder.

The cluster names its shared folder in ``spark.checkpoint.dir``; operators
that must cut lineage (distributed ranking, file round trips) write below
it.  Only on a local master with nothing configured (tests) do we pick a
folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the feature frame has about 150 columns; code generation stops at 100 by default
    "spark.sql.codegen.maxFields": "500",
    # ranked frames are checkpointed; drop their files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "dailyseries",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="dailyseries-ckpt-")
    sc.setCheckpointDir(d)
    # setCheckpointDir appends a unique sub-folder; report what Spark uses
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (local, HDFS, S3A...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the input files, from the cluster file system (no job)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        total += int(hp.getFileSystem(conf).getContentSummary(hp).getLength())
    return total


def scale_conf(spark: SparkSession, paths: list[str], bytes_per_partition: int = 200 << 20,
               split_bytes: int = 256 << 20, apply: bool = True) -> dict[str, str]:
    """Size shuffles and file splits from the input size instead of fixed numbers.

    Shuffle partitions: one per ``bytes_per_partition`` of input (columnar
    input expands in memory; pre-aggregated daily rows shrink it again) and
    never fewer than two per core; AQE then coalesces small ones and splits
    skewed ones.  Scan splits: ``split_bytes`` per task.
    """
    cores = spark.sparkContext.defaultParallelism
    size = input_bytes(spark, paths)
    conf = {
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-size // bytes_per_partition))),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    }
    if apply:
        for k, v in conf.items():
            spark.conf.set(k, v)
    return conf
