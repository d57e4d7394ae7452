"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, AQE for runtime re-planning (join strategy,
# partition coalescing, skew-join splitting), and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that are gone are removed by Spark itself.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "issuelens", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder below the cluster's shared checkpoint directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we only read it.
    When it is unset (local tests) a scratch folder is created and registered as the
    checkpoint directory, so ``DataFrame.checkpoint()`` and written tables agree.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="issuelens-")   # local runs and tests only
        sc.setCheckpointDir(base)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return os.path.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a table of ``shared_dir`` that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Jobs run inside have these session settings."""
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def small_methods(spark: SparkSession):
    """Jobs run inside write wide projections (an issue document has some sixty fields) as several small methods,
    and VARIANTs as they are.

    The JVM never compiles a generated method of more than 8,000 bytes; it would interpret it for every row.  Shredding
    takes every issue apart and builds it again, a column a field, which costs more than parsing its page."""
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.variant.inferShreddingSchema": "false"})


def unsorted_writes(spark: SparkSession, folders: int):
    """Tables written inside to at most so many ``partitionBy`` folders keep a file open for each, where rows would be sorted
    by folder (and spilled) first."""
    return settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(folders + 1)})    # at the number itself Spark begins to sort


def spread(df):
    """Give a CPU-heavy per-row stage at least one partition per core.

    A small file with one row group is scanned by one task, so parsing or rebuilding
    text would run on one core.  When the input has fewer partitions than the cluster
    has cores, one round-robin shuffle spreads it; on a wide input (many files or row
    groups, the normal case at scale) this is a no-op and adds no exchange.  Meant for
    scans: on a plan with shuffles, counting partitions under AQE runs those shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settle(df):
    """Materialise ``df`` once with a reliable checkpoint in the shared checkpoint folder.

    Used where a plan is read by more than one job (size statistics, then the result):
    lineage is cut, so the second job and any recomputation after a lost executor read
    the checkpoint instead of recomputing the input.  The checkpoint keeps the input's
    partitioning.
    """
    shared_dir(df.sparkSession, "checkpoint")     # ensures a checkpoint folder is set
    return df.checkpoint(eager=True)


def as_table(df, name: str, **options):
    """Write ``df`` as Parquet into the shared folder and read it back.

    Like :func:`settle` it cuts lineage and survives lost executors; unlike a checkpoint,
    later jobs read only the columns they need.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
