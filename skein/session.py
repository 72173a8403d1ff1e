"""Session construction and the few session-level helpers every module shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on: AQE re-plans joins/aggregates at runtime and
# splits skewed join partitions (hot parent ids, frequent words), UTC keeps any
# timestamp rendering engine-independent.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join side that turns out to have at most this many bytes is broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "skein",
              shuffle_partitions: int | None = None, **extra) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, leave ``master`` unset and let spark-submit decide; the
    shuffle partition count should then be sized to the data (roughly
    input bytes / 128 MB), not to the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is configured.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is always
    used. Only a local-mode session without one (tests, the bench) gets a fresh
    scratch folder. A cluster session without the setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="skein-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for written tables."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint).

    Keeps the partitioning and sort order of ``df`` so that later steps that
    depend on partition boundaries see the same ones, and survives the loss of
    the executors that computed it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: later steps
    read the written table instead of repeating the work, and Spark knows its
    size. The table is listed for :func:`clear_scratch`."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables, landing folders, sinks and checkpoints that this
    session wrote to the shared folder; call it once their results are used."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
