"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "rivermill", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Runtime settings that decide results (time zone) or overwrite scope, on a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a local session without it gets a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="rivermill-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


_OWNED: set[str] = set()


def run_dir(spark: SparkSession) -> str:
    """The folder of this application below the shared one; it goes when the driver's process ends."""
    path = f"{shared_dir(spark)}/rivermill-{spark.sparkContext.applicationId}"
    if path not in _OWNED:
        _OWNED.add(path)
        atexit.register(_remove, spark.sparkContext._gateway.jvm, path)
    return path


def _remove(jvm, path: str) -> None:
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
    except Exception:  # noqa: BLE001  the JVM may be gone before the driver's process ends
        pass


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the run's folder, so reruns never collide."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes what `fresh_path` gave, once nothing reads it any more."""
    if not path.startswith(run_dir(spark)):
        raise ValueError(f"not a folder of this run: {path}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write once, read back: cuts lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def spread(df):
    """Deals rows out when the input has fewer splits than the cluster has cores; a large input is left alone.

    For work that is heavy per row: one small file would otherwise keep a single core busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
