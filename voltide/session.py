"""Session helpers."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltide")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.debug.maxToStringFields", "200")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``. Only a local
    master may do without it: a private folder is taken then. On a cluster the
    executors would not see such a folder, so its absence raises."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="voltide-ckpt-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written table, inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write an intermediate table that several jobs read and return a scan of
    it (shared storage, so a lost executor costs a re-read, not the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver collect finished queries now: their shuffle files stay on
    the executors' disks until it does. For use between large steps."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing reads them
    any more. Anything outside the shared scratch folder is left alone."""
    for table in tables:
        spark = table.sparkSession
        root = spark.sparkContext.getCheckpointDir()
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        home = jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().toUri().getPath() == home:
                path.getFileSystem(conf).delete(path, True)
