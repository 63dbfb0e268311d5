"""Session, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strandwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table `name` of a data directory; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system is there; other faults are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only where the setting is absent and everything runs in one process.

    Off a local master an absent setting is an error: each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="strandwise-checkpoint-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


class Scratch:
    """Tables written to the shared checkpoint folder to cut lineage.

    Every `write` is a plain Parquet table that all executors can read again after any loss.
    `drop` removes one early; whatever is left goes when the Python process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{checkpoint_root(spark)}/strandwise-{uuid.uuid4().hex}"
        self.made: dict[int, str] = {}
        atexit.register(self.close)

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.made.pop(id(df), None)
        if path:
            self._remove(path)

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        try:
            self._remove(self.root)
        except Exception:  # the JVM may be gone already
            pass


def spread(scan: DataFrame) -> DataFrame:
    """A table as read, in at least one partition per core, for work that Python does row by row.

    A file of one row group can't be split, and such a scan would keep one core busy; then its rows are dealt out. Only the
    number of tasks depends on it, never a result. Scans with enough splits stay where they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(3 * cores) if scan._jdf.rdd().getNumPartitions() < cores else scan
