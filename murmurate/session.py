"""Sessions, the shared scratch folder, and cutting lineage with written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_OPEN: list["Scratch"] = []


def local_session(name: str = "murmurate", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset a temporary folder is used, but only when the master is
    local: on a cluster a machine-local folder would lose data with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        try:
            named = spark.sparkContext.getCheckpointDir()
        except Exception:
            named = None
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master and not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = "file://" + tempfile.mkdtemp(prefix="murmurate-")
    return _LOCAL_ROOTS[app]


class Scratch:
    """Tables written to the shared folder to cut lineage.

    A written table survives the loss of any executor, is compressed, and is
    read with column pruning, unlike a block in an executor's storage. Tables
    that a later step no longer needs are dropped by that step; what a result
    still reads stays until the driver process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/murmurate-{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        _OPEN.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{len(self.paths):03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._murmurate_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_murmurate_path", None)
        if path:
            delete_path(self.spark, path)

    def close(self) -> None:
        delete_path(self.spark, self.root)


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, s = hadoop_path(spark, source)
    _, t = hadoop_path(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"cannot move {source} to {target}")


def release() -> None:
    """Drops all written steps so far; for long sessions, once no result is read any more."""
    for scratch in _OPEN:
        scratch.close()
    _OPEN.clear()


@atexit.register
def _clean_up() -> None:
    """Drops what results still read; the engine may have stopped already, so local folders go without it."""
    for scratch in _OPEN:
        try:
            if scratch.root.startswith(("file:", "/")):
                shutil.rmtree(scratch.root.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
            else:
                scratch.close()
        except Exception:
            pass


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
