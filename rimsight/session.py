"""Session settings for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "rimsight") -> SparkSession:
    """Local session for tests and benches; on a cluster use the cluster's own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a new one only if unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one round trip, under the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def hold(df: DataFrame) -> DataFrame:
    """Write a reused intermediate once to the shared folder and read it back.

    Column pruning gives each consumer of an aggregate a different shuffle, so
    Spark cannot reuse the exchange: without this the scan below runs once per
    consumer. A reliable checkpoint also survives a lost executor.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


class Columns:
    """A reused intermediate as columns in the shared folder, for one ``with`` block, at whose end it is removed.

    A checkpoint keeps whole rows, uncompressed, as long as the session keeps them; use this for tables that grow
    with the input, and for what is worked out before the block ends.
    """

    def __init__(self, df: DataFrame) -> None:
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, "columns")
        try:
            df.write.parquet(self.path)
        except BaseException:
            self.remove()
            raise
        self.table = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> DataFrame:
        return self.table

    def __exit__(self, *_: object) -> None:
        self.remove()


TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int, each: int = TASK_ROWS) -> int:
    """Tasks to deal rows out to: as many as the session runs at once, more where a task would get over ``each``.

    With the session's fixed number of shuffle partitions, merged up to a size in bytes, a task's memory grows with
    the table.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the session was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "rimsight_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "rimsight")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
