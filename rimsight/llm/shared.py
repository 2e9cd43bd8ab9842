"""Intermediate tables and files in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from rimsight.session import scratch_path

_SHIPPED: set[str] = set()


def held(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back.

    Cuts the lineage as a checkpoint does, but keeps columns prunable.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the session was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="spark-"), "rimsight_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "rimsight")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def tasks_for(spark: SparkSession) -> int:
    """Shuffle tasks the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
