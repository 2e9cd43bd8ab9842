"""Keyed upsert of arriving batches into a table of key buckets.

Layout of a table: ``data/version=<v>/bucket=<b>/`` holds the rows of one key bucket as written by
one batch, ``manifest/version=<v>/`` says for each bucket which version of it the table has. A
batch reads and writes only the buckets its keys fall into; all others keep their files. A
manifest counts once its write has finished, so a batch that is cut short changes nothing and a
batch that is run again gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rimsight.operators.keyed import last_per_key

BUCKETS = 64  # of a new table; an existing one keeps its own number


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, table: str) -> list[int]:
    """Versions whose manifest was finished; a batch cut short has no success mark."""
    path, fs = _folder(spark, f"{table}/manifest")
    if not fs.exists(path):
        return []
    done = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        mark = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(mark):
            done.append(int(name.split("=")[1]))
    return sorted(done)


def manifest(spark: SparkSession, table: str, version: int) -> dict[int, int]:
    """Version of each bucket, -1 for a bucket without rows; one small row a bucket."""
    rows = spark.read.schema("bucket int, written long").parquet(f"{table}/manifest/version={version}").collect()
    return {r["bucket"]: r["written"] for r in rows}


def _read(spark: SparkSession, table: str, buckets: dict[int, int]) -> DataFrame | None:
    """Rows of some buckets as their versions wrote them."""
    paths = [f"{table}/data/version={v}/bucket={b}" for b, v in sorted(buckets.items()) if v >= 0]
    return spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The table as of the last finished batch."""
    done = _versions(spark, table)
    return _read(spark, table, manifest(spark, table, done[-1])) if done else None


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_batch(table: str, keys: Sequence[str], order: str, buckets: int = BUCKETS, keep: int = 2, by_batch: bool = True) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch over the table before it, in the buckets it touches.

    The last row of a key wins, by batch and then ``order``; without ``by_batch`` by ``order`` and
    then batch, so that rows may arrive in any order of batches. The batch is reduced to one row a
    key before it is dealt to its buckets, so a key that holds most of it is one row a task.
    ``keep`` versions stay readable, data that only older ones name is removed.
    """
    keys = list(keys)
    newest = [F.col("_batch"), F.col(order)] if by_batch else [F.col(order), F.col("_batch")]

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = [v for v in _versions(spark, table) if v <= batch_id]
        if batch_id in done:
            return
        before = manifest(spark, table, done[-1]) if done else dict.fromkeys(range(buckets), -1)
        n = len(before)
        rows = last_per_key(batch.withColumn("_batch", F.lit(batch_id).cast("long")), keys, [F.col(order)])
        rows = rows.persist()
        try:
            touched = [r[0] for r in rows.select(bucket_of(keys, n)).distinct().collect()]
            merged = rows
            old = _read(spark, table, {b: before[b] for b in touched})
            if old is not None:
                merged = old.unionByName(rows, allowMissingColumns=True)
            merged = last_per_key(merged, keys, newest).withColumn("bucket", bucket_of(keys, n))
            # one file a bucket; a bucket is a bounded share of the keys
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/version={batch_id}")
        finally:
            rows.unpersist()
        after = {**before, **dict.fromkeys(touched, batch_id)}
        made = spark.createDataFrame(sorted(after.items()), "bucket int, written long")
        made.coalesce(1).write.mode("overwrite").parquet(f"{table}/manifest/version={batch_id}")
        clean(spark, table, keep)

    return apply


def clean(spark: SparkSession, table: str, keep: int) -> None:
    """Remove manifests but the last ``keep``, and buckets that none of those name."""
    done = _versions(spark, table)
    kept = done[-keep:]
    named = {(b, v) for version in kept for b, v in manifest(spark, table, version).items()}
    data, fs = _folder(spark, f"{table}/data")
    for status in fs.listStatus(data) if kept and fs.exists(data) else []:
        version = status.getPath().getName().removeprefix("version=")
        if not version.isdigit() or int(version) > kept[-1]:
            continue
        own = [s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("bucket=")]
        gone = [p for p in own if (int(p.getName().removeprefix("bucket=")), int(version)) not in named]
        for path in [status.getPath()] if len(gone) == len(own) else gone:
            fs.delete(path, True)
    for version in done[:-keep]:
        fs.delete(_folder(spark, f"{table}/manifest/version={version}")[0], True)


def upsert_stream(stream: DataFrame, table: str, keys: Sequence[str], order: str, checkpoint: str, by_batch: bool = True) -> StreamingQuery:
    """Upsert everything that has arrived, then stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(upsert_batch(table, keys, order, by_batch=by_batch)).start()
