"""A data source of many small files: planned from their listing, read by task as whole files or numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT_SCHEMA = "path string, unit string, size long, line long, value string"


def _source():
    # defined here so that workers get the classes themselves and need no import of this package
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Files(InputPartition):
        def __init__(self, files: list[tuple[str, int]]):
            super().__init__(None)
            self.files = files

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.root = options["path"]
            self.suffix = options.get("suffix", "")
            self.least = int(options.get("leastbytes", "0"))
            self.target = int(options.get("partitionbytes", str(32 << 20)))
            self.whole = options.get("whole", "false") == "true"

        def _at(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.root if ":/" in self.root else f"file://{self.root}")

        def partitions(self) -> list:
            """Files that count, in order of their paths, packed by size; small and other files are never opened."""
            from pyarrow import fs

            system, path = self._at()
            listed = system.get_file_info(fs.FileSelector(path, recursive=True))
            hidden = lambda p: any(part[:1] in "._" for part in p[len(path) :].split("/") if part)
            kept = sorted((i.path, i.size) for i in listed if i.is_file and i.path.removesuffix(".gz").endswith(self.suffix) and i.size > self.least and not hidden(i.path))
            out, size = [[]], 0
            for name, n in kept:
                weight = n * 8 if name.endswith(".gz") else n  # about what a compressed file holds
                if out[-1] and size + weight > self.target:
                    out.append([])
                    size = 0
                out[-1].append((name, n))
                size += weight
            return [Files(files) for files in out if files]

        def read(self, partition):
            import pyarrow as pa

            names = ["path", "unit", "size", "line", "value"]

            def batch(path: str, size: int, first: int, values: list[str]) -> pa.RecordBatch:
                unit, n = path.rsplit("/", 1)[-1].removesuffix(".gz").rsplit(".", 1)[0], len(values)
                lines = pa.array(range(first, first + n), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([unit] * n), pa.array([size] * n, pa.int64()), lines, pa.array(values, pa.string())], names)

            system, _ = self._at()
            for path, size in partition.files if partition else []:
                with system.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as raw:
                    if self.whole:
                        yield batch(path, size, 0, [raw.read().decode("utf-8-sig", "replace")])
                        continue
                    first, rest = 0, b""
                    while piece := raw.read(4 << 20):
                        *lines, rest = (rest + piece).split(b"\n")
                        if lines:
                            yield batch(path, size, first, [x.decode("utf-8", "replace") for x in lines])
                            first += len(lines)
                    if rest:
                        yield batch(path, size, first, [rest.decode("utf-8", "replace")])

    class Units(DataSource):
        @classmethod
        def name(cls) -> str:
            return "file_units"

        def schema(self) -> str:
            return "path string, unit string, size long, line long, value string"

        def reader(self, schema) -> Reader:
            return Reader({k.lower(): v for k, v in self.options.items()})

    return Units


def read_units(spark: SparkSession, root: str, suffix: str = "", least_bytes: int = 0, whole: bool = False, partition_bytes: int = 32 << 20) -> DataFrame:
    """path, unit (file name without its ending), size, line (from 0) and value of the files under a folder.

    The listing decides what is read: files of other endings, hidden ones and those of at most
    ``least_bytes`` bytes are never opened, many small files share a task and a file's lines
    keep their places. Files whose name goes on with ``.gz`` are unpacked as they are read. Empty folders give no rows.
    """
    spark.dataSource.register(_source())
    options = {"path": root, "suffix": suffix, "leastBytes": str(least_bytes), "whole": str(whole).lower(), "partitionBytes": str(partition_bytes)}
    return spark.read.format("file_units").options(**options).load()


def game_units(spark: SparkSession, root: str, schema: str, null_bytes: int = 4) -> DataFrame:
    """Games under ``slug/season/``: one document a line, null files skipped by their size, keys from the path."""
    rows = read_units(spark, root, ".json", null_bytes).where(~F.col("value").isin("", "null"))
    keys = r"/(?:slug=)?([^/]+)/(?:season=)?(\d{4}-\d{2})/[^/]+$"
    named = rows.select(F.from_json("value", schema).alias("game"), F.regexp_extract("path", keys, 1).alias("slug"), F.regexp_extract("path", keys, 2).alias("season"))
    return named.select("game.*", "slug", "season")


def account_units(spark: SparkSession, root: str, schema: str, skip: str = "teams") -> DataFrame:
    """JSON lines of many accounts with their place in the file; the account is the file's name, or its folder's."""
    rows = read_units(spark, root, ".json").where(F.col("value") != "")
    account = F.coalesce(F.nullif(F.regexp_extract("path", r"/account=([^/]+)/[^/]+$", 1), F.lit("")), F.col("unit"))
    named = rows.select(F.from_json("value", schema).alias("row"), account.alias("account_name"), "path", "line")
    return named.where(F.col("account_name") != skip).select("row.*", "account_name", "path", "line")
