"""Records by endpoint: a data source with one partition an endpoint, that opens only endpoints whose channels are asked for.

A capture is a folder of Parquet files by endpoint, as ``record`` writes it. Each endpoint carries a fixed range of channels, so
predicates on ``frequency`` (and on ``endpoint``) are pushed into the source and decide, before any task starts, which
endpoints have a partition at all. As a stream, the source hands on the files that each endpoint has added since the last trigger.

Options: ``path`` (any file system that pyarrow or Spark's own URIs name: ``file:``, ``hdfs:``, ``s3:``, or a plain path) and ``channels``
(channels of an endpoint; endpoint k starts at k times that). Filter push-down of Python sources has a switch in Spark, which ``register`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

NAME = "endpoints"
SCHEMA = "arrival_seq long, kind string, ts_raw long, frequency int, payload long, endpoint int"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def record(heaps: DataFrame, path: str, channels: int) -> None:
    """Write records (arrival_seq, kind, ts_raw, frequency, payload) to their endpoints' folders; those without a channel go to endpoint -1. Many writers a folder are fine."""
    rows = heaps.withColumn("endpoint", F.coalesce(F.floor(F.col("frequency") / channels).cast("int"), F.lit(-1))).select(*COLUMNS)
    rows.withColumn("_folder", F.col("endpoint")).write.mode("append").partitionBy("_folder").parquet(path)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Endpoints)


def read(spark: SparkSession, path: str, channels: int) -> DataFrame:
    register(spark)
    return spark.read.format(NAME).option("path", path).option("channels", str(channels)).load()


def read_stream(spark: SparkSession, path: str, channels: int) -> DataFrame:
    register(spark)
    return spark.readStream.format(NAME).option("path", path).option("channels", str(channels)).load()


@dataclass
class Endpoint(InputPartition):
    number: int
    files: list[str]

    def __init__(self, number: int, files: list[str]):
        super().__init__(number)
        self.number, self.files = number, files


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def list_files(path: str) -> dict[int, list[str]]:
    """Whole files of each endpoint, in the order of their writing, so that what is recorded later comes later. Spark's commit moves files into place, so what is listed is complete."""
    from pyarrow import fs

    system, root = _file_system(path)
    out: dict[int, list[str]] = {}
    for item in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if item.type == fs.FileType.Directory and item.base_name.startswith("_folder=") and item.base_name[8:].lstrip("-").isdigit():
            files = system.get_file_info(fs.FileSelector(item.path))
            whole = [f for f in files if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
            out[int(item.base_name[8:])] = [f.path for f in sorted(whole, key=lambda f: (f.mtime_ns or 0, f.path))]
    return out


def read_files(path: str, files: list[str]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    system, _ = _file_system(path)
    for name in files:
        with system.open_input_file(name) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=COLUMNS):
                yield batch


class Wanted:
    """The endpoints that predicates leave, as half-open bounds of numbers and a set, if there is one. Only what is decided here entirely by the number is taken from Spark."""

    def __init__(self, channels: int):
        self.channels, self.low, self.high, self.among = channels, float("-inf"), float("inf"), None

    def take(self, f: Filter) -> bool:
        """Narrow by a filter; whether no row of what is left needs the filter any more."""
        if not isinstance(f, (In, EqualTo, EqualNullSafe, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or f.attribute not in (("frequency",), ("endpoint",)):
            return False
        by_frequency, value = f.attribute[0] == "frequency", f.value
        if isinstance(f, In):
            self._only({v // self.channels if by_frequency else v for v in value if v is not None})
            return not by_frequency
        if value is None:
            return False
        at = value // self.channels if by_frequency else value
        whole = not by_frequency
        if isinstance(f, (EqualTo, EqualNullSafe)):
            self._only({at})
        elif isinstance(f, GreaterThan):
            self.low = max(self.low, at if by_frequency else at + 1)
        elif isinstance(f, GreaterThanOrEqual):
            self.low = max(self.low, at)
        elif isinstance(f, LessThan):
            self.high = min(self.high, -(-value // self.channels) if by_frequency else at)
        elif isinstance(f, LessThanOrEqual):
            self.high = min(self.high, at + 1)
        else:
            return False
        return whole

    def _only(self, some: set[int]) -> None:
        self.among = some if self.among is None else self.among & some

    def __contains__(self, number: int) -> bool:
        return self.low <= number < self.high and (self.among is None or number in self.among)


class EndpointReader(DataSourceReader):
    def __init__(self, path: str, channels: int):
        self.path, self.wanted = path, Wanted(channels)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on channels within an endpoint stay with Spark; those on whole endpoints are done by choosing partitions."""
        return iter([f for f in filters if not self.wanted.take(f)])

    def partitions(self) -> list[InputPartition]:
        return [Endpoint(k, files) for k, files in sorted(list_files(self.path).items()) if k in self.wanted and files]

    def read(self, partition: Endpoint) -> Iterator[pa.RecordBatch]:
        return read_files(self.path, partition.files)


class EndpointStream(DataSourceStreamReader):
    """Offsets are the numbers of files taken of each endpoint."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {str(k): len(files) for k, files in list_files(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = list_files(self.path)
        return [Endpoint(int(k), some) for k, n in sorted(end.items()) if (some := files.get(int(k), [])[start.get(k, 0) : n])]

    def read(self, partition: Endpoint) -> Iterator[pa.RecordBatch]:
        return read_files(self.path, partition.files)


class Endpoints(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return EndpointReader(self.options["path"], int(self.options["channels"]))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return EndpointStream(self.options["path"])
