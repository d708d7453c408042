"""Writes that happen once, however many sessions race or however often a batch is run again."""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _hadoop(spark: SparkSession, path: str):
    """File context and Hadoop path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop.FileContext.getFileContext(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri()), where


def _local(path: str) -> str | None:
    return path.removeprefix("file://") if path.startswith(("file:///", "/")) else None


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``path`` with this text if it is not there yet; whether it was us. The text is written aside and then named, so nobody reads half of it.

    A hard link (local) and a rename that does not overwrite (elsewhere, as in HDFS) both fail for all but one.
    """
    aside = f"{path}.{os.urandom(8).hex()}"
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(_local(aside), "x") as f:
            f.write(text)
        try:
            os.link(_local(aside), local)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(_local(aside))
    context, target = _hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    _, source = _hadoop(spark, aside)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(source, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:
        context.rename(source, target, options)
        return True
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        system.delete(source, False)
        return False


def _text(spark: SparkSession, path: str) -> str | None:
    if local := _local(path):
        try:
            with open(local) as f:
                return f.read()
        except FileNotFoundError:
            return None
    context, where = _hadoop(spark, path)
    if not context.util().exists(where):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def first_writer(spark: SparkSession, path: str, value: object) -> object:
    """The value that the first caller with this path gave, for all callers, whatever they give themselves."""
    if (held := _text(spark, path)) is None:
        _publish(spark, path, json.dumps(value))
        held = _text(spark, path)
    return json.loads(held)


def shared_base(spark: SparkSession, folder: str, block: str, heaps: DataFrame) -> int | None:
    """The first timestamp of a capture block, the same for all its sessions: that of the session which is first to tell one. None where these records have none and nobody told one."""
    from ..operators.frames import first_timestamp

    path = f"{folder.rstrip('/')}/{block}/first_timestamp"
    if (held := _text(spark, path)) is not None:
        return json.loads(held)
    own = first_timestamp(heaps).first()["ts0"]
    return own if own is None else first_writer(spark, path, own)


class ExactlyOnceSink:
    """A receiver that leaves each batch of each query in its folder once, by substream.

    An epoch is written to a folder of its own, over whatever an interrupted attempt left there, and then committed by a marker. Epochs
    that have a marker are not written again; readers see committed epochs only. Failures are retried ``attempts`` times, each
    wait twice as long as the one before, and then raised.
    """

    def __init__(self, path: str, query: str, attempts: int = 3, wait: float = 0.5, by: str = "substream", write: Callable[[DataFrame, str], None] | None = None):
        self.path, self.query, self.attempts, self.wait, self.by = path.rstrip("/"), query, attempts, wait, by
        self.write = write or (lambda batch, folder: batch.write.mode("overwrite").partitionBy(by).parquet(folder))

    def _marker(self, epoch: int) -> str:
        return f"{self.path}/{self.query}/committed/{epoch}"

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if _text(spark, self._marker(epoch)) is not None:
            return
        for attempt in range(self.attempts):
            try:
                self.write(batch, f"{self.path}/{self.query}/rows/epoch={epoch}")
                break
            except Exception:
                if attempt + 1 == self.attempts:
                    raise
                log.warning("epoch %d of %s failed, attempt %d", epoch, self.query, attempt + 1, exc_info=True)
                time.sleep(self.wait * 2**attempt)
        _publish(spark, self._marker(epoch), "")

    def begin(self, block: str) -> None:
        """Leave a mark that a capture block has begun, for readers of the folder."""
        _publish(SparkSession.active(), f"{self.path}/{self.query}/marks/{block}.begin", "")

    def end(self, block: str) -> None:
        """And that no more of it will come."""
        _publish(SparkSession.active(), f"{self.path}/{self.query}/marks/{block}.end", "")

    def ended(self, block: str) -> bool:
        return _text(SparkSession.active(), f"{self.path}/{self.query}/marks/{block}.end") is not None

    def committed(self, spark: SparkSession) -> list[int]:
        context, where = _hadoop(spark, f"{self.path}/{self.query}/committed")
        if not context.util().exists(where):
            return []
        names = [f.getPath().getName() for f in context.util().listStatus(where)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """Rows of all committed epochs, with the columns ``epoch`` and the substream."""
        root = f"{self.path}/{self.query}/rows"
        folders = [f"{root}/epoch={e}" for e in self.committed(spark)]
        full = f"{schema}, epoch long"
        if not folders:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).option("basePath", root).parquet(*folders)
