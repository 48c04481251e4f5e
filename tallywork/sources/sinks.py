"""Writing tables: batches that are written once, rewrite, and partitions by month with a default bucket."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


DEFAULT_BUCKET = "default"


def with_month_bucket(df: DataFrame, day: str, months: Sequence[str] | None = None, out: str = "bucket") -> DataFrame:
    """Add the month (``yyyy-MM``) of ``day``, or the default bucket.

    With ``months`` only those have a bucket of their own; any other month, like
    a NULL date, goes to the default.
    """
    month = F.date_format(F.col(day), "yyyy-MM")
    known = month.isNotNull() if months is None else month.isin(list(months))
    return df.withColumn(out, F.when(known, month).otherwise(F.lit(DEFAULT_BUCKET)))


def write_partitioned(df: DataFrame, path: str, bucket: str = "bucket", mode: str = "append") -> None:
    """Write one folder per bucket.

    Rebalancing by bucket keeps the number of files per folder small, and AQE
    splits the default bucket, or a busy month, over several tasks.
    """
    df.hint("rebalance", bucket).write.mode(mode).partitionBy(bucket).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a table. Done again after a failure, it adds them again: see :func:`write_batch`."""
    df.write.mode("append").parquet(path)


BATCH_NAME = re.compile(r"[\w][\w.-]*")


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_batch(df: DataFrame, path: str, batch: str | int) -> bool:
    """Append ``df`` to the table at ``path`` as the batch of that name, once.

    A batch is a folder of its own, and Spark's ``_SUCCESS`` file in it is its commit record.
    A batch that has one is not written again (False is returned); what a lost driver left
    without one is not read by :func:`read_batches` and is replaced by the next try. So a job
    that is repeated adds nothing twice.
    """
    name = str(batch)
    if not BATCH_NAME.fullmatch(name):
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {name!r}")
    folder = f"{path.rstrip('/')}/batch={name}"
    hadoop, files = _files(df.sparkSession, folder)
    if files.exists(hadoop.Path(f"{folder}/_SUCCESS")):
        return False
    df.write.mode("overwrite").parquet(folder)
    return True


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches of a table; none yet: no rows."""
    hadoop, files = _files(spark, path)
    found = files.globStatus(hadoop.Path(f"{path.rstrip('/')}/batch=*/_SUCCESS")) or []
    folders = sorted(status.getPath().getParent().toString() for status in found)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def replace(df: DataFrame, path: str) -> None:
    """Replace a table by a rewrite of itself.

    Spark cannot overwrite files it is reading, so the new rows go to a folder beside the
    table, and two renames switch them. Until the first rename the old table is untouched;
    if the second fails the old one is renamed back. The old files go last.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    mark = uuid.uuid4().hex
    fresh, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    df.write.parquet(fresh)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(hadoop.Path(path))
    if had and not files.rename(hadoop.Path(path), hadoop.Path(old)):
        raise OSError(f"{path} could not be moved; the new rows are in {fresh}")
    if not files.rename(hadoop.Path(fresh), hadoop.Path(path)):
        if had:
            files.rename(hadoop.Path(old), hadoop.Path(path))
        raise OSError(f"{path} could not be replaced and is as before; the new rows are in {fresh}")
    if had:
        files.delete(hadoop.Path(old), True)
