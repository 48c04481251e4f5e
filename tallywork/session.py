"""Session settings the operators are written for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should carry. AQE re-plans joins from real sizes,
# splits skewed join partitions and merges small shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keyed state with maps and timers (streaming) needs a store that keeps it off the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS; ``conf`` adds to or overrides them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# One JVM: executors and driver share its disk. (local-cluster[...] has several.)
ONE_MACHINE = re.compile(r"local(\[[^\]]*\])?")
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A local session may leave it unset and gets a folder of its own, removed when Python
    ends; on a cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not ONE_MACHINE.fullmatch(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.TemporaryDirectory(prefix="tallywork-")
    return _local_folders[context.applicationId].name


def written_folder(spark: SparkSession) -> str:
    """Where :func:`written` puts the tables of this application; it may go when it ends."""
    return f"{shared_folder(spark)}/tallywork-{spark.sparkContext.applicationId}"


def written(df: DataFrame, by: str | None = None, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Used where a plan reads the same rows twice and both reads must agree (for example on
    the partition a row fell into), and between the stages of a job. Parquet keeps the
    second read column-pruned, and the files outlive any executor. ``by`` names a column whose
    values get folders of their own, so that a read of one value opens no other files;
    ``options`` are the writer's.
    """
    path = f"{written_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> bool:
    """Remove all tables :func:`written` made in this application; frames on them end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
