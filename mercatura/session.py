"""Session defaults and the shared folder that staged tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "mercatura", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides.

    Keys use underscores for dots: ``spark_sql_shuffle_partitions="64"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites of column expressions: two gateway calls for each of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, visible to every executor.

    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder all executors can reach"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mercatura-"))
    return context.getCheckpointDir()


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go as soon as each query ends."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``compression`` other than the session's is
    for large texts that stay long.

    Cuts the lineage with a table that outlives any executor, keeps the data
    columnar for later pruned scans, and fixes values such as
    ``monotonically_increasing_id`` that a recomputation might change.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def publish(spark: SparkSession, made: str, path: str) -> None:
    """Put the finished folder ``made`` in the place of ``path``; one writer at a time.

    The old folder steps aside first and is deleted last, so at any moment a whole
    version is at ``path`` or beside it, where the next writer's ``recover`` finds it. Between
    the two renames there is no table: tables that must be readable at any moment are
    kept in versions (``sources.versions``).
    """
    recover(spark, path)
    if path_exists(spark, path):
        _rename(spark, path, aside(path))
    if path_exists(spark, path):  # a rename would put the new folder inside this one
        raise RuntimeError(f"another writer has made {path}; {made} is whole and not published")
    _rename(spark, made, path)
    drop_path(spark, aside(path))


def aside(path: str) -> str:
    """Where the old folder is while a new one takes its place."""
    return f"{path}.before"


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a ``publish`` that was cut short: the old version returns if the new one
    never took its place. For writers only: a reader might meet a writer at work."""
    if path_exists(spark, aside(path)):
        if path_exists(spark, path):
            drop_path(spark, aside(path))
        else:
            _rename(spark, aside(path), path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(source)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).rename(folder, jvm.Path(target)):
        raise RuntimeError(f"cannot move {source} to {target}")


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables this application has staged; frames over them end with it."""
    drop_path(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
