"""Session settings, staging tables and small partitioning helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# The folder of the job that runs, if it removes what it stages.
_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)


def build_session(app_name: str = "textprep", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Lets AQE hash-join narrow key tables without sorting the wide text side.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        # Arrow batches carry whole texts, so bound them by rows well below 2 GiB.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.session.timeZone": "UTC",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder, since all its tasks run on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="textprep-")
    return _LOCAL_ROOTS[app]


def _application_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/textprep/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the staging folder."""
    return f"{_JOB_FOLDER.get() or _application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the staging folder and return the table read back.

    Used where several later jobs need the same costly result: the written
    table survives lost executors and cuts the lineage. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again.

    What was computed from them has to be staged itself.
    """
    for table in tables:
        _remove(table.sparkSession, table._staged_at)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables; nothing that reads them works after."""
    _remove(spark, _application_folder(spark))


def removes_staged(job: Callable) -> Callable:
    """A job whose staged tables are removed when it ends, also by an error.

    Its first argument is the session; what it returns must not read them.
    """

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        folder = staging_path(spark, job.__name__)
        outer = _JOB_FOLDER.set(folder)
        try:
            return job(spark, *args, **kwargs)
        finally:
            _JOB_FOLDER.reset(outer)
            _remove(spark, folder)

    return run


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy row work at least one partition per core.

    Only an input with fewer scan splits than cores is repartitioned; a large
    input already has more and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df
