"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Recommended session settings. Shuffle partition counts and executor sizes
# belong to the cluster, so they are not set here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "vinework", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vinework-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table is computed once, survives the loss of executors and
    gives the optimizer true sizes, so later joins pick broadcast or shuffle
    from facts.
    """
    path = f"{_own_dir(df.sparkSession)}{_scope.get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scope: ContextVar[str] = ContextVar("scope", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that :func:`cut_lineage` writes inside, at the end.

    For steps whose results are written elsewhere before they end, such as the
    batches of a stream.
    """
    folder = f"/{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        delete_folder(spark, f"{_own_dir(spark)}{folder}")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/vinework/{spark.sparkContext.applicationId}"


def discard_tables(spark: SparkSession) -> None:
    """Delete the tables this application wrote with :func:`cut_lineage`.

    For the end of an application: frames built on these tables stop working.
    """
    delete_folder(spark, _own_dir(spark))


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, folder = _hadoop(spark, path)
    return system.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


def _hadoop(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder
