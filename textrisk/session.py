"""Session settings and staged intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders staged by this driver, oldest first.
_made: list[str] = []


def build_session(app: str = "textrisk", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the library counts on; ``settings`` use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all executors share.

    A session without that setting uses a folder below its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    return f"{root}/{spark.sparkContext.applicationId}"


def staged_folder(spark: SparkSession, kind: str = "staged") -> str:
    """A new, not yet made folder for one staged table; ``staging`` removes it."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and go on from there (one job).

    For a narrow frame that several passes read: costly columns are computed once, later
    passes read only the columns they need, filters on computed columns are not pushed
    back into the computation, and the rows survive the loss of any executor.
    """
    spark = df.sparkSession
    path = staged_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Remove a table that ``staged`` returned, when nothing will read it any more."""
    names = {file.rsplit("/", 2)[-2] for file in df.inputFiles()}
    for path in [path for path in _made if path.rsplit("/", 1)[-1] in names]:
        _delete(df.sparkSession, path)
        _made.remove(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a ``staged_folder`` that nothing will read any more."""
    _delete(spark, path)
    _made.remove(path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every table staged inside it.

    Frames that read such a table must be written or collected before the block ends.
    """
    before = len(_made)
    try:
        yield
    finally:
        for name in _made[before:]:
            _delete(spark, name)
        del _made[before:]


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small input at least as many partitions as there are cores.

    A file of few row groups is read by few tasks, which leaves costly text work on a few
    cores. An input of enough files is returned as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, *keys)
