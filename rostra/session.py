"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For work that would fill the disks: files of a shuffle go when the query that made them has ended, and
# what is written takes a better compression. A frame that is run twice then makes its shuffles twice.
FRUGAL_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_made: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every plan in this package assumes."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Apply the settings that keep little on disk for a while."""
    before = {key: spark.conf.get(key, None) for key in FRUGAL_SETTINGS}
    try:
        for key, value in FRUGAL_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that all executors can reach.

    It lies under ``spark.checkpoint.dir``; where that is unset, under the warehouse
    folder of the session, which a cluster shares as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def staged(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a relation that is read several times to the shared folder and read it back.

    That computes it once, keeps later plans short, and survives the loss of an executor. ``by`` are columns of few
    values that readers choose by: each value has a folder of its own.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """A point in time for ``scratch_since``."""
    return len(_made)


def scratch_since(mark: int) -> list[str]:
    """The folders that this process made since then and has not deleted, in their order."""
    return [path for path in _made[mark:] if path]


def drop_scratch(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete those of the folders that this process made with ``shared_dir``. Returns how many there were."""
    jvm, n = spark.sparkContext._jvm, 0
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name in set(paths).intersection(filter(None, _made)):
        _made[_made.index(name)] = ""  # marks stay valid
        path = jvm.org.apache.hadoop.fs.Path(name)
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders that this process made with ``shared_dir``, and no other.

    Call it when no result that still reads them is needed. Returns how many there were.
    """
    n = drop_scratch(spark, list(_made))
    _made.clear()
    return n
