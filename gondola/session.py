"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime SQL settings beyond Spark's defaults. A dimension too big to broadcast is
# joined by shuffle, and then a hot key is split at run time; "force" allows that even
# where it costs one more shuffle. The JVM does not compile methods over 8000 bytes of
# code, which text parsing reaches soon; above the limit Spark generates smaller ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="gondola-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: With this, the shuffle files of a query go when it ends. Else they stay until the driver happens to collect
#: its garbage, which a driver that does little itself hardly does.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Scratch tables that this process wrote and has not removed.
_tables: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts the lineage with a columnar table: later passes read only the columns
    they need and a lost executor never repeats the work before it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gondola-{uuid.uuid4().hex}"
    _tables.append(path)
    store(df, path)
    return spark.read.schema(df.schema).parquet(path)


def store(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet and remove the shuffle files this took; what reads ``df`` again shuffles anew."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def written_counted(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Any]]:
    """``written``, and aggregates taken on the way."""
    if not metrics:
        return written(df), {}
    seen = Observation(f"gondola-{uuid.uuid4().hex}")
    stored = written(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]))
    return stored, dict(seen.get)


def written_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """``written`` of what ``make()`` returns; what ``written`` wrote inside is removed when the result stands."""
    start = len(_tables)
    stored = written(make())
    for path in _tables[start:-1]:
        remove(stored.sparkSession, path)
    del _tables[start:-1]
    return stored


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this process wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``written`` wrote inside; nothing read from it may be used after."""
    start = len(_tables)
    try:
        yield
    finally:
        for path in _tables[start:]:
            remove(spark, path)
        del _tables[start:]
