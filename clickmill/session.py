"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Micros instead of INT96, so that parquet keeps min/max of timestamps and can skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A repeated key in a payload keeps its last value, as most JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM does not compile methods beyond this size; smaller generated ones run much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# State of the stateful stream lives off-heap and on disk.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(name: str = "clickmill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; the caller stops it.

    ``settings`` are further Spark settings, with ``__`` for ``.`` in their names.
    """
    builder = SparkSession.builder.appName(name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | STATE_STORE).items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Put the engine's settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a session that runs in this one process may go without that setting, as tests do: it gets
    a folder that goes away with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _own_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _own_root() -> str:
    root = tempfile.mkdtemp(prefix="clickmill-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def observed(seen: Observation, *names: str) -> tuple:
    """Values observed by a finished job; None where the optimizer has found it to have no rows at all."""
    if seen._jo.get().isEmpty():
        return (None,) * len(names)
    found = seen.get
    return tuple(found[n] for n in names)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller has made."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A new folder under the shared folder, removed with all in it when the work ends or fails."""
    path = scratch_dir(spark, purpose)
    try:
        yield path
    finally:
        remove(spark, path)
