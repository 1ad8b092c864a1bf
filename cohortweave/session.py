"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings the operators are written for. None is needed for right results.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "cohortweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, whose executors share this machine, falls back to a
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
    folder = os.path.join(tempfile.gettempdir(), f"cohortweave-{os.getpid()}")
    os.makedirs(folder, exist_ok=True)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """New path under the shared folder for a written intermediate or stream state."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def recorded_paths() -> Iterator[list[str]]:
    """List of the fresh paths handed out inside the block; a block around it lists them too."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(before)
        if (outer := _made.get()) is not None:
            outer.extend(made)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a fresh path whose content is not read any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
