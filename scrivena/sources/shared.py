"""Folders that the driver and all executors share, for files that a query writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_made: list[tuple[SparkSession, str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers started beside the driver import this package (a cluster ships it with --py-files)."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *parts])
    return spark


def folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which a cluster has to name; it goes when the driver's process ends. A local
    session may do without, as it has one machine."""
    prepare(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.gettempdir()
    path = f"{root.rstrip('/')}/scrivena-files/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session or its gateway may be gone by now
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
