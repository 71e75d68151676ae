"""File systems for the raw matrix format, and scratch places on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

# Hadoop names of object stores that Arrow knows under another scheme.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or URI (``file``, ``hdfs``, ``s3``, ``gs``...)."""
    scheme, separator, rest = path.partition("://")
    if not separator:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh place below the cluster's shared ``spark.checkpoint.dir``.

    Only a session on one machine without that setting (a test) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="vectrove-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
