"""A folder for a run's own files."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: list[str] = []
_MADE: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; a temporary one only where all tasks run in the driver's process."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="paysieve-"))
        top = _OWN[0]
    _MADE.append(f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear(spark: SparkSession) -> int:
    """Deletes the folders that this process has named so far; how many there were.  What still reads them fails afterwards."""
    gone = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
