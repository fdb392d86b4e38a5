"""Written results that are used again while their inputs stay as they are.

A result is a folder under the shared checkpoint folder. Its name holds a stamp of
the input files (path, size, time of change), so a changed input finds no old
result. A result counts once its ``_READY`` file is there, the last thing that is
made, so a build that broke off is done again. With ``max_age`` a result also
ends by time. Old results are left alone, as readers may still use them; they
go with the checkpoint folder.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from nimbusmart.session import checkpoint_dir

READY = "_READY"


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def input_stamp(spark: SparkSession, *paths: str) -> str:
    """A digest of the paths, sizes and times of change of all files of ``paths``. A
    folder's files are listed and summed up by Spark, a single file's by the driver."""
    found = []
    for path in sorted(paths):
        fs, p = _store(spark, path)
        status = fs.getFileStatus(p)
        if not status.isDirectory():
            found.append((path, status.getLen(), status.getModificationTime()))
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        # An order-free sum over the files; their contents are not read.
        one = F.xxhash64("path", "length", "modificationTime")
        total = files.agg(F.count(F.lit(1)), F.bit_xor(one), F.sum("length")).first()
        found.append((path, *total))
    return hashlib.md5(repr(found).encode()).hexdigest()


def _latest(spark: SparkSession, folder: str, max_age: float | None) -> str | None:
    """The newest complete result in ``folder`` that is not too old."""
    fs, p = _store(spark, folder)
    if not fs.exists(p):
        return None
    best = None
    for status in fs.listStatus(p):
        ready = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), READY)
        if fs.exists(ready):
            made = fs.getFileStatus(ready).getModificationTime() / 1000
            if (max_age is None or time.time() - made <= max_age) and (best is None or made > best[0]):
                best = (made, f"{folder}/{status.getPath().getName()}")
    return best and best[1]


def reused(
    spark: SparkSession, name: str, inputs: list[str], build: Callable[[str], None], max_age: float | None = None
) -> str:
    """The folder that ``build(folder)`` filled from ``inputs``: an earlier one, if it
    is of the same input files and at most ``max_age`` seconds old, else a new one."""
    folder = f"{checkpoint_dir(spark)}/reuse/{name}/{input_stamp(spark, *inputs)}"
    found = _latest(spark, folder, max_age)
    if found is None:
        found = f"{folder}/{uuid.uuid4().hex[:12]}"
        build(found)
        fs, ready = _store(spark, f"{found}/{READY}")
        fs.create(ready).close()
    return found
