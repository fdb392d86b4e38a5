"""Session construction and the shared scratch location."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Settings every session of the library wants; a cluster may override them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "nimbusmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    hive: bool = False,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with UTC time, AQE and skew handling on.

    ``hive=True`` asks for a Hive catalog, which needs a metastore the cluster
    provides; without it the in-memory catalog is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is taken as it is: whether a path is shared is for the cluster
    to say (``file:`` may be a network mount). Only when the session has none
    and runs in one JVM (local runs, tests) do we create one of our own and
    register it, so ``DataFrame.checkpoint()`` works too. On a cluster, and
    ``local-cluster`` is one, a missing setting is an error: a machine-local
    folder would not survive a lost executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster; "
                "a machine-local temporary folder would not survive a lost executor"
            )
        configured = tempfile.mkdtemp(prefix="nimbusmart-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = checkpoint_dir(spark)
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


def _norm_path(p: str) -> str:
    if p.startswith("file://"):
        p = p[len("file://"):]
    elif p.startswith("file:"):
        p = p[len("file:"):]
    if is_local_path(p):
        p = os.path.abspath(p)
    return p.rstrip("/")


def same_location(a: str, b: str) -> bool:
    """True when two paths point at the same folder (N15: never overwrite the input)."""
    return _norm_path(a) == _norm_path(b)


def check_output(out: str, *inputs: str) -> None:
    """Refuse an output folder that is, contains or lies inside an input folder
    (N15): an overwrite there would delete data the job is still reading."""
    o = _norm_path(out)
    for i in inputs:
        n = _norm_path(i)
        if o == n or o.startswith(n + "/") or n.startswith(o + "/"):
            raise ValueError(f"output {out!r} overlaps input {i!r}; write somewhere else")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# Bytes of shuffle data a reduce task should have before AQE merges small ones,
# and the most blocks (map tasks x reduce tasks) a shuffle may have. At 100 TB
# the second bound holds: about 65 000 maps and as many reducers of 1.6 GB each,
# blocks of about 25 KB. A cluster at that size should also use push-based or
# remote shuffle, which merges them.
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_BLOCKS = 1 << 32
MAP_SPLIT_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(
    shuffle_bytes: int,
    target_bytes: int = SHUFFLE_TARGET_BYTES,
    minimum: int = 8,
    max_blocks: int = MAX_SHUFFLE_BLOCKS,
) -> int:
    """Reduce tasks of about ``target_bytes``, or fewer and larger ones where
    maps x reducers would pass ``max_blocks``; maps are split alike then (see
    :func:`map_split_bytes_for`)."""
    n = -(-int(shuffle_bytes) // int(target_bytes))
    return max(minimum, min(n, math.isqrt(max_blocks)))


def map_split_bytes_for(
    input_bytes: int, split_bytes: int = MAP_SPLIT_BYTES, max_blocks: int = MAX_SHUFFLE_BLOCKS
) -> int:
    """Input bytes a map task reads, so that there are at most sqrt(max_blocks) maps."""
    return max(split_bytes, -(-int(input_bytes) // math.isqrt(max_blocks)))


# Bytes a shuffled row takes per field (an UnsafeRow slot), plus a guess at the
# payload of variable-length values.
_SLOT_BYTES = 8
_VARIABLE_BYTES = 32


def estimate_row_bytes(schema: T.StructType) -> int:
    """Rough shuffle size of one row of ``schema``: a null bitmap word, one
    8-byte slot per field, and a guess for strings, binaries and nested values."""
    size = _SLOT_BYTES
    for f in schema.fields:
        size += _SLOT_BYTES
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            size += _VARIABLE_BYTES
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            size += 16
    return size


@contextmanager
def settings(spark: SparkSession, new: Mapping[str, object]) -> Iterator[None]:
    """Run the enclosed jobs with other settings; the previous ones come back afterwards."""
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def sized_shuffles(
    spark: SparkSession, shuffle_bytes: int, target_bytes: int = SHUFFLE_TARGET_BYTES
) -> Iterator[int]:
    """Run the enclosed jobs with shuffles and map splits sized for
    ``shuffle_bytes``, with no fewer reduce tasks than the session has cores;
    the previous settings come back afterwards. Yields the partition count."""
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect
        cores = 8
    n = shuffle_partitions_for(shuffle_bytes, target_bytes, minimum=max(8, cores))
    new = {
        "spark.sql.shuffle.partitions": n,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes // 2,
    }
    split = map_split_bytes_for(shuffle_bytes)
    if split > MAP_SPLIT_BYTES:
        new["spark.sql.files.maxPartitionBytes"] = split
    with settings(spark, new):
        yield n


# Partitions for every key of a shuffle by few large keys: so many that two of them seldom meet.
PARTITIONS_PER_KEY = 16
# Partitions up to this size may still share a task, and splits of the input are not smaller.
SPREAD_MERGE_BYTES = 1024 * 1024


@contextmanager
def spread_shuffles(
    spark: SparkSession, keys: int, input_bytes: int = 0, max_blocks: int = MAX_SHUFFLE_BLOCKS
) -> Iterator[int]:
    """Run the enclosed jobs with shuffles that leave each of ``keys`` large keys a task
    of its own, but for chance, and with about as many map tasks over files of
    ``input_bytes``; the previous settings come back afterwards. Yields the
    partition count.

    Rows are dealt to partitions by the hash of their key, so with about as many
    partitions as keys several keys meet in one, and AQE merges by the compressed
    size, which says little about the memory that the rows take. AQE still drops
    the partitions that stay empty.
    """
    n = max(1, min(keys * PARTITIONS_PER_KEY, math.isqrt(max_blocks)))
    new = {
        "spark.sql.shuffle.partitions": n,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": SPREAD_MERGE_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": SPREAD_MERGE_BYTES,
    }
    if input_bytes and keys:
        split = max(SPREAD_MERGE_BYTES, -(-input_bytes // keys))
        new["spark.sql.files.maxPartitionBytes"] = map_split_bytes_for(input_bytes, split, max_blocks)
    with settings(spark, new):
        yield n
