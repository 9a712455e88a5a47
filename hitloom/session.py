"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

MIB = 1 << 20
GIB = 1 << 30

_local_folder: str | None = None


def sizing(input_bytes: int) -> dict[str, str]:
    """Partition settings for a job that reads ``input_bytes`` of log text; none for 0.

    Scan splits grow from 128 MiB to 512 MiB, so that 100 TB takes about 200,000 map
    tasks and each sorts its split in memory. Shuffles start with one partition per
    256 MiB to 4 GiB of input, which keeps 100 TB near 25,000 partitions and their blocks
    large enough to fetch; AQE merges small ones towards the advisory size afterwards.
    """
    if not input_bytes:
        return {}
    split = min(max(128 * MIB, input_bytes // 200_000), 512 * MIB)
    reduce_bytes = min(max(256 * MIB, input_bytes // 25_000), 4 * GIB)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(max(8, math.ceil(input_bytes / reduce_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
    }


def build_session(app_name: str = "hitloom", master: str | None = None,
                  input_bytes: int = 0, **settings: str) -> SparkSession:
    """A session with AQE on and partition settings sized for the input."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **sizing(input_bytes),
        **settings,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_to_input(spark: SparkSession, input_bytes: int) -> None:
    """Apply ``sizing`` to a running session, but for what its user has set."""
    given = spark.sparkContext.getConf()
    for key, value in sizing(input_bytes).items():
        if not given.contains(key):
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only in local mode, where all tasks share one
    machine.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="hitloom-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/hitloom/{label}-{uuid.uuid4().hex}"
