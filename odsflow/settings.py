"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Suggested settings for a session that runs these loads.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "125000000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; 0 when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    match = re.fullmatch(r"\s*(-?\d+)\s*([bkmgt]?)b?\s*", text.lower())
    if match is None:
        return 0
    return max(0, int(match.group(1)) * _UNITS[match.group(2)])


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="odsflow-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent and the
    session runs inside one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


def scratch_home(spark: SparkSession) -> str:
    """Where this application keeps its scratch folders."""
    return f"{shared_dir(spark)}/odsflow/{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def discard_scratch(spark: SparkSession) -> bool:
    """Delete all scratch of this application; call it when no result is read any more.

    A result that was settled on the way is read from its folder, so folders
    cannot go by themselves before their last reader does.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_home(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
