"""Session checks and the shared staging folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

MAX_BROADCAST_ROWS = 100_000
_LOCAL_FOLDERS: dict[str, str] = {}


def require_utc(spark: SparkSession) -> None:
    """Every time rule here is a UTC rule, so another session zone is an error."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone!r})")


def stage_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own, which
    goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.master.startswith("local"):
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = folder = tempfile.mkdtemp(prefix="depthframe-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return _LOCAL_FOLDERS[context.applicationId]
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table and read it back.

    Used where several branches need one costly input: the branches then read
    only their columns of a finished table, and a lost executor costs a re-read
    of files, not a second run of the scan.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
