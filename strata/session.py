"""Checks on the session a job runs in, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bounds of a table side that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


class SessionNotFit(RuntimeError):
    """The session's settings would change results or plans."""


def require_utc(spark: SparkSession) -> None:
    """Month buckets and parsed times depend on the session zone, so a run refuses any zone but UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "+00:00", "GMT"):
        raise SessionNotFit(f"spark.sql.session.timeZone is {zone}; set it to UTC before running")


def warn_without_skew_handling(spark: SparkSession) -> None:
    """Row-level shuffled joins count on adaptive execution to split a hot key over several tasks."""
    for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(name).lower() != "true":
            warnings.warn(f"{name} is off; a hot join key will run in one task", stacklevel=2)


@contextmanager
def overriding(spark: SparkSession, name: str, value: str):
    """Run a block with one session setting changed."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def without_shuffles_left(spark: SparkSession):
    """Run a block whose queries remove what they shuffled when they end, not when the driver happens to collect garbage."""
    return overriding(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise SessionNotFit("set spark.checkpoint.dir to a folder that every executor can reach")
        return tempfile.mkdtemp(prefix=f"strata-{purpose}-")
    return f"{shared.rstrip('/')}/strata-{purpose}-{uuid.uuid4().hex}"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` is measured to hold at most ``limit`` bytes in ``rows`` rows.

    The optimizer's estimate comes first and alone settles large tables. It goes by compressed file sizes, so what
    looks small is then counted.
    """
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > limit:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    found = df.agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).first()
    return found.rows <= rows and (found.bytes or 0) <= limit
