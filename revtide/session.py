"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings only, so they can be applied to a session somebody else
# built.  Adaptive execution merges small reducers and splits skewed join
# partitions; dates are taken from timestamps in UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Adaptive execution only merges reducers, so a shuffle has to start with
#: enough of them: 8,192 hold 100 TB at 12 GB each, read and sorted with spills.
REDUCERS = 8192
_REDUCERS_START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

#: Where scratch tables go if the cluster does not name a checkpoint folder.
SCRATCH = "revtide.scratch.dir"


def configure(spark: SparkSession, reducers: int = REDUCERS) -> SparkSession:
    """Apply the settings; a number of shuffle partitions somebody set is kept."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if all(spark.conf.get(key, None) is None for key in ("spark.sql.shuffle.partitions", _REDUCERS_START)):
        spark.conf.set(_REDUCERS_START, str(reducers))
    return spark


#: Whether Spark removes the shuffle files of an action when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the write that made them, not when the driver's memory is next collected.

    For code that writes what it computes; a frame on which a second action runs
    would be shuffled again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def scratch_base(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder that the session names."""
    base = scratch_base(spark)
    if not base:
        raise ValueError(f"set spark.checkpoint.dir or {SCRATCH} to a folder all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
