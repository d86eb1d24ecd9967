"""Size checks that decide between a broadcast-friendly and a shuffled plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, from its optimised plan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast limit in bytes; -1 when broadcasts are off."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark would itself be willing to broadcast ``df``."""
    return 0 <= estimated_bytes(df) <= broadcast_limit(df)
