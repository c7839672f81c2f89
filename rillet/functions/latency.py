"""Latencies and health."""

from pyspark.sql import Column, functions as F

from rillet.constants import DEFAULT_UNHEALTHY_LATENCY_MS


def epoch_millis(timestamp: Column) -> Column:
    """Milliseconds since the epoch of a UTC time (the session zone is UTC)."""
    return F.unix_millis(timestamp.cast("timestamp"))


def latency_ms(now: Column, since: Column) -> Column:
    """Milliseconds from ``since`` to ``now``; negative when the clock is behind, null without a time."""
    return epoch_millis(now) - epoch_millis(since)


def health(latency: Column, limit_ms: int = DEFAULT_UNHEALTHY_LATENCY_MS) -> Column:
    return F.when(latency > limit_ms, F.lit("unhealthy")).otherwise(F.lit("healthy"))
