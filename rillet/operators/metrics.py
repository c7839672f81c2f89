"""Counts and latencies, by batch and by reporting period."""

from decimal import ROUND_UP, Decimal

from pyspark.sql import Column, DataFrame, functions as F

from rillet import constants as C
from rillet.functions.latency import health, latency_ms


def good_bad_counts(rows: DataFrame, ok: Column) -> DataFrame:
    """One row: ``n``, ``good`` and ``bad``.  Skipped entities do not change the counts."""
    good = F.count_if(ok)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), good.alias("good"), (F.count(F.lit(1)) - good).alias("bad")
    )


def metric_columns(ok: Column, now: Column, source_time: str | None = None, line_bytes: Column | None = None) -> list[Column]:
    """Aggregates for a batch: counts, bytes, earliest event time, stream and end-to-end latency.

    The end-to-end latency is null when nothing was parsed.
    """
    line_bytes = F.octet_length("value") if line_bytes is None else line_bytes
    source_latency = latency_ms(now, F.min(source_time)) if source_time else F.lit(None).cast("bigint")
    earliest = F.min(F.when(F.col("parse_ok"), F.col("collector_tstamp")))
    good = F.count_if(ok)
    return [
        F.count(F.lit(1)).alias("n"),
        good.alias("good"),
        (F.count(F.lit(1)) - good).alias("bad"),
        F.coalesce(F.sum(line_bytes), F.lit(0)).alias("bytes"),
        earliest.alias("earliest"),
        F.coalesce(source_latency, F.lit(0)).alias("latency_ms"),
        latency_ms(now, earliest).alias("e2e_latency_ms"),
    ]


def metrics_report(batches: DataFrame, period: str = C.DEFAULT_METRICS_PERIOD) -> DataFrame:
    """Sums of counts and maxima of latencies for each period of the batch metrics."""
    return batches.groupBy(F.window("t", period)["start"].alias("period")).agg(
        F.sum("good").alias(C.METRIC_GOOD),
        F.sum("bad").alias(C.METRIC_BAD),
        F.max("latency_ms").alias(C.METRIC_LATENCY),
        F.max("e2e_latency_ms").alias(C.METRIC_E2E_LATENCY),
    )


def health_status(batches: DataFrame, limit_ms: int = C.DEFAULT_UNHEALTHY_LATENCY_MS) -> DataFrame:
    """Add ``status``: unhealthy above the latency limit."""
    return batches.withColumn("status", health(F.col("latency_ms"), limit_ms))


def parallelism(cores: int, factor: str = C.DEFAULT_CPU_FACTOR) -> int:
    """Cores times a factor, rounded up."""
    return int((cores * Decimal(str(factor))).to_integral_value(ROUND_UP))
