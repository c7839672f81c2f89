"""Health of the services a load depends on, from one row of status per batch and service."""

from pyspark.sql import DataFrame, Window, functions as F

from rillet import constants as C
from rillet.functions.alerts import alert_text, service_label
from rillet.functions.errors import error_class
from rillet.functions.latency import health
from rillet.functions.texts import clean_error_text

#: Services of a load: the events table, the sink of failed events, and the source with its delay.
TABLE, FAILED_EVENTS, SOURCE = "table", "failed_events", "source"
STATUS = "t TIMESTAMP_NTZ, batch_id BIGINT, service STRING, failed BOOLEAN, latency_ms BIGINT, cause STRING"
#: What a failed status says for an alert: its type, the columns it is about, and whether the set-up is wrong.
BLAME = "alert_type STRING, columns ARRAY<STRING>, setup BOOLEAN"


def service_states(statuses: DataFrame, limit_ms: int = C.DEFAULT_UNHEALTHY_LATENCY_MS) -> DataFrame:
    """Add ``state`` after each status, ``changed`` where it differs from the one before, and ``message``.

    A service is unhealthy after a failure and until its next success; the source also while its latency is above the limit.
    A service starts healthy.  A row of a service follows another by time, then batch; of one time and
    batch a failure counts after a success.  ``message`` says what is wrong, null for a healthy service.
    """
    state = F.when(F.col("failed"), F.lit("unhealthy")).otherwise(health(F.coalesce("latency_ms", F.lit(0)), limit_ms))
    before = Window.partitionBy("service").orderBy("t", "batch_id", "failed")
    label = F.coalesce(service_label(F.col("service")), F.col("service"))
    message = F.when(F.col("failed"), F.concat(label, F.lit(": "), F.coalesce("cause", F.lit("failed"))))
    late = F.concat(label, F.lit(": latency of "), F.col("latency_ms").cast("string"), F.lit(" ms"))
    rows = statuses.withColumn("state", state)
    rows = rows.withColumn("changed", F.col("state") != F.coalesce(F.lag("state").over(before), F.lit("healthy")))
    return rows.withColumn("message", F.when(F.col("state") == "unhealthy", F.coalesce(message, late)))


def health_report(statuses: DataFrame, limit_ms: int = C.DEFAULT_UNHEALTHY_LATENCY_MS) -> DataFrame:
    """One row per service: its state, since when (null if it never changed), how often it became unhealthy,
    failures, and the message of its last status.

    There is one status per micro-batch and service, so the window of a service is small next to the events.
    """
    rows = service_states(statuses, limit_ms)
    order = F.struct("t", "batch_id", "failed")
    return rows.groupBy("service").agg(
        F.max_by("state", order).alias("state"),
        F.max(F.when(F.col("changed"), F.col("t"))).alias("since"),
        F.count_if(F.col("changed") & (F.col("state") == "unhealthy")).alias("times_unhealthy"),
        F.count_if("failed").alias("failures"),
        F.max_by("message", order).alias("message"),
    )


def alerts(
    statuses: DataFrame, db: str = "", schema: str = "", destination: str = "warehouse", pipeline: str = "the event pipeline"
) -> DataFrame:
    """One row per alert: ``t``, ``batch_id``, ``service`` and ``alert``, the text.

    A failure is worth an alert if the set-up is wrong; one that may pass by itself only makes its service
    unhealthy.  While a service goes on failing with the same text it gives no further alert; a success or a
    passing failure in between, or another text, does.  Failures of no known alert type give none.
    """
    cause = F.coalesce(clean_error_text(F.col("cause")), F.lit("failed"))
    is_setup = error_class(F.when(F.col("failed") & F.col("setup"), cause)) == "setup"
    text = alert_text(F.col("alert_type"), F.lit(db), F.lit(schema), F.col("columns"), cause, destination, pipeline)
    order = Window.partitionBy("service").orderBy("t", "batch_id", "failed", "alert")
    said = statuses.withColumn("alert", F.when(is_setup, text))
    said = said.withColumn("before", F.lag("alert").over(order))
    new = F.col("alert").isNotNull() & ~F.col("alert").eqNullSafe(F.col("before"))
    return said.filter(new).select("t", "batch_id", "service", "alert")
