"""Run history, failing checks, watermark lag and alerts over the control tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

ALERT_HOURS = 26
REJECT_RATE_LIMIT = 0.01
SLOW_FACTOR = 2.0
TRAILING_DAYS = 7
MESSAGE_LIMIT = 2000


def _moment(now: datetime | str) -> Column:
    return F.lit(now).cast("timestamp")


def run_history(events: DataFrame) -> DataFrame:
    """One row per run folded from its events.

    A failed run stays failed whatever is reported later, and a failure
    overrides an earlier success: failed > succeeded > running. The totals are
    those of the latest event that carries them.
    """
    failed = F.max(F.col("status") == "failed")
    succeeded = F.max(F.col("status") == "succeeded")
    finished = F.col("status") != "running"

    def latest(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("at")))

    return events.groupBy("run_id").agg(
        F.min_by("workflow", "at").alias("workflow"),
        F.min_by("source", "at").alias("source"),
        F.when(failed, "failed").when(succeeded, "succeeded").otherwise("running").alias("status"),
        F.min("at").alias("started_at"),
        F.max(F.when(finished, F.col("at"))).alias("finished_at"),
        F.coalesce(latest("rows_extracted"), F.lit(0)).alias("rows_extracted"),
        F.coalesce(latest("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(latest("rows_rejected"), F.lit(0)).alias("rows_rejected"),
        F.substring(
            F.max_by("error_message", F.when(F.col("status") == "failed", F.col("at"))),
            1,
            MESSAGE_LIMIT,
        ).alias("error_message"),
    )


def recent_runs(history: DataFrame, limit: int = 20) -> DataFrame:
    return history.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(limit)


def failing_checks(log: DataFrame, now: datetime | str, days: int = 7) -> DataFrame:
    since = _moment(now) - F.make_dt_interval(F.lit(days))
    return (
        log.filter(~F.col("passed") & (F.col("checked_at") > since))
        .select("check_name", "severity", "observed", "threshold", "checked_at")
        .orderBy(F.col("checked_at").desc(), "check_name")
    )


def latest_watermarks(entries: DataFrame) -> DataFrame:
    """Highest watermark per entity: an older entry can never move it back."""
    return entries.groupBy("entity").agg(
        F.max("watermark_ts").alias("watermark_ts"),
        F.max_by("run_id", "updated_at").alias("last_run_id"),
        F.max("updated_at").alias("updated_at"),
    )


def watermark_lag(watermarks: DataFrame, now: datetime | str) -> DataFrame:
    hours = (F.unix_micros(_moment(now)) - F.unix_micros("watermark_ts")) / F.lit(3_600_000_000.0)
    return (
        watermarks.select("entity", "watermark_ts", hours.alias("lag_hours"))
        .withColumn("alert", F.col("lag_hours") > ALERT_HOURS)
        .orderBy(F.col("lag_hours").desc(), "entity")
    )


def reject_rates(history: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("rows_rejected").cast("double"), F.col("rows_extracted").cast("double"))
    return history.select(
        "run_id", "workflow", "rows_extracted", "rows_rejected", rate.alias("reject_rate")
    ).withColumn("alert", F.coalesce(F.col("reject_rate") > REJECT_RATE_LIMIT, F.lit(False)))


def run_durations(history: DataFrame) -> DataFrame:
    """(run_id, workflow, started_at, seconds) of finished runs."""
    micros = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return history.filter(F.col("finished_at").isNotNull()).select(
        "run_id", "workflow", "started_at", (micros / F.lit(1_000_000.0)).alias("seconds")
    )


def slow_runs(durations: DataFrame) -> DataFrame:
    """Runs lasting over twice the median of the workflow's previous 7 days.

    ``durations`` holds (run_id, workflow, started_at, seconds), one row per
    run. Every run is copied into its own 7-day bucket and into the next one
    as history, which is all a trailing week can need; the sliding median then
    runs per (workflow, bucket), so one busy workflow is spread over time
    instead of passing through a single window task.
    """
    week = TRAILING_DAYS * 86_400_000_000
    micros = F.unix_micros("started_at")
    bucket = F.floor(micros / F.lit(week)).cast("bigint")
    copies = durations.select(
        "run_id",
        "workflow",
        "started_at",
        "seconds",
        micros.alias("at"),
        bucket.alias("own"),
        F.explode(F.array(bucket, bucket + 1)).alias("bucket"),
    )
    trailing = (
        Window.partitionBy("workflow", "bucket").orderBy("at").rangeBetween(-week, -1)
    )
    return (
        copies.withColumn("trailing_median", F.percentile("seconds", 0.5).over(trailing))
        .filter(F.col("own") == F.col("bucket"))
        .select("run_id", "workflow", "started_at", "seconds", "trailing_median")
        .withColumn(
            "alert",
            F.coalesce(F.col("seconds") > SLOW_FACTOR * F.col("trailing_median"), F.lit(False)),
        )
    )


def run_alerts(history: DataFrame, log: DataFrame, now: datetime | str) -> DataFrame:
    """Counts behind the paging rules: (alert, severity, count)."""
    since = _moment(now) - F.make_dt_interval(F.lit(0), F.lit(ALERT_HOURS))
    runs = history.agg(
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        (
            F.count_if((F.col("status") == "succeeded") & (F.col("finished_at") >= since)) == 0
        ).cast("bigint").alias("no_recent_success"),
    )
    failed = ~F.col("passed")
    checks = log.agg(
        F.count_if(failed & (F.col("severity") == "error")).alias("blocking_checks"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warning_checks"),
    )

    def rows(df: DataFrame, *named: tuple[str, str]) -> DataFrame:
        return df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(n).alias("alert"),
                            F.lit(s).alias("severity"),
                            F.col(n).alias("count"),
                        )
                        for n, s in named
                    ]
                )
            )
        )

    return rows(runs, ("failed_runs", "page"), ("no_recent_success", "page")).unionByName(
        rows(checks, ("blocking_checks", "page"), ("warning_checks", "ticket"))
    )
