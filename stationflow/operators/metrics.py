"""Service figures over readings: rates, errors, latency, lag and SLO share."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.times import interval, micros
from stationflow.operators.windows import tumbling, window_start

ERROR_BUDGET = 0.01
SLO_LIMIT = timedelta(seconds=2)

#: The latency percentile, and the low bits of a latency in microseconds (65 milliseconds).
PERCENTILE = (95, 100)
STEP_BITS = 16


def service_metrics(
    handled: DataFrame, size: timedelta = timedelta(hours=1), share: tuple[int, int] = PERCENTILE
) -> DataFrame:
    """Rate, error share and latency per service and window.

    Needs ``service, ts, arrival_ts, is_error``. All figures come from one aggregate that
    counts rows per service, window and latency; the percentile (``share`` as a fraction) is
    the smallest latency with so many rows at or below it, exact at any size. Rows without
    a latency count as handled only.
    """
    key = ["service", "window_start"]
    latency = (F.unix_micros("arrival_ts") - F.unix_micros("ts")).alias("_us")
    counted = handled.groupBy("service", window_start(size).alias("window_start"), latency).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("is_error")).alias("_errors")
    )
    # A step is one of the latencies' high digits: the ranking below meets few of them.
    stepped = counted.withColumn("_step", F.shiftright("_us", STEP_BITS))
    steps = stepped.groupBy(*key, "_step").agg(
        F.sum("_n").alias("_n"),
        F.sum("_errors").alias("_errors"),
        F.sum(F.col("_us") * F.col("_n")).alias("_total"),
        F.max("_us").alias("_max"),
    )
    known = F.sum(F.when(F.col("_step").isNotNull(), F.col("_n")))
    figures = steps.groupBy(*key).agg(
        F.sum("_n").alias("handled"),
        F.sum("_errors").alias("_errors"),
        (F.sum("_total") / F.lit(1000.0) / known).alias("avg_latency_ms"),
        (F.max("_max") / F.lit(1000.0)).alias("max_latency_ms"),
    )
    part, whole = share
    group = Window.partitionBy(*key)
    upto = group.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    # The step in which the rank lies, and how far into it.
    ranked = (
        steps.where(F.col("_step").isNotNull())
        .select(*key, "_step", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(group).alias("_all"))
        .withColumn("_rank", F.ceil(F.col("_all") * part / F.lit(whole)) - F.col("_upto") + F.col("_n"))
        .where((F.col("_rank") > 0) & (F.col("_rank") <= F.col("_n")))
        .select(*key, "_step", "_rank")
    )
    # At most 2^STEP_BITS different latencies of one step.
    within = Window.partitionBy(*key).orderBy("_us").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        stepped.join(ranked, [*key, "_step"])
        .select(*key, "_us", "_rank", F.sum("_n").over(within).alias("_upto"))
        .where(F.col("_upto") >= F.col("_rank"))
        .groupBy(*key)
        .agg((F.min("_us") / F.lit(1000.0)).alias("p95_latency_ms"))
    )
    return figures.join(chosen, key, "left").select(
        "service",
        "window_start",
        "handled",
        (F.col("handled") / F.lit(micros(size) / 1e6)).alias("rate_per_second"),
        (F.col("_errors") / F.col("handled")).alias("error_share"),
        "avg_latency_ms",
        "max_latency_ms",
        "p95_latency_ms",
    )


def slo_burn(
    handled: DataFrame,
    size: timedelta = timedelta(hours=1),
    limit: timedelta = SLO_LIMIT,
    budget: float = ERROR_BUDGET,
) -> DataFrame:
    """Share of rows handled within the limit, and error-budget burn."""
    within = F.col("arrival_ts") <= F.col("ts") + interval(limit)
    grouped = handled.groupBy(tumbling(size).alias("_w")).agg(
        F.count(F.lit(1)).alias("handled"), F.count_if(within).alias("within")
    )
    good = F.col("within") / F.col("handled")
    return grouped.select(
        F.col("_w.start").alias("window_start"),
        "handled",
        good.alias("good_share"),
        ((F.lit(1.0) - good) / F.lit(budget)).alias("budget_burn"),
    )


def topic_lag(rows: DataFrame, committed: DataFrame) -> DataFrame:
    """Newest offset minus committed offset, per topic and partition.

    ``committed`` has one row per partition; a partition without one has not
    been read yet, so its lag counts from before offset 0.
    """
    newest = rows.groupBy("topic", "partition").agg(F.max("offset").alias("newest"))
    return newest.join(committed, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "newest",
        (F.col("newest") - F.coalesce(F.col("committed"), F.lit(-1))).alias("lag"),
    )


def reason_counts(decoded: DataFrame) -> DataFrame:
    """Rejected rows per reason class."""
    return (
        decoded.where(F.col("reason_code").isNotNull())
        .groupBy("reason_code")
        .agg(F.count(F.lit(1)).alias("n"))
    )
