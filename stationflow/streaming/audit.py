"""Running totals of streaming queries, from their progress reports.

Spark reports a batch after its sinks have taken it and its checkpoint has moved on, so
what is reported was handled, whatever the outputs are: files, Kafka or a handler of the
caller. The listener adds the reports of a run up and keeps one small file for each run.
"""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql import types as T

from stationflow.sources import files

AUDIT = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("last_batch", T.LongType()),
        T.StructField("batches", T.LongType()),
        T.StructField("last_at", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("slowest_ms", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
        T.StructField("positions", T.ArrayType(T.StringType())),
    ]
)


class AuditListener(StreamingQueryListener):
    """Writes totals of rows, batches and observed metrics below ``path``, run by run.

    Observed metrics are named ``observation.metric`` and have to be counts. Register it
    with ``spark.streams.addListener``. A run that is killed loses at most the report that
    was on its way.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._totals: dict[str, dict] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        report = event.progress
        observed = {
            f"{name}.{metric}": int(value or 0)
            for name, row in report.observedMetrics.items()
            for metric, value in row.asDict().items()
        }
        # A trigger that found nothing repeats the number of the batch to come.
        if not report.numInputRows and not any(observed.values()):
            return
        run = str(report.runId)
        total = self._totals.setdefault(
            run,
            {"query": str(report.id), "run": run, "name": report.name, "batches": 0, "rows": 0, "slowest_ms": 0, "metrics": {}},
        )
        before = total.get("last_batch")
        if before is not None and report.batchId <= before:
            return
        total |= {"last_batch": report.batchId, "last_at": report.timestamp, "batches": total["batches"] + 1}
        total["rows"] += report.numInputRows
        # Where each source is read up to, as the source writes it.
        total["positions"] = [source.endOffset for source in report.sources]
        total["slowest_ms"] = max(total["slowest_ms"], report.durationMs.get("triggerExecution", 0))
        for name, value in observed.items():
            total["metrics"][name] = total["metrics"].get(name, 0) + value
        # The new total first, then the old one goes: readers take the last batch of a run.
        files.write_new(self._spark, f"{self._path}/{run}-{report.batchId}.json", json.dumps(total))
        if before is not None:
            files.delete(self._spark, f"{self._path}/{run}-{before}.json")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()

    def await_run(self, run: str, timeout: float = 60) -> bool:
        """Wait until all reports of an ended run are written: they arrive a little after its end."""
        return self._end_of(str(run)).wait(timeout)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The totals of each run, one row for a run; no rows before the first report."""
    try:
        rows = spark.read.schema(AUDIT).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], AUDIT)
    return rows.groupBy("query", "run").agg(
        *[F.max_by(name, "last_batch").alias(name) for name in AUDIT.names if name not in ("query", "run")]
    )


def metric_totals(audit: DataFrame) -> DataFrame:
    """(query, metric, n): observed counts of all runs of each query, ``rows`` among them."""
    rows = audit.select("query", F.explode(F.map_concat("metrics", F.create_map(F.lit("rows"), "rows"))).alias("metric", "n"))
    return rows.groupBy("query", "metric").agg(F.sum("n").alias("n"))


def kafka_positions(audit: DataFrame) -> DataFrame:
    """(query, topic, partition, committed): the last offset read of each Kafka partition, for ``topic_lag``.

    From the newest run of each query. Positions of other sources are passed over.
    """
    newest = audit.groupBy("query").agg(F.max_by("positions", "last_at").alias("positions"))
    kind = "map<string,map<string,bigint>>"
    topics = newest.select("query", F.explode("positions").alias("at")).select("query", F.explode(F.from_json("at", kind)).alias("topic", "ends"))
    ends = topics.select("query", "topic", F.explode("ends").alias("number", "end"))
    return ends.select("query", "topic", F.col("number").try_cast("int").alias("partition"), (F.col("end") - 1).alias("committed")).where(
        F.col("partition").isNotNull()
    )


def rows_behind(topic: DataFrame, audit: DataFrame, query: str) -> DataFrame:
    """(query, newest, read, lag): rows of a file topic, those a query has read, and the rest.

    For topics that lose no rows to retention between the two counts.
    """
    read = audit.where(F.col("query") == query).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("read"))
    counted = topic.agg(F.count(F.lit(1)).alias("newest")).withColumn("read", read.scalar())
    return counted.select(F.lit(query).alias("query"), "newest", "read", (F.col("newest") - F.col("read")).alias("lag"))
