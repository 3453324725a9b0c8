"""Names for the batches of a streaming query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Body = Callable[[DataFrame, str], None]


def named_batches(spark: SparkSession, checkpoint: str, body: Body) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that calls ``body(rows, name)``.

    The name joins the query id, which Spark keeps in the checkpoint, and the
    batch number. A restart from the checkpoint uses the same names again, so
    its writes replace their own rows; a query with a new checkpoint has a new
    id and never touches the rows of an older one.
    """
    query_id: list[str] = []

    def run(rows: DataFrame, number: int) -> None:
        if not query_id:
            query_id.append(spark.read.json(f"{checkpoint}/metadata").first()["id"])
        body(rows, f"{query_id[0]}-{number}")

    return run
