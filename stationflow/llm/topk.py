"""Exact top k by inner product, term at a time.

A vector is a sparse row of integer weights, a dimension is a term. Within a task the
candidates of a block are turned into postings: for each term the places and weights of
the candidates that have it. Each query then scatters its weight times the posting into a
dense row of scores, term after term; a partition selection keeps the k best, and the
winners of all blocks are merged by query.

Queries and candidates meet in a grid: query blocks are copied to all candidate blocks
and the other way round, so a task holds one block of each, however large the tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import common  # noqa: F401  (ships this package with the job)

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16_384
#: Queries whose score rows are held at once.
TILE = 64


def weights(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale))
    return F.when(vector.isNotNull() & ~F.coalesce(F.exists(vector.cast("array<double>"), bad), F.lit(True)), whole)


def _dense(rows: pd.Series) -> np.ndarray:
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of a tile of queries against a block: scatter posting after posting."""
    out = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        asking = np.flatnonzero(queries[:, term])
        places = np.flatnonzero(candidates[:, term])
        if not len(asking) or not len(places):
            continue
        posting = candidates[places, term]
        full = len(places) == len(candidates)
        for q in asking:
            if full:
                out[q] += queries[q, term] * posting
            else:
                out[q, places] += queries[q, term] * posting
    return out


def _best(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    candidates = candidates.sort_values("vec_id", kind="stable")
    ids = candidates["vec_id"].to_numpy()
    have, want = _dense(candidates["weights"]), _dense(queries["weights"])
    asked = queries["vec_id"].to_numpy()
    found = []
    for at in range(0, len(asked), TILE):
        scores = _scores(want[at : at + TILE], have)
        for query, row in zip(asked[at : at + TILE], scores, strict=True):
            other = ids != query
            pool, names = row[other], ids[other]
            if len(pool) > k:
                least = np.partition(pool, len(pool) - k)[len(pool) - k]
                above = np.flatnonzero(pool > least)
                # Candidates are in id order, so the first ties are those with the smaller ids.
                chosen = np.concatenate([above, np.flatnonzero(pool == least)[: k - len(above)]])
                pool, names = pool[chosen], names[chosen]
            found.append(pd.DataFrame({"query_id": query, "vec_id": names, "score": pool}))
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    return pd.concat(found or [empty], ignore_index=True)


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK
) -> DataFrame:
    """The k best candidates of each query, as (query_id, rank, vec_id, score).

    Both tables have ``vec_id`` long and ``weights`` array of long (other columns are not
    read). Candidates with the query's vec_id are the query itself. Rows with a null id
    or null weights take no part; every other row does, also of rows that share an id: a
    candidate id comes once for each of its rows, and the rows of a query id compete for
    its k places. Vectors may differ in length: missing components are zero. Ties
    go to the smaller vec_id. Scores are 64-bit; a larger inner product is out of range.
    """
    ready = [
        df.select(F.col("vec_id").cast("long"), F.col("weights").cast("array<bigint>").alias("weights"))
        .where(F.col("vec_id").isNotNull() & F.col("weights").isNotNull())
        .withColumn("row", F.monotonically_increasing_id())
        for df in (queries, candidates)
    ]
    columns = [max(1, -(-df.count() // size)) for df, size in zip(ready, (query_block, candidate_block), strict=True)]
    # By the row, not by its id: rows that share one do not meet in one block.
    mine = [F.pmod(F.xxhash64("row"), F.lit(n)).cast("int") for n in columns]
    other = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in columns]
    asked = ready[0].select("vec_id", "weights", mine[0].alias("q"), other[1].alias("c"))
    held = ready[1].select("vec_id", "weights", other[0].alias("q"), mine[1].alias("c"))
    found = (
        asked.groupBy("q", "c")
        .cogroup(held.groupBy("q", "c"))
        .applyInPandas(lambda a, b: _best(a, b, k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
