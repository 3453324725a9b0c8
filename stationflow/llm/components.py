"""Connected components of a graph whose edges are a DataFrame.

Every round each node takes the smallest label among its own and its neighbours' (a
minimum that shrinks before the shuffle, so a node with very many edges is no hot spot)
and then the label of its label. Both are written to the checkpoint folder, as each has several readers.
A node with very many edges, or a label that very many nodes carry, is dealt over several keys of the join;
edges are dealt once, before the first round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed

#: Rows of one key that meet in one key of a dealt join.
DEALT = 512
#: Keys known to be dealt, at most: they are broadcast (16 bytes each).
LARGE_KEYS = 1_000_000


def _parts(rows: DataFrame, key: str, total: int) -> DataFrame:
    """(key, _parts) for each key with more than ``DEALT`` of ``total`` rows: keys above the border cannot be more than ``LARGE_KEYS``."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > max(DEALT, total // LARGE_KEYS))
    return sizes.select(key, F.ceil(F.col("_size") / DEALT).cast("int").alias("_parts"))


def _dealt(rows: DataFrame, large: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with ``_part``: that of its key, by a hash of ``by``."""
    mine = F.pmod(F.xxhash64(by, F.lit(7)), F.coalesce("_parts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(large), key, "left").withColumn("_part", mine).drop("_parts")


def _copies(unique: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """A copy of each row of ``unique`` for each part of its key."""
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    return unique.join(F.broadcast(large), key, "left").withColumn("_part", each).drop("_parts")


def join_dealt(rows: DataFrame, unique: DataFrame, key: str, by: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``unique``, which has one row at most for each ``key``.

    A key with more than ``DEALT`` rows is cut into parts by a hash of ``by``, and its one
    partner is copied for each part. ``total`` is the number of ``rows``. Null keys find no partner.
    """
    large = _parts(rows, key, total)
    return _dealt(rows, large, key, by).join(_copies(unique, large, key), [key, "_part"], "left").drop("_part")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of an edge; the component is its smallest node.

    Edges are undirected; loops and repeated edges are fine. No edges, no rows. The edges
    are computed once.
    """
    one_way, back = F.struct(F.col(a).alias("node"), F.col(b).alias("other")), F.struct(F.col(b).alias("node"), F.col(a).alias("other"))
    both = checkpointed(edges.select(F.explode(F.array(one_way, back)).alias("edge")).select("edge.node", "edge.other").distinct())
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component"))
    total, edges_ = labels.count(), both.count()
    large = _parts(both, "node", edges_)
    some = not large.isEmpty()
    if some:
        large = checkpointed(large, edges_ // DEALT)
        both = checkpointed(_dealt(both, large, "node", "other"), edges_)
    while True:
        # The label of each node goes to its neighbours, and to those that carry its name.
        offers = both.join(_copies(labels, large, "node"), ["node", "_part"]) if some else both.join(labels, "node")
        offers = offers.select(F.col("other").alias("node"), "component")
        nearest = checkpointed(offers.unionByName(labels).groupBy("node").agg(F.min("component").alias("component")), total)
        change = nearest.join(labels.withColumnRenamed("component", "_old"), "node").where(F.col("component") != F.col("_old"))
        # Neighbours of one label: no label can change any more.
        if change.isEmpty():
            return nearest
        jump = nearest.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = join_dealt(nearest, jump, "component", "node", total).select(
            "node", F.least("component", "further").alias("component")
        )
        labels = checkpointed(moved, total)
