"""Regional scopes: the region whose box holds a reading.

Boxes are covered by cells of a quadtree, small boxes by small cells and large ones by
large cells, so every box makes about as many. A reading lies in one cell of each level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.plans.layout import BROADCAST_ROWS, broadcast_if_small

#: Scope of readings outside every box.
UNASSIGNED = "unassigned"
#: The finest level: 2^LEVELS cells around the globe, each 0.0003 degrees wide.
LEVELS = 20
#: A box is cut into 2^3 to 2^4 cells along its longer side, a narrow one into up to 2^5 to 2^6.
DEPTH, NARROW_DEPTH = 3, 5

_SIDES = ("min_lat", "max_lat", "min_lon", "max_lon")


def _index(degrees: Column, span: float) -> Column:
    """Cell of the finest level: whole numbers that never fall as degrees rise."""
    degrees = F.least(F.greatest(degrees, F.lit(-1000.0)), F.lit(1000.0))
    return F.floor((degrees + F.lit(span)) * F.lit(2.0**LEVELS / 360.0))


def _key(level: Column, row: Column, col: Column) -> Column:
    return (level * F.lit(1 << 44) + row * F.lit(1 << 22) + col).cast("bigint")


def cover(regions: DataFrame) -> DataFrame:
    """(level, cell, scope, box sides): the quadtree cells of each box, fewer than 200 a box.

    A cell of the box's own level that touches the box is replaced by the largest cell
    around it that touches nothing else.
    """
    rows = {"_r0": _index(F.col("min_lat"), 90.0), "_r1": _index(F.col("max_lat"), 90.0)}
    cols = {"_c0": _index(F.col("min_lon"), 180.0), "_c1": _index(F.col("max_lon"), 180.0)}
    high, wide = F.col("_r1") - F.col("_r0") + 1, F.col("_c1") - F.col("_c0") + 1
    longer, shorter = F.greatest(high, wide), F.least(high, wide)
    depth = F.least(F.lit(NARROW_DEPTH), F.lit(DEPTH) + F.floor(F.log2(longer / shorter)))
    # How many levels above the finest one the box's own cells are.
    above = F.greatest(F.lit(0), F.floor(F.log2(longer.cast("double"))) - depth).cast("int")
    placed = (
        regions.where(F.col("max_lat") >= F.col("min_lat"))
        .where(F.col("max_lon") >= F.col("min_lon"))
        .withColumns(rows | cols)
        .withColumn("_above", above)
        .withColumns({name: F.expr(f"shiftright({name}, _above)") for name in (*rows, *cols)})
        .withColumn("_row", F.explode(F.sequence("_r0", "_r1")))
        .withColumn("_col", F.explode(F.sequence("_c0", "_c1")))
    )

    def within(cell: str, first: str, last: str, up: int) -> str:
        start = f"shiftleft(shiftright({cell}, {up}), {up})"
        return f"{start} >= {first} and {start} + {(1 << up) - 1} <= {last}"

    up = F.lit(0)
    for k in range(1, NARROW_DEPTH + 2):
        fits = f"_above + {k} <= {LEVELS} and {within('_row', '_r0', '_r1', k)} and {within('_col', '_c0', '_c1', k)}"
        up = F.when(F.expr(fits), F.lit(k)).otherwise(up)
    merged = placed.withColumn("_up", up).withColumns(
        {"_row": F.expr("shiftright(_row, _up)"), "_col": F.expr("shiftright(_col, _up)")}
    )
    level = F.lit(LEVELS) - F.col("_above") - F.col("_up")
    cells = merged.select("scope", *_SIDES, level.alias("level"), _key(level, F.col("_row"), F.col("_col")).alias("cell"))
    return cells.distinct()


def _cell_at(level: int, lat: Column, lon: Column) -> Column:
    up = LEVELS - level
    return _key(F.lit(level), F.shiftright(_index(lat, 90.0), up), F.shiftright(_index(lon, 180.0), up))


def _scopes(boxes: Column, lat: Column, lon: Column) -> Column:
    """Scopes of the boxes that hold the point; ``unassigned`` if none does."""
    def holds(box: Column) -> Column:
        return (lat >= box["min_lat"]) & (lat < box["max_lat"]) & (lon >= box["min_lon"]) & (lon < box["max_lon"])

    found = F.transform(F.filter(boxes, holds), lambda box: box["scope"])
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(UNASSIGNED)))


def _by_level(points: DataFrame, cells: DataFrame, levels: list[int], small: bool) -> Column:
    """``points`` with ``_boxes``: those whose cells hold the point, a lookup for each level."""
    boxes = cells.groupBy("level", "cell").agg(F.collect_list(F.struct("scope", *_SIDES)).alias("_found"))
    for level in levels:
        side = boxes.where(F.col("level") == level).select(F.col("cell").alias(f"_cell_{level}"), F.col("_found").alias(f"_at_{level}"))
        points = points.withColumn(f"_cell_{level}", _cell_at(level, F.col("lat"), F.col("lon")))
        points = points.join(F.broadcast(side) if small else side, f"_cell_{level}", "left")
    none = F.array().cast("array<struct<scope:string,min_lat:double,max_lat:double,min_lon:double,max_lon:double>>")
    found = F.concat(none, *[F.coalesce(f"_at_{level}", none) for level in levels])
    return points.withColumn("_boxes", found).drop(*[f"{name}_{level}" for level in levels for name in ("_cell", "_at")])


def with_region(readings: DataFrame, regions: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``scope``, one row per region whose box contains the reading.

    A reading outside every box, or without a position, keeps its row, with the scope
    ``unassigned``. ``regions`` has ``scope, min_lat, max_lat, min_lon, max_lon``; a box
    holds its lower edges, not its upper ones.

    Cells are counted. Up to ``limit`` of them are broadcast, and readings are looked up where
    they are, once a level: no shuffle, whatever cell half of them are in. Beyond it the
    different positions are looked up by a shuffle, not the readings, which then join
    their position: broadcast if the positions are few, else left to the skew handling of
    adaptive execution.
    """
    sides = [F.col(name).cast("double").alias(name) for name in _SIDES]
    cells = cover(regions.select(F.col("scope").cast("string").alias("scope"), *sides))
    levels = {row.level: row.n for row in cells.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    ordered = sorted(levels)
    lat, lon = F.col("lat"), F.col("lon")
    if sum(levels.values()) <= limit:
        placed = _by_level(readings, cells, ordered, True)
        scope = F.explode(_scopes(F.col("_boxes"), lat, lon))
        return placed.withColumn("scope", scope).drop("_boxes").select(*readings.drop("scope").columns, "scope")
    positions = readings.where(lat.isNotNull() & lon.isNotNull()).select("lat", "lon").distinct()
    found = _by_level(positions, cells, ordered, False).select(
        F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), _scopes(F.col("_boxes"), lat, lon).alias("_scopes")
    )
    known = broadcast_if_small(found, positions.count(), limit)
    joined = readings.join(known, (lat == F.col("_lat")) & (lon == F.col("_lon")), "left")
    scope = F.explode(F.coalesce("_scopes", F.array(F.lit(UNASSIGNED))))
    return joined.withColumn("scope", scope).select(*readings.drop("scope").columns, "scope")
