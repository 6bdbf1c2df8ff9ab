"""Point-in-polygon join: the smallest zone that holds each point.

The index cuts each zone to grid cells. A cell keeps the edges that pass through it; of the edges east of it, which a ray from any of its
points may cross, only the latitudes at which their parity changes. Edges that follow each other share a vertex, whose two changes cancel, so next to
nothing is left: a cell inside a zone holds one number, however many vertices the ring has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import ring_area, ring_bounds, ring_crossings, ring_edges
from ..session import cut_lineage
from .skew import find_hot, lookup_join

CELL_DEGREES = 0.05
ZONE_CELLS = 4096  # grid cells of one zone; a larger zone goes to a coarser grid
LEVEL_STEP = 8  # how much coarser the next grid is
BROADCAST_BYTES = 64_000_000  # an index up to this measured size is broadcast
MARGIN = 1e-9  # degrees around an edge in which rounding may decide the side
ALWAYS = float("inf")  # a parity change north of all points of a cell


def zone_cells(zones: DataFrame, ring: str, cell: float = CELL_DEGREES) -> DataFrame:
    """One row per zone and cell that has a part of it, on the finest grid where its bounding box has at most `ZONE_CELLS` cells.

    `_level` numbers the grid: its cells are `cell * LEVEL_STEP ** _level` wide. A country costs no more cells than a city block. `_edges` are the
    edges that pass through the cell, `_turns` the latitudes below which the parity of the edges east of it changes; a point is inside
    if it has an odd number of crossings with the first and of the second north of it. Equal rows of `zones` count once.
    """
    west, east, south, north = ring_bounds(ring)
    span = F.sqrt((F.col("_e") - F.col("_w") + cell) * (F.col("_n") - F.col("_s") + cell)) / (cell * ZONE_CELLS**0.5 / 2)
    level = F.greatest(F.lit(0.0), F.ceil(F.log(float(LEVEL_STEP), span)).cast("double"))
    row = F.struct(*zones.columns)
    named = (
        zones.withColumns({"_za": F.xxhash64(row), "_zb": F.xxhash64(row, F.lit(1)), "_edges": ring_edges(ring)})
        .dropDuplicates(["_za", "_zb"])
        .withColumns({"_w": west, "_e": east, "_s": south, "_n": north})
        .withColumns({"_area": ring_area("_edges"), "_level": level})
        .withColumn("_width", F.lit(cell) * F.pow(F.lit(float(LEVEL_STEP)), F.col("_level")))
    )
    head = F.struct(*[c for c in zones.columns if c != ring], "_area", "_level")  # goes along with each edge: cheaper than joining it back
    at = lambda v: F.floor(v / F.col("_width")).cast("long")
    zone = ["_za", "_zb", "_width", "_head"]
    named = named.withColumn("_head", head)
    edges = named.select(*zone, at(F.col("_w")).alias("_first"), F.explode("_edges").alias("_edge")).select(*zone, "_first", "_edge", "_edge.*")
    edges = edges.filter(F.col("y1") != F.col("y2"))  # no ray to the east crosses a level edge
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    bands = edges.withColumn("_cy", F.explode(F.sequence(at(low), at(high))))
    # the edge's part within the band
    x_at = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
    a = x_at(F.greatest(low, F.col("_cy") * F.col("_width")))
    b = x_at(F.least(high, (F.col("_cy") + 1) * F.col("_width")))
    inside = lambda x: F.least(F.greatest("x1", "x2"), F.greatest(F.least("x1", "x2"), x))
    bands = bands.withColumns({"_from": at(F.least(inside(a), inside(b)) - MARGIN), "_to": at(F.greatest(inside(a), inside(b)) + MARGIN)})
    local = bands.select(*zone, F.explode(F.sequence(F.greatest("_from", "_first"), F.greatest("_to", "_first"))).alias("_cx"), "_cy", "_edge")
    # west of `_from` the edge only changes the parity at its two ends; an end south of the band changes nothing
    ends = bands.select(*zone, "_first", "_from", "_cy", F.explode(F.array("y1", "y2")).alias("_y"))
    ends = ends.filter((at(F.col("_y")) >= F.col("_cy")) & (F.col("_from") > F.col("_first")))
    ends = ends.withColumn("_y", F.when(at(F.col("_y")) > F.col("_cy"), F.lit(ALWAYS)).otherwise(F.col("_y")))
    # changes at one latitude cancel in pairs: those of the 1st and 2nd, 3rd and 4th, ... `_from` from the east hold between these two
    changes = ends.groupBy("_za", "_zb", "_cy", "_y").agg(
        F.first("_head").alias("_head"), F.first("_width").alias("_width"), F.min("_first").alias("_first"), F.sort_array(F.collect_list("_from"), asc=False).alias("_far")
    )
    pairs = F.transform(F.sequence(F.lit(0), F.size("_far") - 1, F.lit(2)), lambda k: F.struct(
        F.coalesce(F.get("_far", k + 1), F.col("_first")).alias("a"), F.get("_far", k).alias("b")
    ))
    turns = changes.select(*zone, "_cy", "_y", F.explode(pairs).alias("_p")).filter("_p.a < _p.b")
    turns = turns.select(*zone, F.explode(F.sequence(F.col("_p.a"), F.col("_p.b") - 1)).alias("_cx"), "_cy", "_y")
    parts = local.unionByName(turns, allowMissingColumns=True).groupBy("_za", "_zb", "_cx", "_cy").agg(
        F.first("_head").alias("_head"), F.collect_list("_edge").alias("_edges"), F.collect_list("_y").alias("_turns")
    )
    return parts.select("_head.*", "_cx", "_cy", "_edges", "_turns")


def zone_join_many(
    points: DataFrame, zones: DataFrame, ends: list[tuple[str, str, dict[str, str]]], ring: str, name: str,
    cell: float = CELL_DEGREES,
) -> DataFrame:
    """For each end (longitude, latitude, outputs from zone columns) the columns of the smallest zone that holds it.

    Every row comes back once, whatever its ids. The zones of a cell are one list, smallest first and then by name, and a point takes the
    first of its cell's list that holds it. The lists are written once and measured; up to `BROADCAST_BYTES` they are broadcast, so no point is
    shuffled, otherwise they are joined by cell with busy cells spread. NULL outside all zones and without coordinates.
    """
    wanted = sorted({c for _, _, outputs in ends for c in outputs.values()})
    cells = zone_cells(zones, ring, cell)
    entry = F.struct(
        F.col("_area").alias("area"), F.col(name).alias("name"), F.col("_edges").alias("edges"), F.col("_turns").alias("turns"), F.struct(*wanted).alias("zone")
    )
    lists = cut_lineage(_lists(cells, entry))
    sizes = {r[0]: r[1] for r in lists.groupBy("_level").agg(F.sum(_bytes("_zones"))).collect()}  # one row per grid, of which there are few
    few = sum(sizes.values()) <= BROADCAST_BYTES
    out = points
    for i, (lon, lat, outputs) in enumerate(ends):
        found = []
        for level in sorted(sizes):
            mark = f"_z{i}_{int(level)}"
            width = cell * LEVEL_STEP**level
            own = lists.filter(F.col("_level") == level).select(
                F.col("_cx").alias(mark + "x"), F.col("_cy").alias(mark + "y"), F.col("_zones").alias(mark)
            )
            out = out.withColumns({mark + "x": F.floor(F.col(lon) / width).cast("long"), mark + "y": F.floor(F.col(lat) / width).cast("long")})
            keys = [mark + "x", mark + "y"]
            out = out.join(F.broadcast(own), keys, "left") if few else lookup_join(out, own, keys, "left", find_hot(out, keys))
            holding = F.filter(F.col(mark), lambda z: _holds(z, lon, lat))
            out = out.withColumn(mark, F.try_element_at(holding, F.lit(1))).drop(*keys)
            found.append(mark)
        best = _best([F.col(m) for m in found]) if found else F.lit(None)
        out = out.withColumns({o: (best["zone"][c] if found else F.lit(None).cast("string")) for o, c in outputs.items()}).drop(*found)
    return out


def _holds(zone: Column, lon: str, lat: str) -> Column:
    """Whether a cell's part of a zone holds a point of the cell."""
    turns = F.aggregate(zone["turns"], F.lit(0), lambda n, y: n + F.when(y > F.col(lat), 1).otherwise(0))
    return (ring_crossings(zone["edges"], lon, lat) + turns) % 2 == 1


def _bytes(lists: str) -> Column:
    """About the size of a cell's list in memory."""
    one = lambda z: 200 + 48 * F.size(z["edges"]) + 8 * F.size(z["turns"]) + 4 * F.length(F.to_json(z["zone"]))
    return F.lit(100) + F.aggregate(lists, F.lit(0).cast("long"), lambda n, z: n + one(z))


def _smaller(a: Column, b: Column) -> Column:
    """Order of two zones: area, then name."""
    by_name = F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0)
    return F.when(a["area"] < b["area"], -1).when(a["area"] > b["area"], 1).otherwise(by_name)


def _lists(cells: DataFrame, entry: Column) -> DataFrame:
    """The zones of each cell, smallest first; a cell holds the zones that overlap there."""
    return cells.groupBy("_level", "_cx", "_cy").agg(F.array_sort(F.collect_list(entry), _smaller).alias("_zones"))


def _best(found: list[Column]) -> Column:
    best = found[0]
    for other in found[1:]:
        best = F.when(best.isNull() | (other.isNotNull() & (_smaller(other, best) < 0)), other).otherwise(best)
    return best


def zone_join(
    points: DataFrame, zones: DataFrame, lon: str, lat: str, ring: str, name: str, carried: dict[str, str],
    cell: float = CELL_DEGREES,
) -> DataFrame:
    """`zone_join_many` for one pair of coordinates; `carried` maps outputs to zone columns."""
    return zone_join_many(points, zones, [(lon, lat, carried)], ring, name, cell)
