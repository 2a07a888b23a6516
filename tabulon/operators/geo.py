"""Point-in-polygon lookup as a grid-cell equi join.

Each polygon's bounding box is cut into grid cells; for each cell the
candidate polygons are kept as one array in priority order. A point computes
its own cell, equi-joins the cell table (at most one match, so no row
expansion and no regrouping afterwards) and picks the first candidate whose
ring contains it (even-odd ray casting, a JVM expression).

The cell table is broadcast only when the polygon edges it holds are under a
checked bound; beyond that it is a shuffle hash join on the cell key, where AQE's
skew handling splits a hot cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.geometry import contains
from tabulon.session import cut

BROADCAST_MAX_EDGES = 1_000_000  # of 32 bytes, over all cells


def polygon_cells(regions: DataFrame, cell: float, rank_cols: list,
                  name_col: str = "name", edges_col: str = "edges") -> DataFrame:
    """(cx, cy, candidates) with candidates sorted by ``rank_cols`` (Columns,
    ascending) then name."""
    cx = F.explode(F.sequence(F.floor(F.col("min_x") / cell), F.floor(F.col("max_x") / cell))).alias("cx")
    cy = F.explode(F.sequence(F.floor(F.col("min_y") / cell), F.floor(F.col("max_y") / cell))).alias("cy")
    ranked = regions.select(
        F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank_cols)], F.col(name_col).alias("rn"))
         .alias("rank"),
        F.col(name_col).alias("name"), F.col(edges_col).alias("edges"),
        "min_x", "min_y", "max_x", "max_y")
    cells = ranked.select("*", cx).select("*", cy)
    cand = F.struct("rank", "name", "edges", "min_x", "min_y", "max_x", "max_y")
    return (cells.groupBy("cx", "cy")
                 .agg(F.array_sort(F.collect_list(cand)).alias("candidates")))


def auto_cell_size(regions: DataFrame) -> float:
    """Half the median bounding-box side of the polygons: a polygon then
    covers a handful of cells, so the cell table grows with the number of
    polygons, not with their extent."""
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    med = regions.agg(F.percentile_approx(side, F.lit(0.5), 10_000).alias("m")).first()["m"]
    return float(med) / 2.0 if med and med > 0 else 1.0


def point_in_polygon(points: DataFrame, lon: str, lat: str, regions: DataFrame,
                     rank_cols: list, out_col: str = "region", cell: float | None = None,
                     name_col: str = "name") -> DataFrame:
    """Add ``out_col``: the name of the first polygon (by ``rank_cols``) that
    contains (lon, lat), or null when none does. ``cell=None`` picks the grid
    size from the polygons (``auto_cell_size``)."""
    if cell is None:
        cell = auto_cell_size(regions)
    cells = polygon_cells(regions, cell, rank_cols, name_col)
    cells = cut(cells)
    held = F.aggregate("candidates", F.lit(0).cast("bigint"), lambda a, c: a + F.size(c["edges"]))
    n_edges = cells.agg(F.sum(held).alias("n")).first()["n"] or 0  # size check (polygons, not points)
    side = F.broadcast(cells) if n_edges <= BROADCAST_MAX_EDGES else cells
    p = points.withColumn("_cx", F.floor(F.col(lon) / cell)).withColumn("_cy", F.floor(F.col(lat) / cell))
    j = p.join(side, (p["_cx"] == side["cx"]) & (p["_cy"] == side["cy"]), "left")
    px, py = F.col(lon), F.col(lat)
    hits = F.filter(F.coalesce(F.col("candidates"), F.array().cast(side.schema["candidates"].dataType)),
                    lambda c: (px >= c["min_x"]) & (px <= c["max_x"]) & (py >= c["min_y"])
                    & (py <= c["max_y"]) & contains(c["edges"], px, py))
    return j.select(*[F.col(c) for c in points.columns],
                    F.try_element_at(hits, F.lit(1))["name"].alias(out_col))
