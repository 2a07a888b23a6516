"""Planar geometry as column expressions: even-odd ray casting.

A polygon ring is stored as ``ARRAY<STRUCT<x1,y1,x2,y2>>`` (its edges), so a
point-in-ring test is one ``aggregate`` over the array -- a JVM expression,
no geometry library per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_edges(xs: list[float], ys: list[float]) -> list[tuple[float, float, float, float]]:
    """Closed ring vertices to edge tuples (the last vertex joins the first)."""
    n = len(xs)
    return [(float(xs[i]), float(ys[i]), float(xs[(i + 1) % n]), float(ys[(i + 1) % n]))
            for i in range(n)]


def ring_area(xs: list[float], ys: list[float]) -> float:
    """Shoelace area (absolute)."""
    n = len(xs)
    return abs(sum(xs[i] * ys[(i + 1) % n] - xs[(i + 1) % n] * ys[i] for i in range(n))) / 2.0


def crossings(edges, px, py) -> Column:
    """Number of ring edges a ray from (px, py) towards +x crosses."""
    edges = F.col(edges) if isinstance(edges, str) else edges
    px = F.col(px) if isinstance(px, str) else px
    py = F.col(py) if isinstance(py, str) else py

    def step(acc, e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(edges, F.lit(0), step)


def contains(edges, px, py) -> Column:
    """Even-odd rule: inside when the crossing count is odd."""
    return (crossings(edges, px, py) % 2) == 1


# The same crossing predicate written for SQL oracles (edge table e, point p).
CROSSING_SQL = ("CASE WHEN ((e.y1 > {py}) <> (e.y2 > {py})) AND "
                "({px} < (e.x2 - e.x1) * ({py} - e.y1) / (e.y2 - e.y1) + e.x1) THEN 1 ELSE 0 END")
