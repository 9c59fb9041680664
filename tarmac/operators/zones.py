"""Time zones of coordinates: polygons cut into grid cells, rays cast in border cells only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _edges(ring: str) -> Column:
    """Edges of a closed or open ring of (x, y) points."""
    points = F.col(ring)
    after = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    return F.zip_with(points, after, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def _inside(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point to the east meets an odd number of edges."""
    met = F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (
        x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.size(met) % 2 == 1


def grid(polygons: DataFrame, cell: float = 1.0) -> DataFrame:
    """(zone, ring) polygons as cells: cx, cy and `zones`, those that have a part in the cell, in order of name.

    A cell that no edge comes near lies in a zone or not, and needs no edges.  A border
    cell keeps the edges that a ray to the east from inside it can meet.
    """
    size = F.lit(float(cell))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    span = lambda v: F.explode(F.sequence(F.floor(F.array_min(v) / size), F.floor(F.array_max(v) / size)))
    cells = polygons.select("zone", _edges("ring").alias("edges"), xs.alias("xs"), ys.alias("ys"))
    cells = cells.select("zone", "edges", "ys", span(F.col("xs")).alias("cx")).select("zone", "edges", "cx", span(F.col("ys")).alias("cy"))
    low, bottom = F.col("cx") * size, F.col("cy") * size
    level = lambda e: (F.greatest(e["y1"], e["y2"]) >= bottom) & (F.least(e["y1"], e["y2"]) <= bottom + size)
    eastern = F.filter("edges", lambda e: level(e) & (F.greatest(e["x1"], e["x2"]) >= low))
    near = F.filter("edges", lambda e: level(e) & (F.greatest(e["x1"], e["x2"]) >= low) & (F.least(e["x1"], e["x2"]) <= low + size))
    border = F.size(near) > 0
    found = cells.where(border | _inside(F.col("edges"), low + size / 2, bottom + size / 2)).select(
        "cx", "cy", F.struct(F.col("zone"), border.alias("border"), F.when(border, eastern).alias("edges")).alias("part"))
    return found.groupBy("cx", "cy").agg(F.array_sort(F.collect_list("part")).alias("zones"))


def with_zone(rows: DataFrame, cells: DataFrame, latitude: str = "latitude", longitude: str = "longitude", cell: float = 1.0) -> DataFrame:
    """Add, or replace, `tz`: the first zone, by name, that holds the coordinates.

    Coordinates in no zone are in UTC; those that are no numbers give 'TIMEZONE'.  Rows
    meet the one row of their cell, so nothing is paired with polygons.
    """
    y, x = (F.col(c).try_cast("double") for c in (latitude, longitude))
    own = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), x.alias("x"), y.alias("y"))
    own = own.withColumns({"cx": F.floor(F.col("x") / F.lit(float(cell))), "cy": F.floor(F.col("y") / F.lit(float(cell)))})
    met = own.join(cells, ["cx", "cy"], "left")
    holds = F.filter("zones", lambda z: ~z["border"] | _inside(z["edges"], F.col("x"), F.col("y")))
    zone = F.get(holds, F.lit(0))["zone"]
    readable = F.col("x").isNotNull() & F.col("y").isNotNull()
    found = met.select("row", F.when(~readable, "TIMEZONE").otherwise(F.coalesce(zone, F.lit("UTC"))).alias("tz"))
    return found.select(*[F.col("row")[c].alias(c) for c in rows.columns if c != "tz"], "tz")
