"""Zones of coordinates and epochs of training rows against plain versions."""

import random

from pyspark.sql import functions as F

from tarmac.operators import zones
from tarmac.sources import files

RINGS = {
    "b/square": [(0, 0), (4, 0), (4, 4), (0, 4)],
    "a/bay": [(2.5, -3.2), (9.1, -2), (8, 5.5), (5.2, 1.1), (3.3, 6.7)],
    "c/sliver": [(-5, -5), (-4.9, -5), (-1, 8), (-1.1, 8)],
}


def brute(x, y):
    for zone in sorted(RINGS):
        odd, ring = False, RINGS[zone]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        if odd:
            return zone
    return "UTC"


def test_zone_of_each_point(spark):
    rng = random.Random(4)
    points = [(rng.uniform(-7, 11), rng.uniform(-7, 10)) for _ in range(3000)] + [(float(x), float(y)) for x in range(-6, 10) for y in range(-6, 9)]
    rows = [(i, str(y), repr(x)) for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(rows + [(-1, "x", "1"), (-2, None, "1"), (-3, "500", "1")], "id int, latitude string, longitude string")
    df = df.withColumns({c: F.lit("own") for c in ("x", "cx", "zones")})
    shape = "zone string, ring array<struct<x:double,y:double>>"
    polygons = spark.createDataFrame([(z, [(float(x), float(y)) for x, y in r]) for z, r in RINGS.items()], shape)
    for cell in (1.0, 0.7):
        cells = zones.grid(polygons, cell)
        got = {r["id"]: r["tz"] for r in zones.with_zone(df, cells, cell=cell).collect()}
        assert (got.pop(-1), got.pop(-2), got.pop(-3)) == ("TIMEZONE", "TIMEZONE", "UTC")
        assert got == {i: brute(x, y) for i, (x, y) in enumerate(points)}
    inner = zones.grid(polygons, 0.5).where(F.exists("zones", lambda z: ~z["border"])).count()
    assert inner > 50


def test_epochs_hold_every_row_once_in_another_order(spark):
    rows = spark.createDataFrame([(i // 3, "z") for i in range(900)], "v int, epoch_name string").repartition(3).cache()
    out = files.epochs(rows, 3, seed=1).withColumn("place", F.monotonically_increasing_id()).cache()
    orders = []
    for epoch in range(3):
        found = [r["v"] for r in out.where(F.col("epoch") == epoch).orderBy("place").collect()]
        assert sorted(found) == [i // 3 for i in range(900)]
        orders.append(found)
    assert orders[0] != orders[1] != orders[2] and all(o != sorted(o) for o in orders)
    assert files.epochs(rows.where("false"), 2).count() == 0
    plan = files.epochs(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
