"""Model inputs as ML pipeline stages and native expressions."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.keys import hash_bucket

# Numeric inputs, carrier vocabulary and coordinate ranges of the model.
REAL_COLUMNS = [
    "dep_delay", "taxiout", "distance", "avg_dep_delay", "avg_arr_delay",
    "dep_lat", "dep_lon", "arr_lat", "arr_lon",
]
CARRIER_VOCABULARY = [
    "AS", "VX", "F9", "UA", "US", "WN", "HA", "EV", "MQ", "DL", "00", "86", "NK", "AA",
]
AIRPORT_BUCKETS = 1000
LATITUDES, LONGITUDES = (20.0, 50.0), (-120.0, -70.0)
BASE_FEATURES = ("dep_delay", "taxi_out", "distance")


def assembler(columns, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def cut_points(low: float, high: float, n: int) -> list[float]:
    """`n` evenly spaced boundaries from `low` to `high`."""
    return [low + (high - low) * i / (n - 1) for i in range(n)]


def location_buckets(n: int) -> list[Bucketizer]:
    """Coordinates to bucket numbers 0..n; values outside the range get the end buckets."""
    ends = [("dep_lat", LATITUDES), ("dep_lon", LONGITUDES), ("arr_lat", LATITUDES), ("arr_lon", LONGITUDES)]
    inf = float("inf")
    return [
        Bucketizer(splits=[-inf, *cut_points(*span, n), inf], inputCol=c, outputCol=f"d_{c}")
        for c, span in ends
    ]


def crosses(n: int) -> dict[str, Column]:
    """Hashed combinations of bucketed coordinates; needs the `d_` columns."""

    def crossed(size: int, *columns: str) -> Column:
        return hash_bucket(F.concat_ws(":", *[F.col(c).cast("int") for c in columns]), size)

    return {
        "dep_loc": crossed(n * n, "d_dep_lat", "d_dep_lon"),
        "arr_loc": crossed(n * n, "d_arr_lat", "d_arr_lon"),
        "dep_arr": crossed(n**4, "d_dep_lat", "d_dep_lon", "d_arr_lat", "d_arr_lon"),
    }


def carrier_index(output: str = "carrier_ix") -> StringIndexerModel:
    """Vocabulary position of the carrier; others share the position after the last."""
    return StringIndexerModel.from_labels(
        CARRIER_VOCABULARY, inputCol="carrier", outputCol=output, handleInvalid="keep"
    )


def categories(column: str, size: int) -> Column:
    """A category number that carries its category count, so that encoding needs no pass."""
    return F.col(column).cast("double").alias(
        column, metadata={"ml_attr": {"type": "nominal", "name": column, "num_vals": size}}
    )


def with_hashed(rows: DataFrame, airport_buckets: int = AIRPORT_BUCKETS, location: int | None = None) -> DataFrame:
    """Training rows plus hashed airports and, if asked for, crossed locations."""
    sizes = {"origin_ix": airport_buckets, "dest_ix": airport_buckets}
    out = rows.withColumns({
        "label": F.col("ontime"),
        "origin_ix": hash_bucket("origin", airport_buckets),
        "dest_ix": hash_bucket("dest", airport_buckets),
    })
    if location:
        for stage in location_buckets(location):
            out = stage.transform(out)
        out = out.withColumns(crosses(location))
        sizes |= {"dep_loc": location**2, "arr_loc": location**2, "dep_arr": location**4}
    kept = [c for c in out.columns if c not in sizes]
    return out.select(*kept, *[categories(c, n) for c, n in sizes.items()])


def column_stages(location: bool = False) -> list:
    """Stages from training rows (see `with_hashed`) to one feature vector.

    The carrier is one-hot over its vocabulary, an unknown one is all zero.
    """
    hashed = ["origin_ix", "dest_ix"] + (["dep_loc", "arr_loc", "dep_arr"] if location else [])
    return [
        carrier_index(),
        OneHotEncoder(inputCols=["carrier_ix"], outputCols=["carrier_hot"], dropLast=True),
        OneHotEncoder(inputCols=hashed, outputCols=[f"{c}_hot" for c in hashed], dropLast=False),
        assembler([*REAL_COLUMNS, "carrier_hot", *[f"{c}_hot" for c in hashed]]),
    ]


def fit_columns(rows: DataFrame, location: bool = False):
    return Pipeline(stages=column_stages(location)).fit(rows)
