"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.sinks.tables import write_folders


def write_csv(df: DataFrame, path: str, header: bool = False, packed: bool = False) -> None:
    """One CSV part per partition.

    `packed` writes gzip parts, which every reader here opens as it opens plain ones;
    event lines take about a sixth of the disk.  A part is then read by one task.
    """
    _packed(_csv(df, header), packed).csv(path)


def write_lines(lines: DataFrame, path: str, packed: bool = False, level: str = "BEST_SPEED") -> None:
    """Text, one part per partition; `packed` as in `write_csv`, at a level of gzip."""
    _packed(lines.select("value").write.mode("overwrite"), packed, level).text(path)


def write_keyed_csv(averages: DataFrame, path: str, header: bool = False) -> None:
    """CSV in a single part, for a table with one row per airport and hour only.

    Such a table is bounded by its keys, some thousand rows, however many events it
    sums up.  The aggregation before it keeps its own tasks: only its result is
    brought together, by one exchange.
    """
    _csv(averages.repartition(1), header).csv(path)


def write_csv_with_schema(df: DataFrame, path: str) -> None:
    """CSV with header and, beside it, its schema as JSON."""
    spark = df.sparkSession
    write_csv(df, path, header=True)
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}_schema")


def read_csv_with_schema(spark, path: str) -> DataFrame:
    from pyspark.sql.types import StructType
    import json

    text = spark.read.text(f"{path}_schema").first()["value"]
    schema = StructType.fromJson(json.loads(text))
    return spark.read.schema(schema).option("header", True).csv(path)


def write_by_event(events: DataFrame, path: str) -> None:
    """One folder per event type, each task writing to all of them without a sort."""
    write_folders(events, path, "event")


def _packed(writer, packed: bool, level: str = "BEST_SPEED"):
    return writer.option("compression", "gzip").option("zlib.compress.level", level) if packed else writer


def _csv(df: DataFrame, header: bool):
    return (
        df.write.mode("overwrite").option("header", header).option("emptyValue", "")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    )
