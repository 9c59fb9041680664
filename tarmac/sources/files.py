"""File sources: monthly flight files, airport master, day list, lookups, archives."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac import schemas
from tarmac.functions.text import clean_line, field_count, typed_fields


class UnexpectedFormat(ValueError):
    """A raw file does not begin with the expected header."""


class DataUnavailable(ValueError):
    """A raw file holds a header and nothing else."""


def read_raw_flights(spark: SparkSession, path: str) -> DataFrame:
    """Monthly CSV files with a header line each; `path` may be a glob.

    Header lines further down, as in files put together from several, are left out.
    """
    rows = (
        spark.read.schema(schemas.RAW_FLIGHT)
        .option("header", True).option("enforceSchema", True).option("nullValue", "")
        .csv(path)
    )
    return rows.where(~F.col("origin").eqNullSafe("ORIGIN"))


def read_corrected_flights(spark: SparkSession, path: str) -> DataFrame:
    """Headerless corrected flights.  Files of 33 columns leave the event columns null."""
    return (
        spark.read.schema(schemas.FLIGHT_EVENT)
        .option("nullValue", "").option("mode", "PERMISSIVE")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport master file, plain or gzip: id and coordinates, as text."""
    raw = spark.read.option("header", True).option("quote", '"').csv(path)
    return raw.select(*[
        F.col(f"`{raw.columns[i]}`").alias(name)
        for name, i in schemas.AIRPORT_FILE_POSITIONS.items()
    ])


def read_train_days(spark: SparkSession, path: str, only_train: bool = False) -> DataFrame:
    """Day list with a True/False flag; lines of a single field are left out."""
    days = (
        spark.read.option("header", True).schema("fl_date string, flag string").csv(path)
        .where(F.col("flag").isNotNull())
        .select(F.to_date("fl_date").alias("fl_date"), (F.col("flag") == "True").alias("is_train_day"))
    )
    return days.where("is_train_day") if only_train else days


def read_delay_lookup(spark: SparkSession, path: str) -> DataFrame:
    """`ORIGIN:HH,mean` lines as (origin, dep_hour, avg_dep_delay)."""
    key = F.split("origin_hour", ":")
    return (
        spark.read.schema(schemas.DELAY_LOOKUP).csv(path)
        .select(key[0].alias("origin"), key[1].alias("dep_hour"), "avg_dep_delay")
    )


def read_training_rows(
    spark: SparkSession, path: str, shuffle: bool = False, limit: int = 0, seed: int = 13,
) -> DataFrame:
    """Headerless training CSV; missing numbers read as 0.0 and missing names as 'na'.

    `limit`, for a first look at the data, bounds the rows returned; 0 returns all.
    """
    rows = spark.read.schema(schemas.TRAINING_ROW).option("nullValue", "").csv(path)
    rows = rows.fillna(0.0).fillna("na")
    if shuffle:
        rows = epochs(rows, 1, seed).drop("epoch")
    return rows.limit(limit) if limit > 0 else rows


def epochs(rows: DataFrame, count: int, seed: int = 13) -> DataFrame:
    """Training rows `count` times over, each time in another order, with `epoch`.

    Every epoch deals the rows into buckets by a hash of seed, epoch and place in the
    input, and orders each bucket by it: one shuffle and no global sort.  Equal rows
    differ in their place, so they spread; files read the same way give the same order.
    """
    keyed = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("row"), F.monotonically_increasing_id().alias("at"))
    many = keyed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    many = many.withColumn("key", F.xxhash64(F.lit(seed), "epoch", "at"))
    return many.repartition("epoch", "key").sortWithinPartitions("epoch", "key").select(
        *[F.col("row")[c].alias(c) for c in rows.columns if c != "epoch"], "epoch")


def create_external_table(spark: SparkSession, name: str, path: str, schema_json: str) -> DataFrame:
    """An external CSV table described by a JSON list of fields."""
    fields = schemas.from_json_fields(json.loads(schema_json))
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    (
        spark.read.schema(fields).option("nullValue", "")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        .createOrReplaceTempView(name)
    )
    return spark.table(name)


def load_relational(raw: DataFrame) -> DataFrame:
    """Raw flights under the column types of the relational table.

    Clock times become integers there, so `0056` reads 56.
    """
    integers = ["op_carrier_fl_num", *schemas.TIME_COLUMNS]
    floats = ["dep_delay", "taxi_out", "taxi_in", "arr_delay", "cancelled", "diverted"]
    return raw.select(*[
        F.col(c).try_cast("int").alias(c) if c in integers
        else F.col(c).try_cast("float").alias(c) if c in floats
        else F.col(c).cast("string").alias(c) if c == "distance"
        else F.col(c)
        for c in raw.columns
    ])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Zip archives, one row each: path and content."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


#: Bytes of text that an archive reader hands on at once.
BLOCK = 1 << 20


def archive_blocks(archives: DataFrame, size: int = BLOCK) -> DataFrame:
    """Text of the first member of each archive in blocks that end at a line break: path, first (number of its first line), text.

    The member is decompressed as a stream: a task holds one archive and one block, which
    is longer than `size` only where a line is.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive, archive.open(archive.namelist()[0]) as member:
                    for first, block in _blocks(member, size):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path]), pa.array([first], pa.int64()), pa.array([block], pa.binary())], names=["path", "first", "text"])

    return archives.select("path", "content").mapInArrow(expand, "path string, first bigint, text binary")


def _blocks(member, size: int) -> Iterator[tuple[int, bytes]]:
    rest, first = [], 0
    while data := member.read(size):
        cut = data.rfind(b"\n") + 1
        if not cut:
            rest.append(data)
            continue
        block = b"".join([*rest, data[:cut]])
        yield first, block
        first += block.count(b"\n")
        rest = [data[cut:]] if cut < len(data) else []
    if rest:
        yield first, b"".join(rest)


def archive_lines(archives: DataFrame, size: int = BLOCK) -> DataFrame:
    """Lines of the first member of each archive, as (path, line_no, value); blocks are split into lines in the JVM."""
    text = F.regexp_replace(F.decode("text", "UTF-8"), r"\n\z", "")
    lines = archive_blocks(archives, size).select("path", "first", F.posexplode(F.split(text, "\n", -1)).alias("at", "value"))
    return lines.select("path", (F.col("first") + F.col("at")).alias("line_no"), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and a number that grows along each file split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def clean_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", clean_line("value"))


def file_report(lines: DataFrame, header: str = schemas.RAW_HEADER) -> DataFrame:
    """Per file: its line count and verdict.

    Only the split at offset 0 can hold the first line, so the others contribute a
    count and nothing else.  What is kept of the first line is whether it is the
    header, so no text goes through the shuffle.
    """
    head = F.lit(True) if "block_start" not in lines.columns else F.col("block_start") == 0
    order = F.when(head, F.col("line_no"))
    return (
        lines.groupBy("path")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.min_by(F.trim("value") == header, order).alias("has_header"))
        .select(
            "path", "n_lines",
            F.when(~F.col("has_header"), "unexpected_format")
            .when(F.col("n_lines") <= 1, "data_unavailable")
            .otherwise("ok").alias("verdict"),
        )
    )


def verify_files(lines: DataFrame, header: str = schemas.RAW_HEADER) -> None:
    """Raise for the first file with a wrong header or without data."""
    bad = file_report(lines, header).where("verdict <> 'ok'").orderBy("path").first()
    if bad is None:
        return
    if bad["verdict"] == "unexpected_format":
        found = lines.where(F.col("path") == bad["path"]).orderBy("line_no").first()["value"]
        raise UnexpectedFormat(f"{bad['path']}: header={found!r}, expected={header!r}")
    raise DataUnavailable(f"{bad['path']}: header only")


def next_month(paths: DataFrame) -> DataFrame:
    """The month after the latest `yyyymm.csv` file or folder among the paths (one row)."""
    stamp = F.regexp_extract("path", r"(?:^|/)(\d{6})[^/]*\.csv(?:/|$)", 1)
    return (
        paths.where(stamp != "")
        .agg(F.max(stamp).alias("latest"))
        .select("latest", F.date_format(F.add_months(F.to_date("latest", "yyyyMM"), 1), "yyyyMM").alias("next"))
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; file contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def parse_events(lines: DataFrame, column: str = "value", columns: Sequence[str] | None = None) -> DataFrame:
    """Payload lines of exactly 35 fields as typed events; other lines are dropped.

    With `columns`, only these fields are parsed and returned.
    """
    whole = lines.where(field_count(column) == len(schemas.EVENT_ROW_COLUMNS))
    row = typed_fields(column, schemas.EVENT_ROW_COLUMNS, columns)
    return whole.select(row.alias("event_row")).select("event_row.*")


def malformed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines `parse_events` drops, with the number of fields found."""
    wrong = F.coalesce(F.col("n_fields") != len(schemas.EVENT_ROW_COLUMNS), F.lit(True))
    return lines.withColumn("n_fields", field_count(column)).where(wrong)
