"""From delivered archives to the stored event log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.functions.predicates import contains, has_coordinates
from tarmac.functions.text import csv_line, payload_fields
from tarmac import schemas
from tarmac.operators.correction import correct_times, with_timezone
from tarmac.operators.events import flight_events, with_payload
from tarmac.session import forget, measured, tidy
from tarmac.sinks.files import write_csv, write_lines
from tarmac.sinks.tables import by_day, write_event_log
from tarmac.sources import files


def ingest_month(spark: SparkSession, archive: str, raw_dir: str, month: str) -> str:
    """Unpack, clean and verify a month's archive, or folder of archives, and store it as `<yyyymm>.csv`.

    Raises `UnexpectedFormat` or `DataUnavailable` before anything is written.  The month
    is written beside the others under a name that readers skip, and then renamed: readers
    see it whole or not at all.  A month that is there already is replaced.  Its files are
    gzip; the lines stored for the checks go when the month is published, or not accepted.
    """
    lines = files.clean_lines(files.archive_lines(files.read_archives(spark, archive)))
    stored = measured(lines, "ingest", packed=True)
    staged, target = f"{raw_dir}/_staged-{uuid.uuid4().hex}", f"{raw_dir}/{month}.csv"
    try:
        files.verify_files(stored)
        write_lines(stored.where(F.col("line_no") > 0), staged, packed=True)
    finally:
        forget(stored)
    publish(spark, staged, target)
    return target


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of `target`."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(path(target), True)
    if not store.rename(path(staged), path(target)):
        raise OSError(f"cannot put {target} in place")


def month_to_ingest(spark: SparkSession, raw_dir: str, first: str | None = None) -> str | None:
    """The month after the latest that is stored; `first` where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_dir)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return first
    return files.next_month(files.list_files(spark, raw_dir)).first()["next"] or first


def ingest_months(spark: SparkSession, delivered: str, raw_dir: str, first: str, last: str) -> list[str]:
    """Ingest `delivered`/<yyyymm> month by month, from where the stored months end up to `last`."""
    done = []
    while (month := month_to_ingest(spark, raw_dir, first)) <= last:
        ingest_month(spark, f"{delivered}/{month}", raw_dir, month)
        done.append(month)
    return done


def read_ingested(spark: SparkSession, raw_dir: str) -> DataFrame:
    """All stored months; their header lines were checked and left out on ingest."""
    return spark.read.schema(schemas.RAW_FLIGHT).option("nullValue", "").csv(f"{raw_dir}/*.csv")


def store_airports(spark: SparkSession, master: str, out: str, zones: DataFrame | None = None) -> None:
    """Airport ids with coordinates, and with time zones if a zone table is given, as CSV."""
    airports = files.read_airports(spark, master).where(has_coordinates())
    if zones is not None:
        airports = with_timezone(airports, zones)
    write_csv(airports, out)


def correct_and_log(flights: DataFrame, airports: DataFrame, corrected_out: str, log_out: str) -> None:
    """Corrected flights as CSV and the event log as a table.

    The corrected flights are stored once, those of a day together; both outputs start
    from that table and need no further shuffle.  The lines are gzip files.  The shuffles
    are let go before the outputs are written, and the stored flights after.
    """
    corrected = measured(correct_times(by_day(flights), airports), "corrected", packed=True)
    tidy(flights.sparkSession)
    fields = payload_fields(schemas.CORRECTED_COLUMNS)
    write_lines(corrected.select(csv_line(*fields).alias("value")), corrected_out, packed=True, level="DEFAULT_COMPRESSION")
    write_event_log(with_payload(flight_events(corrected)), log_out, arranged=True)
    forget(corrected)


def filter_airport(lines: DataFrame, code: str, out: str) -> None:
    """Lines that mention an airport."""
    write_lines(lines.where(contains(code)), out)
