"""File sources and sinks on small files."""

import gzip
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from fixtures import R1, R2
from tarmac import schemas
from tarmac.plans import ingest
from tarmac.sinks import files as file_sink, tables as table_sink
from tarmac.sources import files, tables

BODY = "2019-05-14,WN,19393,WN,118,1,1474703,3,SEA,2,1129202,4,DEN,0041,0047,6.00,14.00,0101,0432,6.00,0450,0438,-12.00,0.00,,0.00,1024.00"


def quoted(line):
    return ",".join(f'"{f}"' if i in (1, 8) else f for i, f in enumerate(line.split(","))) + ",\n"


def archive(tmp_path, name, lines, extra=None):
    path = tmp_path / name
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("month.csv", "".join(lines))
        if extra:
            z.writestr("readme.html", extra)
    return str(path)


def test_ingest_month(spark, tmp_path):
    lines = [schemas.RAW_HEADER + ",\n"] + [quoted(BODY)] * 3
    path = archive(tmp_path, "ontime.zip", lines, "<html>")
    raw = str(tmp_path / "raw")
    ingest.ingest_month(spark, path, raw, "201801")
    rows = ingest.read_ingested(spark, raw).collect()
    assert len(rows) == 3
    assert rows[0]["origin"] == "SEA" and rows[0]["dep_time"] == "0047" and rows[0]["cancellation_code"] is None
    assert ingest.month_to_ingest(spark, raw) == "201802"


def test_long_archive_is_read_whole(spark, tmp_path):
    path = archive(tmp_path, "long.zip", [f"line {i}\n" for i in range(45001)])
    lines = files.archive_lines(files.read_archives(spark, path))
    assert lines.count() == 45001
    assert lines.agg(F.max("line_no"), F.count_distinct("line_no")).first()[:] == (45000, 45001)


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_blocks_end_at_line_breaks(spark, tmp_path, size):
    lines = ["a", "", "ü" * 40, "b\r", "x" * 200, "end"]
    path = archive(tmp_path, f"blocks{size}.zip", ["\n".join(lines)])
    blocks = files.archive_blocks(files.read_archives(spark, path), size).orderBy("first").collect()
    assert b"".join(bytes(r["text"]) for r in blocks).decode() == "\n".join(lines)
    assert all(bytes(r["text"]).endswith(b"\n") for r in blocks[:-1])
    got = files.archive_lines(files.read_archives(spark, path), size).orderBy("line_no").collect()
    assert [(r["line_no"], r["value"]) for r in got] == list(enumerate(lines))


def test_months_are_taken_in_turn_and_replaced_whole(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for month in ("201801", "201802"):
        (tmp_path / "in" / month).mkdir(parents=True)
        archive(tmp_path / "in" / month, "m.zip", [schemas.RAW_HEADER + ",\n"] + [quoted(BODY)] * 2)
    assert ingest.ingest_months(spark, str(tmp_path / "in"), raw, "201801", "201802") == ["201801", "201802"]
    assert ingest.ingest_months(spark, str(tmp_path / "in"), raw, "201801", "201802") == []
    ingest.ingest_month(spark, str(tmp_path / "in" / "201802"), raw, "201802")
    assert ingest.read_ingested(spark, raw).count() == 4
    assert sorted(n for n in os.listdir(raw) if not n.startswith(".")) == ["201801.csv", "201802.csv"]


@pytest.mark.parametrize("lines, error", [
    (["A,B\n", BODY + "\n"], files.UnexpectedFormat),
    ([schemas.RAW_HEADER + "\n"], files.DataUnavailable),
])
def test_bad_archive(spark, tmp_path, lines, error):
    with pytest.raises(error):
        ingest.ingest_month(spark, archive(tmp_path, "bad.zip", lines), str(tmp_path / "raw"), "201801")
    assert not (tmp_path / "raw").exists()


def test_header_check_on_plain_files(spark, tmp_path):
    (tmp_path / "good.csv").write_text(schemas.RAW_HEADER + "\n" + (BODY + "\n") * 2000)
    (tmp_path / "short.csv").write_text(schemas.RAW_HEADER + "\n")
    (tmp_path / "wrong.csv").write_text(BODY + "\n" + schemas.RAW_HEADER + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        report = files.file_report(files.read_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r["path"].rsplit("/", 1)[1]: (r["n_lines"], r["verdict"]) for r in report}
    assert got == {"good.csv": (2001, "ok"), "short.csv": (1, "data_unavailable"), "wrong.csv": (2, "unexpected_format")}


def test_raw_flights_glob_with_headers(spark, tmp_path):
    for month in ("201801", "201802"):
        (tmp_path / f"{month}.csv").write_text(schemas.RAW_HEADER + "\n" + BODY + "\n")
    rows = files.read_raw_flights(spark, f"{tmp_path}/*.csv")
    assert rows.count() == 2 and rows.schema == schemas.RAW_FLIGHT
    loaded = files.load_relational(rows).first()
    assert loaded["dep_time"] == 47 and loaded["distance"] == "1024.0"


def test_airports_from_gzip(spark, tmp_path):
    header = ",".join(f"C{i}" for i in range(28))
    row = ["x"] * 28
    row[0], row[3], row[21], row[26] = "1000101", '"Afognak, AK"', "58.1", "-152.9"
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(header + "\n" + ",".join(row) + "\n")
    assert files.read_airports(spark, str(tmp_path / "a.csv.gz")).collect() == [("1000101", "58.1", "-152.9")]


def test_train_days(spark, tmp_path):
    (tmp_path / "days.csv").write_text("FL_DATE,is_train_day\n2018-01-02,True\n2018-01-03,False\n2018-01-04\n")
    assert files.read_train_days(spark, str(tmp_path / "days.csv")).count() == 2
    only = files.read_train_days(spark, str(tmp_path / "days.csv"), only_train=True).collect()
    assert [str(r["fl_date"]) for r in only] == ["2018-01-02"]


def test_training_rows_defaults(spark, tmp_path):
    (tmp_path / "train.csv").write_text("1.0,2.0,,3.0,,,AA,1,2,3,4,SEA,DEN\n0.0,2.0,1,3.0,4,5,,1,2,3,4,SEA,DEN\n")
    rows = files.read_training_rows(spark, str(tmp_path / "train.csv")).collect()
    assert rows[0]["taxiout"] == 0.0 and rows[1]["carrier"] == "na"
    assert files.read_training_rows(spark, str(tmp_path / "train.csv"), shuffle=True, limit=1).count() == 1


@pytest.mark.parametrize("n", [100, 1_000_001])
def test_layout_does_not_depend_on_size(spark, tmp_path, n):
    rows = spark.range(n).repartition(4)
    file_sink.write_csv(rows, str(tmp_path / "parts"))
    file_sink.write_keyed_csv(rows, str(tmp_path / "one"))
    assert [len(list((tmp_path / d).glob("*.csv"))) for d in ("parts", "one")] == [4, 1]
    assert spark.read.csv(str(tmp_path / "parts")).count() == spark.read.csv(str(tmp_path / "one")).count() == n


def test_header_lines_inside_a_file(spark, tmp_path):
    (tmp_path / "joined.csv").write_text((schemas.RAW_HEADER + "\n" + BODY + "\n\n") * 2)
    assert files.read_raw_flights(spark, str(tmp_path / "joined.csv")).count() == 2


def test_wanted_fields_equal_the_whole_parse(spark):
    lines = tables.lines(spark, [R1, R2])
    wanted = ["event", "dep_delay", "fl_date", "notify_time", "cancellation_code", "taxi_out"]
    part, whole = files.parse_events(lines, columns=wanted), files.parse_events(lines).select(wanted)
    assert part.schema.simpleString() == whole.schema.simpleString() and part.collect() == whole.collect()


def test_event_log_is_partitioned_by_day(spark, tmp_path):
    rows = files.parse_events(tables.lines(spark, [R1, R2]))
    path = str(tmp_path / "log")
    table_sink.write_event_log(rows, path)
    assert [p.name for p in (tmp_path / "log").glob("fl_date=*")] == ["fl_date=2019-05-14"]
    log = tables.expected_events(spark, path, "2019-05-14").select("dest")
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fl_date" in plan
    assert log.count() == 2


def test_relational_table(spark):
    table_sink.create_relational_table(spark)
    table_sink.create_relational_table(spark)
    kinds = dict(spark.table("bts.flights").dtypes)
    assert (kinds["fl_date"], kinds["dep_time"], kinds["arr_delay"], kinds["distance"]) == ("date", "int", "float", "string")
    spark.sql("DROP TABLE bts.flights")


def test_json_fields():
    fields = schemas.from_json_fields([
        {"name": "FL_DATE", "type": "DATE", "mode": "NULLABLE"}, {"name": "N", "type": "INTEGER", "mode": "REQUIRED"}])
    assert fields.simpleString() == "struct<fl_date:date,n:bigint>" and not fields["n"].nullable


def test_store_airports_with_zones(spark, tmp_path):
    header = ",".join(f"C{i}" for i in range(28))
    rows = []
    for key, lat in (("1", "58.1"), ("2", "")):
        row = ["x"] * 28
        row[0], row[21], row[26] = key, lat, "-152.9"
        rows.append(",".join(row))
    (tmp_path / "a.csv").write_text("\n".join([header, *rows]) + "\n")
    zones = spark.createDataFrame([("1", "America/Anchorage")], "airport_seq_id string, tz string")
    ingest.store_airports(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), zones)
    assert spark.read.csv(str(tmp_path / "out")).collect() == [("1", "58.1", "-152.9", "America/Anchorage")]
