"""One text file per window, put in place once the window has closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.streaming.lateness import Watermark, is_late
from tarmac.streaming.runs import each_batch


class WindowedText:
    """A batch writer: messages (`time`, `line`) to `out`/<yyyyMMddHHmm>.txt, one file for each window with messages.

    A window is written when the watermark has passed it; until then its rows are carried
    from batch to batch in `work`, so what is carried is the rows of open windows.  The
    files of a batch are written to a staging folder and renamed when all are there.  A
    batch that is repeated finds the same carried rows and the same watermark, writes the
    same files and puts them in the place of those already renamed.  Rows of windows
    closed before their batch are late and left out.  Lines of a window are ordered by
    time and text.  A window goes through one task: that is what one file asks for.
    """

    def __init__(self, spark: SparkSession, out: str, work: str, time: str = "ts", line: str = "line", width: str = "1 minute") -> None:
        self.spark, self.out, self.work, self.time, self.line, self.width = spark, out, work, time, line, width
        self.watermark = Watermark(spark, f"{work}/watermark", time)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = jvm.org.apache.hadoop.fs.Path
        self.files = self.path(out).getFileSystem(conf)

    def __call__(self, batch: DataFrame, number: int) -> None:
        late = is_late(self.watermark.before(number), self.time, self.width)
        rows = batch.select(F.col(self.time).cast("timestamp").alias("time"), F.col(self.line).alias("line"), late.alias("late"))
        rows = rows.where("NOT late").drop("late")
        if number:
            rows = rows.unionByName(self._carried(number - 1))
        rows.write.mode("overwrite").parquet(f"{self.work}/all/batch={number}")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.work}/all/batch={number}")
        high = self.watermark.store(stored.withColumnRenamed("time", self.time), number)
        window = F.window("time", self.width)
        named = stored.select(
            F.date_format(window["start"], "yyyyMMddHHmm").alias("window_start"), "time", F.coalesce("line", F.lit("")).alias("line"),
            F.coalesce(window["end"] <= F.lit(high).cast("timestamp"), F.lit(False)).alias("closed"))
        named.where("NOT closed").select("time", "line").write.mode("overwrite").parquet(f"{self.work}/open/batch={number}")
        staged = f"{self.work}/staged/batch={number}"
        closed = named.where("closed").repartition("window_start").sortWithinPartitions("window_start", "time", "line")
        closed.select("window_start", "line").write.mode("overwrite").partitionBy("window_start").text(staged)
        self._publish(staged)
        for old in (f"{self.work}/all/batch={number}", staged, f"{self.work}/open/batch={number - 2}"):
            self.files.delete(self.path(old), True)

    def _carried(self, number: int) -> DataFrame:
        return self.spark.read.schema("time timestamp, line string").parquet(f"{self.work}/open/batch={number}")

    def _publish(self, staged: str) -> None:
        """Rename staged files; only their names pass through here."""
        self.files.mkdirs(self.path(self.out))
        for found in self.files.globStatus(self.path(f"{staged}/window_start=*/part-*")) or ():
            source = found.getPath()
            target = self.path(self.out, source.getParent().getName().partition("=")[2] + ".txt")
            if not self.files.rename(source, target):
                self.files.delete(target, False)
                if not self.files.rename(source, target):
                    raise OSError(f"cannot put {target} in place")


def write_windows(stream: DataFrame, out: str, work: str, time: str = "ts", line: str = "line", width: str = "1 minute", drain: bool = True):
    """Start `WindowedText` on a stream."""
    return each_batch(stream, WindowedText(stream.sparkSession, out, f"{work}/rows", time, line, width), f"{work}/state", drain=drain)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """window_start and line of every line of the files."""
    name = F.regexp_extract(F.input_file_name(), r"([0-9]+)\.txt$", 1)
    return spark.read.schema("line string").text(out).select(name.alias("window_start"), "line")
