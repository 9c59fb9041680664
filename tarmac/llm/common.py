"""Words, input columns and stored intermediate tables, shared by the operators."""

from __future__ import annotations

import gc
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.session import scratch, settle

#: Words of letters and digits, after A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(lower_ascii(text), F.lit("")), F.lit(WORD), F.lit(0))


class Workspace:
    """The stored tables of one job, in a folder of their own below `spark.checkpoint.dir`.

    A stored table cuts the plan, so a lost executor costs no recomputation of what
    came before, and its true size is known to the planner.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root = settle(spark), scratch(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete stored tables that no later step reads, and the shuffles that made them."""
        for table in tables:
            for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                delete(self.spark, path)
        self.tidy()

    def tidy(self) -> None:
        """Let Spark remove the shuffle files of jobs whose results are stored."""
        gc.collect()
        self.spark._jvm.System.gc()

    def close(self) -> None:
        delete(self.spark, self.root)
        self.tidy()


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
