"""A training corpus from `documents`: quality rules, line dedup, n-gram Jaccard join,
benchmark decontamination, packing.

A stage's result has to be written before the next stage is called, as `run` does: a stage
deletes the intermediate tables of the one before it.

Defined results: an empty table gives no pieces; null texts fail the quality rules; rows that
agree in doc_id and text are copies, and one stays; further columns of any names pass through
all stages but the last, and n_chars is counted anew by the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import chosen_path, line_dedup, packing, positional_index, robust_outliers
from tarmac.llm.common import Workspace
from tarmac.llm.queries import vocabulary

_open: list[Workspace] = []


def _workspace(spark: SparkSession, label: str) -> Workspace:
    while _open:
        last = _open.pop()
        if last.spark is spark:
            last.close()
    _open.append(Workspace(spark, label))
    return _open[-1]


def _rows_of(docs: DataFrame, keys: DataFrame, how: str, names: list[str]) -> DataFrame:
    """Rows of `docs` with (or without) their doc_id and text among `keys`; both sides grow, so it is a merge join.

    Rows are packed, so that their columns may have any names.
    """
    own = docs.select(_packed(docs), F.xxhash64("text").alias("own_th"))
    keys = keys.withColumnsRenamed({n: f"key_{n}" for n in names})
    met = own["own_th"] == keys["key_th"]
    for n in names:
        if n != "th":
            met = met & F.col("row")[n].eqNullSafe(keys[f"key_{n}"])
    return own.join(keys.hint("merge"), met, how).select("row.*")


def _packed(docs: DataFrame):
    return F.struct(*[docs[c] for c in docs.columns]).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    work = _workspace(spark, "pipeline-quality")
    kept = robust_outliers.judge(docs, work).where("kept").select("doc_id", "th", "lang", "source").distinct()
    return _rows_of(docs, work.store(kept, "kept"), "left_semi", ["doc_id", "th", "lang", "source"])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those of which nothing is left go."""
    work = _workspace(spark, "pipeline-lines")
    out = line_dedup.dedup_lines(docs, work).where("n_removed = 0 OR text <> ''")
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by doc_id, of each class of near copies."""
    work = _workspace(spark, "pipeline-near")
    found = chosen_path.similar_documents(docs, work)
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("k")).select("k.*").distinct()
    kept = _rows_of(docs, work.store(first, "first"), "left_semi", ["doc_id", "th"])
    rows = kept.select(_packed(kept), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"))
    return rows.dropDuplicates(["id", "th"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    work = _workspace(spark, "pipeline-leaks")
    found = positional_index.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), work)
    leaks = work.store(found.where("contaminated").select("doc_id", "th").distinct(), "leaks")
    return _rows_of(docs, leaks, "left_anti", ["doc_id", "th"])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(), _workspace(spark, "pipeline-packing"))


STAGES = [
    ("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("packing", packed),
]
#: The first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, results = spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark, "pipeline")
    for name, stage in STAGES:
        docs = results.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
