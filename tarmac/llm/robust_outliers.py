"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every document has a vector of transformed statistics.  For each language and source, the
covariance of the most compact `SHARE` of its vectors is found by concentration steps: the
distances to the current estimate, the nearest share of the rows, their mean and
covariance, and so on until the determinant stops falling.  All scopes go through a step
together, as one aggregation.  Two starts are taken, from medians with spreads and from
vectors scaled to one length, and the smaller determinant wins.  A document is rejected
when its squared Mahalanobis distance is beyond `CUTOFF`.

Aggregates are exact: vectors are whole multiples of 1/`UNIT`, so sums of products do not
depend on the order of rows, and the nearest share is cut at a boundary between distance
bins, so ties fall together.  An aggregate has one small row per scope; it is joined to
the rows, not collected.  No scope's rows meet in one task.

A source with fewer than `LEAST` documents of a language shares a scope with the other
such sources of that language, and languages whose rest is still smaller share one.
If that one has fewer than `LEAST` documents, none of them is rejected by distance.

The statistics are rates, so that length is no reason to reject.  Rates of short texts
scatter more: each is drawn towards the typical rate by the weight of `PRIOR` words.
Spreads have a floor, since most texts have no repeated line at all.

Defined results: a null text has no words and fails the base rule; null language or source
is a scope of its own; repeated rows are judged alike, one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import Workspace

MIN_WORDS = 50
REPEAT_PERCENT = 50
SHARE = 0.75
LEAST = 100
STEPS = 8
UNIT = 1 << 12
#: Distances are binned by this many bins per doubling.
BINS = 64
PRIOR = 200
FLOOR = 0.2
FEATURES = ["word_length", "symbols", "repeats", "dup_lines", "upper", "digits", "punctuation", "top_word"]
#: Squared distance beyond which a vector of eight is no plausible member: far in the tail of its
#: chi-square law, since the statistics are only roughly normal.
CUTOFF = 75.0
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def base_counts(text: str | None) -> tuple[int, int, int, int, int, list[str]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the words."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif WORD.search(line):
            seen.add(line)
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words), words


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    hit = np.fromiter((counts[w] > 1 for w in windows), bool, n - 2)
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def statistics(text: str, n: int, chars: int, symbols: int, dup: int, repeat: int, words: list[str]) -> list[int]:
    """The transformed vector, in whole multiples of 1 / UNIT."""
    size = max(len(text), 1)
    lines = text.count("\n") + 1
    plain = text.encode("ascii", "replace").translate(KINDS)
    upper, digits, marks = plain.count(b"U"), plain.count(b"D"), plain.count(b"P")
    top = Counter(words).most_common(1)[0][1] if words else 0
    w = PRIOR

    def rate(part: int, whole: int, typical: float, weight: int) -> float:
        """Log of the rate drawn towards the typical one; bounded below, however long the text."""
        return math.log((part + typical * weight) / (whole + weight) + typical)

    vector = [
        4 * math.log((chars + 5.5 * w) / (n + w)),
        rate(symbols, size, 0.002, 6 * w), rate(repeat, n, 0.02, w), rate(dup, lines, 0.05, 20),
        rate(upper, size, 0.02, 6 * w), rate(digits, size, 0.005, 6 * w), rate(marks, size, 0.03, 6 * w),
        rate(top, n, 0.08, w),
    ]
    return [round(x * UNIT) for x in vector]


#: Kinds of ASCII characters; others count as letters.
KINDS = bytes(
    ord("U") if chr(c).isupper() else ord("D") if chr(c).isdigit() else ord("P") if 32 < c < 127 and not chr(c).isalnum() and c != 63 else ord("o")
    for c in range(256))


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text), lang, source, the base counts, base_failed and `v`, the vector."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, vectors = [], []
            for i in range(batch.num_rows):
                text = batch[3][i].as_py() or ""
                *base, words = base_counts(text)
                counts.append(base)
                vectors.append(statistics(text, *base, words))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[4], batch[1], batch[2], *columns, pa.array(vectors, pa.list_(pa.int64()))],
                names=["doc_id", "th", "lang", "source", *(c.split()[0] for c in BASE.split(", ")), "v"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "lang", "source", "text", F.xxhash64("text")).mapInArrow(
        described, f"doc_id bigint, th bigint, lang string, source string, {BASE}, v array<bigint>")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _scopes(rows: DataFrame, work: Workspace) -> DataFrame:
    """lang, source and their scope."""
    counts = rows.where("NOT base_failed").groupBy("lang", "source").count()
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    small = counts.where(F.col("count") < LEAST)
    rest = small.groupBy("lang").agg(F.sum("count").alias("rest"))
    joined = counts.join(rest.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return work.store(joined.select(
        "lang", "source", F.when(F.col("count") >= LEAST, name("lang", "source")).when(F.col("rest") >= LEAST, name("lang"))
        .otherwise(F.lit("rest")).alias("scope")), "scopes")


def _moments(rows: DataFrame) -> DataFrame:
    """scope, n, sums and sums of products: exact whole numbers, combined before the shuffle."""
    d = len(FEATURES)
    v = [F.col("v")[i] for i in range(d)]
    sums = [F.sum(v[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum((v[i] * v[j]).cast("decimal(30,0)")).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    return rows.groupBy("scope").agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def _fit(moments: DataFrame) -> DataFrame:
    """scope, center, inverse (row by row) and log determinant, from the moments of each scope's rows."""
    d = len(FEATURES)

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, r in batch.iterrows():
                mean = np.array([r[f"s{i}"] for i in range(d)], float) / r["n"]
                second = np.zeros((d, d))
                for i in range(d):
                    for j in range(i, d):
                        second[i, j] = second[j, i] = float(r[f"p{i}_{j}"]) / r["n"]
                cov = (second - np.outer(mean, mean)) / UNIT**2 + np.eye(d) * FLOOR**2
                out.append((r["scope"], (mean / UNIT).tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=["scope", "center", "inverse", "logdet"])

    return moments.mapInPandas(fitted, "scope string, center array<double>, inverse array<double>, logdet double")


def _distance(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance to the scope's estimate."""
    d = len(FEATURES)
    joined = rows.join(fits, "scope").withColumn(
        "z", F.array(*[F.col("v")[i] / F.lit(float(UNIT)) - F.col("center")[i] for i in range(d)]))
    total = sum((F.col("z")[i] * F.col("z")[j] * F.col("inverse")[i * d + j] * (1.0 if i == j else 2.0) for i in range(d) for j in range(i, d)), F.lit(0.0))
    return joined.withColumn("d2", total).drop("z", "center", "inverse", "logdet")


def _nearest(rows: DataFrame) -> DataFrame:
    """The nearest SHARE of each scope's rows, up to the end of a distance bin."""
    binned = rows.withColumn("bin", F.ceil(F.log2(F.greatest("d2", F.lit(2.0**-20))) * BINS).cast("int"))
    counts = binned.groupBy("scope", "bin").count()
    cut = counts.groupBy("scope").agg(F.sort_array(F.collect_list(F.struct("bin", "count"))).alias("bins"), (F.sum("count") * SHARE).alias("want"))
    first = F.aggregate("bins", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-(2**31)).alias("bin")), lambda acc, b: F.when(
        acc["n"] < F.col("want"), F.struct((acc["n"] + b["count"]).alias("n"), b["bin"].alias("bin"))).otherwise(acc))
    return binned.join(cut.select("scope", first["bin"].alias("cut")), "scope").where("bin <= cut")


def concentrate(rows: DataFrame, work: Workspace, steps: int = STEPS) -> DataFrame:
    """The estimate of least determinant of each scope: scope, center, inverse, logdet.

    rows: scope and v.
    """
    d = len(FEATURES)
    middle = rows.groupBy("scope").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.col("v")[i], F.lit([0.16, 0.5, 0.84]), 2000).alias(f"q{i}") for i in range(d)]).where(F.col("n") >= LEAST)
    spread = lambda i: F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / F.lit(2.0 * UNIT), F.lit(FLOOR))
    diagonal = work.store(middle.select(
        "scope", F.array(*[F.col(f"q{i}")[1] / F.lit(float(UNIT)) for i in range(d)]).alias("center"),
        F.array(*[1 / (spread(i) * spread(i)) if i == j else F.lit(0.0) for i in range(d) for j in range(d)]).alias("inverse"),
        F.lit(0.0).alias("logdet")), "start-diagonal")
    # spatial signs: vectors from the median, all of one length, make a second start
    away = rows.join(diagonal, "scope")
    z = [F.col("v")[i] - F.col("center")[i] * UNIT for i in range(d)]
    length = F.sqrt(sum((x * x * F.col("inverse")[i * d + i] for i, x in enumerate(z)), F.lit(1e-6))) / UNIT
    signs = away.select("scope", F.array(*[F.round(F.col("center")[i] * UNIT + x / F.greatest(length, F.lit(1e-3))).cast("bigint") for i, x in enumerate(z)]).alias("v"))
    # both starts go through the steps together, as scopes of their own
    mark = lambda df, start: df.withColumn("scope", F.concat(F.lit(start), "scope"))
    twice = rows.select(F.explode(F.array(F.concat(F.lit("d"), "scope"), F.concat(F.lit("s"), "scope"))).alias("scope"), "v")
    fits, last = mark(diagonal, "d").unionByName(mark(work.store(_fit(_moments(signs)), "start-signs"), "s")), None
    for step in range(steps):
        fits = work.store(_fit(_moments(_nearest(_distance(twice, fits)))), f"step-{step}")
        total = fits.agg(F.sum("logdet")).first()[0]
        if total is None or last is not None and last - total < 1e-3 * max(1, abs(last)):
            break
        last = total
    best = fits.groupBy(F.expr("substr(scope, 2)").alias("scope")).agg(F.min_by(F.struct("center", "inverse", "logdet"), "logdet").alias("best"))
    return work.store(best.select("scope", "best.*"), "estimates")


def judge(documents: DataFrame, work: Workspace, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, th, lang, source, the base counts, base_failed, kept, distance and scope: one row per document."""
    rows = work.store(describe(documents), "statistics")
    scopes = _scopes(rows, work).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    met = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    scoped = rows.join(scopes, met, "left").drop("_lang", "_source")
    fits = concentrate(work.store(scoped.where("NOT base_failed").select("scope", "v"), "vectors"), work)
    d = len(FEATURES)
    joined = scoped.join(fits, "scope", "left")
    z = [F.col("v")[i] / F.lit(float(UNIT)) - F.col("center")[i] for i in range(d)]
    d2 = sum((z[i] * z[j] * F.col("inverse")[i * d + j] * (1.0 if i == j else 2.0) for i in range(d) for j in range(i, d)), F.lit(0.0))
    return joined.select(
        "doc_id", "th", "lang", "source", *[c.split()[0] for c in BASE.split(", ")], "base_failed",
        (~F.col("base_failed") & (F.coalesce(d2, F.lit(0.0)) <= cutoff)).alias("kept"), F.round(d2, 3).alias("distance"), "scope")
