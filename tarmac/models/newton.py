"""Logistic regressions on several feature sets at once, by Newton steps over one aggregation each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Fit:
    """A fitted regression: `intercept` and one coefficient per feature."""

    features: list[str]
    intercept: float
    coefficients: list[float]
    steps: int


def fit_all(rows: DataFrame, subsets: list[list[str]], label: str = "label", max_steps: int = 60, tolerance: float = 1e-11) -> list[Fit]:
    """Maximum-likelihood fits of `label` (0 or 1) on each of `subsets`.

    Every row goes once per feature set through one aggregation per step, which adds up
    gradient, weighted cross products and loss of all sets; the driver solves systems as
    large as a feature set.  A step that does not lower the loss is halved.  A set is
    done when its mean gradient, on scaled features, is below `tolerance`; a set that
    parts the labels without error has no maximum, and its loss falls until then.  A row
    counts for the sets whose features it knows.  `rows` is read once per step, so it
    should be a stored table.
    """
    features = sorted({f for s in subsets for f in s})
    moments = rows.agg(*[x for f in features for x in (F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}"))]).first()
    mean = np.array([moments[f"m_{f}"] or 0.0 for f in features])
    spread = np.array([moments[f"s_{f}"] or 1.0 for f in features])
    z = [F.lit(1.0), *((F.coalesce(F.col(f), F.lit(m)) - F.lit(float(m))) / F.lit(float(s)) for f, m, s in zip(features, mean, spread))]
    d = len(features) + 1
    at = [[0, *(features.index(f) + 1 for f in s)] for s in subsets]
    now, step = np.zeros((len(subsets), d)), np.zeros((len(subsets), d))
    best, known = np.full(len(subsets), np.inf), [None] * len(subsets)
    steps, open_ = [0] * len(subsets), set(range(len(subsets)))
    for turn in range(max_steps):
        asked = sorted(open_)
        for r in _sums(rows, subsets, asked, features, z, now + step, label):
            s, n = asked[r["s"]], r["n"]
            gradient = np.array([r[f"g{j}"] for j in range(d)])[at[s]] / n
            if r["loss"] / n > best[s] + 1e-12 and np.abs(step[s]).max() > 1e-9:
                step[s] /= 2
                continue
            now[s], best[s], steps[s] = now[s] + step[s], r["loss"] / n, turn
            step[s] = 0
            if np.abs(gradient).max() < tolerance:
                open_.discard(s)
                continue
            products = np.array([[r[f"h{min(j, k)}_{max(j, k)}"] for k in range(d)] for j in range(d)])[np.ix_(at[s], at[s])] / n
            step[s][at[s]] = np.linalg.lstsq(products, gradient, rcond=1e-13)[0]
        if not open_:
            break
    out = []
    for s, names in enumerate(subsets):
        raw = now[s][1:] / spread
        keep = [features.index(f) for f in names]
        out.append(Fit(list(names), float(now[s][0] - (raw[keep] * mean[keep]).sum()), [float(raw[k]) for k in keep], steps[s]))
    return out


def _sums(rows, subsets, asked, features, z, weights, label):
    d = len(z)
    used = rows.select(F.col(label).cast("double").alias("y"), *features).withColumn("s", F.explode(F.array(*map(F.lit, range(len(asked))))))
    used = used.where(_knows(subsets, asked, features))
    named = used.select("s", "y", *[x.alias(f"z{j}") for j, x in enumerate(z)])
    eta = _pick(weights[asked, 0]) * F.col("z0")
    for j in range(1, d):
        eta = eta + _pick(weights[asked, j]) * F.col(f"z{j}")
    named = named.withColumn("eta", eta).withColumn("p", 1 / (1 + F.exp(-F.col("eta"))))
    y, p, e = F.col("y"), F.col("p"), F.col("eta")
    loss = F.log1p(F.exp(-F.abs(e))) + F.greatest(e, F.lit(0.0)) - y * e
    sums = [F.sum((y - p) * F.col(f"z{j}")).alias(f"g{j}") for j in range(d)]
    sums += [F.sum(p * (1 - p) * F.col(f"z{j}") * F.col(f"z{k}")).alias(f"h{j}_{k}") for j in range(d) for k in range(j, d)]
    return named.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"), *sums).collect()


def _pick(values) -> Column:
    """The value of the row's feature set."""
    return F.array(*[F.lit(float(v)) for v in values])[F.col("s")]


def _knows(subsets: list[list[str]], asked: list[int], features: list[str]) -> Column:
    out = F.lit(True)
    for f in features:
        needed = F.array(*[F.lit(f in subsets[s]) for s in asked])[F.col("s")]
        out = out & (~needed | F.col(f).isNotNull())
    return out


def scored(rows: DataFrame, fits: list[Fit]) -> DataFrame:
    """Each row once per fit that knows its features: `fit` (its number) and `probability`."""
    subsets = [f.features for f in fits]
    features = sorted({f for s in subsets for f in s})
    many = rows.withColumn("s", F.explode(F.array(*map(F.lit, range(len(fits))))))
    many = many.where(_knows(subsets, list(range(len(fits))), features))
    eta = _pick([f.intercept for f in fits])
    for name in features:
        weight = _pick([dict(zip(f.features, f.coefficients)).get(name, 0.0) for f in fits])
        eta = eta + weight * F.coalesce(F.col(name), F.lit(0.0))
    return many.withColumn("probability", 1 / (1 + F.exp(-eta))).withColumnRenamed("s", "fit")
