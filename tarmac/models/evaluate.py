"""Evaluation of on-time forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.functions.predicates import probability_band

THRESHOLD = 0.7


def categorical(predictions: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Totals and correct shares of both predicted classes, in one pass.

    Class 1 is "on time", so a predicted 0 means the meeting is cancelled.
    """
    return _summary(predictions, F.col(prediction) == 1)


def probabilistic(predictions: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The same for a probability cut at the threshold, plus accuracy and RMSE over all rows."""
    return _summary(predictions, F.col("probability") >= threshold, with_error=True)


def near_threshold(predictions: DataFrame, low: float = 0.65, high: float = 0.75) -> DataFrame:
    return probabilistic(predictions.where(probability_band("probability", low, high)))


def _summary(rows: DataFrame, keep, with_error: bool = False) -> DataFrame:
    on_time = F.col("label") == 1
    extra = []
    if with_error:
        error = F.col("label") - F.col("probability")
        extra = [
            F.try_divide(F.count_if(keep == on_time), F.count(F.lit(1))).alias("accuracy"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        ]
    return rows.agg(
        F.count_if(~keep).alias("total_cancel"),
        F.try_divide(F.count_if(~keep & ~on_time), F.count_if(~keep)).alias("correct_cancel"),
        F.count_if(keep).alias("total_nocancel"),
        F.try_divide(F.count_if(keep & on_time), F.count_if(keep)).alias("correct_nocancel"),
        *extra,
    )
