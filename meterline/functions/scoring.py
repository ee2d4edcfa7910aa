"""Batch scoring with a Python model, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Model = Callable[[pd.DataFrame], pd.Series]


def minutes_by_distance(batch: pd.DataFrame) -> pd.Series:
    """Stand-in model: five minutes per distance unit."""
    return batch["trip_distance"] * 5.0


def predict_duration(df: DataFrame, model: Model = minutes_by_distance, features: tuple[str, ...] = ("trip_distance",),
                     name: str = "predicted_duration") -> DataFrame:
    """Add a model's prediction to every row.

    Only the feature columns travel to Python, batch by batch; all others stay
    in the JVM. A model with costly set-up does it once per task, on first call.
    """
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield model(batch).astype("float64")

    return df.withColumn(name, score(F.struct(*features)))
