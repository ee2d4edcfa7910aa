"""Putting frames on top of each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_trips(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; every frame must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
