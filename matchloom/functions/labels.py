"""Labels and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def application_status(flag: Column) -> Column:
    """1.0 for any known flag, true or false; NULL stays NULL."""
    return F.when(flag.isNotNull(), F.lit(1.0))


def click_label(apply_flag: Column, click: Column) -> Column:
    """1.0 for a click, else 0.0. The application flag plays no part."""
    return F.when(click, F.lit(1.0)).otherwise(F.lit(0.0))


def add_one(value: Column) -> Column:
    """0/1 labels to 1/2 labels."""
    return value.cast("double") + F.lit(1.0)


def to_zero_one(value: Column) -> Column:
    """1/2 labels back to 0/1. NULL stays NULL."""
    return F.when(value > 1, F.lit(1.0)).when(value.isNotNull(), F.lit(0.0))


def score_to_label(score: Column, cut: float) -> Column:
    """1.0 when the score is strictly above the cut, else 0.0. NULL scores stay NULL."""
    return F.when(score > F.lit(cut), F.lit(1.0)).when(score.isNotNull(), F.lit(0.0))


def score_to_bucket(score: Column) -> Column:
    """Tenth of the score scale, truncated."""
    return (score * 10).cast("int")


def to_decimal(value: Column, places: int) -> Column:
    """Round half up."""
    return F.round(value, places)


def rounded(value: Column, places: int = 6) -> Column:
    """Round half up and turn -0.0 into 0.0."""
    return F.round(value, places) + F.lit(0.0)


def to_double(value: Column) -> Column:
    return value.cast("double")
