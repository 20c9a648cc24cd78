"""Precision and recall over score cuts, and score buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.functions.labels import score_to_bucket

# Cuts 0.02, 0.04, ... 0.98.
CUTS_PER_UNIT = 50
LAST_CUT = 49


def precision_recall_at(df: DataFrame, cut: float) -> DataFrame:
    """One row: precision and recall when scores above the cut count as positive.

    NULL instead of a division by zero.
    """
    positive, predicted = F.col("label") == 1.0, F.col("score") > F.lit(cut)
    counts = df.agg(
        F.count_if(positive).alias("positives"),
        F.count_if(predicted).alias("predicted"),
        F.count_if(positive & predicted).alias("hits"),
    )
    return counts.select(
        F.lit(cut).alias("cut"),
        F.try_divide(F.col("hits"), F.col("predicted")).alias("precision"),
        F.try_divide(F.col("hits"), F.col("positives")).alias("recall"),
    )


def _cut(number: Column) -> Column:
    return F.round(number / F.lit(float(CUTS_PER_UNIT)), 2)


def _cuts_below(score: Column) -> Column:
    """How many cuts are strictly below the score: a guess from its size, then set right."""
    clipped = F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))
    guess = F.least(F.floor(clipped * CUTS_PER_UNIT).cast("int"), F.lit(LAST_CUT))
    too_many = F.when(_cut(guess) >= score, 1).otherwise(0)
    too_few = F.when((guess < LAST_CUT) & (_cut(guess + 1) < score), 1).otherwise(0)
    return F.greatest(guess - too_many + too_few, F.lit(0))


def _cut_counts(df: DataFrame) -> DataFrame:
    """Rows and positives above each cut.

    Every score falls in one of 50 steps, counted before the shuffle; the running sums go
    over these 50 rows.
    """
    steps = (
        df.where(F.col("score").isNotNull())
        .groupBy(_cuts_below(F.col("score").cast("double")).alias("step"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1.0).alias("positives"))
    )
    all_steps = df.sparkSession.range(0, LAST_CUT + 1, 1, 1).select(F.col("id").cast("int").alias("step"))
    from_top = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        all_steps.join(F.broadcast(steps), "step", "left")
        .select(
            "step",
            F.coalesce(F.sum("rows").over(from_top), F.lit(0)).alias("above"),
            F.coalesce(F.sum("positives").over(from_top), F.lit(0)).alias("positivesAbove"),
        )
        .where(F.col("step") > 0)
        .withColumn("cut", _cut(F.col("step")))
    )


def cut_summary(df: DataFrame) -> DataFrame:
    """Number of rows scored above each cut."""
    return _cut_counts(df.select("score", F.lit(None).cast("double").alias("label"))).select("cut", "above")


def precision_recall_curve(df: DataFrame) -> DataFrame:
    """Precision and recall at each cut; NULL where the denominator is 0."""
    positives = df.agg(F.count_if(F.col("label") == 1.0).alias("n")).scalar()
    return (
        _cut_counts(df.select("score", "label"))
        .select(
            "cut",
            F.try_divide(F.col("positivesAbove"), F.col("above")).alias("precision"),
            F.try_divide(F.col("positivesAbove"), positives).alias("recall"),
        )
        .orderBy("cut")
    )


def score_buckets(df: DataFrame) -> DataFrame:
    """Positives per tenth of the score scale, with their share."""
    counts = (
        df.where(F.col("label") == 1.0)
        .groupBy(score_to_bucket(F.col("score").cast("double")).alias("bucket"))
        .count()
    )
    return counts.withColumn("percent", F.col("count") / F.sum("count").over(W.partitionBy()))
