"""Classification and regression metrics.

Every metric starts from the counts of (label, prediction): one pass that combines before
the shuffle. The evaluators then work on the counts as weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.functions.labels import to_decimal, to_zero_one


AREAS = {"auroc": "areaUnderROC", "aupr": "areaUnderPR"}


def outcome_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per label and prediction."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).cast("double").alias("n"))


def unscored_rows(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: how many rows have no prediction, e.g. because their cluster has no model."""
    return df.agg(F.count_if(F.col(prediction).isNull()).alias("unscored"))


def _scored(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())


def _confusion(counts: DataFrame) -> DataFrame:
    def cell(prediction: float, label: float) -> Column:
        hit = (F.col("prediction") == prediction) & (F.col("label") == label)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0.0)).cast("bigint")

    return counts.agg(
        cell(1.0, 1.0).alias("tp"),
        cell(1.0, 0.0).alias("fp"),
        cell(0.0, 0.0).alias("tn"),
        cell(0.0, 1.0).alias("fn"),
    )


def confusion(df: DataFrame) -> DataFrame:
    """One row: tp, fp, tn, fn."""
    return _confusion(outcome_counts(df))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(-1.0))


def binary_ratios(cells: DataFrame) -> DataFrame:
    """Accuracy, precision and recall from the confusion row; -1 when a denominator is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return cells.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )


def _has_both(counts: DataFrame) -> bool:
    """Whether a positive and a negative row are there; areas under curves mean nothing otherwise."""
    row = counts.agg(F.bool_or(F.col("label") > 0.5).alias("p"), F.bool_or(F.col("label") <= 0.5).alias("n")).first()
    return bool(row["p"] and row["n"])


def _range_areas() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task function of a range of scores; made here, so that workers need not find this module."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For a range of scores, greatest first: its greatest score, its positives and negatives, and the area over its own negatives."""
        top, positives, negatives, area = None, 0.0, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            up, along = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("up", "along"))
            top = batch.column("prediction")[0].as_py() if top is None else top
            after = positives + np.cumsum(up)
            area += float(np.dot(along, after - up / 2))
            positives, negatives = float(after[-1]), negatives + float(along.sum())
        if top is not None:
            yield pa.RecordBatch.from_pydict({"top": [top], "up": [positives], "along": [negatives], "area": [area]})

    return add_up


def _roc_area(df: DataFrame, n: Column) -> float:
    """Exact area under the ROC curve of rows that count ``n`` each, straight between neighbouring scores.

    Rows of a score are added up first. Scores are sorted by range, each range gives its own area, and the positives
    of the ranges above are added below its negatives; one row for each range is all that one task takes.
    """
    missing = F.col("label").isNull() | F.col("prediction").isNull()
    checked = F.when(missing, F.raise_error(F.lit("a row has no label or no prediction")).cast("double")).otherwise(n)
    positive = F.col("label") > 0.5
    sides = {"up": F.when(positive, checked).otherwise(0.0), "along": F.when(positive, 0.0).otherwise(checked)}
    scores = df.groupBy(F.col("prediction").cast("double").alias("prediction")).agg(*[F.sum(c).alias(side) for side, c in sides.items()])
    scores = scores.repartitionByRange(F.desc("prediction"))
    ranges = scores.sortWithinPartitions(F.desc("prediction")).mapInArrow(_range_areas(), "top double, up double, along double, area double")
    above = F.coalesce(F.sum("up").over(W.orderBy(F.desc("top")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    whole = ranges.withColumn("area", F.col("area") + F.col("along") * above)
    up, along, area = whole.agg(F.sum("up"), F.sum("along"), F.sum("area")).first()
    if up is None:
        return 0.5  # of no rows, the diagonal
    if not up or not along:
        return 1.0 if up else 0.0
    return area / (up * along)


def _binary(counts: DataFrame, metric: str) -> float:
    if metric == AREAS["auroc"]:
        return _roc_area(counts, F.col("n"))
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="prediction", labelCol="label", weightCol="n", metricName=metric, numBins=0
    )
    return evaluator.evaluate(counts)


def _multiclass(counts: DataFrame, metric: str) -> float:
    evaluator = MulticlassClassificationEvaluator(
        predictionCol="prediction", labelCol="label", weightCol="n", metricName=metric
    )
    return evaluator.evaluate(counts)


def area_under_roc(df: DataFrame) -> float:
    """Exact area under the ROC curve of ``prediction``, ties counting half."""
    return _roc_area(df.select(F.col("label").cast("double"), "prediction"), F.lit(1.0))


def area_under_pr(df: DataFrame) -> float:
    return _binary(outcome_counts(df), "areaUnderPR")


def weighted_precision_recall(df: DataFrame) -> DataFrame:
    """One row: accuracy and the label-weighted precision and recall, from class totals."""
    counts = outcome_counts(df)
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0.0))
    labels = counts.groupBy(F.col("label").alias("class")).agg(
        F.sum("n").alias("actual"), F.sum(right).alias("hits")
    )
    predicted = counts.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    total = F.sum("actual")
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    return labels.join(predicted, "class", "left").agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.try_divide(F.sum(precision * F.col("actual")), total).alias("weightedPrecision"),
        F.try_divide(F.sum("hits"), total).alias("weightedRecall"),
    )


def _one_row(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    row = [F.lit(value).cast("double").alias(name) for name, value in values.items()]
    return df.sparkSession.range(1).select(*row)


def evaluate_multiclass(df: DataFrame) -> DataFrame:
    """One row: area under ROC, accuracy, weighted precision and recall, to 3 places; rows without label or prediction stay out.

    The area is NULL where one of the classes has no row; with nothing scored every metric is NULL.
    """
    counts = outcome_counts(_scored(df)).persist()
    try:
        shares = ("accuracy", "weightedPrecision", "weightedRecall")
        some = not counts.isEmpty()
        values = {"auroc": _binary(counts, "areaUnderROC") if some and _has_both(counts) else None}
        values |= {name: _multiclass(counts, name) if some else None for name in shares}
    finally:
        counts.unpersist()
    return _one_row(df, values).select(*[to_decimal(F.col(c), 3).alias(c) for c in values])


def evaluate_binary(df: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, areas under ROC and PR, to 3 places; rows without label or prediction stay out.

    Ratios are -1 where there is nothing to divide by, so with nothing scored; areas are NULL where one of the
    classes has no row.
    """
    counts = outcome_counts(_scored(df)).persist()
    try:
        both = _has_both(counts)
        values = binary_ratios(_confusion(counts)).first().asDict()
        values |= {name: _binary(counts, metric) if both else None for name, metric in AREAS.items()}
    finally:
        counts.unpersist()
    return _one_row(df, values).select(*[to_decimal(F.col(c), 3).alias(c) for c in values])


def evaluate_binary_by(df: DataFrame, key: str) -> DataFrame:
    """:func:`evaluate_binary` for each value of a key, for predictions that are classes 0 or 1; one aggregate for all.

    A key whose rows have no label or no prediction keeps its row, with -1 and NULL. The areas are those of a
    curve with one step: through the point of the predicted positives.
    """
    known = F.col("label").isNotNull() & F.col("prediction").isNotNull()

    def cell(prediction: float, label: float) -> Column:
        return F.count_if(known & (F.col("prediction") == prediction) & (F.col("label") == label))

    cells = df.groupBy(key).agg(cell(1, 1).alias("tp"), cell(1, 0).alias("fp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    recall, right = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    share = F.try_divide(tp + fn, tp + fn + tn + fp)
    precision = F.coalesce(F.try_divide(tp, tp + fp), share)
    areas = {"auroc": (recall + right) / 2, "aupr": recall * precision + (1 - recall) * (precision + share) / 2}
    values = {
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        **{name: F.when((tp + fn > 0) & (tn + fp > 0), area) for name, area in areas.items()},
    }
    return cells.select(key, *[to_decimal(v, 3).alias(name) for name, v in values.items()])


def evaluate_predictions(df: DataFrame) -> DataFrame:
    """:func:`evaluate_binary` for labels and predictions given as 1/2."""
    return evaluate_binary(
        df.select(
            to_zero_one(F.col("label")).alias("label"), to_zero_one(F.col("prediction")).alias("prediction")
        )
    )


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    rows = df.select(F.col(label).cast("double"), F.col(prediction).cast("double"))
    return RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction).evaluate(rows)
