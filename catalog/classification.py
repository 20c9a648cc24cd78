"""Classification and regression metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_SCORED_PAIRS, ctes, scored_pairs, sql_round, table
from catalog.registry import query
from matchloom.functions.labels import add_one, rounded
from matchloom.operators import classification as metrics

_OUTCOMES = "outcomes AS (SELECT quality::DOUBLE AS label, toxic::DOUBLE AS prediction FROM labels)"

_CONFUSION = """confusion AS (
  SELECT count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp,
         count(*) FILTER (prediction = 0 AND label = 0) AS tn, count(*) FILTER (prediction = 0 AND label = 1) AS fn
  FROM outcomes)"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / ({whole})::DOUBLE ELSE -1e0 END"


_ACCURACY = _ratio("tp + tn", "tp + tn + fp + fn")
_PRECISION = _ratio("tp", "tp + fp")
_RECALL = _ratio("tp", "tp + fn")

_CURVE = """steps AS (
  SELECT prediction, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM outcomes GROUP BY prediction),
curve AS (
  SELECT prediction, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS ps, sum(n) OVER () AS ns
  FROM steps WINDOW w AS (ORDER BY prediction DESC)),
points AS (
  SELECT *, tp / (tp + fp) AS prec, lag(tp, 1, 0) OVER (ORDER BY prediction DESC) AS tp0,
         lag(tp / (tp + fp)) OVER (ORDER BY prediction DESC) AS prec0 FROM curve),
areas AS (
  SELECT sum(p * (ns - fp + n / 2)) / (any_value(ps) * any_value(ns)) AS auroc,
         sum((tp - tp0) / ps * (prec + coalesce(prec0, prec)) / 2) AS aupr FROM points)"""

_WEIGHTED = """classes AS (
  SELECT c, (SELECT count(*) FROM outcomes WHERE label = c) AS actual,
         (SELECT count(*) FROM outcomes WHERE prediction = c) AS predicted,
         (SELECT count(*) FROM outcomes WHERE label = c AND prediction = c) AS hits
  FROM (SELECT DISTINCT label AS c FROM outcomes)),
weighted AS (
  SELECT sum(hits) / sum(actual) AS accuracy,
         sum(actual * coalesce(hits / nullif(predicted, 0), 0)) / sum(actual) AS "weightedPrecision",
         sum(hits) / sum(actual) AS "weightedRecall" FROM classes)"""


def outcomes(spark, sf):
    return table(spark, sf, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )


def scores_as_predictions(spark, sf):
    return scored_pairs(spark, sf).withColumnRenamed("score", "prediction")


_SCORES = SQL_SCORED_PAIRS + ",\noutcomes AS (SELECT label, score AS prediction FROM scored_pairs)"


def _value(spark, name, number):
    return spark.range(1).select(rounded(F.lit(float(number))).alias(name))


@query("confusion", ctes(_OUTCOMES, _CONFUSION) + "SELECT * FROM confusion")
def confusion(spark, sf):
    return metrics.confusion(outcomes(spark, sf))


@query(
    "binary_metrics",
    ctes(_OUTCOMES, _CONFUSION)
    + f"""SELECT {sql_round(_ACCURACY)} AS accuracy, {sql_round(_PRECISION)} AS precision,
       {sql_round(_RECALL)} AS recall FROM confusion""",
)
def binary_metrics(spark, sf):
    ratios = metrics.binary_ratios(metrics.confusion(outcomes(spark, sf)))
    return ratios.select(*[rounded(F.col(c)).alias(c) for c in ratios.columns])


@query("auroc", ctes(_SCORES, _CURVE) + f"SELECT {sql_round('auroc')} AS auroc FROM areas")
def auroc(spark, sf):
    return _value(spark, "auroc", metrics.area_under_roc(scores_as_predictions(spark, sf)))


@query("aupr", ctes(_SCORES, _CURVE) + f"SELECT {sql_round('aupr')} AS aupr FROM areas")
def aupr(spark, sf):
    return _value(spark, "aupr", metrics.area_under_pr(scores_as_predictions(spark, sf)))


@query(
    "weighted_pr",
    ctes(_OUTCOMES, _WEIGHTED)
    + f"""SELECT {sql_round("accuracy")} AS accuracy, {sql_round('"weightedPrecision"')} AS "weightedPrecision",
       {sql_round('"weightedRecall"')} AS "weightedRecall" FROM weighted""",
)
def weighted_pr(spark, sf):
    report = metrics.weighted_precision_recall(outcomes(spark, sf))
    return report.select(*[rounded(F.col(c)).alias(c) for c in report.columns])


@query(
    "evaluate_multiclass",
    ctes(_OUTCOMES, _CURVE, _WEIGHTED)
    + """SELECT round(auroc, 3) AS auroc, round(accuracy, 3) AS accuracy,
       round("weightedPrecision", 3) AS "weightedPrecision", round("weightedRecall", 3) AS "weightedRecall"
    FROM areas, weighted""",
)
def evaluate_multiclass(spark, sf):
    return metrics.evaluate_multiclass(outcomes(spark, sf))


_BUNDLE = f"""SELECT round({_ACCURACY}, 3) AS accuracy, round({_PRECISION}, 3) AS precision,
    round({_RECALL}, 3) AS recall, round(auroc, 3) AS auroc, round(aupr, 3) AS aupr FROM confusion, areas"""


@query("evaluate_binary", ctes(_OUTCOMES, _CONFUSION, _CURVE) + _BUNDLE)
def evaluate_binary(spark, sf):
    return metrics.evaluate_binary(outcomes(spark, sf))


@query("evaluate_predictions", ctes(_OUTCOMES, _CONFUSION, _CURVE) + _BUNDLE)
def evaluate_predictions(spark, sf):
    return metrics.evaluate_predictions(
        outcomes(spark, sf).select(*[add_one(F.col(c)).alias(c) for c in ("label", "prediction")])
    )


@query(
    "rmse",
    ctes(_SCORES) + f"SELECT {sql_round('sqrt(avg((label - prediction) ** 2))')} AS rmse FROM outcomes",
)
def rmse(spark, sf):
    return _value(spark, "rmse", metrics.rmse(scores_as_predictions(spark, sf)))
