"""Least squares, trees and forests on MLlib with the settings of the pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions.scalars import yesno_to_int
from obsledger.operators.clean import add_calendar, drop_missing

# MLlib allows a depth of 30 at most; it stands for unlimited depth.
MAX_DEPTH = 30
MAX_BINS = 128
# Rows from which on a forest is fitted on rows put in order.
ORDERED_ROWS = 100_000


def fit_regressor(df: DataFrame, features: Sequence[str], target: str, kind: str = "ols", **params) -> PipelineModel:
    """Fit ols, tree or forest on rows that have the target and all features."""
    makers = {
        "ols": lambda: LinearRegression(solver="normal", **params),
        "tree": lambda: DecisionTreeRegressor(**{"maxDepth": MAX_DEPTH, "maxBins": MAX_BINS, "seed": 42, **params}),
        "forest": lambda: RandomForestRegressor(**{
            "numTrees": 100, "maxDepth": MAX_DEPTH, "maxBins": MAX_BINS,
            "featureSubsetStrategy": "all", "seed": 42, **params}),
    }
    if kind not in makers:
        raise ValueError(f"regressor {kind} is not supported")
    learner = makers[kind]().setFeaturesCol("features").setLabelCol(target).setPredictionCol("prediction")
    rows = df.select(*features, F.col(target).cast("double").alias(target)).dropna()
    steps = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), learner])
    return steps.fit(neighbours(rows, features, target) if kind == "forest" else rows)


def neighbours(rows: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """A large frame with the rows of each task in order, features of few values first; a small one as it is.

    At every level a forest leads each row down each tree and adds it to the
    bins of its node. Neighbours in this order meet the same nodes and bins,
    so these stay in the processor's cache. Which row draws which bootstrap
    count follows from the order; it no longer hangs on how rows arrive.
    """
    seen = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(features)]).first()
    if seen["_n"] < ORDERED_ROWS:
        return rows
    by = [c for _, _, c in sorted((seen[f"_d{i}"], i, c) for i, c in enumerate(features))]
    return rows.sortWithinPartitions(*by, target)


def fit_from_params(df: DataFrame, target: str, params: Mapping) -> PipelineModel:
    """Forest of ``target`` on all other numeric columns, described by a parameter mapping."""
    if params["model_type"] != "RandomForestRegressor":
        raise ValueError(f"model type {params['model_type']} is not supported")
    features = [c for c, t in df.dtypes if c != target and t in ("double", "float", "int", "bigint")]
    return fit_regressor(df, features, target, "forest", numTrees=params["n_estimators"],
                         maxDepth=params["max_depth"], seed=params["random_state"])


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Score rows; rows with a missing feature are left out. ``keep`` selects the returned columns."""
    inputs = model.stages[0].getInputCols()
    out = model.transform(df.dropna(subset=list(inputs)))
    return out.select(*keep, "prediction") if keep else out.drop("features")


def coefficients(model: PipelineModel, spark) -> DataFrame:
    """(term, value) rows of a fitted line, intercept first."""
    line, names = model.stages[-1], model.stages[0].getInputCols()
    rows = [("intercept", float(line.intercept))] + [(n, float(v)) for n, v in zip(names, line.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")


# ---- next-day classifier ------------------------------------------------------------

CALENDAR = ("Year", "Month", "Day", "DayOfWeek", "Quarter")


def prepare_inference(df: DataFrame, entity: str, measures: Sequence[str], today: str,
                      calendar: Sequence[str] = CALENDAR, keys: Sequence[str] = ()) -> DataFrame:
    """Rows without missing inputs, today's Yes/No as 1/0, columns in model order, row keys kept."""
    needed = [entity, *measures, today, *calendar]
    rows = drop_missing(df, needed).withColumn(today, yesno_to_int(today))
    return rows.select(*dict.fromkeys([*keys, entity, *measures, today, *calendar]))


def fit_label_forest(df: DataFrame, entity: str, numeric: Sequence[str], label: str, **params) -> PipelineModel:
    """Forest classifier on numeric columns plus the one-hot entity.

    The entity is indexed into a sparse vector, so thousands of entities cost
    one column; an entity unseen in training gets an all-zero vector.
    """
    learner = RandomForestClassifier(**{"numTrees": 100, "maxDepth": 20, "maxBins": MAX_BINS, "seed": 42, **params})
    steps = [
        StringIndexer(inputCol="_entity", outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_index", outputCol="_hot", dropLast=True),
        VectorAssembler(inputCols=[*numeric, "_hot"], outputCol="features"),
        learner.setFeaturesCol("features").setLabelCol("_label"),
    ]
    rows = (df.dropna(subset=[entity, *numeric, label])
              .select(F.col(entity).cast("string").alias("_entity"), *numeric, F.col(label).cast("double").alias("_label")))
    return Pipeline(stages=steps).fit(rows)


def batch_predict(model: PipelineModel, df: DataFrame, entity: str, keep: Sequence[str],
                  out: str = "PredictedRainTomorrow") -> DataFrame:
    """Score prepared rows keeping their keys; absent numeric inputs count as 0."""
    wanted = [c for c in model.stages[2].getInputCols() if c != "_hot"]
    full = df.withColumns({c: F.lit(0) for c in wanted if c not in df.columns})
    scored = model.transform(full.withColumn("_entity", F.col(entity).cast("string")))
    return scored.select(*keep, F.col("prediction").cast("int").alias(out))


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    return add_calendar(df, date, CALENDAR, labels=None)
