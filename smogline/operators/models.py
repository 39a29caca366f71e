"""Regression and classification models on the feature columns."""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from smogline.operators.boosting import SOFTMAX, SQUARED, GradientBoosting, GradientBoostingModel
from smogline.operators.evaluate import (
    best_model,
    classification_metrics,
    compared,
    leaderboard,
    regression_metrics,
)
from smogline.schema import BUCKET, CALENDAR, INDEX, PLACE_CODE, POLLUTANTS, present
from smogline.session import shared_folder, small_table


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Profile:
    """Model sizes."""

    name: str
    trees: int
    depth: int
    stages: int
    stage_depth: int
    iterations: int
    bins: int
    leaf: int = 2
    rate: float = 0.1
    seed: int = 42
    # Room of every task for node statistics per pass over the data.
    memory_mb: int = 256
    # Models fitted at once, where the rows are few: each keeps its own binned copy of them.
    at_once: int = 1


FULL = Profile("full", trees=200, depth=15, stages=200, stage_depth=5, iterations=1000, bins=128)
SMOKE = Profile("smoke", trees=10, depth=8, stages=5, stage_depth=5, iterations=1000, bins=32, at_once=3)

#: Train rows beyond which models are fitted one after another, over parts that the cores can share.
FEW_ROWS = 10_000_000
#: So many parts per core leave hardly a core idle in the last round of tasks.
PARTS_PER_CORE = 4

REGRESSION = "regression"
CLASSIFICATION = "classification"


def boosting(loss: str, p: Profile) -> GradientBoosting:
    return GradientBoosting(loss=loss, maxIter=p.stages, stepSize=p.rate, maxDepth=p.stage_depth, maxBins=p.bins)


def regressors(p: Profile = FULL) -> dict[str, object]:
    """Estimators by name, in order of preference (M6-M8)."""
    io = {"featuresCol": "features", "labelCol": "label"}
    trees = {"seed": p.seed, "maxBins": p.bins, "maxMemoryInMB": p.memory_mb}
    return {
        "Linear Regression": LinearRegression(regParam=0.0, solver="normal", **io),
        "Random Forest Regressor": RandomForestRegressor(
            numTrees=p.trees, maxDepth=p.depth, minInstancesPerNode=p.leaf,
            featureSubsetStrategy="all", **trees, **io,
        ),
        "Gradient Boosting Regressor": boosting(SQUARED, p),
    }


def classifiers(p: Profile = FULL, train_rows: int = 1) -> dict[str, object]:
    """Estimators by name.

    The penalty of the logistic model is that of C = 1 on a summed loss.
    """
    io = {"featuresCol": "features", "labelCol": "label"}
    trees = {"seed": p.seed, "maxBins": p.bins, "maxMemoryInMB": p.memory_mb}
    return {
        "Logistic Regression": LogisticRegression(
            family="multinomial", maxIter=p.iterations, regParam=1.0 / train_rows,
            elasticNetParam=0.0, standardization=False, **io,
        ),
        "Random Forest Classifier": RandomForestClassifier(
            numTrees=p.trees, maxDepth=p.depth, minInstancesPerNode=p.leaf,
            featureSubsetStrategy="sqrt", **trees, **io,
        ),
        "Gradient Boosting Classifier": boosting(SOFTMAX, p),
    }


def encoding_stages(task: str) -> list[object]:
    """Calendar parts, place code and class label from cleaned rows (M1, M2).

    They are part of each saved model, so that it scores plain rows. The place
    code is an ordinary number for the trees: a cast drops the category
    metadata. A place not seen in training gets a code of its own.
    """
    calendar = (
        "SELECT *, year(Date) AS Year, month(Date) AS Month, dayofmonth(Date) AS Day, "
        "weekday(Date) AS DayOfWeek, quarter(Date) AS Quarter, dayofyear(Date) AS DayOfYear, "
        "weekday(Date) >= 5 AS IsWeekend, "
        "coalesce(CAST(City AS STRING), 'nan') AS city_text FROM __THIS__"
    )
    stages = [
        SQLTransformer(statement=calendar),
        StringIndexer(
            inputCol="city_text", outputCol="city_index",
            stringOrderType="alphabetAsc", handleInvalid="keep",
        ),
        SQLTransformer(statement=f"SELECT *, CAST(city_index AS DOUBLE) AS {PLACE_CODE} FROM __THIS__"),
    ]
    if task == CLASSIFICATION:
        stages.append(StringIndexer(inputCol=BUCKET, outputCol="label", stringOrderType="alphabetAsc"))
    return stages


def scaling_stages(measured: list[str], impute: bool = False) -> list[object]:
    """Vectors with mean 0 and deviation 1 (M5); ``impute`` fills gaps with train medians."""
    stages: list[object] = []
    if impute:
        stages.append(Imputer(inputCols=measured, outputCols=measured, strategy="median"))
    return stages + [
        VectorAssembler(inputCols=[*measured, *CALENDAR, PLACE_CODE], outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


@dataclass
class Trained:
    """Fitted models of one task and how they compare."""

    task: str
    profile: str
    models: dict[str, PipelineModel]
    seconds: dict[str, float]
    board: DataFrame
    best_name: str

    @property
    def best(self) -> PipelineModel:
        return self.models[self.best_name]


def train(
    task: str, marked: DataFrame, profile: Profile = FULL, impute: bool = False, flag: str = "is_test"
) -> Trained:
    """Fit all models of a task, score the test rows and pick the best.

    Dictionaries cover the whole table, means and deviations the train rows
    only. Both are fitted once, and the vectors are kept for all fits. Each fit
    is a distributed job; all models score the test rows in one projection. The
    driver holds only models and a few scores. With
    several fits at once, the fit times include waiting for each other.
    """
    spark = marked.sparkSession
    shared_folder(spark)
    encoders = Pipeline(stages=encoding_stages(task)).fit(marked)
    encoded = encoders.transform(marked)
    train_rows, test_rows = encoded.where(~F.col(flag)), encoded.where(F.col(flag))
    scaler = Pipeline(stages=scaling_stages(present(marked, POLLUTANTS), impute)).fit(train_rows)

    def label(df: DataFrame) -> DataFrame:
        return df if task == CLASSIFICATION else df.withColumn("label", F.col(INDEX))

    vectors = label(scaler.transform(_dealt(train_rows, train_rows.count()))).select("features", "label")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    held_out = label(scaler.transform(test_rows)).select("features", "label")
    rows = vectors.count()
    estimators = regressors(profile) if task == REGRESSION else classifiers(profile, max(rows, 1))
    measure = regression_metrics if task == REGRESSION else classification_metrics

    @inheritable_thread_target(spark)
    def fit(estimator):
        started = time.monotonic()
        fitted = estimator.fit(vectors)
        return fitted, round(time.monotonic() - started, 3)

    with ThreadPoolExecutor(profile.at_once if rows <= FEW_ROWS else 1) as pool:
        outcomes = dict(zip(estimators, pool.map(fit, estimators.values())))
    scored, columns = held_out, {}
    for k, (name, (fitted, _)) in enumerate(outcomes.items()):
        columns[name] = f"prediction_{k}"
        scored = fitted.copy({fitted.predictionCol: columns[name]}).transform(scored)
        scored = scored.select("features", "label", *columns.values())
    found = compared(scored, "label", columns, measure).collect()
    models, seconds, scores = {}, {}, []
    for name, (fitted, spent) in outcomes.items():
        seconds[name] = spent
        own = [(r["metric"], r["value"]) for r in found if r["model"] == name]
        scores.append((task, name, small_table(spark, own, {"metric": "string", "value": "double"})))
        models[name] = PipelineModel(
            stages=[*encoders.stages, *scaler.stages, fitted, *_class_names(task, encoders)]
        )
    vectors.unpersist()
    spent = small_table(spark, list(seconds.items()), {"model": "string", "fit_seconds": "double"})
    board = (
        leaderboard(scores)
        .join(spent, "model")
        .withColumn("profile", F.lit(profile.name))
        .select("task", "model", "ord", "metric", "value", "fit_seconds", "profile")
    )
    best = best_model(board).first()["best_model"]
    return Trained(task, profile.name, models, seconds, board, best)


def _dealt(df: DataFrame, rows: int) -> DataFrame:
    """Many rows in few splits dealt out anew, so that no pass of a fit ends with a round of a few tasks.

    A fit passes over the rows up to hundreds of times; they are shuffled once. Above
    ``PARTS_PER_CORE`` splits a core, that is at any larger size, nothing is shuffled.
    """
    parts = PARTS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts) if rows > FEW_ROWS and df.rdd.getNumPartitions() < parts else df


def _class_names(task: str, encoders: PipelineModel) -> list[object]:
    if task == REGRESSION:
        return []
    return [
        IndexToString(inputCol="prediction", outputCol="predicted_bucket", labels=encoders.stages[-1].labels)
    ]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions for rows with the cleaned columns."""
    return model.transform(df).drop("city_text", "city_index", "raw_features", "features")


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Rows (feature, importance) of a fitted model; none for one without.

    Names come from the assembler of the same model.
    """
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    fitted = next(s for s in reversed(model.stages) if not isinstance(s, IndexToString))
    rows = []
    if hasattr(fitted, "featureImportances"):
        rows = [(name, float(share)) for name, share in zip(names, fitted.featureImportances.toArray())]
    else:
        log.warning("%s has no feature importances", type(fitted).__name__)
    return small_table(spark, rows, {"feature": "string", "importance": "double"})


def fitted_scaler_stats(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Mean and deviation by which a fitted model scales each feature, as rows."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    rows = [(n, float(m), float(d)) for n, m, d in zip(names, scaler.mean, scaler.std)]
    return small_table(spark, rows, {"feature": "string", "mean": "double", "std": "double"})


def structure(models: dict[str, PipelineModel]) -> list[tuple[str, str, float]]:
    """(model, property, value) of fitted estimators: trees, stages, greatest depth, smallest leaf, coefficients."""
    found = []
    for name, model in models.items():
        fitted = next(s for s in reversed(model.stages) if not isinstance(s, IndexToString))
        facts: dict[str, float] = {}
        if isinstance(fitted, GradientBoostingModel):
            trees = fitted.trees
            used = trees.rows > 0
            node = np.nonzero(used)[1]
            facts = {
                "trees": len(trees.feature), "stages": len(fitted.losses) - 1,
                "depth": int(np.log2(node.max() + 1)) if len(node) else 0,
                "smallest_leaf": int(trees.rows[used & (trees.feature < 0)].min()),
            }
        elif hasattr(fitted, "trees"):
            facts = {"trees": len(fitted.trees), "depth": max(t.depth for t in fitted.trees)}
        elif hasattr(fitted, "coefficientMatrix"):
            facts = {"coefficients": fitted.coefficientMatrix.numRows * fitted.coefficientMatrix.numCols}
        elif hasattr(fitted, "coefficients"):
            facts = {"coefficients": len(fitted.coefficients)}
        found += [(name, key, float(value)) for key, value in facts.items()]
    return found


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per feature, as rows."""
    one = df.agg(
        *[
            F.struct(
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_pop(F.col(c).cast("double")).alias("std"),
            ).alias(c)
            for c in columns
        ]
    )
    return one.unpivot([], columns, "feature", "s").select("feature", "s.mean", "s.std")


def scaled(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """The columns standardised with the given statistics (M5).

    A feature that does not vary is only centred. The statistics are one row
    per feature and come as literals.
    """
    known = {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(known[c][0])) / F.lit(known[c][1] or 1.0)
            for c in columns
            if known[c][0] is not None
        }
    )
