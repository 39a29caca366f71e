"""Registered queries: each operator over the whole derived observation table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smogline.functions import scalars
from smogline.functions.calendar import to_day, with_calendar
from smogline.operators import clean as cleaning
from smogline.operators import encode, evaluate, explore, models, profile, quantiles, split
from smogline.operators.correlation import correlation_matrix as correlate
from smogline.plans import pipeline
from smogline.plans.observations import observations, once, staged_clean, staged_observations
from smogline.schema import (
    BUCKET,
    CORRELATED,
    DATE,
    FEATURES,
    INDEX,
    OBSERVATION,
    PLACE,
    POLLUTANTS,
)
from smogline.session import small_table, stage, staged_path
from smogline.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

# Columns that tell two cleaned rows apart; numbers go in as whole millionths,
# which every engine writes the same way.
IDENTITY = ["PM10", "SO2", "O3", "Benzene", "Toluene"]


def day_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, F.col(DATE).cast("string"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums depend on the order of addition in the last digits; show six."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def content_key() -> Column:
    millionths = [F.floor(F.col(c) * 1e6).cast("long").cast("string") for c in IDENTITY]
    parts = [F.col("k").cast("string"), F.col(PLACE), F.col(DATE).cast("string"), *millionths]
    return split.text_key(F.concat_ws("|", *parts))


def scratch(spark: SparkSession, name: str) -> str:
    return staged_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


# Scan and cleaning

def scan_observations(spark, folder):
    return day_as_text(observations(spark, folder))


def drop_missing_targets(spark, folder):
    return day_as_text(cleaning.drop_missing_targets(staged_observations(spark, folder)))


def column_medians(spark, folder):
    kept = cleaning.drop_missing_targets(staged_observations(spark, folder))
    return quantiles.median_table(kept, POLLUTANTS)


def impute_medians(spark, folder):
    kept = cleaning.drop_missing_targets(staged_observations(spark, folder))
    return day_as_text(cleaning.fill_medians(kept))


def remove_duplicates(spark, folder):
    return day_as_text(cleaning.drop_copies(staged_observations(spark, folder)))


def clean(spark, folder):
    return day_as_text(cleaning.clean(staged_observations(spark, folder)))


def cleaning_audit(spark, folder):
    return cleaning.cleaning_audit(staged_observations(spark, folder), staged_clean(spark, folder))


def observed_audit(spark, folder):
    """The audit from the counts of the one write."""
    cleaned, audit = cleaning.audited_clean(staged_observations(spark, folder))
    stage(cleaned, "audited")
    return audit()


def clean_without_columns(spark, folder):
    """Cleaning a table that lacks two of the measured columns."""
    return day_as_text(cleaning.clean(staged_observations(spark, folder).drop("NH3", "Xylene")))


# Profile

def null_counts(spark, folder):
    return profile.null_counts(staged_observations(spark, folder))


def table_info(spark, folder):
    return profile.table_info(staged_observations(spark, folder))


def shape(spark, folder):
    return profile.shape(staged_clean(spark, folder))


def preview(spark, folder):
    table = staged_clean(spark, folder)
    return day_as_text(profile.preview(table, order=[PLACE, DATE, "k", *POLLUTANTS, INDEX, BUCKET]))


def describe(spark, folder):
    table = profile.describe(staged_clean(spark, folder), [*POLLUTANTS, INDEX], digits=None)
    quartiles = {c: F.round(c, 9) for c in ("q25", "q50", "q75")}
    return rounded(table, "mean", "std").withColumns(quartiles)


def describe_dates(spark, folder):
    table = profile.describe_dates(staged_clean(spark, folder), [DATE])
    moments = ["mean", "min", "q25", "q50", "q75", "max"]
    return table.withColumns({m: F.date_format(m, "yyyy-MM-dd HH:mm:ss") for m in moments})


def column_range(spark, folder):
    return profile.value_range(staged_clean(spark, folder), INDEX)


def distinct_buckets(spark, folder):
    return profile.distinct_values(staged_clean(spark, folder), BUCKET)


def city_count(spark, folder):
    return profile.distinct_count(staged_clean(spark, folder), PLACE)


# Features

def temporal_features(spark, folder):
    return day_as_text(
        with_calendar(staged_clean(spark, folder)).select(PLACE, DATE, "k", INDEX, *FEATURES[12:19])
    )


def city_dictionary(spark, folder):
    return encode.dictionary(staged_clean(spark, folder), PLACE)


def encode_city(spark, folder):
    table = staged_clean(spark, folder).select("k", PLACE, INDEX)
    return encode.encode(table, PLACE, encode.dictionary(table, PLACE), "City_Encoded")


def encode_bucket(spark, folder):
    table = staged_clean(spark, folder).select("k", BUCKET, INDEX)
    codes = encode.dictionary(table, BUCKET)
    coded = encode.encode(table, BUCKET, codes, "code")
    return encode.decode(coded, "code", codes, "decoded")


def feature_matrix(spark, folder):
    return encode.feature_matrix(staged_clean(spark, folder))


# Exploration

def histogram(spark, folder):
    return rounded(explore.histogram(staged_clean(spark, folder)), "low", "high")


def density(spark, folder):
    table = explore.density(staged_clean(spark, folder))
    return table.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


def correlation_matrix(spark, folder):
    return rounded(correlate(staged_clean(spark, folder), CORRELATED), "value")


def correlation_with_gaps(spark, folder):
    return rounded(correlate(staged_observations(spark, folder), CORRELATED), "value")


def top_cities(spark, folder):
    return rounded(explore.top_means(staged_clean(spark, folder)), "mean_aqi")


def top_cities_for_display(spark, folder):
    """The top list as a bar chart shows it, from the bottom up."""
    table = explore.for_display(explore.top_means(staged_clean(spark, folder)), "mean_aqi", PLACE)
    place = F.row_number().over(Window.orderBy(F.asc_nulls_first("mean_aqi"), F.desc(PLACE)))  # 15 rows
    return rounded(table.withColumn("place", place), "mean_aqi")


def monthly_trend(spark, folder):
    return rounded(explore.monthly_trend(staged_clean(spark, folder)), "mean_aqi", "smoothed_aqi")


def bucket_counts(spark, folder):
    return explore.bucket_counts(staged_clean(spark, folder))


def axis_range(spark, folder):
    return explore.axis_range(staged_clean(spark, folder))


def explore_bundle(spark, folder):
    """Every value of every exploratory result."""
    rows = explore.long_rows(explore.explore(staged_clean(spark, folder)))
    digits = F.when(F.col("measure") == "density", F.round("value", 9)).otherwise(F.round("value", 6))
    return rows.withColumn("value", digits)


# Splits and scaling

def split_rows(spark, folder):
    return split.random_split(staged_clean(spark, folder), content_key())


def split_classes(spark, folder):
    return split.stratified_split(staged_clean(spark, folder), BUCKET, content_key())


def marked(spark, folder):
    """The cleaned rows with their split, staged for the queries that follow it."""
    return once("marked", spark, folder, lambda: split_rows(spark, folder))


def marked_by_class(spark, folder):
    return once("marked-by-class", spark, folder, lambda: split_classes(spark, folder))


def marked_places(spark, folder):
    """What the simple predictors of the index read of the marked rows, staged without the other columns."""
    return once("marked-places", spark, folder, lambda: split_rows(spark, folder).select(PLACE, DATE, INDEX, "is_test"))


def random_split(spark, folder):
    return day_as_text(split_rows(spark, folder).select("k", PLACE, DATE, INDEX, "is_test"))


def stratified_split(spark, folder):
    return day_as_text(split_classes(spark, folder).select("k", PLACE, DATE, BUCKET, "is_test"))


def split_of_many_classes(spark, folder):
    """A class per place and month: every one keeps its share."""
    month = F.concat_ws("|", PLACE, F.date_format(DATE, "yyyy-MM"))
    table = staged_clean(spark, folder).withColumn("place_month", month)
    marked = split.stratified_split(table, "place_month", content_key())
    return day_as_text(marked.select("k", "place_month", DATE, "is_test"))


def split_counts(spark, folder):
    return split_rows(spark, folder).groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"), F.sum(INDEX).alias("sum_aqi")
    )


def stratified_counts(spark, folder):
    return split_classes(spark, folder).groupBy(BUCKET, "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.sum(INDEX).alias("sum_aqi")
    )


def _train_statistics(spark, folder):
    features = encode.feature_matrix(marked(spark, folder), keep=["is_test"])
    numbers = features.withColumn("IsWeekend", F.col("IsWeekend").cast("int"))
    return numbers, models.scaler_stats(numbers.where(~F.col("is_test")), FEATURES)


def scaler_stats(spark, folder):
    return rounded(_train_statistics(spark, folder)[1], "mean", "std")


def scaled_checksum(spark, folder):
    """Mean and mean square of the scaled test rows per feature."""
    features, stats = _train_statistics(spark, folder)
    held_out = models.scaled(features.where("is_test"), stats, FEATURES)
    sums = held_out.agg(
        *[F.struct(F.avg(c).alias("mean"), F.avg(F.col(c) * F.col(c)).alias("square")).alias(c) for c in FEATURES]
    )
    return rounded(
        sums.unpivot([], FEATURES, "feature", "s").select("feature", "s.mean", "s.square"), "mean", "square"
    )


# Scores of simple predictors, so that every number can be checked

def _guesses(spark, folder):
    """Test rows with three guesses of the index from means of the train rows."""
    table = marked_places(spark, folder).withColumn("Month", F.month(DATE))
    train = table.where(~F.col("is_test"))
    overall = train.agg(F.avg(INDEX)).first()[0]
    by_city = explore.mean_by(train, PLACE, INDEX, "city_mean")
    by_month = train.groupBy(PLACE, "Month").agg(F.avg(INDEX).alias("month_mean"))
    return (
        table.where("is_test")
        .select(PLACE, "Month", INDEX)
        .join(by_city, PLACE, "left")
        .join(by_month, [PLACE, "Month"], "left")
        .select(
            INDEX,
            F.lit(overall).alias("overall"),
            F.coalesce("city_mean", F.lit(overall)).alias("city"),
            F.coalesce("month_mean", F.lit(overall)).alias("city_month"),
        )
    )


def _bands(value: Column) -> Column:
    return (
        F.when(value <= 60, "Good")
        .when(value <= 120, "Satisfactory")
        .when(value <= 200, "Moderate")
        .when(value <= 300, "Poor")
        .when(value <= 400, "Very Poor")
        .otherwise("Severe")
    )


def _classes(spark, folder):
    """Test rows with two guesses of the bucket from one measurement each, staged without the other columns."""
    guesses = [_bands(F.col("PM2_5")).alias("by_pm2_5"), _bands(F.col("PM10")).alias("by_pm10")]
    return once("classes", spark, folder, lambda: split_classes(spark, folder).where("is_test").select(BUCKET, *guesses))


def regression_metrics(spark, folder):
    return rounded(evaluate.regression_metrics(_guesses(spark, folder), INDEX, "city_month"), "value")


def classification_metrics(spark, folder):
    return rounded(evaluate.classification_metrics(_classes(spark, folder), BUCKET, "by_pm2_5"), "value")


def confusion_matrix(spark, folder):
    return rounded(evaluate.confusion_matrix(_classes(spark, folder), BUCKET, "by_pm2_5"), "pct")


def _board(spark, folder):
    guesses = stage(_guesses(spark, folder), "guesses")
    classes = _classes(spark, folder)
    scores = [
        ("regression", "Overall mean", evaluate.regression_metrics(guesses, INDEX, "overall")),
        ("regression", "City mean", evaluate.regression_metrics(guesses, INDEX, "city")),
        ("regression", "City and month mean", evaluate.regression_metrics(guesses, INDEX, "city_month")),
        ("classification", "PM2_5 bands", evaluate.classification_metrics(classes, BUCKET, "by_pm2_5")),
        ("classification", "PM10 bands", evaluate.classification_metrics(classes, BUCKET, "by_pm10")),
    ]
    return evaluate.leaderboard(scores)


def leaderboard(spark, folder):
    return _board(spark, folder)


def best_model(spark, folder):
    return evaluate.best_model(_board(spark, folder))


def marked_leaderboard(spark, folder):
    board = stage(_board(spark, folder), "board")
    table = evaluate.marked_leaderboard(board, evaluate.best_model(board))
    scores = [c for c in table.columns if c not in ("task", "ord", "model", "is_best")]
    return table.select("task", "model", "is_best", *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in scores])


def top_importances(spark, folder):
    """Measurements ranked by the size of their correlation with the index."""
    matrix = correlate(staged_clean(spark, folder), CORRELATED)
    weights = matrix.where((F.col("col") == INDEX) & (F.col("row") != INDEX)).select(
        F.col("row").alias("feature"), F.abs("value").alias("importance")
    )
    return rounded(evaluate.top_importances(weights), "importance", "share")


# Scalar functions

def safe_divide(spark, folder):
    ratio = scalars.safe_divide(F.col("PM2_5"), F.col("NO2"), F.lit(-1.0))
    return day_as_text(staged_observations(spark, folder).select("k", PLACE, DATE, ratio.alias("ratio")))


def format_percentage(spark, folder):
    text = scalars.percent_text(F.col("Xylene") / 7.0)
    return (
        staged_observations(spark, folder)
        .groupBy(text.alias("text"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def number_labels(spark, folder):
    """Display texts of each city's size, mean and share of all rows."""
    per_city = staged_clean(spark, folder).groupBy(PLACE).agg(
        F.count(F.lit(1)).alias("n"), F.avg(INDEX).alias("mean")
    )
    shares = evaluate.with_percent(per_city, "n", "share")
    return shares.select(
        PLACE,
        scalars.grouped_text(F.col("n"), 0).alias("n_text"),
        scalars.grouped_text(F.col("mean") * 100, 1).alias("mean_text"),
        scalars.value_with_share_text(F.col("mean"), F.col("share")).alias("share_text"),
    )


# Round trips

def write_read_csv(spark, folder):
    path = scratch(spark, "csv")
    writers.write_csv(staged_clean(spark, folder), path, "gzip")
    return day_as_text(readers.read_csv(spark, path).withColumn("k", F.col("k").cast("long")))


def write_read_json(spark, folder):
    path = scratch(spark, "json")
    writers.write_json(staged_observations(spark, folder), path, "gzip")
    return day_as_text(readers.read_json(spark, path, OBSERVATION.add("k", "long")))


def clean_metadata(spark, folder):
    path, facts = scratch(spark, "cleaned"), scratch(spark, "metadata")
    writers.write_cleaned(cleaning.clean(staged_observations(spark, folder)), path, facts)
    return readers.read_json(spark, facts, "clean_path string, rows long, cols int").drop("clean_path")


def metrics_round_trip(spark, folder):
    path = scratch(spark, "metrics")
    board = stage(_board(spark, folder), "board")
    writers.write_metrics(board, evaluate.best_model(board), path)
    return readers.metric_rows(readers.read_metrics(spark, path))


def metrics_without_counts(spark, folder):
    """A board with confusion counts, written and read back: the counts stay out."""
    path = scratch(spark, "metrics")
    board = _board(spark, folder)
    counts = board.where("task = 'classification'").select("task", "model", "ord").distinct()
    counts = counts.select("*", F.lit("Confusion_Matrix").alias("metric"), F.lit(1.0).alias("value"))
    board = stage(board.unionByName(counts), "board")
    writers.write_metrics(board, evaluate.best_model(board), path)
    return readers.metric_rows(readers.read_metrics(spark, path))


def columnar_rescan(spark, folder):
    """The cleaned table as later steps read it: written, then scanned for some columns and rows."""
    path = scratch(spark, "rescan")
    writers.write_cleaned(staged_clean(spark, folder), path)
    return readers.read_table(spark, path).where(F.col(INDEX) > 200).select("k", PLACE, INDEX)


def parsed_days(spark, folder):
    """Days from moments, from their texts, and from texts that do not parse."""
    table = spark.read.parquet(f"{folder}/events.parquet")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_id") % 3 == 1, "no day")
    days = table.select(to_day(F.col("ts")).cast("string").alias("day"), to_day(text).cast("string").alias("text_day"))
    return days.groupBy("day", "text_day").agg(F.count(F.lit(1)).alias("n"))


def utc_texts(spark, folder):
    table = spark.read.parquet(f"{folder}/events.parquet")
    return table.select("event_id", scalars.utc_text(F.col("ts")).alias("text"))


def dataset_facts(spark, folder):
    return pipeline.dataset_facts(staged_observations(spark, folder), staged_clean(spark, folder))


# Models, at the small profile but for the regressors

_TRAINED: dict[tuple[str, str, str, str], models.Trained] = {}


def _trained(spark, folder, task, profile=models.SMOKE) -> models.Trained:
    where = (spark.sparkContext.applicationId, folder, task, profile.name)
    if where not in _TRAINED:
        table = marked(spark, folder) if task == models.REGRESSION else marked_by_class(spark, folder)
        _TRAINED[where] = models.train(task, table, profile)
    return _TRAINED[where]


def fit_regressors(spark, folder):
    """The regressors at their full sizes."""
    return _trained(spark, folder, models.REGRESSION, models.FULL).board


def fit_classifiers(spark, folder):
    return _trained(spark, folder, models.CLASSIFICATION).board


def fitted_importances(spark, folder):
    best = _trained(spark, folder, models.REGRESSION).best
    return evaluate.top_importances(models.importances(spark, best))


def score_saved_model(spark, folder):
    path = scratch(spark, "model")
    writers.save_model(_trained(spark, folder, models.CLASSIFICATION).best, path)
    table = staged_clean(spark, folder)
    scored = models.score(PipelineModel.load(path), table)
    return day_as_text(scored.select("k", PLACE, DATE, BUCKET, "predicted_bucket"))


def linear_normal_equations(spark, folder):
    """Per feature the mean of feature times prediction over the train rows.

    Least squares makes it equal that of feature times index, and the mean
    prediction equal the mean index (feature ``1``).
    """
    model = _trained(spark, folder, models.REGRESSION).models["Linear Regression"]
    scored = model.transform(marked(spark, folder).where("NOT is_test")).select(vector_to_array("raw_features").alias("x"), "prediction")
    sums = scored.agg(*[F.avg(F.get("x", F.lit(k)) * F.col("prediction")).alias(c) for k, c in enumerate(FEATURES)], F.avg("prediction").alias("1"))
    return sums.unpivot([], [*FEATURES, "1"], "feature", "value").withColumn("value", F.round("value", 3))


def logistic_gradient(spark, folder):
    """Per class: its mean probability over the train rows, and whether the penalised gradient vanishes."""
    model = _trained(spark, folder, models.CLASSIFICATION).models["Logistic Regression"]
    fitted, names = model.stages[-2], model.stages[-1].getLabels()
    scored = model.transform(marked_by_class(spark, folder).where("NOT is_test"))
    scored = scored.select("label", vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"))
    weights, penalty = fitted.coefficientMatrix.toArray(), fitted.getRegParam()
    sums = scored.agg(
        *[
            F.struct(
                F.avg(F.get("p", F.lit(k))).alias("share"),
                *[F.avg(F.get("x", F.lit(j)) * ((F.col("label") == k).cast("double") - F.get("p", F.lit(k)))).alias(f"g{j}") for j in range(len(FEATURES))],
            ).alias(f"c{k}")
            for k in range(len(names))
        ]
    ).first()
    rows = []
    for k, name in enumerate(names):
        off = max(abs(sums[f"c{k}"][f"g{j}"] - penalty * weights[k][j]) for j in range(len(FEATURES)))
        rows.append((name, round(sums[f"c{k}"]["share"], 3), int(off < 2e-3)))
    return small_table(spark, rows, {"class": "string", "share": "double", "settled": "int"})


def model_structure(spark, folder):
    """Size of every fitted model that has one; leaves are left out, as they depend on the rows."""
    rows = [
        (task, *fact)
        for task in (models.REGRESSION, models.CLASSIFICATION)
        for fact in models.structure(_trained(spark, folder, task).models)
        if fact[1] != "smallest_leaf"
    ]
    return small_table(spark, rows, {"task": "string", "model": "string", "property": "string", "value": "double"})


def boosting_losses(spark, folder):
    """Start and first loss of both boosted models, and whether each stage lowers the loss."""
    rows = []
    for task, name in ((models.REGRESSION, "Gradient Boosting Regressor"), (models.CLASSIFICATION, "Gradient Boosting Classifier")):
        stages = _trained(spark, folder, task).models[name].stages
        fitted = next(s for s in stages if hasattr(s, "losses"))
        rows.append((task, "first_loss", round(fitted.losses[0], 4)))
        rows += [(task, f"start_{k}", round(float(v), 4)) for k, v in enumerate(fitted.start)]
        rows += [(task, f"stage_{k}_falls", float(b < a)) for k, (a, b) in enumerate(zip(fitted.losses, fitted.losses[1:]))]
    return small_table(spark, rows, {"task": "string", "fact": "string", "value": "double"})


def saved_models_agree(spark, folder):
    """Every model saved and loaded: test rows, and rows on which it and the one in memory differ."""
    parts = []
    for task, table in ((models.REGRESSION, marked(spark, folder)), (models.CLASSIFICATION, marked_by_class(spark, folder))):
        held_out = table.where("is_test")
        for name, model in _trained(spark, folder, task).models.items():
            path = scratch(spark, "model")
            writers.save_model(model, path)
            ours = model.transform(held_out).withColumnRenamed("prediction", "ours").drop(*MADE_BY_MODELS, "raw_features", "features")
            both = PipelineModel.load(path).transform(ours)
            counts = both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ours").eqNullSafe(F.col("prediction"))).alias("n_different"))
            parts.append(counts.select(F.lit(task).alias("task"), F.lit(name).alias("model"), "n", "n_different"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


MADE_BY_MODELS = [
    "Year", "Month", "Day", "DayOfWeek", "Quarter", "DayOfYear", "IsWeekend", "city_text", "city_index", "City_Encoded",
    "label", "rawPrediction", "probability", "predicted_bucket",
]

_JOBS: dict[tuple[str, str], pipeline.Results] = {}


def _job(spark, folder) -> pipeline.Results:
    """The whole job, run once per application."""
    where = (spark.sparkContext.applicationId, folder)
    if where not in _JOBS:
        source, target = scratch(spark, "job-input"), scratch(spark, "job")
        writers.write_csv(staged_observations(spark, folder).drop("k"), source)
        _JOBS[where] = pipeline.run(spark, source, target, models.SMOKE)
    return _JOBS[where]


def batch_job(spark, folder):
    """The whole job from raw rows to reports, back as its leaderboard."""
    return spark.read.option("header", True).csv(_job(spark, folder).paths["leaderboard"])


def job_outputs(spark, folder):
    """What the job wrote, read back: every value that does not depend on the fits, and sizes of the rest."""
    paths = _job(spark, folder).paths

    def table(name: str) -> DataFrame:
        return spark.read.option("header", True).csv(f"{paths['eda']}/{name}" if name in explore.MEASURES else paths[name])

    found = explore.long_rows({name: table(name) for name in explore.MEASURES})
    digits = F.when(F.col("measure") == "density", F.round("value", 9)).otherwise(F.round("value", 6))
    found = found.withColumn("value", digits)

    def more(output: str, part: DataFrame, key: Column, measure: str, value: Column) -> None:
        nonlocal found
        found = found.unionByName(part.select(F.lit(output).alias("result"), key.alias("key"), F.lit(measure).alias("measure"), value.cast("double").alias("value")))

    count = F.count(F.lit(1)).alias("n")
    more("cleaning_audit", table("cleaning_audit"), F.col("step"), "n", F.col("n"))
    more("cleaned", readers.read_table(spark, paths["cleaned"]).agg(count), F.lit(""), "rows", F.col("n"))
    for split_name in ("by_row", "by_class"):
        more(split_name, spark.read.parquet(paths[split_name]).groupBy("is_test").agg(count), F.col("is_test").cast("string"), "rows", F.col("n"))
    more("confusion_matrix", table("confusion_matrix").agg(F.sum("n").alias("n")), F.lit(""), "rows", F.col("n"))
    more("leaderboard", table("leaderboard").groupBy("task").agg(count), F.col("task"), "models", F.col("n"))
    more("scaler_stats", table("scaler_stats").agg(count), F.lit(""), "features", F.col("n"))
    more("metrics", readers.metric_rows(readers.read_metrics(spark, paths["metrics"])).groupBy("task").agg(count), F.col("task"), "scores", F.col("n"))
    facts = readers.read_json(spark, paths["dataset_facts"], "raw_rows long, clean_rows long, n_cities long, n_features long")
    for c in facts.columns:
        more("dataset_facts", facts, F.lit(""), c, F.col(c))
    return found


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_observations, drop_missing_targets, column_medians, impute_medians, remove_duplicates,
        clean, cleaning_audit, null_counts, table_info, shape, preview, describe, describe_dates,
        column_range, distinct_buckets, city_count, temporal_features, city_dictionary, encode_city,
        encode_bucket, feature_matrix, histogram, density, correlation_matrix, correlation_with_gaps,
        top_cities, monthly_trend, bucket_counts, axis_range, explore_bundle, random_split,
        split_counts, stratified_counts, scaler_stats, scaled_checksum, regression_metrics,
        classification_metrics, confusion_matrix, leaderboard, best_model, marked_leaderboard,
        observed_audit, clean_without_columns, top_cities_for_display, stratified_split,
        split_of_many_classes, metrics_without_counts, columnar_rescan, parsed_days, utc_texts,
        top_importances, safe_divide, format_percentage, number_labels, write_read_csv,
        write_read_json, clean_metadata, metrics_round_trip, dataset_facts, fit_regressors,
        fit_classifiers, fitted_importances, score_saved_model, batch_job, linear_normal_equations,
        logistic_gradient, model_structure, boosting_losses, saved_models_agree, job_outputs,
    )
}
