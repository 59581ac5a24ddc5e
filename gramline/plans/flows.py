"""The two classification flows, end to end."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramline.operators import metrics, search
from gramline.operators.model import FLOW_A, FLOW_B, Params, TextModel, fit_text_model, predict
from gramline.operators.relational import drop_nulls, filter_known_labels, filter_min_class_frequency, n_classes
from gramline.operators.splits import shuffled_split, stratified_split
from gramline.operators.text import prepare_text
from gramline.plans.storage import kept, scope, spread, written
from gramline.sources import registry, tables

# Names of datasets, models and metrics.
PREPARED, MODEL_A, MODEL_B = "prepared", "classifier-a", "text-classification"
ACCURACY_TAG = "Final Test Accuracy"


@dataclass(frozen=True)
class Outcome:
    model: TextModel
    metrics: DataFrame
    predictions: DataFrame
    version: int | None = None


def prepare_a(rows: DataFrame) -> DataFrame:
    """Cleaned and split (row_id, tweet, target, split) of labelled rows with a row id."""
    cleaned = written(prepare_text(rows), "prepared")
    return written(stratified_split(cleaned, "target", "row_id"), "split")


def search_a(split: DataFrame, n_trials: int = 18, parallelism: int = 6, defaults: Params = FLOW_A) -> DataFrame:
    """Settings with their mean accuracy over five folds of the training rows, as a written table.

    Trials go in rounds of `parallelism`, which are fitted together: the first round is drawn at random, later ones are
    suggested from all rounds before. `search.best_trial(results, "accuracy")` picks the best; `Params.with_trial` takes
    its settings over.
    """
    spark = split.sparkSession
    train = written(split.filter("split = 'train'").drop("split"), "train")
    results = None
    for first in range(0, n_trials, parallelism):
        ids = spark.range(first, min(first + parallelism, n_trials)).withColumnRenamed("id", "trial_id")
        if results is None:
            trials = search.draw_parameters(ids, "trial_id", search.SPACE_A, defaults.seed)
        else:
            trials = search.suggest_trials(results, ids, search.SPACE_A, seed=defaults.seed)
        found = search.evaluate_trials(train, written(trials, "trials"), defaults, folds=5)
        results = written(found if results is None else results.unionByName(found), "results")
    return results


def train_a(split: DataFrame, params: Params = FLOW_A, run_id: str = "a") -> Outcome:
    """Fits on the frequent classes of the training rows only and scores the test rows of those classes."""
    train = filter_min_class_frequency(split.filter("split = 'train'"), "target", params.min_class_frequency)
    model = fit_text_model(train, params)
    test = filter_known_labels(split.filter("split = 'test'"), train, "target")
    predictions = written(predict(model, test), "predictions")
    accuracy = metrics.accuracy(predictions, "target", "predicted").select(
        F.lit(run_id).alias("run_id"), F.lit(0).cast("bigint").alias("step"), F.lit("accuracy").alias("name"),
        F.col("accuracy").alias("value"),
    )
    return Outcome(model, accuracy, predictions)


def _rows(spark: SparkSession, csv: str, cut: bool) -> DataFrame:
    """(row_id, tweet, target). A file read as a whole is one split, so its rows are spread before they are written."""
    read = tables.read_labelled_csv(spark, csv, cut=cut)
    return written(tables.with_row_id(read) if cut else spread(tables.with_row_id(read)), "rows")


def flow_a(spark: SparkSession, csv: str, root: str, params: Params = FLOW_A, cut: bool = False) -> Outcome:
    """CSV -> cleaned text -> split -> forest -> logged accuracy -> registered model."""
    with scope(spark):
        outcome = train_a(prepare_a(_rows(spark, csv, cut)), params)
        logged, predictions = kept(outcome.metrics, "metrics"), kept(outcome.predictions, "predictions")
        tables.log_metrics(logged, f"{root}/metrics")
        path = f"{root}/models/{MODEL_A}/{uuid.uuid4().hex}"  # its own, so that flows that run at once keep both models
        tables.save_model(outcome.model, path)
        version = registry.register_model(spark, f"{root}/registry", MODEL_A, path)
    return Outcome(tables.load_model(path), logged, predictions, version)


def prepare_b(spark: SparkSession, csv: str, root: str, cut: bool = False) -> int:
    """Registers the rows with both text and label as a new dataset version."""
    prepared = drop_nulls(_rows(spark, csv, cut), ["target", "tweet"]).select("row_id", "target", "tweet")
    return tables.register_dataset(prepared, root, PREPARED)


def train_b(rows: DataFrame, params: Params = FLOW_B, dataset_version: int | None = None, run_id: str = "b") -> Outcome:
    """Fits the vocabulary on all rows and the forest on four fifths, and measures on the rest."""
    frequent = filter_min_class_frequency(rows, "target", params.min_class_frequency)
    data = written(drop_nulls(frequent, ["target", "tweet"]), "rows")
    split = written(shuffled_split(data, "row_id", seed=params.seed), "split")
    model = fit_text_model(split.filter("split = 'train'"), params, scope=split)
    predictions = written(predict(model, split.filter("split = 'test'")), "predictions")
    counted = n_classes(data, "target").select(
        F.lit("Number of classes").alias("name"), F.col("n_classes").cast("double").alias("value")
    )
    logged = metrics.all_metrics(predictions, "target", "predicted").unionByName(counted)
    if dataset_version is not None:
        version = rows.sparkSession.range(1).select(
            F.lit("Dataset Version").alias("name"), F.lit(float(dataset_version)).alias("value")
        )
        logged = logged.unionByName(version)
    named = logged.select(F.lit(run_id).alias("run_id"), F.lit(0).cast("bigint").alias("step"), "name", "value")
    return Outcome(model, named, predictions)


def flow_b(
    spark: SparkSession, csv: str, root: str, defaults: Params = FLOW_B, n_trials: int = 10,
    parallelism: int | None = None, policy: search.Bandit | None = search.Bandit(), cut: bool = False,
) -> Outcome:
    """CSV -> dataset version -> random search with early stopping -> metrics of all trials -> the best trial's own
    model, its report and its registered version. Tables written on the way are deleted."""
    with scope(spark):
        return _flow_b(spark, csv, root, defaults, n_trials, parallelism, policy, cut)


def _flow_b(spark, csv: str, root: str, defaults: Params, n_trials: int, parallelism, policy, cut: bool) -> Outcome:
    dataset = prepare_b(spark, csv, root, cut)
    rows = tables.read_dataset(spark, root, PREPARED, dataset).drop("version")
    trials = written(search.sample_trials(spark, search.SPACE_B, n_trials, defaults.seed), "trials")
    found = search.run_trials(rows, trials, defaults, policy=policy, parallelism=parallelism)
    results = written(found.results, "results")
    best = search.best_trial(results.filter("NOT stopped"), "accuracy").first()
    if best is None:
        raise ValueError("no trial could be fitted")
    logged = search.trial_metrics(results)
    version = results.filter("accuracy is not null").select(
        F.concat(F.lit("trial-"), F.col("trial_id")).alias("run_id"), F.lit(0).cast("bigint").alias("step"),
        F.lit("Dataset Version").alias("name"), F.lit(float(dataset)).alias("value"),
    )
    logged = kept(logged.unionByName(version), "metrics")
    tables.log_metrics(logged, f"{root}/metrics")
    model, params = found.model(best["trial_id"]), defaults.with_trial(best.asDict())
    frequent = filter_min_class_frequency(rows, "target", params.min_class_frequency)
    split = shuffled_split(drop_nulls(frequent, ["target", "tweet"]), "row_id", seed=params.seed)
    predictions = kept(predict(model, split.filter("split = 'test'")), "predictions")
    path = f"{root}/models/{MODEL_B}/{uuid.uuid4().hex}"
    tables.save_model(model, path)
    tables.write_report(metrics.classification_report(predictions, "target", "predicted"), f"{path}-report")
    accuracy = str(best["accuracy"])
    registered = registry.register_model(
        spark, f"{root}/registry", MODEL_B, path, {ACCURACY_TAG: accuracy, "label": "target"}, {"Accuracy": accuracy}
    )
    own = logged.filter(F.col("run_id") == f"trial-{best['trial_id']}")
    return Outcome(tables.load_model(path), own, predictions, registered)
