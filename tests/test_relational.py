import math

import pytest

from gramline.operators import metrics, relational, search


def test_drop_nulls(spark):
    rows = spark.createDataFrame([("", "a", 1.0), (None, "a", 1.0), ("x", None, 1.0), ("x", "a", math.nan)], "t string, l string, v double")
    assert [r["t"] for r in relational.drop_nulls(rows, ["t", "l", "v"]).collect()] == [""]


def test_null_classes_are_never_frequent(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "target string")
    assert [r[0] for r in relational.filter_min_class_frequency(rows, "target", 2).collect()] == ["a", "a"]


def test_report_with_classes_seen_on_one_side_only(spark):
    """x is never predicted, z is only predicted."""
    rows = spark.createDataFrame([("x", "y"), ("y", "y"), ("y", "z"), ("y", "y")], "t string, p string")
    got = {r["target"]: r for r in metrics.classification_report(rows, "t", "p").collect()}
    assert (got["x"]["precision"], got["x"]["recall"], got["x"]["f1"], got["x"]["support"]) == (0, 0, 0, 1)
    assert (got["z"]["precision"], got["z"]["recall"], got["z"]["f1"], got["z"]["support"]) == (0, 0, 0, 0)
    assert math.isclose(got["y"]["precision"], 2 / 3) and math.isclose(got["y"]["recall"], 2 / 3)
    assert got["accuracy"]["f1"] == 0.5 and math.isclose(got["macro avg"]["f1"], 2 / 9)
    assert math.isclose(got["weighted avg"]["recall"], 0.5) and got["weighted avg"]["support"] == 4
    named = {r["name"]: r["value"] for r in metrics.all_metrics(rows, "t", "p").collect()}
    assert named["Accuracy"] == 0.5 and math.isclose(named["F1"], got["weighted avg"]["f1"])


def test_best_trial_ties_and_nulls(spark):
    rows = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 0.1), (0, None)], "trial_id bigint, accuracy double")
    assert search.best_trial(rows, "accuracy").first()["trial_id"] == 1
    assert search.best_trial(rows.filter("accuracy is null"), "accuracy").count() == 0


def test_bandit(spark):
    rows = spark.createDataFrame(
        [(1, 1, 0.1), (2, 1, 0.9), (1, 3, 0.80), (2, 3, 0.84), (3, 3, 0.70), (4, 2, 0.0)], "run_id int, step int, metric double"
    )
    kept = {r["run_id"]: r["keep"] for r in search.bandit_keep(rows).collect()}
    assert kept == {1: True, 2: True, 3: False}
    assert {r[0] for r in search.surviving_runs(rows).collect()} == {1, 2, 4}


@pytest.mark.parametrize("space", [search.SPACE_A, search.SPACE_B])
def test_trials_stay_in_their_space(spark, space):
    rows = search.sample_trials(spark, space, 300).collect()
    assert len(rows) == 300 and rows == search.sample_trials(spark, space, 300).collect()
    for name, (kind, low, high) in space.items():
        values = {r[search.PARAMETER_NAMES.get(name, name)] for r in rows}
        assert all(low <= v < high for v in values)
        assert kind != "int" or high - low > 60 or values == set(range(low, high))
