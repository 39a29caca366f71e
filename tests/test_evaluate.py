from __future__ import annotations

import math

from conftest import rows

from smogline.operators import evaluate

PAIR = {"y": "double", "p": "double"}
CLASSES = {"y": "string", "p": "string"}


def regression(table, *pairs):
    return dict(rows(evaluate.regression_metrics(table(PAIR, *pairs), "y", "p")))


def test_regression_metrics(table):
    found = regression(table, (1.0, 2.0), (3.0, 3.0), (5.0, 3.0))
    assert found["MAE"] == 1.0 and math.isclose(found["RMSE"], math.sqrt(5 / 3))
    assert math.isclose(found["R2"], 1 - 5 / 8)


def test_r2_of_a_constant_truth(table):
    assert regression(table, (2.0, 2.0), (2.0, 2.0))["R2"] == 1.0
    assert regression(table, (2.0, 2.0), (2.0, 3.0))["R2"] == 0.0


def test_classification_metrics(table):
    df = table(CLASSES, ("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"))
    found = dict(rows(evaluate.classification_metrics(df, "y", "p")))
    assert found["Accuracy"] == found["Recall"] == 0.5
    assert math.isclose(found["Precision"], (2 * 1.0 + 1 / 3 + 0) / 4)
    assert math.isclose(found["F1_Score"], (2 * (2 / 3) + 0.5 + 0) / 4)


def test_class_that_is_only_predicted(table):
    df = table(CLASSES, ("a", "z"), ("a", "a"))
    found = dict(rows(evaluate.classification_metrics(df, "y", "p")))
    assert found["Accuracy"] == 0.5 and found["Precision"] == 1.0


def test_confusion_matrix_is_dense(table):
    df = table(CLASSES, ("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"))
    found = {(r["label"], r["prediction"]): (r["n"], r["pct"]) for r in evaluate.confusion_matrix(df, "y", "p").collect()}
    assert len(found) == 9 and found["c", "b"] == (1, 25.0) and found["c", "c"] == (0, 0.0)
    assert sum(n for n, _ in found.values()) == 4


def test_share_of_nothing(table):
    df = table({"feature": "string", "importance": "double"}, ("a", 0.0), ("b", 0.0))
    assert rows(evaluate.top_importances(df)) == [("a", 0.0, 0.0), ("b", 0.0, 0.0)]


def test_first_of_equal_models_wins(table):
    scored = {"metric": "string", "value": "double"}
    board = evaluate.leaderboard(
        [
            ("regression", "one", table(scored, ("R2", 0.50001))),
            ("regression", "two", table(scored, ("R2", 0.50002))),
            ("classification", "x", table(scored, ("F1_Score", 0.1), ("Accuracy", 0.9))),
            ("classification", "y", table(scored, ("F1_Score", 0.2), ("Accuracy", 0.1))),
        ]
    )
    best = evaluate.best_model(board)
    assert sorted(rows(best)) == [("classification", "y", 0.2), ("regression", "one", 0.5)]
    marked = {r["model"]: r["is_best"] for r in evaluate.marked_leaderboard(board, best).collect()}
    assert marked == {"one": True, "two": False, "x": False, "y": True}
