"""Staged boosting against plain arithmetic, and trees as SQL text against the model."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from wattline.operators import boosting, training

FEATURES = training.Features(("make",), ("x", "y"))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1500).selectExpr(
        "concat('make', id % 40) AS make", "if(id % 31 = 0, null, double(id % 7)) AS x", "double((id * 37) % 101) AS y",
        "int((id * 37) % 101 > 60 AND id % 7 > 2 OR id % 40 = 5 OR id % 13 = 0) AS LABEL",
        "if(id % 2 = 0, 1D, 1.5D) AS class_weight", "id % 5 = 0 AS is_validation",
    ).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    """A model, and the curve of all rounds that were fitted."""
    kept = []
    fit = boosting.fit
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(boosting, "fit", lambda *a: kept.append(fit(*a)) or kept[-1])
        model = training.train_gbt(rows, FEATURES, training.TreeParams(trees=40, depth=3, patience=4, step=0.3, by_f1=False))
    return model, kept[0][1]


def test_the_fit_ends_with_the_patience(fitted):
    model, curve = fitted
    losses = [c.loss for c in curve]
    best = int(np.argmin(losses)) + 1
    assert training.booster(model).getNumTrees == best
    assert len(curve) == min(best + 4, 40) and all(0 <= c.f1 <= 1 for c in curve)
    assert losses[best - 1] < losses[0]


def test_curve_is_that_of_the_kept_trees(fitted, rows):
    model, curve = fitted
    scored = training.score(model, rows.where("is_validation"), FEATURES).toPandas()
    p, y, w = scored.PREDICTION_SCORE, scored.LABEL, scored.class_weight
    loss = -(w * np.log(np.where(y == 1, p, 1 - p))).sum() / w.sum()
    last = curve[training.booster(model).getNumTrees - 1]
    assert math.isclose(loss, last.loss, rel_tol=1e-9)
    both, marked = w[(y == 1) & (p > 0.5)].sum(), w[y == 1].sum() + w[p > 0.5].sum()
    assert math.isclose(last.f1, 2 * both / marked, rel_tol=1e-9)


def test_one_split_is_the_best_newton_step(rows):
    """Brute force over all splits of one number, with the L2 term in the leaves."""
    only = training.Features((), ("y",))
    params = training.TreeParams(trees=1, depth=1, step=1.0, bagging=0.0, l2=2.0, borders=128)
    model = training.train_gbt(rows, only, params)
    learn = rows.where("NOT is_validation").toPandas()
    y, g, w = learn.y.to_numpy(), learn.LABEL.to_numpy() - 0.5, learn.class_weight.to_numpy()

    def gain(cut):
        return sum((w * g)[side].sum() ** 2 / (w[side].sum() / 4) for side in (y <= cut, y > cut))

    cut = max(np.unique(y)[:-1], key=gain)
    leaves = {low: (w * g)[(y <= cut) == low].sum() / (w[(y <= cut) == low].sum() / 4 + 2.0) for low in (True, False)}
    for r in training.score(model, rows, only).select("y", "PREDICTION_SCORE").distinct().collect():
        assert math.isclose(r["PREDICTION_SCORE"], 1 / (1 + math.exp(-leaves[r["y"] <= cut])), rel_tol=1e-12)


def test_sql_text_and_rebuilt_trees_give_the_same_scores(spark, fitted, rows, tmp_path):
    model, _ = fitted
    trees = boosting.nodes_of(training.booster(model))
    text = boosting.log_odds_sql(trees, ["make_index", "x", "y"])
    filled = training.fill_numeric(rows, FEATURES)
    scored = model.transform(filled).withColumn("p", vector_to_array("probability")[1])
    arrow_rows = scored.select("make_index", "x", "y", "p").toArrow()  # noqa: F841 - DuckDB reads it by name
    worst = duckdb.sql(f"SELECT max(abs(p - 1 / (1 + exp(-({text}))))) FROM arrow_rows").fetchall()[0][0]
    assert worst < 1e-12
    assert scored.selectExpr(f"max(abs(p - 1 / (1 + exp(-({text})))))").first()[0] < 1e-12
    values = {0: len(model.stages[0].labelsArray[0]) + 1}
    again = boosting.model_of([n for _, n in trees], 0.3, 3, training.GBTClassifier(), values)
    type(model)([*model.stages[:-1], again]).write().overwrite().save(f"{tmp_path}/model")
    loaded = type(model).load(f"{tmp_path}/model").transform(filled).withColumn("q", vector_to_array("probability")[1])
    assert np.allclose(loaded.toPandas().q, scored.toPandas().p, rtol=0, atol=1e-12)
    listed = spark.createDataFrame(boosting.tree_rows(trees), boosting.TREE_SQL)
    assert listed.where("feature < 0").count() == listed.where("feature >= 0").count() + len(trees)


def test_more_rounds_follow_the_loss_down(rows):
    """The bootstrap changes the trees, not what they learn."""
    plain, drawn = (
        training.evaluate(training.train_gbt(rows, FEATURES, training.TreeParams(trees=10, depth=3, step=0.3, bagging=b, by_f1=False)), rows, FEATURES)
        for b in (0.0, 0.5)
    )
    plain, drawn = ({r["part"]: r["logloss"] for r in t.collect()} for t in (plain, drawn))
    assert plain != drawn and all(abs(plain[p] - drawn[p]) < 0.1 and drawn[p] < 0.6 for p in plain)
