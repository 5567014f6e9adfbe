"""What the sink queries save: here on rows of their own."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from catalog import modelling
from catalog.registry import QUERIES
from wattline.operators import training
from wattline.sources import sinks


@pytest.fixture
def table(spark, monkeypatch):
    features = training.Features()
    rows = spark.range(240).selectExpr(
        "string(id) AS CONS_ID", "'1' AS CSQ", "if(id = 7, null, string(id)) AS CNO", "if(id % 9 = 0, 'same', string(id)) AS MNO",
        "int(id % 3 = 0) AS LABEL",
    )
    kinds = {c: F.expr(f"if(id % {i + 2} = 0, 'N', 'Y')") for i, c in enumerate(features.categorical)}
    numbers = {c: F.expr(f"double((id * {2 * i + 3}) % 41)") for i, c in enumerate(features.numeric)}
    own = spark.range(240).withColumns({**kinds, **numbers}).withColumn("CONS_ID", F.col("id").cast("string"))
    made = rows.join(own.drop("id"), "CONS_ID").localCheckpoint()
    monkeypatch.setattr(modelling, "table_of", lambda t: made)
    monkeypatch.setattr(modelling, "SHORT", training.TreeParams(trees=2, depth=2, step=0.3))
    monkeypatch.setattr(modelling, "_RUNS", {})
    return made


def test_the_model_trained_on_the_table_is_saved_and_scores_all_rows(spark, table, monkeypatch):
    saved, write = [], sinks.write_model
    monkeypatch.setattr(sinks, "write_model", lambda model, *a: saved.append((model, write(model, *a))) or saved[-1][1])
    found = QUERIES["sink_model"](spark, "own rows").collect()
    run = next(iter(modelling._RUNS.values()))
    path = next(path for model, path in saved if model is run.full)
    kept = PipelineModel.load(path)
    assert training.booster(kept).toDebugString.split("\n", 1)[1] == training.booster(run.full).toDebugString.split("\n", 1)[1]
    assert len(found) == 240 and all(r["same"] for r in found)
    fixed = modelling.scores_of(modelling.model_run.predict(modelling.fixed_model(spark), table)).collect()
    assert sorted(map(str, fixed)) == sorted(str(r).replace(", same=True", "") for r in found)
