"""The whole job from one dict: which datasets, where they lie, which source wins.

The driver only builds plans and names paths; rows stay in the tables.

    {
      "lookups": {"mcd": path, "defect_range": path},
      "combine": {"output_directory": dir,
                  "files": {name: {"consumer": path, "consumption": path,
                                   "report": path, "custom_processing": bool,
                                   "many_copies": bool,
                                   "state": dir, "batch": name}}},
      "concatenate": {"output_directory": dir, "priority": {name: int}, "files": {name: path}},
      "prepare_model_input": {"output_directory": dir, "files": path},
      "train": {"output_directory": dir, "training_data": path},
      "score": {"output_directory": dir, "combined": path, "model": path, "features": [name],
                "rejects": [path]},
    }

``files`` and ``training_data`` may be left out; a step then takes what the step before it wrote. With
``state`` the readings are one batch more, merged into the monthly state that is kept there.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import Observation, SparkSession

from wattline.operators import training as T
from wattline.operators.combine import union_pred_rejects
from wattline.operators.lookup import store_models, store_ranges
from wattline.operators.rows import key_filter, with_likely_keys
from wattline.plans import increments, model_input, model_run, raw
from wattline.session import scratch_dir
from wattline.sources import readers, sinks


def load(path: str) -> dict:
    """The config from a JSON file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


def _screen(
    spark: SparkSession, files: Mapping, tables: Mapping, path: str
) -> tuple[raw.Screened, list[tuple[str, int]]]:
    """One dataset screened, and how many rows of each source had no key.

    What is read more than once is written below ``path``, so each source is read once, and its rows
    without a key are counted in that pass. Readings of consumers that the master doesn't have go before
    the first shuffle, but for the few that its key filter lets through; these fall out at the join.
    """
    seen = {kind: Observation() for kind in ("consumer", "consumption")}
    if files.get("custom_processing"):
        life = readers.read_meter_life(spark, files["consumption"], seen["consumption"])
        names = readers.read_master_history(spark, files["consumer"], seen["consumer"])
        screened = raw.screen_history_path(names, life, **tables)
    else:
        master = readers.read_consumer(spark, files["consumer"], seen["consumer"])
        master.write.parquet(f"{path}/master")
        consumption = readers.read_consumption(spark, files["consumption"], seen["consumption"])
        many_copies = bool(files.get("many_copies"))
        if "state" in files:
            # All readings are kept: a later master may have their consumers.
            if not increments.add_batch(spark, consumption, files["state"], files["batch"], many_copies):
                del seen["consumption"]  # merged by an earlier run, and not read again
            summary = increments.summary(spark, files["state"])
        else:
            known = key_filter(spark.read.parquet(f"{path}/master"), f"{path}/keys")
            summary = raw.summarise_consumption(with_likely_keys(consumption, known), many_copies)
        summary.write.parquet(f"{path}/summary")
        stored = (spark.read.parquet(f"{path}/{part}") for part in ("master", "summary"))
        screened = raw.screen_master_path(*stored, **tables)
    screened.consumers.write.parquet(f"{path}/consumers")
    counted = [(kind, one.get["rows_without_key"]) for kind, one in seen.items()]
    return raw.Screened(spark.read.parquet(f"{path}/consumers"), screened.early), counted


def process_raw(spark: SparkSession, config: Mapping) -> dict[str, str]:
    """Screen each dataset; write its kept rows, its rejects, and the number of rows without a key.

    Returns the path per dataset.
    """
    step = config["combine"]
    root, written = step["output_directory"], {}
    with scratch_dir(spark, "screened-lookups") as place:
        models = readers.read_mcd(spark, config["lookups"]["mcd"])
        ranges = readers.read_defect_range(spark, config["lookups"]["defect_range"])
        tables = {
            "models": store_models(models, f"{place}/models"),
            "ranges": store_ranges(ranges, f"{place}/ranges"),
        }
        for name, files in step["files"].items():
            written[name] = _process_dataset(spark, name, files, tables, root)
    return written


def _process_dataset(spark: SparkSession, name: str, files: Mapping, tables: Mapping, root: str) -> str:
    with scratch_dir(spark, f"screened-{name}") as path:
        screened, counted = _screen(spark, files, tables, path)
        report = readers.read_report(spark, files["report"]) if "report" in files else None
        kept = sinks.write_raw(raw.apply_report(screened.kept(), report), root, name)
        sinks.write_rejects(screened.rejects(), root, name)
    sinks.write_keyless(spark, counted, root, name)
    return kept


def concatenate(spark: SparkSession, config: Mapping, files: Mapping[str, str] | None = None) -> str:
    step = config["concatenate"]
    paths = step.get("files") or files
    datasets = {name: readers.read_dataset(spark, path, name) for name, path in paths.items()}
    combined = model_input.combine(datasets, step["priority"])
    return sinks.write_combined(combined, step["output_directory"], list(paths))


def prepare_model_input(
    spark: SparkSession,
    config: Mapping,
    path: str | None = None,
    mode: str = "fit",
    encode_elc: bool = False,
) -> str:
    step = config["prepare_model_input"]
    path = step.get("files") or path
    table = model_input.model_input(readers.read_combined(spark, path), mode)
    if encode_elc:
        table = model_input.encode_elc(table)
    return sinks.write_model_input(table, step["output_directory"], path.rstrip("/").split("/")[-1])


def train(
    spark: SparkSession,
    config: Mapping,
    path: str | None = None,
    params: T.TreeParams = T.TreeParams(),
) -> model_run.ModelRun:
    step = config["train"]
    root = step["output_directory"]
    path = step.get("training_data") or path
    table = readers.read_training(spark, path, ["CNO", "MNO"])
    with scratch_dir(spark, "training-rows") as prepared:
        run = model_run.train_and_select(table, params=params, path=prepared)
        saved = sinks.write_model(run.full, root)
        sinks.write_model(run.selected, f"{root.rstrip('/')}/selected")
        for name, rows in model_run.held_out_tables(run.full, run.prepared, run.features).items():
            sinks.write_table(rows, f"{root.rstrip('/')}/evaluation/{name}")
    sinks.log_run(spark, f"{root.rstrip('/')}/runs", saved, {"dataset": path, **run.metrics})
    return replace(run, prepared=None)  # its rows are gone


def score(spark: SparkSession, config: Mapping) -> str:
    """Score merged rows with a saved model, the weights normalised by the fixed constants.

    ``features`` are the names the model was trained on, all of them if left out. Rejected consumers
    named by ``rejects`` join the predictions, without a score.
    """
    step = config["score"]
    features = T.Features()
    if "features" in step:
        features = features.only(step["features"])
    table = model_input.model_input(readers.read_combined(spark, step["combined"]), "fixed")
    found = model_run.predict(PipelineModel.load(step["model"]), table, features)
    for path in step.get("rejects", ()):
        found = union_pred_rejects(found, spark.read.parquet(path))
    out = f"{step['output_directory'].rstrip('/')}/predictions"
    sinks.write_predictions(found, out)
    return out


def run_all(
    spark: SparkSession, config: Mapping, params: T.TreeParams = T.TreeParams()
) -> model_run.ModelRun:
    files = process_raw(spark, config)
    combined = concatenate(spark, config, files)
    return train(spark, config, prepare_model_input(spark, config, combined), params)
