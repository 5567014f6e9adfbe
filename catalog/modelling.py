"""Split, encoding, training, selection, scoring and evaluation tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import stages
from catalog.registry import ORACLES, Tables, cte, query, rounded
from wattline import constants as C
from wattline.functions import rules
from wattline.operators import boosting, metrics, ranking, training
from wattline.plans import model_input, model_run
from wattline.session import fresh_dir
from wattline.sources import sinks

# The queries' model gives up sooner than the library's own setting; README has the times.
SHORT = training.TreeParams(patience=8)


@query(
    "stratified_split",
    """SELECT doc_id, quality, row_number() OVER w <= floor(0.2 * count(*) OVER (PARTITION BY quality)) AS is_validation
FROM labels WINDOW w AS (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)))""",
)
def stratified_split(t: Tables) -> DataFrame:
    return ranking.stratified_split(t.labels.select("doc_id", "quality"), "quality", ["doc_id"])


@query(
    "class_weights",
    """SELECT doc_id, quality, round(sum(n_c) OVER () / k / n, 6) + 0.0 AS class_weight FROM (
  SELECT doc_id, quality, count(*) OVER (PARTITION BY quality) AS n, 1 AS n_c,
    (SELECT count(DISTINCT quality) FROM labels) AS k FROM labels)""",
)
def class_weights(t: Tables) -> DataFrame:
    weighted = ranking.with_class_weights(t.labels.select("doc_id", "quality"), "quality")
    return weighted.withColumn("class_weight", rounded("class_weight"))


@query(
    "label_encode",
    "SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code FROM part",
)
def label_encode(t: Tables) -> DataFrame:
    return training.label_encode(t.part.select("p_partkey", "p_brand"), "p_brand", "code")


def _frequency_index(column: str) -> str:
    return f"""SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_index
FROM part GROUP BY {column}"""


@query(
    "encode_categoricals",
    f"""SELECT p_partkey, p_brand_index, p_type_index FROM part
JOIN ({_frequency_index('p_brand')}) USING (p_brand) JOIN ({_frequency_index('p_type')}) USING (p_type)""",
)
def encode_categoricals(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_type")
    encoded = training.encode_categoricals(parts, ["p_brand", "p_type"]).transform(parts)
    return encoded.select("p_partkey", "p_brand_index", "p_type_index")


@query(
    "score_bin",
    """SELECT doc_id, CASE WHEN s < 0.1 THEN '0-0.1' WHEN s < 0.2 THEN '0.1-0.2' WHEN s < 0.3 THEN '0.2-0.3'
  WHEN s < 0.4 THEN '0.3-0.4' WHEN s < 0.5 THEN '0.4-0.5' WHEN s < 0.6 THEN '0.5-0.6' WHEN s < 0.7 THEN '0.6-0.7'
  WHEN s < 0.8 THEN '0.7-0.8' WHEN s < 0.9 THEN '0.8-0.9' WHEN s < 1 THEN '0.9-1.0' END AS category
FROM (SELECT doc_id, (doc_id % 101) / 100.0::DOUBLE AS s FROM documents)""",
)
def score_bin(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.expr(rules.score_bin("(doc_id % 101 / 100D)")).alias("category"))


# ---- evaluation tables ----

PAIR = ("quality", "toxic")


@query(
    "metric_confusion",
    """SELECT quality AS actual, count(*) FILTER (toxic = 0) AS predicted_0, count(*) FILTER (toxic = 1) AS predicted_1
FROM labels GROUP BY quality""",
)
def metric_confusion(t: Tables) -> DataFrame:
    return metrics.metric_confusion(t.labels, *PAIR)


@query(
    "metric_prf",
    """SELECT round(accuracy, 6) AS accuracy, round(p, 6) AS "precision", round(r, 6) AS recall,
  round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1
FROM (SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) AS accuracy,
  coalesce(count(*) FILTER (quality = 1 AND toxic = 1) / nullif(count(*) FILTER (toxic = 1), 0), 0) AS p,
  coalesce(count(*) FILTER (quality = 1 AND toxic = 1) / nullif(count(*) FILTER (quality = 1), 0), 0) AS r
  FROM labels)""",
)
def metric_prf(t: Tables) -> DataFrame:
    found = metrics.metric_prf(t.labels, *PAIR)
    return found.select(*(rounded(c).alias(c) for c in found.columns))


@query(
    "metric_report",
    """WITH classes AS (
  SELECT class, count(*) FILTER (quality = class AND toxic = class) AS tp,
    count(*) FILTER (toxic = class) AS claimed, count(*) FILTER (quality = class) AS support
  FROM labels, (VALUES (0), (1)) c(class) GROUP BY class),
scored AS (
  SELECT class, support, tp, coalesce(tp / nullif(claimed, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r FROM classes),
full_scores AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM scored),
report_rows AS (
  SELECT CAST(class AS VARCHAR) AS class, p, r, f, support FROM full_scores
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM full_scores
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
    sum(f * support) / sum(support), sum(support) FROM full_scores
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM full_scores)
SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM report_rows""",
)
def metric_report(t: Tables) -> DataFrame:
    found = metrics.metric_report(t.labels, *PAIR)
    scores = ("precision", "recall", "f1")
    return found.select("class", *(rounded(c).alias(c) for c in scores), "support")


# ---- model; MLlib has no SQL twin, so the twins check what holds of every row ----


_TABLES: dict[tuple[str, str], DataFrame] = {}
_RUNS: dict[tuple[str, str], model_run.ModelRun] = {}


def table_of(t: Tables) -> DataFrame:
    """The model input, stored once."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _TABLES:
        path = fresh_dir(t.spark, "model-input")
        model_input.model_input(stages.stored_combined(t)).write.parquet(path)
        _TABLES[key] = t.spark.read.parquet(path)
    return _TABLES[key]


def run_of(t: Tables) -> tuple[DataFrame, model_run.ModelRun]:
    """The model input and the run trained on it, shared by the queries that report on them."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _RUNS:
        _RUNS[key] = model_run.train_and_select(table_of(t), params=SHORT)
    return table_of(t), _RUNS[key]


# One round of one split, in SQL: all rows start at a chance of a half, so a row's gradient is its label
# less a half and its curvature a quarter. The split with the largest sum of G * G / H wins, its leaves
# are G / (H + 1), and the step is 0.05.
STUMP = training.TreeParams(trees=1, depth=1, bagging=0.0)
STUMP_FEATURES = training.Features((), ("p_size", "tenth"))
STUMP_ROWS = """SELECT p_partkey, p_size, p_partkey % 10 AS tenth, CAST(p_size > 33 OR p_partkey % 10 = 3 AS INTEGER) AS LABEL,
  CASE WHEN p_size > 33 OR p_partkey % 10 = 3 THEN 1.5 ELSE 0.75 END AS class_weight, p_partkey % 5 = 0 AS is_validation FROM part"""
cte("stump_rows", STUMP_ROWS)
cte(
    "stump_splits",
    """
SELECT name, s.x AS cut, sum(w * g) FILTER (v <= s.x) AS gl, sum(w) FILTER (v <= s.x) / 4 AS hl,
  sum(w * g) FILTER (v > s.x) AS gr, sum(w) FILTER (v > s.x) / 4 AS hr
FROM (SELECT DISTINCT 'p_size' AS name, p_size AS x FROM stump_rows UNION ALL SELECT DISTINCT 'tenth', tenth FROM stump_rows) s
JOIN (SELECT 'p_size' AS name, p_size AS v, LABEL - 0.5 AS g, class_weight AS w FROM stump_rows WHERE NOT is_validation
  UNION ALL SELECT 'tenth', tenth, LABEL - 0.5, class_weight FROM stump_rows WHERE NOT is_validation) r USING (name)
GROUP BY name, s.x HAVING count(*) FILTER (v > s.x) > 0""",
)
cte("stump", "SELECT * FROM stump_splits ORDER BY gl * gl / hl + gr * gr / hr DESC LIMIT 1")


@query(
    "train_gbt",
    """SELECT p_partkey, round(1 / (1 + exp(-0.05 * CASE WHEN (CASE name WHEN 'p_size' THEN p_size ELSE tenth END) <= cut
  THEN gl / (hl + 1) ELSE gr / (hr + 1) END)), 9) AS PREDICTION_SCORE FROM stump_rows CROSS JOIN stump""",
)
def train_gbt(t: Tables) -> DataFrame:
    """A model of one round and one split, trained here and in SQL; the tests train larger ones."""
    rows = t.part.selectExpr(
        "p_partkey", "double(p_size) AS p_size", "double(p_partkey % 10) AS tenth",
        "int(p_size > 33 OR p_partkey % 10 = 3) AS LABEL",
        "if(p_size > 33 OR p_partkey % 10 = 3, 1.5D, 0.75D) AS class_weight", "p_partkey % 5 = 0 AS is_validation",
    )
    model = training.train_gbt(rows, STUMP_FEATURES, STUMP)
    return training.score(model, rows, STUMP_FEATURES).select("p_partkey", rounded("PREDICTION_SCORE", 9).alias("PREDICTION_SCORE"))


SIZES = "SELECT p_type AS feature, sum(p_size) AS importance FROM part GROUP BY p_type"


def _importances(t: Tables) -> DataFrame:
    table = t.part.groupBy(F.col("p_type").alias("feature")).agg(F.sum("p_size").alias("importance"))
    return training.select_from(table)


@query("select_features", f"WITH s AS ({SIZES}) SELECT feature, CAST(importance AS BIGINT) AS importance FROM s WHERE importance >= (SELECT median(importance) FROM s)")
def select_features(t: Tables) -> DataFrame:
    return _importances(t).where("is_selected").drop("is_selected")


@query(
    "reduction_ratio",
    f"""WITH s AS ({SIZES}), n AS (SELECT count(*) AS a, count(*) FILTER (importance >= (SELECT median(importance) FROM s)) AS b FROM s)
SELECT a AS original_features, b AS selected_features, b / a AS feature_reduction_ratio FROM n""",
)
def reduction_ratio(t: Tables) -> DataFrame:
    return training.reduction(_importances(t))


def _evaluations(t: Tables) -> DataFrame:
    scored = t.labels.selectExpr("toxic", "(doc_id % 97 + 1) / 99D AS PREDICTION_SCORE", "doc_id % 5 = 0 AS is_validation")
    return training.evaluate_scores(scored, "toxic")


SCORED = """SELECT if(doc_id % 5 = 0, 'validation', 'learn') AS part, toxic, (doc_id % 97 + 1) / 99.0::DOUBLE AS s FROM labels"""


@query(
    "eval_curves",
    f"""SELECT part, round(coalesce(2 * count(*) FILTER (toxic = 1 AND s > 0.5)
    / nullif(count(*) FILTER (toxic = 1) + count(*) FILTER (s > 0.5), 0), 0), 6) + 0.0 AS f1,
  round(avg(-ln(if(toxic = 1, s, 1 - s))), 6) + 0.0 AS logloss FROM ({SCORED}) GROUP BY part""",
)
def eval_curves(t: Tables) -> DataFrame:
    return _evaluations(t).select("part", rounded("f1").alias("f1"), rounded("logloss").alias("logloss"))


@query("accuracy_score", f"SELECT part, round(avg(if((toxic = 1) = (s > 0.5), 1.0, 0.0)), 6) + 0.0 AS accuracy FROM ({SCORED}) GROUP BY part")
def accuracy_score(t: Tables) -> DataFrame:
    return _evaluations(t).select("part", rounded("accuracy").alias("accuracy"))


LOGGED = {**training.params_row(SHORT), "original_features": 20.0}


cte("learn_counts", "SELECT LABEL, count(*) - floor(count(*) * 0.2) AS n FROM combined WHERE LABEL IN (0, 1) GROUP BY LABEL")


@query(
    "log_run",
    f"""SELECT * FROM (VALUES {", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in LOGGED.items())}) p(name, value)
UNION ALL SELECT 'class_weight_' || LABEL, round(sum(n) OVER () / (count(*) OVER () * n), 6) FROM learn_counts
UNION ALL SELECT 'rounds_in_time', 1.0""",
)
def log_run(t: Tables) -> DataFrame:
    """The parameters and class weights of a run's record, and whether the fit ended in time."""
    table, run = run_of(t)
    path = fresh_dir(t.spark, "runs")
    in_time = float(1 <= run.metrics["rounds"] <= SHORT.trees)
    sinks.log_run(t.spark, path, "demo", {"dataset": t.sf_dir, "rounds_in_time": in_time, **run.metrics})
    kept = F.col("name").isin(*LOGGED, "class_weight_0", "class_weight_1", "rounds_in_time")
    return t.spark.read.parquet(path).where(kept).select("name", rounded("double(value)").alias("value"))


# A fixed model, so that SQL can score the same trees: splits on numbers and on two-valued categories.
# Cuts have seven decimals, the last a 5, so that the twin may round the features to six.
FIXED_LABELS = [["-"], ["-"], ["-"], ["N", "Y"], ["N", "Y"], ["N", "Y"]]
_PLACE = {name: i for i, name in enumerate(training.Features().names)}


def _tree(root: tuple, low: tuple | float, high: tuple | float) -> list[boosting.Node]:
    """A tree of a split (feature, cut or categories, left, right) and up to two below it."""
    nodes: list[boosting.Node] = []

    def add(spec: tuple | float) -> int:
        at = len(nodes)
        nodes.append(boosting.Node(0.0 if isinstance(spec, tuple) else spec))
        if isinstance(spec, tuple):
            name, cut, left, right = spec
            below = add(left), add(right)
            plain = not isinstance(cut, tuple)
            nodes[at] = boosting.Node(0.0, _PLACE[name], cut if plain else None, () if plain else cut, *below)
        return at

    add((*root, low, high))
    return nodes


FIXED_STEP = 0.4
FIXED_TREES = [
    _tree(("ELC", (1.0,)), ("z_score_0", 0.4000005, -0.8, 0.9), ("max_abs_zscore", 2.2000005, 0.3, -0.6)),
    _tree(("max_consumption", 3.5000005), ("SUP", (0.0,), 1.1, -0.2), ("consumption_range", 4.1000005, -0.7, 0.25)),
    _tree(("max_residual_zscore", -50.0000005), -0.35, ("z_score_1", -0.1000005, 0.6, -0.45)),
    _tree(("common_weight_normalized", 0.5000005), ("min_consumption", 1.6000005, -0.15, 0.5), 0.75),
    _tree(("SMT", (0.0, 2.0)), 0.05, ("electronic_weight_normalized", 0.4500005, -0.3, 0.65)),
]
LOG_ODDS = boosting.log_odds_sql(
    [(FIXED_STEP, nodes) for nodes in FIXED_TREES],
    [f"CASE {c} WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE 2 END" for c in training.Features().categorical]
    + [f"coalesce({c}, {C.NO_RESIDUAL})" for c in training.Features().numeric],
)
cte("scored_rows", f"SELECT CNO, MNO, 1 / (1 + exp(-({LOG_ODDS}))) AS s FROM ({ORACLES['model_input']})")
cte("scores", "SELECT CNO, MNO, round(s, 9) AS PREDICTION_SCORE, concat(floor(s * 10) / 10, '-', (floor(s * 10) + 1) / 10) AS bin FROM scored_rows")
SCORES = """SELECT CNO, MNO, PREDICTION_SCORE, CASE bin WHEN '0.0-0.1' THEN '0-0.1' ELSE bin END AS CATEGORY FROM scores"""


def fixed_model(spark: SparkSession) -> PipelineModel:
    features = training.Features()
    columns = [f"{c}_index" for c in features.categorical]
    indexer = StringIndexerModel.from_arrays_of_labels(FIXED_LABELS, list(features.categorical), columns, "keep")
    assembler = VectorAssembler(inputCols=[*columns, *features.numeric], outputCol="features", handleInvalid="keep")
    values = {i: len(labels) + 1 for i, labels in enumerate(FIXED_LABELS)}
    booster = boosting.model_of(FIXED_TREES, FIXED_STEP, len(features.names), GBTClassifier(), values)
    return PipelineModel([indexer, assembler, booster])


def scores_of(found: DataFrame, *more: str) -> DataFrame:
    return found.select("CNO", "MNO", rounded("PREDICTION_SCORE", 9).alias("PREDICTION_SCORE"), "CATEGORY", *more)


@query("predict_proba", SCORES)
def predict_proba(t: Tables) -> DataFrame:
    """Each row's score and bin by the fixed model."""
    return scores_of(model_run.predict(fixed_model(t.spark), table_of(t)))
