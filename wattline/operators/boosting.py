"""Boosting round by round on a stored margin, and trees as rows, as SQL text and back as a model.

Every row carries its margin, the log-odds that the trees so far give it. A round fits one regression
tree of MLlib to the Newton steps of the rows, shrinks the leaves by the L2 term, adds the tree to the
margin and scores the held-out rows. It ends ``patience`` rounds after the best one, so that no round is
fitted in vain beyond these. The rows are written to the shared folder every few rounds, so a lost
executor costs the trees since then and no plan grows with the rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import remove_dir, scratch_dir

MARGIN, ROW, STEP = "_margin", "_row", "_step"
# Rounds between two stores of the margin.
STORED_EVERY = 8
LEAST_CURVATURE = 1e-6
PREFIX = "org.apache.spark.ml"


@dataclass(frozen=True)
class Round:
    """Weighted log-loss and F1 of class 1 over the held-out rows after a round."""

    loss: float
    f1: float


@dataclass(frozen=True)
class Node:
    """A split, left where the value is at most ``threshold`` or one of ``categories``; or a leaf."""

    value: float
    feature: int = -1
    threshold: float | None = None
    categories: tuple[float, ...] = ()
    left: int = -1
    right: int = -1


def _jvm():
    return SparkContext._active_spark_context._jvm


def _java(path: str):
    found = _jvm()
    for part in f"{PREFIX}.{path}".split("."):
        found = getattr(found, part)
    return found


def best_round(values: Sequence[float], patience: int) -> int:
    """Number of rounds up to the least value, given up after ``patience`` rounds without a lesser one."""
    best = 0
    for i, value in enumerate(values):
        if value < values[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def shrunk(tree: DecisionTreeRegressionModel, l2: float) -> DecisionTreeRegressionModel:
    """The tree with each leaf's mean taken over its weight and ``l2`` more of weight at 0."""
    leaf, inner = _java("tree.LeafNode"), _java("tree.InternalNode")

    def rebuilt(node):
        stats = node.impurityStats()
        if node.getClass().getSimpleName() == "LeafNode":
            sums = stats.stats()
            return leaf(float(sums[1] / (sums[0] + l2)), node.impurity(), stats)
        left, right = rebuilt(node.leftChild()), rebuilt(node.rightChild())
        return inner(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), stats)

    java = tree._java_obj
    made = _java("regression.DecisionTreeRegressionModel")(java.uid(), rebuilt(java.rootNode()), java.numFeatures())
    return DecisionTreeRegressionModel(java.copyValues(made, java.extractParamMap()))


def _steps(rows: DataFrame, label: str, weight: str, turn: int, bagging: float) -> DataFrame:
    """Rows with their Newton step and its weight, which a Bayesian bootstrap varies from round to round."""
    chance = 1 / (1 + F.exp(-F.col(MARGIN)))
    curve = F.greatest(chance * (1 - chance), F.lit(LEAST_CURVATURE))
    drawn = (F.pmod(F.xxhash64(F.lit(turn), ROW), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    luck = F.pow(-F.log(drawn), F.lit(float(bagging))) if bagging else F.lit(1.0)
    return rows.select("features", ((F.col(label) - chance) / curve).alias("_z"), (F.col(weight) * curve * luck).alias("_w"))


def _scored(rows: DataFrame, label: str, weight: str, held_out: str) -> Round | None:
    """None without held-out rows."""
    actual, claimed, w = F.col(label) == 1, F.col(MARGIN) > 0, F.col(weight)
    loss = F.log1p(F.exp(-F.abs(MARGIN))) + F.greatest(F.when(actual, -F.col(MARGIN)).otherwise(F.col(MARGIN)), F.lit(0.0))
    sums = rows.where(held_out).agg(
        F.sum(w).alias("w"), F.sum(w * loss).alias("loss"), F.sum(F.when(actual & claimed, w).otherwise(0)).alias("tp"),
        (F.sum(F.when(actual, w).otherwise(0)) + F.sum(F.when(claimed, w).otherwise(0))).alias("marked"),
    ).first()
    if not sums["w"]:
        return None
    return Round(sums["loss"] / sums["w"], 2 * sums["tp"] / sums["marked"] if sums["marked"] else 0.0)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fit(
    rows: DataFrame, estimator: GBTClassifier, params, label: str, weight: str, held_out: str
) -> tuple[GBTClassificationModel, list[Round]]:
    """The model of the rounds up to the best one, and how every fitted round did.

    ``rows`` has ``features``, the label of 0 or 1, the weight and the held-out flag. ``params`` has the
    fields of ``training.TreeParams``. Without held-out rows all rounds are fitted and kept.
    """
    grower = DecisionTreeRegressor(
        featuresCol="features", labelCol="_z", weightCol="_w", predictionCol=STEP, maxDepth=params.depth,
        maxBins=estimator.getMaxBins(), seed=params.seed,
    )
    trees, curve = [], []
    with scratch_dir(rows.sparkSession, "margins") as place:
        path = f"{place}/0"
        numbered = rows.withColumns({ROW: F.monotonically_increasing_id(), MARGIN: F.lit(0.0)})
        now = _kept(numbered, path)
        for turn in range(params.trees):
            learn = _steps(now.where(~F.col(held_out)), label, weight, turn, params.bagging)
            tree = shrunk(grower.fit(learn), params.l2)
            trees.append(tree)
            now = tree.transform(now).withColumn(MARGIN, F.col(MARGIN) + params.step * F.col(STEP)).drop(STEP)
            if (turn + 1) % STORED_EVERY == 0:
                before, path = path, f"{place}/{turn + 1}"
                now = _kept(now, path)
                remove_dir(rows.sparkSession, before)
            found = _scored(now, label, weight, held_out)
            if found is None:
                continue
            curve.append(found)
            values = [-c.f1 if params.by_f1 else c.loss for c in curve]
            if best_round(values, params.patience) + params.patience <= len(values):
                break
    if curve:
        trees = trees[: best_round([-c.f1 if params.by_f1 else c.loss for c in curve], params.patience)]
    return assembled([t._java_obj for t in trees], params.step, estimator), curve


def assembled(trees: Sequence, step: float, estimator: GBTClassifier) -> GBTClassificationModel:
    """A classifier of regression trees whose sum, times ``step``, is the log-odds.

    MLlib takes half of the log-odds for its margin.
    """
    gateway = SparkContext._active_spark_context._gateway
    members = gateway.new_array(_java("regression.DecisionTreeRegressionModel"), len(trees))
    weights = gateway.new_array(_jvm().double, len(trees))
    for i, tree in enumerate(trees):
        members[i], weights[i] = tree, step / 2
    java = estimator._to_java()
    made = _java("classification.GBTClassificationModel")(java.uid(), members, weights, trees[0].numFeatures(), 2)
    return GBTClassificationModel(java.copyValues(made, java.extractParamMap()))


def nodes_of(model: GBTClassificationModel) -> list[tuple[float, list[Node]]]:
    """Each tree's weight in the log-odds, and its nodes, the root first."""
    found = []
    for tree, weight in zip(model.trees, model.treeWeights):
        nodes: list[Node] = []

        def walk(node) -> int:
            at = len(nodes)
            nodes.append(Node(node.prediction()))
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                plain = split.getClass().getSimpleName() == "ContinuousSplit"
                left, right = walk(node.leftChild()), walk(node.rightChild())
                nodes[at] = Node(
                    node.prediction(), split.featureIndex(), split.threshold() if plain else None,
                    () if plain else tuple(split.leftCategories()), left, right,
                )
            return at

        walk(tree._java_obj.rootNode())
        found.append((2 * weight, nodes))
    return found


def model_of(trees: Sequence[Sequence[Node]], step: float, width: int, estimator: GBTClassifier, values: Mapping[int, int]) -> GBTClassificationModel:
    """The classifier that ``trees`` describe; ``values`` has the number of values of each categorical feature."""
    leaf, inner = _java("tree.LeafNode"), _java("tree.InternalNode")
    gateway = SparkContext._active_spark_context._gateway
    stats = gateway.new_array(_jvm().double, 3)
    stats[0], stats[1], stats[2] = 1.0, 0.0, 0.0
    calculator = _jvm().org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, 1)
    made = []
    for nodes in trees:

        def build(at: int, nodes=nodes):
            node = nodes[at]
            if node.feature < 0:
                return leaf(float(node.value), 0.0, calculator)
            if node.threshold is None:
                chosen = gateway.new_array(_jvm().double, len(node.categories))
                for i, c in enumerate(node.categories):
                    chosen[i] = float(c)
                split = _java("tree.CategoricalSplit")(node.feature, chosen, values[node.feature])
            else:
                split = _java("tree.ContinuousSplit")(node.feature, float(node.threshold))
            return inner(float(node.value), 0.0, 0.0, build(node.left), build(node.right), split, calculator)

        made.append(_java("regression.DecisionTreeRegressionModel")(f"tree_{len(made)}", build(0), width))
    return assembled(made, step, estimator)


def log_odds_sql(trees: Sequence[tuple[float, Sequence[Node]]], names: Sequence[str]) -> str:
    """The log-odds as SQL text over the columns that ``names`` gives to the features, for any engine.

    A missing value is larger than every threshold, as MLlib's NaN is.
    """

    def case(nodes: Sequence[Node], at: int) -> str:
        node = nodes[at]
        if node.feature < 0:
            return f"CAST({node.value!r} AS DOUBLE)"
        name = names[node.feature]
        if node.threshold is None:
            test = f"{name} IN ({', '.join(str(int(c)) for c in node.categories)})"
        else:
            test = f"{name} <= CAST({node.threshold!r} AS DOUBLE)"
        return f"CASE WHEN {test} THEN {case(nodes, node.left)} ELSE {case(nodes, node.right)} END"

    return " + ".join(f"CAST({weight!r} AS DOUBLE) * ({case(nodes, 0)})" for weight, nodes in trees) or "CAST(0 AS DOUBLE)"


def tree_rows(trees: Sequence[tuple[float, Sequence[Node]]]) -> list[tuple]:
    """``tree, node, weight, value, feature, threshold, categories, left, right`` of every node."""
    return [
        (t, k, weight, n.value, n.feature, n.threshold, list(n.categories), n.left, n.right)
        for t, (weight, nodes) in enumerate(trees)
        for k, n in enumerate(nodes)
    ]


TREE_SQL = (
    "tree int, node int, weight double, value double, feature int, threshold double, categories array<double>,"
    " `left` int, `right` int"
)
