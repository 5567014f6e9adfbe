"""Inputs that must spoil their own row only, and results that must not depend on chance."""

from __future__ import annotations

import pytest

from wattline import constants as C
from wattline.functions import dates, lists
from wattline.operators import combine, lookup, metrics, training
from wattline.sources import readers


def write(path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_a_code_beyond_its_range_is_unknown(spark, tmp_path):
    header = "|".join(C.CONSUMER_COLUMNS)
    rows = ["|".join({"MCD": mcd}.get(c, "1") for c in C.CONSUMER_COLUMNS) for mcd in ("9999999999", "80.0", "x")]
    path = write(tmp_path / "consumer.txt", "\n".join([header, *rows]))
    assert [r["MCD"] for r in readers.read_consumer(spark, path).orderBy(C.ROW_ORDER).collect()] == [None, 80, None]


def test_another_header_order_fails(spark, tmp_path):
    folder = tmp_path / "report"
    folder.mkdir()
    columns = list(C.CONSUMPTION_COLUMNS)
    write(folder / "a.csv", "|".join(columns) + "\n" + "|".join("1" for _ in columns) + "\n")
    write(folder / "b.csv", "|".join(reversed(columns)) + "\n" + "|".join("2" for _ in columns) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_text_table(spark, str(folder), columns, "|").collect()


def test_days_and_months_outside_the_range_are_missing(evaluate):
    found = evaluate({
        "late": dates.parse_fix_date("'31/12/9999'"),
        "early": dates.parse_fix_date("'01/01/1500'"),
        "day": dates.parse_fix_date("'1/2/2020'"),
        "short": dates.parse_bill_month("'20201'"),
        "far": dates.parse_bill_month("'226205'"),
        "zero": dates.parse_bill_month("'20200'"),
    })
    assert [str(found[k]) for k in ("late", "early", "far", "zero")] == ["None"] * 4
    assert str(found["day"]) == "2020-02-01" and str(found["short"]) == "2020-01-01"


def test_list_text_keeps_quoted_codes(evaluate):
    row = {"codes": '"[\'a, None, b\', None ,           None, \\"nan\\"]"', "numbers": "'[ 1.0,\t None,          nan, -2]'", "none": "'[]'"}
    found = evaluate({"codes": lists.parse_code_list("codes"), "numbers": lists.parse_reading_list("numbers"), "none": lists.parse_code_list("none")}, row)
    assert found["codes"] == ["a, None, b", None, None, "nan"]
    assert found["numbers"] == [1.0, None, None, -2.0] and found["none"] == []
    with pytest.raises(Exception):
        evaluate({"x": lists.parse_code_list("codes")}, {"codes": "'no list'"})


def test_the_merge_does_not_follow_the_order_of_rows(spark):
    rows = [("1", "1", "c", "m", 1, [2.0]), ("1", "1", "c", "m", 0, [1.0]), ("1", "1", "c", "m", 0, [3.0])]
    schema = "CONS_ID string, CSQ string, CNO string, MNO string, LABEL int, adv_ut_list array<double>"
    for order in (rows, rows[::-1]):
        table = combine.union_sources({"it's": spark.createDataFrame(order, schema).coalesce(1)})
        best = combine.dedup_priority(table, ["it's"], {"it's": 1}).collect()
        assert [(r["LABEL"], r["adv_ut_list"], r["SOURCE"]) for r in best] == [(0, [1.0], "it's")]


def test_a_repeated_model_fails(spark):
    meters = spark.createDataFrame([(1,), (2,), (None,)], "MCD int")
    models = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "MCD int, MFG string")
    assert lookup.join_mcd_properties(meters, models, properties=["MFG"]).count() == 3
    twice = models.union(spark.createDataFrame([(1, "z")], models.schema))
    with pytest.raises(Exception, match="model listed more than once"):
        lookup.join_mcd_properties(meters, twice, properties=["MFG"]).collect()


def test_confusion_of_three_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 0), (1, 1)], "a int, p int")
    found = {r["actual"]: tuple(r)[1:] for r in metrics.metric_confusion(df, "a", "p", (0, 1, 2)).collect()}
    assert found == {0: (1, 0, 1), 1: (1, 2, 0), 2: (0, 0, 0)}
    assert sorted(map(tuple, metrics.confusion_pairs(df, "a", "p").collect())) == [(0, 0, 1), (0, 2, 1), (1, 0, 1), (1, 1, 2)]


def test_best_round_waits_for_the_patience():
    assert training.best_round([5, 4, 4.5, 3, 3.1], 100) == 4  # a dip that recovers
    assert training.best_round([5, 4, 4.5, 4.6, 3], 2) == 2
    assert training.best_round([1], 100) == 1


def test_training_keeps_the_best_round_and_takes_many_categories(spark):
    df = spark.range(800).selectExpr(
        "concat('make', id % 80) AS make", "double(id % 7) AS x", "int(id % 7 > 3 OR id % 80 = 5) AS LABEL",
        "1D AS class_weight", "id % 5 = 0 AS is_validation",
    )
    features = training.Features(("make",), ("x",))
    model = training.train_gbt(df, features, training.TreeParams(trees=6, depth=2))
    kept = training.booster(model)
    losses = kept.evaluateEachIteration(
        type(model)(model.stages[:-1]).transform(df.where("is_validation")).select("features", "LABEL", "class_weight")
    )
    assert 1 <= kept.getNumTrees <= 6 and losses[-1] == min(losses)
    assert training.score(model, df, features).where("PREDICTION_SCORE BETWEEN 0 AND 1").count() == 800
