"""List expressions: hand-worked cases, and random lists against brute force."""

from __future__ import annotations

import math
import random

import pytest

from wattline.functions import dates, labels, lists
from wattline.operators.series import dense_list

NONE = None


def array(values) -> str:
    items = ", ".join("null" if v is None else f"{float(v)}D" for v in values)
    return f"CAST(array({items}) AS array<double>)"


CASES = {
    "bimonthly": (lists.bimonthly_split, [10, NONE, 7, NONE, NONE, 9, NONE], [5, 3, 3, 4, 4]),
    "bimonthly negative": (lists.bimonthly_split, [-7, 3], [-3, 1]),
    "trimonthly": (lists.trimonthly_split, [NONE, NONE, 9, NONE, NONE, 12, NONE], [3, 3, 3, 4, 4, 4]),
    "trimonthly overlap": (lists.trimonthly_split, [NONE, 30, 9, 6], [3, 2, 2, 2]),
    "trimonthly all missing": (lists.trimonthly_split, [NONE, NONE], []),
    "tail of 40": (lists.tail, list(range(40)), list(range(4, 40))),
    "tail of 3": (lists.tail, [1, 2, 3], [1, 2, 3]),
    "tail of none": (lists.tail, [], []),
    "fill": (lists.fill_zero, [1, NONE], [1, 0]),
}


def test_hand_cases(evaluate):
    row = {f"c{i}": array(given) for i, (_, given, _) in enumerate(CASES.values())}
    texts = {name: f(f"c{i}") for i, (name, (f, _, _)) in enumerate(CASES.items())}
    found = evaluate(texts, row)
    assert found == {name: [float(x) for x in want] for name, (_, _, want) in CASES.items()}


def test_prefix_chooses_the_cycle(evaluate):
    row = {"a": array([10, 9, 30]), "b": "'01123'", "t": "'8812'", "o": "'77'", "n": "string(null)"}
    found = evaluate({c: lists.cycle_dispatch(c, "a") for c in "bton"}, row)
    assert found == {"b": [5, 4, 15], "t": [10, 10, 10], "o": [10, 9, 30], "n": [10, 9, 30]}


def test_list_text(evaluate):
    row = {"r": "'[None, 1.0, nan, 2]'", "c": "\"['NR', None, 'None', 'nan']\""}
    found = evaluate({"r": lists.parse_reading_list("r"), "c": lists.parse_code_list("c")}, row)
    assert found == {"r": [None, 1.0, None, 2.0], "c": ["NR", None, "None", "nan"]}


def test_bad_list_text_fails_the_job(evaluate):
    with pytest.raises(Exception, match="(?i)malformed"):
        evaluate({"r": lists.parse_reading_list("r")}, {"r": "'[1.0, oops'"})


def test_missing_share(evaluate):
    row = {"six": array([NONE] * 6 + [1] * 4), "none": array([])}
    found = evaluate({"six": lists.missing_ratio("six"), "none": lists.missing_ratio("none")}, row)
    assert found == {"six": 0.6, "none": None}


def brute_bimonthly(values):
    out = []
    for i, v in enumerate(values):
        follower = values[i + 1] if i + 1 < len(values) else None
        source = v if v is not None else follower
        if source is not None:
            out.append(float(math.trunc(source / 2)))
    return out


def brute_trimonthly(values):
    out = list(values)
    for i, v in enumerate(values):
        if v is not None:
            for j in range(max(0, i - 2), i + 1):
                out[j] = float(math.trunc(v / 3))
    while out and out[-1] is None:
        out.pop()
    return out


def test_random_splits(spark):
    dice = random.Random(7)
    given = [
        [dice.choice([None, float(dice.randint(-50, 500)), dice.random() * 90]) for _ in range(dice.randint(0, 45))]
        for _ in range(400)
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, a array<double>")
    rows = df.selectExpr("i", f"{lists.bimonthly_split('a')} AS b", f"{lists.trimonthly_split('a')} AS t").collect()
    for row in rows:
        assert row["b"] == brute_bimonthly(given[row["i"]])
        assert row["t"] == brute_trimonthly(given[row["i"]])


def test_dense_list_fills_gaps(spark):
    dice = random.Random(3)
    cases = []
    for i in range(200):
        positions = sorted(dice.sample(range(100, 140), dice.randint(0, 12)))
        start = dice.choice([None, dice.randint(95, 145), positions[0] if positions else 100])
        cases.append((i, [(p, float(p * 2)) for p in positions], start))
    df = spark.createDataFrame(cases, "i int, entries array<struct<pos: int, units: double>>, s int")
    found = {r["i"]: r["a"] for r in df.select("i", dense_list("entries", "units", "s").alias("a")).collect()}
    for i, entries, start in cases:
        known = dict(entries)
        want = []
        if start is not None and entries:
            want = [known.get(p) for p in range(start, entries[-1][0] + 1)]
        assert found[i] == want


def test_dates(evaluate):
    texts = {
        "bad_day": dates.parse_fix_date("'99/99/2020'"),
        "day": dates.parse_fix_date("'1/2/2020'"),
        "bad_month": dates.parse_bill_month("'202413'"),
        "month": dates.parse_bill_month("'202412'"),
        "far_month": dates.parse_bill_month("'999912'"),
        "text_month": dates.parse_bill_month("'2024-1'"),
        "none": dates.parse_bill_month("string(null)"),
        "position": f"{dates.month_position('date(\"2024-03-09\")')}",
        "back": dates.position_month("24290"),
    }
    found = {k: str(v) for k, v in evaluate(texts).items()}
    assert found == {
        "bad_day": "None", "day": "2020-02-01", "bad_month": "None", "month": "2024-12-01",
        "far_month": "None", "text_month": "None", "none": "None", "position": "24290",
        "back": "2024-03-01",
    }


def test_labels(evaluate):
    flags = {"yn": ("'Y'", "'N'"), "ny": ("'N'", "'Y'"), "missing": ("string(null)", "string(null)")}
    texts = {name: labels.label_from_flags(*pair) for name, pair in flags.items()}
    texts |= {
        "relabel_ok": labels.relabel_from_remark("1", "'METER OK'"),
        "relabel_bad": labels.relabel_from_remark("0", "'METER DEFECTIVE'"),
        "relabel_none": labels.relabel_from_remark("1", "string(null)"),
        "current": labels.label_from_current_meter("true"),
        "old": labels.label_from_current_meter("false"),
        "unknown": labels.label_from_current_meter("boolean(null)"),
        "serial": labels.serial_number("'0012'"),
        "no_serial": labels.serial_number("'A12'"),
        "other": labels.is_other_meter("'DIFFERENT METER AT SITE: METER OK'"),
        "no_remark": labels.is_other_meter("string(null)"),
        "supported": labels.is_supported_model("102"),
        "unsupported": labels.is_supported_model("104"),
        "no_model": labels.is_supported_model("int(null)"),
    }
    assert evaluate(texts) == {
        "yn": 1, "ny": 1, "missing": 0, "relabel_ok": 0, "relabel_bad": 1, "relabel_none": 1,
        "current": 0, "old": 1, "unknown": None, "serial": 12, "no_serial": None, "other": True,
        "no_remark": False, "supported": True, "unsupported": False, "no_model": False,
    }
