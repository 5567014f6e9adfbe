"""Statistics, rules and scores: hand-worked cases, and the decomposition against NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline import constants as C
from wattline.functions import rules, stats
from wattline.operators import features


def frame(spark, series: list[list[float | None]], elc: str = "Y", codes=None):
    rows = [(i, elc, "1", s, codes[i] if codes else []) for i, s in enumerate(series)]
    schema = "i int, ELC string, MNO string, adv_ut_list array<double>, ent_cd_list array<string>"
    return spark.createDataFrame(rows, schema)


def test_zscore_tail_and_range(spark):
    given = [[2, 4, 4, 4, 5, 5, 7, 9], [3, 3, 3], [0, 4, 9], []]
    given = [[float(x) for x in s] for s in given]
    rows = features.add_statistics(frame(spark, given)).orderBy("i").collect()
    first = [rows[0][c] for c in C.Z_COLUMNS]
    assert first == pytest.approx([2, 1, 0, 0, -0.5, -0.5])
    assert rows[0]["max_abs_zscore"] == pytest.approx(2)
    assert [rows[1][c] for c in C.Z_COLUMNS] == [0] * 6
    ranged = [rows[2][c] for c in ("max_consumption", "min_consumption", "consumption_range")]
    assert ranged == pytest.approx(np.log1p([9, 4, 5]).tolist())
    assert [rows[3][c] for c in C.STAT_COLUMNS] == [0] * 11


def test_v1_statistics(spark):
    rows = features.add_statistics_v1(frame(spark, [[3.0, 3.0, 3.0], [1.0, 2.0, None]])).orderBy("i").collect()
    assert rows[0]["max_abs_zscore"] is None
    assert [rows[1][c] for c in C.Z_COLUMNS] == [0] * 6
    assert rows[1]["min_consumption"] == pytest.approx(np.log1p(1))


def decomposed(x: np.ndarray, extend: bool) -> np.ndarray:
    """Residual of an additive decomposition with period 12, written from its definition."""
    n = len(x)
    kernel = np.r_[0.5, np.ones(11), 0.5] / 12
    trend = np.full(n, np.nan)
    trend[6 : n - 6] = np.convolve(x, kernel, mode="valid")
    if extend:
        front, back = 6, n - 7
        ahead, behind = min(front + 12, back), max(front, back - 12)
        slope, level = np.polyfit(np.arange(front, ahead), trend[front:ahead], 1)
        trend[:front] = slope * np.arange(front) + level
        slope, level = np.polyfit(np.arange(behind, back), trend[behind:back], 1)
        trend[back + 1 :] = slope * np.arange(back + 1, n) + level
    rest = x - trend
    phases = np.array([np.nanmean(rest[k::12]) for k in range(12)])
    season = np.tile(phases - phases.mean(), n // 12 + 1)[:n]
    rest = rest - season
    return rest[~np.isnan(rest)]


@pytest.mark.parametrize("extend", [True, False])
def test_residual_matches_numpy(spark, extend):
    rng = np.random.default_rng(5)
    series = [(rng.gamma(2, 50, n) + 1).tolist() for n in list(range(25, 37)) * 4 + [60, 83]]
    if extend:
        series += [(rng.gamma(2, 50, 24) + 1).tolist()]
    text = stats.residual_z("adv_ut_list") if extend else stats.residual_z_v1("adv_ut_list")
    rows = frame(spark, series).selectExpr("i", f"{text} AS z").collect()
    for row in rows:
        rest = decomposed(np.array(series[row["i"]]), extend)
        want = np.max(np.abs(rest - rest.mean())) / rest.std()
        assert row["z"] == pytest.approx(want, rel=1e-9)


def test_residual_gate(spark):
    zeros = [0.0] * 4 + [float(i) for i in range(1, 21)]
    flat = [5.0] * 24
    series = [[1.0] * 23, zeros, zeros[1:] + [9.0], flat]
    texts = [f"{stats.residual_z('adv_ut_list')} AS z", f"{stats.residual_z_v1('adv_ut_list')} AS z1"]
    rows = frame(spark, series).selectExpr("i", *texts).orderBy("i").collect()
    assert [r["z"] for r in rows[:2]] == [-99, -99]
    assert rows[2]["z"] > 0
    assert rows[2]["z1"] == -99
    assert rows[3]["z"] is None
    assert rows[3]["z1"] == 0


def fired(spark, rule: str, series, elc, codes=None) -> list[int]:
    df = frame(spark, series, elc, codes)
    return [r[0] for r in df.orderBy("i").selectExpr(rules.fires(rules.RULES[rule])).collect()]


def test_spike_rules(spark):
    sixty = [60.0] * 6
    assert fired(spark, "t_2_c_1", [[*sixty, 240.0], [*sixty, 241.0], sixty], "Y") == [0, 1, 0]
    assert fired(spark, "t_2_c_2", [[*sixty, 480.0], [*sixty, 481.0]], "Y") == [0, 1]
    assert fired(spark, "t_2_c_1", [[*sixty, 241.0]], "N") == [0]
    assert fired(spark, "t_2_c_1", [[None, *sixty[1:], 900.0]], "Y") == [0]


def test_missing_last_reading(spark):
    given = [[20.0, 30.0, None]]
    assert fired(spark, "t_1_c_2", given, "N") == [0]
    filled = frame(spark, given, "N").withColumn("adv_ut_list", F.expr("transform(adv_ut_list, x -> coalesce(x, 0D))"))
    assert rules.apply_rules(filled).first()["t_1_c_2"] == 1


def test_code_rules(spark):
    codes = [["SP", None, None, None], [None, "SP", None, None], []]
    assert fired(spark, "t_1_c_1", [[]] * 3, "N", codes) == [0, 1, 0]
    assert fired(spark, "t_a_c_1", [[]] * 3, "N", [["x", "LCC"], ["LCC", None], []]) == [1, 0, 0]
    twice = [["NR", None, "NR"], [None, "NR", "NR"], []]
    assert fired(spark, "consecutive_NR", [[]] * 3, "N", twice) == [0, 1, 0]


def test_own_rules_extend_the_table(spark):
    own = {**rules.LIVE_RULES, "long_series": "size(adv_ut_list) > 2"}
    row = rules.apply_rules(frame(spark, [[1.0, 2.0, 3.0]]), own).first()
    assert row["long_series"] == 1 and "consecutive_NR" in row


def test_score_bins(evaluate):
    given = {"0D": "0-0.1", "0.1D": "0.1-0.2", "0.95D": "0.9-1.0", "1D": None, "-0.1D": None, "double(null)": None}
    found = evaluate({text: rules.score_bin(text) for text in given})
    assert found == given


def test_sigmoid(spark):
    df = spark.createDataFrame([(0.0235, 0.0352, 0.0269), (0.5, 0.5, 0.5)], "electronic_weight double, electromechanical_weight double, common_weight double")
    fixed = features.normalise_sigmoid(df, "fixed").first()
    assert [fixed[f"{c}_normalized"] for c in C.WEIGHT_COLUMNS] == [0.5] * 3
    row = features.normalise_sigmoid(df, "fit").first()
    weights = np.array([0.0235, 0.5])
    want = 1 / (1 + np.exp(-6 * (weights - weights.mean()) / (weights.std() + 1e-8)))
    assert row["electronic_weight_normalized"] == pytest.approx(want[0])
    with pytest.raises(ValueError, match="mode"):
        features.normalise_sigmoid(df, "other")
