"""Statistics, rules, weights and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import Tables, cte, query, rounded
from wattline import constants as C
from wattline.functions import lists, rules, stats
from wattline.operators import features


def residual_ctes(name: str, source: str, extend: bool = True, keys: str = "k") -> None:
    """Sub-selects that decompose ``source`` (keys, idx, n, v): ``<name>_resid`` has the residuals.

    They say with windows and regressions what the library says with lists.
    """
    on = f"USING ({keys})"
    cte(
        f"{name}_smooth",
        f"""
SELECT {keys}, idx, n, v, CASE WHEN count(*) OVER w = 13 THEN
  (sum(v) OVER w - 0.5 * first_value(v) OVER w - 0.5 * last_value(v) OVER w) / 12 END AS trend
FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY idx ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)""",
    )
    cte(
        f"{name}_lines",
        f"""
SELECT {keys},
  regr_slope(trend, idx) FILTER (idx BETWEEN 6 AND least(18, n - 7) - 1) AS front_slope,
  regr_intercept(trend, idx) FILTER (idx BETWEEN 6 AND least(18, n - 7) - 1) AS front_level,
  regr_slope(trend, idx) FILTER (idx BETWEEN greatest(6, n - 19) AND n - 8) AS back_slope,
  regr_intercept(trend, idx) FILTER (idx BETWEEN greatest(6, n - 19) AND n - 8) AS back_level
FROM {name}_smooth GROUP BY {keys}""",
    )
    filled = (
        """CASE WHEN idx < 6 THEN front_slope * idx + front_level
    WHEN idx > n - 7 THEN back_slope * idx + back_level ELSE trend END"""
        if extend
        else "trend"
    )
    cte(
        f"{name}_detrended",
        f"""
SELECT {keys}, idx, n, v, v - {filled} AS d FROM {name}_smooth JOIN {name}_lines {on}""",
    )
    cte(
        f"{name}_phases",
        f"""
SELECT {keys}, phase, a - avg(a) OVER (PARTITION BY {keys}) AS s FROM (
  SELECT {keys}, idx % 12 AS phase, avg(d) AS a FROM {name}_detrended WHERE d IS NOT NULL GROUP BY {keys}, idx % 12)""",
    )
    keys_and_phase = " AND ".join(f"t.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    cte(
        f"{name}_resid",
        f"""
SELECT {', '.join('t.' + k.strip() for k in keys.split(','))}, t.idx, t.d - p.s AS r
FROM {name}_detrended t JOIN {name}_phases p ON {keys_and_phase} AND t.idx % 12 = p.phase WHERE t.d IS NOT NULL""",
    )
    cte(
        f"{name}_resid_stats",
        f"SELECT {keys}, avg(r) AS r_mean, stddev_pop(r) AS r_std, min(r) AS r_min, max(r) AS r_max FROM {name}_resid GROUP BY {keys}",
    )


def residual_sql(zeros_ok: str, otherwise: str = "NULL") -> str:
    """Largest |z| of the residual behind its gate; needs n, zeros, scale and the residual stats."""
    return f"""CASE WHEN n >= 24 AND zeros {zeros_ok} THEN
    CASE WHEN r_std > scale * 1e-9 THEN greatest(r_max - r_mean, r_mean - r_min) / r_std ELSE {otherwise} END
  ELSE -99 END"""


residual_ctes("mt", "m_tail")
residual_ctes("mt1", "m_tail", extend=False)
cte(
    "m_moments",
    """
SELECT k, any_value(n) AS n, avg(v) AS mean, stddev_pop(v) AS std, max(v) AS high, min(v) AS least_v, max(abs(v)) AS scale,
  count(*) FILTER (v = 0) AS zeros, coalesce(min(v) FILTER (v > 0), 0) AS low,
  coalesce(min(v) FILTER (v <> 0), 0) AS low_v1
FROM m_tail GROUP BY k""",
)
cte(
    "m_z",
    """
SELECT k, idx, t.n, CASE WHEN std < 1e-8 THEN 0 ELSE (v - mean) / std END AS z,
  CASE WHEN high <> least_v THEN (v - mean) / std END AS z1
FROM m_tail t JOIN m_moments USING (k)""",
)


def z_tail_sql(z: str) -> str:
    return ", ".join(f"round(coalesce(max({z}) FILTER (idx = n - {i + 1}), 0), 6) + 0.0 AS z_score_{i}" for i in range(6))


def _m_tail(t: Tables) -> DataFrame:
    return S.m_series(t).withColumn("adv_ut_list", F.expr(lists.fill_zero(lists.tail("adv_ut_list"))))


@query("zscore_window", "SELECT k, idx, round(z, 6) + 0.0 AS z FROM m_z")
def zscore_window(t: Tables) -> DataFrame:
    z = _m_tail(t).select("k", F.posexplode(F.expr(stats.zscores("adv_ut_list"))).alias("idx", "z"))
    return z.withColumn("z", rounded("z"))


@query("feat_zscore_tail", f"SELECT k, {z_tail_sql('z')} FROM m_z GROUP BY k")
def feat_zscore_tail(t: Tables) -> DataFrame:
    found = features.add_statistics(_m_tail(t))
    return found.select("k", *(rounded(c).alias(c) for c in C.Z_COLUMNS))


@query("feat_max_abs_z", "SELECT k, round(max(abs(z)), 6) + 0.0 AS max_abs_zscore FROM m_z GROUP BY k")
def feat_max_abs_z(t: Tables) -> DataFrame:
    return features.add_statistics(_m_tail(t)).select("k", rounded("max_abs_zscore").alias("max_abs_zscore"))


@query(
    "feat_minmax_range",
    """SELECT k, round(ln(1 + high), 6) + 0.0 AS max_consumption, round(ln(1 + low), 6) + 0.0 AS min_consumption,
  round(ln(1 + high - low), 6) + 0.0 AS consumption_range FROM m_moments""",
)
def feat_minmax_range(t: Tables) -> DataFrame:
    columns = ["max_consumption", "min_consumption", "consumption_range"]
    return features.add_statistics(_m_tail(t)).select("k", *(rounded(c).alias(c) for c in columns))


@query(
    "feat_residual_z",
    f"""SELECT k, round({residual_sql('<= 3')}, 6) + 0.0 AS max_residual_zscore
FROM m_moments LEFT JOIN mt_resid_stats USING (k)""",
)
def feat_residual_z(t: Tables) -> DataFrame:
    found = features.add_statistics(_m_tail(t))
    return found.select("k", rounded("max_residual_zscore").alias("max_residual_zscore"))


@query(
    "feat_residual_z_v1",
    f"""SELECT k, round({residual_sql('< 3', '0')}, 6) + 0.0 AS max_residual_zscore
FROM m_moments LEFT JOIN mt1_resid_stats USING (k)""",
)
def feat_residual_z_v1(t: Tables) -> DataFrame:
    found = features.add_statistics_v1(_m_tail(t))
    return found.select("k", rounded("max_residual_zscore").alias("max_residual_zscore"))


@query(
    "feat_zscore_v1",
    "SELECT k, "
    + ", ".join(f"round(CASE WHEN n > 5 THEN max(z1) FILTER (idx = n - {i + 1}) ELSE 0 END, 6) + 0.0 AS z_score_{i}" for i in range(6))
    + ", round(max(abs(z1)), 6) + 0.0 AS max_abs_zscore FROM m_z GROUP BY k, n",
)
def feat_zscore_v1(t: Tables) -> DataFrame:
    found = features.add_statistics_v1(_m_tail(t))
    return found.select("k", *(rounded(c).alias(c) for c in [*C.Z_COLUMNS, "max_abs_zscore"]))


# ---- rules ----


def _e_filled(t: Tables) -> DataFrame:
    return S.e_series(t).withColumn("adv_ut_list", F.expr(lists.fill_zero("adv_ut_list")))


cte(
    "e_facts",
    """
SELECT k, max(n) AS n, CASE WHEN k % 2 = 0 THEN 'N' ELSE 'Y' END AS ELC, k * 1500 + 6990000 AS serial,
  max(v) FILTER (idx = n - 1) AS last_v,
  sum(coalesce(v, 0)) FILTER (idx BETWEEN n - 7 AND n - 2) / 6 AS prior,
  CASE WHEN count(v) FILTER (idx BETWEEN n - 7 AND n - 2) = 6 THEN
    sum(v) FILTER (idx BETWEEN n - 7 AND n - 2) / 6 END AS prior_raw,
  max(code) FILTER (idx = n - 1) AS last_code,
  coalesce(bool_or(code = 'SP') FILTER (idx >= n - 3), false) AS sp3,
  coalesce(bool_or(code = 'LW') FILTER (idx >= n - 3), false) AS lw3,
  coalesce(bool_or(code = 'NR') FILTER (idx >= n - 3), false) AS nr3,
  coalesce(bool_or(code = 'NR' AND prev = 'NR'), false) AS nr_twice
FROM (SELECT *, lag(code) OVER (PARTITION BY k ORDER BY idx) AS prev FROM e_rows) GROUP BY k""",
)
RULE_SQL = {
    "t_1_c_1": "ELC = 'N' AND sp3",
    "t_1_c_2": "ELC = 'N' AND coalesce(last_v, 0) < 10",
    "t_1_c_3": "ELC = 'N' AND lw3",
    "t_2_c_1": "ELC = 'Y' AND n >= 7 AND prior > 50 AND coalesce(last_v, 0) > 4 * prior",
    "t_2_c_2": "ELC = 'Y' AND n >= 7 AND prior > 50 AND coalesce(last_v, 0) > 8 * prior",
    "t_2_c_3": "ELC = 'Y' AND nr3",
    "t_a_c_1": "last_code IN ('LCC', 'NR', 'Read')",
    "consecutive_NR": "nr_twice",
}
RAW_RULE_SQL = {
    **{name: text for name, text in RULE_SQL.items() if name != "consecutive_NR"},
    "t_1_c_2": "ELC = 'N' AND last_v < 10",
    "t_2_c_1": "ELC = 'Y' AND n >= 7 AND prior_raw > 50 AND last_v > 4 * prior_raw",
    "t_2_c_2": "ELC = 'Y' AND n >= 7 AND prior_raw > 50 AND last_v > 8 * prior_raw",
    "t_2_c_4": "ELC = 'Y' AND serial BETWEEN 7000001 AND 7097000",
}


def flag_sql(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS INTEGER)"


RULE_LIST = ", ".join(f"{flag_sql(text)} AS {name}" for name, text in RULE_SQL.items())
cte("e_rules", f"SELECT k, {RULE_LIST} FROM e_facts")


def _register_rule(name: str, rule: str, condition: str) -> None:
    @query(f"rule_{name}", f"SELECT k, ELC, {flag_sql(condition)} AS hit FROM e_facts")
    def run(t: Tables) -> DataFrame:
        return _e_filled(t).selectExpr("k", "ELC", f"{rules.fires(rule)} AS hit")


for _name, _rule in rules.RULES.items():
    _register_rule(_name.replace("NR", "nr"), _rule, {**RAW_RULE_SQL, **RULE_SQL}[_name])


@query("rule_registry", "SELECT * FROM e_rules")
def rule_registry(t: Tables) -> DataFrame:
    return rules.apply_rules(_e_filled(t)).select("k", *rules.LIVE_RULES)


def weight_sql(weights: dict[str, float]) -> str:
    return " + ".join(f"{name} * CAST({weight} AS DOUBLE)" for name, weight in weights.items())


WEIGHT_SQL = {
    "electronic_weight": weight_sql(C.ELECTRONIC_WEIGHTS),
    "electromechanical_weight": weight_sql(C.ELECTROMECHANICAL_WEIGHTS),
    "common_weight": weight_sql(C.COMMON_WEIGHTS),
}
cte("e_weights", "SELECT k, " + ", ".join(f"{text} AS {name}" for name, text in WEIGHT_SQL.items()) + " FROM e_rules")


def _weighted(t: Tables) -> DataFrame:
    return features.add_weights(rules.apply_rules(_e_filled(t)))


def _register_weight(name: str, column: str) -> None:
    @query(name, f"SELECT k, round({column}, 6) + 0.0 AS {column} FROM e_weights")
    def run(t: Tables) -> DataFrame:
        return _weighted(t).select("k", rounded(column).alias(column))


_register_weight("weight_electronic", "electronic_weight")
_register_weight("weight_electromech", "electromechanical_weight")
_register_weight("weight_common", "common_weight")

SCORE_SQL = " + ".join(f"{weight} * ({flag_sql(RAW_RULE_SQL[name])})" for name, weight in C.SCORE_WEIGHTS.items())


@query("computed_score", f"SELECT k, CAST({SCORE_SQL} AS INTEGER) AS computed_score FROM e_facts")
def computed_score(t: Tables) -> DataFrame:
    return S.e_series(t).select("k", F.expr(rules.computed_score()).alias("computed_score"))


def fitted_sql(columns: list[str], source: str) -> str:
    return ", ".join(
        f"round(1 / (1 + exp(-6.0 * ({c} - (SELECT avg({c}) FROM {source})) / ((SELECT stddev_pop({c}) FROM {source}) + 1e-8))), 6) + 0.0 AS {c}_normalized"
        for c in columns
    )


def fixed_sql(columns: list[str]) -> str:
    return ", ".join(
        f"round(1 / (1 + exp(-6.0 * ({c} - {C.FIXED_WEIGHT_STATS[c][0]}) / {C.FIXED_WEIGHT_STATS[c][1]})), 6) + 0.0 AS {c}_normalized"
        for c in columns
    )


def _normalised(df: DataFrame) -> DataFrame:
    names = [f"{c}_normalized" for c in C.WEIGHT_COLUMNS]
    return df.select("k", *(rounded(c).alias(c) for c in names))


@query("normalise_sigmoid", f"SELECT k, {fitted_sql(C.WEIGHT_COLUMNS, 'e_weights')} FROM e_weights")
def normalise_sigmoid(t: Tables) -> DataFrame:
    return _normalised(features.normalise_sigmoid(_weighted(t), "fit"))


@query("normalise_sigmoid_fixed", f"SELECT k, {fixed_sql(C.WEIGHT_COLUMNS)} FROM e_weights")
def normalise_sigmoid_fixed(t: Tables) -> DataFrame:
    return _normalised(features.normalise_sigmoid(_weighted(t), "fixed"))
