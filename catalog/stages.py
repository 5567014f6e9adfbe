"""Whole stages: raw tables to screened rows, to one combined dataset, to the model input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog import standins as S
from catalog.features import (
    RAW_RULE_SQL,
    RULE_SQL,
    WEIGHT_SQL,
    fitted_sql,
    flag_sql,
    residual_ctes,
    residual_sql,
)
from catalog.registry import Tables, cte, query, rounded
from catalog.relational import MISSING_FDT, NO_CONSUMPTION, SUPPORTED
from wattline import constants as C
from wattline.functions import rules
from wattline.operators.rows import distinct_rows
from wattline.plans import increments
from wattline.plans import model_input as model
from wattline.plans import raw
from wattline.session import fresh_dir
from wattline.sources import readers, sinks

KEYS = "CONS_ID, CSQ, MNO"
PROPERTIES = ", ".join(C.MODEL_PROPERTIES)


def list_ctes(p: str) -> None:
    """From ``<p>_rows`` (keys, CNO, idx, v, code) to the recent readings and codes."""
    window = f"(PARTITION BY {KEYS} ORDER BY idx)"
    cte(
        f"{p}_split",
        f"""
SELECT * FROM (
  SELECT {KEYS}, idx, coalesce(trunc(v / 2), lead(trunc(v / 2)) OVER {window}) AS v
  FROM {p}_rows WHERE CNO LIKE '011%') WHERE v IS NOT NULL
UNION ALL
SELECT {KEYS}, idx, v FROM (
  SELECT {KEYS}, idx,
    coalesce(lead(trunc(v / 3), 2) OVER {window}, lead(trunc(v / 3)) OVER {window}, trunc(v / 3)) AS v,
    max(idx) FILTER (v IS NOT NULL) OVER (PARTITION BY {KEYS}) AS last_idx
  FROM {p}_rows WHERE CNO LIKE '88%') WHERE idx <= last_idx
UNION ALL
SELECT {KEYS}, idx, v FROM {p}_rows WHERE NOT (CNO LIKE '011%' OR CNO LIKE '88%')""",
    )
    for name, source, value in ((f"{p}_tail", f"{p}_split", "v"), (f"{p}_codes", f"{p}_rows", "code")):
        cte(
            name,
            f"""
SELECT {KEYS}, place - greatest(total - 36, 0) AS idx, least(total, 36) AS n, {value} FROM (
  SELECT *, row_number() OVER {window} - 1 AS place, count(*) OVER (PARTITION BY {KEYS}) AS total
  FROM {source}) WHERE place >= total - 36""",
        )
    cte(
        f"{p}_lists",
        f"""
SELECT {KEYS}, count(*) AS n, max(v) AS high, count(*) FILTER (v IS NULL) / count(*) AS missing,
  string_agg(coalesce(CAST(CAST(v AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY idx) AS readings
FROM {p}_tail GROUP BY {KEYS}""",
    )
    cte(
        f"{p}_code_lists",
        f"SELECT {KEYS}, string_agg(coalesce(code, '-'), ',' ORDER BY idx) AS codes FROM {p}_codes GROUP BY {KEYS}",
    )


DEFECT = """EXISTS (SELECT 1 FROM ranges r WHERE r.MFG = o.MFG AND r.AMP = o.AMP AND r.VLT = o.VLT
    AND TRY_CAST(x.MNO AS BIGINT) BETWEEN r.start_serial AND r.end_serial)"""

# ---- master path ----

cte(
    "p_rows",
    """
SELECT g.CONS_ID, g.CSQ, g.MNO, g.CNO, g.pos - g.start_pos AS idx, r.units AS v, r.code
FROM (
  SELECT f.CONS_ID, f.CSQ, m.MNO, m.CNO, f.start_pos, unnest(range(f.start_pos, f.last_pos + 1)) AS pos
  FROM fixed_series f JOIN master_latest m USING (CONS_ID, CSQ)) g
LEFT JOIN reading_months r USING (CONS_ID, CSQ, pos)""",
)
list_ctes("p")
cte(
    "p_screened",
    f"""
SELECT x.CONS_ID, x.CSQ, x.CNO, x.MNO, x.MCD, {PROPERTIES}, x.LABEL, defect_range, n, high, readings, codes,
  CASE WHEN different THEN '{C.DIFFERENT_MNO}' WHEN coalesce(n, 0) <= 5 THEN '{C.LESS_CONSUMPTION}'
    WHEN defect_range = 1 THEN '{C.DEFECT_RANGE}' WHEN NOT coalesce(high > 1, false) THEN 'silent'
    WHEN NOT coalesce(x.MCD IN ({SUPPORTED}), false) THEN '{C.UNSUPPORTED_MCD}' END AS REMARKS
FROM (
  SELECT x.*, {PROPERTIES}, coalesce(x.MNO <> l.MNO, true) AS different, {flag_sql(DEFECT)} AS defect_range
  FROM master_latest x JOIN reading_latest l USING (CONS_ID, CSQ) LEFT JOIN models o ON o.MCD = x.MCD) x
LEFT JOIN p_lists USING ({KEYS}) LEFT JOIN p_code_lists USING ({KEYS})""",
)


def master_path(t: Tables) -> raw.Screened:
    summary = raw.summarise_consumption(S.consumption(t))
    return raw.screen_master_path(S.master(t), summary, *S.lookups(t))


def stored_master_path(t: Tables) -> raw.Screened:
    """The same with the summary as the job stores it: kept and rejected rows from one scan."""
    path = fresh_dir(t.spark, "summary")
    raw.summarise_consumption(S.consumption(t)).write.parquet(path)
    return raw.screen_master_path(S.master(t), t.spark.read.parquet(path), *S.lookups(t))


@query(
    "monthly_state",
    "SELECT CONS_ID, CSQ, CAST(pos AS INTEGER) AS pos, units, code FROM reading_months WHERE pos IS NOT NULL",
)
def monthly_state(t: Tables) -> DataFrame:
    """The readings merged into a stored state in two batches; the second repeats a third of all orders."""
    readings, state = S.consumption(t), fresh_dir(t.spark, "state")
    last = readings.agg(F.max(C.ROW_ORDER)).first()[0] or 0
    increments.add_batch(t.spark, readings.where(F.col(C.ROW_ORDER) * 3 <= 2 * last), state, "1")
    increments.add_batch(t.spark, readings.where(F.col(C.ROW_ORDER) * 3 > last), state, "2")
    entries = increments.summary(t.spark, state).select(*C.KEYS, F.explode("entries").alias("e"))
    return entries.select(*C.KEYS, "e.pos", "e.units", "e.code")


def _text(items: str, kind: str) -> Column:
    shown = F.transform(items, lambda x: F.coalesce(x.cast(kind).cast("string"), F.lit("-")))
    return F.array_join(shown, ",")


def _flat(kept: DataFrame) -> DataFrame:
    return kept.withColumns(
        {"readings": _text("adv_ut_list", "bigint"), "codes": _text("ent_cd_list", "string")}
    ).drop("adv_ut_list", "ent_cd_list")


KEPT = f"CONS_ID, CSQ, CNO, MNO, MCD, {PROPERTIES}, readings, codes, defect_range, LABEL"


@query("master_path_kept", f"SELECT {KEPT} FROM p_screened WHERE REMARKS IS NULL")
def master_path_kept(t: Tables) -> DataFrame:
    return _flat(master_path(t).kept())


LATE = f"""SELECT CONS_ID, CSQ, CASE WHEN REMARKS <> '{C.DIFFERENT_MNO}' THEN CNO END AS CNO,
  CASE WHEN REMARKS <> '{C.DIFFERENT_MNO}' THEN MNO END AS MNO, REMARKS
FROM p_screened WHERE REMARKS IS NOT NULL AND REMARKS <> 'silent'"""


@query(
    "master_path_rejects",
    f"""{LATE} UNION ALL BY NAME {NO_CONSUMPTION}
UNION ALL BY NAME {MISSING_FDT} AND (CONS_ID, CSQ) IN (SELECT (CONS_ID, CSQ) FROM consumption)""",
)
def master_path_rejects(t: Tables) -> DataFrame:
    return stored_master_path(t).rejects()


@query(
    "master_path_reported",
    f"""SELECT {KEPT.replace(', LABEL', '')}, CAST(CASE WHEN LABEL = 1 AND remark = 'METER OK' THEN 0
    WHEN LABEL = 0 AND remark = 'METER DEFECTIVE' THEN 1 ELSE LABEL END AS INTEGER) AS LABEL
FROM p_screened JOIN report USING (CONS_ID, CSQ, CNO, MNO)
WHERE REMARKS IS NULL AND remark IS DISTINCT FROM 'DIFFERENT METER AT SITE: METER OK'""",
)
def master_path_reported(t: Tables) -> DataFrame:
    return _flat(raw.apply_report(master_path(t).kept(), S.report(t)))


# ---- history path ----

cte(
    "h_meters",
    """
SELECT l.*, n.CNO FROM life_meters l JOIN (SELECT DISTINCT * FROM life_names) n USING (CONS_ID, CSQ)""",
)
cte(
    "h_rows",
    """
SELECT m.CONS_ID, m.CSQ, m.MNO, m.CNO, r.idx, r.v, r.code
FROM h_meters m JOIN life_rows r USING (user_id, event_type)""",
)
list_ctes("h")
cte(
    "h_screened",
    f"""
SELECT x.CONS_ID, x.CSQ, x.CNO, x.MNO, x.MCD, {PROPERTIES}, defect_range, n, high, readings, codes,
  CAST(CASE WHEN is_current_meter THEN 0 WHEN NOT is_current_meter THEN 1 END AS INTEGER) AS LABEL,
  CASE WHEN coalesce(n, 0) <= 5 THEN '{C.LESS_CONSUMPTION}'
    WHEN NOT coalesce(high > 1, false) OR missing > 0.6 THEN 'silent'
    WHEN defect_range = 1 THEN '{C.DEFECT_RANGE}'
    WHEN NOT coalesce(x.MCD IN ({SUPPORTED}), false) THEN '{C.UNSUPPORTED_MCD}' END AS REMARKS
FROM (
  SELECT x.*, {PROPERTIES}, {flag_sql(DEFECT)} AS defect_range FROM h_meters x LEFT JOIN models o ON o.MCD = x.MCD) x
LEFT JOIN h_lists USING ({KEYS}) LEFT JOIN h_code_lists USING ({KEYS})""",
)


def history_path(t: Tables) -> raw.Screened:
    return raw.screen_history_path(distinct_rows(S.life_names(t)), S.life(t), *S.lookups(t))


@query("history_path_kept", f"SELECT {KEPT} FROM h_screened WHERE REMARKS IS NULL")
def history_path_kept(t: Tables) -> DataFrame:
    return _flat(history_path(t).kept())


@query(
    "history_path_rejects",
    "SELECT CONS_ID, CSQ, CNO, MNO, REMARKS FROM h_screened WHERE REMARKS IS NOT NULL AND REMARKS <> 'silent'",
)
def history_path_rejects(t: Tables) -> DataFrame:
    return history_path(t).rejects()


# ---- combined and model input ----

PRIORITY = {"D_1": 0, "D_2": 3}
cte(
    "combined",
    f"""
SELECT * FROM (
  SELECT {KEPT}, 'D_1' AS SOURCE, 0 AS pri FROM h_screened WHERE REMARKS IS NULL
  UNION ALL SELECT {KEPT}, 'D_2' AS SOURCE, 3 AS pri FROM p_screened WHERE REMARKS IS NULL)
QUALIFY row_number() OVER (PARTITION BY CNO, MNO ORDER BY pri DESC, CONS_ID, CSQ) = 1""",
)


def combined(t: Tables) -> DataFrame:
    kept = {"D_1": history_path(t).kept(), "D_2": master_path(t).kept()}
    return model.combine(kept, PRIORITY)


@query("combine", f"SELECT {KEPT}, SOURCE FROM combined")
def combine(t: Tables) -> DataFrame:
    return _flat(combined(t))


def combined_path(t: Tables) -> str:
    return sinks.write_combined(combined(t), fresh_dir(t.spark, "combined"), ["D_1", "D_2"])


def stored_combined(t: Tables) -> DataFrame:
    """The combined dataset as the next stage finds it: the fit of the weights reads it again."""
    return readers.read_combined(t.spark, combined_path(t))


for _kind in ("tail", "codes"):
    _value = {"tail": "v", "codes": "code"}[_kind]
    cte(
        f"x_{_kind}",
        f"""
SELECT c.CNO, c.MNO, t.idx, t.n, {'coalesce(t.v, 0) AS v, t.v AS raw_v' if _kind == 'tail' else 't.code'}
FROM combined c JOIN (
  SELECT 'D_1' AS SOURCE, * FROM h_{_kind} UNION ALL SELECT 'D_2' AS SOURCE, * FROM p_{_kind}) t
USING (SOURCE, {KEYS})""",
    )
residual_ctes("x", "x_tail", keys="CNO, MNO")
residual_ctes("x1", "x_tail", extend=False, keys="CNO, MNO")
cte(
    "x_facts",
    """
SELECT CNO, MNO, max(n) AS n, avg(v) AS mean, stddev_pop(v) AS std, max(v) AS high, min(v) AS least_v, max(abs(v)) AS scale,
  count(*) FILTER (v = 0) AS zeros, coalesce(min(v) FILTER (v > 0), 0) AS low,
  coalesce(min(v) FILTER (v <> 0), 0) AS low_v1,
  max(v) FILTER (idx = n - 1) AS last_v, sum(v) FILTER (idx BETWEEN n - 7 AND n - 2) / 6 AS prior,
  max(raw_v) FILTER (idx = n - 1) AS last_raw,
  CASE WHEN count(raw_v) FILTER (idx BETWEEN n - 7 AND n - 2) = 6 THEN
    sum(raw_v) FILTER (idx BETWEEN n - 7 AND n - 2) / 6 END AS prior_raw
FROM x_tail GROUP BY CNO, MNO""",
)
cte(
    "x_z",
    """
SELECT CNO, MNO, idx, n, CASE WHEN std < 1e-8 THEN 0 ELSE (v - mean) / std END AS z,
  CASE WHEN high <> least_v THEN (v - mean) / std END AS z1
FROM (SELECT CNO, MNO, idx, v FROM x_tail) JOIN x_facts USING (CNO, MNO)""",
)
cte(
    "x_scores",
    "SELECT CNO, MNO, "
    + ", ".join(f"coalesce(max(z) FILTER (idx = n - {i + 1}), 0) AS z_score_{i}" for i in range(6))
    + ", "
    + ", ".join(f"CASE WHEN n > 5 THEN max(z1) FILTER (idx = n - {i + 1}) ELSE 0 END AS z1_{i}" for i in range(6))
    + ", max(abs(z)) AS max_abs_zscore, max(abs(z1)) AS max_abs_z1 FROM x_z GROUP BY CNO, MNO, n",
)
cte(
    "x_code_facts",
    """
SELECT CNO, MNO, max(code) FILTER (idx = n - 1) AS last_code,
  coalesce(bool_or(code = 'SP') FILTER (idx >= n - 3), false) AS sp3,
  coalesce(bool_or(code = 'LW') FILTER (idx >= n - 3), false) AS lw3,
  coalesce(bool_or(code = 'NR') FILTER (idx >= n - 3), false) AS nr3,
  coalesce(bool_or(code = 'NR' AND prev = 'NR'), false) AS nr_twice
FROM (SELECT *, lag(code) OVER (PARTITION BY CNO, MNO ORDER BY idx) AS prev FROM x_codes) GROUP BY CNO, MNO""",
)
BASE = ", ".join(C.BASE_COLUMNS).replace("MCD", "CAST(MCD AS VARCHAR) AS MCD")
cte(
    "x_rules",
    f"""
SELECT c.*, f.* EXCLUDE (CNO, MNO), s.* EXCLUDE (CNO, MNO), r.* EXCLUDE (CNO, MNO),
  {', '.join(f'{flag_sql(text)} AS {name}' for name, text in RULE_SQL.items())}
FROM combined c JOIN x_facts f USING (CNO, MNO) JOIN x_scores s USING (CNO, MNO)
LEFT JOIN x_code_facts k USING (CNO, MNO) LEFT JOIN x_resid_stats r USING (CNO, MNO)""",
)
cte("x_weights", "SELECT *, " + ", ".join(f"{text} AS {name}" for name, text in WEIGHT_SQL.items()) + " FROM x_rules")


def r6(text: str, name: str) -> str:
    return f"round({text}, 6) + 0.0 AS {name}"


Z_SQL = ", ".join(r6(c, c) for c in [*C.Z_COLUMNS, "max_abs_zscore"])
LOG_SQL = ", ".join(
    r6(f"ln(1 + {text})", name)
    for name, text in (
        ("max_consumption", "high"),
        ("min_consumption", "low"),
        ("consumption_range", "high - low"),
    )
)


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: rounded(c) for c in doubles})


@query(
    "model_input",
    f"""SELECT {BASE}, {Z_SQL}, {r6(residual_sql('<= 3'), 'max_residual_zscore')}, {LOG_SQL},
  {', '.join(rules.LIVE_RULES)}, {', '.join(r6(c, c) for c in C.WEIGHT_COLUMNS)},
  {fitted_sql(C.WEIGHT_COLUMNS, 'x_weights')} FROM x_weights""",
)
def model_input(t: Tables) -> DataFrame:
    return _rounded(model.model_input(stored_combined(t)))


@query(
    "model_input_encoded",
    "SELECT CNO, MNO, CAST(dense_rank() OVER (ORDER BY ELC NULLS LAST) - 1 AS INTEGER) AS ELC FROM combined",
)
def model_input_encoded(t: Tables) -> DataFrame:
    return model.encode_elc(model.model_input(stored_combined(t))).select("CNO", "MNO", "ELC")


V1_Z = ", ".join([*(r6(f"z1_{i}", f"z_score_{i}") for i in range(6)), r6("max_abs_z1", "max_abs_zscore")])
V1_LOG = LOG_SQL.replace("low", "low_v1")
V1_RULES = {
    name: text.replace("last_v", "last_raw").replace("serial", "TRY_CAST(MNO AS BIGINT)")
    for name, text in RAW_RULE_SQL.items()
}
V1_SCORE = " + ".join(f"{weight} * ({flag_sql(V1_RULES[name])})" for name, weight in C.SCORE_WEIGHTS.items())


@query(
    "model_input_v1",
    f"""SELECT {BASE}, {flag_sql('nr_twice')} AS "has_consecutive_NR_in_ENT_CD",
  CAST({V1_SCORE} AS INTEGER) AS computed_score, {V1_Z},
  {r6(residual_sql('< 3', '0'), 'max_residual_zscore')}, {V1_LOG}
FROM combined JOIN x_facts USING (CNO, MNO) JOIN x_scores USING (CNO, MNO)
LEFT JOIN x_code_facts USING (CNO, MNO) LEFT JOIN x1_resid_stats USING (CNO, MNO)""",
)
def model_input_v1(t: Tables) -> DataFrame:
    return _rounded(model.model_input_v1(stored_combined(t)))
