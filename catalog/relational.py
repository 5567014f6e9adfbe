"""Projections, screens, joins, aggregations, latest rows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import Tables, cte, query, rounded
from wattline import constants as C
from wattline.functions import dates, labels, lists, stats
from wattline.operators import combine, features, lookup, ranking, rows, screens, series
from wattline.plans import raw

KEY = "CONS_ID, CSQ"

# ---- projections and derived columns ----


@query("project", "SELECT CONS_ID, CSQ, CNO, MNO AS METER, MCD FROM master")
def project(t: Tables) -> DataFrame:
    return (
        S.master(t)
        .drop("FDT", "XCHG", "ADV", C.ROW_ORDER)
        .withColumnRenamed("MNO", "METER")
        .select("CONS_ID", "CSQ", "CNO", "METER", "MCD")
    )


@query(
    "label_from_flags",
    """SELECT CONS_ID, XCHG, ADV,
  CAST(CASE WHEN XCHG = 'Y' OR ADV = 'Y' THEN 1 ELSE 0 END AS INTEGER) AS LABEL FROM master""",
)
def label_from_flags(t: Tables) -> DataFrame:
    return S.master(t).select("CONS_ID", "XCHG", "ADV", F.expr(labels.label_from_flags("XCHG", "ADV")).alias("LABEL"))


@query(
    "label_from_current_meter",
    """SELECT CONS_ID, MNO,
  CAST(CASE WHEN is_current_meter THEN 0 WHEN NOT is_current_meter THEN 1 END AS INTEGER) AS LABEL FROM life_meters""",
)
def label_from_current_meter(t: Tables) -> DataFrame:
    return S.life(t).select(
        "CONS_ID", "MNO", F.expr(labels.label_from_current_meter("is_current_meter")).alias("LABEL")
    )


RELABEL = """CAST(CASE WHEN LABEL = 1 AND remark = 'METER OK' THEN 0
    WHEN LABEL = 0 AND remark = 'METER DEFECTIVE' THEN 1 ELSE LABEL END AS INTEGER)"""


@query(
    "relabel_from_remark",
    f"""SELECT CONS_ID, CNO, MNO, {RELABEL} AS LABEL FROM master_latest
JOIN report USING (CONS_ID, CSQ, CNO, MNO)
WHERE remark IS DISTINCT FROM 'DIFFERENT METER AT SITE: METER OK'""",
)
def relabel_from_remark(t: Tables) -> DataFrame:
    latest = _latest_master(t)
    return combine.relabel_on_report(latest, S.report(t)).select("CONS_ID", "CNO", "MNO", "LABEL")


@query("composite_key", "SELECT MCD, MFG || '|' || AMP || '|' || VLT AS make_key FROM models")
def composite_key(t: Tables) -> DataFrame:
    return S.models(t).select("MCD", F.expr(labels.composite_key("MFG", "AMP", "VLT")).alias("make_key"))


@query("mno_to_int", "SELECT CONS_ID, MNO, TRY_CAST(MNO AS BIGINT) AS serial FROM master")
def mno_to_int(t: Tables) -> DataFrame:
    return S.master(t).select("CONS_ID", "MNO", F.expr(labels.serial_number("MNO")).alias("serial"))


@query("log1p_scale", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) + 0.0 AS scaled FROM orders")
def log1p_scale(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", rounded(stats.log1p_scale("o_totalprice")).alias("scaled"))


# ---- screens ----


def _latest_master(t: Tables) -> DataFrame:
    return rows.latest_master(raw.prepare_master(S.master(t)).where(F.col("FDT").isNotNull()))


def _latest_reading(t: Tables) -> DataFrame:
    return rows.latest_consumption(raw.read_months(S.consumption(t)), month="pos")


NAMED = "CONS_ID, CSQ, CNO, MNO"
NO_CONSUMPTION = f"""SELECT {NAMED}, '{C.NO_CONSUMPTION}' AS REMARKS FROM master
WHERE (CONS_ID, CSQ) NOT IN (SELECT (CONS_ID, CSQ) FROM consumption)"""
MISSING_FDT = f"""SELECT {NAMED}, '{C.MISSING_FDT}' AS REMARKS FROM master_rows WHERE FDT IS NULL"""


@query("screen_no_consumption", NO_CONSUMPTION)
def screen_no_consumption(t: Tables) -> DataFrame:
    return screens.screen_no_consumption(S.master(t), S.consumption(t)).select(*C.REJECT_COLUMNS)


@query("screen_missing_fdt", MISSING_FDT)
def screen_missing_fdt(t: Tables) -> DataFrame:
    return screens.screen_missing_fdt(raw.prepare_master(S.master(t))).select(*C.REJECT_COLUMNS)


cte(
    "different_keys",
    f"""
SELECT m.CONS_ID, m.CSQ FROM master_latest m JOIN reading_latest r USING ({KEY})
WHERE coalesce(m.MNO <> r.MNO, true)""",
)


@query("screen_different_mno", f"SELECT {KEY}, '{C.DIFFERENT_MNO}' AS REMARKS FROM different_keys")
def screen_different_mno(t: Tables) -> DataFrame:
    return screens.screen_different_mno(_latest_master(t), _latest_reading(t))


@query(
    "screen_short_series",
    f"SELECT k, '{C.LESS_CONSUMPTION}' AS REMARKS FROM c_rows GROUP BY k HAVING count(*) <= 5",
)
def screen_short_series(t: Tables) -> DataFrame:
    short = S.c_series(t).where(screens.is_short_series("adv_ut_list"))
    return screens.rejected(short.select("k"), C.LESS_CONSUMPTION)


IN_RANGE = """EXISTS (SELECT 1 FROM ranges r WHERE r.MFG = m.MFG AND r.AMP = m.AMP AND r.VLT = m.VLT
    AND TRY_CAST(x.MNO AS BIGINT) BETWEEN r.start_serial AND r.end_serial)"""


@query(
    "screen_defect_range",
    f"""SELECT {NAMED}, '{C.DEFECT_RANGE}' AS REMARKS FROM master x LEFT JOIN models m USING (MCD)
WHERE {IN_RANGE}""",
)
def screen_defect_range(t: Tables) -> DataFrame:
    models, ranges = S.lookups(t)
    flagged = lookup.range_defect_lookup(lookup.join_mcd_key(S.master(t), models), ranges).where("defect_range = 1")
    return screens.rejected(flagged, C.DEFECT_RANGE).select(*C.REJECT_COLUMNS)


SUPPORTED = ", ".join(map(str, C.SUPPORTED_MCD))


@query(
    "screen_unsupported_mcd",
    f"""SELECT {NAMED}, '{C.UNSUPPORTED_MCD}' AS REMARKS FROM master
WHERE NOT coalesce(MCD IN ({SUPPORTED}), false)""",
)
def screen_unsupported_mcd(t: Tables) -> DataFrame:
    unsupported = S.master(t).where(f"NOT {labels.is_supported_model('MCD')}")
    return screens.rejected(unsupported, C.UNSUPPORTED_MCD).select(*C.REJECT_COLUMNS)


@query(
    "drop_low_max",
    """SELECT k, CAST(max(pos) - min(pos) + 1 AS INTEGER) AS n, max(units) AS max_value FROM (
  SELECT l_orderkey AS k, year(l_shipdate) * 12 + month(l_shipdate) - 1 AS pos,
    CAST(sum(CAST(l_discount * 10 AS DECIMAL(18, 2))) AS DOUBLE) AS units
  FROM lineitem GROUP BY ALL)
GROUP BY k HAVING max(units) > 1""",
)
def drop_low_max(t: Tables) -> DataFrame:
    discounts = t.lineitem.select(
        F.col("l_orderkey").alias("k"),
        F.expr(dates.month_position("l_shipdate")).alias("pos"),
        (F.col("l_discount") * 10).cast("decimal(18,2)").alias("v"),
    )
    lists_of = series.build_series(series.agg_month_sum(discounts, "v", S.K), S.K)
    return lists_of.where(f"NOT ({screens.is_low_max('adv_ut_list')})").select(
        "k", F.size("adv_ut_list").alias("n"), F.array_max("adv_ut_list").alias("max_value")
    )


@query(
    "drop_sparse",
    """SELECT k, CAST(count(*) AS INTEGER) AS n FROM c_rows GROUP BY k
HAVING NOT count(*) FILTER (v IS NULL) / count(*) > 0.6""",
)
def drop_sparse(t: Tables) -> DataFrame:
    kept = S.c_series(t).where(f"NOT {screens.is_sparse('adv_ut_list')}")
    return kept.select("k", F.size("adv_ut_list").alias("n"))


@query(
    "drop_other_meter_remark",
    """SELECT CONS_ID, MNO, remark FROM report
WHERE remark IS DISTINCT FROM 'DIFFERENT METER AT SITE: METER OK'""",
)
def drop_other_meter_remark(t: Tables) -> DataFrame:
    return combine.drop_other_meter_remark(S.report(t)).select(
        "CONS_ID", "MNO", F.col("`TD REMARKS`").alias("remark")
    )


@query(
    "collect_rejects",
    f"""{NO_CONSUMPTION} UNION ALL BY NAME {MISSING_FDT}
UNION ALL BY NAME SELECT {KEY}, '{C.DIFFERENT_MNO}' AS REMARKS FROM different_keys""",
)
def collect_rejects(t: Tables) -> DataFrame:
    return screens.collect_rejects([screen_no_consumption(t), screen_missing_fdt(t), screen_different_mno(t)])


# ---- joins ----


@query(
    "join_common_keys",
    f"""SELECT {KEY}, MNO, BC_CD, row_order FROM consumption
WHERE (CONS_ID, CSQ) IN (SELECT (CONS_ID, CSQ) FROM master)""",
)
def join_common_keys(t: Tables) -> DataFrame:
    common = rows.with_common_keys(S.consumption(t), S.master(t))
    return common.select(*C.KEYS, "MNO", "BC_CD", C.ROW_ORDER)


@query(
    "join_missing_keys",
    f"""SELECT {KEY}, MNO, row_order FROM consumption
WHERE (CONS_ID, CSQ) NOT IN (SELECT (CONS_ID, CSQ) FROM master)""",
)
def join_missing_keys(t: Tables) -> DataFrame:
    return rows.with_missing_keys(S.consumption(t), S.master(t)).select(*C.KEYS, "MNO", C.ROW_ORDER)


@query(
    "join_latest_compare",
    f"""SELECT {KEY}, m.MNO AS MNO_m, r.MNO AS MNO_c FROM master_latest m JOIN reading_latest r USING ({KEY})""",
)
def join_latest_compare(t: Tables) -> DataFrame:
    return rows.compare_latest(_latest_master(t), _latest_reading(t))


@query(
    "join_exclude_keys",
    f"""SELECT {KEY}, BC_CD, ADV_UT, row_order FROM readings
WHERE (CONS_ID, CSQ) NOT IN (SELECT (CONS_ID, CSQ) FROM different_keys)""",
)
def join_exclude_keys(t: Tables) -> DataFrame:
    kept = screens.exclude_keys(raw.read_months(S.consumption(t)), screen_different_mno(t))
    return kept.select(*C.KEYS, "BC_CD", "ADV_UT", C.ROW_ORDER)


@query(
    "join_span",
    f"""SELECT m.CONS_ID, m.CSQ, m.MNO, s.min_month, s.max_month FROM master m LEFT JOIN (
  SELECT {KEY}, min(pos) AS min_month, max(pos) AS max_month FROM readings GROUP BY {KEY}) s USING ({KEY})""",
)
def join_span(t: Tables) -> DataFrame:
    span = series.agg_month_span(raw.read_months(S.consumption(t)), "pos")
    return S.master(t).join(span, C.KEYS, "left").select(*C.KEYS, "MNO", "min_month", "max_month")


@query(
    "join_series",
    f"""SELECT m.CONS_ID, m.CSQ, m.MNO, CAST(coalesce(s.n, 0) AS INTEGER) AS n,
  round(coalesce(s.total, 0), 2) + 0.0 AS total
FROM master_latest m LEFT JOIN (
  SELECT {KEY}, max(pos) - min(pos) + 1 AS n, sum(units) AS total FROM reading_months GROUP BY {KEY}) s USING ({KEY})""",
)
def join_series(t: Tables) -> DataFrame:
    months = series.agg_month_sum(raw.placed_months(S.consumption(t)), "ADV_UT", raw.PLACE_KEYS)
    found = series.build_series(months)
    readings = F.coalesce("adv_ut_list", F.array().cast("array<double>"))
    joined = _latest_master(t).join(found, C.KEYS, "left").withColumn("adv_ut_list", readings)
    return joined.select(
        *C.KEYS,
        "MNO",
        F.size("adv_ut_list").alias("n"),
        rounded(stats.total(lists.fill_zero("adv_ut_list")), 2).alias("total"),
    )


@query(
    "join_report",
    "SELECT CONS_ID, CNO, MNO, LABEL, remark FROM master_rows JOIN report USING (CONS_ID, CSQ, CNO, MNO)",
)
def join_report(t: Tables) -> DataFrame:
    joined = combine.join_report(raw.prepare_master(S.master(t)), S.report(t))
    return joined.select("CONS_ID", "CNO", "MNO", "LABEL", F.col("`TD REMARKS`").alias("remark"))


@query(
    "join_history",
    "SELECT l.CONS_ID, l.CSQ, l.MNO, l.MCD, n.CNO FROM life_meters l JOIN life_names n USING (CONS_ID, CSQ)",
)
def join_history(t: Tables) -> DataFrame:
    joined = combine.join_history(S.life(t), rows.distinct_rows(S.life_names(t)))
    return joined.select(*C.KEYS, "MNO", "MCD", "CNO")


def _line_meters(t: Tables) -> DataFrame:
    """A meter per line: its model is the part, its serial follows from order and line."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") + 400).cast("int").alias("MCD"),
        (F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 977, F.lit(600000)) + 2800000)
        .cast("string")
        .alias("MNO"),
    )


cte(
    "line_meters",
    """
SELECT l_orderkey, l_linenumber, CAST(l_partkey + 400 AS INTEGER) AS MCD,
  CAST((l_orderkey * 31 + l_linenumber * 977) % 600000 + 2800000 AS VARCHAR) AS MNO FROM lineitem""",
)


@query(
    "join_mcd_properties",
    """SELECT l_orderkey, l_linenumber, MCD, MFG, AMP, VLT, SUP, SMT, ELC
FROM line_meters LEFT JOIN models USING (MCD)""",
)
def join_mcd_properties(t: Tables) -> DataFrame:
    return lookup.join_mcd_properties(_line_meters(t), S.lookups(t)[0]).select(
        "l_orderkey", "l_linenumber", "MCD", *C.MODEL_PROPERTIES
    )


@query(
    "join_mcd_key",
    "SELECT CONS_ID, CSQ, MNO, MCD, MFG, AMP, VLT FROM master LEFT JOIN models USING (MCD)",
)
def join_mcd_key(t: Tables) -> DataFrame:
    return lookup.join_mcd_key(S.master(t), S.lookups(t)[0]).select(*C.KEYS, "MNO", "MCD", *lookup.MAKE)


@query(
    "range_defect_lookup",
    f"""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN {IN_RANGE} THEN 1 ELSE 0 END AS INTEGER) AS defect_range
FROM line_meters x LEFT JOIN models m USING (MCD)""",
)
def range_defect_lookup(t: Tables) -> DataFrame:
    models, ranges = S.lookups(t)
    known = lookup.join_mcd_key(_line_meters(t), models)
    return lookup.range_defect_lookup(known, ranges).select("l_orderkey", "l_linenumber", "defect_range")


# ---- aggregations ----


@query(
    "agg_month_span",
    f"SELECT {KEY}, min(pos) AS min_month, max(pos) AS max_month FROM readings GROUP BY {KEY}",
)
def agg_month_span(t: Tables) -> DataFrame:
    return series.agg_month_span(raw.read_months(S.consumption(t)), "pos")


@query("agg_month_sum", f"SELECT {KEY}, pos, units FROM reading_months")
def agg_month_sum(t: Tables) -> DataFrame:
    return series.agg_month_sum(raw.placed_months(S.consumption(t)), "ADV_UT", raw.PLACE_KEYS).drop(raw.PLACE)


@query("agg_month_first_code", f"SELECT {KEY}, pos, code FROM reading_months")
def agg_month_first_code(t: Tables) -> DataFrame:
    months = raw.placed_months(S.consumption(t))
    return series.agg_month_first_code(months, "ENT_CD", C.ROW_ORDER, raw.PLACE_KEYS).drop(raw.PLACE)


@query("agg_global_range", "SELECT min(first_pos) AS first_pos, max(last_pos) AS last_pos FROM c_span")
def agg_global_range(t: Tables) -> DataFrame:
    return series.agg_global_range(S.c_series(t), "first_pos", "last_pos")


_MONTHS = ", ".join(
    f"sum(l_quantity) FILTER (month(l_shipdate) = {m}) AS m{m:02d}"
    for m in range(1, 13)
)


@query(
    "pivot_months",
    f"""SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, {_MONTHS}
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)""",
)
def pivot_months(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_suppkey", "l_shipdate", F.col("l_quantity").alias("v"))
    return series.pivot_months(lines, "v", "l_shipdate", ["l_suppkey"])


@query(
    "agg_mean_std",
    """SELECT round(avg(units), 6) + 0.0 AS units_mean, round(stddev_pop(units), 6) + 0.0 AS units_std
FROM m_months""",
)
def agg_mean_std(t: Tables) -> DataFrame:
    months = series.agg_month_sum(S.m_rows(t), "v", S.K)
    return features.agg_mean_std(months, ["units"]).select(
        rounded("units_mean").alias("units_mean"), rounded("units_std").alias("units_std")
    )


@query("agg_value_counts", "SELECT quality AS LABEL, count(*) AS n FROM labels GROUP BY quality")
def agg_value_counts(t: Tables) -> DataFrame:
    return ranking.agg_value_counts(t.labels.withColumnRenamed("quality", "LABEL"), "LABEL")


CLASS_WEIGHT = """SELECT quality, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS class_weight
FROM labels WHERE quality IS NOT NULL GROUP BY quality"""


@query("agg_class_weight", CLASS_WEIGHT)
def agg_class_weight(t: Tables) -> DataFrame:
    return ranking.agg_class_weight(t.labels, "quality").withColumn("class_weight", rounded("class_weight"))


@query(
    "agg_series_stats",
    """SELECT k, max(v) AS high, coalesce(min(v) FILTER (v > 0), 0) AS low,
  max(v) - coalesce(min(v) FILTER (v > 0), 0) AS span FROM m_tail GROUP BY k""",
)
def agg_series_stats(t: Tables) -> DataFrame:
    filled = S.m_series(t).withColumn("a", F.expr(lists.fill_zero(lists.tail("adv_ut_list"))))
    found = features.range_features("a", stats.positive_min("a"))
    return filled.selectExpr("k", *found.values()).toDF("k", "high", "low", "span")


# ---- latest rows and ties ----


@query("latest_master", "SELECT CONS_ID, CSQ, CNO, MNO, MCD, FDT, LABEL FROM master_latest")
def latest_master(t: Tables) -> DataFrame:
    return _latest_master(t).select(*C.KEYS, "CNO", "MNO", "MCD", "FDT", "LABEL")


@query("latest_consumption", f"SELECT {KEY}, MNO, pos, ENT_CD, ADV_UT FROM reading_latest")
def latest_consumption(t: Tables) -> DataFrame:
    return _latest_reading(t).select(*C.KEYS, "MNO", "pos", "ENT_CD", "ADV_UT")


@query(
    "top1_per_group",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def top1_per_group(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return rows.top1_per_group(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


PRIORITY = {"D_1": 0, "D_5": 1, "D_2": 3}


def datasets(t: Tables) -> dict[str, DataFrame]:
    """Four datasets whose meters overlap; D_9 has no priority and sometimes no meter number."""
    return {
        "D_1": t.orders.select(
            F.col("o_orderkey").cast("string").alias("CONS_ID"),
            F.lit("1").alias("CSQ"),
            F.col("o_custkey").cast("string").alias("CNO"),
            F.month("o_orderdate").cast("string").alias("MNO"),
            "o_totalprice",
        ),
        "D_5": t.lineitem.select(
            F.col("l_orderkey").cast("string").alias("CONS_ID"),
            F.expr("l_linenumber || '-' || l_partkey AS CSQ"),
            F.col("l_suppkey").cast("string").alias("CNO"),
            F.month("l_shipdate").cast("string").alias("MNO"),
        ),
        "D_2": t.supplier.select(
            F.col("s_name").alias("CONS_ID"),
            F.lit("1").alias("CSQ"),
            F.col("s_suppkey").cast("string").alias("CNO"),
            F.col("s_nationkey").cast("string").alias("MNO"),
        ),
        "D_9": t.customer.select(
            F.col("c_name").alias("CONS_ID"),
            F.lit("1").alias("CSQ"),
            F.when(F.col("c_nationkey") < 20, F.col("c_custkey").cast("string")).alias("CNO"),
            F.when(F.col("c_nationkey") < 15, F.col("c_nationkey").cast("string")).alias("MNO"),
        ),
    }


cte(
    "stacked",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS CONS_ID, '1' AS CSQ, CAST(o_custkey AS VARCHAR) AS CNO,
  CAST(month(o_orderdate) AS VARCHAR) AS MNO, o_totalprice, 'D_1' AS SOURCE, 0 AS pri, 0 AS place FROM orders
UNION ALL BY NAME
SELECT CAST(l_orderkey AS VARCHAR) AS CONS_ID,
  l_linenumber || '-' || l_partkey AS CSQ,
  CAST(l_suppkey AS VARCHAR) AS CNO, CAST(month(l_shipdate) AS VARCHAR) AS MNO, 'D_5' AS SOURCE, 1 AS pri, 1 AS place FROM lineitem
UNION ALL BY NAME
SELECT s_name AS CONS_ID, '1' AS CSQ, CAST(s_suppkey AS VARCHAR) AS CNO, CAST(s_nationkey AS VARCHAR) AS MNO,
  'D_2' AS SOURCE, 3 AS pri, 2 AS place FROM supplier
UNION ALL BY NAME
SELECT c_name AS CONS_ID, '1' AS CSQ, CASE WHEN c_nationkey < 20 THEN CAST(c_custkey AS VARCHAR) END AS CNO,
  CASE WHEN c_nationkey < 15 THEN CAST(c_nationkey AS VARCHAR) END AS MNO,
  'D_9' AS SOURCE, NULL AS pri, 3 AS place FROM customer""",
)
cte(
    "best_rows",
    """
SELECT * EXCLUDE (pri, place) FROM stacked
QUALIFY row_number() OVER (PARTITION BY CNO, MNO ORDER BY pri DESC NULLS LAST, place, CONS_ID, CSQ) = 1""",
)


@query("dedup_priority", "SELECT * FROM best_rows")
def dedup_priority(t: Tables) -> DataFrame:
    tables = datasets(t)
    return combine.dedup_priority(combine.union_sources(tables), list(tables), PRIORITY)


@query("union_sources", "SELECT * EXCLUDE (pri, place) FROM stacked")
def union_sources(t: Tables) -> DataFrame:
    return combine.union_sources(datasets(t))


@query(
    "union_dedup_parts",
    """SELECT SOURCE, count(*) AS n FROM best_rows GROUP BY SOURCE""",
)
def union_dedup_parts(t: Tables) -> DataFrame:
    """What each source contributes: its unique meters and the duplicates it wins."""
    return ranking.agg_value_counts(dedup_priority(t), "SOURCE")


# ---- set operations and order ----


def _users(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("c_custkey"))


@query("keys_intersect", "SELECT c_custkey FROM customer INTERSECT SELECT user_id FROM events")
def keys_intersect(t: Tables) -> DataFrame:
    return rows.keys_intersect(t.customer, _users(t), ["c_custkey"])


@query("keys_except", "SELECT c_custkey FROM customer EXCEPT SELECT user_id FROM events")
def keys_except(t: Tables) -> DataFrame:
    return rows.keys_except(t.customer, _users(t), ["c_custkey"])


@query(
    "distinct_rows",
    "SELECT DISTINCT CONS_ID, CSQ, CNO, MNO, MCD, FDT, XCHG, ADV FROM master",
)
def distinct_rows(t: Tables) -> DataFrame:
    return rows.distinct_rows(S.master(t).drop(C.ROW_ORDER))


@query(
    "union_pred_rejects",
    f"""SELECT {NAMED}, round(1 / (1 + exp(-MCD / 1000.0)), 6) AS PREDICTION_SCORE, NULL AS REMARKS FROM master_latest
UNION ALL BY NAME {MISSING_FDT}""",
)
def union_pred_rejects(t: Tables) -> DataFrame:
    score = rounded("1D / (1D + exp(-MCD / 1000D))")
    scored = _latest_master(t).select(*C.REJECT_COLUMNS[:4], score.alias("PREDICTION_SCORE"))
    return combine.union_pred_rejects(scored, screen_missing_fdt(t))


@query(
    "sort_keys",
    f"SELECT {KEY}, MNO, BC_CD FROM consumption ORDER BY CONS_ID, CSQ, BC_CD, MNO",
)
def sort_keys(t: Tables) -> DataFrame:
    """Ordered output; Spark sorts by ranges, so no task gets it all."""
    return S.consumption(t).select(*C.KEYS, "MNO", "BC_CD").orderBy(*C.KEYS, "BC_CD", "MNO")
