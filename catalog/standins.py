"""The given tables in the parts of meter tables, each with its SQL twin.

- master: customers (and suppliers, who never have readings); some rows older or repeated
- consumption: orders as monthly readings (and events, whose users have no master row)
- life: a list of daily readings per user and event type
- models and ranges: parts; report: customers
- M: lineitem by supplier and month, dense; C: orders by customer and month, sparse;
  E: events by user and day, with codes
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables, cte
from wattline import constants as C
from wattline.functions import dates
from wattline.operators import lookup, series
from wattline.session import fresh_dir

K = ["k"]

# Event type or order priority to exception code.
EVENT_CODES = {"error": "NR", "signup": "SP", "view": "LW", "click": "OK"}
PRIORITY_CODES = {"1-URGENT": "NR", "2-HIGH": "SP", "3-MEDIUM": "LW", "5-LOW": "Read"}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
REPORT_REMARKS = {
    "BUILDING": C.REMARK_OK,
    "MACHINERY": C.REMARK_DEFECTIVE,
    "AUTOMOBILE": C.REMARK_OTHER_METER_OK,
    "FURNITURE": "NOT FOUND",
}


def choose(column: str, mapping: dict) -> Column:
    return F.expr(choose_sql(column, mapping))


def choose_sql(column: str, mapping: dict) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


def cents(column: str) -> Column:
    """Whole cents, so that sums do not depend on their order."""
    return F.expr(f"bigint({column} * 100 + 0.5D)")


def text_id(column: str, width: int = 8) -> Column:
    return F.lpad(F.col(column).cast("string"), width, "0")


# ---- consumer master ----

SEGMENT_PREFIX = {"BUILDING": "011", "MACHINERY": "88", "HOUSEHOLD": "77", "FURNITURE": "78", "AUTOMOBILE": "79"}


def _customers(t: Tables) -> DataFrame:
    fixed = F.date_add(F.lit("1994-06-01").cast("date"), F.pmod(F.col("c_custkey") * 37, F.lit(900)).cast("int"))
    day = F.when(F.col("c_acctbal") < -800, F.lit(None)).when(F.col("c_acctbal") < -600, F.lit("99/99/2020"))
    return t.customer.select(
        text_id("c_custkey").alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        F.concat(choose("c_mktsegment", SEGMENT_PREFIX), text_id("c_custkey", 7)).alias("CNO"),
        (F.col("c_custkey") * 11 + 3000000).cast("string").alias("MNO"),
        (F.col("c_nationkey") + 560).alias("MCD"),
        day.otherwise(F.date_format(fixed, "dd/MM/yyyy")).alias("FDT"),
        F.when(F.col("c_acctbal") > 7000, "Y").when(F.col("c_acctbal") > 0, "N").alias("XCHG"),
        F.when(F.col("c_nationkey") < 5, "Y").otherwise("N").alias("ADV"),
        (F.col("c_custkey") * 3).alias(C.ROW_ORDER),
        "c_mktsegment",
    )


def master(t: Tables) -> DataFrame:
    """Customers; car makers' meters were replaced once, furniture rows come twice; suppliers."""
    base = _customers(t)
    segment = F.col("c_mktsegment")
    older = base.where(segment == "AUTOMOBILE").withColumns(
        {
            "MNO": F.concat(F.lit("9"), F.col("MNO")),
            "FDT": F.lit("1/2/1990"),
            C.ROW_ORDER: F.col(C.ROW_ORDER) + 1,
        }
    )
    twice = base.where(segment == "FURNITURE").withColumn(C.ROW_ORDER, F.col(C.ROW_ORDER) + 2)
    suppliers = t.supplier.select(
        F.concat(F.lit("S"), text_id("s_suppkey", 7)).alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        F.concat(F.lit("90"), text_id("s_suppkey", 7)).alias("CNO"),
        F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("MNO"),
        (F.col("s_nationkey") + 560).alias("MCD"),
        F.lit("05/03/1996").alias("FDT"),
        F.lit("N").alias("XCHG"),
        F.lit("N").alias("ADV"),
        (F.lit(-1) - F.col("s_suppkey")).alias(C.ROW_ORDER),
    )
    return base.unionByName(older).unionByName(twice).drop("c_mktsegment").unionByName(suppliers)


cte(
    "customers_in",
    f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CONS_ID, '1' AS CSQ,
  ({choose_sql('c_mktsegment', SEGMENT_PREFIX)}) || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS CNO,
  CAST(c_custkey * 11 + 3000000 AS VARCHAR) AS MNO, c_nationkey + 560 AS MCD,
  CASE WHEN c_acctbal < -800 THEN NULL WHEN c_acctbal < -600 THEN '99/99/2020'
    ELSE strftime(DATE '1994-06-01' + CAST((c_custkey * 37) % 900 AS INTEGER), '%d/%m/%Y') END AS FDT,
  CASE WHEN c_acctbal > 7000 THEN 'Y' WHEN c_acctbal > 0 THEN 'N' END AS XCHG,
  CASE WHEN c_nationkey < 5 THEN 'Y' ELSE 'N' END AS ADV,
  c_custkey * 3 AS row_order, c_mktsegment
FROM customer""",
)
cte(
    "master",
    """
SELECT * EXCLUDE (c_mktsegment) FROM customers_in
UNION ALL BY NAME
SELECT * EXCLUDE (c_mktsegment) REPLACE ('9' || MNO AS MNO, '1/2/1990' AS FDT, row_order + 1 AS row_order)
FROM customers_in WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL BY NAME
SELECT * EXCLUDE (c_mktsegment) REPLACE (row_order + 2 AS row_order)
FROM customers_in WHERE c_mktsegment = 'FURNITURE'
UNION ALL BY NAME
SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS CONS_ID, '1' AS CSQ,
  '90' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS CNO, 'A' || s_suppkey AS MNO,
  s_nationkey + 560 AS MCD, '05/03/1996' AS FDT, 'N' AS XCHG, 'N' AS ADV, -1 - s_suppkey AS row_order
FROM supplier""",
)
cte(
    "master_rows",
    """
SELECT CONS_ID, CSQ, CNO, MNO, MCD, CAST(try_strptime(FDT, '%d/%m/%Y') AS DATE) AS FDT, XCHG, ADV,
  CAST(CASE WHEN XCHG = 'Y' OR ADV = 'Y' THEN 1 ELSE 0 END AS INTEGER) AS LABEL, min(row_order) AS row_order
FROM master GROUP BY ALL""",
)
cte(
    "master_latest",
    """
SELECT * FROM master_rows WHERE FDT IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY CONS_ID, CSQ ORDER BY FDT DESC, row_order DESC) = 1""",
)

# ---- readings ----


def consumption(t: Tables) -> DataFrame:
    """Orders as readings: some without units, some with a month that does not exist."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    no_month = (status == "F") & (priority == "4-NOT SPECIFIED") & (F.col("o_totalprice") < 30000)
    other = (status == "P") & (priority == "5-LOW")
    orders = t.orders.select(
        text_id("o_custkey").alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        F.when(other, "5").otherwise((F.col("o_custkey") * 11 + 3000000).cast("string")).alias("MNO"),
        F.when(no_month, "199913").otherwise(F.expr("string(year(o_orderdate) * 100 + month(o_orderdate))")).alias("BC_CD"),
        status.alias("BL_CD"),
        choose("o_orderpriority", PRIORITY_CODES).alias("ENT_CD"),
        F.when(~((status == "F") & (priority == "5-LOW")), F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("ADV_UT"),
        F.col("o_orderkey").alias(C.ROW_ORDER),
    )
    users = t.events.select(
        F.concat(F.lit("U"), text_id("user_id", 7)).alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        F.col("user_id").cast("string").alias("MNO"),
        F.expr("string(year(ts) * 100 + month(ts)) AS BC_CD"),
        F.lit(None).cast("string").alias("BL_CD"),
        choose("event_type", EVENT_CODES).alias("ENT_CD"),
        F.floor("value").cast("double").alias("ADV_UT"),
        F.col("event_id").alias(C.ROW_ORDER),
    )
    return orders.unionByName(users)


cte(
    "consumption",
    f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS CONS_ID, '1' AS CSQ,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '5'
    ELSE CAST(o_custkey * 11 + 3000000 AS VARCHAR) END AS MNO,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice < 30000
    THEN '199913' ELSE strftime(o_orderdate, '%Y%m') END AS BC_CD,
  o_orderstatus AS BL_CD, {choose_sql('o_orderpriority', PRIORITY_CODES)} AS ENT_CD,
  CASE WHEN NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') THEN floor(o_totalprice / 1000) END AS ADV_UT,
  o_orderkey AS row_order
FROM orders
UNION ALL BY NAME
SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS CONS_ID, '1' AS CSQ, CAST(user_id AS VARCHAR) AS MNO,
  strftime(ts, '%Y%m') AS BC_CD, CAST(NULL AS VARCHAR) AS BL_CD, {choose_sql('event_type', EVENT_CODES)} AS ENT_CD,
  floor(value) AS ADV_UT, event_id AS row_order
FROM events""",
)
cte(
    "readings",
    """
SELECT CONS_ID, CSQ, MNO, BC_CD, BL_CD, ENT_CD, ADV_UT, min(row_order) AS row_order,
  CAST(year(try_strptime(BC_CD, '%Y%m')) * 12 + month(try_strptime(BC_CD, '%Y%m')) - 1 AS INTEGER) AS pos
FROM consumption GROUP BY CONS_ID, CSQ, MNO, BC_CD, BL_CD, ENT_CD, ADV_UT""",
)
cte(
    "reading_months",
    """
SELECT CONS_ID, CSQ, pos, coalesce(sum(ADV_UT), 0.0) AS units,
  arg_min(ENT_CD, row_order) FILTER (ENT_CD IS NOT NULL) AS code
FROM readings WHERE pos IS NOT NULL GROUP BY CONS_ID, CSQ, pos""",
)
cte(
    "reading_latest",
    """
SELECT * FROM readings
QUALIFY row_number() OVER (PARTITION BY CONS_ID, CSQ ORDER BY pos DESC NULLS FIRST, row_order DESC) = 1""",
)

# ---- meter models, ranges, report ----


def models(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.part.select(
        (F.col("p_partkey") + 400).cast("int").alias("MCD"),
        F.col("p_brand").alias("MFG"),
        F.col("p_type").alias("AMP"),
        F.col("p_size").cast("string").alias("VLT"),
        F.when(F.col("p_size") > 25, "Y").otherwise("N").alias("SUP"),
        F.when(F.col("p_name").startswith("red"), "Y").otherwise("N").alias("SMT"),
        F.when(price * 10 - F.floor(price) * 10 < 5, "N").otherwise("Y").alias("ELC"),
    )


cte(
    "models",
    """
SELECT CAST(p_partkey + 400 AS INTEGER) AS MCD, p_brand AS MFG, p_type AS AMP, CAST(p_size AS VARCHAR) AS VLT,
  CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END AS SUP,
  CASE WHEN p_name LIKE 'red%' THEN 'Y' ELSE 'N' END AS SMT,
  CASE WHEN p_retailprice * 10 - floor(p_retailprice) * 10 < 5 THEN 'N' ELSE 'Y' END AS ELC
FROM part""",
)


def ranges(t: Tables) -> DataFrame:
    """A serial range per part, long enough that some overlap and some cross a block."""
    start = F.col("p_partkey") * 9973 % 400000 + 2900000
    return t.part.select(
        F.col("p_brand").alias("MFG"),
        F.col("p_type").alias("AMP"),
        F.col("p_size").cast("string").alias("VLT"),
        start.alias("start_serial"),
        (start + F.col("p_size") * 2000).alias("end_serial"),
    )


cte(
    "ranges",
    """
SELECT p_brand AS MFG, p_type AS AMP, CAST(p_size AS VARCHAR) AS VLT,
  p_partkey * 9973 % 400000 + 2900000 AS start_serial,
  p_partkey * 9973 % 400000 + 2900000 + p_size * 2000 AS end_serial
FROM part""",
)


def report(t: Tables) -> DataFrame:
    """Inspectors' remarks per customer; furniture makers were visited twice."""
    rows = _customers(t).select(
        "CONS_ID", "CSQ", "CNO", "MNO", choose("c_mktsegment", REPORT_REMARKS).alias("TD REMARKS")
    )
    return rows.unionByName(rows.where(F.col("TD REMARKS") == "NOT FOUND"))


cte(
    "report_once",
    f"""
SELECT CONS_ID, CSQ, CNO, MNO, {choose_sql('c_mktsegment', REPORT_REMARKS)} AS remark FROM customers_in""",
)
cte(
    "report",
    """
SELECT * FROM report_once UNION ALL SELECT * FROM report_once WHERE remark = 'NOT FOUND'""",
)

# ---- meter life ----

LIFE_CODES = {"error": "NR", "signup": "SP", "view": "LW", "click": "OK", "purchase": "LCC"}


def life_names(t: Tables) -> DataFrame:
    """Every customer's row, so names come as often as a master lists them."""
    prefix = F.when(F.col("c_nationkey") < 8, "011").when(F.col("c_nationkey") < 16, "88").otherwise("77")
    return t.customer.select(
        text_id("c_custkey").alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        F.concat(prefix, text_id("c_custkey", 7)).alias("CNO"),
    )


def life(t: Tables) -> DataFrame:
    """Per user and event type: daily readings and codes; a code only on days of high value."""
    kind = F.col("event_type")
    index = choose("event_type", {name: i for i, name in enumerate(EVENT_TYPES)})
    rows = t.events.select(
        text_id("user_id").alias("CONS_ID"),
        F.lit("1").alias("CSQ"),
        (F.col("user_id") * 523 + index * 300 + 2900000).cast("string").alias("MNO"),
        (F.pmod(F.col("user_id"), F.lit(25)) + 560).cast("int").alias("MCD"),
        F.when(kind != "click", kind != "error").alias("is_current_meter"),
        F.expr(dates.day_position("ts")).alias("pos"),
        F.floor("value").alias("value"),
        F.when(F.col("value") > 30, choose("event_type", LIFE_CODES)).alias("code_in"),
        "event_id",
    )
    keys = ["CONS_ID", "CSQ", "MNO", "MCD", "is_current_meter"]
    days = series.agg_months(rows, "value", "code_in", "event_id", keys)
    return series.build_series(days, keys, with_codes=True).drop("first_pos", "last_pos")


cte(
    "life_names",
    """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CONS_ID, '1' AS CSQ,
  CASE WHEN c_nationkey < 8 THEN '011' WHEN c_nationkey < 16 THEN '88' ELSE '77' END
    || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS CNO
FROM customer""",
)
cte(
    "life_days",
    f"""
SELECT user_id, event_type, CAST(ts AS DATE) - DATE '1970-01-01' AS pos,
  CAST(sum(floor(value)) AS DOUBLE) AS units,
  arg_min({choose_sql('event_type', LIFE_CODES)}, event_id) FILTER (value > 30) AS code
FROM events GROUP BY ALL""",
)
cte(
    "life_rows",
    f"""
SELECT g.*, g.pos - g.first_pos AS idx, d.units AS v, d.code
FROM (
  SELECT user_id, event_type, min(pos) AS first_pos, unnest(range(min(pos), max(pos) + 1)) AS pos
  FROM life_days GROUP BY user_id, event_type
) g LEFT JOIN life_days d USING (user_id, event_type, pos)""",
)
cte(
    "life_meters",
    f"""
SELECT user_id, event_type, lpad(CAST(user_id AS VARCHAR), 8, '0') AS CONS_ID, '1' AS CSQ,
  CAST(user_id * 523 + ({choose_sql('event_type', {n: i for i, n in enumerate(EVENT_TYPES)})}) * 300 + 2900000 AS VARCHAR) AS MNO,
  CAST(user_id % 25 + 560 AS INTEGER) AS MCD,
  CASE WHEN event_type <> 'click' THEN event_type <> 'error' END AS is_current_meter
FROM (SELECT DISTINCT user_id, event_type FROM events)""",
)

# ---- plain series ----


def m_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("k"),
        F.expr(dates.month_position("l_shipdate")).alias("pos"),
        F.col("l_quantity").alias("v"),
    )


def c_rows(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("k"),
        F.expr(dates.month_position("o_orderdate")).alias("pos"),
        cents("o_totalprice").alias("v"),
    )


def e_rows(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("k"),
        F.expr(dates.day_position("ts")).alias("pos"),
        F.col("value").cast("decimal(18,2)").alias("v"),
        choose("event_type", EVENT_CODES).alias("code_in"),
        "event_id",
    )


def m_series(t: Tables) -> DataFrame:
    return series.build_series(series.agg_month_sum(m_rows(t), "v", K), K)


def c_series(t: Tables) -> DataFrame:
    return series.build_series(series.agg_month_sum(c_rows(t), "v", K), K)


def e_series(t: Tables) -> DataFrame:
    """Daily readings and codes; users with an even key have electromechanical meters."""
    days = series.agg_months(e_rows(t), "v", "code_in", "event_id", K)
    lists = series.build_series(days, K, with_codes=True)
    return lists.withColumns(
        {
            "ELC": F.when(F.col("k") % 2 == 0, "N").otherwise("Y"),
            "MNO": (F.col("k") * 1500 + 6990000).cast("string"),
        }
    )


def _series_ctes(name: str, monthly: str, codes: bool = False) -> None:
    cte(f"{name}_months", monthly)
    cte(f"{name}_span", f"SELECT k, min(pos) AS first_pos, max(pos) AS last_pos FROM {name}_months GROUP BY k")
    code = ", m.code" if codes else ""
    cte(
        f"{name}_rows",
        f"""
SELECT g.k, CAST(g.pos AS INTEGER) AS pos, CAST(g.pos - g.first_pos AS INTEGER) AS idx,
  CAST(g.last_pos - g.first_pos + 1 AS INTEGER) AS n, m.units AS v{code}
FROM (SELECT *, unnest(range(first_pos, last_pos + 1)) AS pos FROM {name}_span) g
LEFT JOIN {name}_months m ON m.k = g.k AND m.pos = g.pos""",
    )


_series_ctes(
    "m",
    """
SELECT l_suppkey AS k, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER) AS pos,
  sum(l_quantity) AS units
FROM lineitem GROUP BY ALL""",
)
_series_ctes(
    "c",
    """
SELECT o_custkey AS k, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS pos,
  CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) AS units
FROM orders GROUP BY ALL""",
)
_series_ctes(
    "e",
    f"""
SELECT user_id AS k, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) AS pos,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS units,
  arg_min({choose_sql('event_type', EVENT_CODES)}, event_id)
    FILTER (event_type <> 'purchase') AS code
FROM events GROUP BY ALL""",
    codes=True,
)
cte("m_tail", "SELECT k, CAST(idx - greatest(n - 36, 0) AS INTEGER) AS idx, CAST(least(n, 36) AS INTEGER) AS n, coalesce(v, 0) AS v FROM m_rows WHERE idx >= n - 36")


_LOOKUPS: dict[tuple[str, str], tuple[lookup.StoredModels, lookup.StoredRanges]] = {}


def lookups(t: Tables) -> tuple[lookup.StoredModels, lookup.StoredRanges]:
    """Models and ranges as the job stores them, once for all queries."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _LOOKUPS:
        path = fresh_dir(t.spark, "lookups")
        _LOOKUPS[key] = lookup.store_models(models(t), f"{path}/models"), lookup.store_ranges(ranges(t), f"{path}/ranges")
    return _LOOKUPS[key]
