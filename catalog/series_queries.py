"""Series and list queries. Lists are compared as long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import standins as S
from catalog.registry import Tables, cte, query, rounded
from wattline import constants as C
from wattline.functions import dates, lists, rules, stats
from wattline.operators import series
from wattline.plans import raw


def _long(df: DataFrame, items: str = "adv_ut_list", keep: tuple[str, ...] = ("k",), digits: int | None = 2) -> DataFrame:
    long = series.explode_series(df, items, keep, "v")
    return long if digits is None else long.withColumn("v", rounded("v", digits))


V2 = "round(v, 2) + 0.0 AS v"


# ---- building ----


@query(
    "series_start",
    """SELECT m.CONS_ID, m.CSQ, CAST(greatest(s.first_pos, year(m.FDT) * 12 + month(m.FDT) - 1) AS INTEGER) AS start_pos
FROM master_latest m LEFT JOIN (
  SELECT CONS_ID, CSQ, min(pos) AS first_pos FROM readings GROUP BY CONS_ID, CSQ) s USING (CONS_ID, CSQ)""",
)
def series_start(t: Tables) -> DataFrame:
    from catalog.relational import _latest_master

    span = series.agg_month_span(raw.read_months(S.consumption(t)), "pos")
    start = F.expr(dates.series_start("min_month", dates.month_position("FDT")))
    return _latest_master(t).join(span, C.KEYS, "left").select(*C.KEYS, start.alias("start_pos"))


@query("build_series", f"SELECT k, idx, {V2} FROM c_rows")
def build_series(t: Tables) -> DataFrame:
    return _long(S.c_series(t))


@query("build_code_series", "SELECT k, idx, code AS v FROM e_rows")
def build_code_series(t: Tables) -> DataFrame:
    return _long(S.e_series(t), "ent_cd_list", digits=None)


cte(
    "fixed_series",
    """
SELECT CONS_ID, CSQ, start_pos, last_pos FROM (
  SELECT m.CONS_ID, m.CSQ, greatest(min(r.pos), any_value(year(m.FDT) * 12 + month(m.FDT) - 1)) AS start_pos,
    max(r.pos) AS last_pos
  FROM master_latest m JOIN readings r USING (CONS_ID, CSQ) GROUP BY m.CONS_ID, m.CSQ)""",
)


@query(
    "explode_series",
    """SELECT g.CONS_ID, g.CSQ, CAST(CASE WHEN g.pos IS NOT NULL THEN g.pos - g.start_pos END AS INTEGER) AS idx,
  r.units AS v
FROM (
  SELECT *, unnest(CASE WHEN start_pos <= last_pos THEN range(start_pos, last_pos + 1) ELSE [NULL] END) AS pos
  FROM fixed_series) g
LEFT JOIN reading_months r USING (CONS_ID, CSQ, pos)""",
)
def explode_series(t: Tables) -> DataFrame:
    """Series from the fixing of the meter; a consumer without one keeps an empty row."""
    from catalog.relational import _latest_master

    summary = raw.summarise_consumption(S.consumption(t))
    with_lists = raw.with_lists(_latest_master(t).join(summary, C.KEYS))
    return series.explode_series(with_lists, "adv_ut_list", C.KEYS, "v")


@query("series_length", "SELECT k, CAST(count(*) AS INTEGER) AS n FROM c_rows GROUP BY k")
def series_length(t: Tables) -> DataFrame:
    return S.c_series(t).select("k", F.expr(lists.series_length("adv_ut_list")).alias("n"))


@query(
    "count_missing",
    "SELECT k, CAST(count(*) FILTER (v IS NULL) AS INTEGER) AS n_missing FROM c_rows GROUP BY k",
)
def count_missing(t: Tables) -> DataFrame:
    return S.c_series(t).select("k", F.expr(lists.count_missing("adv_ut_list")).alias("n_missing"))


@query(
    "missing_ratio",
    "SELECT k, round(count(*) FILTER (v IS NULL) / count(*), 6) AS ratio FROM c_rows GROUP BY k",
)
def missing_ratio(t: Tables) -> DataFrame:
    return S.c_series(t).select("k", rounded(lists.missing_ratio("adv_ut_list")).alias("ratio"))


@query("fill_zero", "SELECT k, idx, round(coalesce(v, 0), 2) + 0.0 AS v FROM c_rows")
def fill_zero(t: Tables) -> DataFrame:
    return _long(S.c_series(t).withColumn("adv_ut_list", F.expr(lists.fill_zero("adv_ut_list"))))


@query(
    "nan_to_none",
    """SELECT k, idx, CASE WHEN v > 10000000 THEN round(v, 2) + 0.0 END AS v FROM c_rows""",
)
def nan_to_none(t: Tables) -> DataFrame:
    """Readings up to 100,000.00 are NaN on the way in."""
    marked = "transform(adv_ut_list, x -> if(x IS NULL OR x > 10000000, x, double('NaN')))"
    return _long(S.c_series(t).withColumn("adv_ut_list", F.expr(lists.nan_to_null(marked))))


@query(
    "parse_list_text",
    """SELECT r.k, idx, CASE WHEN v >= 20 THEN round(v, 2) + 0.0 END AS v,
  CASE WHEN code = 'LW' THEN 'None' ELSE code END AS code
FROM e_rows r""",
)
def parse_list_text(t: Tables) -> DataFrame:
    """Lists written as text, with None, nan and a code that is called None, and read back."""
    number = "CASE WHEN x IS NULL THEN 'None' WHEN x < 20 THEN 'nan' ELSE string(x) END"
    code = """CASE WHEN x IS NULL THEN 'None' WHEN x = 'LW' THEN "'None'" ELSE "'" || x || "'" END"""
    text = "'[' || array_join(transform({0}, x -> {1}), ', ') || ']'"
    written = S.e_series(t).selectExpr(
        "k", f"{text.format('adv_ut_list', number)} AS r", f"{text.format('ent_cd_list', code)} AS c"
    )
    read = written.selectExpr(
        "k", f"{lists.parse_reading_list('r')} AS r", f"{lists.parse_code_list('c')} AS c"
    )
    pairs = F.arrays_zip("r", "c")
    return read.select("k", F.posexplode(pairs).alias("idx", "p")).select(
        "k", "idx", rounded("p.r", 2).alias("v"), F.col("p.c").alias("code")
    )


# ---- tails ----


@query("tail_36", "SELECT k, idx, v + 0.0 AS v FROM m_tail")
def tail_36(t: Tables) -> DataFrame:
    return _long(S.m_series(t).withColumn("adv_ut_list", F.expr(lists.fill_zero(lists.tail("adv_ut_list")))))


@query(
    "tail_6_desc",
    "SELECT k, "
    + ", ".join(f"round(coalesce(max(v) FILTER (idx = n - {i}), 0), 2) + 0.0 AS t{i - 1}" for i in range(1, 7))
    + " FROM c_rows GROUP BY k",
)
def tail_6_desc(t: Tables) -> DataFrame:
    latest = lists.tail_desc("adv_ut_list", 6)
    return S.c_series(t).select("k", *(rounded(c, 2).alias(f"t{i}") for i, c in enumerate(latest)))


# ---- billing cycles ----

BI = """
SELECT k, idx, coalesce(trunc(v / 2), lead(trunc(v / 2)) OVER (PARTITION BY k ORDER BY idx)) AS v FROM {0}"""
TRI = """
SELECT k, idx, coalesce(lead(trunc(v / 3), 2) OVER w, lead(trunc(v / 3)) OVER w, trunc(v / 3)) AS v,
  max(idx) FILTER (v IS NOT NULL) OVER (PARTITION BY k) AS last_idx
FROM {0} WINDOW w AS (PARTITION BY k ORDER BY idx)"""
RENUMBER = "CAST(row_number() OVER (PARTITION BY k ORDER BY idx) - 1 AS INTEGER) AS idx"

cte("c_bi", BI.format("c_rows"))
cte("c_tri", TRI.format("c_rows"))


@query("bimonthly_split", f"SELECT k, {RENUMBER}, v + 0.0 AS v FROM c_bi WHERE v IS NOT NULL")
def bimonthly_split(t: Tables) -> DataFrame:
    return _long(S.c_series(t).withColumn("adv_ut_list", F.expr(lists.bimonthly_split("adv_ut_list"))))


@query("trimonthly_split", "SELECT k, idx, v + 0.0 AS v FROM c_tri WHERE idx <= last_idx")
def trimonthly_split(t: Tables) -> DataFrame:
    return _long(S.c_series(t).withColumn("adv_ut_list", F.expr(lists.trimonthly_split("adv_ut_list"))))


CNO = """CASE k % 3 WHEN 0 THEN '011' WHEN 1 THEN '88' ELSE '77' END || k"""


@query(
    "cycle_dispatch",
    f"""SELECT k, CNO, CAST(row_number() OVER (PARTITION BY k ORDER BY idx) - 1 AS INTEGER) AS idx, v FROM (
  SELECT k, {CNO} AS CNO, idx, v + 0.0 AS v FROM c_bi WHERE {CNO} LIKE '011%' AND v IS NOT NULL
  UNION ALL
  SELECT k, {CNO} AS CNO, idx, v + 0.0 AS v FROM c_tri WHERE {CNO} LIKE '88%' AND idx <= last_idx
  UNION ALL
  SELECT k, {CNO} AS CNO, idx, {V2} FROM c_rows WHERE NOT ({CNO} LIKE '011%' OR {CNO} LIKE '88%'))""",
)
def cycle_dispatch(t: Tables) -> DataFrame:
    numbered = S.c_series(t).withColumn("CNO", F.expr(CNO))
    split = numbered.withColumn("adv_ut_list", F.expr(lists.cycle_dispatch("CNO", "adv_ut_list")))
    return _long(split, keep=("k", "CNO"))


# ---- codes and trailing means ----

LAST3 = "max(CASE WHEN code = '{0}' AND idx >= n - 3 THEN 1 ELSE 0 END)"


@query(
    "consecutive_code",
    """SELECT k, CAST(max(CASE WHEN code = 'NR' AND prev = 'NR' THEN 1 ELSE 0 END) AS INTEGER) AS hit FROM (
  SELECT k, code, lag(code) OVER (PARTITION BY k ORDER BY idx) AS prev FROM e_rows) GROUP BY k""",
)
def consecutive_code(t: Tables) -> DataFrame:
    return S.e_series(t).select("k", F.expr(rules.fires(rules.consecutive_code("ent_cd_list"))).alias("hit"))


@query(
    "last_k_codes",
    "SELECT k, "
    + ", ".join(f"CAST({LAST3.format(c)} AS INTEGER) AS has_{c}" for c in ("SP", "LW", "NR"))
    + " FROM e_rows GROUP BY k",
)
def last_k_codes(t: Tables) -> DataFrame:
    found = {c: rules.fires(rules.code_in_last("ent_cd_list", c)) for c in ("SP", "LW", "NR")}
    return S.e_series(t).selectExpr("k", *(f"{text} AS has_{c}" for c, text in found.items()))


@query(
    "trailing_mean_ratio",
    """SELECT k, round(max(v) FILTER (idx = n - 1), 2) + 0.0 AS last_v,
  round(sum(coalesce(v, 0)) FILTER (idx BETWEEN n - 7 AND n - 2) / 6, 6) + 0.0 AS prior_mean,
  round(max(v) FILTER (idx = n - 1)
    / nullif(sum(coalesce(v, 0)) FILTER (idx BETWEEN n - 7 AND n - 2) / 6, 0), 4) + 0.0 AS ratio
FROM e_rows GROUP BY k HAVING max(n) >= 7
UNION ALL
SELECT k, round(max(v) FILTER (idx = n - 1), 2) + 0.0, NULL, NULL FROM e_rows GROUP BY k HAVING max(n) < 7""",
)
def trailing_mean_ratio(t: Tables) -> DataFrame:
    filled = S.e_series(t).withColumn("a", F.expr(lists.fill_zero("adv_ut_list")))
    before, last = rules.prior_mean("a"), lists.last_item("a")
    return filled.select(
        "k",
        rounded(last, 2).alias("last_v"),
        rounded(before).alias("prior_mean"),
        rounded(f"try_divide({last}, {before})", 4).alias("ratio"),
    )


# ---- moving average over whole series ----

cte(
    "m_trend",
    """
SELECT k, idx, n, coalesce(v, 0) AS v, CASE WHEN count(*) OVER w = 13 THEN
  (sum(coalesce(v, 0)) OVER w - 0.5 * first_value(coalesce(v, 0)) OVER w - 0.5 * last_value(coalesce(v, 0)) OVER w) / 12 END AS trend
FROM m_rows WINDOW w AS (PARTITION BY k ORDER BY idx ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)""",
)


@query(
    "moving_average_2x12",
    "SELECT k, idx, round(trend, 6) + 0.0 AS v FROM m_trend WHERE trend IS NOT NULL",
)
def moving_average_2x12(t: Tables) -> DataFrame:
    trend = stats.centred_trend(lists.fill_zero("adv_ut_list"))
    smooth = S.m_series(t).select("k", F.posexplode(F.expr(trend)).alias("j", "v"))
    return smooth.select("k", (F.col("j") + stats.HALF).alias("idx"), rounded("v").alias("v"))
