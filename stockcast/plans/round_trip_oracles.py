"""SQL counterparts of the queries of files, saved artifacts and fallbacks."""

from __future__ import annotations

from stockcast.plans import oracles as base
from stockcast.plans.round_trips import FLAG, LINE_NUMBERS

COERCED = """coerced AS (SELECT l_orderkey, l_linenumber, l_tax, l_shipdate, l_returnflag,
 CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END AS amount,
 CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS ratio FROM lineitem)"""
COERCED_SPLIT = f"""{COERCED}, cut AS (SELECT max(l_shipdate) - INTERVAL 365 DAY AS c FROM coerced),
ref AS (SELECT x.* FROM coerced x, cut WHERE l_shipdate <= c), cur AS (SELECT x.* FROM coerced x, cut WHERE l_shipdate > c)"""


def oracle_sql() -> dict[str, str]:
    medians = ", ".join(f"median({c}) AS m_{c}" for c in base.MACRO)
    by_store = ", ".join(f"COALESCE(e.{c}, m.m_{c}) AS {c}" for c in base.MACRO)
    overall = ", ".join(f"round(COALESCE({c}, m_{c}), 3) AS {c}" for c in base.MACRO)
    panel_columns = "Store Dept Date MarkDown1 MarkDown2 CPI Unemployment Type Size IsHoliday".split()
    parts = [f"Date_{p}" for p in ("year", "month", "week", "day", "dow", "dayofyear", "ts")]
    features = [c for c in panel_columns if c != "Date"] + parts
    seen = base._naive(base.SALES).replace(
        "valid AS (SELECT y.* FROM y, cut WHERE Date > c)",
        "valid AS (SELECT y.* REPLACE (CASE WHEN Store = 2 THEN 'new ' || Dept ELSE Dept END AS Dept) FROM y, cut WHERE Date > c)")
    nothing = "CAST(NULL AS DOUBLE)"
    return {
        "csv_round_trip": f"""WITH {base.FEATURES} SELECT Store, Date, {nothing} AS Temperature, {nothing} AS Fuel_Price, MarkDown1, MarkDown2,
 {nothing} AS MarkDown3, {nothing} AS MarkDown4, {nothing} AS MarkDown5, CPI, Unemployment, IsHoliday FROM features""",
        "preprocess_round_trip": f"""WITH {base.PANEL}, {base._positions(features)},
labels AS (SELECT 'Dept' AS feature, Dept AS value FROM enriched UNION SELECT 'Type', Type FROM enriched
 UNION SELECT 'Dept', 'missing' UNION SELECT 'Type', 'missing')
SELECT CAST(pos AS INTEGER) AS pos, feature, value IS NOT NULL AS is_cat, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code,
 value FROM pos LEFT JOIN labels USING (feature)""",
        "quantile_reference_round_trip": f"""WITH {base.LINE_SPLIT}, {base._positions([*LINE_NUMBERS, FLAG])}, {base._quantile_bins(LINE_NUMBERS)},
rc AS (SELECT l_returnflag AS key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ref) AS share FROM ref GROUP BY 1),
rd AS (SELECT key, share FROM rc UNION ALL SELECT '__other__', greatest(0.0, 1.0 - SUM(share)) FROM rc)
SELECT CAST(pos AS INTEGER) AS pos, feature, 'numeric' AS kind, bin, lo, hi, CAST(NULL AS VARCHAR) AS key, prop AS ref_prop, (SELECT COUNT(*) FROM ref) AS n_ref
FROM qbins JOIN pos USING (feature) UNION ALL
SELECT {len(LINE_NUMBERS)}, '{FLAG}', 'categorical', NULL, NULL, NULL, key, share, (SELECT COUNT(*) FROM ref) FROM rd""",
        "width_reference_round_trip": f"""WITH {base.LINE_SPLIT}, {base._width_report(LINE_NUMBERS)}
SELECT feature, n_batch_rows, round(psi.psi, 9) AS psi, round(mean_batch, 6) AS mean_batch, round(std_batch, 6) AS std_batch,
 {nothing} AS missing_rate, {nothing} AS delta_n FROM psi JOIN st USING (feature)
UNION ALL SELECT '{FLAG}', (SELECT COUNT(*) FROM cur), NULL, NULL, NULL, 0.0,
 round((SELECT CAST(COUNT(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) / COUNT(*) FROM cur)
  - (SELECT CAST(COUNT(*) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) / COUNT(*) FROM ref), 9)""",
        "impute_overall": f"""WITH {base.PANEL}, lacking AS (SELECT * REPLACE (CASE WHEN Store <> 1 THEN CPI END AS CPI) FROM enriched),
med1 AS (SELECT Store, {medians} FROM lacking GROUP BY Store),
fill1 AS (SELECT e.* REPLACE ({by_store}) FROM lacking e LEFT JOIN med1 m ON e.Store=m.Store), med2 AS (SELECT {medians} FROM fill1)
SELECT fill1.* REPLACE ({overall}), true AS overall_used FROM fill1, med2""",
        "naive_overall": f"WITH {seen} SELECT Store, Dept, Date, Weekly_Sales, IsHoliday, round(pred, 4) AS pred FROM naive",
        "matrix_coerced": f"""WITH {COERCED} SELECT l_orderkey, l_linenumber, COALESCE(amount, 0.0) AS amount, COALESCE(ratio, 0.0) AS ratio,
 CAST(0 AS DOUBLE) AS absent, l_tax, CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'missing' END AS l_returnflag FROM coerced""",
        "drift_coerced": f"""WITH {COERCED_SPLIT}, {base._width_report(('amount', 'ratio'))}
SELECT feature, round(psi.psi, 6) AS psi, round(CAST(nv - cn AS DOUBLE) / nv, 6) AS out_of_range_rate, n_batch_rows
FROM psi JOIN st USING (feature) JOIN tot USING (feature)""",
        "reference_rows": """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT * FROM t WHERE TRY_CAST(day AS DATE) <= (SELECT max(TRY_CAST(day AS DATE)) - 28 FROM t)""",
        "merged_reference": f"""WITH cut AS (SELECT max(CAST(l_shipdate AS DATE)) - 365 AS c FROM lineitem),
ref AS (SELECT l.* FROM lineitem l, cut WHERE CAST(l_shipdate AS DATE) <= c), {base._width_reference(LINE_NUMBERS)}
SELECT CAST(pos AS INTEGER) AS pos, p.feature, bin, b.lo AS lo, b.hi AS hi, CAST(NULL AS VARCHAR) AS key, cnt, CAST(cnt AS DOUBLE) / n AS share, missing_rate,
 round(mean, 6) AS mean, round(std, 6) AS std, mn AS min, mx AS max, n_rows FROM bins b JOIN prof p USING (feature) JOIN pos USING (feature)
UNION ALL SELECT {len(LINE_NUMBERS)}, '{FLAG}', NULL, NULL, NULL, l_returnflag, COUNT(*), CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ref), 0.0,
 NULL, NULL, NULL, NULL, (SELECT COUNT(*) FROM ref) FROM ref GROUP BY l_returnflag""",
        "gold_by_month": f"""WITH {base.SALES} SELECT *, (SELECT COUNT(*) FROM sales) AS n_rows FROM sales
WHERE Date > (SELECT max(Date) - INTERVAL 28 DAY FROM sales)""",
        **{f"layout_{name}": base.oracle_sql()[same] for name, same in (
            ("history", "rolling_features"), ("naive", "seasonal_naive"), ("report", "segment_report"))},
        "segment_one": f"""WITH {base._naive(base.SALES)}
SELECT Date, Weekly_Sales AS Real, round(pred, 4) AS Previsto FROM naive WHERE Store = 1 AND Dept = (SELECT min(Dept) FROM naive WHERE Store = 1)""",
    }
