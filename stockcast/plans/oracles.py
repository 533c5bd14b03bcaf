"""SQL counterparts of the registered queries, for an ANSI engine over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from stockcast.plans.queries import EVENT_DAYS, GOLD_CATS, GOLD_FEATURES, GOLD_NUMBERS, LINE_NUMBERS, SCENARIOS

SALES = """sales AS (
 SELECT CAST(n.n_regionkey AS INT) AS Store, p.p_type AS Dept, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS Date,
  CAST(SUM(CASE WHEN l.l_returnflag='R' THEN -CAST(l.l_extendedprice AS DECIMAL(12,2)) ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END) AS DOUBLE) AS Weekly_Sales,
  (MONTH(CAST(date_trunc('week', l.l_shipdate) AS DATE)) = 11) AS IsHoliday
 FROM lineitem l JOIN part p ON l.l_partkey=p.p_partkey JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN nation n ON s.s_nationkey=n.n_nationkey
 GROUP BY 1, 2, 3, 5)"""
FEATURES = """features AS (
 SELECT CAST(n.n_regionkey AS INT) AS Store, CAST(date_trunc('week', o.o_orderdate) AS DATE) AS Date,
  CAST(SUM(CASE WHEN o.o_orderpriority LIKE '1-%' THEN CAST(o.o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS MarkDown1,
  CAST(SUM(CASE WHEN o.o_orderpriority LIKE '2-%' THEN CAST(o.o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS MarkDown2,
  CAST(MAX(CAST(c.c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS CPI,
  CAST(MIN(CAST(c.c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS Unemployment,
  (MONTH(CAST(date_trunc('week', o.o_orderdate) AS DATE)) = 12) AS IsHoliday
 FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey JOIN nation n ON c.c_nationkey=n.n_nationkey
 GROUP BY 1, 2, 7)"""
STORES = """stores AS (
 SELECT CAST(r.r_regionkey AS INT) AS Store, r.r_name AS Type, CAST(COUNT(s.s_suppkey) AS BIGINT) AS Size
 FROM region r JOIN nation n ON n.n_regionkey=r.r_regionkey LEFT JOIN supplier s ON s.s_nationkey=n.n_nationkey
 GROUP BY 1, 2)"""
ENRICHED = """enriched AS (
 SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, f.MarkDown1, f.MarkDown2, f.CPI, f.Unemployment, st.Type, st.Size,
  CAST(COALESCE(f.IsHoliday, false) AS INTEGER) AS IsHoliday
 FROM sales s LEFT JOIN features f ON s.Store=f.Store AND s.Date=f.Date LEFT JOIN stores st ON s.Store=st.Store)"""
PANEL = f"{SALES},\n{FEATURES},\n{STORES},\n{ENRICHED}"
MACRO = ("MarkDown1", "MarkDown2", "CPI", "Unemployment")


def sig(x: str, digits: int = 9) -> str:
    x = f"CAST({x} AS DOUBLE)"
    e = f"floor(log10(abs({x})))"
    scale = f"pow(10.0, abs({e}))"
    return (f"CASE WHEN {x} = 0 THEN 0.0 WHEN {e} < 0 THEN round({x} * {scale}, {digits}) / {scale} "
            f"ELSE round({x} / {scale}, {digits}) * {scale} END")


def _calendar(d: str) -> str:
    return (
        f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
        f"CAST(weekofyear({d}) AS INTEGER) AS weekofyear, CAST(isodow({d}) - 1 AS INTEGER) AS dayofweek, "
        f"CAST(day({d}) = 1 AS INTEGER) AS is_month_start, CAST({d} = last_day({d}) AS INTEGER) AS is_month_end"
    )


def _parts(c: str, src: str) -> str:
    return (
        f"CAST(year({src}) AS INTEGER) AS {c}_year, CAST(month({src}) AS INTEGER) AS {c}_month, "
        f"CAST(weekofyear({src}) AS INTEGER) AS {c}_week, CAST(day({src}) AS INTEGER) AS {c}_day, "
        f"CAST(isodow({src}) - 1 AS INTEGER) AS {c}_dow, CAST(dayofyear({src}) AS INTEGER) AS {c}_dayofyear, "
        f"CAST(floor(epoch({src})) AS BIGINT) AS {c}_ts"
    )


def _rolling(windows: Sequence[int], std: str) -> str:
    out = []
    for k in windows:
        over = f"OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        out.append(f"CASE WHEN COUNT(y) {over} = {k} THEN CAST(SUM(y) {over} AS DOUBLE) / {k} END AS roll_mean_{k}")
        out.append(f"CASE WHEN COUNT(y) {over} = {k} THEN {std.format(x=f'STDDEV_SAMP(CAST(y AS DOUBLE)) {over}')} END AS roll_std_{k}")
    return ",\n  ".join(out)


def _gold() -> str:
    medians = ", ".join(f"median({c}) AS m_{c}" for c in MACRO)
    fill1 = ", ".join(f"COALESCE(k.{c}, m.m_{c}) AS {c}" for c in MACRO)
    fill2 = ", ".join(f"round(COALESCE({c}, m_{c}), 3) AS {c}" for c in MACRO)
    lags = ", ".join(f"lag(Weekly_Sales, {k}) OVER w AS lag_{k}" for k in (1, 2, 3, 4))
    history = ["lag_1", "lag_2", "lag_3", "lag_4", *[f"roll_{s}_{k}" for k in (4, 8, 12) for s in ("mean", "std")]]
    full = " AND ".join(f"{c} IS NOT NULL" for c in history)
    return f"""{PANEL},
known AS (SELECT * EXCLUDE (y) FROM (SELECT *, {_calendar('Date')},
  {lags},
  {_rolling((4, 8, 12), 'ROUND({x}, 2)')}
 FROM (SELECT *, CAST(Weekly_Sales AS DECIMAL(18,2)) AS y FROM enriched) WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date))),
med1 AS (SELECT Store, {medians} FROM enriched GROUP BY Store),
fill1 AS (SELECT k.* REPLACE ({fill1}) FROM known k LEFT JOIN med1 m ON k.Store=m.Store),
med2 AS (SELECT {medians} FROM fill1),
gold AS (SELECT fill1.* REPLACE ({fill2}, CASE WHEN Weekly_Sales < 0 THEN 0 ELSE Weekly_Sales END AS Weekly_Sales)
 FROM fill1, med2 WHERE {full})"""


GOLD = _gold()
GOLD_SPLIT = f"""{GOLD},
dated AS (SELECT gold.*, {_parts('Date', 'Date')} FROM gold),
cut AS (SELECT max(Date) - INTERVAL 28 DAY AS c FROM gold),
ref AS (SELECT d.* FROM dated d, cut WHERE d.Date <= c), cur AS (SELECT d.* FROM dated d, cut WHERE d.Date > c)"""
GOLD_COLUMNS = f"""{GOLD}, late AS (SELECT * FROM gold WHERE Date > (SELECT max(Date) - INTERVAL 28 DAY FROM gold))"""
EVENT_SPLIT = f"""cut AS (SELECT max(ts) - INTERVAL {EVENT_DAYS} DAY AS c FROM events),
ref AS (SELECT value, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events, cut WHERE ts <= c),
cur AS (SELECT value, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events, cut WHERE ts > c)"""


LINE_SPLIT = """cut AS (SELECT max(l_shipdate) - INTERVAL 365 DAY AS c FROM lineitem),
ref AS (SELECT l.* FROM lineitem l, cut WHERE l_shipdate <= c), cur AS (SELECT l.* FROM lineitem l, cut WHERE l_shipdate > c)"""


def _naive(panel: str, extra: str = "") -> str:
    """CTEs ending in ``naive``: validation rows with pred, from a panel CTE named sales."""
    return f"""{panel},
y AS (SELECT Store, Dept, Date, CASE WHEN Weekly_Sales < 0 THEN 0 ELSE Weekly_Sales END AS Weekly_Sales, IsHoliday FROM sales),
cut AS (SELECT max(Date) - INTERVAL 28 DAY AS c FROM y),
train AS (SELECT y.* FROM y, cut WHERE Date <= c), valid AS (SELECT y.* FROM y, cut WHERE Date > c),
gm AS (SELECT Store, Dept, median(Weekly_Sales) AS m FROM train GROUP BY 1, 2), om AS (SELECT median(Weekly_Sales) AS m FROM train),
naive AS (SELECT v.*, COALESCE(t.Weekly_Sales, gm.m, om.m) AS pred, COALESCE(gm.m, om.m) AS pred_median
 FROM valid v LEFT JOIN train t ON t.Store=v.Store AND t.Dept=v.Dept AND t.Date + 364 = v.Date
 LEFT JOIN gm ON gm.Store=v.Store AND gm.Dept=v.Dept CROSS JOIN om){extra}"""


def _metrics(src: str, by: Sequence[str] = ()) -> str:
    """Metrics over Weekly_Sales and pred as DECIMAL(18,4)."""
    keys = "".join(f"{c}, " for c in by)
    group = f" GROUP BY {', '.join(by)}" if by else ""
    mae, rmse = "CAST(SUM(abs(y - p)) AS DOUBLE) / COUNT(*)", "sqrt(CAST(SUM((y - p) * (y - p)) AS DOUBLE) / COUNT(*))"
    mape = "SUM(CAST(abs(y - p) AS DOUBLE) / greatest(abs(CAST(y AS DOUBLE)), 1e-8)) / COUNT(*)"
    cost = "CAST(SUM(greatest(y - p, 0)) AS DOUBLE) * 6.0 + CAST(SUM(greatest(p - y, 0)) AS DOUBLE) * 1.5"
    return (
        f"SELECT {keys}COUNT(*) AS n, CAST(0 AS BIGINT) AS n_null, {mae} AS mae, {rmse} AS rmse, {sig(mape)} AS mape, "
        f"{cost} AS cost_total FROM (SELECT *, CAST(Weekly_Sales AS DECIMAL(18,4)) AS y, CAST(pred AS DECIMAL(18,4)) AS p FROM {src}){group}"
    )


def _long(src: str, cols: Sequence[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)


def _keys(src: str, cols: Sequence[str], missing: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COALESCE(CAST({c} AS VARCHAR), '{missing}') AS key FROM {src}" for c in cols)


def _positions(names: Sequence[str]) -> str:
    return "pos AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(names)) + ") t(pos, feature))"


def _width_reference(cols: Sequence[str], n: int = 10) -> str:
    """CTEs over ref: prof (one row per feature), bins (feature, bin, lo, hi, cnt)."""
    return f"""{_positions(cols)},
rl AS ({_long('ref', cols)}),
prof AS (SELECT feature, COUNT(*) AS n_rows, COUNT(v) AS n, 1.0 - CAST(COUNT(v) AS DOUBLE) / COUNT(*) AS missing_rate, AVG(v) AS mean,
 STDDEV_SAMP(v) AS std, MIN(v) AS mn, MAX(v) AS mx FROM rl GROUP BY feature HAVING COUNT(v) > 0),
rng AS (SELECT *, CASE WHEN mn <> mx THEN mn WHEN mn = 0 THEN -0.001 ELSE mn - abs(mn) * 0.001 END AS a,
 CASE WHEN mn <> mx THEN mx WHEN mn = 0 THEN 0.001 ELSE mx + abs(mn) * 0.001 END AS b FROM prof),
grid AS (SELECT rng.*, CAST(i AS INTEGER) AS bin,
 CASE WHEN i = 0 THEN CASE WHEN mn <> mx THEN a - (b - a) * 0.001 ELSE a END ELSE a + CAST(i AS DOUBLE) * ((b - a) / {n}) END AS lo,
 CASE WHEN i = {n - 1} THEN b ELSE a + CAST(i + 1 AS DOUBLE) * ((b - a) / {n}) END AS hi FROM rng, range({n}) r(i)),
bins AS (SELECT g.feature, g.bin, ANY_VALUE(g.lo) AS lo, ANY_VALUE(g.hi) AS hi, COUNT(rl.v) AS cnt FROM grid g
 LEFT JOIN rl ON rl.feature = g.feature AND rl.v > g.lo AND rl.v <= g.hi GROUP BY 1, 2)"""


def _width_report(cols: Sequence[str], n: int = 10) -> str:
    """CTEs over ref and cur, ending in report (one row per numeric feature)."""
    return f"""{_width_reference(cols, n)},
cl AS ({_long('cur', cols)}),
cb AS (SELECT b.feature, b.bin, b.cnt, COUNT(cl.v) AS cur FROM bins b
 LEFT JOIN cl ON cl.feature = b.feature AND (cl.v > b.lo OR (b.bin = 0 AND cl.v = b.lo)) AND cl.v <= b.hi GROUP BY 1, 2, 3),
tot AS (SELECT feature, SUM(cnt) AS rn, SUM(cur) AS cn FROM cb GROUP BY 1),
sh AS (SELECT cb.feature, CASE WHEN cnt = 0 THEN 1e-8 ELSE CAST(cnt AS DOUBLE) / CAST(rn AS DOUBLE) END AS r,
 CASE WHEN cn = 0 THEN NULL WHEN cur = 0 THEN 1e-8 ELSE CAST(cur AS DOUBLE) / CAST(cn AS DOUBLE) END AS c FROM cb JOIN tot USING (feature)),
psi AS (SELECT feature, SUM((c - r) * ln(c / r)) AS psi FROM sh GROUP BY 1),
st AS (SELECT feature, AVG(v) AS mean_batch, STDDEV_POP(v) AS std_batch, COUNT(v) AS nv, COUNT(*) AS n_batch_rows FROM cl GROUP BY 1),
report AS (SELECT p.pos, p.feature, {sig('psi.psi')} AS psi, {sig('mean_batch')} AS mean_batch, {sig('std_batch')} AS std_batch,
 {sig('CAST(nv - cn AS DOUBLE) / nv')} AS out_of_range_rate, n_batch_rows
 FROM pos p JOIN psi USING (feature) JOIN st USING (feature) JOIN tot USING (feature))"""


def _quantile_bins(cols: Sequence[str], n: int = 10) -> str:
    """CTEs over ref, ending in qbins (feature, bin, lo, hi, prop)."""
    probs = ", ".join([*(repr(i * (1.0 / n)) for i in range(n)), "1.0"])
    return f"""rl AS ({_long('ref', cols)}),
qe AS (SELECT feature, list_sort(list_distinct([CAST(format('{{:.11e}}', x) AS DOUBLE) for x in quantile_cont(v, [{probs}])])) AS e FROM rl WHERE v IS NOT NULL GROUP BY 1),
qc AS (SELECT feature, CASE WHEN len(e) <= 1 THEN e ELSE e[2:len(e) - 1] END AS cuts FROM qe),
qg AS (SELECT feature, CAST(i AS INTEGER) AS bin, CASE WHEN i > 0 THEN cuts[i] END AS lo, CASE WHEN i < len(cuts) THEN cuts[i + 1] END AS hi
 FROM (SELECT feature, cuts, unnest(range(len(cuts) + 1)) AS i FROM qc)),
qcnt AS (SELECT g.feature, g.bin, ANY_VALUE(g.lo) AS lo, ANY_VALUE(g.hi) AS hi, COUNT(rl.v) AS cnt FROM qg g
 LEFT JOIN rl ON rl.feature = g.feature AND (g.lo IS NULL OR rl.v >= g.lo) AND (g.hi IS NULL OR rl.v < g.hi) GROUP BY 1, 2),
qbins AS (SELECT *, CAST(cnt AS DOUBLE) / CAST(SUM(cnt) OVER (PARTITION BY feature) AS DOUBLE) AS prop FROM qcnt)"""


def _psi_numeric(cols: Sequence[str], n: int = 10) -> str:
    return f"""{_quantile_bins(cols, n)},
cl AS ({_long('cur', cols)}),
ccnt AS (SELECT q.feature, q.bin, q.prop AS r, COUNT(cl.v) AS cnt FROM qbins q
 LEFT JOIN cl ON cl.feature = q.feature AND (q.lo IS NULL OR cl.v >= q.lo) AND (q.hi IS NULL OR cl.v < q.hi) GROUP BY 1, 2, 3),
nterm AS (SELECT feature, r, CAST(cnt AS DOUBLE) / CAST(SUM(cnt) OVER (PARTITION BY feature) AS DOUBLE) AS c FROM ccnt)"""


def _psi_category(cols: Sequence[str]) -> str:
    return f"""rk AS ({_keys('ref', cols, 'missing')}), ck AS ({_keys('cur', cols, 'missing')}),
rc AS (SELECT feature, key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ref) AS share,
 row_number() OVER (PARTITION BY feature ORDER BY COUNT(*) DESC, key) AS nr FROM rk GROUP BY 1, 2),
top AS (SELECT feature, key, share FROM rc WHERE nr <= 30),
rd AS (SELECT * FROM top UNION ALL SELECT feature, '__other__', greatest(0.0, 1.0 - SUM(share)) FROM top GROUP BY 1),
cd AS (SELECT ck.feature, COALESCE(top.key, '__other__') AS key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM cur) AS share
 FROM ck LEFT JOIN top ON top.feature = ck.feature AND top.key = ck.key GROUP BY 1, 2),
cterm AS (SELECT rd.feature, rd.share AS r, COALESCE(cd.share, 0.0) AS c FROM rd LEFT JOIN cd ON cd.feature = rd.feature AND cd.key = rd.key)"""


def _psi_result(names: Sequence[str], cats: Sequence[str], terms: Sequence[str]) -> str:
    """CTE psi (pos, feature, kind, psi) over nterm / cterm."""
    union = " UNION ALL ".join(f"SELECT feature, r, c FROM {t}" for t in terms)
    kinds = ", ".join(f"'{c}'" for c in cats)
    kind = f"CASE WHEN feature IN ({kinds}) THEN 'categorical' ELSE 'numeric' END" if cats else "'numeric'"
    return f"""{_positions(names)},
psi AS (SELECT pos, feature, {kind} AS kind, psi FROM pos JOIN
 (SELECT feature, SUM((c - r) * ln(c / r)) AS psi FROM
  (SELECT feature, least(greatest(r, 1e-6), 1.0) AS r, least(greatest(c, 1e-6), 1.0) AS c FROM ({union})) GROUP BY 1) USING (feature))"""


GOLD_PSI = (
    f"WITH {GOLD_SPLIT}, {_psi_numeric(GOLD_NUMBERS)}, {_psi_category(GOLD_CATS)}, "
    f"{_psi_result(GOLD_FEATURES, GOLD_CATS, ('nterm', 'cterm'))}"
)
FINE = """sales AS (
 SELECT CAST(l.l_suppkey AS INT) AS Store, p.p_brand AS Dept, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS Date,
  CAST(SUM(CASE WHEN l.l_returnflag='R' THEN -CAST(l.l_extendedprice AS DECIMAL(12,2)) ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END) AS DOUBLE) AS Weekly_Sales,
  (MONTH(CAST(date_trunc('week', l.l_shipdate) AS DATE)) = 11) AS IsHoliday
 FROM lineitem l JOIN part p ON l.l_partkey=p.p_partkey JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN nation n ON s.s_nationkey=n.n_nationkey
 GROUP BY 1, 2, 3, 5)"""


def _rolling_sql() -> str:
    return f"""WITH {SALES}
SELECT Store, Dept, Date, Weekly_Sales, {_rolling((4, 8, 12), 'ROUND({x}, 2)')}
FROM (SELECT *, CAST(Weekly_Sales AS DECIMAL(18,2)) AS y FROM sales) WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date)"""


def oracle_sql() -> dict[str, str]:
    scenarios = ", ".join(f"('{n}', CAST({u} AS DOUBLE), CAST({o} AS DOUBLE))" for n, u, o in SCENARIOS)
    quantiles = ", ".join(str(i / 10) for i in range(11))
    profile_cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    event_keys = ("event_type", "user_id")
    line_cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    macro1 = ", ".join(f"COALESCE(e.{c}, m.m_{c}) AS {c}" for c in MACRO)
    macro2 = ", ".join(f"round(COALESCE({c}, m_{c}), 3) AS {c}" for c in MACRO)
    medians = ", ".join(f"median({c}) AS m_{c}" for c in MACRO)
    naive = _naive(SALES)
    mixed_report = f"""WITH {GOLD_SPLIT}, {_width_report(GOLD_NUMBERS)}, rk AS ({_keys('ref', GOLD_CATS, '__MISSING__')}),
ck AS ({_keys('cur', GOLD_CATS, '__MISSING__')}),
rc AS (SELECT feature, key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ref) AS share,
 row_number() OVER (PARTITION BY feature ORDER BY COUNT(*) DESC, key) AS nr FROM rk GROUP BY 1, 2),
cc AS (SELECT feature, key, COUNT(*) AS cnt FROM ck GROUP BY 1, 2)
SELECT pos, feature, 'numeric' AS kind, psi, mean_batch, std_batch, out_of_range_rate, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS DOUBLE) AS delta,
 CAST(NULL AS DOUBLE) AS missing_rate, n_batch_rows FROM report UNION ALL
SELECT {len(GOLD_NUMBERS)} + CASE feature WHEN '{GOLD_CATS[0]}' THEN 0 ELSE 1 END, feature, 'categorical', NULL, NULL, NULL, NULL, rc.key,
 round(CAST(COALESCE(cnt, 0) AS DOUBLE) / (SELECT COUNT(*) FROM cur) - share, 9), CAST(0 AS DOUBLE), (SELECT COUNT(*) FROM cur)
FROM rc LEFT JOIN cc USING (feature, key) WHERE nr <= 30"""
    return {
        "enrich_panel": f"WITH {PANEL} SELECT * FROM enriched",
        "calendar_features": f"WITH {SALES} SELECT Store, Dept, Date, {_calendar('Date')} FROM sales",
        "parse_dates": "SELECT event_id, CAST(ts AS DATE) AS day, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS strict_day, "
                       "TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS lenient_day FROM events",
        "model_date_parts": f"SELECT o_orderkey, {_parts('at', 'o_orderdate')}, {_parts('day', 'CAST(o_orderdate AS DATE)')} FROM orders",
        "lag_features": f"WITH {SALES} SELECT Store, Dept, Date, Weekly_Sales, "
                        + ", ".join(f"lag(Weekly_Sales, {k}) OVER w AS lag_{k}" for k in (1, 2, 3, 4))
                        + " FROM sales WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date)",
        "rolling_features": _rolling_sql(),
        "rolling_features_split": _rolling_sql(),
        "event_history": f"""SELECT event_id, event_type, value, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
 {_rolling((4, 8), sig('{x}', 6))}
FROM (SELECT *, CAST(value AS DECIMAL(18,4)) AS y FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
        "event_history_ties": f"""SELECT event_id, event_type, value, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
 {_rolling((4, 8), sig('{x}', 6))}
FROM (SELECT *, CAST(value AS DECIMAL(18,4)) AS y FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY date_trunc('day', ts), event_id)""",
        "event_history_pieces": f"""SELECT event_id, event_type, value, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
 {_rolling((4, 8), sig('{x}', 6))}
FROM (SELECT *, CAST(value AS DECIMAL(18,4)) AS y FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY date_trunc('day', ts), lpad(CAST(event_id AS VARCHAR), 12, '0'))""",
        "impute_macro": f"""WITH {PANEL}, med1 AS (SELECT Store, {medians} FROM enriched GROUP BY Store),
fill1 AS (SELECT e.* REPLACE ({macro1}) FROM enriched e LEFT JOIN med1 m ON e.Store=m.Store), med2 AS (SELECT {medians} FROM fill1)
SELECT fill1.* REPLACE ({macro2}) FROM fill1, med2""",
        "build_dataset": f"WITH {GOLD} SELECT * FROM gold",
        "split_counts": """WITH cut AS (SELECT max(o_orderdate) - INTERVAL 28 DAY AS c FROM orders)
SELECT CASE WHEN o_orderdate <= c THEN 'train' ELSE 'valid' END AS part, COUNT(*) AS n, CAST(MIN(o_orderdate) AS DATE) AS first_day,
 CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders, cut GROUP BY 1""",
        "batch_slice": f"WITH {SALES} SELECT * FROM sales WHERE Date > (SELECT max(Date) - INTERVAL 28 DAY FROM sales)",
        "seasonal_naive": f"WITH {naive} SELECT Store, Dept, Date, Weekly_Sales, IsHoliday, round(pred, 4) AS pred FROM naive",
        "eval_baseline": f"WITH {naive} {_metrics('naive')}",
        "segment_report": f"WITH {naive} {_metrics('naive', ('Store', 'Dept'))}",
        "segment_series": f'WITH {naive} SELECT Store, Dept, Date, Weekly_Sales AS "Real", round(pred, 4) AS Previsto FROM naive',
        "cost_scenarios": f"""WITH {naive},
u AS (SELECT Store, Dept, CAST(SUM(greatest(y - p, 0)) AS DOUBLE) AS short, CAST(SUM(greatest(p - y, 0)) AS DOUBLE) AS over_
 FROM (SELECT *, CAST(Weekly_Sales AS DECIMAL(18,4)) AS y, CAST(pred AS DECIMAL(18,4)) AS p FROM naive) GROUP BY 1, 2)
SELECT Store, Dept, scenario, cost_under, cost_over, short * cost_under + over_ * cost_over AS cost_total
FROM u CROSS JOIN (VALUES {scenarios}) t(scenario, cost_under, cost_over)""",
        "segment_keys": f"WITH {SALES} SELECT DISTINCT Store, Dept FROM sales",
        "promotion_decision": f"""WITH {naive},
a AS ({_metrics('naive', ('Store',))}), b AS ({_metrics('(SELECT * REPLACE (pred_median AS pred) FROM naive)', ('Store',))})
SELECT a.Store, a.cost_total AS baseline_cost, b.cost_total AS model_cost, b.cost_total < a.cost_total AS promote FROM a JOIN b USING (Store)""",
        "supplier_brand_costs": f"WITH {_naive(FINE)} {_metrics('naive', ('Store',))}",
        "supplier_brand_history": f"""WITH {FINE},
h AS (SELECT Store, lag(y, 1) OVER w AS lag_1, lag(y, 4) OVER w AS lag_4,
 CASE WHEN COUNT(y) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) = 4 THEN CAST(SUM(y) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 4 END AS m4,
 CASE WHEN COUNT(y) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) = 12 THEN 1 END AS r12
 FROM (SELECT *, CAST(Weekly_Sales AS DECIMAL(18,2)) AS y FROM sales) WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date))
SELECT Store, COUNT(lag_4) AS n_lag_4, COUNT(r12) AS n_roll_12, CAST(SUM(lag_1) AS DOUBLE) AS sum_lag_1,
 CAST(SUM(CAST(m4 AS DECIMAL(24,6))) AS DOUBLE) AS sum_mean_4 FROM h GROUP BY 1""",
        "category_dictionary": f"""WITH {PANEL}, v AS (SELECT DISTINCT 'Type' AS feature, Type AS value FROM enriched UNION SELECT DISTINCT 'Dept', Dept FROM enriched
 UNION SELECT 'Type', 'missing' UNION SELECT 'Dept', 'missing')
SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code FROM v""",
        "category_apply": """WITH l AS (SELECT DISTINCT n_name AS value FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal < 0 UNION SELECT 'missing'),
d AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM l)
SELECT c_custkey, n_name AS nation, COALESCE(d.value, 'missing') AS nation_label, COALESCE(d.code, (SELECT code FROM d WHERE value = 'missing')) AS nation_code
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN d ON d.value = n_name""",
        "feature_matrix": f"""WITH {GOLD}, dated AS (SELECT gold.*, {_parts('Date', 'Date')} FROM gold)
SELECT Store, Date_week, CAST(Size AS DOUBLE) AS Size, COALESCE(MarkDown1, 0.0) AS MarkDown1, CAST(0 AS DOUBLE) AS MarkDown5,
 CASE WHEN Type IN ('ASIA', 'EUROPE') THEN Type ELSE 'missing' END AS Type, Dept, lag_1, roll_mean_4,
 CAST(Date_year AS DOUBLE) AS Date_year, CAST(Date_dayofyear AS DOUBLE) AS Date_dayofyear, CAST(Date_ts AS DOUBLE) AS Date_ts FROM dated""",
        "column_profile": f"""WITH rl AS ({_long('lineitem', profile_cols)})
SELECT feature, COUNT(*) AS n_rows, COUNT(v) AS n, 1.0 - CAST(COUNT(v) AS DOUBLE) / COUNT(*) AS missing_rate, {sig('AVG(v)')} AS mean,
 {sig('STDDEV_SAMP(v)')} AS std, {sig('STDDEV_POP(v)')} AS std_batch, MIN(v) AS min, MAX(v) AS max FROM rl GROUP BY 1""",
        "exact_quantiles": f"""WITH rl AS (SELECT l_returnflag, 'l_extendedprice' AS feature, l_extendedprice AS v FROM lineitem UNION ALL
 SELECT l_returnflag, 'l_quantity', l_quantity FROM lineitem),
q AS (SELECT l_returnflag, feature, COUNT(v) AS n, quantile_cont(v, [{quantiles}]) AS qs FROM rl GROUP BY 1, 2)
SELECT l_returnflag, feature, n, CAST(i AS INTEGER) AS decile, round(qs[i + 1], 5) AS q FROM q, range(11) r(i)""",
        "drift_width_reference": f"""WITH {GOLD_SPLIT}, {_width_reference(GOLD_NUMBERS)}
SELECT pos, p.feature, bin, b.lo AS lo, b.hi AS hi, cnt, CAST(cnt AS DOUBLE) / n AS share, missing_rate,
 {sig('mean')} AS mean, {sig('std')} AS std, mn AS min, mx AS max, n_rows FROM bins b JOIN prof p USING (feature) JOIN pos USING (feature)""",
        "drift_width_report": f"WITH {GOLD_SPLIT}, {_width_report(GOLD_NUMBERS)} SELECT * FROM report",
        "drift_width_events": f"WITH {EVENT_SPLIT}, {_width_report(('value',))} SELECT * EXCLUDE (pos) FROM report",
        "drift_category_topk": f"""WITH {EVENT_SPLIT}, rk AS ({_keys('ref', event_keys, '__MISSING__')}),
rc AS (SELECT feature, key, COUNT(*) AS cnt, row_number() OVER (PARTITION BY feature ORDER BY COUNT(*) DESC, key) AS nr FROM rk GROUP BY 1, 2)
SELECT feature, key, cnt, CAST(cnt AS DOUBLE) / (SELECT COUNT(*) FROM ref) AS share FROM rc WHERE nr <= 30""",
        "drift_category_delta": f"""WITH {EVENT_SPLIT}, rk AS ({_keys('ref', event_keys, '__MISSING__')}), ck AS ({_keys('cur', event_keys, '__MISSING__')}),
rc AS (SELECT feature, key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ref) AS share,
 row_number() OVER (PARTITION BY feature ORDER BY COUNT(*) DESC, key) AS nr FROM rk GROUP BY 1, 2),
cc AS (SELECT feature, key, COUNT(*) AS cnt FROM ck GROUP BY 1, 2)
SELECT feature, rc.key AS value, round(CAST(COALESCE(cnt, 0) AS DOUBLE) / (SELECT COUNT(*) FROM cur) - share, 9) AS delta,
 CAST(0 AS DOUBLE) AS missing_rate, (SELECT COUNT(*) FROM cur) AS n_batch_rows
FROM rc LEFT JOIN cc USING (feature, key) WHERE nr <= 30""",
        "drift_quantile_reference": f"""WITH {GOLD_SPLIT}, {_positions(GOLD_NUMBERS)}, {_quantile_bins(GOLD_NUMBERS)}
SELECT pos, feature, bin, lo, hi, prop AS ref_prop, (SELECT COUNT(*) FROM ref) AS n_ref FROM qbins JOIN pos USING (feature)""",
        "drift_quantile_psi": f"{GOLD_PSI} SELECT pos, feature, kind, {sig('psi')} AS psi FROM psi",
        "drift_top_features": f"{GOLD_PSI} SELECT pos, feature, kind, {sig('psi')} AS psi FROM psi ORDER BY 4 DESC, pos LIMIT 10",
        "drift_quantile_summary": f"""{GOLD_PSI}, exact AS (SELECT pos, feature, {sig('psi')} AS psi FROM psi) SELECT COALESCE(MAX(psi) >= 0.2, false) AS drift_detected, CAST(0.2 AS DOUBLE) AS drift_threshold,
 MAX(psi) AS max_psi, COUNT(*) FILTER (psi >= 0.2) AS n_features_over_threshold,
 (SELECT string_agg(feature, ',' ORDER BY psi DESC, pos) FROM (SELECT * FROM exact ORDER BY psi DESC, pos LIMIT 10)) AS top_features,
 (SELECT string_agg(printf('%.6f', psi), ',' ORDER BY psi DESC, pos) FROM (SELECT * FROM exact ORDER BY psi DESC, pos LIMIT 10)) AS top_psi FROM exact""",
        "drift_category_psi": f"WITH {EVENT_SPLIT}, {_psi_category(event_keys)}, {_psi_result(event_keys, event_keys, ('cterm',))} "
                              f"SELECT pos, feature, kind, {sig('psi')} AS psi FROM psi",
        "drift_report_mixed": mixed_report,
        "drift_width_bins20": f"WITH {LINE_SPLIT}, {_width_report(LINE_NUMBERS, 20)} SELECT * EXCLUDE (pos) FROM report",
        "drift_quantile_bins20": f"""WITH {LINE_SPLIT}, {_psi_numeric(LINE_NUMBERS, 20)}, {_psi_result(LINE_NUMBERS, (), ('nterm',))}
SELECT pos, feature, kind, {sig('psi')} AS psi FROM psi""",
        "train_score_gbt": f"WITH {GOLD_COLUMNS} SELECT *, true AS finite, true AS beats_mean FROM late",
        "score_expression": f"WITH {GOLD} SELECT *, true AS equal FROM gold",
        "train_reference_settings": f"""WITH {GOLD_SPLIT}
SELECT Store, COUNT(*) AS n_scored, true AS patience_ended, true AS grown_once, true AS beats_median FROM cur GROUP BY 1""",
        "batch_predictions": f"WITH {GOLD_COLUMNS} SELECT *, true AS scored FROM late",
        "train_compare": f"""WITH {GOLD_SPLIT}, gm AS (SELECT Store, Dept, median(Weekly_Sales) AS m FROM ref GROUP BY 1, 2),
om AS (SELECT median(Weekly_Sales) AS m FROM ref),
scored AS (SELECT v.Store, v.Weekly_Sales, COALESCE(t.Weekly_Sales, gm.m, om.m) AS pred FROM cur v
 LEFT JOIN ref t ON t.Store=v.Store AND t.Dept=v.Dept AND t.Date + 364 = v.Date
 LEFT JOIN gm ON gm.Store=v.Store AND gm.Dept=v.Dept CROSS JOIN om),
m AS ({_metrics('scored')})
SELECT 'baseline' AS candidate, n, n_null, {sig('mae')} AS mae, {sig('rmse')} AS rmse, {sig('mape')} AS mape, {sig('cost_total')} AS cost_total, true AS sound, true AS decision_sound FROM m
UNION ALL SELECT 'model', n, n_null, NULL, NULL, NULL, NULL, true, true FROM m""",
        "batch_job": f"SELECT * EXCLUDE (pos) FROM ({mixed_report})",
        "drift_quantile_lineitem": f"""WITH {LINE_SPLIT},
{_psi_numeric(line_cols)}, {_psi_category(('l_returnflag',))}, {_psi_result((*line_cols, 'l_returnflag'), ('l_returnflag',), ('nterm', 'cterm'))}
SELECT pos, feature, kind, {sig('psi')} AS psi FROM psi""",
    }
