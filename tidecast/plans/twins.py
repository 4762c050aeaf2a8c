"""SQL twins of the registered queries, written independently of the DataFrame plans.

They run on the same tables in a plain SQL engine and are compared value by
value with the Spark results.
"""

from __future__ import annotations

D = 4

# Results go on a decimal grid (floor of the value plus a fixed part of a unit), as
# the Spark side does, so that the last bits of a floating sum do not decide a match.
LAGS = (1, 2, 3, 4, 5, 6, 7, 14, 21)

CENTS = "CAST(round({}*100) AS BIGINT)"

SO = f"""so AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
         SUM({CENTS.format('o_totalprice')})::BIGINT / 100.0::DOUBLE AS y
  FROM orders GROUP BY 1, 2)"""

SC = f"""so AS (
  SELECT o_custkey AS series_id, CAST(o_orderdate AS DATE) AS date,
         SUM({CENTS.format('o_totalprice')})::BIGINT / 100.0::DOUBLE AS y
  FROM orders GROUP BY 1, 2)"""


def fill(src: str = "so", out: str = "filled") -> str:
    """Spine joined to the data, neighbours by ignoring nulls: a different route than the Spark plan."""
    return f"""
{out}_span AS (SELECT series_id, min(date) AS a, max(date) AS b FROM {src} GROUP BY 1),
{out}_days AS (SELECT series_id, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date
               FROM {out}_span),
{out}_j AS (
  SELECT d.series_id, d.date, s.y,
    last_value(s.y IGNORE NULLS) OVER bk AS py,
    last_value(CASE WHEN s.y IS NOT NULL THEN d.date END IGNORE NULLS) OVER bk AS pd,
    first_value(s.y IGNORE NULLS) OVER fw AS ny,
    first_value(CASE WHEN s.y IS NOT NULL THEN d.date END IGNORE NULLS) OVER fw AS nd
  FROM {out}_days d LEFT JOIN {src} s ON d.series_id = s.series_id AND d.date = s.date
  WINDOW bk AS (PARTITION BY d.series_id ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         fw AS (PARTITION BY d.series_id ORDER BY d.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{out} AS (
  SELECT series_id, date,
    CASE WHEN y IS NOT NULL THEN y WHEN py IS NULL THEN ny WHEN ny IS NULL THEN py
         ELSE py + (ny - py) * (date - pd) / (nd - pd) END AS y,
    y IS NULL AS is_filled
  FROM {out}_j)"""


FILLED = f"{SO},{fill()}"
FILLED_C = f"{SC},{fill()}"

HORIZON = "CASE WHEN isodow({0}) = 7 THEN 7 ELSE 7 - isodow({0}) END::INT"


def lag_list(alias: str = "f") -> str:
    return ", ".join(f"lag({alias}.y, {k}) OVER w AS lag_{k}" for k in range(1, 22))


def history() -> str:
    """h0 is the value of the day itself, hk the value k days before."""
    cols = ", ".join(f"lag(y, {k}) OVER w AS h{k}" for k in range(1, 21))
    return f"""hist AS (SELECT series_id, date, y AS h0, {cols}, is_filled, row_number() OVER w AS n
  FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY date))"""


def path_sql(src: str, keep: str) -> str:
    """Iterated lag mean p1..p7 over an origin relation with h0..h20, one nested query per step."""
    q = src
    for step in range(1, 8):
        terms = []
        for k in LAGS:
            back = step - k
            terms.append(f"p{back}" if back >= 1 else f"h{-back}")
        q = f"(SELECT *, ({' + '.join(terms)}) / 9 AS p{step} FROM {q})"
    picks = " ".join(f"WHEN {s} THEN p{s}" for s in range(1, 8))
    return f"SELECT {keep}, s.step, CASE s.step {picks} END AS predicted FROM {q} o, steps s"


STEPS = "steps AS (SELECT unnest(generate_series(1, 7))::INT AS step)"
SEASONAL = "CASE s.step " + " ".join(f"WHEN {s} THEN h{7 - s}" for s in range(1, 8)) + " END"
LAG3 = "(h6 + h13 + h20) / 3"

CUTS = f"""
bounds AS (SELECT series_id, min(date) AS a, max(date) AS b FROM filled GROUP BY 1),
cands AS (
  SELECT f.series_id, f.date AS train_end, {HORIZON.format('f.date')} AS horizon,
         row_number() OVER (PARTITION BY f.series_id ORDER BY f.date DESC)::INT AS cutoff_rank
  FROM filled f JOIN bounds USING (series_id)
  WHERE NOT f.is_filled AND f.date >= a + 30 AND f.date + {HORIZON.format('f.date')} <= b),
cuts AS (SELECT * FROM cands WHERE cutoff_rank <= 10)"""


def detail_from(filled: str) -> str:
    return f"""{filled}, {STEPS}, {CUTS}, {history()},
cut_hist AS (SELECT c.series_id, c.train_end, c.horizon, h.* EXCLUDE (series_id, date, is_filled)
  FROM cuts c JOIN hist h ON h.series_id = c.series_id AND h.date = c.train_end WHERE h.n >= 21),
guesses AS (
  SELECT series_id, train_end, horizon, 'single' AS mode, 1 AS step, h6 AS predicted FROM cut_hist
  UNION ALL
  SELECT series_id, train_end, horizon, 'multi', s.step, {LAG3} FROM cut_hist, steps s WHERE s.step <= horizon
  UNION ALL
  SELECT series_id, train_end, horizon, 'iterative', step, predicted FROM ({path_sql('cut_hist', 'series_id, train_end, horizon')})
  WHERE step <= horizon),
detail AS (
  SELECT g.series_id, g.train_end, g.mode, g.train_end + g.step AS target_date, g.step, g.predicted, s.y AS actual,
         g.predicted - s.y AS error, abs(g.predicted - s.y) AS abs_error, (g.predicted - s.y) * (g.predicted - s.y) AS squared_error
  FROM guesses g JOIN so s ON s.series_id = g.series_id AND s.date = g.train_end + g.step)"""


DETAIL = detail_from(FILLED)
PIVOT = DETAIL + """,
pv AS (SELECT series_id, train_end, target_date, step, actual,
  avg(predicted) FILTER (mode = 'single') AS single_predicted, avg(error) FILTER (mode = 'single') AS single_error,
  avg(predicted) FILTER (mode = 'multi') AS multi_predicted, avg(error) FILTER (mode = 'multi') AS multi_error,
  avg(predicted) FILTER (mode = 'iterative') AS iterative_predicted, avg(error) FILTER (mode = 'iterative') AS iterative_error
  FROM detail GROUP BY ALL)"""

#: Scaled values up to each cutoff (rank 0: the last day), numbered from the first day on.
LABELS = """ends AS (SELECT series_id, cutoff_rank AS rank, train_end AS upto FROM cuts UNION ALL SELECT series_id, 0, b FROM bounds),
days AS (SELECT series_id, date, y, row_number() OVER (PARTITION BY series_id ORDER BY date) AS n FROM filled),
ranges AS (SELECT series_id, rank, upto, min(y) AS lo, max(y) AS hi FROM ends JOIN days USING (series_id) WHERE date <= upto GROUP BY ALL),
labels AS (SELECT rank, n, CASE WHEN hi > lo THEN (y - lo) / (hi - lo) ELSE 0 END AS v FROM days JOIN ranges USING (series_id) WHERE date <= upto)"""

ORIGIN = f"""{FILLED}, {STEPS}, {history()},
origin AS (SELECT h.* EXCLUDE (date, is_filled, n), h.date AS origin, {HORIZON.format('h.date')} AS horizon FROM hist h
  JOIN (SELECT series_id, max(date) AS date FROM filled GROUP BY 1) m USING (series_id, date) WHERE n >= 21)"""


def r(col: str, digits: int = D, name: str | None = None) -> str:
    return f"floor(({col}) * 1e{digits} + 0.381966e0) / 1e{digits} AS {name or col.split('.')[-1]}"


METRICS = """count(error) AS count, floor((avg(abs_error)) * 1e3 + 0.381966e0) / 1e3 AS "MAE", floor((avg(squared_error) / 1e6) * 1e3 + 0.381966e0) / 1e3 AS "MSE",
  floor((avg(error)) * 1e3 + 0.381966e0) / 1e3 AS "MeanError" """


def overall(keys: str = "") -> str:
    """Every mode shows up, also one without rows."""
    from_keys = f"(SELECT DISTINCT {keys} FROM detail), " if keys else ""
    lead = f"{keys}, " if keys else ""
    using = f"USING ({keys}, mode)" if keys else "USING (mode)"
    return f"""WITH {DETAIL},
m AS (SELECT * FROM {from_keys}(SELECT unnest(['single', 'multi', 'iterative']) AS mode))
SELECT {lead}mode, {METRICS}, floor((avg(error)) * 1e3 + 0.381966e0) / 1e3 AS "MSAE" FROM m LEFT JOIN detail {using} GROUP BY {lead}mode"""


def sweep(keys: str = "", bias: str | None = None) -> str:
    lead = f"{keys}, " if keys else ""
    prefix = f", gb AS (SELECT {lead}-avg(iterative_predicted - actual) AS bias FROM pv {'GROUP BY ' + keys if keys else ''})" if bias else ""
    src = ("pv" if not bias else f"pv JOIN gb USING ({keys})" if keys else "pv, gb")
    add = " + bias" if bias else ""
    return f"""WITH {PIVOT}{prefix},
x AS (SELECT {('pv.' if bias and not keys else '') + 'series_id'}, s.step AS switch,
   CASE WHEN t.step <= s.step THEN iterative_predicted{add} ELSE multi_predicted END - actual AS e
  FROM (SELECT * FROM {src}) t, steps s)
SELECT {lead}switch, floor((avg(abs(e))) * 1e3 + 0.381966e0) / 1e3 AS "MAE", floor((avg(e * e) / 1e6) * 1e3 + 0.381966e0) / 1e3 AS "MSE", floor((avg(e)) * 1e3 + 0.381966e0) / 1e3 AS "MeanError"
FROM x GROUP BY {lead}switch""".replace("pv.series_id", "series_id")


def best_sql(keys: str = "", horizon: str = "7", out: str = "bs") -> str:
    hz = ""
    if keys:
        h = HORIZON.format("max(date)") if horizon != "7" else "7"
        hz = f"hz AS (SELECT series_id, {h} AS horizon FROM so WHERE series_id IN (SELECT series_id FROM detail) GROUP BY 1),"
    lead = "series_id, " if keys else ""
    base = "hz" if keys else "(SELECT 7 AS horizon)"
    match = "AND c.series_id = g.series_id" if keys else ""
    return f"""{hz}
costs AS (SELECT {lead}mode, step, avg(abs_error) AS mae FROM detail WHERE mode IN ('iterative', 'multi') GROUP BY ALL),
grid AS (SELECT b.*, sw.step AS switch, st.step AS step FROM {base} b, steps sw, steps st
  WHERE sw.step <= b.horizon AND st.step <= b.horizon),
totals AS (
  SELECT {'g.series_id, ' if keys else ''}g.switch, sum(coalesce(c.mae, 'infinity'::DOUBLE)) AS total
  FROM grid g LEFT JOIN costs c ON c.step = g.step
    AND c.mode = CASE WHEN g.step <= g.switch THEN 'iterative' ELSE 'multi' END {match}
  GROUP BY ALL),
{out} AS (SELECT {lead}switch FROM (
  SELECT *, row_number() OVER ({'PARTITION BY series_id ' if keys else ''}ORDER BY total, switch) AS rn FROM totals) WHERE rn = 1)"""


TREND_FITS = """fits AS (SELECT c.series_id, c.train_end, c.horizon, regr_slope(f.y, f.date - DATE '2000-01-01') AS a, regr_intercept(f.y, f.date - DATE '2000-01-01') AS b
  FROM cuts c JOIN filled f ON f.series_id = c.series_id AND f.date <= c.train_end GROUP BY 1, 2, 3)"""
TREND_SCORED = """scored AS (SELECT t.series_id, t.train_end, t.train_end + s.step AS target_date, s.step,
  b + a * (t.train_end + s.step - DATE '2000-01-01') AS predicted, so.y AS actual
  FROM fits t JOIN steps s ON s.step <= t.horizon JOIN so ON so.series_id = t.series_id AND so.date = t.train_end + s.step)"""

FORECASTS = f"""
it AS (SELECT * FROM ({path_sql('origin', 'series_id, origin, horizon')}) WHERE step <= horizon),
mu AS (SELECT series_id, origin, step, {LAG3} AS predicted FROM origin, steps WHERE step <= horizon)"""


def hybrid(switch: str, join: str = "") -> str:
    return f"""hybrid AS (
  SELECT it.series_id, it.origin, it.step, it.origin + it.step AS target_date, ({switch})::INT AS switch,
    CASE WHEN it.step <= {switch} THEN it.predicted ELSE mu.predicted END AS predicted
  FROM it JOIN mu USING (series_id, origin, step) {join})"""


LOG = """log AS (SELECT user_id::VARCHAR AS series_id, ts::DATE AS target_date, value AS predicted, ts AS predicted_at FROM events)"""
ACTUALS = f"""actuals AS (SELECT user_id::VARCHAR AS series_id, ts::DATE + 7 AS date,
  SUM({CENTS.format('value')})::BIGINT / 100.0::DOUBLE AS y FROM events GROUP BY 1, 2)"""
LATEST = """latest AS (SELECT series_id, target_date, arg_max(predicted, predicted_at) FILTER (predicted IS NOT NULL) AS predicted,
  max(predicted_at) AS predicted_at FROM log GROUP BY 1, 2)"""
WEEK = """
weeks AS (SELECT series_id, date_trunc('week', max(target_date))::DATE AS week_start FROM log GROUP BY 1),
spine AS (SELECT series_id, week_start, week_start + k::INT AS date FROM weeks, (SELECT unnest(generate_series(0, 6)) AS k)),
wk AS (
  SELECT s.series_id, s.week_start, s.date,
    CASE WHEN l.target_date IS NOT NULL THEN l.predicted ELSE a.y END AS ridership,
    CASE WHEN l.target_date IS NOT NULL THEN 'predicted' WHEN a.y IS NOT NULL THEN 'actual' END AS data_type,
    bool_or(l.target_date IS NULL) OVER (PARTITION BY s.series_id) AS has_mixed_data
  FROM spine s LEFT JOIN latest l ON l.series_id = s.series_id AND l.target_date = s.date
  LEFT JOIN actuals a ON a.series_id = s.series_id AND a.date = s.date)"""
WEEKLY = f"{LOG}, {ACTUALS}, {LATEST}, {WEEK}"

NUMBERS = f"""series_id, {r('avg(ridership)', D, 'daily_average')},
  strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS period_description,
  min(date) AS start_date, max(date) AS end_date, {r('sum(ridership)', D, 'total_period_ridership')},
  count(*)::INT AS num_days, count(*) = 7 AND bool_and(in_week) AS is_complete_week, bool_or(has_mixed_data) AS has_mixed_data,
  {r('min(ridership)', D, 'min_daily')}, {r('max(ridership)', D, 'max_daily')}"""

WEEK_ROWS = "wr AS (SELECT *, true AS in_week FROM wk WHERE ridership IS NOT NULL)"

# The holiday rules as (name, month, kind, a, b, first year, observed).
HOLIDAYS = """
rules(name, m, kind, a, b, since, obs) AS (VALUES
  ('New Year''s Day', 1, 'day', 1, 0, 1871, true),
  ('Martin Luther King Jr. Day', 1, 'nth', 1, 3, 1986, false),
  ('Lincoln''s Birthday', 2, 'day', 12, 0, 1971, true),
  ('Susan B. Anthony Day', 2, 'day', 15, 0, 2004, false),
  ('Washington''s Birthday', 2, 'nth', 1, 3, 1971, false),
  ('Memorial Day', 5, 'last', 1, 0, 1971, false),
  ('Juneteenth National Independence Day', 6, 'day', 19, 0, 2021, true),
  ('Independence Day', 7, 'day', 4, 0, 1871, true),
  ('Labor Day', 9, 'nth', 1, 1, 1894, false),
  ('Columbus Day', 10, 'nth', 1, 2, 1971, false),
  ('Election Day', 11, 'after', 2, 2, 2015, false),
  ('Veterans Day', 11, 'day', 11, 0, 1978, true),
  ('Thanksgiving Day', 11, 'nth', 4, 4, 1942, false),
  ('Christmas Day', 12, 'day', 25, 0, 1871, true)),
firsts AS (SELECT r.*, y, make_date(y, m, 1) AS f FROM rules r, (SELECT unnest(generate_series(1990, 2030))::INT AS y) WHERE y >= since),
named AS (SELECT name, obs, CASE kind
    WHEN 'day' THEN make_date(y, m, a)
    WHEN 'nth' THEN f + ((a - isodow(f) + 7) % 7)::INT + 7 * (b - 1)
    WHEN 'last' THEN last_day(f) - ((isodow(last_day(f)) - a + 7) % 7)::INT
    ELSE f + 1 + ((a - isodow(f + 1) + 7) % 7)::INT END AS date FROM firsts),
allh AS (SELECT name, date, 0 AS late FROM named
  UNION ALL SELECT name || ' (observed)', CASE isodow(date) WHEN 6 THEN date - 1 ELSE date + 1 END, 1
  FROM named WHERE obs AND isodow(date) IN (6, 7)),
hol AS (SELECT date, arg_min(name, late) AS holiday_name FROM allh GROUP BY 1)"""

CALENDAR = (
    ", ".join(f"(isodow(date) = {k + 1})::INT AS dow_{k}" for k in range(7))
    + ", "
    + ", ".join(f"(month(date) = {k})::INT AS month_{k}" for k in range(1, 13))
    + ", (isodow(date) >= 6)::INT AS is_weekend, (date IN (SELECT date FROM hol))::INT AS is_holiday"
)

STATIONS = """st AS (SELECT l_returnflag AS station_id, l_shipdate::DATE AS date, max(l_quantity) AS tmax, min(l_quantity) AS tmin,
  sum(l_quantity) FILTER (l_discount >= 0.1) AS prcp FROM lineitem GROUP BY 1, 2)"""


def observed(src: str = "st") -> str:
    return f"""obs AS (SELECT station_id, date, tmax * 9.0::DOUBLE / 5.0 + 32.0 AS tmax_f, tmin * 9.0::DOUBLE / 5.0 + 32.0 AS tmin_f,
  coalesce(prcp, 0)::DOUBLE / 25.4::DOUBLE AS prcp_in, 0.0::DOUBLE AS snow_in FROM {src})"""


def runs(src: str, out: str, key: str = "station_id") -> str:
    """Gaps and islands by numbered change points; a missing day is one."""
    return f"""{out}_f AS (SELECT *, coalesce(prcp_in > 0, false) AS wet FROM {src}),
{out}_c AS (SELECT *, CASE WHEN wet IS DISTINCT FROM lag(wet) OVER (PARTITION BY {key} ORDER BY date)
  OR date IS DISTINCT FROM lag(date) OVER (PARTITION BY {key} ORDER BY date) + 1 THEN 1 ELSE 0 END AS ch FROM {out}_f),
{out}_g AS (SELECT *, sum(ch) OVER (PARTITION BY {key} ORDER BY date ROWS UNBOUNDED PRECEDING) AS g FROM {out}_c),
{out} AS (SELECT *, CASE WHEN wet THEN row_number() OVER (PARTITION BY {key}, g ORDER BY date) ELSE 0 END::INT AS wet_streak,
  CASE WHEN NOT wet THEN row_number() OVER (PARTITION BY {key}, g ORDER BY date) ELSE 0 END::INT AS dry_streak FROM {out}_g)"""


def weather_features() -> str:
    """Frames over day numbers, so that a missing day counts."""
    parts = []

    def frame(begin: int, end: int) -> str:
        return f"(PARTITION BY station_id ORDER BY date - DATE '1970-01-01' RANGE BETWEEN {begin} PRECEDING AND {end} PRECEDING)"

    for m in ("tmax_f", "tmin_f", "prcp_in"):
        parts += [f"max({m}) OVER {frame(k, k)} AS {m}_l{k}" for k in (1, 2, 3, 7, 14)]
        for n in (3, 7, 14):
            for fn, tag in (("avg", "ma"), ("stddev_samp", "std")):
                parts.append(f"CASE WHEN count({m}) OVER {frame(n - 1, 0)} = {n} THEN {fn}({m}) OVER {frame(n - 1, 0)} END AS {m}_{tag}{n}")
    return ",\n".join(parts)


WINDOW_FEATURES = [
    f"{m}_{s}"
    for m in ("tmax_f", "tmin_f", "prcp_in")
    for s in (["l1", "l2", "l3", "l7", "l14"] + [f"{t}{n}" for n in (3, 7, 14) for t in ("ma", "std")])
]

FRAME = f"""{runs('obs', 'sk')},
frame AS (SELECT station_id, date, date + 1 AS target_date, {weather_features()},
  sin(2 * pi() * dayofyear(date) / 366.0::DOUBLE) AS doy_sin, cos(2 * pi() * dayofyear(date) / 366.0::DOUBLE) AS doy_cos,
  month(date)::INT AS month, wet_streak, dry_streak,
  CASE WHEN lead(date) OVER w = date + 1 THEN lead(tmax_f) OVER w END AS y_tmax_f, CASE WHEN lead(date) OVER w = date + 1 THEN lead(tmin_f) OVER w END AS y_tmin_f,
  CASE WHEN lead(date) OVER w = date + 1 THEN coalesce(lead(prcp_in) OVER w > 0, false)::INT END AS y_rain_yn,
  tmax_f, tmin_f, prcp_in, snow_in
  FROM sk WINDOW w AS (PARTITION BY station_id ORDER BY date))"""


def shown(cols: list[str]) -> str:
    return ", ".join(r(c) for c in cols)


def not_null(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


EVENT_STATIONS = """st AS (SELECT event_type AS station_id, ts::DATE AS date, max(value) AS tmax, min(value) AS tmin,
  max(value) FILTER (value > 100) AS prcp FROM events GROUP BY 1, 2)"""
LOCAL = "(({0} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"
HOURLY = f"""hr AS (SELECT event_type AS station_id, {LOCAL.format("(date_trunc('second', ts) + to_hours(o))")}::DATE AS date,
    value AS temp, (props::JSON->>'k')::DOUBLE AS pop, CASE WHEN event_type <> 'click' THEN value + o END AS gust
  FROM events, (SELECT unnest([0, 1])::INT AS o) WHERE event_type <> 'error'),
hd AS (SELECT station_id, date, max(temp) AS nws_tmax_f, min(temp) AS nws_tmin_f, max(pop) AS nws_pop_max, max(gust) AS nws_windgust_max
  FROM hr GROUP BY 1, 2)"""
DAILY = """dd AS (
  SELECT station_id, date + 100 * o AS date, (tmax + o) * 9.0::DOUBLE / 5.0 + 32.0 AS om_tmax_f, (tmin + o) * 9.0::DOUBLE / 5.0 + 32.0 AS om_tmin_f,
    (CASE o WHEN 0 THEN tmax ELSE tmin END) / 25.4::DOUBLE AS om_prcp_in, CASE o WHEN 0 THEN 50.0 ELSE 75.0 END::DOUBLE AS om_pop_max,
    (CASE o WHEN 0 THEN tmin ELSE tmax END) * 2.23694::DOUBLE AS om_windgust_mph
  FROM st, (SELECT unnest([0, 1])::INT AS o))"""

TRADES = "tr AS (SELECT event_id AS trade_id, event_type AS ticker, floor(epoch(ts))::BIGINT AS ts FROM events)"
MESSAGES = """SELECT event_id, CASE WHEN event_type = 'error' THEN left(props, 4) ELSE props END AS message,
  CASE WHEN event_type <> 'error' THEN (props::JSON->>'k')::INT END AS k, event_type = 'error' AS is_bad FROM events"""

RAW = """raw AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS date, o_orderpriority AS mode,
  CASE WHEN day(o_orderdate) <> 13 THEN o_totalprice END AS y FROM orders)"""

WEEKLY_JOB = f"""{DETAIL}, {history().replace('hist AS', 'hist2 AS')},
origin AS (SELECT h.* EXCLUDE (date, is_filled, n), h.date AS origin, {HORIZON.format('h.date')} AS horizon FROM hist2 h
  JOIN (SELECT series_id, max(date) AS date FROM filled GROUP BY 1) m USING (series_id, date) WHERE n >= 21),
{best_sql('series_id', 'own')},
wb AS (SELECT series_id, isodow(target_date) - 1 AS wd, -avg(error) AS bias FROM detail WHERE mode = 'iterative' GROUP BY 1, 2),
{FORECASTS},
itb AS (SELECT it.series_id, it.origin, it.step, it.predicted + coalesce(wb.bias, 0) AS predicted FROM it
  LEFT JOIN wb ON wb.series_id = it.series_id AND wb.wd = isodow(it.origin + it.step) - 1),
hybrid AS (SELECT i.series_id, i.origin + i.step AS target_date,
    CASE WHEN i.step <= coalesce(bs.switch, greatest(1, {HORIZON.format('i.origin')} // 2)) THEN i.predicted ELSE mu.predicted END AS predicted
  FROM itb i JOIN mu USING (series_id, origin, step) LEFT JOIN bs USING (series_id))"""


def lines(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().strip(",") for c in ctes if c) + "\n" + select


def build() -> dict[str, str]:
    lag_cols = ", ".join(r(f"lag_{k}") for k in LAGS)
    lagged = f"lg AS (SELECT series_id, date, y, {lag_list('filled')} FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY date))"
    sql = {
        "clean_contains": lines("SELECT 'high' AS series_id, date, y FROM raw WHERE lower(mode) LIKE '%high%' AND date IS NOT NULL AND y IS NOT NULL", RAW),
        "clean_daily": lines(
            f"SELECT mode AS series_id, date, sum({CENTS.format('y')})::BIGINT / 100.0::DOUBLE AS y FROM raw "
            "WHERE date IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2", RAW),
        "clean_dates": """SELECT o_orderdate::DATE AS date, count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders
  WHERE day(o_orderdate) NOT BETWEEN 1 AND 6 AND o_orderdate::DATE BETWEEN '1996-01-01' AND '1999-12-31' GROUP BY 1""",
        "coerce_values": """SELECT p_partkey, try_cast(p_name AS DOUBLE) AS name_number, try_cast(p_retailprice AS DOUBLE) AS price,
  try_cast(regexp_extract(p_brand, '#(.*)$', 1) AS DOUBLE) AS brand_number, coalesce(try_cast(p_type AS DOUBLE), 0) AS type_number FROM part""",
        "day_parts": f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, (isodow(o_orderdate) - 1)::INT AS weekday,
  month(o_orderdate)::INT AS month, dayofyear(o_orderdate)::INT AS day_of_year, dayname(o_orderdate) AS day_name,
  date_trunc('week', o_orderdate)::DATE AS week_start, {HORIZON.format('o_orderdate')} AS days_to_sunday FROM orders""",
        "tz_local_day": f"SELECT event_id, {LOCAL.format('ts')} AS local_ts, {LOCAL.format('ts')}::DATE AS local_date, {LOCAL.format('ts')}::DATE + 1 AS tomorrow FROM events",
        "unit_convert": f"""SELECT l_orderkey, l_linenumber, {r('l_quantity * 9.0::DOUBLE / 5.0 + 32.0', D, 'fahrenheit')},
  {r('l_quantity / 25.4::DOUBLE', D, 'inches')}, {r('l_quantity * 2.23694::DOUBLE', D, 'mph')} FROM lineitem""",
        "newest_days": "SELECT DISTINCT o_orderdate::DATE AS date FROM orders ORDER BY 1 DESC LIMIT 10",
        "ridership_scan": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') END AS date,
  o_orderpriority AS mode, CASE WHEN day(o_orderdate) = 13 THEN 'n/a' ELSE o_totalprice::VARCHAR END AS count
  FROM orders WHERE o_orderpriority = '2-HIGH'""",
        "actuals_on_days": lines("SELECT * FROM so WHERE date IN ('1997-05-28', '1998-10-03', '1999-01-16', '2030-01-01')", SO),
        "counts_on_days": """SELECT o_orderdate::DATE AS date, '1-URGENT' AS mode, count(*) AS count FROM orders WHERE o_orderpriority = '1-URGENT'
  AND o_orderdate::DATE IN (SELECT l_shipdate::DATE FROM lineitem WHERE l_quantity = 50 AND day(l_shipdate) = 13) GROUP BY 1""",
        "daily_series": lines("SELECT * FROM so", SO),
        "gap_fill": lines(f"SELECT series_id, date, {r('y')}, is_filled FROM filled", FILLED),
        "gap_fill_customers": lines(
            "SELECT series_id, count(*) AS n_days, count(*) FILTER (is_filled) AS n_filled, floor((sum(y) / 1000.0) * 1e4 + 0.381966e0) / 1e4 AS total FROM filled GROUP BY 1", FILLED_C),
        "gap_fill_ends": lines(
            f"SELECT series_id, date, {r('y')}, is_filled FROM filled", SO,
            "masked AS (SELECT series_id, date, CASE WHEN month(date) NOT IN (1, 8) THEN y END AS y FROM so)", fill("masked")),
        "series_span": lines("SELECT series_id, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows FROM so GROUP BY 1", SO),
        "series_cut": lines("SELECT * FROM so WHERE date BETWEEN '1998-01-01' AND '1999-12-31'", SO),
        "trailing_avg7": lines(
            """SELECT series_id, date, y, CASE WHEN count(y) OVER w = 7 THEN floor((avg(y) OVER w) * 1e4 + 0.381966e0) / 1e4 END AS avg7 FROM so
  WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", SO),
        "lag_features": lines(f"SELECT series_id, date, {r('y')}, {lag_cols} FROM lg", FILLED, lagged),
        "calendar_features": lines(f"SELECT series_id, date, {CALENDAR} FROM so", SO, HOLIDAYS),
        "calendar_from_table": lines(
            "SELECT series_id, date, (isodow(date) >= 6)::INT AS is_weekend, (date IN (SELECT date FROM hol))::INT AS is_holiday FROM so", SO, HOLIDAYS),
        "future_calendar": lines(
            f"SELECT series_id, date, {CALENDAR}, holiday_name FROM sp LEFT JOIN hol USING (date)", SO, HOLIDAYS,
            "sp AS (SELECT series_id, CAST(unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM so GROUP BY series_id)"),
        "horizon_sunday": lines(f"SELECT series_id, max(date) AS origin, {HORIZON.format('max(date)')} AS horizon FROM so GROUP BY 1", SO),
        "scaled_target": lines(
            """SELECT series_id, date, floor(((y - lo) / (hi - lo)) * 1e6 + 0.381966e0) / 1e6 AS y_scaled, floor((y) * 1e3 + 0.381966e0) / 1e3 AS y_back FROM filled
  JOIN (SELECT series_id, min(y) AS lo, max(y) AS hi FROM filled GROUP BY 1) USING (series_id)""", FILLED),
        "supervised_frame": lines(f"SELECT series_id, date, {r('y')}, {lag_cols}, {CALENDAR} FROM lg WHERE lag_21 IS NOT NULL", FILLED, lagged, HOLIDAYS),
        "fc_next_day": lines(f"SELECT series_id, origin, 1 AS step, origin + 1 AS target_date, {r('h6', D, 'predicted')} FROM origin", ORIGIN),
        "fc_seasonal_naive": lines(
            f"SELECT series_id, origin, s.step, origin + s.step AS target_date, {r(SEASONAL, D, 'predicted')} FROM origin, steps s WHERE s.step <= horizon", ORIGIN),
        "fc_lag_mean_iterative": lines(f"SELECT series_id, origin, step, origin + step AS target_date, {r('predicted')} FROM it", ORIGIN, FORECASTS),
        "fc_lag_mean_direct": lines(f"SELECT series_id, origin, step, origin + step AS target_date, {r('predicted')} FROM mu", ORIGIN, FORECASTS),
        "fc_trend": lines(
            f"""SELECT series_id, origin, step, origin + step AS target_date, floor((b + a * (origin + step - DATE '2000-01-01')) * 1e4 + 0.381966e0) / 1e4 AS predicted
  FROM (SELECT series_id, max(date) AS origin, regr_slope(y, date - DATE '2000-01-01') AS a, regr_intercept(y, date - DATE '2000-01-01') AS b FROM filled GROUP BY 1), steps
  WHERE step <= {HORIZON.format('origin')}""", FILLED, STEPS),
        "trend_line": lines(
            """SELECT series_id, date, floor((a) * 1e4 + 0.381966e0) / 1e4 AS slope, floor((b + a * (date - DATE '2000-01-01')) * 1e4 + 0.381966e0) / 1e4 AS level FROM (
  SELECT series_id, date, regr_slope(y, date - DATE '2000-01-01') OVER w AS a, regr_intercept(y, date - DATE '2000-01-01') OVER w AS b, count(*) OVER w AS n FROM filled
  WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WHERE n > 1""", FILLED),
        "holdout_last_day": lines(
            """SELECT series_id, date AS target_date, floor((p) * 1e4 + 0.381966e0) / 1e4 AS predicted, floor((y) * 1e4 + 0.381966e0) / 1e4 AS actual, floor((abs(p - y)) * 1e4 + 0.381966e0) / 1e4 AS abs_error, floor((abs(p - y) / y * 100.0) * 1e4 + 0.381966e0) / 1e4 AS pct_error
  FROM (SELECT *, (lag_1 + lag_2 + lag_3 + lag_4 + lag_5 + lag_6 + lag_7 + lag_14 + lag_21) / 9 AS p FROM lg)
  JOIN (SELECT series_id, max(date) AS date FROM filled GROUP BY 1) USING (series_id, date)""", FILLED, lagged),
        "backtest_cutoffs": lines("SELECT series_id, train_end, cutoff_rank, horizon FROM cuts", FILLED, CUTS),
        "backtest_detail": lines(
            f"SELECT series_id, train_end, mode, target_date, step, {shown(['predicted', 'actual', 'error', 'abs_error'])}, {r('squared_error', 1)} FROM detail", DETAIL),
        "detail_csv": lines(
            f"SELECT series_id, train_end, mode, target_date, step, {shown(['predicted', 'actual', 'error', 'abs_error', 'squared_error'])} FROM detail", DETAIL),
        "backtest_customers": lines(
            f"SELECT series_id, train_end, mode, target_date, step, {shown(['predicted', 'actual', 'error', 'abs_error'])} FROM detail", detail_from(FILLED_C)),
        "backtest_trend": lines(
            f"SELECT series_id, train_end, 'trend' AS mode, target_date, step, {shown(['predicted', 'actual'])}, {r('predicted - actual', D, 'error')}, {r('abs(predicted - actual)', D, 'abs_error')} FROM scored",
            FILLED, STEPS, CUTS,
            TREND_FITS, TREND_SCORED),
        "backtest_skipped": lines(
            f"""SELECT series_id, date AS train_end, mode, 'fewer than 21 days of history' AS reason FROM hist JOIN (SELECT series_id, max(date) AS b FROM filled GROUP BY 1) USING (series_id),
  (SELECT unnest(['single', 'multi', 'iterative']) AS mode) WHERE NOT is_filled AND n < 21 AND date + {HORIZON.format('date')} <= b""", FILLED, history()),
        "scored_predictions": lines(
            f"SELECT series_id, train_end, mode, target_date, step, {shown(['predicted', 'actual', 'error', 'abs_error'])} FROM detail", DETAIL),
        "scored_predictions_doubled": lines(
            f"SELECT series_id, train_end, mode, target_date, step, {shown(['predicted', 'actual', 'error', 'abs_error'])} FROM detail", DETAIL),
        "overall_metrics_trend": lines(
            f"""SELECT mode, {METRICS}, floor((avg(error)) * 1e3 + 0.381966e0) / 1e3 AS "MSAE" FROM (SELECT unnest(['trend', 'single', 'multi', 'iterative']) AS mode)
  LEFT JOIN (SELECT 'trend' AS mode, predicted - actual AS error, abs(predicted - actual) AS abs_error, (predicted - actual) * (predicted - actual) AS squared_error FROM scored) USING (mode) GROUP BY mode""",
            FILLED, STEPS, CUTS, TREND_FITS, TREND_SCORED),
        "overall_metrics": overall(),
        "overall_metrics_by_series": overall("series_id"),
        "horizon_metrics": lines(f"SELECT mode, step, {METRICS} FROM detail GROUP BY 1, 2", DETAIL),
        "mode_pivot": lines(
            "SELECT series_id, train_end, target_date, step, "
            + shown(["actual"] + [f"{m}_{c}" for m in ("single", "multi", "iterative") for c in ("predicted", "error")]) + " FROM pv", PIVOT),
        "hybrid_sweep": sweep(),
        "hybrid_sweep_calibrated": sweep(bias="global"),
        "hybrid_sweep_by_series": sweep("series_id", bias="own"),
        "global_bias": lines("SELECT series_id, floor((-avg(error)) * 1e3 + 0.381966e0) / 1e3 AS bias FROM detail WHERE mode = 'iterative' GROUP BY 1", DETAIL),
        "bias_by_weekday": lines(
            """SELECT d::INT AS weekday, coalesce(floor((-avg(error)) * 1e3 + 0.381966e0) / 1e3, 0) AS bias FROM (SELECT unnest(generate_series(0, 6)) AS d)
  LEFT JOIN (SELECT * FROM detail WHERE mode = 'iterative') ON isodow(target_date) - 1 = d GROUP BY 1""", DETAIL),
        "bias_by_weekday_series": lines(
            """SELECT k.series_id, d::INT AS weekday, coalesce(floor((-avg(error)) * 1e3 + 0.381966e0) / 1e3, 0) AS bias
  FROM (SELECT DISTINCT series_id FROM detail) k, (SELECT unnest(generate_series(0, 6)) AS d)
  LEFT JOIN (SELECT * FROM detail WHERE mode = 'iterative') t ON isodow(t.target_date) - 1 = d AND t.series_id = k.series_id GROUP BY 1, 2""".replace(
                "FROM (SELECT DISTINCT series_id FROM detail) k, (SELECT unnest(generate_series(0, 6)) AS d)",
                "FROM (SELECT series_id, d FROM (SELECT DISTINCT series_id FROM detail), (SELECT unnest(generate_series(0, 6)) AS d)) k"), DETAIL),
        "bias_before_cutoff": lines(
            """SELECT c.series_id, c.train_end, d::INT AS weekday, coalesce(floor((-avg(t.error)) * 1e3 + 0.381966e0) / 1e3, 0) AS bias
  FROM (SELECT * FROM (SELECT DISTINCT series_id, train_end FROM detail WHERE mode = 'iterative'), (SELECT unnest(generate_series(0, 6)) AS d)) c
  LEFT JOIN (SELECT * FROM detail WHERE mode = 'iterative') t
    ON t.series_id = c.series_id AND t.target_date <= c.train_end AND isodow(t.target_date) - 1 = d GROUP BY 1, 2, 3""", DETAIL),
        "apply_bias": lines(
            """SELECT t.series_id, t.train_end, t.mode, t.target_date, t.step,
  floor((t.predicted + CASE WHEN t.mode = 'iterative' THEN coalesce(wb.bias, 0) ELSE 0 END) * 1e3 + 0.381966e0) / 1e3 AS predicted FROM detail t
  LEFT JOIN (SELECT series_id, isodow(target_date) AS wd, -avg(error) AS bias FROM detail WHERE mode = 'iterative' GROUP BY 1, 2) wb
  ON wb.series_id = t.series_id AND wb.wd = isodow(t.target_date)""", DETAIL),
        "apply_bias_override": lines(
            """SELECT series_id, train_end, mode, target_date, floor((predicted + CASE WHEN mode = 'iterative' THEN 125.5 ELSE 0 END) * 1e3 + 0.381966e0) / 1e3 AS predicted FROM detail""", DETAIL),
        "best_switch": lines("SELECT switch FROM bs", DETAIL, best_sql()),
        "best_switch_by_series": lines("SELECT series_id, switch FROM bs", DETAIL, best_sql("series_id", "own")),
        "compose_hybrid": lines(
            f"SELECT series_id, origin, step, target_date, switch, {r('predicted')} FROM hybrid", DETAIL,
            history().replace("hist AS", "hist2 AS"),
            f"""origin AS (SELECT h.* EXCLUDE (date, is_filled, n), h.date AS origin, {HORIZON.format('h.date')} AS horizon FROM hist2 h
  JOIN (SELECT series_id, max(date) AS date FROM filled GROUP BY 1) m USING (series_id, date) WHERE n >= 21)""",
            best_sql("series_id"), FORECASTS,
            hybrid(f"coalesce(bs.switch, greatest(1, {HORIZON.format('it.origin')} // 2))", "LEFT JOIN bs USING (series_id)")),
        "best_switch_far": lines(
            """SELECT series_id, switch FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY total, switch) AS rn FROM far_totals) WHERE rn = 1""",
            DETAIL,
            """far_rows AS (SELECT series_id, mode, step, abs_error FROM detail UNION ALL SELECT series_id, mode, step + 14, abs_error FROM detail),
far_costs AS (SELECT series_id, mode, step, avg(abs_error) AS mae FROM far_rows WHERE mode IN ('iterative', 'multi') GROUP BY ALL),
far_steps AS (SELECT unnest(generate_series(1, 21))::INT AS step),
far_totals AS (SELECT g.series_id, g.switch, sum(coalesce(c.mae, 'infinity'::DOUBLE)) AS total
  FROM (SELECT s.series_id, a.step AS switch, b.step FROM (SELECT DISTINCT series_id FROM detail) s, far_steps a, far_steps b) g
  LEFT JOIN far_costs c ON c.series_id = g.series_id AND c.step = g.step AND c.mode = CASE WHEN g.step <= g.switch THEN 'iterative' ELSE 'multi' END GROUP BY ALL)"""),
        "compose_hybrid_partial": lines(
            f"SELECT series_id, origin, step, target_date, switch, {r('predicted')} FROM hybrid", ORIGIN, FORECASTS,
            """hybrid AS (SELECT it.series_id, it.origin, it.step, it.origin + it.step AS target_date, least(2, it.horizon)::INT AS switch,
  CASE WHEN it.step <= 2 OR it.series_id IN ('1-URGENT', '3-MEDIUM') THEN it.predicted ELSE mu.predicted END AS predicted
  FROM (SELECT *, {HZ} AS horizon FROM it) it JOIN mu USING (series_id, origin, step))""".replace("{HZ}", HORIZON.format("origin"))),
        "compose_hybrid_override": lines(
            f"SELECT series_id, origin, step, target_date, switch, {r('predicted')} FROM hybrid", ORIGIN, FORECASTS,
            hybrid(f"least(30, {HORIZON.format('it.origin')})")),
        "compose_hybrid_fallback": lines(
            f"SELECT series_id, origin, step, target_date, switch, {r('predicted')} FROM hybrid", ORIGIN, FORECASTS,
            hybrid(f"greatest(1, {HORIZON.format('it.origin')} // 2)")),
        "error_box": lines(
            """SELECT mode, step, count(error) AS count, floor((any_value(q1)) * 1e3 + 0.381966e0) / 1e3 AS q1, floor((any_value(median)) * 1e3 + 0.381966e0) / 1e3 AS median, floor((any_value(q3)) * 1e3 + 0.381966e0) / 1e3 AS q3,
  floor((min(error) FILTER (error BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) * 1e3 + 0.381966e0) / 1e3 AS whisker_low,
  floor((max(error) FILTER (error BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) * 1e3 + 0.381966e0) / 1e3 AS whisker_high
  FROM detail JOIN (SELECT mode, step, quantile_cont(error, 0.25) AS q1, quantile_cont(error, 0.5) AS median, quantile_cont(error, 0.75) AS q3 FROM detail GROUP BY 1, 2)
  USING (mode, step) GROUP BY 1, 2""", DETAIL),
        "residuals": lines(
            """SELECT series_id, mode, train_end, target_date, step, floor((predicted - actual) * 1e4 + 0.381966e0) / 1e4 AS residual FROM detail WHERE mode IN ('iterative', 'multi')""", DETAIL),
        "latest_prediction": lines("SELECT * FROM latest", LOG, LATEST),
        "week_build": lines("SELECT * FROM wk", WEEKLY),
        "week_build_doubled": lines("SELECT * FROM wk", WEEKLY),
        "week_skipped": lines(
            """SELECT series_id, week_start, count(ridership)::INT AS num_days,
  CASE count(ridership) WHEN 0 THEN 'no value in the week' ELSE 'only ' || count(ridership) || ' of 7 days' END AS reason
  FROM wk GROUP BY 1, 2 HAVING count(ridership) < 7""", WEEKLY),
        "week_missing_days": lines(
            "SELECT series_id, date FROM spine s WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.series_id = s.series_id AND l.target_date = s.date)", WEEKLY),
        "week_missing_actuals": lines(
            "SELECT a.* FROM actuals a JOIN spine s USING (series_id, date) WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.series_id = s.series_id AND l.target_date = s.date)", WEEKLY),
        "week_summary": lines(f"SELECT {NUMBERS} FROM wr GROUP BY series_id", WEEKLY, WEEK_ROWS),
        "week_summary_complete": lines(f"SELECT {NUMBERS} FROM wr GROUP BY series_id HAVING count(*) = 7", WEEKLY, WEEK_ROWS),
        "week_all_days": lines(
            f"SELECT {NUMBERS} FROM wr2 GROUP BY series_id",
            LOG.replace("value AS predicted", "CASE WHEN ts < '2024-01-29' THEN value END AS predicted"),
            ACTUALS.replace("FROM events GROUP BY", "FROM events WHERE ts::DATE + 7 < '2024-01-15' GROUP BY"), LATEST, WEEK, WEEK_ROWS,
            """wr2 AS (SELECT series_id, date, ridership, has_mixed_data, in_week FROM wr
  UNION ALL SELECT series_id, target_date, predicted, false, false FROM latest
  WHERE predicted IS NOT NULL AND series_id NOT IN (SELECT series_id FROM wr))"""),
        "week_breakdown": lines(
            """SELECT series_id, dayname(date) AS day_name, max(date) AS date, arg_max(round_even(ridership, 0), date)::BIGINT AS ridership, arg_max(data_type, date) AS data_type
  FROM wr GROUP BY 1, 2""", WEEKLY, WEEK_ROWS),
        "week_json": lines(
            """SELECT series_id, (SELECT strftime(min(date), '%Y-%m-%d') FROM wr x WHERE x.series_id = wr.series_id) AS start_date,
  (SELECT strftime(max(date), '%Y-%m-%d') FROM wr x WHERE x.series_id = wr.series_id) AS end_date, 7 AS num_days,
  dayname(date) AS day_name, strftime(date, '%Y-%m-%d') AS date, round_even(ridership, 0)::BIGINT AS ridership, data_type
  FROM wr WHERE series_id IN (SELECT series_id FROM wr GROUP BY 1 HAVING count(*) = 7)""", WEEKLY, WEEK_ROWS),
        "recent_week": lines(
            """SELECT s.series_id, s.sunday - 6 AS monday, s.sunday, count(DISTINCT l.target_date)::INT AS num_days
  FROM (SELECT series_id, max(target_date) AS sunday FROM log WHERE isodow(target_date) = 7 GROUP BY 1) s
  JOIN log l ON l.series_id = s.series_id AND l.target_date BETWEEN s.sunday - 6 AND s.sunday GROUP BY 1, 2, 3""", LOG),
        "recent_complete_week": lines(
            """SELECT l.*, s.sunday - 6 AS monday, s.sunday
  FROM (SELECT series_id, max(target_date) AS sunday FROM log WHERE isodow(target_date) = 7 GROUP BY 1) s
  JOIN log l ON l.series_id = s.series_id AND l.target_date BETWEEN s.sunday - 6 AND s.sunday
  QUALIFY count(DISTINCT l.target_date) OVER (PARTITION BY l.series_id) = 7""", LOG),
        "summary_upsert": lines(
            """SELECT series_id, strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS period,
  CASE WHEN count(*) = 7 THEN 'complete_week' ELSE 'partial_period' END AS period_type,
  CASE WHEN bool_or(has_mixed_data) THEN 'mixed' ELSE 'predictions_only' END AS data_mix, count(*)::INT AS num_days,
  round_even(round(avg(ridership), 6), 0)::BIGINT AS daily_average_ridership, round_even(round(sum(ridership), 6), 0)::BIGINT AS total_period_ridership, calculation_date
  FROM wr, (SELECT unnest([DATE '2024-02-01', DATE '2024-02-02']) AS calculation_date) GROUP BY series_id, calculation_date""", WEEKLY, WEEK_ROWS),
        "summary_upsert_doubled": lines(
            """SELECT series_id, strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS period,
  CASE WHEN count(*) = 7 THEN 'complete_week' ELSE 'partial_period' END AS period_type,
  CASE WHEN bool_or(has_mixed_data) THEN 'mixed' ELSE 'predictions_only' END AS data_mix, count(*)::INT AS num_days,
  round_even(round(avg(ridership), 6), 0)::BIGINT AS daily_average_ridership, round_even(round(sum(ridership), 6), 0)::BIGINT AS total_period_ridership, DATE '2024-02-01' AS calculation_date
  FROM wr GROUP BY series_id""", WEEKLY, WEEK_ROWS),
        "station_scan": lines(
            "SELECT station_id, date, tmin::DOUBLE AS tmin, tmax::DOUBLE AS tmax, prcp::DOUBLE AS prcp, NULL::DOUBLE AS snow FROM st WHERE date BETWEEN '1996-03-01' AND '1998-02-28'", STATIONS),
        "weather_frame_gaps": lines(
            f"""SELECT station_id, target_date, {shown(WINDOW_FEATURES + ['doy_sin', 'doy_cos'])}, month, wet_streak, dry_streak,
  floor((n_tmax) * 1e4 + 0.381966e0) / 1e4 AS y_tmax_f, floor((n_tmin) * 1e4 + 0.381966e0) / 1e4 AS y_tmin_f, n_rain AS y_rain_yn,
  {shown(['tmax_f', 'tmin_f', 'prcp_in', 'snow_in'])}
  FROM (SELECT frame.*, nx.tmax_f AS n_tmax, nx.tmin_f AS n_tmin, coalesce(nx.prcp_in > 0, false)::INT AS n_rain FROM frame
    JOIN (SELECT station_id AS s, date AS d, tmax_f, tmin_f, prcp_in FROM obs) nx ON nx.s = frame.station_id AND nx.d = frame.date + 1)
  WHERE {not_null(WINDOW_FEATURES + ['n_tmax', 'n_tmin'])}""",
            STATIONS,
            "gaps AS (SELECT station_id, date, CASE WHEN dayofyear(date) % 41 <> 0 THEN tmax END AS tmax, tmin, prcp FROM st WHERE dayofyear(date) % 37 <> 0)",
            observed("gaps"), FRAME),
        "weather_observations": lines(
            f"SELECT station_id, date, {shown(['tmax_f', 'tmin_f', 'prcp_in', 'snow_in'])} FROM obs WHERE date BETWEEN '1996-01-01' AND '2000-12-31'", STATIONS, observed()),
        "weather_streaks": lines("SELECT station_id, date, wet_streak, dry_streak FROM sk", STATIONS, observed(), runs("obs", "sk")),
        "order_streaks": lines(
            "SELECT station_id, date, wet_streak, dry_streak FROM sk",
            "o AS (SELECT o_custkey AS station_id, o_orderdate::DATE AS date, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 END) AS prcp_in FROM orders GROUP BY 1, 2)",
            runs("o", "sk")),
        "weather_frame": lines(
            f"""SELECT station_id, target_date, {shown(WINDOW_FEATURES + ['doy_sin', 'doy_cos'])}, month, wet_streak, dry_streak,
  {shown(['y_tmax_f', 'y_tmin_f'])}, y_rain_yn, {shown(['tmax_f', 'tmin_f', 'prcp_in', 'snow_in'])} FROM frame
  WHERE {not_null(WINDOW_FEATURES + ['y_tmax_f', 'y_tmin_f'])}""", STATIONS, observed(), FRAME),
        "latest_row": lines(
            f"SELECT station_id, date, {shown(['tmax_f', 'tmin_f', 'prcp_in', 'snow_in'])} FROM obs WHERE date <= '1999-06-30' QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY date DESC) = 1",
            STATIONS, observed()),
        "hourly_to_day": lines("SELECT * FROM hd", HOURLY),
        "daily_arrays": lines(
            f"SELECT station_id, date, {shown(['om_tmax_f', 'om_tmin_f', 'om_prcp_in'])}, om_pop_max, {r('om_windgust_mph')} FROM dd", EVENT_STATIONS, DAILY),
        "daily_arrays_damaged": lines(
            f"""SELECT station_id, date, {shown(['om_tmax_f', 'om_tmin_f'])}, CASE WHEN k = 2 AND o = 0 THEN NULL ELSE floor((om_prcp_in) * 1e4 + 0.381966e0) / 1e4 END AS om_prcp_in,
  om_pop_max, CASE WHEN k <> 1 THEN floor((om_windgust_mph) * 1e4 + 0.381966e0) / 1e4 END AS om_windgust_mph FROM ddk WHERE k IN (0, 1, 2)""",
            EVENT_STATIONS, DAILY.replace("dd AS (", "ddk AS (").replace("SELECT station_id, date + 100 * o AS date,", "SELECT station_id, date + 100 * o AS date, o, day(date) % 5 AS k,")),
        "daily_arrays_unreadable": lines(
            """SELECT station_id, CASE day(date) % 5 WHEN 3 THEN 'not JSON' ELSE 'no time array' END AS reason, count(*) AS n FROM st WHERE day(date) % 5 IN (3, 4) GROUP BY 1, 2""", EVENT_STATIONS),
        "hourly_unreadable": "SELECT event_type AS station_id, 'not JSON' AS reason, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1",
        "score_frame": lines(
            f"""SELECT f.station_id, {shown(['f.' + c for c in WINDOW_FEATURES] + ['f.doy_sin', 'f.doy_cos'])}, f.month, f.wet_streak, f.dry_streak,
  {shown(['f.tmax_f', 'f.tmin_f', 'f.prcp_in', 'f.snow_in'])}, DATE '2024-01-30' AS target_date,
  {shown(['nws_tmax_f', 'nws_tmin_f', 'nws_pop_max', 'nws_windgust_max', 'om_tmax_f', 'om_tmin_f', 'om_prcp_in', 'om_pop_max', 'om_windgust_mph'])}
  FROM (SELECT * FROM frame WHERE date <= '2024-01-29' AND {not_null(WINDOW_FEATURES)} QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY date DESC) = 1) f
  LEFT JOIN hd ON hd.station_id = f.station_id AND hd.date = '2024-01-30' LEFT JOIN dd ON dd.station_id = f.station_id AND dd.date = '2024-01-30'""",
            EVENT_STATIONS, observed(), FRAME, HOURLY, DAILY),
        "trades_page": lines(
            """SELECT * FROM tr WHERE ticker = 'click' AND ts BETWEEN 1704100000 AND 1706500000 AND (ts > 1705000000 OR (ts = 1705000000 AND trade_id > 0))
  ORDER BY ts, trade_id LIMIT 100""", TRADES),
        "trades_listing": lines("SELECT * FROM tr WHERE ts >= 1704500000", TRADES),
        "trades_all_pages": lines(
            """SELECT trade_id, ticker, ts, (n - 1) // 100 AS page, ((n - 1) % 100)::INT AS place
  FROM (SELECT *, row_number() OVER (ORDER BY ts, trade_id) AS n FROM tr)""", TRADES),
        "trades_saved_pages": lines(
            """SELECT trade_id, ticker, ts, (n - 1) // 100 AS page, ((n - 1) % 100)::INT AS place
  FROM (SELECT *, row_number() OVER (ORDER BY ts, trade_id) AS n FROM tr)""", TRADES),
        "trades_saved_filtered": lines("SELECT * FROM tr WHERE ticker = 'click' AND ts BETWEEN 1704100000 AND 1706500000", TRADES),
        "event_json": MESSAGES,
        "stream_messages": MESSAGES,
        "stream_latest": "SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
        "stream_latest_compacted": "SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
        "stream_daily": lines(
            "SELECT f.series_id, f.date, f.y, f.is_filled, d.n, d.is_open FROM filled f LEFT JOIN d USING (series_id, date)",
            f"""d AS (SELECT event_type AS series_id, ts::DATE AS date, count(*) AS n, sum({CENTS.format('value')})::BIGINT / 100.0::DOUBLE AS y,
  ts::DATE + INTERVAL 1 DAY > (SELECT max(ts) - INTERVAL 1 HOUR FROM events) AS is_open FROM events GROUP BY 1, 2)""",
            fill("d")),
        "stream_segments": "SELECT event_id, user_id, event_type, value, false AS is_bad FROM events",
        "stream_once": "SELECT event_id, ts, user_id, value FROM events",
        **{name: lines(
            "SELECT series_id, date, y, is_filled FROM filled",
            f"d AS (SELECT event_type AS series_id, ts::DATE AS date, sum({CENTS.format('value')})::DOUBLE AS y FROM events GROUP BY 1, 2)", fill("d"))
            for name in ("stream_filled", "stream_filled_late")},
        "upsert_buckets": f"""SELECT c_custkey, {CENTS.format('c_acctbal')} + CASE WHEN c_custkey % 50 = 0 THEN 3 WHEN c_custkey = 7 THEN 2 ELSE 0 END AS cents,
  CASE WHEN c_custkey % 50 = 0 THEN 3 WHEN c_custkey = 7 THEN 2 ELSE 1 END AS run FROM customer""",
        "stream_closed_days": f"""SELECT event_type AS series_id, ts::DATE AS date, count(*) AS n, sum({CENTS.format('value')})::BIGINT / 100.0::DOUBLE AS y FROM events
  WHERE ts::DATE + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""",
        "stream_late": f"""SELECT series_id, n, cents, CASE WHEN l > 0 THEN l END AS n_late FROM (
  SELECT event_type AS series_id, count(*) AS n, sum({CENTS.format('value')})::BIGINT AS cents,
    count(*) FILTER (event_id % 3 > 0 AND ts::DATE + INTERVAL 1 DAY <= (CASE event_id % 3 WHEN 1 THEN a ELSE greatest(a, b) END) - INTERVAL 1 HOUR) AS l
  FROM events, (SELECT max(ts) FILTER (event_id % 3 = 0) AS a, max(ts) FILTER (event_id % 3 = 1) AS b FROM events) GROUP BY 1)""",
        "weekly_forecast": lines(
            f"""SELECT series_id, strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS period, 'complete_week' AS period_type,
  CASE WHEN bool_or(tag = 'actual') THEN 'mixed' ELSE 'predictions_only' END AS data_mix, 7 AS num_days,
  round_even(round(avg(v), 6), 0)::BIGINT AS daily_average_ridership, round_even(round(sum(v), 6), 0)::BIGINT AS total_period_ridership, DATE '2024-02-01' AS calculation_date
  FROM days7 WHERE v IS NOT NULL GROUP BY series_id HAVING count(*) = 7""", WEEKLY_JOB,
            """sp7 AS (SELECT series_id, date_trunc('week', max(target_date))::DATE + k::INT AS date FROM hybrid, (SELECT unnest(generate_series(0, 6)) AS k) GROUP BY series_id, k),
days7 AS (SELECT p.series_id, p.date, coalesce(h.predicted, s.y) AS v, CASE WHEN h.predicted IS NULL THEN 'actual' ELSE 'predicted' END AS tag
  FROM sp7 p LEFT JOIN hybrid h ON h.series_id = p.series_id AND h.target_date = p.date LEFT JOIN so s ON s.series_id = p.series_id AND s.date = p.date)"""),
        "weekly_forecast_log": lines("SELECT series_id, target_date, floor((predicted) * 1e3 + 0.381966e0) / 1e3 AS predicted FROM hybrid", WEEKLY_JOB),
        "log_append": lines(
            f"""SELECT series_id, origin + step AS target_date, {r('predicted')}, predicted_at FROM it,
  (SELECT unnest([TIMESTAMP '2024-01-01 08:00:00', TIMESTAMP '2024-02-01 12:00:00']) AS predicted_at)""", ORIGIN, FORECASTS),
        **{name: lines(
            """SELECT o.series_id, o.origin, m.mode, s.step, o.origin + s.step AS target_date, true AS is_predicted, true AS is_near
  FROM origin o, steps s, (SELECT unnest(['single', 'multi', 'iterative']) AS mode) m WHERE s.step <= CASE m.mode WHEN 'single' THEN 1 ELSE horizon END""", ORIGIN)
            for name in ("fc_gbt", "fc_linear")},
        **{name: lines(
            f"SELECT series_id, train_end, mode, target_date, step, {r('actual')}, true AS is_predicted, true AS is_near, true AS is_calibrated FROM detail", DETAIL)
            for name in ("backtest_gbt", "backtest_linear")},
        **{f"{name}_training": lines(
            f"""SELECT rank, mode, count(*) AS n_rows, round(var_pop(v), 6) AS constant_error, true AS beats_constant{more}
  FROM labels, (VALUES ('single', 1), ('iterative', 1), ('multi', 7)) m(mode, ahead), steps
  WHERE step <= ahead AND n > 20 + step AND rank {ranks} GROUP BY 1, 2""", FILLED, STEPS, CUTS, LABELS)
            for name, ranks, more in (
                ("fc_gbt", "= 0", ""), ("fc_linear", "= 0", ", 0.0::DOUBLE AS residual_product"),
                ("backtest_gbt", "> 0", ""), ("backtest_linear", "> 0", ", 0.0::DOUBLE AS residual_product"))},
        "weekly_forecast_learned": lines(
            """SELECT series_id, strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS period, 'complete_week' AS period_type,
  CASE WHEN bool_or(tag = 'actual') THEN 'mixed' ELSE 'predictions_only' END AS data_mix, 7 AS num_days, DATE '2024-02-01' AS calculation_date, true AS is_near
  FROM days7 GROUP BY series_id HAVING count(*) = 7 AND count(v) = 7""", WEEKLY_JOB,
            """sp7 AS (SELECT series_id, date_trunc('week', max(target_date))::DATE + k::INT AS date FROM hybrid, (SELECT unnest(generate_series(0, 6)) AS k) GROUP BY series_id, k),
days7 AS (SELECT p.series_id, p.date, coalesce(h.predicted, s.y) AS v, CASE WHEN h.predicted IS NULL THEN 'actual' ELSE 'predicted' END AS tag
  FROM sp7 p LEFT JOIN hybrid h ON h.series_id = p.series_id AND h.target_date = p.date LEFT JOIN so s ON s.series_id = p.series_id AND s.date = p.date)"""),
        "weekly_records": lines(
            """SELECT CASE WHEN name IN ('bias', 'switch') THEN 'calibrate' ELSE name END AS stage, name AS table, '2024-02-01 12:00:00' AS as_of,
  n::BIGINT AS n_rows, 0::BIGINT AS n_nulls FROM (SELECT 'series' AS name, (SELECT count(*) FROM so) AS n UNION ALL SELECT 'backtest', (SELECT count(*) FROM detail)
    UNION ALL SELECT 'bias', 7 * (SELECT count(DISTINCT series_id) FROM detail) UNION ALL SELECT 'switch', (SELECT count(DISTINCT series_id) FROM detail))""", DETAIL),
        "output_checks": lines(
            """SELECT s.series_id, newest_date, (DATE '2001-08-05' - newest_date)::INT AS age_days, DATE '2001-08-05' - newest_date <= 7 AS is_fresh,
  coalesce(n, 0) AS n_predictions, coalesce(a >= lo AND b <= hi, false) AS in_range
  FROM (SELECT series_id, max(date) AS newest_date, min(y) AS lo, max(y) AS hi FROM so GROUP BY 1) s
  LEFT JOIN (SELECT series_id, min(predicted) AS a, max(predicted) AS b, count(*) AS n FROM it GROUP BY 1) USING (series_id)""", ORIGIN, FORECASTS),
    }
    # from sums that three runs added to, the same
    for name in ("overall_metrics", "horizon_metrics", "hybrid_sweep", "global_bias", "bias_by_weekday_series", "best_switch_by_series"):
        sql[f"merged_{name}"] = sql[name]
    sql["weekly_output"] = sql["weekly_forecast"]
    sql["weather_tables"] = sql["weather_frame"]
    return sql
