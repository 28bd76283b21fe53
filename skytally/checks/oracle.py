"""What every registered query must return, as SQL for another engine.

Written against the order tables, not against the Spark code: the joins are spelled out in full, ranks and shares are
taken in other ways.
"""

from __future__ import annotations

# Cause column, its name in results, and the line numbers whose delay it takes.
CAUSES = [
    ("CARRIER_DELAY", "Carrier", "1, 6"),
    ("WEATHER_DELAY", "Weather", "2"),
    ("NAS_DELAY", "NAS", "3"),
    ("SECURITY_DELAY", "Security", "4"),
    ("LATE_AIRCRAFT_DELAY", "Late Aircraft", "5, 7"),
]


def per_cause(template: str, separator: str = ", ") -> str:
    """The template once for each cause."""
    parts = [template.format(column=c, name=n, lines=k, short=c.lower().removesuffix("_delay")) for c, n, k in CAUSES]
    return separator.join(parts)


_CAUSE_COLUMNS = per_cause(
    "CASE WHEN has_cause THEN CASE WHEN l_linenumber IN ({lines}) THEN lag ELSE 0 END::DOUBLE END AS {column}"
)

FLIGHTS = f"""
lags AS (
    SELECT l.*, p_brand, sn.n_name AS origin_name, r_name,
           date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag,
           l_returnflag IS NOT DISTINCT FROM 'R' AS returned
    FROM lineitem l
    LEFT JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN part ON p_partkey = l_partkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = cn.n_regionkey
),
attributed AS (SELECT *, NOT returned AND lag >= 15 AS has_cause FROM lags),
flights AS (
    SELECT CAST(l_shipdate AS DATE) AS FL_DATE,
           p_brand AS OP_CARRIER, origin_name AS ORIGIN, r_name AS DEST,
           CASE WHEN NOT returned THEN CAST(lag AS DOUBLE) END AS ARR_DELAY,
           CASE WHEN NOT returned THEN CAST(lag - l_linenumber AS DOUBLE) END AS DEP_DELAY,
           CASE WHEN returned THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS CANCELLED,
           CASE WHEN returned AND l_linenumber <= 4 THEN substr('ABCD', l_linenumber, 1) END AS CANCELLATION_CODE,
           {_CAUSE_COLUMNS},
           CAST(year(l_shipdate) AS INTEGER) AS fl_year,
           CAST(month(l_shipdate) AS INTEGER) AS fl_month
    FROM attributed
)"""


def rounded(expression: str, digits: int) -> str:
    """Half up on the decimal text of the double, as Spark defines ``round``: 2.675 gives 2.68, and a quotient that
    falls just short of a half, like 43.74999999999999, is not lifted to it."""
    text = f"CAST(CAST({expression} AS DOUBLE) AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


MEAN = rounded("avg(ARR_DELAY)", 2)
DEP_MEAN = rounded("avg(DEP_DELAY)", 2)
LABEL = """CASE CANCELLATION_CODE WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
    WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' ELSE 'Unknown' END"""

ALL_VOLUMES = "SELECT OP_CARRIER, count(*) AS total_flights FROM flights GROUP BY OP_CARRIER"
VOLUME = f"{ALL_VOLUMES} ORDER BY total_flights DESC, OP_CARRIER LIMIT 10"

CARRIER_DELAY = f"""SELECT OP_CARRIER, count(*) AS delayed_flights, {MEAN} AS avg_delay_min,
    {rounded("max(ARR_DELAY)", 2)} AS max_delay_min FROM flights"""

DELAY = f"{CARRIER_DELAY} WHERE ARR_DELAY > 0 GROUP BY OP_CARRIER ORDER BY avg_delay_min DESC, OP_CARRIER"

TOTALS = f"SELECT {per_cause(rounded('sum({column})', 0) + ' AS {short}_delay_min')} FROM flights"

ALL_ORIGINS = f"""SELECT ORIGIN, count(*) AS delayed_departures, {DEP_MEAN} AS avg_dep_delay_min FROM flights
    WHERE DEP_DELAY > 0 GROUP BY ORIGIN HAVING count(*) > 1000"""
ORIGINS = f"{ALL_ORIGINS} ORDER BY avg_dep_delay_min DESC, ORIGIN LIMIT 10"

REASONS = """SELECT CANCELLATION_CODE, count(*) AS cancelled_flights FROM flights WHERE CANCELLED = 1
    GROUP BY CANCELLATION_CODE"""

DECODED = f"""SELECT CANCELLATION_CODE, count(*) AS cancelled_flights, {LABEL} AS reason
    FROM flights WHERE CANCELLED = 1 AND CANCELLATION_CODE <> '' GROUP BY CANCELLATION_CODE"""

MONTHS = f"SELECT fl_month AS month, {MEAN} AS avg_delay_min FROM flights WHERE ARR_DELAY > 0 GROUP BY fl_month"

ROUTES = f"""routes AS (
        SELECT OP_CARRIER, ORIGIN, DEST, {MEAN} AS avg_delay_min, count(*) AS flight_count
        FROM flights WHERE ARR_DELAY > 0 GROUP BY ALL HAVING count(*) > 5
    ) SELECT *, CAST(row_number() OVER (PARTITION BY OP_CARRIER ORDER BY avg_delay_min DESC, ORIGIN, DEST) AS INTEGER)
        AS rank FROM routes QUALIFY rank <= 3"""

YEAR_COLUMNS = f"""fl_year AS year, count(*) AS total_flights,
    count(*) FILTER (ARR_DELAY > 0) AS delayed_flights, count(*) FILTER (CANCELLED = 1) AS cancellations,
    {rounded("avg(ARR_DELAY) FILTER (ARR_DELAY > 0)", 2)} AS avg_delay_min,
    {rounded("count(*) FILTER (CANCELLED = 1) / count(*) * 100", 2)} AS cancel_rate_pct"""

YEARS = f"SELECT {YEAR_COLUMNS} FROM flights GROUP BY fl_year"

EXACT_YEARS = """SELECT fl_year AS year, count(*) AS total_flights, count(*) FILTER (ARR_DELAY > 0) AS delayed_flights,
    count(*) FILTER (CANCELLED = 1) AS cancellations, avg(ARR_DELAY) FILTER (ARR_DELAY > 0) AS avg_delay_min,
    count(*) FILTER (CANCELLED = 1) / count(*) * 100 AS cancel_rate_pct FROM flights GROUP BY fl_year"""

YEAR_CARRIERS = f"""carriers AS (
        SELECT fl_year AS year, OP_CARRIER, {MEAN} AS avg_delay_min, count(*) AS delayed_flights
        FROM flights WHERE ARR_DELAY > 0 GROUP BY ALL
    ) SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY avg_delay_min DESC, OP_CARRIER) AS INTEGER) AS rank
    FROM carriers"""

_CAUSE_UNION = per_cause("SELECT fl_year, '{name}' AS cause, {column} AS minutes FROM flights", " UNION ALL ")
CAUSE_ROWS = f"causes AS ({_CAUSE_UNION})"


def change_from_previous_year(minutes: str) -> str:
    return f"""{CAUSE_ROWS}, per_year AS (
        SELECT cause, fl_year AS year, {minutes} AS total_min FROM causes GROUP BY ALL
    ) SELECT a.cause, a.year, a.total_min,
        {rounded("(a.total_min - b.total_min) / nullif(b.total_min, 0) * 100", 1)} AS change_pct
    FROM per_year a LEFT JOIN per_year b ON a.cause = b.cause
        AND b.year = (SELECT max(c.year) FROM per_year c WHERE c.year < a.year AND c.cause = a.cause)"""


def _year_changes() -> str:
    metrics = ["total_flights", "delayed_flights", "cancellations", "avg_delay_min", "cancel_rate_pct"]
    columns = ", ".join(
        f"{rounded(f'(a.{m} - b.{m}) / nullif(b.{m}, 0) * 100', 1)} AS {m}_change_pct" for m in metrics
    )
    return f"""years AS ({EXACT_YEARS}) SELECT a.year, {columns} FROM years a
    LEFT JOIN years b ON b.year = (SELECT max(c.year) FROM years c WHERE c.year < a.year)"""


def _having(sql: str, key: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE {key} IS NOT NULL"


HEADLINE = f"""volumes AS ({_having(ALL_VOLUMES, "OP_CARRIER")}), delays AS ({_having(DELAY, "OP_CARRIER")}),
    origins AS ({_having(ALL_ORIGINS, "ORIGIN")}), months AS ({_having(MONTHS, "month")}),
    reasons AS ({REASONS}), {CAUSE_ROWS},
    cause_sums AS (SELECT cause, sum(minutes) AS minutes FROM causes GROUP BY cause),
    top_cause AS (SELECT * FROM cause_sums ORDER BY minutes DESC, cause LIMIT 1),
    top_reason AS (SELECT {LABEL} AS reason, cancelled_flights FROM reasons
        ORDER BY cancelled_flights DESC, CANCELLATION_CODE LIMIT 1)
    SELECT (SELECT OP_CARRIER FROM volumes ORDER BY total_flights DESC, OP_CARRIER LIMIT 1) AS busiest_carrier,
        (SELECT max(total_flights) FROM volumes) AS busiest_carrier_flights,
        (SELECT OP_CARRIER FROM delays ORDER BY avg_delay_min DESC, OP_CARRIER LIMIT 1) AS worst_carrier,
        (SELECT max(avg_delay_min) FROM delays) AS worst_carrier_avg_delay_min,
        (SELECT ORIGIN FROM origins ORDER BY avg_dep_delay_min DESC, ORIGIN LIMIT 1) AS worst_origin,
        (SELECT max(avg_dep_delay_min) FROM origins) AS worst_origin_avg_dep_delay_min,
        (SELECT month FROM months ORDER BY avg_delay_min DESC, month LIMIT 1) AS worst_month,
        (SELECT month FROM months ORDER BY avg_delay_min, month LIMIT 1) AS best_month,
        (SELECT cause FROM top_cause) AS top_cause,
        {rounded("(SELECT minutes FROM top_cause) / (SELECT sum(minutes) FROM cause_sums) * 100", 1)} AS top_cause_pct,
        (SELECT reason FROM top_reason) AS top_reason,
        {rounded(
            "(SELECT cancelled_flights FROM top_reason) / (SELECT sum(cancelled_flights) FROM reasons) * 100", 1
        )} AS top_reason_pct"""

ROLLUP = f"""SELECT fl_year AS year, fl_month AS month, OP_CARRIER, ORIGIN, DEST, CANCELLATION_CODE,
    count(*) AS n_flights, count(*) FILTER (CANCELLED = 1) AS n_cancelled,
    count(*) FILTER (ARR_DELAY > 0) AS ARR_DELAY_n, sum(ARR_DELAY) FILTER (ARR_DELAY > 0) AS ARR_DELAY_sum,
    max(ARR_DELAY) FILTER (ARR_DELAY > 0) AS ARR_DELAY_max,
    count(*) FILTER (DEP_DELAY > 0) AS DEP_DELAY_n, sum(DEP_DELAY) FILTER (DEP_DELAY > 0) AS DEP_DELAY_sum,
    max(DEP_DELAY) FILTER (DEP_DELAY > 0) AS DEP_DELAY_max,
    {per_cause('sum({column}) AS {column}')}
    FROM flights GROUP BY fl_year, fl_month, OP_CARRIER, ORIGIN, DEST, CANCELLATION_CODE"""

BAD_LINES = """SELECT OP_CARRIER || ', Inc.' AS OP_CARRIER, count(*) AS total_flights,
    count(*) FILTER (day(FL_DATE) = 7) AS bad_lines, count(DEP_DELAY) FILTER (day(FL_DATE) IS DISTINCT FROM 7) AS known_delays
    FROM flights GROUP BY OP_CARRIER"""


def _select(sql: str) -> str:
    """A query on the flights; ``sql`` may open with further common table expressions."""
    separator = "\n" if sql.lstrip().upper().startswith("SELECT") else ",\n"
    return f"WITH {FLIGHTS.strip()}{separator}{sql}"


_BODIES = {
    "flight_count": "SELECT count(*) AS total_flights FROM flights",
    "volume_by_carrier": VOLUME,
    "delay_by_carrier": DELAY,
    "delay_by_carrier_all_flights": f"{CARRIER_DELAY} WHERE ARR_DELAY IS NOT NULL GROUP BY OP_CARRIER",
    "delay_by_carrier_from_lines": DELAY,
    "volume_by_carrier_from_lines": VOLUME,
    "cancel_reasons_from_lines": DECODED,
    "delay_by_carrier_from_csv": DELAY,
    "year_summary_from_csv": YEARS,
    "bad_lines_from_csv": BAD_LINES,
    "bad_lines_from_lines": BAD_LINES,
    "published_avg_delay": DELAY,
    "published_worst_airports": ALL_ORIGINS,
    "published_monthly_trend": MONTHS,
    "published_flight_rollup": ROLLUP,
    "year_summary_landed": YEARS,
    "flight_rollup_merged": ROLLUP,
    "worst_flights_per_carrier": """SELECT FL_DATE, OP_CARRIER, ARR_DELAY, ORIGIN, DEST, DEP_DELAY,
        CAST(row_number() OVER (PARTITION BY OP_CARRIER ORDER BY ARR_DELAY DESC, FL_DATE NULLS LAST, ORIGIN, DEST, DEP_DELAY)
            AS INTEGER) AS rank
        FROM flights WHERE ARR_DELAY IS NOT NULL QUALIFY rank <= 1200""",
    "cause_totals": TOTALS,
    "worst_origins": ORIGINS,
    "cancel_reasons": REASONS,
    "cancel_reasons_decoded": DECODED,
    "monthly_trend": MONTHS,
    "monthly_trend_labelled": f"""SELECT fl_month AS month, {MEAN} AS avg_delay_min,
        strftime(make_date(2000, fl_month, 1), '%b') AS month_name
        FROM flights WHERE ARR_DELAY > 0 GROUP BY fl_month""",
    "top_routes_per_carrier": ROUTES,
    "year_summary": YEARS,
    "year_cause_minutes": f"""SELECT fl_year AS year,
        {per_cause(rounded("sum({column}) / 1e6", 2) + " AS {short}_min")} FROM flights GROUP BY fl_year""",
    "top_carriers_per_year": f"{YEAR_CARRIERS} QUALIFY rank <= 5",
    "top_carriers_picked_years": f"{YEAR_CARRIERS} WHERE year IN (1997, 1998) QUALIFY rank <= 5",
    "cause_share": f"""{CAUSE_ROWS} SELECT cause, sum(minutes) AS total_min,
        {rounded("sum(minutes) / (SELECT sum(minutes) FROM causes) * 100", 1)} AS share_pct
        FROM causes GROUP BY cause""",
    "cancel_reason_share": f"""SELECT CANCELLATION_CODE, count(*) AS cancelled_flights,
        {rounded("count(*) / (SELECT count(*) FROM flights WHERE CANCELLED = 1) * 100", 1)} AS share_pct,
        {LABEL} AS reason FROM flights WHERE CANCELLED = 1 GROUP BY CANCELLATION_CODE""",
    "cause_yoy_change": change_from_previous_year("sum(minutes)"),
    "cause_yoy_change_millions": change_from_previous_year(rounded("sum(minutes) / 1e6", 2)),
    "year_summary_change": _year_changes(),
    "headline_extremes": HEADLINE,
    "chart_volume": f"SELECT *, total_flights / 1e6 AS total_flights_m FROM ({VOLUME})",
    "chart_year_overview": f"""SELECT year, total_flights / 1e6 AS total_flights_m,
        delayed_flights / 1e6 AS delayed_flights_m, cancellations / 1e3 AS cancellations_k, avg_delay_min
        FROM ({YEARS})""",
    "chart_month_range": f"SELECT min(avg_delay_min) AS lowest, max(avg_delay_min) AS highest FROM ({MONTHS})",
    "flight_rollup": ROLLUP,
    "sql_volume_by_carrier": VOLUME,
    "sql_delay_by_carrier": f"{DELAY} LIMIT 10",
    "sql_cause_totals": TOTALS,
    "sql_worst_origins": ORIGINS,
    "sql_cancel_reasons": REASONS,
    "sql_monthly_trend": MONTHS,
    "sql_view_monthly_trend": MONTHS,
    "sql_view_worst_origins": ORIGINS,
}

# The order of results that have one; nulls go last.
_ORDERS = {
    "delay_by_carrier_all_flights": "avg_delay_min DESC, OP_CARRIER",
    "cancel_reasons": "cancelled_flights DESC, CANCELLATION_CODE",
    "cancel_reasons_decoded": "cancelled_flights DESC, CANCELLATION_CODE",
    "cancel_reasons_from_lines": "cancelled_flights DESC, CANCELLATION_CODE",
    "cancel_reason_share": "cancelled_flights DESC, CANCELLATION_CODE",
    "sql_cancel_reasons": "cancelled_flights DESC, CANCELLATION_CODE",
    "monthly_trend": "month",
    "monthly_trend_labelled": "month",
    "sql_monthly_trend": "month",
    "sql_view_monthly_trend": "month",
    "top_routes_per_carrier": "OP_CARRIER, rank",
    "year_summary": "year",
    "year_summary_change": "year",
    "year_cause_minutes": "year",
    "top_carriers_per_year": "year, rank",
    "top_carriers_picked_years": "year, rank",
    "cause_share": "total_min DESC, cause",
    "cause_yoy_change": "cause, year",
    "cause_yoy_change_millions": "cause, year",
    "chart_volume": "total_flights DESC, OP_CARRIER",
    "chart_year_overview": "year",
}

# Queries whose rows come in a set order: by the list above or by the text itself.
ORDERED = {name for name, body in _BODIES.items() if body.startswith((VOLUME, DELAY, ORIGINS))} | set(_ORDERS)


def _ordered(name: str, body: str) -> str:
    if name not in _ORDERS:
        return body
    # Rows without a year or month come first, rows without another key last.
    keys = ", ".join(f"{key} NULLS {'FIRST' if key in ('year', 'month') else 'LAST'}" for key in _ORDERS[name].split(", "))
    return f"{body} ORDER BY {keys}"


ORACLE = {name: _select(_ordered(name, body)) for name, body in _BODIES.items()}
