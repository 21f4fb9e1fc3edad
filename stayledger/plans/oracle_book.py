"""DuckDB SQL for every query that SQL can express, over the same order tables.

The SQL derives bookings straight from the order tables and knows nothing of the warehouse, so it also checks the
star-schema build.
"""

from __future__ import annotations

from itertools import combinations

from ..functions.buckets import LEAD_TIME, STAY
from ..functions.calendar import MONTH_NAMES
from ..functions.risk import CANCELLATION_ACTIONS, CHURN_ACTIONS, CHURN_STRATEGIES, SEGMENT_RECOMMENDATIONS
from ..operators import advice, display
from ..operators.correlation import DASHBOARD_COLUMNS, MODEL_COLUMNS
from ..operators.filters import CANCELLATION_COLUMNS, CHURN_COLUMNS, DETAIL_COLUMNS, WIDE_COLUMNS
from ..operators.facts import DERIVED, KEY_COLUMNS, MEASURES
from ..sources.booking_schema import RAW_COLUMNS

RAW = """
raw AS (
  SELECT
    CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
      l_quantity, l_returnflag, l_linestatus, l_discount, l_tax) AS BIGINT) AS booking_id,
    CASE WHEN l_linestatus = 'F' THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
    CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS is_canceled,
    CAST(abs(datediff('day', o_orderdate, l_shipdate)) % 450 AS BIGINT) AS lead_time,
    CAST(year(l_shipdate) AS BIGINT) AS arrival_date_year,
    monthname(l_shipdate) AS arrival_date_month,
    CAST(weekofyear(l_shipdate) AS BIGINT) AS arrival_date_week_number,
    CAST(day(l_shipdate) AS BIGINT) AS arrival_date_day_of_month,
    CAST(l_linenumber % 3 AS BIGINT) AS stays_in_weekend_nights,
    CAST(CAST(l_quantity AS INTEGER) % 6 AS BIGINT) AS stays_in_week_nights,
    CAST(1 + l_partkey % 4 AS BIGINT) AS adults,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 3 AS DOUBLE) END AS children,
    CAST(CASE WHEN l_partkey % 100 = 0 THEN l_orderkey % 997 WHEN l_partkey % 100 = 1 THEN l_orderkey % 7 ELSE 0 END AS BIGINT) AS babies,
    p_type AS meal,
    CASE WHEN o_custkey % 200 = 0 THEN NULL ELSE n_name END AS country,
    c_mktsegment AS market_segment,
    o_orderpriority AS distribution_channel,
    CAST(CASE WHEN o_custkey % 25 = 3 AND l_partkey % 20 = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_repeated_guest,
    CAST(CASE WHEN l_partkey % 11 = 0 THEN l_linenumber % 4 ELSE 0 END AS BIGINT) AS previous_cancellations,
    CAST(CASE WHEN o_custkey % 25 = 3 THEN l_linenumber ELSE 0 END AS BIGINT) AS previous_bookings_not_canceled,
    chr(CAST(65 + p_size % 8 AS INTEGER)) AS reserved_room_type,
    chr(CAST(65 + (p_size + CASE WHEN l_suppkey % 8 = 0 THEN 1 ELSE 0 END) % 8 AS INTEGER)) AS assigned_room_type,
    CAST(CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber % 3 ELSE 0 END AS BIGINT) AS booking_changes,
    CASE o_orderstatus WHEN 'F' THEN 'No Deposit' WHEN 'O' THEN 'Non Refund' ELSE 'Refundable' END AS deposit_type,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_suppkey END AS agent,
    CASE WHEN l_partkey % 16 = 0 THEN l_partkey % 40 ELSE NULL END AS company,
    CAST(CASE WHEN l_partkey % 30 = 0 THEN l_suppkey % 90 ELSE 0 END AS BIGINT) AS days_in_waiting_list,
    r_name AS customer_type,
    floor(l_extendedprice / l_quantity * 10) / 100 AS adr,
    CAST(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS BIGINT) AS required_car_parking_spaces,
    CAST(CAST(round(l_tax * 100) AS INTEGER) % 6 AS BIGINT) AS total_of_special_requests,
    CASE WHEN l_returnflag = 'R' THEN 'Canceled' WHEN l_suppkey % 50 = 0 THEN 'No-Show' ELSE 'Check-Out' END AS reservation_status,
    CAST(o_orderdate AS DATE) AS reservation_status_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

SEASON = """CASE WHEN month IN ('December', 'January', 'February') THEN 'Winter'
      WHEN month IN ('March', 'April', 'May') THEN 'Spring'
      WHEN month IN ('June', 'July', 'August') THEN 'Summer' ELSE 'Fall' END"""
SEASON_ORDER = "CASE season WHEN 'Winter' THEN 0 WHEN 'Spring' THEN 1 WHEN 'Summer' THEN 2 ELSE 3 END"
MONTH_NUM = "CASE month " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTH_NAMES, 1)) + " END"

WIDE = f"""
wide AS (
  SELECT *, {SEASON} AS season, isodow(full_date) >= 6 AS is_weekend,
    stays_in_weekend_nights + stays_in_week_nights AS total_stay_nights,
    adults + children + babies AS total_guests,
    adr * (stays_in_weekend_nights + stays_in_week_nights) AS revenue,
    reserved_room_type <> assigned_room_type AS room_changed
  FROM (
    SELECT raw.* REPLACE (coalesce(children, 0) AS children),
      arrival_date_year AS year, arrival_date_month AS month, arrival_date_week_number AS week_number,
      arrival_date_day_of_month AS day_of_month, hotel AS hotel_name, meal AS meal_plan,
      make_date(arrival_date_year, month(strptime(arrival_date_month, '%B')), arrival_date_day_of_month) AS full_date
    FROM raw
  )
)"""

LABELLED = """
identified AS (
  SELECT *, concat_ws('_', coalesce(country, 'nan'), CAST(adults AS VARCHAR), CAST(children AS VARCHAR),
    CAST(babies AS VARCHAR)) AS customer_id FROM wide
), rollup_ AS (
  SELECT customer_id, count(*) AS bookings, avg(is_canceled) AS cancel_rate, max(is_repeated_guest) AS any_repeat,
    min(reservation_status_date) AS first_date, max(reservation_status_date) AS last_date,
    CASE WHEN count(*) > 1 THEN datediff('day', min(reservation_status_date), max(reservation_status_date)) / (count(*) - 1) END
      AS avg_return_gap_days,
    datediff('day', max(reservation_status_date), (SELECT max(reservation_status_date) FROM wide)) AS days_since_last_booking
  FROM identified GROUP BY customer_id
), labelled AS (
  SELECT identified.*, CAST(CASE
    WHEN bookings > 1 AND any_repeat = 1 THEN 0
    WHEN bookings > 1 AND days_since_last_booking > avg_return_gap_days * 1.5 THEN 1
    WHEN bookings > 1 THEN 0
    WHEN is_canceled = 1 THEN 1
    WHEN booking_changes > 0 AND room_changed THEN 1
    ELSE 0 END AS INTEGER) AS is_churned
  FROM identified JOIN rollup_ USING (customer_id)
)"""

PREDICTED = """
predicted AS (
  SELECT booking_id, is_canceled AS label, lead_time / 450.0::DOUBLE AS score,
    CASE WHEN lead_time / 450.0::DOUBLE > 0.5 THEN 1 ELSE 0 END AS prediction FROM wide
), cells AS (
  SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM predicted
)"""

GRID_KEY = """concat_ws(' | ', hotel_name, coalesce(country, 'nan'), meal_plan, market_segment)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _wide(query: str) -> str:
    return _with(RAW, WIDE) + query


def _labelled(query: str) -> str:
    return _with(RAW, WIDE, LABELLED) + query


def _predicted(query: str) -> str:
    return _with(RAW, WIDE, PREDICTED) + query


def _bucket(column: str, groups) -> str:
    parts = [
        f"WHEN {column} > {low} AND {column} <= {high} THEN '{name}'"
        for low, high, name in zip(groups.borders, groups.borders[1:], groups.labels)
    ]
    return "CASE " + " ".join(parts) + f" WHEN {column} > {groups.borders[-1]} THEN '{groups.labels[-1]}' END"


def _form_bucket(column: str) -> str:
    parts = [f"WHEN {column} <= {high} THEN '{name}'" for high, name in zip(LEAD_TIME.borders[1:], LEAD_TIME.labels)]
    return "CASE " + " ".join(parts) + f" ELSE '{LEAD_TIME.labels[-1]}' END"


def _labels(groups, name: str) -> str:
    rows = ", ".join(f"('{text}', {i})" for i, text in enumerate(groups.labels))
    return f"(VALUES {rows}) labels({name}, bucket_order)"


def _case(column: str, texts: dict) -> str:
    def text(value):
        return ", ".join(value) if isinstance(value, list) else value

    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{text(v)}'" for k, v in texts.items()) + " END"


def _by_bucket(column: str, groups, name: str, aggregates: str, outputs: str) -> str:
    return (
        f"SELECT labels.{name}, labels.bucket_order, {outputs} FROM {_labels(groups, name)} LEFT JOIN "
        f"(SELECT {_bucket(column, groups)} AS {name}, {aggregates} FROM wide GROUP BY 1) g ON g.{name} = labels.{name}"
    )


def _by_month(aggregates: str) -> str:
    return _wide(
        f"SELECT year, month, {MONTH_NUM} AS month_num, year || '-' || month AS year_month, {aggregates} FROM wide GROUP BY year, month"
    )




def _cents(value: str, keep: str = "") -> str:
    return f"CAST(sum(CAST(round(({value}) * 100) AS BIGINT)){keep} AS DOUBLE)"


def _money(value: str, keep: str = "") -> str:
    return f"{_cents(value, keep)} / 100.0::DOUBLE"


def _mean_money(value: str, keep: str = "") -> str:
    return f"{_cents(value, keep)} / (count({value}){keep} * 100.0::DOUBLE)"


TOTAL_REVENUE = f"{_money('revenue')} AS total_revenue"
MEAN_ADR = f"round({_mean_money('adr')}, 6) AS avg_adr"
RATE = "round(avg(is_canceled) * 100, 6) AS cancellation_rate, count(*) AS count"
REVENUE = f"{TOTAL_REVENUE}, count(*) AS booking_count, {MEAN_ADR}"
REVENUE_NO_COUNT = f"{TOTAL_REVENUE}, {MEAN_ADR}"


def _dimension(key: str, columns: str, source: str, order: str) -> str:
    return _with(RAW) + f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key}, {columns} FROM ({source})"


def _nulls_last(*names: str) -> str:
    return ", ".join(f"{n} ASC NULLS LAST" for n in names)


def _crosstab(table: str, dimensions: dict[str, str], flag: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, {expression} AS value, {flag} AS flag, count(*) AS count FROM {table} "
        f"WHERE {expression} IS NOT NULL GROUP BY ALL"
        for name, expression in dimensions.items()
    )


def _correlations(table: str, columns: list[str]) -> str:
    """All ordered pairs, from one aggregation with one correlation per unordered pair."""
    parts = [f"corr({a}, {b}) AS r_{i}" for i, (a, b) in enumerate(combinations(columns, 2))]
    constant = [f"(count(DISTINCT {c}) > 1) AS v_{c}" for c in columns]
    position = {frozenset(pair): i for i, pair in enumerate(combinations(columns, 2))}
    rows = []
    for a in columns:
        for b in columns:
            value = f"CASE WHEN v_{a} THEN 1.0::DOUBLE END" if a == b else f"CASE WHEN isfinite(r_{position[frozenset((a, b))]}) THEN round(r_{position[frozenset((a, b))]}, 6) END"
            rows.append(f"{{'col_a': '{a}', 'col_b': '{b}', 'r': {value}}}")
    return (
        f", sums AS (SELECT {', '.join(parts + constant)} FROM {table}) "
        f"SELECT unnest([{', '.join(rows)}], recursive := true) FROM sums"
    )


SERIES = "SELECT 'all' AS series_key, make_date(year, {m}, 1) AS month_start, count(*) AS value FROM wide GROUP BY ALL".format(m=MONTH_NUM)


def _filled(source: str) -> str:
    """CTEs series, grid and filled for a query of (series_key, month_start, value)."""
    return f"""
series AS ({source}),
spans AS (SELECT series_key, min(month_start) AS first_month, max(month_start) AS last_month FROM series GROUP BY 1),
months AS (SELECT series_key, CAST(unnest(generate_series(CAST(first_month AS TIMESTAMP), CAST(last_month AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM spans),
grid AS (SELECT months.series_key, months.month_start, value FROM months LEFT JOIN series ON series.series_key = months.series_key AND series.month_start = months.month_start),
filled AS (SELECT series_key, month_start, last_value(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM grid)"""


GRID_SOURCE = f"SELECT {GRID_KEY} AS series_key, make_date(year, {MONTH_NUM}, 1) AS month_start, count(*) AS value FROM wide GROUP BY ALL"
HOTEL_SEGMENT_SOURCE = GRID_SOURCE.replace(GRID_KEY, "concat_ws(' | ', hotel_name, market_segment)")
BASELINE = f"""
history AS ({SERIES}),
last_month AS (SELECT max(month_start) AS last_start, arg_max(value, month_start) AS last_value FROM history),
steps AS (SELECT CAST(last_start + to_months(CAST(step AS INTEGER)) AS DATE) AS month_start, last_value, step FROM last_month, range(1, 7) t(step)),
ahead AS (SELECT month_start, CAST(greatest(0, trunc(last_value * (CASE WHEN month(month_start) IN (6, 7, 8) THEN 1.2::DOUBLE
  WHEN month(month_start) IN (11, 12, 1) THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END) * pow(1.02::DOUBLE, step))) AS BIGINT) AS bookings FROM steps),
forecast AS (SELECT month_start, bookings, CAST(greatest(0, trunc(bookings * 0.85::DOUBLE)) AS BIGINT) AS lower_ci,
  CAST(trunc(bookings * 1.15::DOUBLE) AS BIGINT) AS upper_ci FROM ahead)"""


def _advice(best: str, column: str, templates: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{title}' AS title, '{text.split('%s')[0].replace('%%', '%')}' || {column} || "
        f"'{text.split('%s')[1].replace('%%', '%')}' AS detail FROM ({best})"
        for title, text in templates
    )


TOP_SEASON = f"SELECT season, {REVENUE_NO_COUNT} FROM wide GROUP BY season ORDER BY total_revenue DESC, season"
TOP_MARKET = f"SELECT market_segment, {REVENUE} FROM wide GROUP BY market_segment ORDER BY total_revenue DESC, market_segment"
TOP_ROOM = f"SELECT reserved_room_type, {REVENUE} FROM wide GROUP BY reserved_room_type ORDER BY avg_adr DESC, reserved_room_type"
STAY_REVENUE = _by_bucket("total_stay_nights", STAY, "stay_duration_bucket", REVENUE_NO_COUNT, "coalesce(total_revenue, 0.0) AS total_revenue, avg_adr")
LEAD_RATES = _by_bucket("lead_time", LEAD_TIME, "lead_time_bucket", RATE, "cancellation_rate, coalesce(count, 0) AS count")
MARKET_RATES = f"SELECT market_segment, {RATE} FROM wide GROUP BY market_segment"
VALUE_THRESHOLD = "(SELECT quantile_cont(adr * total_stay_nights, 0.75) FROM wide)"
RISK_LEVEL = "CASE WHEN p < 0.3::DOUBLE THEN 'Low' WHEN p < 0.7::DOUBLE THEN 'Medium' ELSE 'High' END"
SEGMENT = f"""SELECT booking_id, CASE WHEN adr * total_stay_nights > {VALUE_THRESHOLD} THEN 'High-Value' ELSE 'Low-Value' END || ' ' ||
  CASE WHEN lead_time / 450.0::DOUBLE > 0.7::DOUBLE THEN 'High-Risk' WHEN lead_time / 450.0::DOUBLE > 0.3::DOUBLE THEN 'Medium-Risk' ELSE 'Loyal' END AS segment
  FROM wide"""
SPLIT = """SELECT booking_id, is_canceled, CASE WHEN row_number() OVER (PARTITION BY is_canceled
  ORDER BY md5(booking_id || '-42')) <= floor(count(*) OVER (PARTITION BY is_canceled) * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS part FROM wide"""


def _kpi_texts() -> str:
    money = "'$' || format('{:,.2f}', %s)"
    texts = {
        display.CANCELLATION_RATE: "format('{:,.2f}', avg(is_canceled) * 100) || '%'",
        display.TOTAL: "format('{:,}', count(*))",
        display.CANCELLED: "format('{:,}', CAST(sum(is_canceled) AS BIGINT))",
        display.CONFIRMED: "format('{:,}', CAST(count(*) - sum(is_canceled) AS BIGINT))",
        display.REVENUE: money % _money("revenue"),
        display.RATE: money % _mean_money("adr"),
        display.REVPAR: money % f"{_mean_money('adr')} * (1 - avg(is_canceled))",
        display.LOST: money % _money("revenue", " FILTER (is_canceled = 1)"),
    }
    return " UNION ALL ".join(f"SELECT '{name}' AS figure, {text} AS text FROM wide" for name, text in texts.items())


def _warehouse() -> dict[str, str]:
    agents = "SELECT DISTINCT coalesce(CAST(agent AS VARCHAR), 'Unknown') AS agent_id, coalesce(CAST(company AS VARCHAR), 'Unknown') AS company_id FROM raw"
    dimensions = {
        "date_dim": ("SELECT year, month, min(week_number) AS week_number, day_of_month, full_date, bool_or(is_weekend) AS is_weekend, "
                     "min(season) AS season FROM wide GROUP BY year, month, day_of_month, full_date"),
        "hotel_dim": "SELECT DISTINCT hotel_name, meal_plan, market_segment, distribution_channel FROM wide",
        "customer_dim": "SELECT DISTINCT country, customer_type, deposit_type FROM wide",
        "room_dim": "SELECT DISTINCT reserved_room_type, assigned_room_type, room_changed FROM wide",
        "agent_dim": agents,
    }
    orders = {
        "date_dim": ("date_key", _nulls_last("full_date")),
        "hotel_dim": ("hotel_key", _nulls_last("hotel_name", "meal_plan", "market_segment", "distribution_channel")),
        "customer_dim": ("customer_key", _nulls_last("country", "customer_type", "deposit_type")),
        "room_dim": ("room_key", _nulls_last("reserved_room_type", "assigned_room_type")),
        "agent_dim": ("agent_key", _nulls_last("agent_id", "company_id")),
    }
    sql = {
        name: _wide(f"SELECT CAST(row_number() OVER (ORDER BY {orders[name][1]}) AS BIGINT) AS {orders[name][0]}, * FROM ({members})")
        for name, members in dimensions.items()
    }
    tables = [f"{name}_ AS (SELECT row_number() OVER (ORDER BY {orders[name][1]}) AS {orders[name][0]}, * FROM ({members}))" for name, members in dimensions.items()]
    sql["fact_keys"] = _with(RAW, WIDE, *tables) + f"""
SELECT booking_id, {', '.join(f'CAST({k} AS BIGINT) AS {k}' for k in KEY_COLUMNS)} FROM wide
JOIN date_dim_ d ON d.full_date = wide.full_date
JOIN hotel_dim_ h ON h.hotel_name = wide.hotel_name AND h.meal_plan = wide.meal_plan AND h.market_segment = wide.market_segment
  AND h.distribution_channel = wide.distribution_channel
JOIN customer_dim_ c ON c.country IS NOT DISTINCT FROM wide.country AND c.customer_type = wide.customer_type AND c.deposit_type = wide.deposit_type
JOIN room_dim_ r ON r.reserved_room_type = wide.reserved_room_type AND r.assigned_room_type = wide.assigned_room_type
JOIN agent_dim_ a ON a.agent_id = coalesce(CAST(wide.agent AS VARCHAR), 'Unknown') AND a.company_id = coalesce(CAST(wide.company AS VARCHAR), 'Unknown')"""
    counts = [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({members})" for name, members in dimensions.items()]
    counts.append("SELECT 'booking_fact' AS table_name, count(*) AS row_count FROM wide")
    sql["warehouse_counts"] = _wide(" UNION ALL ".join(counts))
    return sql


OUTLOOK_MONTHS = """, outlook AS (
  SELECT series_key, CASE WHEN row_number() OVER own <= floor(count(*) OVER (PARTITION BY series_key) * 0.8::DOUBLE) THEN 'history' ELSE 'holdout' END AS kind,
    month_start, CAST(value AS DOUBLE) AS value FROM filled WINDOW own AS (PARTITION BY series_key ORDER BY month_start)
  UNION ALL
  SELECT series_key, 'forecast', CAST(last_start + to_months(CAST(step AS INTEGER)) AS DATE), NULL
  FROM (SELECT series_key, max(month_start) AS last_start FROM filled GROUP BY series_key), range(1, 13) t(step))
"""

# The labelled rows of a fit: those of the training part whose number has the smallest hash.
FIT_ROWS = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(booking_id || '-42'))
  <= floor(count(*) OVER (PARTITION BY {label}) * 0.2::DOUBLE + 0.5) AS held FROM {source})
WHERE NOT held ORDER BY md5(booking_id || '-42'), booking_id LIMIT {rows}"""

GRID = (
    ", sample AS (" + FIT_ROWS.format(label="is_canceled", source="wide", rows=300) + "), numbered AS (SELECT *, row_number() OVER (PARTITION BY is_canceled ORDER BY "
    "md5(booking_id || '-7')) AS place, count(*) OVER (PARTITION BY is_canceled) AS all_rows FROM sample), folds AS (SELECT CAST(CASE WHEN place <= floor(all_rows * (1 / 3.0::DOUBLE) + 0.5) "
    "THEN 0 WHEN place <= floor(all_rows * (1 / 3.0::DOUBLE + 1 / 3.0::DOUBLE) + 0.5) THEN 1 ELSE 2 END AS INTEGER) AS fold, count(*) AS rows FROM numbered GROUP BY 1) "
    "SELECT depth, min_leaf, trees, fold, rows, true AS judged FROM folds, (VALUES (30), (10), (20)) AS d(depth), (VALUES (1), (2)) AS l(min_leaf), (VALUES (100), (200)) AS t(trees)"
)


def _feature_list(label: str, source: str, more: tuple[str, ...]) -> str:
    """Numbers by name, categories by value, as far as the labelled rows of the fit have them."""
    numbers = (
        "lead_time stays_in_weekend_nights stays_in_week_nights adults children babies is_repeated_guest previous_cancellations previous_bookings_not_canceled "
        "booking_changes adr required_car_parking_spaces total_of_special_requests days_in_waiting_list total_stay_nights total_guests year room_changed"
    ).split()
    texts = (
        "month season hotel_name meal_plan market_segment distribution_channel country customer_type deposit_type reserved_room_type assigned_room_type"
    ).split()
    mode = f"(SELECT country FROM {source} WHERE country IS NOT NULL GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)"
    value = lambda c: f"coalesce(country, {mode})" if c == "country" else c
    parts = [f"SELECT '{c}' AS feature" for c in (*numbers, *more)] + [f"SELECT DISTINCT '{c}_' || {value(c)} FROM sample" for c in texts]
    return f", sample AS ({FIT_ROWS.format(label=label, source=source, rows=20000)}) SELECT feature, true AS consistent FROM (" + " UNION ALL ".join(parts) + ")"


def oracle_sql() -> dict[str, str]:
    raw_columns = ", ".join(RAW_COLUMNS)
    mean_by_status = "SELECT 'Canceled' AS booking_status, round(avg({0}) FILTER (is_canceled = 1), 6) AS average FROM wide UNION ALL SELECT 'Not Canceled', round(avg({0}) FILTER (is_canceled = 0), 6) FROM wide"
    null_rows = ", ".join(
        f"{{'column_name': '{c}', 'null_count': count(*) - count({c}), 'null_pct': round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6)}}"
        for c in RAW_COLUMNS
    )
    options = " UNION ALL ".join(
        [f"SELECT DISTINCT '{c}' AS filter_name, {c} AS option FROM wide" for c in ("hotel_name", "market_segment", "customer_type")]
        + [f"SELECT '{f}_year' AS filter_name, CAST({f}(year) AS VARCHAR) AS option FROM wide" for f in ("min", "max")]
    )
    precision, recall = "(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END)", "(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END)"
    precision0, recall0 = "(CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END)", "(CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END)"

    def f1(p: str, r: str) -> str:
        return f"(CASE WHEN {p} + {r} = 0 THEN 0 ELSE 2 * {p} * {r} / ({p} + {r}) END)"

    total = "(tp + fp + fn + tn)"
    report_rows = [("0", precision0, recall0, f1(precision0, recall0), "tn + fp"), ("1", precision, recall, f1(precision, recall), "tp + fn")]
    macro = [f"({a} + {b}) / 2" for a, b in zip(report_rows[0][1:4], report_rows[1][1:4])]
    weighted = [f"({a} * (tn + fp) + {b} * (tp + fn)) / {total}" for a, b in zip(report_rows[0][1:4], report_rows[1][1:4])]
    report_rows += [("accuracy", "NULL", "NULL", f"(tp + tn) / {total}", total), ("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    report = " UNION ALL ".join(
        f"SELECT '{n}' AS class, round(CAST({p} AS DOUBLE), 6) AS precision, round(CAST({r} AS DOUBLE), 6) AS recall, round(CAST({f} AS DOUBLE), 6) AS f1, {s} AS support FROM cells"
        for n, p, r, f, s in report_rows
    )
    roc = """, by_score AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM predicted GROUP BY score),
ranked AS (SELECT *, sum(pos) OVER w AS upto_pos, sum(neg) OVER w AS upto_neg, sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
  FROM by_score WINDOW w AS (ORDER BY score DESC))"""
    outlook = (
        "SELECT 'history' AS kind, CAST(year(month_start) AS INTEGER) AS year, monthname(month_start) AS month, value AS bookings, "
        "NULL::BIGINT AS lower_ci, NULL::BIGINT AS upper_ci FROM history "
        "UNION ALL SELECT 'forecast', CAST(year(month_start) AS INTEGER), monthname(month_start), bookings, lower_ci, upper_ci FROM forecast"
    )
    scored_form = f"""SELECT booking_id, hotel_name, lead_time, total_stay_nights, market_segment, distribution_channel, is_repeated_guest,
  deposit_type, customer_type, adr, total_of_special_requests, booking_changes, required_car_parking_spaces,
  least(2, total_stay_nights) AS stays_in_weekend_nights, greatest(0, total_stay_nights - 2) AS stays_in_week_nights,
  adr * total_stay_nights AS revenue, {_form_bucket('lead_time')} AS lead_time_bucket, 'Reserved' AS reservation_status,
  2::BIGINT AS adults, 0.0::DOUBLE AS children, 0::BIGINT AS babies, 0::BIGINT AS previous_cancellations,
  0::BIGINT AS previous_bookings_not_canceled, 0::BIGINT AS days_in_waiting_list, 2.0::DOUBLE AS total_guests, 2017::BIGINT AS year,
  'August' AS month, 'Summer' AS season, 'BB' AS meal_plan, 'PRT' AS country, 'A' AS reserved_room_type, 'A' AS assigned_room_type,
  false AS room_changed, false AS is_weekend, p AS cancellation_probability, {RISK_LEVEL} AS risk_level,
  {_case(RISK_LEVEL, CANCELLATION_ACTIONS)} AS actions, p > 0.5::DOUBLE AS high_risk
FROM (SELECT *, lead_time / 450.0::DOUBLE AS p FROM wide)"""
    demand = f"""SELECT year, month, hotel_name, count(*) AS booking_count, {_money('adr * total_stay_nights')} AS total_revenue, {_mean_money('adr')} AS avg_daily_rate
FROM wide GROUP BY year, month, hotel_name"""
    customer_form = f"""SELECT booking_id, hotel_name, customer_type, is_repeated_guest, previous_cancellations, market_segment,
  distribution_channel, booking_changes, room_changed, adr, total_of_special_requests, previous_bookings_not_canceled, deposit_type,
  30::BIGINT AS lead_time, 1::BIGINT AS stays_in_weekend_nights, 2::BIGINT AS stays_in_week_nights, 3::BIGINT AS total_stay_nights,
  0::BIGINT AS is_canceled, 'Check-Out' AS reservation_status, 2::BIGINT AS adults, 0.0::DOUBLE AS children, 0::BIGINT AS babies,
  0::BIGINT AS required_car_parking_spaces, 0::BIGINT AS days_in_waiting_list, 2.0::DOUBLE AS total_guests, 2017::BIGINT AS year,
  'August' AS month, 'Summer' AS season, 'BB' AS meal_plan, 'PRT' AS country, 'A' AS reserved_room_type, 'A' AS assigned_room_type,
  false AS is_weekend, p AS churn_probability, {RISK_LEVEL} AS risk_level, {_case(RISK_LEVEL, CHURN_STRATEGIES)} AS strategy,
  {_case(RISK_LEVEL, CHURN_ACTIONS)} AS actions
FROM (SELECT *, (total_of_special_requests + booking_changes) / 8.0::DOUBLE AS p FROM wide)"""
    decomposition = _with(RAW, WIDE, _filled(SERIES)) + """, indexed AS (
  SELECT month_start, CAST(value AS DOUBLE) AS observed, row_number() OVER (ORDER BY month_start) - 1 AS i FROM filled
), trended AS (
  SELECT *, CASE WHEN count(*) OVER wide_ = 13 THEN (sum(observed) OVER wide_ + sum(observed) OVER narrow_) / 24 END AS trend
  FROM indexed WINDOW wide_ AS (ORDER BY i ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), narrow_ AS (ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
), phases AS (SELECT i % 12 AS phase, avg(observed / trend) AS phase_mean FROM trended GROUP BY 1
), factors AS (SELECT phase, phase_mean / (SELECT avg(phase_mean) FROM phases) AS seasonal FROM phases)
SELECT month_start, round(observed, 6) AS observed, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
  round(observed / (seasonal * trend), 6) AS resid FROM trended JOIN factors ON phase = i % 12"""
    acf_parts = _with(RAW, WIDE, _filled(SERIES)) + """, centred AS (
  SELECT row_number() OVER (ORDER BY month_start) AS i, value - (SELECT avg(value) FROM filled) AS d FROM filled
), lags AS (SELECT CAST(lag AS INTEGER) AS lag FROM range(0, 13) t(lag) WHERE lag <= (SELECT floor(count(*) * 0.4::DOUBLE) FROM filled))
"""
    acf_values = """SELECT lag, sum(a.d * b.d) / (SELECT sum(d * d) FROM centred) AS value
FROM lags, centred a JOIN centred b ON b.i = a.i + lag GROUP BY lag"""
    acf = f"{acf_parts}SELECT lag, round(value, 6) AS value FROM ({acf_values})"
    pacf = acf_parts.replace("WITH ", "WITH RECURSIVE ", 1) + f""", rhos AS (SELECT list(value ORDER BY lag) AS rho FROM ({acf_values}) WHERE lag > 0
), steps AS (
  SELECT 1 AS k, [rho[1]] AS weights, rho[1] AS last, rho FROM rhos
  UNION ALL
  SELECT k + 1, list_append([weights[j] - p * weights[k + 1 - j] FOR j IN range(1, k + 1)], p), p, rho FROM (
    SELECT *, (rho[k + 1] - list_dot_product(weights, list_reverse(rho[1:k]))) / (1 - list_dot_product(weights, rho[1:k])) AS p
    FROM steps WHERE k < len(rho))
)
SELECT 0::INTEGER AS lag, 1.0::DOUBLE AS value UNION ALL SELECT CAST(k AS INTEGER), round(last, 6) FROM steps"""
    sql = {
        "scan_bookings": _with(RAW) + f"SELECT {raw_columns}, booking_id FROM raw",
        **_warehouse(),
        "booking_fact": _wide(f"SELECT booking_id, {', '.join(MEASURES + DERIVED)} FROM wide"),
        "booking_wide": _wide(f"SELECT {', '.join(WIDE_COLUMNS)} FROM wide"),
        "cancellation_features": _wide(f"SELECT {', '.join(CANCELLATION_COLUMNS)} FROM wide"),
        "churn_features": _wide(f"SELECT {', '.join(CHURN_COLUMNS)} FROM wide"),
        "filtered_bookings": _wide(
            f"SELECT {', '.join(WIDE_COLUMNS)} FROM wide WHERE hotel_name = 'City Hotel' AND year BETWEEN 1996 AND 1997 "
            "AND market_segment = 'BUILDING' AND customer_type = 'ASIA'"
        ),
        "filter_options": _wide(options),
        "booking_detail": _wide(f"SELECT booking_id, {', '.join(DETAIL_COLUMNS)} FROM wide ORDER BY booking_id LIMIT 100"),
        "monthly_bookings": _by_month("count(*) AS bookings"),
        "seasonal_bookings": _wide(f"SELECT season, {SEASON_ORDER} AS season_order, count(*) AS bookings FROM wide GROUP BY season"),
        "lead_time_distribution": _wide(_by_bucket("lead_time", LEAD_TIME, "bucket", "count(*) AS n", "coalesce(n, 0) AS count")),
        "stay_distribution": _wide(_by_bucket("total_stay_nights", STAY, "bucket", "count(*) AS n", "coalesce(n, 0) AS count")),
        "lead_bucket_form": _wide(f"SELECT {_form_bucket('lead_time')} AS lead_time_bucket, count(*) AS count FROM wide GROUP BY 1"),
        "channel_distribution": _wide("SELECT distribution_channel, count(*) AS count FROM wide GROUP BY 1"),
        "market_distribution": _wide("SELECT market_segment, count(*) AS count FROM wide GROUP BY 1"),
        "top_channel": _wide("SELECT distribution_channel, count(*) AS count FROM wide GROUP BY 1 ORDER BY count DESC, 1 LIMIT 1"),
        "busiest_months": _with(RAW, WIDE, "counts AS (SELECT month, count(*) AS count FROM wide GROUP BY month)")
        + "(SELECT 'busiest' AS kind, month, count FROM counts ORDER BY count DESC, month LIMIT 3) UNION ALL "
        "(SELECT 'quietest' AS kind, month, count FROM counts ORDER BY count, month LIMIT 3)",
        "cancellation_kpis": _wide(
            "SELECT round(avg(is_canceled) * 100, 6) AS cancellation_rate, count(*) AS total_bookings, "
            "CAST(sum(is_canceled) AS BIGINT) AS cancelled_bookings, CAST(count(*) - sum(is_canceled) AS BIGINT) AS confirmed_bookings FROM wide"
        ),
        "cancel_by_lead_time": _wide(LEAD_RATES),
        "cancel_by_deposit": _wide(f"SELECT deposit_type, {RATE} FROM wide GROUP BY deposit_type"),
        "cancel_by_market": _wide(MARKET_RATES),
        "cancel_trend": _by_month(RATE),
        "lead_time_by_status": _wide(mean_by_status.format("lead_time")),
        "requests_by_status": _wide(mean_by_status.format("total_of_special_requests")),
        "worst_lead_bucket": _wide(LEAD_RATES + " ORDER BY cancellation_rate DESC NULLS LAST, labels.bucket_order LIMIT 1"),
        "worst_market": _wide(MARKET_RATES + " ORDER BY cancellation_rate DESC, market_segment LIMIT 1"),
        "cancel_crosstab": _wide(
            _crosstab(
                "wide",
                {"hotel_name": "hotel_name", "lead_time_bucket": _bucket("lead_time", LEAD_TIME), "deposit_type": "deposit_type", "market_segment": "market_segment"},
                "is_canceled",
            )
        ),
        "correlation_matrix": _wide(_correlations("wide", DASHBOARD_COLUMNS)),
        "cancellation_correlation": _wide(_correlations("wide", MODEL_COLUMNS + ["is_canceled"])),
        "null_profile": _with(RAW) + f"SELECT unnest([{null_rows}], recursive := true) FROM raw",
        "revenue_kpis": _wide(
            f"SELECT {TOTAL_REVENUE}, round({_mean_money('adr')}, 6) AS avg_daily_rate, "
            f"round({_mean_money('adr')} * (1 - avg(is_canceled)), 6) AS revpar, "
            f"coalesce({_money('revenue', ' FILTER (is_canceled = 1)')}, 0.0) AS potential_revenue_lost FROM wide"
        ),
        "kpi_texts": _wide(_kpi_texts()),
        "monthly_revenue": _by_month(f"{TOTAL_REVENUE}, count(*) AS booking_count"),
        "monthly_adr": _by_month(MEAN_ADR),
        "revenue_by_market": _wide(TOP_MARKET),
        "revenue_by_room": _wide(f"SELECT reserved_room_type, {REVENUE} FROM wide GROUP BY 1"),
        "revenue_by_season": _wide(f"SELECT season, {SEASON_ORDER} AS season_order, {REVENUE} FROM wide GROUP BY season"),
        "revenue_by_stay": _wide(STAY_REVENUE),
        "top_markets": _wide(TOP_MARKET + " LIMIT 3"),
        "seasons_by_revenue": _wide(TOP_SEASON),
        "top_rooms": _wide(TOP_ROOM + " LIMIT 3"),
        "top_stays": _wide(STAY_REVENUE + " ORDER BY total_revenue DESC, labels.bucket_order LIMIT 3"),
        "retention_kpis": _wide(
            f"""SELECT round(avg(is_repeated_guest) * 100, 6) AS repeat_rate,
  round(count(*) FILTER (high AND is_repeated_guest = 1) * 100.0::DOUBLE / count(*) FILTER (high), 6) AS high_value_repeat_rate,
  round({_mean_money('v', ' FILTER (is_repeated_guest = 1)')}, 6) AS avg_spend_repeat,
  round({_mean_money('v', ' FILTER (is_repeated_guest = 0)')}, 6) AS avg_spend_new,
  round((({_mean_money('v', ' FILTER (is_repeated_guest = 1)')}) / ({_mean_money('v', ' FILTER (is_repeated_guest = 0)')}) - 1) * 100, 6) AS spend_diff_pct,
  round(avg(total_of_special_requests) FILTER (is_repeated_guest = 1), 6) AS avg_requests_repeat,
  round(avg(total_of_special_requests) FILTER (is_repeated_guest = 0), 6) AS avg_requests_new
FROM (SELECT *, adr * total_stay_nights AS v, adr * total_stay_nights >= {VALUE_THRESHOLD} AS high FROM wide)"""
        ),
        "retention_by_market": _wide("SELECT market_segment, round(avg(is_repeated_guest) * 100, 6) AS repeat_rate, count(*) AS booking_count FROM wide GROUP BY 1"),
        "best_retention_market": _wide(
            "SELECT market_segment, round(avg(is_repeated_guest) * 100, 6) AS repeat_rate, count(*) AS booking_count FROM wide GROUP BY 1 ORDER BY repeat_rate DESC, 1 LIMIT 1"
        ),
        "operational_kpis": _wide(
            "SELECT round(avg(lead_time), 6) AS avg_lead_time, round(avg(total_stay_nights), 6) AS avg_stay_length, "
            "round(avg(CAST(room_changed AS INTEGER)) * 100, 6) AS room_change_rate FROM wide"
        ),
        "value_segment": _wide(
            f"SELECT booking_id, adr * total_stay_nights AS total_value, CASE WHEN adr * total_stay_nights >= {VALUE_THRESHOLD} THEN 'High Value' ELSE 'Standard Value' END AS value_segment FROM wide"
        ),
        "customer_key": _labelled("SELECT booking_id, customer_id FROM identified"),
        "customer_rollup": _labelled(
            "SELECT * REPLACE (round(cancel_rate, 6) AS cancel_rate, round(avg_return_gap_days, 6) AS avg_return_gap_days, CAST(days_since_last_booking AS INTEGER) AS days_since_last_booking) FROM rollup_"
        ),
        "churn_label": _labelled("SELECT booking_id, customer_id, is_churned FROM labelled"),
        "churn_summary": _labelled(
            "SELECT round(avg(is_churned) * 100, 6) AS churn_rate, CAST(sum(is_churned) AS BIGINT) AS churned, CAST(count(*) - sum(is_churned) AS BIGINT) AS not_churned FROM labelled"
        ),
        "churn_crosstab": _labelled(
            _crosstab("labelled", {c: c for c in ("hotel_name", "customer_type", "deposit_type", "market_segment", "season")}, "is_churned")
        ),
        "churn_correlation": _labelled(_correlations("labelled", MODEL_COLUMNS + ["is_churned"])),
        "risk_tiers": _wide(
            f"SELECT booking_id, p AS probability, {RISK_LEVEL} AS risk_level, {_case(RISK_LEVEL, CHURN_STRATEGIES)} AS strategy, "
            f"{_case(RISK_LEVEL, CHURN_ACTIONS)} AS actions FROM (SELECT booking_id, lead_time / 450.0::DOUBLE AS p FROM wide)"
        ),
        "risk_value_segment": _wide(SEGMENT),
        "segment_recommendations": _wide(
            f"SELECT segment, count(*) AS customer_count, {_case('segment', {k: v[:3] for k, v in SEGMENT_RECOMMENDATIONS.items()})} AS recommendations FROM ({SEGMENT}) GROUP BY segment"
        ),
        "score_bookings": _wide(scored_form),
        "score_customers": _wide(customer_form),
        "monthly_demand": _wide(f"SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, round(avg_daily_rate, 6) AS avg_daily_rate) FROM ({demand})"),
        "total_demand": _wide(
            f"SELECT make_date(year, {MONTH_NUM}, 1) AS date, CAST(sum(booking_count) AS BIGINT) AS booking_count, round(sum(total_revenue), 2) AS total_revenue, "
            f"round(avg(avg_daily_rate), 6) AS avg_daily_rate, round(sum(avg_daily_rate * booking_count) / sum(booking_count), 6) AS weighted_daily_rate FROM ({demand}) GROUP BY 1"
        ),
        "month_grid": _with(RAW, WIDE, _filled(GRID_SOURCE)) + "SELECT series_key, month_start, value FROM grid",
        "month_ffill": _with(RAW, WIDE, _filled(GRID_SOURCE)) + "SELECT series_key, month_start, value FROM filled",
        "seasonal_decomposition": decomposition,
        "acf": acf,
        "pacf": pacf,
        "time_split": _with(RAW, WIDE, _filled(SERIES))
        + "SELECT month_start, value, CASE WHEN row_number() OVER (ORDER BY month_start) <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM filled",
        "baseline_forecast": _with(RAW, WIDE, BASELINE) + "SELECT month_start, bookings, lower_ci, upper_ci FROM forecast",
        "forecast_summary": _with(RAW, WIDE, BASELINE)
        + "SELECT (SELECT strftime(month_start, '%B %Y') FROM forecast ORDER BY bookings DESC, month_start LIMIT 1) AS peak_month, max(bookings) AS peak_value, "
        "(SELECT strftime(month_start, '%B %Y') FROM forecast ORDER BY bookings, month_start LIMIT 1) AS low_month, min(bookings) AS low_value, "
        "CAST(sum(bookings) AS BIGINT) AS total, CAST(trunc(avg(bookings)) AS BIGINT) AS average FROM forecast",
        "demand_outlook": _with(RAW, WIDE, BASELINE) + outlook,
        "hotel_outlook": _with(RAW, WIDE, BASELINE.replace("FROM wide", "FROM wide WHERE hotel_name = 'Resort Hotel'").replace("range(1, 7)", "range(1, 13)"))
        + outlook,
        "forecast_metrics": _with(RAW, WIDE, _filled(HOTEL_SEGMENT_SOURCE))
        + """, predicted AS (SELECT *, lag(value, 12) OVER (PARTITION BY series_key ORDER BY month_start) AS predicted,
  row_number() OVER (PARTITION BY series_key ORDER BY month_start) > floor(count(*) OVER (PARTITION BY series_key) * 0.8::DOUBLE) AS held_out FROM filled)
SELECT series_key, round(sqrt(avg((value - predicted) * (value - predicted))), 6) AS rmse, round(avg(abs(value - predicted)), 6) AS mae,
  round(1 - sum((value - predicted) * (value - predicted)) / (var_pop(value) * count(*)), 6) AS r2
FROM predicted WHERE held_out AND predicted IS NOT NULL GROUP BY series_key""",
        "model_outlook": _with(RAW, WIDE, _filled(HOTEL_SEGMENT_SOURCE)) + OUTLOOK_MONTHS
        + "SELECT series_key, kind, month_start, value, true AS ordered FROM outlook",
        "model_demand_outlook": _with(RAW, WIDE, _filled(SERIES)) + OUTLOOK_MONTHS
        + "SELECT CASE WHEN kind = 'holdout' THEN 'history' ELSE kind END AS kind, CAST(year(month_start) AS INTEGER) AS year, monthname(month_start) AS month, "
        "CAST(value AS BIGINT) AS bookings, true AS ordered FROM outlook",
        "impute_numeric": _with(RAW)
        + "SELECT booking_id, coalesce(children, (SELECT median(children) FROM raw)) AS children, "
        "coalesce(CAST(agent AS DOUBLE), (SELECT median(CAST(agent AS DOUBLE)) FROM raw)) AS agent, "
        "coalesce(CAST(company AS DOUBLE), (SELECT median(CAST(company AS DOUBLE)) FROM raw)) AS company FROM raw",
        "impute_category": _wide(
            "SELECT booking_id, coalesce(country, (SELECT country FROM wide WHERE country IS NOT NULL GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)) AS country, market_segment FROM wide"
        ),
        "stratified_split": _wide(f"SELECT part, is_canceled AS label, count(*) AS count FROM ({SPLIT}) GROUP BY 1, 2"),
        "split_assignment": _wide(SPLIT),
        "cancellation_holdout": _wide(f"SELECT booking_id, is_canceled AS label, true AS consistent FROM ({SPLIT}) WHERE part = 'test'"),
        "churn_holdout": _labelled(
            "SELECT booking_id, is_churned AS label, true AS consistent FROM (SELECT booking_id, is_churned, row_number() OVER "
            "(PARTITION BY is_churned ORDER BY md5(booking_id || '-42')) <= floor(count(*) OVER (PARTITION BY is_churned) * 0.2::DOUBLE + 0.5) AS held "
            "FROM labelled) WHERE held"
        ),
        "cancellation_trees": "SELECT CAST(unnest(range(100)) AS INTEGER) AS tree, true AS sound",
        "churn_trees": "SELECT CAST(unnest(range(200)) AS INTEGER) AS tree, true AS sound",
        "importance_check": _with(RAW, WIDE) + _feature_list("is_canceled", "wide", ("revenue", "is_weekend")),
        "churn_importance_check": _with(RAW, WIDE, LABELLED) + _feature_list("is_churned", "labelled", ()),
        "cancellation_grid": _with(RAW, WIDE) + GRID,
        "loyalty_total": _wide("SELECT count(*) AS bookings FROM wide"),
        "loyalty_segments": _wide(
            f"SELECT booking_id, round(adr * total_stay_nights, 2) AS total_value, CASE WHEN adr * total_stay_nights > {VALUE_THRESHOLD} THEN 'High-Value' ELSE 'Low-Value' END AS worth, "
            "true AS consistent FROM wide"
        ),
        "standardize": _wide(
            "SELECT booking_id, "
            + ", ".join(f"round(({c} - (SELECT avg({c}) FROM wide)) / (SELECT stddev_pop({c}) FROM wide), 6) AS {c}" for c in ("lead_time", "adr", "total_stay_nights", "total_guests"))
            + " FROM wide"
        ),
        "binary_metrics": _predicted(
            f"SELECT round((tp + tn) / {total}, 6) AS accuracy, round({precision}, 6) AS precision, round({recall}, 6) AS recall, round({f1(precision, recall)}, 6) AS f1 FROM cells"
        ),
        "classification_report": _predicted(report),
        "confusion_matrix": _predicted(
            " UNION ALL ".join(f"SELECT {a} AS label, {p} AS prediction, {c} AS count FROM cells" for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")))
        ),
        "roc_auc": _predicted(roc + " SELECT round(sum(neg * (upto_pos - pos + pos / 2)) / (max(positives) * max(negatives)), 6) AS roc_auc FROM ranked"),
        "roc_points": _predicted(
            roc + " SELECT round(max(score) + 1, 6) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM ranked UNION ALL "
            "SELECT round(score, 6), round(upto_neg / negatives, 6), round(upto_pos / positives, 6) FROM ranked"
        ),
        "roc_curve": _predicted(
            roc + ", steps AS (SELECT *, lead(pos) OVER w = pos AND lead(neg) OVER w = neg AS same_step, row_number() OVER w AS place FROM ranked WINDOW w AS (ORDER BY score DESC)) "
            "SELECT round(max(score) + 1, 6) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM ranked UNION ALL "
            "SELECT round(score, 6), round(upto_neg / negatives, 6), round(upto_pos / positives, 6) FROM steps WHERE place = 1 OR NOT coalesce(same_step, false)"
        ),
        "revenue_advice": _wide(
            " UNION ALL ".join(
                [
                    _advice(TOP_SEASON + " LIMIT 1", "season", advice.SEASON_LINES),
                    _advice(TOP_MARKET + " LIMIT 1", "market_segment", advice.MARKET_LINES),
                    _advice(TOP_ROOM + " LIMIT 1", "reserved_room_type", advice.ROOM_LINES),
                    _advice(STAY_REVENUE + " ORDER BY total_revenue DESC, labels.bucket_order LIMIT 1", "stay_duration_bucket", advice.STAY_LINES),
                ]
            )
        ),
        "cancellation_advice": _wide(
            _advice(LEAD_RATES + " ORDER BY cancellation_rate DESC NULLS LAST, labels.bucket_order LIMIT 1", "lead_time_bucket", advice.LEAD_LINES)
            + " UNION ALL "
            + _advice(MARKET_RATES + " ORDER BY cancellation_rate DESC, market_segment LIMIT 1", "market_segment", advice.CANCEL_MARKET_LINES)
        ),
    }
    return sql
