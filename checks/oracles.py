"""SQL counterparts of the registered queries, over the given tables."""

from __future__ import annotations

from checks.tables import SQL_PREFIX
from platterflow import constants as K

FULFILLED = "order_status IN ('Delivered', 'Partially Delivered')"
CANCELLED = "lower(order_status) LIKE '%cancel%'"
MONTHS = "(8, 9, 10, 11, 12)"
FORECAST_YEAR = 2002
REFERENCE_YEAR = 2001


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def whole(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


def risk(x: str) -> str:
    return (f"CASE WHEN {x} >= 0.30e0 THEN 'Critical' WHEN {x} >= 0.18e0 THEN 'High' "
            f"WHEN {x} >= 0.06e0 THEN 'Medium' ELSE 'Normal' END")


def week(x: str) -> str:
    return f"CAST((day({x}) - 1) // 7 + 1 AS INTEGER)"


# --- common table expressions ------------------------------------------------------------------

DELIVERED = SQL_PREFIX + f""",
d_orders AS (
  SELECT order_id, arg_min(CAST(delivery_date AS DATE), line_no) AS date,
    arg_min(station_code, line_no) AS station_code, arg_min(station_name, line_no) AS station_name,
    arg_min(coalesce(nullif(trim(outlet_name), ''), 'Unknown outlet'), line_no) AS outlet_name,
    arg_min(train_no, line_no) AS train_no, arg_min(train_name, line_no) AS train_name,
    coalesce(MAX(amount_payable), {money('gross_item_amount')}) AS revenue
  FROM lines WHERE {FULFILLED} GROUP BY order_id)"""

PANEL = DELIVERED + f""",
panel AS (
  SELECT station_code, MIN(station_name) AS station_name, date, COUNT(*) AS order_count,
    {money('revenue')} AS revenue, COUNT(DISTINCT outlet_name) AS vendor_capacity
  FROM d_orders GROUP BY station_code, date)"""

CALENDAR = """
ev AS (
  SELECT *, CAST(floor((epoch(ts) - epoch(TIMESTAMP '2024-01-01 00:00:00')) / 3600) AS INTEGER) AS h
  FROM events),
cal_rows AS (
  SELECT DATE '1995-01-01' + h * 4 AS date, event_id,
    CASE WHEN event_type <> 'error'
      THEN upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' day'
      ELSE 'Known calendar event' END AS event_name,
    CASE WHEN event_type = 'view' THEN 'Holiday' WHEN h % 2 = 0 THEN 'Fair' ELSE 'Festival' END AS event_type,
    CASE WHEN h % 3 = 0 THEN 1 ELSE 0 END AS festival_flag,
    CASE WHEN h % 5 = 0 THEN 1 ELSE 0 END AS holiday_flag,
    CASE WHEN h % 7 = 0 THEN 1 ELSE 0 END AS local_event_flag
  FROM ev WHERE NOT (event_type = 'error' AND value < 2)),
cal_names AS (
  SELECT date, string_agg(event_name, ' / ' ORDER BY o) AS event_name
  FROM (SELECT date, event_name, MIN(event_id) AS o FROM cal_rows GROUP BY 1, 2) GROUP BY date),
cal_types AS (
  SELECT date, string_agg(event_type, ' / ' ORDER BY o) AS event_type
  FROM (SELECT date, event_type, MIN(event_id) AS o FROM cal_rows GROUP BY 1, 2) GROUP BY date),
cal AS (
  SELECT date, n.event_name, t.event_type, f.festival_flag, f.holiday_flag, f.local_event_flag
  FROM (SELECT date, MAX(festival_flag) AS festival_flag, MAX(holiday_flag) AS holiday_flag,
          MAX(local_event_flag) AS local_event_flag FROM cal_rows GROUP BY date) f
    JOIN cal_names n USING (date) JOIN cal_types t USING (date))"""

FEATURES = PANEL + "," + CALENDAR + """,
seg0 AS (
  SELECT p.*, c.event_name, c.event_type, coalesce(c.festival_flag, 0) AS festival_flag,
    coalesce(c.holiday_flag, 0) AS holiday_flag, coalesce(c.local_event_flag, 0) AS local_event_flag,
    CAST(month(p.date) AS INTEGER) AS month, CAST(isodow(p.date) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN isodow(p.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN date_diff('day', lag(p.date) OVER (PARTITION BY station_code ORDER BY p.date), p.date) = 1
      THEN 0 ELSE 1 END AS new_segment
  FROM panel p LEFT JOIN cal c ON p.date = c.date),
seg AS (
  SELECT *, CAST(SUM(new_segment) OVER (PARTITION BY station_code ORDER BY date
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM seg0),
features AS (
  SELECT *, CAST(lag(order_count) OVER (PARTITION BY station_code, segment ORDER BY date) AS DOUBLE)
      AS lag_1_demand,
    CASE WHEN COUNT(order_count) OVER w >= 2 THEN AVG(order_count) OVER w END AS rolling_7_demand
  FROM seg WINDOW w AS (PARTITION BY station_code, segment ORDER BY date
    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
complete AS (SELECT * FROM features WHERE lag_1_demand IS NOT NULL AND rolling_7_demand IS NOT NULL),
cut AS (SELECT MAX(date) - 30 AS cutoff FROM complete)"""

PROFILES = """
aged AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY station_code ORDER BY date DESC) AS age FROM panel),
profiles AS (
  SELECT station_code, station_name, median(vendor_capacity) AS current_vendor_count,
    median(order_count / greatest(vendor_capacity, 1)) AS orders_per_vendor,
    CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
    CAST(SUM(order_count) AS BIGINT) AS orders,
    AVG(order_count) FILTER (age <= 28) AS baseline_daily_orders,
    CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) / greatest(SUM(order_count), 1)
      AS average_order_value
  FROM aged GROUP BY station_code, station_name),
seeds AS (
  SELECT station_code, list(CAST(order_count AS DOUBLE) ORDER BY date) AS history
  FROM aged WHERE age <= 7 GROUP BY station_code)"""

HORIZON = PANEL.replace("WITH lines", "WITH RECURSIVE lines", 1) + "," + CALENDAR + "," + PROFILES + f""",
days AS (
  SELECT step, d.date, coalesce(festival_flag, 0) AS festival_flag,
    coalesce(holiday_flag, 0) AS holiday_flag, coalesce(local_event_flag, 0) AS local_event_flag,
    event_name, event_type, CAST(month(d.date) AS INTEGER) AS month,
    CAST(isodow(d.date) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN isodow(d.date) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT CAST(s AS INTEGER) AS step, (SELECT MAX(date) FROM panel) + CAST(s AS INTEGER) AS date
        FROM range(1, 31) r(s)) d LEFT JOIN cal ON d.date = cal.date),
steps AS (
  SELECT station_code, 0 AS step, history, CAST(NULL AS DOUBLE) AS prediction FROM seeds
  UNION ALL
  SELECT station_code, step, list_slice(list_append(history, prediction), -7, -1), prediction FROM (
    SELECT s.station_code, d.step, s.history, greatest(
      (0.5e0 * s.history[-1] + 0.5e0 * (list_sum(s.history) / len(s.history)))
      * (1 + 0.05e0 * d.is_weekend + 0.20e0 * d.festival_flag + 0.10e0 * d.holiday_flag
         - 0.05e0 * d.local_event_flag), 0) AS prediction
    FROM steps s JOIN days d ON d.step = s.step + 1)),
horizon AS (
  SELECT s.station_code, p.station_name, d.date, d.month, d.day_of_week, d.is_weekend, d.festival_flag,
    d.holiday_flag, d.local_event_flag, d.event_name, d.event_type, s.prediction,
    p.current_vendor_count, p.orders_per_vendor, p.baseline_daily_orders, p.average_order_value
  FROM steps s JOIN days d USING (step) JOIN profiles p USING (station_code)),
gaps AS (
  SELECT *, greatest(prediction - greatest(baseline_daily_orders * 1.10e0, 1), 0) AS gap,
    greatest(prediction - greatest(baseline_daily_orders * 1.10e0, 1), 0) / greatest(prediction, 1) AS gap_share,
    {whole('current_vendor_count')} AS vendors,
    greatest(1, {whole('prediction / greatest(orders_per_vendor, 1)')}) AS needed
  FROM horizon),
daily AS (
  SELECT station_code AS "stationCode", station_name AS "stationName", strftime(date, '%Y-%m-%d') AS date,
    {whole('prediction')} AS "forecastOrders",
    {whole('prediction * average_order_value')} AS "forecastRevenue",
    {whole('gap * average_order_value')} AS "revenueAtRisk",
    vendors AS "currentVendorCount", needed AS "recommendedVendorCount",
    greatest(needed - vendors, 0) AS "vendorGap", {whole('baseline_daily_orders')} AS "baselineDailyOrders",
    {whole('greatest(20, least(100, 100 - gap_share * 200))')} AS "readinessScore",
    {risk('gap_share')} AS "riskLevel", festival_flag = 1 AS festival, holiday_flag = 1 AS holiday,
    event_name AS "eventName", event_type AS "eventType"
  FROM gaps)"""

OUTLOOK = HORIZON + f""",
rolled AS (
  SELECT "stationCode", "stationName", CAST(SUM("forecastOrders") AS BIGINT) AS "forecastOrders",
    CAST(SUM("forecastRevenue") AS BIGINT) AS "forecastRevenue",
    CAST(SUM("revenueAtRisk") AS BIGINT) AS "revenueAtRisk",
    MAX("recommendedVendorCount") AS "recommendedVendorCount",
    MAX("currentVendorCount") AS "currentVendorCount", MAX("vendorGap") AS "vendorGap",
    MAX("baselineDailyOrders") AS "baselineDailyOrders", MIN("readinessScore") AS "readinessScore"
  FROM daily GROUP BY 1, 2),
shared AS (
  SELECT *, round_even(("forecastOrders" / greatest("baselineDailyOrders" * 30, 1) - 1) * 100, 1)
      AS "demandUpliftPercent",
    round_even("revenueAtRisk" / greatest("forecastRevenue", 1) * 100, 1) AS "riskSharePercent"
  FROM rolled),
outlook AS (
  SELECT *, {risk('"riskSharePercent" / 100')} AS "riskLevel",
    CASE WHEN {risk('"riskSharePercent" / 100')} = 'Normal'
      THEN 'Maintain normal operations and monitor live demand.'
      ELSE 'Add ' || "vendorGap" || ' vendor(s), stage inventory and review the next peak window.' END
      AS "recommendedAction"
  FROM shared)"""

SHARES = """
recent AS (
  SELECT station_code, train_no, train_name, COUNT(*) AS "recentOrders" FROM d_orders
  WHERE date >= (SELECT MAX(date) - 90 FROM d_orders) GROUP BY 1, 2, 3 HAVING COUNT(*) >= 2),
shares AS (
  SELECT station_code, train_no, train_name, "recentOrders", "routeShare" FROM (
    SELECT *, "recentOrders" / SUM("recentOrders") OVER (PARTITION BY station_code) AS "routeShare",
      ROW_NUMBER() OVER (PARTITION BY station_code ORDER BY "recentOrders" DESC, train_no, train_name) AS place
    FROM recent) WHERE place <= 5)"""

ROUTES = HORIZON + "," + SHARES + f""",
spread AS (
  SELECT "stationCode", "stationName", train_no AS "trainNo", train_name AS "trainName",
    CAST(round_even(SUM("forecastOrders") * "routeShare", 0) AS BIGINT) AS "forecastOrders",
    CAST(round_even(SUM("forecastRevenue") * "routeShare", 0) AS BIGINT) AS "forecastRevenue",
    CAST(round_even(SUM("revenueAtRisk") * "routeShare", 0) AS BIGINT) AS "revenueAtRisk", "routeShare"
  FROM daily JOIN shares ON "stationCode" = station_code
  GROUP BY "stationCode", "stationName", train_no, train_name, "routeShare"),
routes AS (
  SELECT *, round_even("routeShare" * 100, 1) AS "routeSharePercent",
    {risk('"revenueAtRisk" / greatest("forecastRevenue", 1)')} AS "riskLevel" FROM spread)"""

ALERTS = """
per_day AS (
  SELECT date, "eventName", "eventType", CAST(SUM("forecastOrders") AS BIGINT) AS "forecastOrders",
    CAST(SUM("revenueAtRisk") AS BIGINT) AS "revenueAtRisk" FROM daily GROUP BY 1, 2, 3),
alerts AS (
  SELECT date, "eventName", "eventType",
    CAST(greatest(date_diff('day', (SELECT MIN(CAST(date AS DATE)) FROM per_day), CAST(date AS DATE)), 0)
      AS INTEGER) AS "daysUntil", "forecastOrders",
    round_even(("forecastOrders" / greatest(
      (SELECT AVG("forecastOrders") FROM per_day WHERE "eventName" IS NULL), 1) - 1) * 100, 1)
      AS "expectedDemandChangePercent", "revenueAtRisk"
  FROM per_day WHERE "eventName" IS NOT NULL)"""

BOOKED = SQL_PREFIX + f""",
b_orders AS (
  SELECT order_id, arg_min(booking_date, line_no) AS booking_date,
    arg_min(station_code, line_no) AS station_code, arg_min(station_name, line_no) AS station_name,
    CAST(year(MIN(booking_date)) AS INTEGER) AS year, CAST(month(MIN(booking_date)) AS INTEGER) AS month_number,
    strftime(MIN(booking_date), '%Y-%m') AS month, {week('MIN(booking_date)')} AS week_of_month,
    bool_or({CANCELLED}) AS is_cancelled,
    coalesce(MAX(amount_payable), {money('gross_item_amount')}) AS revenue
  FROM lines GROUP BY order_id)"""

KPIS = f"""COUNT(*) AS "orderCount", CAST(SUM(CAST(is_cancelled AS INTEGER)) AS BIGINT) AS "cancelledOrders",
    {money('revenue')} AS revenue,
    coalesce(CAST(SUM(CASE WHEN is_cancelled THEN CAST(revenue AS DECIMAL(18,4)) END) AS DOUBLE), 0)
      AS "revenueLoss\""""

HISTORY = BOOKED + f""",
months0 AS (
  SELECT station_code AS "stationCode", MIN(station_name) AS "stationName", year,
    month_number AS "monthNumber", month, {KPIS}
  FROM b_orders GROUP BY station_code, year, month_number, month),
months AS (
  SELECT *, "cancelledOrders" / greatest("orderCount", 1) AS "cancelRate",
    year - (SELECT MIN(year) FROM months0 WHERE "monthNumber" IN {MONTHS}) AS "yearIndex" FROM months0),
weeks AS (
  SELECT station_code AS "stationCode", year, month_number AS "monthNumber",
    week_of_month AS "weekOfMonth", {KPIS}
  FROM b_orders GROUP BY station_code, year, month_number, week_of_month)"""

CARDS = HISTORY + f""",
train AS (SELECT * FROM months WHERE "monthNumber" IN {MONTHS}),
fitted AS (
  SELECT "stationCode", "monthNumber", COUNT(*) AS n, SUM("yearIndex") AS sx, SUM("orderCount") AS sy,
    SUM("yearIndex" * "orderCount") AS sxy, SUM("yearIndex" * "yearIndex") AS sxx
  FROM train GROUP BY 1, 2),
sloped AS (
  SELECT *, coalesce(CAST(n * sxy - sx * sy AS DOUBLE) / nullif(n * sxx - sx * sx, 0), 0) AS slope FROM fitted),
estimated AS (
  SELECT "stationCode", "monthNumber", greatest((sy - slope * sx) / n
    + slope * ({FORECAST_YEAR} - (SELECT MIN(year) FROM train)), 0) AS model_orders FROM sloped),
past AS (
  SELECT "stationCode", "monthNumber", MIN("stationName") AS "stationName",
    coalesce(MAX(CASE WHEN year = {REFERENCE_YEAR} THEN "orderCount" END), arg_max("orderCount", year))
      AS "referenceOrders",
    AVG("orderCount") FILTER (age <= 3) AS seasonal, AVG("cancelRate") AS rate,
    AVG(revenue / greatest("orderCount", 1)) AS value, COUNT(DISTINCT year) AS "historicalYears",
    stddev_pop("orderCount") / greatest(AVG("orderCount"), 1) AS volatility
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "stationCode", "monthNumber" ORDER BY year DESC) AS age FROM train)
  GROUP BY 1, 2),
blended AS (
  SELECT *, {whole('greatest(0.70e0 * seasonal + 0.30e0 * model_orders, 0)')} AS "forecastOrders"
  FROM past JOIN estimated USING ("stationCode", "monthNumber")),
valued AS (SELECT *, {whole('"forecastOrders" * value')} AS "predictedRevenue" FROM blended),
cards AS (
  SELECT "stationCode", "stationName", '{FORECAST_YEAR}-' || lpad(CAST("monthNumber" AS VARCHAR), 2, '0') AS month,
    "monthNumber", "forecastOrders",
    round_even(("forecastOrders" / greatest("referenceOrders", 1) - 1) * 100, 1) AS "predictedPercentage",
    {whole('"forecastOrders" * rate')} AS "forecastCancelledOrders",
    {whole('"predictedRevenue" * rate')} AS "forecastRevenueLoss", "predictedRevenue",
    CAST(trunc(greatest(55, least(94, 56 + "historicalYears" * 13 - volatility * 12))) AS BIGINT)
      AS "confidenceScore", "referenceOrders", "historicalYears",
    round_even(rate * 100, 1) AS "averageCancellationRate"
  FROM valued)"""

ITEM_WEEKS = f"""
item_weeks AS (
  SELECT station_code AS "stationCode", MIN(station_name) AS "stationName",
    CAST(year(booking_date) AS INTEGER) AS year, CAST(month(booking_date) AS INTEGER) AS "monthNumber",
    {week('booking_date')} AS "weekOfMonth", item_name AS item, SUM(quantity) AS units
  FROM lines WHERE {FULFILLED} AND month(booking_date) IN {MONTHS} GROUP BY ALL)"""

WEEK_ITEMS = f"""
pooled AS (
  SELECT "stationCode", "monthNumber", "weekOfMonth", item,
    SUM(units) FILTER (year = {REFERENCE_YEAR}) AS ref, SUM(units) AS total
  FROM item_weeks GROUP BY ALL),
marked AS (
  SELECT *, COUNT(ref) OVER (PARTITION BY "stationCode", "monthNumber", "weekOfMonth") > 0 AS has_ref FROM pooled),
week_items AS (
  SELECT "stationCode", "monthNumber", "weekOfMonth", rank, item, units FROM (
    SELECT "stationCode", "monthNumber", "weekOfMonth", item, CASE WHEN has_ref THEN ref ELSE total END AS units,
      CAST(ROW_NUMBER() OVER (PARTITION BY "stationCode", "monthNumber", "weekOfMonth"
        ORDER BY CASE WHEN has_ref THEN ref ELSE total END DESC, item) AS INTEGER) AS rank
    FROM marked WHERE NOT has_ref OR ref IS NOT NULL) WHERE rank <= 10)"""

RANKING = CARDS + "," + ITEM_WEEKS + f""",
actual AS (
  SELECT "stationCode", "stationName", year, "monthNumber", item, units, rank FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY "stationCode", year, "monthNumber"
      ORDER BY units DESC, item) AS INTEGER) AS rank
    FROM (SELECT "stationCode", MIN("stationName") AS "stationName", year, "monthNumber", item, SUM(units) AS units
          FROM item_weeks GROUP BY "stationCode", year, "monthNumber", item)) WHERE rank <= 10),
listed AS (
  SELECT *, bool_or(year = {REFERENCE_YEAR}) OVER (PARTITION BY "stationCode", "monthNumber") AS has_ref,
    ROW_NUMBER() OVER (PARTITION BY "stationCode", "monthNumber" ORDER BY year DESC, rank) AS place
  FROM actual),
ranking AS (
  SELECT "stationCode", "stationName", year, "monthNumber", CAST(NULL AS VARCHAR) AS month, item, units, rank,
    false AS "isForecast" FROM actual
  UNION ALL
  SELECT c."stationCode", c."stationName", {FORECAST_YEAR}, c."monthNumber", c.month, l.item,
    CAST({whole('l.units * c."forecastOrders" / greatest(c."referenceOrders", 1)')} AS DOUBLE), l.rank, true
  FROM cards c JOIN listed l ON c."stationCode" = l."stationCode" AND c."monthNumber" = l."monthNumber"
  WHERE CASE WHEN has_ref THEN l.year = {REFERENCE_YEAR} ELSE place <= 10 END)"""

_MEASURES = ("forecastOrders", "forecastCancelledOrders", "predictedRevenue", "forecastRevenueLoss")
_ROUNDED = ", ".join(f"""{whole(f'"{m}" * share')} AS r{i}""" for i, m in enumerate(_MEASURES))
_SETTLED = ", ".join(
    f"""CASE WHEN week = 1 THEN r{i} + "{m}" - CAST(SUM(r{i}) OVER (PARTITION BY "stationCode", "monthNumber") AS BIGINT)
    ELSE r{i} END AS "{m}\"""" for i, m in enumerate(_MEASURES))

ALLOCATION = f"""
slots AS (
  SELECT c.*, CAST(w AS INTEGER) AS week, CAST(month || '-01' AS DATE) AS month_start
  FROM cards c, range(1, 6) r(w)
  WHERE w <= (day(last_day(CAST(c.month || '-01' AS DATE))) - 1) // 7 + 1),
week_sums AS (
  SELECT "stationCode", "monthNumber", "weekOfMonth" AS week,
    SUM("orderCount") FILTER (year = {REFERENCE_YEAR}) AS ref, SUM("orderCount") AS total FROM weeks GROUP BY ALL),
week_base AS (
  SELECT "stationCode", "monthNumber", week,
    CASE WHEN COUNT(ref) OVER (PARTITION BY "stationCode", "monthNumber") > 0 THEN coalesce(ref, 0) ELSE total END AS n
  FROM week_sums),
weighted AS (
  SELECT s.*, CASE WHEN SUM(coalesce(n, 0)) OVER w = 0 THEN 1 / COUNT(*) OVER w
    ELSE coalesce(n, 0) / SUM(coalesce(n, 0)) OVER w END AS share
  FROM slots s LEFT JOIN week_base USING ("stationCode", "monthNumber", week)
  WINDOW w AS (PARTITION BY "stationCode", "monthNumber")),
rounded AS (SELECT *, {_ROUNDED} FROM weighted),
allocation AS (
  SELECT "stationCode", month, "monthNumber", week,
    'Week ' || week || ' · ' || strftime(month_start + (week - 1) * 7, '%d %b') || ' - '
      || strftime(least(month_start + (week - 1) * 7 + 6, last_day(month_start)), '%d %b') AS label,
    r0 AS weekly_orders, {_SETTLED}
  FROM rounded)"""

DEMAND = SQL_PREFIX + f""",
demand AS (
  SELECT order_id, created_at AS date, CAST(date_trunc('month', created_at) AS DATE) AS month,
    item_name AS food_item, quantity AS quantity_sold, station_name AS city, railway_zone AS region,
    CASE WHEN discount > 0 THEN 1 ELSE 0 END AS promotion_active, food_type, is_veg, outlet_name, line_no
  FROM lines WHERE {FULFILLED}),
item_months AS (
  SELECT month, food_item, SUM(quantity_sold) AS quantity_sold, arg_max(city, line_no) AS city,
    arg_max(region, line_no) AS region, arg_max(promotion_active, line_no) AS promotion_active,
    arg_max(food_type, line_no) AS food_type, arg_max(is_veg, line_no) AS is_veg,
    COUNT(DISTINCT outlet_name) AS vendor_availability, COUNT(DISTINCT city) AS city_coverage,
    COUNT(DISTINCT region) AS region_coverage
  FROM demand GROUP BY month, food_item)"""

LAGGED = DEMAND + """,
lagged AS (
  SELECT *, lag(quantity_sold, 1) OVER w AS lag_1_month, lag(quantity_sold, 3) OVER w AS lag_3_month,
    AVG(quantity_sold) OVER (PARTITION BY food_item ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
      AS rolling_3_month_mean,
    lead(month) OVER w AS target_month, lead(quantity_sold) OVER w AS next_month_quantity
  FROM item_months WINDOW w AS (PARTITION BY food_item ORDER BY month)),
pairs AS (SELECT * FROM lagged WHERE target_month = CAST(month + INTERVAL 1 MONTH AS DATE)),
future AS (
  SELECT *, CAST(month + INTERVAL 1 MONTH AS DATE) AS next_month FROM lagged
  WHERE month = (SELECT MAX(month) FROM lagged)),
item_forecast AS (
  SELECT strftime(next_month, '%Y-%m') AS forecast_month, food_item,
    greatest(coalesce(rolling_3_month_mean, quantity_sold), 0) AS forecast_quantity,
    ROW_NUMBER() OVER (ORDER BY greatest(coalesce(rolling_3_month_mean, quantity_sold), 0) DESC, food_item) AS rank
  FROM future)"""

DASHBOARD = SQL_PREFIX + f""",
dash AS (
  SELECT *, strftime(booking_date, '%Y-%m') AS month, {CANCELLED} AS is_cancelled, {FULFILLED} AS is_fulfilled
  FROM lines),
dash_orders AS (
  SELECT order_id, MIN(month) AS month, arg_max(order_status, line_no) AS status,
    bool_or(is_cancelled) AS is_cancelled,
    coalesce(MAX(amount_payable), {money('gross_item_amount')}) AS revenue
  FROM dash GROUP BY order_id),
item_units AS (
  SELECT item_name AS item, month, SUM(quantity) AS units FROM dash WHERE is_fulfilled GROUP BY 1, 2),
item_history AS (
  SELECT item, SUM(units) AS units, COUNT(*) AS observed_months, MAX(month) AS latest_month,
    SUM(units) FILTER (month = (SELECT MAX(month) FROM item_units)) AS latest_units,
    (SELECT MAX(month) FROM item_units) AS overall_month
  FROM item_units GROUP BY item)"""

TOTALS = SQL_PREFIX + f""",
totals AS (
  SELECT strftime(created_at, '%Y-%m') AS month, item_name, SUM(quantity) AS units_sold, COUNT(*) AS order_lines,
    COUNT(DISTINCT outlet_name) AS active_vendors, COUNT(DISTINCT station_name) AS active_stations
  FROM lines WHERE {FULFILLED} GROUP BY 1, 2),
winners AS (
  SELECT month, CAST(place AS INTEGER) AS rank, item_name AS top_seller, units_sold, order_lines, active_vendors,
    active_stations
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY units_sold DESC, order_lines DESC, item_name)
        AS place FROM totals) WHERE place = 1)"""

BOOKING = SQL_PREFIX + f""",
k_orders AS (
  SELECT order_id, MIN(booking_date) AS booking_date, arg_min(eta, line_no) AS eta,
    bool_or({CANCELLED}) AS cancelled, arg_min(station_code, line_no) AS station_code,
    arg_min(outlet_name, line_no) AS outlet_name, arg_min(food_type, line_no) AS food_type,
    arg_min(payment_type, line_no) AS payment_type,
    arg_min(CASE WHEN is_veg THEN 'true' ELSE 'false' END, line_no) AS is_veg,
    COUNT(DISTINCT item_name) AS item_count, SUM(quantity) AS total_quantity,
    {money('selling_price')} AS total_selling_price, {money('discount')} AS total_discount
  FROM lines GROUP BY order_id),
bookings AS (
  SELECT *, CAST(month(booking_date) AS INTEGER) AS booking_month,
    CAST(isodow(booking_date) - 1 AS INTEGER) AS booking_day_of_week,
    CAST(hour(booking_date) AS INTEGER) AS booking_hour,
    CASE WHEN isodow(booking_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, CAST(hour(eta) AS INTEGER) AS eta_hour,
    date_diff('microsecond', booking_date, eta) / 3.6e9 AS eta_lead_hours
  FROM k_orders),
last_month AS (SELECT MAX(date_trunc('month', booking_date)) AS m FROM bookings),
k_train AS (SELECT * FROM bookings WHERE date_trunc('month', booking_date) < (SELECT m FROM last_month)),
k_test AS (SELECT * FROM bookings WHERE date_trunc('month', booking_date) = (SELECT m FROM last_month)),
quota AS (
  SELECT CASE WHEN SUM(n) > 5000 THEN least(2500, MIN(n)) ELSE SUM(n) END AS q
  FROM (SELECT cancelled, COUNT(*) AS n FROM k_train GROUP BY cancelled)),
sample AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cancelled ORDER BY md5(CAST(order_id AS VARCHAR) || '|42'), order_id) AS place
    FROM k_train) WHERE place <= (SELECT q FROM quota))"""

_TEXT = SQL_PREFIX + """,
cells AS (
  SELECT order_id, order_status, booking_date, CASE WHEN l_linenumber <> 7 THEN delivery_date END AS delivery_date,
    station_code, CASE WHEN l_linenumber <> 5 THEN station_name ELSE 'Unknown station' END AS station_name,
    coalesce(nullif(trim(outlet_name), ''), 'Unknown outlet') AS outlet_name, train_no, train_name, item_name,
    CASE WHEN l_linenumber <> 4 THEN quantity ELSE 0 END AS quantity, amount_payable,
    CASE WHEN l_linenumber <> 3 THEN gross_item_amount ELSE 0 END AS gross_item_amount
  FROM lines)"""

_AUDIT = ["station_code", "month", "day_of_week", "is_weekend", "festival_flag", "holiday_flag",
          "local_event_flag", "lag_1_demand", "rolling_7_demand", "vendor_capacity", "order_count"]

_PROFILED = ("order_id", "order_status", "booking_date", "delivery_date", "station_code", "outlet_name", "item_name",
             "amount_payable", "quantity")
_ORDER_COLUMNS = ("order_id", "station_code", "outlet_name", "food_type", "payment_type", "is_veg", "booking_month",
                  "booking_day_of_week", "booking_hour", "is_weekend", "eta_hour", "eta_lead_hours", "item_count",
                  "total_quantity", "total_selling_price", "total_discount")

ORACLES = {
    "clean_lines": _TEXT + f"""
SELECT order_id, CAST(delivery_date AS DATE) AS date, station_code, station_name, outlet_name, train_no, train_name,
  amount_payable, gross_item_amount FROM cells WHERE {FULFILLED} AND delivery_date IS NOT NULL""",
    "clean_booked_lines": _TEXT + f"""
SELECT order_id, booking_date, station_code, station_name, item_name, order_status, quantity, amount_payable,
  gross_item_amount, CAST(year(booking_date) AS INTEGER) AS year, CAST(month(booking_date) AS INTEGER) AS month_number,
  strftime(booking_date, '%Y-%m') AS month, {week('booking_date')} AS week_of_month, {CANCELLED} AS is_cancelled,
  {FULFILLED} AS is_fulfilled FROM cells""",
    "dedupe_orders_delivery": DELIVERED + " SELECT * FROM d_orders",
    "dedupe_orders_booking": BOOKED + " SELECT * FROM b_orders",
    "dedupe_orders_status_last": DASHBOARD + " SELECT * FROM dash_orders",
    "calendar_collapse": "WITH " + CALENDAR + " SELECT * FROM cal",
    "daily_panel": PANEL + " SELECT * FROM panel",
    "daily_features": FEATURES + " SELECT * FROM features",
    "feature_null_audit": FEATURES + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, COUNT(*) AS rows, COUNT({c}) AS present, COUNT(*) - COUNT({c}) AS missing FROM features"
        for c in _AUDIT),
    "chrono_split_30d": FEATURES + """
SELECT CASE WHEN date <= cutoff THEN 'train' ELSE 'test' END AS part, COUNT(*) AS row_count, MIN(date) AS first_date,
  MAX(date) AS last_date, CAST(SUM(order_count) AS BIGINT) AS orders FROM complete, cut GROUP BY 1""",
    "regression_metrics": FEATURES + """
SELECT round_even(sqrt(AVG((order_count - rolling_7_demand) ** 2)), 2) AS rmse,
  round_even(AVG(abs(order_count - rolling_7_demand)), 2) AS mae,
  round_even(1 - SUM((order_count - rolling_7_demand) ** 2) / (var_pop(order_count) * COUNT(*)), 4) AS r2,
  COUNT(*) AS rows FROM complete, cut WHERE date > cutoff""",
    "holdout_mape": LAGGED + """
SELECT round(AVG(abs(next_month_quantity - coalesce(rolling_3_month_mean, quantity_sold))
  / greatest(abs(next_month_quantity), 2.220446049250313e-16)) * 100, 6) AS mape
FROM pairs WHERE target_month = (SELECT MAX(target_month) FROM pairs)""",
    "station_capacity": PANEL + "," + PROFILES + " SELECT * FROM profiles",
    "seed_history": PANEL + "," + PROFILES + """
SELECT station_code, CAST(len(history) AS INTEGER) AS size,
  array_to_string(list_transform(history, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS history FROM seeds""",
    "recursive_forecast": HORIZON + """
SELECT station_code, date, month, day_of_week, is_weekend, festival_flag, holiday_flag, local_event_flag,
  round(prediction, 6) AS prediction FROM horizon""",
    "readiness_daily": HORIZON + " SELECT * FROM daily",
    "station_summary": OUTLOOK + " SELECT * FROM outlook",
    "route_shares": DELIVERED + "," + SHARES + " SELECT * FROM shares",
    "route_forecast": ROUTES + " SELECT * FROM routes",
    "event_alerts": HORIZON + "," + ALERTS + " SELECT * FROM alerts",
    "station_month_kpis": HISTORY + " SELECT * FROM months",
    "station_week_history": HISTORY + " SELECT * FROM weeks",
    "weekly_top_items": SQL_PREFIX + "," + ITEM_WEEKS + "," + WEEK_ITEMS + " SELECT * FROM week_items",
    "monthly_station_forecast": CARDS + " SELECT * FROM cards",
    "monthly_item_ranking": RANKING + " SELECT * FROM ranking",
    "weekly_allocation": CARDS + "," + ALLOCATION + " SELECT * EXCLUDE (weekly_orders) FROM allocation",
    "weekly_item_allocation": CARDS + "," + ALLOCATION + "," + ITEM_WEEKS + "," + WEEK_ITEMS + f"""
SELECT a."stationCode", a."monthNumber", a.week, i.rank, i.item,
  {whole('i.units * a.weekly_orders / greatest(coalesce(b.ref, b.total, 0), 1)')} AS units
FROM allocation a JOIN week_items i ON a."stationCode" = i."stationCode" AND a."monthNumber" = i."monthNumber"
    AND a.week = i."weekOfMonth"
  LEFT JOIN week_sums b ON a."stationCode" = b."stationCode" AND a."monthNumber" = b."monthNumber" AND a.week = b.week""",
    "station_trend": CARDS + f"""
SELECT m."stationCode", m."monthNumber", m.year, m."orderCount" AS orders, m."cancelledOrders",
  CAST(trunc(m.revenue) AS BIGINT) AS revenue, CAST(trunc(m."revenueLoss") AS BIGINT) AS "revenueLoss",
  false AS "isForecast" FROM months m JOIN cards c ON m."stationCode" = c."stationCode" AND m."monthNumber" = c."monthNumber"
WHERE m.year BETWEEN {FORECAST_YEAR - 4} AND {REFERENCE_YEAR}
UNION ALL SELECT "stationCode", "monthNumber", {FORECAST_YEAR}, "forecastOrders", "forecastCancelledOrders",
  "predictedRevenue", "forecastRevenueLoss", true FROM cards""",
    "top_items_by_year": RANKING + f"""
SELECT s."stationCode", s."monthNumber", s.year, s.year = {FORECAST_YEAR} AS "isForecast", r.rank, r.item, r.units
FROM (SELECT "stationCode", "monthNumber", CAST(y AS INTEGER) AS year
      FROM cards, range({FORECAST_YEAR - 4}, {FORECAST_YEAR + 1}) t(y)) s
  LEFT JOIN ranking r ON s."stationCode" = r."stationCode" AND s."monthNumber" = r."monthNumber" AND s.year = r.year""",
    "detail_week_items": CARDS + "," + ALLOCATION + "," + ITEM_WEEKS + "," + WEEK_ITEMS + f"""
SELECT a."stationCode", a.month, '{REFERENCE_YEAR} reference volume: ' || format('{{:,}}', c."referenceOrders")
    || ' orders' AS driver, a.week, a.label, a."forecastOrders", a."predictedRevenue", i.rank, i.item,
  {whole('i.units * a.weekly_orders / greatest(coalesce(b.ref, b.total, 0), 1)')} AS units
FROM allocation a JOIN cards c ON a."stationCode" = c."stationCode" AND a."monthNumber" = c."monthNumber"
  LEFT JOIN week_items i ON a."stationCode" = i."stationCode" AND a."monthNumber" = i."monthNumber"
    AND a.week = i."weekOfMonth"
  LEFT JOIN week_sums b ON a."stationCode" = b."stationCode" AND a."monthNumber" = b."monthNumber" AND a.week = b.week""",
    "detail_trend": RANKING + f""",
sizes AS (
  SELECT "stationCode", "monthNumber", string_agg(CAST(n AS VARCHAR), ',' ORDER BY year) AS "listSizes" FROM (
    SELECT s."stationCode", s."monthNumber", s.year, COUNT(r.item) AS n
    FROM (SELECT "stationCode", "monthNumber", CAST(y AS INTEGER) AS year
          FROM cards, range({FORECAST_YEAR - 4}, {FORECAST_YEAR + 1}) t(y)) s
      LEFT JOIN ranking r ON s."stationCode" = r."stationCode" AND s."monthNumber" = r."monthNumber" AND s.year = r.year
    GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT c."stationCode", c.month, z."listSizes", t.year, t.orders, t."cancelledOrders", t.revenue, t."revenueLoss",
  t."isForecast"
FROM cards c JOIN sizes z ON c."stationCode" = z."stationCode" AND c."monthNumber" = z."monthNumber"
  JOIN (SELECT "stationCode", "monthNumber", year, "orderCount" AS orders, "cancelledOrders",
          CAST(trunc(revenue) AS BIGINT) AS revenue, CAST(trunc("revenueLoss") AS BIGINT) AS "revenueLoss",
          false AS "isForecast" FROM months WHERE year BETWEEN {FORECAST_YEAR - 4} AND {REFERENCE_YEAR}
        UNION ALL SELECT "stationCode", "monthNumber", {FORECAST_YEAR}, "forecastOrders", "forecastCancelledOrders",
          "predictedRevenue", "forecastRevenueLoss", true FROM cards) t
    ON c."stationCode" = t."stationCode" AND c."monthNumber" = t."monthNumber\"""",
    "detail_cards": CARDS + f"""
SELECT "stationCode", "stationName", month, "forecastOrders", "predictedPercentage", "forecastCancelledOrders",
  "forecastRevenueLoss", "predictedRevenue", "confidenceScore", position,
  CASE position WHEN 0 THEN "historicalYears" || ' years of same-month station history'
    WHEN 1 THEN '{REFERENCE_YEAR} reference volume: ' || format('{{:,}}', CAST("referenceOrders" AS BIGINT)) || ' orders'
    WHEN 2 THEN 'Historical cancellation rate: ' || "averageCancellationRate" || '%'
    WHEN 3 THEN '{K.DRIVERS[3]}' ELSE '{K.DRIVERS[4].replace("'", "''")}' END AS driver
FROM cards, (SELECT unnest([0, 1, 2, 3, 4]) AS position)""",
    "schema_adapter": DEMAND + """
SELECT order_id, date, month, food_item, quantity_sold, city, region, promotion_active FROM demand""",
    "item_month_panel": DEMAND + " SELECT * FROM item_months",
    "item_supervised": LAGGED + """
SELECT 'training' AS part, month, food_item, quantity_sold, CAST(month(target_month) AS INTEGER) AS month_number,
  CAST(year(target_month) AS INTEGER) AS year, CAST(quarter(target_month) AS INTEGER) AS quarter, lag_1_month,
  lag_3_month, rolling_3_month_mean, target_month, next_month_quantity FROM pairs
UNION ALL
SELECT 'future', month, food_item, quantity_sold, CAST(month(next_month) AS INTEGER), CAST(year(next_month) AS INTEGER),
  CAST(quarter(next_month) AS INTEGER), lag_1_month, lag_3_month, rolling_3_month_mean, NULL, NULL FROM future""",
    "item_forecast_ranking": LAGGED + " SELECT * FROM item_forecast",
    "forecast_enriched": LAGGED + DASHBOARD[len(SQL_PREFIX):] + """
SELECT f.forecast_month, f.rank, f.food_item AS item, f.forecast_quantity AS forecast_units, h.units,
  h.observed_months, h.latest_units,
  coalesce(h.observed_months, 0) || ' observed months; ' || format('{:,}', CAST(coalesce(h.units, 0) AS BIGINT))
    || ' historical units; ' || format('{:,}', CAST(coalesce(h.latest_units, 0) AS BIGINT)) || ' units in '
    || (SELECT MAX(month) FROM item_units) || '.' AS reason
FROM item_forecast f LEFT JOIN item_history h ON f.food_item = h.item WHERE f.rank <= 10""",
    "cancellation_features": BOOKING + " SELECT * FROM bookings",
    "balanced_sample": BOOKING + " SELECT order_id, cancelled, station_code, total_quantity FROM sample",
    "sample_class_counts": BOOKING + " UNION ALL ".join(
        f" SELECT cancelled, COUNT(*) AS rows, '{p}' AS part FROM {t} GROUP BY cancelled"
        for p, t in (("train", "k_train"), ("test", "k_test"), ("sample", "sample"))),
    "rare_level_pool": BOOKING + """,
levels AS (
  SELECT outlet_name, CASE WHEN COUNT(*) >= 20 THEN outlet_name
    ELSE '__infrequent__' END AS outlet_level FROM k_train GROUP BY outlet_name)
SELECT t.order_id, t.outlet_name, l.outlet_level FROM k_test t LEFT JOIN levels l USING (outlet_name)""",
    "impute": FEATURES + """,
mode_name AS (
  SELECT event_name FROM features WHERE event_name IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, event_name LIMIT 1)
SELECT station_code, date, coalesce(event_name, (SELECT event_name FROM mode_name)) AS event_name,
  coalesce(lag_1_demand, (SELECT median(lag_1_demand) FROM features)) AS lag_1_demand,
  coalesce(rolling_7_demand, (SELECT median(rolling_7_demand) FROM features)) AS rolling_7_demand,
  CAST(coalesce(vendor_capacity, (SELECT median(vendor_capacity) FROM features)) AS DOUBLE) AS vendor_capacity
FROM features""",
    "auc_ap": BOOKING + """,
per_score AS (
  SELECT total_quantity * 24 + booking_hour AS score, COUNT(*) FILTER (cancelled) AS pos,
    COUNT(*) FILTER (NOT cancelled) AS neg FROM bookings GROUP BY 1),
placed AS (
  SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM per_score
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT round(SUM(neg * (tp - pos / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 9) AS roc_auc,
  round(SUM(pos * tp / (tp + fp)) / SUM(pos), 9) AS average_precision, CAST(SUM(pos) AS BIGINT) AS positives,
  CAST(SUM(neg) AS BIGINT) AS negatives FROM placed""",
    "station_month_top_items": DASHBOARD + """
SELECT * FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY month, station ORDER BY units DESC, order_lines DESC, item) AS INTEGER)
    AS rank
  FROM (SELECT month, station_name AS station, item_name AS item, SUM(quantity) AS units, COUNT(*) AS order_lines,
          COUNT(DISTINCT outlet_name) AS vendors FROM dash WHERE is_fulfilled GROUP BY 1, 2, 3)) WHERE rank <= 10""",
    "monthly_kpis": DASHBOARD + f"""
SELECT month, COUNT(*) AS order_count, COUNT(*) FILTER (is_cancelled) AS cancellation_count, {money('revenue')} AS revenue,
  coalesce(CAST(SUM(CASE WHEN is_cancelled THEN CAST(revenue AS DECIMAL(18,4)) END) AS DOUBLE), 0) AS revenue_loss,
  COUNT(*) FILTER (is_cancelled) / COUNT(*) AS cancellation_rate FROM dash_orders GROUP BY month""",
    "global_items": DASHBOARD + " SELECT * FROM item_history",
    "state_coverage": DASHBOARD + """,
states AS (
  SELECT 'R' || n_regionkey AS station_code, arg_min(CASE WHEN n_regionkey < 3 THEN n_name ELSE '' END, n_nationkey) AS state
  FROM nation GROUP BY 1)
SELECT COUNT(*) AS lines, CAST(SUM(CASE WHEN coalesce(state, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS mapped,
  AVG(CASE WHEN coalesce(state, '') <> '' THEN 1 ELSE 0 END) AS state_mapping_coverage
FROM dash LEFT JOIN states USING (station_code)""",
    "station_template": DASHBOARD + " SELECT DISTINCT station_code, station_name AS station, '' AS state FROM dash",
    "monthly_best_seller": TOTALS + " SELECT * FROM winners",
    "report_summary": TOTALS + DASHBOARD[len(SQL_PREFIX):] + """
SELECT (SELECT MAX(month) FROM dash WHERE is_fulfilled) AS latest_observed_month,
  (SELECT bool_or(is_cancelled) FROM dash) AS cancellation_model_available,
  (SELECT COUNT(DISTINCT month) FROM totals) AS observed_months,
  (SELECT CAST(SUM(units_sold) AS BIGINT) FROM totals) AS total_delivered_units""",
    "kpi_strip": ROUTES + FEATURES[len(PANEL) + 1 + len(CALENDAR):] + "," + ALERTS + """
SELECT round_even(AVG(abs(order_count - rolling_7_demand)), 2) AS mae,
  round_even(sqrt(AVG((order_count - rolling_7_demand) ** 2)), 2) AS rmse,
  round_even(1 - SUM((order_count - rolling_7_demand) ** 2) / (var_pop(order_count) * COUNT(*)), 4) AS r2,
  (SELECT COUNT(*) FROM complete, cut WHERE date <= cutoff) AS "trainingRows",
  (SELECT COUNT(DISTINCT "stationCode") FROM daily) AS stations, CAST(30 AS BIGINT) AS "forecastDays",
  (SELECT COUNT(*) FROM routes) AS routes, (SELECT COUNT(*) FROM alerts) AS alerts
FROM complete, cut WHERE date > cutoff""",
    "report_stations": OUTLOOK + """
SELECT "stationCode", "stationName", "forecastOrders", format('{:,}', "forecastOrders") AS orders,
  format('INR {:.2f}L', CAST("forecastRevenue" / 100000 AS DOUBLE)) AS revenue, "readinessScore" || '/100' AS readiness,
  "riskLevel" FROM outlook ORDER BY "forecastOrders" DESC, "stationCode" LIMIT 8""",
    "top_stations": PANEL + """
SELECT station_name, CAST(SUM(order_count) AS BIGINT) AS order_count FROM panel GROUP BY 1
ORDER BY order_count DESC, station_name LIMIT 10""",
    "top_routes": DELIVERED + """
SELECT station_code, train_no, train_name, COUNT(*) AS orders FROM d_orders GROUP BY 1, 2, 3
ORDER BY orders DESC, station_code, train_no, train_name LIMIT 15""",
    "route_line": ROUTES + """
SELECT string_agg("trainName" || ' (' || "trainNo" || '): ' || format('{:,}', "forecastOrders") || ' orders', '; '
  ORDER BY "forecastOrders" DESC, "stationCode", "trainNo", "trainName") AS route_line
FROM (SELECT * FROM routes ORDER BY "forecastOrders" DESC, "stationCode", "trainNo", "trainName" LIMIT 3)""",
    "alert_line": HORIZON + "," + ALERTS + """
SELECT string_agg("eventName" || ' on ' || date || ' (' || "daysUntil" || ' days into the model window)', '; '
  ORDER BY date, "eventName") AS alert_line FROM alerts""",
    "monthly_demand_series": PANEL + """
SELECT strftime(date, '%Y-%m') AS month, CAST(SUM(order_count) AS BIGINT) AS order_count FROM panel GROUP BY 1""",
    "station_drilldown": HORIZON + """ SELECT * FROM daily WHERE "stationCode" = 'R1'""",
    "source_lineage": SQL_PREFIX + """
SELECT 'part=' || lower(substr(order_status, 1, 3)) AS part, COUNT(*) AS lines FROM lines GROUP BY 1""",
    "csv_round_trip": SQL_PREFIX + """
SELECT item_name || ' "' || order_status || '",' || chr(10) || 'next line' AS item_name, COUNT(*) AS lines,
  COUNT(*) FILTER (order_status = 'Delivered') AS with_station, SUM(quantity) AS quantity
FROM lines GROUP BY item_name, order_status""",
    "line_profile": SQL_PREFIX + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, COUNT(*) AS rows, COUNT({c}) AS present, COUNT(*) - COUNT({c}) AS missing FROM lines" for c in _PROFILED),
    "order_profile": BOOKING + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, COUNT(*) AS rows, COUNT({c}) AS present, COUNT(*) - COUNT({c}) AS missing FROM bookings" for c in _ORDER_COLUMNS),
    "feature_preview": FEATURES + """
SELECT station_code, date, order_count, segment, lag_1_demand, rolling_7_demand FROM features
ORDER BY station_code, date LIMIT 5""",
    "record_preview": HORIZON + """ SELECT * FROM daily ORDER BY date, "stationCode" LIMIT 5""",
    "month_drilldown": CARDS + """ SELECT * FROM cards WHERE "stationCode" = 'R1'""",
    "published_lookups": OUTLOOK + "," + ALERTS + LAGGED[len(SQL_PREFIX):] + """
SELECT 'summary' AS section, "stationCode" AS key, CAST("forecastOrders" AS DOUBLE) AS value FROM outlook WHERE "stationCode" = 'R1'
UNION ALL SELECT 'alert', CAST(date AS VARCHAR), CAST("forecastOrders" AS DOUBLE) FROM alerts
UNION ALL SELECT 'ranking', food_item, forecast_quantity FROM item_forecast WHERE rank <= 3""",
    "calendar_from_files": "WITH " + CALENDAR + " SELECT * FROM cal",
    "published_run": ROUTES + FEATURES[len(PANEL) + 1 + len(CALENDAR):] + "," + ALERTS + f"""
SELECT '{K.DAILY_MODEL}' AS model, '{K.ROUTE_METHOD.replace("'", "''")}' AS "routeForecastMethod",
  (SELECT MIN(date) FROM daily) AS "forecastStart", (SELECT MAX(date) FROM daily) AS "forecastEnd", 30 AS "forecastDays",
  (SELECT COUNT(DISTINCT "stationCode") FROM daily) AS stations, (SELECT COUNT(*) FROM routes) AS routes,
  (SELECT COUNT(*) FROM alerts) AS alerts, strftime(MIN(date), '%Y-%m-%d') AS "testStart",
  strftime(MAX(date), '%Y-%m-%d') AS "testEnd", COUNT(*) AS "testRows",
  round_even(AVG(abs(order_count - rolling_7_demand)), 2) AS mae,
  round_even(sqrt(AVG((order_count - rolling_7_demand) ** 2)), 2) AS rmse,
  round_even(1 - SUM((order_count - rolling_7_demand) ** 2) / (var_pop(order_count) * COUNT(*)), 4) AS r2,
  (SELECT COUNT(*) FROM complete, cut WHERE date <= cutoff) AS "trainingRows"
FROM complete, cut WHERE date > cutoff""",
    "published_preview": ROUTES + FEATURES[len(PANEL) + 1 + len(CALENDAR):] + "," + ALERTS + """
(SELECT 'evaluation' AS section, strftime(MIN(date), '%Y-%m-%d') AS first, strftime(MAX(date), '%Y-%m-%d') AS second,
  COUNT(*) AS value FROM complete, cut WHERE date > cutoff)
UNION ALL (SELECT 'metadata', MIN(date), MAX(date), 30 FROM daily)
UNION ALL (SELECT 'alert', date, "eventName", "forecastOrders" FROM alerts ORDER BY date LIMIT 5)""",
    "dashboard_metadata": f"""
SELECT 'Boosted-tree demand trend prototype' AS model,
  (SELECT MIN(forecast_month) FROM ({LAGGED} SELECT * FROM item_forecast)) AS forecast_month,
  s.latest_observed_month, '{K.QUALITY_NOTE}' AS data_quality_note, s.cancellation_model_available,
  '{K.CANCELLED_NOTE}' AS cancellation_note, c.state_mapping_coverage, '{K.STATE_NOTE}' AS state_mapping_note,
  (SELECT COUNT(DISTINCT month) FROM ({DASHBOARD} SELECT month FROM dash_orders)) AS months,
  (SELECT COUNT(*) FROM (@station_month_top_items)) AS rankings,
  (SELECT COUNT(*) FROM (@forecast_enriched)) AS "forecastItems", 'trained' AS cancellation_status
FROM (@report_summary) s, (@state_coverage) c""",
    "landed_lines": SQL_PREFIX + """
SELECT order_status, COUNT(*) AS lines,
  SUM(quantity) + CASE order_status WHEN 'Delivered' THEN COUNT(*) ELSE 0 END AS quantity FROM lines GROUP BY 1""",
    "saved_model": FEATURES + """
SELECT COUNT(*) FILTER (date > cutoff) AS rows, COUNT(*) FILTER (date > cutoff) AS same FROM complete, cut""",
    "daily_model_evaluation": FEATURES + """
SELECT COUNT(*) FILTER (date > cutoff) AS test_rows, COUNT(*) FILTER (date <= cutoff) AS training_rows, TRUE AS sound
FROM complete, cut""",
    "recursive_forecast_boosted": HORIZON + """
SELECT "stationCode", COUNT(*) AS days, MIN(date) AS first_day, MAX(date) AS last_day,
  COUNT("eventName") AS event_days, TRUE AS not_negative FROM daily GROUP BY 1""",
    "monthly_station_forecast_boosted": CARDS + """
SELECT "stationCode", month, "referenceOrders", "historicalYears", "averageCancellationRate", "confidenceScore",
  TRUE AS not_negative FROM cards""",
    "item_forecast_boosted": LAGGED + """
SELECT forecast_month, COUNT(*) AS rows, COUNT(DISTINCT food_item) AS items, MIN(rank) AS first_rank,
  MAX(rank) AS last_rank, TRUE AS not_negative FROM item_forecast GROUP BY forecast_month""",
    "cancellation_model": BOOKING + """
SELECT (SELECT strftime(m, '%Y-%m') FROM last_month) AS test_month,
  (SELECT CASE WHEN SUM(n) > 300000 THEN COUNT(*) * least(150000, MIN(n)) ELSE SUM(n) END
   FROM (SELECT COUNT(*) AS n FROM k_train GROUP BY cancelled)) AS training_orders,
  COUNT(*) AS test_orders, COUNT(*) FILTER (cancelled) / COUNT(*) AS test_cancellation_rate, TRUE AS sound
FROM k_test""",
    "feature_importance": """
SELECT CAST(15 AS BIGINT) AS features, CAST(15 AS BIGINT) AS known, 1.0::DOUBLE AS total, TRUE AS not_negative""",
    "published_best_sellers": TOTALS + " SELECT * FROM winners",
}

# The record of a run is stated by the results it is made of.
for _name in ("station_month_top_items", "forecast_enriched", "report_summary", "state_coverage"):
    ORACLES["dashboard_metadata"] = ORACLES["dashboard_metadata"].replace(f"@{_name}", ORACLES[_name])
