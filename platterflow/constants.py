"""Statuses, fallbacks, thresholds, feature lists, formats and texts.

Everything here has to equal the published behaviour for the results to be right, so it is kept in
one place and stated plainly.
"""

# --- fixed values: order states -------------------------------------------------------------
FULFILLED_STATUSES = ("Delivered", "Partially Delivered")
CANCELLED_PATTERN = "%cancel%"

# --- fixed values: text that stands for a missing cell in an export --------------------------
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: characters stripped from both ends of a text cell -------------------------
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: text put in place of a missing or blank cell ------------------------------
FALLBACK_TEXT = {
    "station_code": "UNKNOWN",
    "station_name": "Unknown station",
    "outlet_name": "Unknown outlet",
    "train_no": "Unknown",
    "train_name": "Unknown route",
    "item_name": "Unknown item",
    "order_status": "Unknown",
}
DASHBOARD_STATION_CODE_FALLBACK = "Unknown"
CALENDAR_DEFAULTS = {"event_name": "Known calendar event", "event_type": "Holiday"}
CALENDAR_FLAGS = ("festival_flag", "holiday_flag", "local_event_flag")
CALENDAR_COLUMNS = ("date", "event_name", "event_type") + CALENDAR_FLAGS

# --- fixed values: date formats tried after the ISO forms, month first ------------------------
# Each format goes with the shape of the cells it can read, '-' and '.' read as '/'.
DATE_FORMATS = (
    (r"^(0?[1-9]|1[0-2])/\d{1,2}/\d{4}( \d{1,2}:\d{2}(:\d{2}(/\d{3})?)?)?$", "M/d/yyyy[ H:mm[:ss[/SSS]]]"),
    (r"^(0?[1-9]|1[0-2])/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})? [AP]M$", "M/d/yyyy h:mm[:ss] a"),
    (r"^(1[3-9]|2\d|3[01])/\d{1,2}/\d{4}( \d{1,2}:\d{2}(:\d{2}(/\d{3})?)?)?$", "d/M/yyyy[ H:mm[:ss[/SSS]]]"),
    (r"^\d{4}/\d{1,2}/\d{1,2}( \d{1,2}:\d{2}(:\d{2}(/\d{3})?)?)?$", "yyyy/M/d[ H:mm[:ss[/SSS]]]"),
    (r"^\d{1,2}/[A-Za-z]{3}/\d{4}( \d{1,2}:\d{2}(:\d{2})?)?$", "d/MMM/yyyy[ H:mm[:ss]]"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}( \d{1,2}:\d{2}(:\d{2})?)?$", "d MMM yyyy[ H:mm[:ss]]"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}( \d{1,2}:\d{2}(:\d{2})?)?$", "MMM d, yyyy[ H:mm[:ss]]"),
)

# --- fixed values: daily station forecast ----------------------------------------------------
HORIZON_DAYS = 30
HOLDOUT_DAYS = 30
MIN_DAILY_TRAINING_ROWS = 100
HISTORY_LENGTH = 7
ROLLING_DAYS = 7
ROLLING_MIN_VALUES = 2
BASELINE_ROWS = 28
CAPACITY_BUFFER = 1.10
ROUTE_WINDOW_DAYS = 90
ROUTE_MIN_ORDERS = 2
ROUTES_PER_STATION = 5
RISK_BANDS = ((0.30, "Critical"), (0.18, "High"), (0.06, "Medium"))
LOWEST_RISK = "Normal"
READINESS_FLOOR = 20
READINESS_SLOPE = 200
CALM_ACTION = "Maintain normal operations and monitor live demand."
BUSY_ACTION = "Add %d vendor(s), stage inventory and review the next peak window."
DAILY_CATEGORIES = ("station_code",)
DAILY_NUMBERS = (
    "month", "day_of_week", "is_weekend", "festival_flag", "holiday_flag", "local_event_flag",
    "lag_1_demand", "rolling_7_demand", "vendor_capacity",
)

# --- fixed values: monthly station forecast --------------------------------------------------
FORECAST_YEAR = 2026
FORECAST_MONTHS = (8, 9, 10, 11, 12)
TREND_YEARS = 4
SEASONAL_ROWS = 3
SEASONAL_WEIGHT = 0.70
MODEL_WEIGHT = 0.30
CONFIDENCE_BASE, CONFIDENCE_PER_YEAR, CONFIDENCE_PER_VOLATILITY = 56, 13, 12
CONFIDENCE_LOW, CONFIDENCE_HIGH = 55, 94
ITEMS_PER_LIST = 10
MONTHLY_CATEGORIES = ("stationCode",)
MONTHLY_NUMBERS = ("monthNumber", "yearIndex")

# --- fixed values: item forecast -------------------------------------------------------------
ITEM_REQUIRED = ("date", "food_item", "quantity_sold")
EXPORT_REQUIRED = ("created_at", "item_name", "quantity")
EXPORT_RENAMES = {
    "created_at": "date", "item_name": "food_item", "quantity": "quantity_sold",
    "station_name": "city", "railway_zone": "region",
}
ITEM_OPTIONAL_CATEGORIES = ("city", "region", "festival", "weather", "local_event")
ITEM_OPTIONAL_NUMBERS = ("public_holiday", "promotion_active", "vendor_availability")
ITEM_EXTRA_LAST = ("food_type", "is_veg")
ITEM_COVERAGE = ("city_coverage", "region_coverage")
ITEM_NUMBERS = (
    "month_number", "year", "quarter", "lag_1_month", "lag_3_month", "rolling_3_month_mean",
)
MIN_ITEM_MONTHS = 8
MIN_ITEM_VALIDATION_ROWS = 4
ENRICHED_ITEMS = 10

# --- fixed values: cancellation model --------------------------------------------------------
MAX_TRAINING_ORDERS = 300_000
CANCELLATION_CATEGORIES = ("station_code", "outlet_name", "food_type", "payment_type", "is_veg")
CANCELLATION_NUMBERS = (
    "booking_month", "booking_day_of_week", "booking_hour", "is_weekend", "eta_hour",
    "eta_lead_hours", "item_count", "total_quantity", "total_selling_price", "total_discount",
)
TOP_FACTORS = 8

# --- fixed values: boosting parameters and rare-level thresholds, per model ------------------
DAILY_TREES = dict(trees=250, depth=6, step=0.04, rows=0.85, columns=0.85, min_rows=4)
MONTHLY_TREES = dict(trees=180, depth=4, step=0.05, rows=0.85, columns=0.9, min_rows=1)
ITEM_TREES = dict(trees=350, depth=4, step=0.04, rows=0.85, columns=0.85, min_rows=1)
CANCELLATION_TREES = dict(trees=240, depth=5, step=0.06, rows=0.8, columns=0.8, min_rows=8)
SEED = 42
DAILY_MIN_FREQUENCY = 3
MONTHLY_MIN_FREQUENCY = 2
ITEM_MIN_FREQUENCY = 1
CANCELLATION_MIN_FREQUENCY = 20
INFREQUENT = "__infrequent__"

# --- fixed values: reports -------------------------------------------------------------------
REPORT_STATIONS = 8
REPORT_ROUTES = 3
EXPLORE_STATIONS = 10
PREVIEW_ROWS = 5
EXPLORE_ROUTES = 15
NO_ROUTES = "No qualifying route history."
NO_ALERTS = "No known event in the current model window."

# --- fixed values: published texts -----------------------------------------------------------
DAILY_MODEL = "Boosted-tree daily station-demand forecast"
ROUTE_METHOD = "Station demand forecast allocated using each station's trailing 90-day train-route order share."
RISK_NOTE = ("Risk uses information available at booking time only; use it to prioritise review, "
             "not automatically reject orders.")
QUALITY_NOTE = ("Only selected production months were supplied. Forecast confidence is directional, "
                "not production-grade.")
CANCELLED_NOTE = ("Cancelled orders are available. A cancellation-risk model can now be trained using booking time, "
                  "ETA lead time, station, vendor, item, price, and discount.")
NOT_CANCELLED_NOTE = ("No cancelled orders were found in the supplied data, so cancellation-risk training "
                      "is unavailable.")
STATE_NOTE = "State holidays count for a station once its row of the station map names a state."
DRIVERS = (
    " years of same-month station history",
    ("%d reference volume: ", " orders"),
    ("Historical cancellation rate: ", "%"),
    "Station code, month and historical demand are used in the boosted-tree trend estimate",
    "Weekly forecast is allocated from the selected monthly prediction using the station's historical "
    "same-month weekly demand share",
)
