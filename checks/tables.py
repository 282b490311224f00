"""Order lines, calendar and station dimension derived from the given tables.

Every line, order and event of the tables takes part.  `SQL_PREFIX` states the same mapping for the
SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns each job reads; joins whose columns are not asked for are left out.
DELIVERED = ("order_id", "order_status", "delivery_date", "station_code", "station_name",
             "outlet_name", "train_no", "train_name", "amount_payable", "gross_item_amount")
BOOKED = ("order_id", "order_status", "booking_date", "quantity", "amount_payable", "gross_item_amount")
STATIONS = ("station_code", "station_name")
REPORT = ("order_id", "order_status", "created_at", "item_name", "outlet_name", "station_name", "quantity")
BOOKING = ("order_id", "order_status", "booking_date", "eta", "station_code", "outlet_name", "food_type",
           "payment_type", "is_veg", "item_name", "quantity", "selling_price", "discount")
DEMAND = ("order_id", "order_status", "created_at", "item_name", "quantity", "discount", "station_name",
          "railway_zone", "outlet_name", "food_type", "is_veg")

# Stated, so that no job has to read a footer for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double",
}

_STATION = {"station_code", "station_name", "railway_zone"}
_PART = {"item_name", "food_type", "is_veg"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def order_lines(
    spark: SparkSession, folder: str, columns: tuple[str, ...], unread: tuple[str, ...] = (), by_order: bool = True,
) -> DataFrame:
    """The tables as typed order lines with the asked columns and `line_order`.

    Columns of `unread` are named but empty: their tables are not joined.

    Lines and orders meet last and on the key the jobs group by, so the grouping after a shuffled
    join finds the rows in place. Not so without `by_order`, for jobs that group by other columns: they meet first, so
    that lines of orders that a job leaves out, and names, are not shuffled with them.
    """
    wanted = set(columns)
    key = F.col("o_orderkey")
    hours = F.make_dt_interval(hours=(key % 24).cast("int"))
    booked = F.col("o_orderdate") + hours
    orders = table(spark, folder, "orders").select(
        key.alias("order_id"), "o_custkey",
        F.when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "P", "Partially Delivered")
        .otherwise("Cancelled by customer").alias("order_status"),
        booked.alias("booking_date"), booked.alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(key % 3).cast("int"))).alias("delivery_date"),
        (booked + F.make_dt_interval(hours=(2 + key % 48).cast("int"))).alias("eta"),
        F.concat(F.lit("T"), F.col("o_custkey") % 12).alias("train_no"),
        F.concat(F.lit("Route "), F.col("o_custkey") % 12).alias("train_name"),
        F.col("o_orderpriority").alias("payment_type"),
        F.when(key % 10 != 0, F.col("o_totalprice")).alias("amount_payable"),
    )
    if wanted & _STATION:
        customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        nations = table(spark, folder, "nation").join(
            table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.concat(F.lit("R"), "r_regionkey").alias("station_code"),
            F.col("r_name").alias("station_name"), F.col("n_name").alias("railway_zone"))
        customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, folder, "lineitem")
    met = F.col("l_orderkey") == F.col("order_id")
    if not by_order:
        lines = lines.join(orders, met)
    if wanted & _PART:
        parts = table(spark, folder, "part").select(
            "p_partkey", F.col("p_name").alias("item_name"), F.col("p_type").alias("food_type"),
            (F.col("p_size") % 2 == 0).alias("is_veg"))
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    if "outlet_name" in wanted:
        suppliers = table(spark, folder, "supplier").select(
            "s_suppkey",
            F.when(F.col("s_suppkey") % 50 == 0, "  ").otherwise(F.col("s_name")).alias("outlet_name"))
        lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    # A line's numbers are shuffled once each; what repeats them is built behind the joins.
    if by_order:
        lines = lines.join(orders, met)
    lines = lines.withColumns({
        "quantity": F.col("l_quantity"), "discount": F.col("l_discount"),
        "selling_price": F.col("l_extendedprice"), "gross_item_amount": F.col("l_extendedprice"),
        "line_order": F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"),
    })
    absent = F.lit(None).cast("string")
    return lines.select(
        *[F.col(c) if c in wanted else absent.alias(c) for c in columns + unread], "line_order")


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as the text cells of an export, with blanks, padding, bad numbers and bad dates."""
    columns = ("order_id", "order_status", "booking_date", "delivery_date", "station_code", "station_name",
               "outlet_name", "train_no", "train_name", "item_name", "quantity", "amount_payable",
               "gross_item_amount")
    lines = order_lines(spark, folder, columns)
    number = F.col("line_order.l_linenumber")
    iso = F.date_format("delivery_date", "yyyy-MM-dd HH:mm:ss")
    slashed = F.date_format("delivery_date", "M/d/yyyy H:mm")
    return lines.select(
        "order_id", "order_status",
        F.date_format("booking_date", "yyyy-MM-dd HH:mm:ss").alias("booking_date"),
        F.when(number == 7, "not a date").when(number == 6, slashed).otherwise(iso).alias("delivery_date"),
        F.concat(F.lit("\t"), "station_code", F.lit(" ")).alias("station_code"),
        F.when(number != 5, F.col("station_name")).alias("station_name"),
        "outlet_name", "train_no", "train_name", "item_name",
        F.when(number == 4, "abc").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("amount_payable").cast("string").alias("amount_payable"),
        F.when(number == 3, "NaN").otherwise(F.col("gross_item_amount").cast("string")).alias("gross_item_amount"),
        "line_order",
    )


def calendar_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One calendar row per event: the hours of the event table are every fourth day from 1995 on."""
    event = table(spark, folder, "events")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    hour = F.floor(F.timestamp_diff("SECOND", start, F.col("ts")) / 3600).cast("int")
    day = F.date_add(F.lit("1995-01-01").cast("date"), hour * 4)
    kind = F.col("event_type")
    return event.select(
        F.when((kind == "error") & (F.col("value") < 2), "not a date")
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("date"),
        F.when(kind != "error", F.concat(F.initcap(kind), F.lit(" day"))).alias("event_name"),
        F.when(kind != "view", F.when(hour % 2 == 0, "Fair").otherwise("Festival")).alias("event_type"),
        F.when(hour % 3 == 0, "2").when(hour % 3 == 1, "bad").otherwise("0").alias("festival_flag"),
        F.when(hour % 5 == 0, "1").otherwise("-1").alias("holiday_flag"),
        F.when(hour % 7 == 0, "1").alias("local_event_flag"),
        F.col("event_id").alias("row_order"),
    )


def state_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Station dimension from the nations: codes repeat, some states are blank."""
    return table(spark, folder, "nation").select(
        F.concat(F.lit("R"), "n_regionkey").alias("station_code"), F.col("n_name").alias("station"),
        F.when(F.col("n_regionkey") < 3, F.col("n_name")).otherwise("").alias("state"),
        "n_nationkey")


SQL_PREFIX = """
WITH lines AS (
  SELECT o_orderkey AS order_id,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Partially Delivered'
      ELSE 'Cancelled by customer' END AS order_status,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS booking_date,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created_at,
    o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS delivery_date,
    o_orderdate + to_hours(CAST(o_orderkey % 24 + 2 + o_orderkey % 48 AS INTEGER)) AS eta,
    'R' || r_regionkey AS station_code, r_name AS station_name, n_name AS railway_zone,
    CASE WHEN s_suppkey % 50 = 0 THEN '  ' ELSE s_name END AS outlet_name,
    'T' || (o_custkey % 12) AS train_no, 'Route ' || (o_custkey % 12) AS train_name,
    p_name AS item_name, p_type AS food_type, p_size % 2 = 0 AS is_veg,
    o_orderpriority AS payment_type,
    l_quantity AS quantity, l_discount AS discount, l_extendedprice AS selling_price,
    l_extendedprice AS gross_item_amount,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS amount_payable,
    l_linenumber,
    ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
      l_quantity, l_discount) AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)"""
