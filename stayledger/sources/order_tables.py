"""Booking-shaped rows derived from order tables: one line item is one booking (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.numbering import with_sequence
from ..session import shuffle_width
from .booking_schema import RAW_COLUMNS, typed

# Order that defines the booking number, and the rest of the line item as tie-break.
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
]
LINE_OTHER = ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _case(condition: str, yes: str, no: str) -> str:
    return f"CASE WHEN {condition} THEN {yes} ELSE {no} END"


# Expression per raw column, in terms of the joined tables.
EXPRESSIONS = {
    "hotel": _case("l_linestatus = 'F'", "'City Hotel'", "'Resort Hotel'"),
    "is_canceled": _case("l_returnflag = 'R'", "1", "0"),
    "lead_time": "abs(datediff(l_shipdate, o_orderdate)) % 450",
    "arrival_date_year": "year(l_shipdate)",
    "arrival_date_month": "date_format(l_shipdate, 'MMMM')",
    "arrival_date_week_number": "weekofyear(l_shipdate)",
    "arrival_date_day_of_month": "day(l_shipdate)",
    "stays_in_weekend_nights": "l_linenumber % 3",
    "stays_in_week_nights": "CAST(l_quantity AS INT) % 6",
    "adults": "1 + l_partkey % 4",
    "children": _case("l_partkey % 97 = 0", "NULL", "CAST(l_suppkey % 3 AS DOUBLE)"),
    "babies": "CASE WHEN l_partkey % 100 = 0 THEN l_orderkey % 997 WHEN l_partkey % 100 = 1 THEN l_orderkey % 7 ELSE 0 END",
    "meal": "p_type",
    "country": _case("o_custkey % 200 = 0", "NULL", "n_name"),
    "market_segment": "c_mktsegment",
    "distribution_channel": "o_orderpriority",
    "is_repeated_guest": _case("o_custkey % 25 = 3 AND l_partkey % 20 = 1", "1", "0"),
    "previous_cancellations": _case("l_partkey % 11 = 0", "l_linenumber % 4", "0"),
    "previous_bookings_not_canceled": _case("o_custkey % 25 = 3", "l_linenumber", "0"),
    "reserved_room_type": "chr(CAST(65 + p_size % 8 AS INT))",
    "assigned_room_type": "chr(CAST(65 + (p_size + CASE WHEN l_suppkey % 8 = 0 THEN 1 ELSE 0 END) % 8 AS INT))",
    "booking_changes": _case("l_orderkey % 5 = 0", "l_linenumber % 3", "0"),
    "deposit_type": "CASE o_orderstatus WHEN 'F' THEN 'No Deposit' WHEN 'O' THEN 'Non Refund' ELSE 'Refundable' END",
    "agent": _case("l_suppkey % 7 = 0", "NULL", "l_suppkey"),
    "company": _case("l_partkey % 16 = 0", "l_partkey % 40", "NULL"),
    "days_in_waiting_list": _case("l_partkey % 30 = 0", "l_suppkey % 90", "0"),
    "customer_type": "r_name",
    "adr": "floor(l_extendedprice / l_quantity * 10) / 100",
    "required_car_parking_spaces": _case("l_discount = 0", "1", "0"),
    "total_of_special_requests": "CAST(round(l_tax * 100) AS INT) % 6",
    "reservation_status": "CASE WHEN l_returnflag = 'R' THEN 'Canceled' WHEN l_suppkey % 50 = 0 THEN 'No-Show' ELSE 'Check-Out' END",
    "reservation_status_date": "CAST(o_orderdate AS DATE)",
}


def _guests(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's segment, nation and region, joined before the much larger line items."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    places = (
        table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
        .join(table(spark, folder, "region").select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    customers = (
        table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_name", "r_name")
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def bookings_from_orders(spark: SparkSession, folder: str, sequence: str | None = None) -> DataFrame:
    """The 32 raw booking columns. With ``sequence``, also the position of each row in line-item order.

    The position is taken on the line items alone, before the joins, so the range partitioning samples a plain
    scan and not a join. Only what the expressions need is read from each table. The joins are ordinary equi-joins:
    Catalyst broadcasts a side by its file size, otherwise adaptive execution splits skewed keys.
    """
    lines = table(spark, folder, "lineitem").select(*LINE_ORDER, *LINE_OTHER)
    if sequence:
        lines = with_sequence(lines, LINE_ORDER + LINE_OTHER, sequence, shuffle_width(lines))
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    joined = lines.join(_guests(spark, folder), F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    columns = [F.expr(EXPRESSIONS[name]).cast(typed(name)).alias(name) for name in RAW_COLUMNS]
    if sequence:
        columns.append(F.col(sequence))
    return joined.select(columns)
