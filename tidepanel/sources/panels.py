"""Daily price panels derived from transaction tables, one row a (date, commodity)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The transaction tables as they are written (fixed values). A declared schema spares a job that reads footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _panel(rows: DataFrame, key, date, price) -> DataFrame:
    """The highest price of each key and day; the maximum is summed up before the shuffle."""
    return rows.groupBy(F.to_date(date).alias("date"), key.alias("commodity")).agg(F.max(price).alias("price_idr")).where("commodity is not null and date is not null")


def panel_of_orders(orders: DataFrame) -> DataFrame:
    return _panel(orders, F.col("o_orderpriority"), "o_orderdate", "o_totalprice")


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_of_orders(table(spark, sf_dir, "orders"))


def lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(table(spark, sf_dir, "lineitem"), F.col("l_suppkey").cast("string"), "l_shipdate", "l_extendedprice")


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(table(spark, sf_dir, "events"), F.col("event_type"), "ts", "value")


def with_gaps(panel: DataFrame) -> DataFrame:
    """The panel with missing prices on days of the month that 17 divides, to exercise nulls."""
    return panel.withColumn("price_idr", F.when(F.dayofmonth("date") % 17 != 0, F.col("price_idr")))
