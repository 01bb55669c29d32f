"""Adapters from the shared test tables to the warehouse's staging sources.

The original staging files are not available, so the five staging inputs are
derived from the TPC-H-like test tables with the same column shapes:

* payment  <- orders (one payment per order)
* billing  <- lineitem joined to orders (one bill per line)
* issue    <- orders (one issue per order)
* traffic  <- lineitem joined to orders (one traffic record per line)
* mdm user <- customer joined to nation and region, all of them

Orders of low priority in status P belong to guests: their user id is the
customer's, negated, which master data do not know.  This exercises the NULL
dimension members of the marts.

Everything stays lazy; Spark reads only the columns each adapter uses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import ts_to_epoch_ms

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@dataclass(frozen=True)
class Staging:
    payment: DataFrame
    billing: DataFrame
    issue: DataFrame
    traffic: DataFrame
    mdm_user: DataFrame

    def source(self, name: str) -> DataFrame:
        return getattr(self, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _amount_text(col: str):
    return F.col(col).cast("decimal(10,2)").cast("string")


def _user(kind: str) -> Column:
    """The user of an order, a guest's id being the customer's negated."""
    guest = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return F.when(guest, -F.col("o_custkey")).otherwise(F.col("o_custkey")).cast(kind).alias("user_id")


def stg_payment(orders: DataFrame) -> DataFrame:
    ck = F.col("o_custkey")
    return orders.select(
        _user("int"),
        F.col("o_orderpriority").alias("pay_doc_type"),
        F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("N/A-"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("pay_doc_num"),
        F.concat(F.lit("FL-"), ck.cast("string")).alias("account"),
        F.concat(F.lit("+7"), F.lpad((ck * 7 + F.year("o_orderdate") % 2).cast("string"), 10, "0"))
        .alias("phone"),
        F.date_format("o_orderdate", "yyyy-MM").alias("billing_period"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pay_date"),
        _amount_text("o_totalprice").alias("pay_sum"),
    )


def _lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # a hash table of each task's orders: the lines, four times as many, are not sorted
    return lineitem.join(orders.select("o_orderkey", _user("int")).hint("shuffle_hash"),
                         lineitem.l_orderkey == orders.o_orderkey, "inner")


def stg_billing(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return _lines(lineitem, orders).select(
        "user_id",
        F.date_format("l_shipdate", "yyyy-MM").alias("billing_period"),
        F.col("l_returnflag").alias("service"),
        F.col("l_linestatus").alias("tariff"),
        _amount_text("l_extendedprice").alias("billing_sum"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"),
    )


def stg_issue(orders: DataFrame) -> DataFrame:
    ok = F.col("o_orderkey")
    return orders.select(
        _user("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.date_format(F.timestamp_add("DAY", (ok % 10).cast("int"), F.col("o_orderdate")),
                      "yyyy-MM-dd HH:mm:ss").alias("end_time"),
        F.col("o_orderstatus").alias("title"),
        F.concat(F.lit("order "), ok.cast("string")).alias("description"),
        F.when(ok % 3 == 0, "A").when(ok % 3 == 1, "N").otherwise("R").alias("service"),
    )


def stg_traffic(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    device_no = (F.col("l_suppkey") % 9 + 1).cast("string")
    return _lines(lineitem, orders).select(
        "user_id",
        (ts_to_epoch_ms("l_shipdate") + F.col("l_partkey") * 1000 + F.col("l_linenumber"))
        .alias("traffic_ms"),
        F.concat(F.lit("d00"), device_no).alias("device_id"),
        F.concat(F.lit("10.0."), device_no, F.lit("."), (F.col("l_orderkey") % 5).cast("string"))
        .alias("device_ip_addr"),
        F.floor(F.col("l_quantity") * 1000).cast("int").alias("bytes_sent"),
        F.floor("l_extendedprice").cast("int").alias("bytes_received"),
    )


def mdm_user(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    return (customer.join(geo, customer.c_nationkey == geo.n_nationkey)
            .select(
                F.col("c_custkey").cast("int").alias("user_id"),
                F.col("c_mktsegment").alias("legal_type"),
                F.col("r_name").alias("district"),
                F.when(F.col("c_nationkey") % 2 == 0, "prepaid").otherwise("postpaid").alias("billing_mode"),
                (F.col("c_acctbal") > 5000).alias("is_vip"),
                F.make_date((F.col("c_custkey") % 7 + 1995).cast("int"), F.lit(1), F.lit(1))
                .alias("registered_at"),
            ))


def mdm_snapshots(mdm: DataFrame, years) -> DataFrame:
    """Master data as each run of ``years`` (an array column) finds it: from 1999 on, users whose id is
    a multiple of 50 are on the other billing mode."""
    other = F.when(F.col("billing_mode") == "prepaid", "postpaid").otherwise("prepaid")
    return mdm.withColumn("_year", F.explode(years)).withColumn("billing_mode", F.when(
        (F.col("user_id") % 50 == 0) & (F.col("_year") >= 1999), other).otherwise(F.col("billing_mode")))


def staging_from_testdata(spark: SparkSession, sf_dir: str) -> Staging:
    t = {name: read_table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer",
                                                          "nation", "region")}
    return Staging(
        payment=stg_payment(t["orders"]),
        billing=stg_billing(t["lineitem"], t["orders"]),
        issue=stg_issue(t["orders"]),
        traffic=stg_traffic(t["lineitem"], t["orders"]),
        mdm_user=mdm_user(t["customer"], t["nation"], t["region"]),
    )
