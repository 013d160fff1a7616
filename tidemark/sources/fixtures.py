"""How the driver's TPC-H-like tables stand in for the pipeline's inputs.

* transaction  = orders JOIN customer JOIN nation
  (invoiceid=o_orderkey, customerid=o_custkey, price=o_totalprice,
  orderdate=epoch seconds of o_orderdate, state=n_name, category=o_orderpriority,
  with NULL and lower-case states (``fact_state``), which no dimension row matches;
  shippingtype=o_orderstatus, referral=c_mktsegment, itemid=n_regionkey, quantity=c_nationkey)
* county rows  = all customers, per nation
* merge source with repeated keys = lineitem (l_orderkey)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import timestamp_to_epoch
from tidemark.schemas import LANDING_SCHEMA

LOWER_CASE_NATION = 20  # states of nations from this key on are written in lower case on the fact side
# County measure columns (odd names on purpose: dots, spaces, hyphens).
COUNTY_CUSTOMERS = "Population.Customers"
COUNTY_BALANCE = "Sales.Account Balance Cents"
COUNTY_MEAN_BALANCE = "Income.Mean Account-Balance Cents"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_state() -> Column:
    """State of an order: NULL while it is pending, else the nation's name, for some in lower case."""
    name = F.when(F.col("n_nationkey") >= LOWER_CASE_NATION, F.lower("n_name")).otherwise(F.col("n_name"))
    return F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(name)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing-shaped rows (LANDING_SCHEMA), one per order."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # Base-table joins: the planner's file-size statistics pick broadcast (nation) or
    # sort-merge (orders x customer at scale); no extra sizing job is needed for raw scans.
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey)
    ocn = oc.join(nation, oc.c_nationkey == nation.n_nationkey)
    out = ocn.select(
        F.col("o_orderkey").alias("invoiceid"),
        F.col("n_regionkey").cast("long").alias("itemid"),
        F.col("o_custkey").alias("customerid"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("price"),
        F.col("c_nationkey").cast("int").alias("quantity"),
        timestamp_to_epoch("o_orderdate").alias("orderdate"),
        fact_state().alias("state"),
        F.col("o_orderstatus").alias("shippingtype"),
        F.col("c_mktsegment").alias("referral"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in LANDING_SCHEMA.fields])


def county_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: ``State`` plus integer measures."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    j = customer.join(nation.select("n_nationkey", "n_name"), customer.c_nationkey == nation.n_nationkey)
    return j.select(
        F.col("n_name").alias("State"),
        F.lit(1).cast("int").alias(COUNTY_CUSTOMERS),
        cents.alias(COUNTY_BALANCE),
        cents.alias(COUNTY_MEAN_BALANCE),
        F.col("c_mktsegment").alias("segment"),  # not integral: ignored by the roll-up
    )
