"""The test tables as model tables.

The test data has no signup, delivery or discount table. The stand-ins below exercise the
semantics and carry no business meaning:

* order status: F is Delivered, O is Refunded, P is Cancelled
* signup date: the customer's first order of any status
* delivery delay: the largest line quantity of the order
* discount: the order has a line with a discount of at least 0.09
* restaurant: the supplier, on the order line

Ids keep their stored type (bigint); the operators accept any orderable id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions import calendar

DISCOUNT_THRESHOLD = 0.09


@dataclass(frozen=True)
class BoundTables:
    """Lazy model tables over one folder of the test data; each property is a new plan."""

    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            (F.col("o_orderkey") % 24).cast("smallint").alias("order_hour"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("net_order_value"),
            F.col("o_orderpriority").alias("payment_method"),
            # null-safe and nested, so that a filter on one status folds to a comparison that
            # the Parquet scan takes
            F.when(F.col("o_orderstatus").eqNullSafe("F"), "Delivered")
            .otherwise(F.when(F.col("o_orderstatus").eqNullSafe("O"), "Refunded").otherwise("Cancelled"))
            .alias("order_status"),
        )

    @property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_suppkey").alias("restaurant_id"),
            F.col("l_returnflag").alias("item_category"),
            F.col("l_quantity").cast("smallint").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("item_price"),
        )

    @property
    def restaurants(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        return (
            self.raw("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("restaurant_id"),
                "city",
                F.when(F.col("s_acctbal") < 2500, "Budget")
                .when(F.col("s_acctbal") < 7500, "Mid")
                .otherwise("Premium")
                .alias("price_band"),
            )
        )

    def _by_order(self, **measures: Column) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(*[measure.alias(name) for name, measure in measures.items()])
        )

    @property
    def delivery_events(self) -> DataFrame:
        """One event per order that has a line."""
        return self._by_order(
            delivery_delay_min=F.max("l_quantity").cast("decimal(6,1)"),
            promised_delivery_min=(F.lit(25) + F.max("l_linenumber")).cast("smallint"),
        ).withColumn("delivery_event_id", F.col("order_id"))

    @property
    def discounts(self) -> DataFrame:
        return (
            self._by_order(top_discount=F.max("l_discount"))
            .filter(F.col("top_discount") >= DISCOUNT_THRESHOLD)
            .select(
                F.col("order_id").alias("discount_id"),
                "order_id",
                (F.round(F.col("top_discount") * 1000) / 10).cast("decimal(5,1)").alias("discount_pct"),
            )
        )

    @property
    def facts(self) -> DataFrame:
        """Order facts in one pass over the lines.

        Equal to :func:`patronage.operators.facts.order_facts` on the three tables above,
        which would read the lines twice here because both stand-ins come from them.
        """
        lines = self._by_order(
            delivery_delay_min=F.max("l_quantity").cast("decimal(6,1)"),
            is_discounted=F.max("l_discount") >= DISCOUNT_THRESHOLD,
        )
        return self.orders.join(lines, "order_id", "left").withColumn(
            "is_discounted", F.coalesce("is_discounted", F.lit(False))
        )

    @property
    def customers(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        signup = self.orders.groupBy("customer_id").agg(F.min("order_date").alias("signup_date"))
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                "city",
                F.col("c_mktsegment").alias("acquisition_channel"),
            )
            .join(signup, "customer_id", "left")
            .withColumn("cohort_month", calendar.month_key(F.col("signup_date")))
        )

    @property
    def customer_dimension(self) -> DataFrame:
        """Customers without the signup stand-in, for analyses that do not use the cohort."""
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("city"))
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                "city",
                F.col("c_mktsegment").alias("acquisition_channel"),
            )
        )
