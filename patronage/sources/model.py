"""The six model tables as one object, with the order facts derived from them."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from patronage.operators.facts import order_facts
from patronage.sources import files


@dataclass(frozen=True)
class ModelTables:
    spark: SparkSession
    customers: DataFrame
    restaurants: DataFrame
    orders: DataFrame
    order_items: DataFrame
    delivery_events: DataFrame
    discounts: DataFrame
    written_facts: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, folder: str, source: str = "parquet") -> "ModelTables":
        reader = {"csv": files.read_model_csv, "parquet": files.read_model_parquet}[source]
        return cls(spark=spark, **reader(spark, folder))

    @property
    def customer_dimension(self) -> DataFrame:
        return self.customers

    @property
    def facts(self) -> DataFrame:
        if self.written_facts is not None:
            return self.written_facts
        return order_facts(self.orders, self.delivery_events, self.discounts)

    def tables(self) -> dict[str, DataFrame]:
        names = ("customers", "restaurants", "orders", "order_items", "delivery_events", "discounts")
        return {name: getattr(self, name) for name in names}

    def with_written_facts(self, path: str) -> "ModelTables":
        """Join orders, events and discounts once, write the result, and let every analysis scan it."""
        files.write_parquet(self.facts, path)
        return replace(self, written_facts=self.spark.read.parquet(path))
