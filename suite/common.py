from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass
class Suite:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            assert name not in self.queries, name
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark, sf_dir):
    """Orders with their unique key as record number."""
    return table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "recnum")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumnRenamed("event_id", "recnum")


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "recnum")


def as_date(column: str):
    return F.col(column).cast("date")
