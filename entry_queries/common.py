"""Shared helpers of the entry queries."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from tableferry import load_parquet

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return load_parquet(spark, f"{sf_dir}/{table}.parquet")


def views(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for table in tables:
        read(spark, sf_dir, table).createOrReplaceTempView(table)


def new_table(spark: SparkSession, label: str) -> str:
    """A table name of this run's own; the table goes when the process ends."""
    name = f"ferry_{label}_{uuid.uuid4().hex[:12]}"

    def drop() -> None:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session may have ended before the process
            pass

    atexit.register(drop)
    return name


def new_schema(spark: SparkSession, label: str) -> str:
    """A schema of this run's own; it goes with its tables when the process ends."""
    name = f"ferry_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name}")

    def drop() -> None:
        try:
            spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
        except Exception:  # the session may have ended before the process
            pass

    atexit.register(drop)
    return name
