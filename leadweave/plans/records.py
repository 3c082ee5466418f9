"""Problem 2: rows that fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadweave.operators.bad_records import loaded, parse_records
from leadweave.plans.registry import query
from leadweave.session import table


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every record that doesn't load, with its reason."""
    return parse_records(table(spark, d, "incoming_raw").select("line_no", "raw_line")).filter("reason is not null").select("line_no", "reason")


@query()
def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    """All other records, as rows of the typed list."""
    return loaded(parse_records(table(spark, d, "incoming_raw")))
