"""Small helpers of the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def values(spark: SparkSession, *records: str | None) -> DataFrame:
    return spark.createDataFrame([(record,) for record in records], "value STRING")


def tuples(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The plan as adaptive execution ended up running it."""
    df.collect()
    return plan(df)
