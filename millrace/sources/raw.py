"""Raw SQL: typed expressions, statements, and text with bound values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.errors import InvalidQuery, NotFound
from millrace.sources.types import parse


def sql(kind: str, text: str) -> Column:
    """An expression as text, of a declared type."""
    return F.expr(text).cast(parse(kind).field("x").dataType)


def statement(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """The result of a text; ``{name}`` stands for a frame, which is no view of the session afterwards."""
    return spark.sql(text, **frames)


def load_raw(spark: SparkSession, text: str, **frames: DataFrame) -> list[Row]:
    return statement(spark, text, **frames).collect()


def bound(spark: SparkSession, text: str, *values, **frames: DataFrame) -> DataFrame:
    """The result of a text whose question marks stand for values, which are never parsed as SQL."""
    return spark.sql(text, args=list(values), **frames)


def load_bound(spark: SparkSession, text: str, *values, **frames: DataFrame) -> list[Row]:
    return bound(spark, text, *values, **frames).collect()


def load_optional_bound(spark: SparkSession, text: str, *values, **frames: DataFrame) -> Row | None:
    """The one row, or None; more rows are an error."""
    found = bound(spark, text, *values, **frames).head(2)
    if len(found) > 1:
        raise InvalidQuery("more than one row")
    return found[0] if found else None


def load_one_bound(spark: SparkSession, text: str, *values, **frames: DataFrame) -> Row:
    """The one row, or NotFound."""
    if (row := load_optional_bound(spark, text, *values, **frames)) is None:
        raise NotFound("no row")
    return row


def execute(spark: SparkSession, text: str, **frames: DataFrame) -> None:
    """Runs a statement without a result."""
    spark.sql(text, **frames).collect()


def execute_bound(spark: SparkSession, text: str, *values, **frames: DataFrame) -> None:
    bound(spark, text, *values, **frames).collect()


def ping(spark: SparkSession) -> bool:
    return spark.sql("SELECT 1 AS one").first().one == 1
