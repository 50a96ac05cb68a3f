"""Subquery predicates and set operations on DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _named(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_s{i}" for i in range(len(df.columns))])


def in_subquery(df: DataFrame, column: str, sub: DataFrame) -> DataFrame:
    """``column IN (sub)``: a semi join."""
    sub = _named(sub)
    return df.join(sub, F.col(column) == F.col("_s0"), "left_semi")


def not_in_subquery(df: DataFrame, column: str, sub: DataFrame) -> DataFrame:
    """``column NOT IN (sub)`` with three-valued logic: an anti join on equality, which may shuffle, and two counts of the subquery.

    An empty subquery keeps every row; one with a null keeps none; else rows with a null do not count.
    """
    sub = _named(sub)
    counts = sub.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_s0").isNull()).alias("nulls"))).scalar()
    n, nulls = counts["n"], counts["nulls"]
    left = df.join(sub.filter("_s0 IS NOT NULL"), F.col(column) == F.col("_s0"), "left_anti")
    return left.filter((n == 0) | ((nulls == 0) & F.col(column).isNotNull()))


eq_any = in_subquery
ne_all = not_in_subquery


def exists(df: DataFrame, sub: DataFrame, on: Column) -> DataFrame:
    """Rows for which a row of ``sub`` meets the condition."""
    return df.join(sub, on, "left_semi")


def not_exists(df: DataFrame, sub: DataFrame, on: Column) -> DataFrame:
    return df.join(sub, on, "left_anti")


def single_value(sub: DataFrame) -> Column:
    """The one value of a subquery; more rows raise."""
    return sub.scalar()


def asof_join(left: DataFrame, right: DataFrame, time: str, by: list[str], columns: list[str], inner: bool = False) -> DataFrame:
    """Each row of ``left`` with ``columns`` of the last row of ``right`` that has its keys and is no later; nulls, or no row where ``inner``, if there is none.

    Both sides go in one sort by keys and time, so no pair of rows is made. Rows of ``right`` with a null time are no match;
    of several at one time any may be the match.
    """
    names = left.columns
    mine = left.select(*[F.col(c) for c in names], F.lit(1).alias("_side"), F.lit(None).cast(_struct(right, columns)).alias("_row"))
    keyed = {c: F.col(c).cast(left.schema[c].dataType).alias(c) for c in [*by, time]}
    theirs = right.filter(F.col(time).isNotNull()).select(*[keyed[c] if c in keyed else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in names], F.lit(0).alias("_side"), F.struct(*columns).alias("_row"))
    last = Window.partitionBy(*by).orderBy(F.col(time).asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = mine.union(theirs).withColumn("_row", F.last("_row", ignorenulls=True).over(last)).filter("_side = 1")
    matched = F.col(time).isNotNull() & F.col("_row").isNotNull()
    for k in by:  # keys that are null equal nothing
        matched &= F.col(k).isNotNull()
    out = both.filter(matched) if inner else both
    return out.select(*names, *[F.when(matched, F.col("_row")[c]).alias(c) for c in columns])


def _struct(df: DataFrame, columns: list[str]):
    return df.select(F.struct(*columns).alias("s")).schema["s"].dataType


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs with ``low <= point < high``, by an equality on cells of ``width``: an interval stands in each cell that it touches.

    Choose a width near the usual length of an interval; then each point meets the intervals of its own cell only.
    """
    cell = lambda c: F.floor(c / F.lit(float(width)))
    cells = right.filter(F.col(low) < F.col(high)).withColumn("_cell", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high)))))
    on = (F.col("_at") == F.col("_cell")) & (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    return left.withColumn("_at", cell(F.col(point))).join(cells, on).drop("_at", "_cell")


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def intersect_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersectAll(b)


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b)


def with_queries(spark, main: str, recursive: bool = False, **ctes: DataFrame) -> DataFrame:
    """``WITH name AS (frame), ... main``. The text is left as it is but for a WITH of its own, which goes on after the frames."""
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", main, flags=re.IGNORECASE)
    rest = main[own.end() :] if own else main
    escape = rest.replace("{", "{{").replace("}", "}}")
    frames = ", ".join(f"`{name}` AS (SELECT * FROM {{{name}}})" for name in ctes)
    word = "WITH RECURSIVE" if recursive or (own and own[1]) else "WITH"
    return spark.sql(f"{word} {frames}{',' if own and frames else ''} {escape}" if frames or own else escape, **ctes)
