"""Queries as values: one slot for each clause, and a fixed order in which the clauses apply.

source, SAMPLE, FINAL, ARRAY JOIN and joins, PREWHERE, WHERE, GROUP BY (with totals), HAVING, SELECT,
DISTINCT [ON], ORDER BY, LIMIT BY, OFFSET, LIMIT. The order of method calls does not matter; a clause that is
set again replaces what was there, but for ``and_filter`` and joins, which add.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.errors import InvalidQuery, NotFound
from millrace.operators import modifiers
from millrace.sources.tables import TableDef

#: Settings that have a counterpart in Spark.
SETTINGS = {"max_threads": "spark.sql.shuffle.partitions", "max_block_bytes": "spark.sql.files.maxPartitionBytes", "broadcast_limit": "spark.sql.autoBroadcastJoinThreshold"}


def ordered(c) -> Column:
    """A sort key; without a direction it is ascending, nulls last."""
    if isinstance(c, str):
        return F.col(c).asc_nulls_last()
    return c if any(x in str(c) for x in ("ASC NULLS", "DESC NULLS")) else c.asc_nulls_last()


def asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


@dataclass(frozen=True)
class Query:
    source: DataFrame | TableDef | Query
    name: str | None = None
    columns: tuple = ()
    prewhere_: Column | None = None
    where: Column | None = None
    joins: tuple = ()
    arrays: tuple = ()
    keys: tuple = ()
    having_: Column | None = None
    totals: bool = False
    is_final: bool = False
    sampled: tuple[float, float] | None = None
    is_distinct: bool = False
    on: tuple = ()
    order: tuple = ()
    by: tuple | None = None
    limit_: int | None = None
    offset_: int | None = None
    conf: tuple = ()

    # --- clauses

    def select(self, *columns) -> Query:
        return replace(self, columns=columns)

    def filter(self, predicate: Column) -> Query:
        """WHERE; replaces what was there."""
        return replace(self, where=predicate)

    def and_filter(self, predicate: Column) -> Query:
        return replace(self, where=predicate if self.where is None else self.where & predicate)

    def optional_filter(self, value, predicate: Callable) -> Query:
        """Adds a predicate of a value, unless that is None."""
        return self if value is None else self.and_filter(predicate(value))

    def prewhere(self, predicate: Column) -> Query:
        return replace(self, prewhere_=predicate)

    def join(self, other, on: Column | None = None, how: str = "inner") -> Query:
        return replace(self, joins=(*self.joins, (other, on, how)))

    def inner_join(self, other, on=None) -> Query:
        return self.join(other, on)

    def left_join(self, other, on=None) -> Query:
        return self.join(other, on, "left")

    def right_join(self, other, on=None) -> Query:
        return self.join(other, on, "right")

    def full_join(self, other, on=None) -> Query:
        return self.join(other, on, "full")

    def cross_join(self, other) -> Query:
        return self.join(other, None, "cross")

    inner_join_on, left_join_on = inner_join, left_join

    def array_join(self, *arrays: str, left: bool = False, default_fill: bool = False) -> Query:
        return replace(self, arrays=(*self.arrays, (arrays, left, default_fill)))

    def left_array_join(self, *arrays: str, default_fill: bool = False) -> Query:
        return self.array_join(*arrays, left=True, default_fill=default_fill)

    def group_by(self, *keys) -> Query:
        return replace(self, keys=keys)

    def having(self, predicate: Column) -> Query:
        return replace(self, having_=predicate)

    def with_totals(self) -> Query:
        return replace(self, totals=True)

    def final_(self) -> Query:
        return replace(self, is_final=True)

    def sample(self, rate: float, offset: float = 0.0) -> Query:
        return replace(self, sampled=(rate, offset))

    sample_with_offset = sample

    def distinct(self) -> Query:
        return replace(self, is_distinct=True)

    def distinct_on(self, *by) -> Query:
        return replace(self, on=by)

    def order_by(self, *keys) -> Query:
        return replace(self, order=keys)

    def limit(self, n: int) -> Query:
        return replace(self, limit_=n)

    def offset(self, n: int) -> Query:
        return replace(self, offset_=n)

    def limit_by(self, n: int, *by, offset: int = 0) -> Query:
        return replace(self, by=(n, offset, by))

    def limit_offset_by(self, n: int, offset: int, *by) -> Query:
        return self.limit_by(n, *by, offset=offset)

    def settings(self, **conf) -> Query:
        return replace(self, conf=(*self.conf, *conf.items()))

    def alias(self, name: str) -> Query:
        """As a derived table."""
        return replace(self, name=name)

    as_derived_table = as_subquery = alias

    # --- plan

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The plan as a frame. Settings hold for ``run`` and the other ways to a result, not for a frame that is used later."""
        df = self._source(spark)
        for other, on, how in self.joins:
            right, table = _frame(other, spark)
            if on is None and how != "cross":
                if not (isinstance(self.source, TableDef) and table is not None):
                    raise InvalidQuery("a join without ON needs tables with a foreign key")
                on = self.source.join_condition(table)
            df = df.crossJoin(right) if how == "cross" else df.join(right, on, how)
        for arrays, left, fill in self.arrays:
            df = modifiers.array_join(df, arrays, left, fill)
        for p in (self.prewhere_, self.where):
            df = df if p is None else df.filter(p)
        if self.totals:
            return self._with_totals(df)
        return self._sliced(self._grouped(df) if self.keys else self._projected(df))

    def _sliced(self, df: DataFrame) -> DataFrame:
        df = df.offset(self.offset_) if self.offset_ else df
        return df if self.limit_ is None else df.limit(self.limit_)

    def _source(self, spark: SparkSession) -> DataFrame:
        df, table = _frame(self.source, spark)
        if self.sampled:
            key = [table.sample_by] if table and table.sample_by else list(table.key) if table else df.columns
            df = modifiers.sample(df, self.sampled[0], key, self.sampled[1])
        if self.is_final:
            if table is None:
                raise InvalidQuery("FINAL needs a table with an engine")
            df = modifiers.final(df, table.engine, table.key)
        if table is not None:
            df = df.select(*table.names).alias(self.name or table.name)
        return df.alias(self.name) if self.name else df

    def _parts(self) -> tuple[list[Column], list[Column], list[int]]:
        """Keys, aggregates, and for each selected column its place among both."""
        if not self.columns:
            raise InvalidQuery("GROUP BY needs a select")
        keys = [F.col(k) if isinstance(k, str) else k for k in self.keys]
        named, aggregates, places = {str(k): i for i, k in reversed(list(enumerate(keys)))}, [], []
        for c in (F.col(c) if isinstance(c, str) else c for c in self.columns):
            if str(c) in named:
                places.append(named[str(c)])
            else:
                places.append(len(keys) + len(aggregates))
                aggregates.append(c)
        return keys, aggregates, places

    def _grouped(self, df: DataFrame) -> DataFrame:
        keys, aggregates, places = self._parts()
        df = df.groupBy(*keys).agg(*aggregates) if aggregates else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return self._cut(df if self.having_ is None else df.filter(self.having_), places=places)

    def _with_totals(self, df: DataFrame) -> DataFrame:
        """The groups, cut by every clause, and the row of all rows, which none of them cuts."""
        if not self.keys:
            raise InvalidQuery("WITH TOTALS needs GROUP BY")
        keys, aggregates, places = self._parts()
        df = df.groupingSets([keys, []], *keys).agg(*aggregates, (F.grouping_id() > 0).alias(modifiers.TOTAL))
        places = [*places, len(keys) + len(aggregates)]
        total = F.col(modifiers.TOTAL)
        if self.limit_ is None and not (self.offset_ or self.by or self.is_distinct):
            df = df if self.having_ is None else df.filter(total | self.having_)
            return _pick(df.orderBy(total, *map(ordered, self.order)) if self.order else df, places)
        body = df.filter(~total)
        body = body if self.having_ is None else body.filter(self.having_)
        if self.is_distinct:  # of the selected columns, so these alone can be sorted by
            both = self._sliced(self._cut(body, places=places)).union(_pick(df.filter(total), places))
            return both.orderBy(modifiers.TOTAL, *map(ordered, self.order)) if self.order else both
        both = self._sliced(self._cut(body)).union(df.filter(total))
        return _pick(both.orderBy(modifiers.TOTAL, *map(ordered, self.order)) if self.order else both, places)

    def _projected(self, df: DataFrame) -> DataFrame:
        # DISTINCT ON, LIMIT BY and ORDER BY may use columns that are not selected
        if self.on:
            df = modifiers.distinct_on(df, [F.col(c) if isinstance(c, str) else c for c in self.on], [ordered(c) for c in self.order] or None)
        if self.columns and not self.on and not self.by and not self._sorts_hidden(df):
            return self._cut(df.select(*self.columns))
        return self._cut(df, select=True)

    def _sorts_hidden(self, df: DataFrame) -> bool:
        given = {c for c in self.columns if isinstance(c, str)}
        return any(isinstance(c, str) and c in df.columns and c not in given for c in self.order)

    def _cut(self, df: DataFrame, select: bool = False, places: list[int] | None = None) -> DataFrame:
        """LIMIT BY, DISTINCT and ORDER BY, and the projection: before DISTINCT where there is one, else after the order."""
        if self.by:
            n, offset, by = self.by
            df = modifiers.limit_by(df, n, list(by), [ordered(c) for c in self.order] or [F.lit(1)], offset)
        project = (lambda df: _pick(df, places)) if places is not None else (lambda df: df.select(*self.columns)) if select and self.columns else (lambda df: df)
        if self.is_distinct:
            df, project = project(df).distinct(), lambda df: df
        if self.order:
            df = df.orderBy(*map(ordered, self.order))
        return project(df)

    # --- results

    def load(self, spark: SparkSession) -> list[Row]:
        with scoped(spark, dict(self.conf)):
            return self.to_df(spark).collect()

    def first(self, spark: SparkSession) -> Row:
        if (row := self.get_result(spark)) is None:
            raise NotFound("no row")
        return row

    def get_result(self, spark: SparkSession) -> Row | None:
        with scoped(spark, dict(self.conf)):
            found = self.to_df(spark).head(1)
        return found[0] if found else None

    def first_or(self, spark: SparkSession, default):
        row = self.get_result(spark)
        return default if row is None else row

    def run(self, spark: SparkSession, action: Callable):
        """What an action on the frame gives, under the query's settings."""
        with scoped(spark, dict(self.conf)):
            return action(self.to_df(spark))

    def stream(self, spark: SparkSession):
        """Rows one by one, a partition at a time; the settings hold until the last."""
        with scoped(spark, dict(self.conf)):
            yield from self.to_df(spark).toLocalIterator(prefetchPartitions=True)

    def load_arrow(self, spark: SparkSession):
        return self.run(spark, lambda df: df.toArrow())

    def explain(self, spark: SparkSession) -> str:
        return self.run(spark, lambda df: df._jdf.queryExecution().toString())


def _pick(df: DataFrame, places: list[int]) -> DataFrame:
    """Columns by their places, under their names."""
    names = df.columns
    return df.toDF(*[f"_{i}" for i in range(len(names))]).select(*[F.col(f"_{i}").alias(names[i]) for i in places])


def _frame(source, spark: SparkSession) -> tuple[DataFrame, TableDef | None]:
    if isinstance(source, Query):
        return source.to_df(spark).alias(source.name) if source.name else source.to_df(spark), None
    if isinstance(source, TableDef):
        return source.scan(spark).alias(source.name), source
    return source, None


class scoped:
    """Settings for the time of a block; unknown ones warn."""

    def __init__(self, spark: SparkSession, conf: dict):
        self.spark, self.conf, self.before = spark, conf, {}

    def __enter__(self):
        import warnings

        for k, v in self.conf.items():
            key = SETTINGS.get(k, k if k.startswith("spark.") else None)
            if key is None:
                warnings.warn(f"the setting {k} has no counterpart", stacklevel=3)
                continue
            self.before[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, str(v))
        return self

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def find(spark: SparkSession, table: TableDef, *key) -> Row:
    """The row with a primary key, or NotFound."""
    found = table.find(spark, *key).head(1)
    if not found:
        raise NotFound(f"{table.name} has no {key}")
    return found[0]
