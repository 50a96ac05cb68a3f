"""Table definitions with keys and engines, their scans, and the catalog."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import NotFound, SchemaMismatch
from millrace.sources.types import parse

#: The table property that keeps a definition.
PROPERTY = "millrace.definition"


def quoted(name: str) -> str:
    """An identifier for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """A value for SQL text: strings are quoted, with backslashes and quotes escaped."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, list | tuple):
        return f"array({', '.join(map(literal, value))})"
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    if isinstance(value, int | float | Decimal):
        return repr(value) if not isinstance(value, Decimal) else f"{value}BD"
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'" if value.tzinfo is None else f"TIMESTAMP '{value.isoformat()}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    raise SchemaMismatch(f"no literal for {type(value).__name__}")


#: Column that an insert adds to tables whose FINAL needs the order of insertion.
SEQUENCE = "_ingest_seq"


@dataclass(frozen=True)
class Engine:
    """How rows of one key merge. ``columns``: the version, the sign, or the summed columns."""

    name: str
    columns: tuple[str, ...] = ()

    def __str__(self) -> str:
        return f"{self.name}({', '.join(self.columns)})" if self.columns else self.name


def merge_tree() -> Engine:
    return Engine("MergeTree")


def replacing(version: str | None = None) -> Engine:
    return Engine("ReplacingMergeTree", (version,) if version else ())


def summing(*columns: str) -> Engine:
    return Engine("SummingMergeTree", columns)


def aggregating() -> Engine:
    return Engine("AggregatingMergeTree")


def collapsing(sign: str) -> Engine:
    return Engine("CollapsingMergeTree", (sign,))


def versioned_collapsing(sign: str, version: str) -> Engine:
    return Engine("VersionedCollapsingMergeTree", (sign, version))


def memory() -> Engine:
    return Engine("Memory")


def log() -> Engine:
    return Engine("Log")


def null() -> Engine:
    return Engine("Null")


@dataclass(frozen=True)
class TableDef:
    """A named table: columns as (name, type string), the sorting key, and the engine."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...] = ()
    engine: Engine = Engine("MergeTree")
    sample_by: str | None = None
    path: str | None = None
    references: tuple[tuple[str, str, str], ...] = ()  # column, other table, its column

    @classmethod
    def of(cls, name: str, columns: dict[str, str], key=(), **more) -> TableDef:
        return cls(name, tuple(columns.items()), (key,) if isinstance(key, str) else tuple(key), **more)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([parse(kind).field(name) for name, kind in self.columns])

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def at(self, path: str) -> TableDef:
        return replace(self, path=path)

    def scan(self, spark: SparkSession) -> DataFrame:
        """The table's rows, a file scan or a catalog table, with its merge metadata on the columns."""
        df = spark.read.parquet(self.path) if self.path else spark.table(self.name)
        df = df.cache() if self.engine.name == "Memory" else df
        return df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in self.schema if f.name in df.columns], *[c for c in (SEQUENCE,) if c in df.columns])

    def variants(self, spark: SparkSession) -> DataFrame:
        """The rows with JSON columns as variants, whose paths can be taken by type; null where the text is no JSON."""
        json_ = {name for name, kind in self.columns if kind.removeprefix("Nullable(").rstrip(")") == "JSON" or kind.startswith("Object(")}
        df = self.scan(spark)
        return df.select(*[F.try_parse_json(c).alias(c) if c in json_ else F.col(c) for c in df.columns])

    def find(self, spark: SparkSession, *key) -> DataFrame:
        """The row with a primary key."""
        if len(key) != len(self.key):
            raise SchemaMismatch(f"{self.name} has the key {self.key}")
        df = self.scan(spark)
        for column, value in zip(self.key, key):
            df = df.filter(F.col(column) == F.lit(value))
        return df.limit(1)

    def join_condition(self, other: TableDef):
        """ON of a declared foreign key between two tables, on frames with the tables' names as aliases."""
        for a, b in ((self, other), (other, self)):
            for column, target, theirs in a.references:
                if target == b.name:
                    return F.col(f"{a.name}.{column}") == F.col(f"{b.name}.{theirs}")
        raise NotFound(f"no foreign key between {self.name} and {other.name}")

    def ddl(self, defaults: dict[str, str] | None = None) -> str:
        """CREATE TABLE for Spark's catalog; its properties keep what Spark's types do not: types, key and engine. ``defaults``: SQL of column defaults."""
        of = defaults or {}
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}{f' DEFAULT {of[f.name]}' if f.name in of else ''}" for f in self.schema)
        kept = {"types": dict(self.columns), "key": self.key, "engine": [self.engine.name, *self.engine.columns], "sample_by": self.sample_by}
        return f"CREATE TABLE IF NOT EXISTS {'.'.join(map(quoted, self.name.split('.')))} ({columns}) USING parquet TBLPROPERTIES ('{PROPERTY}' = {literal(json.dumps(kept))})"

    def render(self) -> str:
        """Python source of this definition."""
        columns = ", ".join(f"{n!r}: {k!r}" for n, k in self.columns)
        more = f", engine=Engine({self.engine.name!r}, {self.engine.columns!r})" if self.engine != merge_tree() else ""
        return f"{self.name} = TableDef.of({self.name!r}, {{{columns}}}, key={self.key!r}{more}{f', sample_by={self.sample_by!r}' if self.sample_by else ''})\n"


def expect_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame as it is, if it has these names and types in this order."""
    have, want = ([(f.name, f.dataType) for f in s] for s in (df.schema, schema))
    if have != want:
        raise SchemaMismatch(f"expected {want}, got {have}")
    return df


def as_select(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Just the columns of a row type."""
    return df.select(*schema.names)


class Catalog:
    """Tables and columns of a database, without hidden ones (names that begin with ``.`` or ``__``)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark, self.database = spark, database

    def tables(self, only=(), without=()) -> list[str]:
        names = sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)
        return [n for n in names if not n.startswith((".", "__")) and (not only or n in only) and n not in without]

    def kept(self, name: str) -> dict:
        """What a table's properties hold of its definition; empty for tables that others made."""
        at = f"{self.database}.{name}" if self.database else name
        found = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {'.'.join(map(quoted, at.split('.')))}").collect()}
        return json.loads(found[PROPERTY]) if PROPERTY in found else {}

    def columns(self, name: str) -> list[tuple[str, str, bool]]:
        """Name, type and whether the column is of the sorting key, or partitions or buckets a table that others made."""
        at, kept = f"{self.database}.{name}" if self.database else name, self.kept(name)
        return [(c.name, c.dataType, c.name in kept["key"] if kept else c.isPartition or c.isBucket) for c in self.spark.catalog.listColumns(at)]

    def definition(self, name: str) -> TableDef:
        """The table as a definition, with its key and engine where it was made from one."""
        kept, found = self.kept(name), self.columns(name)
        if not kept:
            return TableDef.of(name, {c: _type_name(kind) for c, kind, _ in found}, [c for c, _, k in found if k])
        return TableDef.of(name, kept["types"], kept["key"], engine=Engine(kept["engine"][0], tuple(kept["engine"][1:])), sample_by=kept["sample_by"])

    def print_schema(self, only=(), without=()) -> str:
        """Source of a definition for each table."""
        out = []
        for name in self.tables(only, without):
            out.append(self.definition(name).render())
        return "".join(out)


# Spark's simple type names and the dialect's.
NAMES = {"tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64", "float": "Float32", "double": "Float64", "boolean": "Bool", "string": "String", "date": "Date", "timestamp": "DateTime('UTC')", "timestamp_ntz": "DateTime", "binary": "String"}


def _type_name(simple: str) -> str:
    if simple in NAMES:
        return NAMES[simple]
    if simple.startswith("array<"):
        return f"Array({_type_name(simple[6:-1])})"
    if simple.startswith("decimal"):
        return "Decimal" + simple[7:].replace(",", ", ")
    return "String"
