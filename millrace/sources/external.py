"""Tables that others keep: files in named formats, and databases by URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import InvalidQuery
from millrace.sources.tables import TableDef

#: Of each format: Spark's reader and its options.
READERS = {
    "JSONEachRow": ("json", {}),
    "CSV": ("csv", {}),
    "CSVWithNames": ("csv", {"header": "true"}),
    "TabSeparated": ("csv", {"sep": "\t", "nullValue": "\\N"}),
    "TabSeparatedWithNames": ("csv", {"sep": "\t", "nullValue": "\\N", "header": "true"}),
    "Native": ("parquet", {}),
    "Parquet": ("parquet", {}),
    "ORC": ("orc", {}),
}


def files(spark: SparkSession, table: TableDef, name: str, *paths: str, strict: bool = True, **options: str) -> DataFrame:
    """Files in a format, read by the columns of a definition. A row that does not fit them is an error, or null where not ``strict``."""
    if name not in READERS:
        raise InvalidQuery(f"unknown format {name}")
    kind, own = READERS[name]
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"} if kind in ("json", "csv") else {}
    df = spark.read.format(kind).options(**{**own, **mode, **options}).schema(table.schema).load(list(paths))
    return df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in table.schema])


def database(spark: SparkSession, url: str, name: str, split: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A table of a database with a JDBC driver. ``split``: a numeric column, its least and largest value, and the number of parallel reads."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if split:
        column, low, high, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()
