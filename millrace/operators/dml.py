"""UPDATE, DELETE and INSERT on tables of Parquet files, by rewriting.

A rewrite goes to a new folder beside the table, which then takes its place by renaming; a reader sees the
old files or the new ones. One writer at a time is assumed. A predicate is never dropped: without
one, ``delete`` and ``update`` must say ``all=True``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.errors import InvalidQuery, SchemaMismatch
from millrace.sources.tables import SEQUENCE, TableDef

KEEP_ORDER = {"ReplacingMergeTree", "CollapsingMergeTree", "VersionedCollapsingMergeTree"}


def updated(df: DataFrame, changes: dict[str, object], where: Column | None = None, all: bool = False) -> DataFrame:
    """The frame after ``UPDATE SET changes WHERE where``. Rows whose predicate is null stay."""
    if where is None and not all:
        raise InvalidQuery("an update without a predicate needs all=True")
    if unknown := set(changes) - set(df.columns):
        raise SchemaMismatch(f"no such columns: {sorted(unknown)}")
    hit = F.lit(True) if where is None else where
    values = {c: v if isinstance(v, Column) else F.lit(v) for c, v in changes.items() if v is not ...}
    return df.select(*[F.when(hit, values[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def deleted(df: DataFrame, where: Column | None = None, all: bool = False) -> DataFrame:
    """The frame after ``DELETE WHERE where``. Rows whose predicate is null stay."""
    if where is None:
        if not all:
            raise InvalidQuery("a delete without a predicate needs all=True")
        return df.limit(0)
    return df.filter(~F.coalesce(where, F.lit(False)))


def rewrite(spark: SparkSession, path: str, df: DataFrame, codec: str = "zstd") -> None:
    """Puts the frame in the place of the files at ``path``, which it may read."""
    new, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", codec).parquet(new)
    where = spark._jvm.org.apache.hadoop.fs.Path
    fs = where(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where(path)) and not fs.rename(where(path), where(old)):
        raise OSError(f"can't move {path}")
    if not fs.rename(where(new), where(path)):
        fs.rename(where(old), where(path))
        raise OSError(f"can't put the new files at {path}")
    fs.delete(where(old), True)
    spark.catalog.refreshByPath(path)


def update(spark: SparkSession, table: TableDef, changes: dict, where: Column | None = None, all: bool = False) -> None:
    rewrite(spark, table.path, updated(spark.read.parquet(table.path), changes, where, all))


def delete(spark: SparkSession, table: TableDef, where: Column | None = None, all: bool = False) -> None:
    rewrite(spark, table.path, deleted(spark.read.parquet(table.path), where, all))


def insert(spark: SparkSession, table: TableDef, rows, codec: str = "zstd") -> int:
    """Appends rows (dicts, tuples in column order, an Arrow table or a frame); gives their number. No rows: nothing happens."""
    import pyarrow as pa

    schema = table.schema
    if isinstance(rows, DataFrame):
        df = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    elif isinstance(rows, pa.Table):
        if not rows.num_rows:
            return 0
        df = spark.createDataFrame(rows).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    else:
        rows = [tuple(r[n] for n in schema.names) if isinstance(r, dict) else tuple(r) for r in rows]
        if not rows:
            return 0
        df = spark.createDataFrame(rows, schema)
    seen = None
    if isinstance(rows, DataFrame):  # counted on the way, so that the source runs once
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    number = lambda: seen.get["n"] if seen is not None else rows.num_rows if isinstance(rows, pa.Table) else len(rows)
    if table.engine.name == "Null":
        df.write.format("noop").mode("append").save()
        return number()
    if table.engine.name in KEEP_ORDER and table.path:
        # the order of insertion decides between equal versions, so it is kept with the rows
        start = 0
        try:
            start = (spark.read.parquet(table.path).agg(F.max(SEQUENCE)).first()[0] or 0) + (1 << 40)
        except Exception as e:  # noqa: BLE001  no files yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
        df = df.withColumn(SEQUENCE, F.monotonically_increasing_id() + F.lit(start))
    writer = df.write.mode("append").option("compression", codec)
    if table.path:
        writer.parquet(table.path)
        spark.catalog.refreshByPath(table.path)
    else:
        writer.insertInto(table.name)
    return number()
