"""Queries over tables that are written first: inserts, FINAL, mutations, formats, cursors and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dml
from millrace.plans.catalogue import query, table
from millrace.plans.query import Query
from millrace.sources import external, scratch, tables
from millrace.streaming import events, sinks

_ORDER = {"o_orderkey": "Int64", "o_orderstatus": "Nullable(String)", "o_totalprice": "Float64"}


def _orders(spark, d, name):
    """A stored copy of three columns of the orders."""
    t = tables.TableDef.of("orders", _ORDER, "o_orderkey", path=scratch.folder(spark, name))
    dml.insert(spark, t, table(spark, d, "orders").select(*_ORDER))
    return t


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_totalprice > 200000 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice FROM orders")
def update_stored(spark, d):
    """UPDATE that rewrites the files."""
    t = _orders(spark, d, "update")
    dml.update(spark, t, {"o_orderstatus": "X", "o_totalprice": F.round(F.col("o_totalprice") * 2, 2)}, F.col("o_totalprice") > 200000)
    return t.scan(spark)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 150000)")
def delete_stored(spark, d):
    """DELETE that rewrites the files."""
    t = _orders(spark, d, "delete")
    dml.delete(spark, t, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 150000))
    return t.scan(spark)


@query("SELECT user_id, event_type, max(event_id) AS version, count(*) FILTER (event_id >= 0) > 0 AS seen FROM events GROUP BY user_id, event_type")
def insert_final(spark, d):
    """Three inserts into a replacing table, and FINAL over its files."""
    t = tables.TableDef.of("seen", {"user_id": "Int64", "event_type": "String", "version": "Int64", "seen": "Bool"}, ("user_id", "event_type"), engine=tables.replacing("version"), path=scratch.folder(spark, "final"))
    e = table(spark, d, "events").select("user_id", "event_type", F.col("event_id").alias("version"), F.lit(True).alias("seen"))
    for k in range(3):
        dml.insert(spark, t, e.filter(F.col("version") % 3 == k))
    return Query(t).final_().to_df(spark)


@query("SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def final_by_order(spark, d):
    """Without a version the row that was inserted last stays: halves of the events, one insert each."""
    t = tables.TableDef.of("last", {"user_id": "Int64", "value": "Float64"}, "user_id", engine=tables.replacing(), path=scratch.folder(spark, "order"))
    last = table(spark, d, "events").groupBy("user_id").agg(F.max_by("value", "event_id").alias("value"))
    dml.insert(spark, t, table(spark, d, "events").select("user_id", "value"))
    dml.insert(spark, t, last)
    return Query(t).final_().to_df(spark)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)")
def find_row(spark, d):
    """The row with a primary key; the key's filter reaches the scan."""
    t = tables.TableDef.of("orders", _ORDER, "o_orderkey", path=f"{d}/orders.parquet")
    return t.find(spark, table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0])


@query("SELECT 'JSONEachRow' AS format, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, count(DISTINCT o_orderpriority) AS priorities FROM orders UNION ALL SELECT 'CSVWithNames', count(*), sum(o_orderkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders UNION ALL SELECT 'TabSeparated', count(*), sum(o_orderkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders UNION ALL SELECT 'Native', count(*), sum(o_orderkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders UNION ALL SELECT 'ORC', count(*), sum(o_orderkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders")
def formats(spark, d):
    """All orders written in each format and read back."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    at, out = scratch.folder(spark, "formats"), None
    t = tables.TableDef.of("orders", {"o_orderkey": "Nullable(Int64)", "o_orderpriority": "Nullable(String)"}, "o_orderkey")
    for name in ("JSONEachRow", "CSVWithNames", "TabSeparated", "Native", "ORC"):
        sinks.write_format(o, name, f"{at}/{name}", "none")
        one = external.files(spark, t, name, f"{at}/{name}").agg(F.lit(name).alias("format"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.count_distinct("o_orderpriority").alias("priorities"))
        out = one if out is None else out.union(one)
    return out


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def insert_rows(spark, d):
    """Rows of the client inserted as tuples, dicts and an Arrow table."""
    t = tables.TableDef.of("nation", {"n_nationkey": "Int32", "n_name": "String", "n_regionkey": "Int32"}, "n_nationkey", path=scratch.folder(spark, "rows"))
    found = [tuple(r) for r in table(spark, d, "nation").select(*t.names).orderBy("n_nationkey").collect()]  # a table of 25 rows
    dml.insert(spark, t, found[:5])
    with sinks.AsyncInserter(spark, t, sinks.InsertConfig(wait=False, busy_timeout_ms=50, max_rows=6)) as out:
        out.write_many(dict(zip(t.names, r)) for r in found[5:15])
    import pyarrow as pa

    dml.insert(spark, t, pa.Table.from_pylist([dict(zip(t.names, r)) for r in found[15:]]))
    return t.scan(spark)


@query("SELECT count(*) AS n, sum(event_id)::BIGINT AS ids, count(DISTINCT event_type) AS types FROM events")
def arrow_stream(spark, d):
    """Batches of a whole result, fetched a partition at a time and added up on the client."""
    n = ids = 0
    types: set[str] = set()
    for batch in sinks.arrow_batches(table(spark, d, "events").select("event_id", "event_type"), 1000):
        n, ids = n + batch.num_rows, ids + sum(batch.column(0).to_pylist())
        types.update(batch.column(1).to_pylist())
    return spark.createDataFrame([(n, ids, len(types))], "n long, ids long, types long")


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_stream(spark, d):
    """Windows over a stream of files, to a table in memory."""
    at = scratch.folder(spark, "stream")
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.repartition(3).write.parquet(f"{at}/in")
    found = events.tumbling(spark.readStream.schema(e.schema).parquet(f"{at}/in"), "ts", "6 hours", [F.count(F.lit(1)).alias("n")], ["event_type"])
    name = "stream_" + at.rsplit("-", 1)[1]
    run = found.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    out = spark.table(name)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n")


@query("SELECT DISTINCT event_type, user_id FROM events")
def dedup_stream(spark, d):
    """Events seen before are dropped; the stream appends the rest to files."""
    at = scratch.folder(spark, "dedup")
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id")
    e.repartition(3).write.parquet(f"{at}/in")
    found = events.dedup(spark.readStream.schema(e.schema).parquet(f"{at}/in"), ["event_type", "user_id"], "ts", "400 days")
    run = found.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{at}/out").select("event_type", "user_id")
