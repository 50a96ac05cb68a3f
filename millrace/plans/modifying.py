"""Engines with FINAL, samples, and rewriting mutations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import dml, modifiers
from millrace.plans.catalogue import query, table
from millrace.sources import tables



@query("SELECT user_id, event_type, version, event_id FROM (SELECT user_id, event_type, event_id % 97 * 1000000 + event_id AS version, event_id FROM events) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY version DESC) = 1")
def final_replacing(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", (F.col("event_id") % 97 * 1000000 + F.col("event_id")).alias("version"), "event_id")
    return modifiers.final(e, tables.replacing("version"), ["user_id", "event_type"])


@query("SELECT user_id, round(sum(value), 2) AS value, sum(event_id)::BIGINT AS event_id FROM events GROUP BY user_id")
def final_summing(spark, d):
    out = modifiers.final(table(spark, d, "events").select("user_id", "value", "event_id"), tables.summing(), "user_id")
    return out.withColumn("value", F.round("value", 2))


@query("SELECT user_id, round(sum(value), 2) AS total, min(value) AS lo, max(value) AS hi, count(*) AS n FROM events GROUP BY user_id")
def final_aggregating(spark, d):
    tag = lambda c, name, agg: c.alias(name, metadata={"agg": agg})
    v = F.col("value")
    parts = table(spark, d, "events").select("user_id", tag(v, "total", "sum"), tag(v, "lo", "min"), tag(v, "hi", "max"), tag(F.lit(1).cast("bigint"), "n", "count"))
    return modifiers.final(parts, tables.aggregating(), "user_id").withColumn("total", F.round("total", 2))


@query("SELECT event_type, round(avg(value), 6) AS mean, array_to_string(list_sort(list(DISTINCT user_id % 10)), ',') AS tails, count(*) AS n, TRUE AS near FROM events GROUP BY event_type")
def final_states(spark, d):
    """Partial states of each user merged by type: a mean, a set, a list and a sketch of distinct events, within 10 %."""
    v = F.col("value")
    e = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.struct(F.sum(v).alias("sum"), F.count(v).alias("count")).alias("mean"), F.collect_set(F.col("user_id") % 10).alias("tails"), F.collect_list("event_id").alias("ids"), F.hll_sketch_agg("event_id", 14).alias("seen")).drop("user_id")
    how = {"mean": "avg", "tails": "groupUniqArray", "ids": "groupArray", "seen": "uniqCombined"}
    found = modifiers.final(e.select("event_type", *[F.col(c).alias(c, metadata={"agg": a}) for c, a in how.items()]), tables.aggregating(), "event_type")
    n = F.size("ids").cast("bigint")
    tails = F.array_join(F.transform(F.array_sort("tails"), lambda x: x.cast("string")), ",")
    return found.select("event_type", F.round(F.col("mean.sum") / F.col("mean.count"), 6).alias("mean"), tails.alias("tails"), n.alias("n"), (F.abs(F.hll_sketch_estimate("seen") - n) <= 0.1 * n).alias("near"))


@query("WITH s AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS sign FROM events) SELECT user_id, max(event_id) FILTER (sign = 1) AS event_id, 1 AS sign FROM s GROUP BY user_id HAVING sum(sign) > 0")
def final_collapsing(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(1).alias("sign"), F.col("event_id").alias(tables.SEQUENCE))
    return modifiers.final(e, tables.collapsing("sign"), "user_id").drop(tables.SEQUENCE)


@query("WITH s AS (SELECT user_id, event_id % 5 AS v, event_id, CASE WHEN event_id % 2 = 0 THEN -1 ELSE 1 END AS sign FROM events) SELECT user_id, v, max(event_id) FILTER (sign = 1) AS event_id, 1 AS sign FROM s GROUP BY user_id, v HAVING sum(sign) > 0")
def final_versioned(spark, d):
    e = table(spark, d, "events").select("user_id", (F.col("event_id") % 5).alias("v"), "event_id", F.when(F.col("event_id") % 2 == 0, -1).otherwise(1).alias("sign"), F.col("event_id").alias(tables.SEQUENCE))
    return modifiers.final(e, tables.versioned_collapsing("sign", "v"), "user_id").drop(tables.SEQUENCE)


@query()
def sample(spark, d):
    """A tenth of the orders by the hash of their key, the same in any layout."""
    return modifiers.sample(table(spark, d, "orders"), 0.1, "o_orderkey").select("o_orderkey", "o_totalprice")


@query()
def sample_offset(spark, d):
    return modifiers.sample(table(spark, d, "orders"), 0.1, "o_orderkey", 0.5).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS sampled, count(DISTINCT o_orderkey) AS orders, TRUE AS fair FROM orders")
def sample_parts(spark, d):
    """Samples with offsets that do not overlap share no row, together give all, and are of like size."""
    o = table(spark, d, "orders").select("o_orderkey")
    parts = [modifiers.sample(o, 0.25, "o_orderkey", k / 4) for k in range(4)]
    both = parts[0]
    for p in parts[1:]:
        both = both.union(p)
    n = parts[0].agg(F.count(F.lit(1)).alias("n"))
    fair = F.col("n").between(0.2 * F.col("sampled"), 0.3 * F.col("sampled")).alias("fair")
    return both.agg(F.count(F.lit(1)).alias("sampled"), F.count_distinct("o_orderkey").alias("orders")).crossJoin(n).select("sampled", "orders", fair)


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_totalprice > 200000 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice FROM orders")
def update_rewrite(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return dml.updated(o, {"o_orderstatus": "X", "o_totalprice": F.round(F.col("o_totalprice") * 2, 2)}, F.col("o_totalprice") > 200000)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'F', FALSE)")
def delete_rewrite(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return dml.deleted(o, F.nullif("o_orderstatus", F.lit("O")) == "F")
