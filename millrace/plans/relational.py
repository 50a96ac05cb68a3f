"""Projection, filters, subqueries, joins, sorting, limits, set operations and CTEs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.operators import modifiers, relational
from millrace.plans.catalogue import query, table
from millrace.plans.query import Query, asc, desc
from millrace.sources import raw, tables


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity BETWEEN 5 AND 20 AND l_returnflag IN ('R', 'A') AND l_linestatus NOT IN ('O') AND l_discount >= 0.03 AND l_discount <= 0.07 AND l_tax > 0.01 AND l_tax < 0.07 AND NOT (l_linenumber = 3) AND l_shipdate IS NOT NULL AND (l_linenumber != 2 OR l_quantity = 7)")
def filter_ops(spark, d):
    c = F.col
    q = Query(table(spark, d, "lineitem")).filter(c("l_quantity").between(5, 20)).and_filter(c("l_returnflag").isin("R", "A") & ~c("l_linestatus").isin("O"))
    q = q.and_filter((c("l_discount") >= 0.03) & (c("l_discount") <= 0.07) & (c("l_tax") > 0.01) & (c("l_tax") < 0.07))
    q = q.and_filter(~(c("l_linenumber") == 3) & c("l_shipdate").isNotNull() & ((c("l_linenumber") != 2) | (c("l_quantity") == 7)))
    return q.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").to_df(spark)


@query("SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%00_' AND c_name ILIKE 'customer%' AND c_mktsegment IS NOT NULL")
def like_ops(spark, d):
    return Query(table(spark, d, "customer")).filter(F.col("c_name").like("%00_") & F.col("c_name").ilike("customer%") & F.col("c_mktsegment").isNotNull()).select("c_custkey", "c_name").to_df(spark)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE FALSE)")
def empty_in(spark, d):
    """An empty list holds nothing, so all rows are outside of it."""
    return Query(table(spark, d, "orders")).filter(F.col("o_orderkey").isin([]) | ~F.col("o_orderkey").isin([])).select("o_orderkey").to_df(spark)


@query("SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity > 45")
def prewhere(spark, d):
    return Query(table(spark, d, "lineitem")).prewhere(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).filter(F.col("l_quantity") > 45).select("l_orderkey", "l_partkey", "l_extendedprice").to_df(spark)


@query("SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderkey >= 10")
def filter_replaces(spark, d):
    """A second ``filter`` takes the place of the first; ``alias`` renames; a missing value adds no filter."""
    q = Query(table(spark, d, "orders")).filter(F.col("o_orderkey") < 5).filter(F.col("o_orderkey") >= 10).optional_filter(None, lambda v: F.col("o_custkey") == v)
    return q.select("o_orderkey", F.col("o_totalprice").alias("price")).to_df(spark)


@query("SELECT DISTINCT event_type, user_id % 5 AS bucket FROM events")
def distinct(spark, d):
    return Query(table(spark, d, "events")).select("event_type", (F.col("user_id") % 5).alias("bucket")).distinct().to_df(spark)


@query("SELECT DISTINCT ON (user_id) user_id, event_id, event_type FROM events ORDER BY user_id, event_id")
def distinct_on(spark, d):
    return Query(table(spark, d, "events")).distinct_on("user_id").order_by("user_id", "event_id").select("user_id", "event_id", "event_type").to_df(spark)


@query("SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_totalprice > 300000")
def qualified_columns(spark, d):
    o, c, n = table(spark, d, "orders").alias("o"), table(spark, d, "customer").alias("c"), table(spark, d, "nation").alias("n")
    q = Query(o).inner_join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).inner_join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
    return q.filter(F.col("o.o_totalprice") > 300000).select("o.o_orderkey", "c.c_name", "n.n_name").to_df(spark)


@query("SELECT seg, count(*) AS n FROM (SELECT c_mktsegment AS seg FROM customer WHERE c_acctbal > 0) AS t GROUP BY seg")
def derived_table(spark, d):
    inner = Query(table(spark, d, "customer")).filter(F.col("c_acctbal") > 0).select(F.col("c_mktsegment").alias("seg")).as_derived_table("t")
    return Query(inner).group_by("seg").select("seg", F.count(F.lit(1)).alias("n")).to_df(spark)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderpriority = '1-URGENT'")
def bound_sql(spark, d):
    """Raw SQL with bound parameters."""
    return raw.bound(spark, "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice > ? AND o_orderpriority = ?", 250000.0, "1-URGENT", orders=table(spark, d, "orders"))


@query("SELECT o_orderkey, o_totalprice / 100 AS hundreds, o_orderpriority || '!' AS loud FROM orders")
def raw_expression(spark, d):
    """Typed raw SQL beside other columns."""
    return Query(table(spark, d, "orders")).select("o_orderkey", raw.sql("Float64", "o_totalprice / 100").alias("hundreds"), raw.sql("String", "o_orderpriority || '!'").alias("loud")).to_df(spark)


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def raw_statement(spark, d):
    return raw.statement(spark, "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus", orders=table(spark, d, "orders"))


# --- subqueries


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)")
def in_subquery(spark, d):
    sub = table(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)).select("o_custkey")
    return relational.in_subquery(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", sub)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000)")
def not_in_subquery(spark, d):
    sub = table(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 200000)).select("o_custkey")
    return relational.not_in_subquery(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", sub)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT nullif(o_custkey, 7) FROM orders WHERE o_totalprice > 400000 OR o_custkey = 7)")
def not_in_null(spark, d):
    """A null in the subquery gives no row."""
    sub = table(spark, d, "orders").filter((F.col("o_totalprice") > 400000) | (F.col("o_custkey") == 7)).select(F.nullif("o_custkey", F.lit(7)).alias("k"))
    return relational.not_in_subquery(table(spark, d, "customer").select("c_custkey"), "c_custkey", sub)


@query("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)")
def exists(spark, d):
    sub = table(spark, d, "orders").filter(F.col("o_totalprice") > 400000)
    return relational.exists(table(spark, d, "customer").select("c_custkey"), sub, F.col("o_custkey") == F.col("c_custkey"))


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
def not_exists(spark, d):
    sub = table(spark, d, "orders").filter(F.col("o_totalprice") > 200000)
    return relational.not_exists(table(spark, d, "customer").select("c_custkey"), sub, F.col("o_custkey") == F.col("c_custkey"))


@query("SELECT p_partkey FROM part WHERE p_partkey = ANY (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
def eq_any(spark, d):
    return relational.eq_any(table(spark, d, "part").select("p_partkey"), "p_partkey", table(spark, d, "lineitem").filter("l_quantity >= 50").select("l_partkey"))


@query("SELECT p_partkey FROM part WHERE p_partkey <> ALL (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def ne_all(spark, d):
    return relational.ne_all(table(spark, d, "part").select("p_partkey"), "p_partkey", table(spark, d, "lineitem").filter("l_quantity >= 49").select("l_partkey"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT 1.8 * avg(o_totalprice) FROM orders)")
def scalar_subquery(spark, d):
    orders = table(spark, d, "orders")
    return orders.filter(F.col("o_totalprice") > relational.single_value(orders.agg(1.8 * F.avg("o_totalprice")))).select("o_orderkey", "o_totalprice")


# --- joins


#: Every customer has an order, so the condition, over whole tables, makes the gaps of outer joins.
_ON = "c_custkey = o_custkey AND o_totalprice > 100 * c_acctbal"


def _dear():
    return (F.col("c_custkey") == F.col("o_custkey")) & (F.col("o_totalprice") > 100 * F.col("c_acctbal"))


@query(f"SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON {_ON}")
def left_join(spark, d):
    return Query(table(spark, d, "customer")).left_join(table(spark, d, "orders"), _dear()).select("c_custkey", "o_orderkey").to_df(spark)


@query(f"SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON {_ON}")
def right_join(spark, d):
    return Query(table(spark, d, "orders")).right_join(table(spark, d, "customer"), _dear()).select("c_custkey", "o_orderkey").to_df(spark)


@query(f"SELECT c_custkey, o_orderkey FROM customer FULL JOIN orders ON {_ON}")
def full_join(spark, d):
    return Query(table(spark, d, "customer")).full_join(table(spark, d, "orders"), _dear()).select("c_custkey", "o_orderkey").to_df(spark)


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def foreign_key_join(spark, d):
    """ON comes from a declared foreign key."""
    customer = tables.TableDef.of("customer", {"c_custkey": "Int64", "c_name": "String"}, "c_custkey", path=f"{d}/customer.parquet")
    orders = tables.TableDef.of("orders", {"o_orderkey": "Int64", "o_custkey": "Int64"}, "o_orderkey", path=f"{d}/orders.parquet", references=(("o_custkey", "customer", "c_custkey"),))
    return Query(orders).inner_join(customer).select("orders.o_orderkey", "customer.c_name").to_df(spark)


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def cross_join(spark, d):
    return Query(table(spark, d, "region")).cross_join(table(spark, d, "nation")).select("r_name", "n_name").to_df(spark)


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def theta_join(spark, d):
    n = table(spark, d, "nation")
    return n.alias("a").join(n.alias("b"), (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b"))


@query("SELECT r_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def three_way_join(spark, d):
    q = Query(table(spark, d, "orders")).inner_join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).inner_join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).inner_join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return q.group_by("r_name").select("r_name", F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")).to_df(spark)


@query("SELECT vec_id, round(unnest(embedding)::DOUBLE, 6) AS x FROM embeddings")
def array_join(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    return Query(e).array_join("x").select("vec_id", F.round(F.col("x").cast("double"), 6).alias("x")).to_df(spark)


_TAGS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN [] WHEN o_orderkey % 3 = 1 THEN ['a', o_orderstatus] ELSE ['b'] END AS tags FROM orders"


@query(f"SELECT o_orderkey, coalesce(t, '') AS tags FROM ({_TAGS}) o LEFT JOIN LATERAL (SELECT unnest(o.tags) AS t) ON TRUE")
def left_array_join(spark, d):
    k = F.col("o_orderkey") % 3
    o = table(spark, d, "orders").select("o_orderkey", F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("a"), F.col("o_orderstatus"))).otherwise(F.array(F.lit("b"))).alias("tags"))
    return Query(o).left_array_join("tags", default_fill=True).to_df(spark)


@query("SELECT p.event_id, p.user_id, v.event_id AS view_id, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts")
def asof_join(spark, d):
    """The last view of its user before each purchase."""
    e = table(spark, d, "events")
    views = e.filter("event_type = 'view'").select("ts", "user_id", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return relational.asof_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, "ts", ["user_id"], ["view_id", "view_value"]).drop("ts")


@query("SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_totalprice >= 40 * c_acctbal AND o_totalprice < 40 * c_acctbal + 30")
def range_join(spark, d):
    """Orders whose price lies in a customer's range, without comparing all pairs."""
    ranges = table(spark, d, "customer").select("c_custkey", (40 * F.col("c_acctbal")).alias("low"), (40 * F.col("c_acctbal") + 30).alias("high"))
    return relational.range_join(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ranges, "o_totalprice", "low", "high", 30).select("o_orderkey", "c_custkey")


@query("SELECT vec_id, unnest(list_slice(embedding, 1, 64))::DOUBLE > 0 AS positive FROM embeddings")
def array_join_function(spark, d):
    return table(spark, d, "embeddings").select("vec_id", fn.array_join("embedding").alias("x")).select("vec_id", (F.col("x") > 0).alias("positive"))


# --- order and limits


@query("SELECT o_orderkey, p FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders) ORDER BY p DESC NULLS FIRST, o_orderkey ASC")
def sort_nulls(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return Query(o).order_by(F.col("p").desc_nulls_first(), asc("o_orderkey")).to_df(spark)


@query("SELECT o_orderkey, p FROM (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p FROM orders) ORDER BY p ASC NULLS LAST, o_orderkey DESC")
def sort_default(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p"))
    return Query(o).order_by("p", desc("o_orderkey")).to_df(spark)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def limit_offset(spark, d):
    return Query(table(spark, d, "orders")).order_by(desc("o_totalprice"), "o_orderkey").offset(10).limit(20).select("o_orderkey", "o_totalprice").to_df(spark)


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3")
def limit_by(spark, d):
    return Query(table(spark, d, "events")).order_by(desc("value"), "event_id").limit_by(3, "user_id").select("user_id", "event_id", "value").to_df(spark)


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) BETWEEN 3 AND 5")
def limit_offset_by(spark, d):
    return Query(table(spark, d, "events")).order_by(desc("value"), "event_id").limit_offset_by(3, 2, "user_id").select("user_id", "event_id", "value").to_df(spark)


# --- set operations and CTEs


def _two(spark, d):
    o = table(spark, d, "orders")
    return o.filter("o_totalprice > 200000").select(F.col("o_custkey").alias("k")), o.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"))


_A, _B = "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 200000", "SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'"


@query(f"{_A} UNION {_B}")
def union(spark, d):
    return relational.union(*_two(spark, d))


@query(f"{_A} UNION ALL {_B}")
def union_all(spark, d):
    return relational.union_all(*_two(spark, d))


@query(f"{_A} INTERSECT {_B}")
def intersect(spark, d):
    return relational.intersect(*_two(spark, d))


@query(f"{_A} EXCEPT {_B}")
def except_(spark, d):
    return relational.except_(*_two(spark, d))


@query(f"{_A} INTERSECT ALL {_B}")
def intersect_all(spark, d):
    return relational.intersect_all(*_two(spark, d))


@query(f"{_A} EXCEPT ALL {_B}")
def except_all(spark, d):
    return relational.except_all(*_two(spark, d))


@query("SELECT p_partkey, p_size FROM part QUALIFY rank() OVER (ORDER BY p_size DESC) <= 15")
def limit_with_ties(spark, d):
    return modifiers.limit_with_ties(table(spark, d, "part").select("p_partkey", "p_size"), 15, desc("p_size"))


@query(f"SELECT k FROM (({_A}) UNION ({_B})) ORDER BY k LIMIT 10")
def set_order_limit(spark, d):
    return Query(relational.union(*_two(spark, d))).order_by("k").limit(10).to_df(spark)


@query("WITH big AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000) SELECT o_custkey, count(*) AS n FROM big GROUP BY o_custkey")
def cte_single(spark, d):
    big = table(spark, d, "orders").filter("o_totalprice > 300000").select("o_custkey", "o_totalprice")
    return relational.with_queries(spark, "SELECT o_custkey, count(*) AS n FROM big GROUP BY o_custkey", big=big)


@query("WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), b AS (SELECT c_custkey, c_mktsegment FROM customer) SELECT c_mktsegment, sum(n)::BIGINT AS n FROM a JOIN b ON o_custkey = c_custkey GROUP BY c_mktsegment")
def cte_multi(spark, d):
    a = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    b = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return relational.with_queries(spark, "SELECT c_mktsegment, sum(n) AS n FROM a JOIN b ON o_custkey = c_custkey GROUP BY c_mktsegment", a=a, b=b)


@query("WITH a AS (SELECT n_nationkey, n_name, n_regionkey FROM nation), b AS (SELECT * FROM region) SELECT n_name, r_name FROM a, b WHERE n_regionkey = r_regionkey")
def cte_comma_join(spark, d):
    return relational.with_queries(spark, "SELECT n_name, r_name FROM a, b WHERE n_regionkey = r_regionkey", a=table(spark, d, "nation"), b=table(spark, d, "region"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority")
def cte_dynamic(spark, d):
    """As many named queries as a loop makes."""
    o = table(spark, d, "orders")
    parts = {f"p{i}": o.filter((F.col("o_orderkey") % 4 == i) & (F.col("o_totalprice") > 100000)).select("o_orderpriority") for i in range(4)}
    return relational.with_queries(spark, f"SELECT o_orderpriority, count(*) AS n FROM ({' UNION ALL '.join(f'SELECT * FROM {p}' for p in parts)}) GROUP BY o_orderpriority", **parts)


@query("WITH a AS (SELECT n_name FROM nation) SELECT 'from a join {a}' AS x, n_name FROM a")
def cte_literal(spark, d):
    """Literals that look like clauses stay as they are."""
    return relational.with_queries(spark, "SELECT 'from a join {a}' AS x, n_name FROM a", a=table(spark, d, "nation"))


@query("WITH RECURSIVE t(k) AS (SELECT 1 UNION ALL SELECT k + 1 FROM t WHERE k < 50) SELECT k, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM t JOIN lineitem ON l_quantity = k GROUP BY k")
def cte_recursive(spark, d):
    text = "WITH RECURSIVE t(k) AS (SELECT 1 UNION ALL SELECT k + 1 FROM t WHERE k < 50) SELECT k, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM t JOIN li ON l_quantity = k GROUP BY k"
    return relational.with_queries(spark, text, li=table(spark, d, "lineitem"))


@query("SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey ORDER BY q DESC, l_orderkey LIMIT 25")
def top_k_rows(spark, d):
    return Query(table(spark, d, "lineitem")).group_by("l_orderkey").select("l_orderkey", F.sum("l_quantity").alias("q")).order_by(desc("q"), "l_orderkey").limit(25).to_df(spark)


