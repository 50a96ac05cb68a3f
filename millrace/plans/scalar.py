"""Scalar functions and conditionals."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.plans.catalogue import query, table
from millrace.plans.query import Query


@query("SELECT p_partkey, lower(p_brand) AS lo, upper(p_name) AS up, length(p_name) AS n, p_partkey::VARCHAR AS s, concat(p_brand, p_type) AS c, substr(p_name, 3) AS tail, substr(p_name, 2, 4) AS mid FROM part")
def str_fns(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.lower("p_brand").alias("lo"), fn.upper("p_name").alias("up"), fn.length("p_name").alias("n"), fn.to_string("p_partkey").alias("s"), fn.concat("p_brand", "p_type").alias("c"), fn.substring("p_name", 3).alias("tail"), fn.substring("p_name", 2, 4).alias("mid"))


@query("SELECT doc_id, length(text) AS chars, strlen(text) AS bytes FROM documents")
def length_units(spark, d):
    return table(spark, d, "documents").select("doc_id", fn.length("text").alias("chars"), fn.length("text", "bytes").alias("bytes"))


@query("SELECT event_id, ts::DATE::VARCHAR AS d, date_trunc('second', ts) AS t, year(ts)::INT AS y, month(ts)::INT AS m, isodow(ts)::INT AS w, hour(ts)::INT AS h FROM events")
def date_fns(spark, d):
    return table(spark, d, "events").select("event_id", fn.to_string(fn.to_date("ts")).alias("d"), fn.to_date_time("ts").alias("t"), fn.to_year("ts").alias("y"), fn.to_month("ts").alias("m"), fn.to_day_of_week("ts").alias("w"), fn.to_hour("ts").alias("h"))


@query("SELECT event_id, date_diff('second', a, ts) AS s, date_diff('minute', a, ts) AS mi, date_diff('hour', a, ts) AS h, date_diff('day', a, ts) AS da, (date_diff('day', date_trunc('week', a), date_trunc('week', ts)) / 7)::BIGINT AS w, date_diff('month', a, ts) AS mo, date_diff('quarter', a, ts) AS q, date_diff('year', a, ts) AS y FROM (SELECT event_id, ts, TIMESTAMP '2023-11-05 22:30:00' AS a FROM events)")
def date_diff(spark, d):
    a = F.lit("2023-11-05 22:30:00").cast("timestamp_ntz")
    names = {"second": "s", "minute": "mi", "hour": "h", "day": "da", "week": "w", "month": "mo", "quarter": "q", "year": "y"}
    return table(spark, d, "events").select("event_id", *[fn.date_diff(u, a, "ts").alias(n) for u, n in names.items()])


@query("SELECT c_custkey, abs(c_acctbal) AS a, floor(c_acctbal) AS f, ceil(c_acctbal) AS c, round(c_acctbal) AS r, round(c_acctbal, 1) AS r1 FROM customer")
def math_fns(spark, d):
    return table(spark, d, "customer").select("c_custkey", fn.abs_("c_acctbal").alias("a"), fn.floor("c_acctbal").alias("f"), fn.ceil("c_acctbal").alias("c"), fn.round_("c_acctbal").alias("r"), fn.round_("c_acctbal", 1).alias("r1"))


@query("SELECT vec_id, len(embedding) AS n, list_contains([1, NULL, label], 3) AS has3, array_to_string([label, 1] || [2], ',') AS joined FROM embeddings")
def array_fns(spark, d):
    label = F.col("label")
    return table(spark, d, "embeddings").select("vec_id", fn.array_length("embedding").alias("n"), fn.has(F.array(F.lit(1), F.lit(None).cast("int"), label), 3).alias("has3"), F.array_join(F.transform(fn.array_concat(F.array(label, F.lit(1)), F.array(F.lit(2))), lambda x: x.cast("string")), ",").alias("joined"))


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), o_orderpriority) AS c FROM orders")
def coalesce(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.coalesce(F.nullif("o_orderstatus", F.lit("F")), "o_orderpriority").alias("c"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'small' END AS size, CASE WHEN o_totalprice > 300000 THEN 1 END AS flag FROM orders")
def case_searched(spark, d):
    p = F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", fn.case_when(p > 300000).then("big").when(p > 100000).then("mid").else_("small").alias("size"), fn.case_when(p > 300000).then(1).end.alias("flag"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS s FROM orders")
def case_simple(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.case("o_orderstatus").when("F").then("done").when("O").then("open").else_("other").alias("s"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS i, CASE WHEN l_discount > 0.08 THEN 'a' WHEN l_discount > 0.04 THEN 'b' ELSE 'c' END AS m FROM lineitem")
def if_multi_if(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fn.if_(c("l_quantity") > 25, 1, 0).alias("i"), fn.multi_if().when(c("l_discount") > 0.08).then("a").when(c("l_discount") > 0.04).then("b").else_("c").alias("m"))


# The hashes of the event types.
_HASHES = """('click', 15751250262173166970, 11411230916889287844, 7851395633440214954), ('error', 15735312805353345849, 15488826717309542915, 6881330540950751673), ('purchase', 12569234202965095745, 10271315167667621807, 7798363455734685992), ('signup', 12260798663447055749, 17202937401691715430, 18128963616329492549), ('view', 8207258920196207762, 8974016132366822871, 4012769036056163235)"""


@query(f"SELECT event_id, city::VARCHAR AS city, xx::VARCHAR AS xx, xx42::VARCHAR AS xx42 FROM events JOIN (VALUES {_HASHES}) AS h(t, city, xx, xx42) ON event_type = t")
def hashes(spark, d):
    """CityHash64 and XXH64; held against published and independent values in the tests as well."""
    return Query(table(spark, d, "events")).select("event_id", *[fn.to_string(h).alias(n) for n, h in (("city", fn.city_hash_64("event_type")), ("xx", fn.xx_hash_64("event_type")), ("xx42", fn.xx_hash_64("event_type", 42)))]).to_df(spark)


@query("SELECT event_type, count(*) FILTER (ts <= current_localtimestamp()) AS past, count(*) FILTER (ts::DATE < today()) AS days_ago FROM events GROUP BY event_type")
def clocks(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(fn.count_if(F.col("ts") <= fn.now()).alias("past"), fn.count_if(fn.to_date("ts") < fn.today()).alias("days_ago"))


@query("SELECT p_partkey, regexp_replace(p_name, '[0-9]+', '#', 'g') AS r, trim('  ' || p_brand || ' ') AS t, string_split(p_type, ' ')[1] AS first, to_base64(p_brand::BLOB) AS b, replace(p_name, 'a', '') AS x, round(sqrt(p_retailprice), 6) AS q, round(ln(p_retailprice), 6) AS l FROM part")
def text_and_math(spark, d):
    c = F.col
    part = table(spark, d, "part")
    return part.select("p_partkey", F.regexp_replace("p_name", "[0-9]+", "#").alias("r"), F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("t"), F.split("p_type", " ")[0].alias("first"), F.base64(c("p_brand").cast("binary")).alias("b"), F.replace("p_name", F.lit("a"), F.lit("")).alias("x"), F.round(F.sqrt("p_retailprice"), 6).alias("q"), F.round(F.ln("p_retailprice"), 6).alias("l"))


@query("SELECT o_orderkey, (o_orderdate + INTERVAL 1 MONTH) AS later, date_trunc('month', o_orderdate) AS month, last_day(o_orderdate)::VARCHAR AS last FROM orders")
def intervals(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 1 MONTH")).cast("timestamp_ntz").alias("later"), F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"), F.last_day("o_orderdate").cast("string").alias("last"))


@query("SELECT user_id, cardinality(m)::BIGINT AS n, array_to_string(list_sort(map_keys(m)), ',') AS types, coalesce(m['click'], 0) AS clicks FROM (SELECT user_id, map_from_entries(list((event_type, n))) AS m FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id)")
def map_fns(spark, d):
    by = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = by.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return m.select("user_id", F.size("m").cast("bigint").alias("n"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("types"), F.coalesce(F.element_at("m", "click"), F.lit(0)).alias("clicks"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, json_type(props, '$.k') IS NULL AS none FROM events")
def json_typed(spark, d):
    """JSON read as a variant, and a path of it as a type."""
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.k", "string").isNull().alias("none"))
