"""Aggregates, windows and the recipes made of them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import functions as fn
from millrace.operators import modifiers
from millrace.plans.catalogue import query, table
from millrace.plans.query import Query, desc


@query("SELECT event_type, count(*) AS n, count(nullif(user_id, 3)) AS n_users, round(sum(value), 2) AS total, round(avg(value), 4) AS mean, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type")
def group_basic(spark, d):
    q = Query(table(spark, d, "events")).group_by("event_type")
    return q.select("event_type", fn.count_star().alias("n"), fn.count(F.nullif("user_id", F.lit(3))).alias("n_users"), F.round(fn.sum_("value"), 2).alias("total"), F.round(fn.avg("value"), 4).alias("mean"), fn.min_("value").alias("lo"), fn.max_("value").alias("hi")).to_df(spark)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING n > 5")
def having_alias(spark, d):
    return Query(table(spark, d, "events")).group_by("user_id").select("user_id", fn.count_star().alias("n")).having(F.col("n") > 5).to_df(spark)


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, grouping(event_type) > 0 AS _is_total FROM events GROUP BY GROUPING SETS ((event_type), ())")
def with_totals(spark, d):
    return Query(table(spark, d, "events")).group_by("event_type").with_totals().select("event_type", fn.count_star().alias("n"), fn.uniq_exact("user_id").alias("users")).to_df(spark)


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def uniq_exact(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(fn.uniq_exact("user_id").alias("users"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS near FROM events GROUP BY event_type")
def uniq(spark, d):
    """Approximate numbers of distinct users lie within 10 % of the exact one, which comes with them."""
    near = lambda a: F.abs(a - fn.uniq_exact("user_id")) <= 0.1 * fn.uniq_exact("user_id")
    return table(spark, d, "events").groupBy("event_type").agg(fn.uniq_exact("user_id").alias("users"), (near(fn.uniq("user_id")) & near(fn.uniq_combined("user_id"))).alias("near"))


@query("SELECT event_type, round(quantile_cont(value, 0.9), 6) AS q90, round(quantile_cont(value, 0.5), 6) AS med FROM events GROUP BY event_type")
def quantile(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(fn.quantile_exact(0.9, "value"), 6).alias("q90"), F.round(fn.median_exact("value"), 6).alias("med"))


@query("SELECT event_type, quantile_disc(value, 0.9) AS q90, quantile_disc(value, 0.5) AS med FROM events GROUP BY event_type")
def quantile_tdigest(spark, d):
    """The sketch's quantiles; up to its accuracy in rows a group, they are the exact ones."""
    return table(spark, d, "events").groupBy("event_type").agg(fn.quantile_tdigest(0.9, "value", 1_000_000).alias("q90"), fn.quantile(0.5, "value", 1_000_000).alias("med"))


@query("SELECT user_id, arg_max(event_type, event_id) AS last_type, arg_min(value, event_id) AS first_value, round(sum(value * event_id) / sum(event_id), 6) AS weighted FROM events GROUP BY user_id")
def arg_max_min(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(fn.arg_max("event_type", "event_id").alias("last_type"), fn.arg_min("value", "event_id").alias("first_value"), F.round(fn.avg_weighted("value", "event_id"), 6).alias("weighted"))


@query("SELECT event_type, upper(event_type) AS found, arg_max(user_id, event_id) AS last FROM events GROUP BY event_type")
def any_last(spark, d):
    """Any value of what is the same throughout a group, nulls left out, is that."""
    e = table(spark, d, "events")
    loud = F.when(F.col("event_id") % 2 == 0, F.upper("event_type"))
    return e.groupBy("event_type").agg(fn.any_(loud).alias("found"), fn.any_last("user_id", "event_id").alias("last"))


@query("SELECT event_type, array_to_string(list_sort(list(user_id)), ',') AS users, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS distinct_users FROM events GROUP BY event_type")
def group_array(spark, d):
    text = lambda c: F.array_join(F.transform(F.sort_array(c), lambda x: x.cast("string")), ",")
    return table(spark, d, "events").groupBy("event_type").agg(text(fn.group_array("user_id")).alias("users"), text(fn.group_uniq_array("user_id")).alias("distinct_users"))


@query("SELECT user_id, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ORDER BY n DESC, user_id LIMIT 10")
def top_k(spark, d):
    return Query(table(spark, d, "events")).group_by("user_id").select("user_id", fn.count_star().alias("n")).order_by(desc("n"), "user_id").limit(10).to_df(spark)


@query("SELECT event_type AS item FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3")
def top_k_sketch(spark, d):
    return table(spark, d, "events").agg(fn.top_k(3, "event_type").alias("items")).select(F.explode("items").alias("item"))


@query("SELECT user_id, event_type, count(*) AS n, sum(DISTINCT event_id % 7)::BIGINT AS s FROM events GROUP BY ROLLUP (user_id, event_type)")
def rollup(spark, d):
    return table(spark, d, "events").rollup("user_id", "event_type").agg(fn.count_star().alias("n"), fn.sum_distinct(F.col("event_id") % 7).alias("s"))


@query("SELECT count(*) AS n, max(value) AS hi FROM events GROUP BY event_type")
def group_select_only(spark, d):
    """Keys that are not selected are not in the result."""
    return Query(table(spark, d, "events")).group_by("event_type").select(fn.count_star().alias("n"), fn.max_("value").alias("hi")).to_df(spark)


@query("SELECT n, event_type, _is_total FROM (SELECT count(*) AS n, event_type, FALSE AS _is_total FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 2) UNION ALL SELECT count(*), NULL, TRUE FROM events")
def totals_limit(spark, d):
    """LIMIT cuts the groups and leaves the row of all rows."""
    return Query(table(spark, d, "events")).group_by("event_type").with_totals().select(fn.count_star().alias("n"), "event_type").order_by(desc("n"), "event_type").limit(2).to_df(spark)


@query("SELECT s % 3 AS g, (((sum(x) % 18446744073709551616 + 18446744073709551616) % 18446744073709551616 + 9223372036854775808) % 18446744073709551616 - 9223372036854775808)::BIGINT AS wrapped FROM (SELECT event_id AS s, (event_id + 1)::HUGEINT * 9000000000000000 AS x FROM events) GROUP BY s % 3")
def sum_with_overflow(spark, d):
    e = table(spark, d, "events").select((F.col("event_id") % 3).alias("g"), ((F.col("event_id") + 1) * F.lit(9000000000000000).cast("decimal(20,0)")).cast("decimal(38,0)").alias("x"))
    return e.groupBy("g").agg(fn.sum_with_overflow("x").alias("wrapped"))


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 2) AS spent FROM events GROUP BY user_id")
def if_combinators(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(fn.count_if(F.col("event_type") == "click").alias("clicks"), F.round(F.coalesce(fn.sum_if("value", F.col("event_type") == "purchase"), F.lit(0.0)), 2).alias("spent"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("q"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 4) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    r = lambda c, n=2: F.round(c, n)
    return li.groupBy("l_returnflag", "l_linestatus").agg(r(F.sum("l_quantity")).alias("sum_qty"), r(F.sum("l_extendedprice")).alias("sum_base"), r(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("sum_disc"), r(F.avg("l_quantity"), 4).alias("avg_qty"), F.count(F.lit(1)).alias("n"))


# --- windows



def _by():
    return W.partitionBy("user_id").orderBy("event_id")


_IN = "OVER (PARTITION BY user_id ORDER BY event_id)"


@query(f"SELECT event_id, row_number() {_IN} AS rn, rank() OVER (PARTITION BY user_id ORDER BY event_type) AS rk, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS dr, ntile(4) {_IN} AS nt FROM events")
def win_rank(spark, d):
    by_type = W.partitionBy("user_id").orderBy("event_type")
    big = lambda c: c.cast("bigint")
    return table(spark, d, "events").select("event_id", big(F.row_number().over(_by())).alias("rn"), big(F.rank().over(by_type)).alias("rk"), big(F.dense_rank().over(by_type)).alias("dr"), big(F.ntile(4).over(_by())).alias("nt"))


@query(f"SELECT event_id, lag(value, 1, -1) {_IN} AS before, lead(value, 2, -1) {_IN} AS after FROM events")
def win_lag_lead(spark, d):
    return table(spark, d, "events").select("event_id", F.lag("value", 1, -1.0).over(_by()).alias("before"), F.lead("value", 2, -1.0).over(_by()).alias("after"))


@query(f"SELECT event_id, first_value(value) {_IN} AS f, last_value(value) {_IN} AS l, nth_value(value, 3) {_IN} AS n3 FROM events")
def win_first_last_nth(spark, d):
    return table(spark, d, "events").select("event_id", F.first_value("value").over(_by()).alias("f"), F.last_value("value").over(_by()).alias("l"), F.nth_value("value", 3).over(_by()).alias("n3"))


@query("SELECT event_id, round(sum(value) OVER w, 4) AS s, round(avg(value) OVER w, 4) AS a, count(value) OVER w AS c, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING)")
def win_agg_frames(spark, d):
    w = _by().rowsBetween(-3, 1)
    return table(spark, d, "events").select("event_id", F.round(F.sum("value").over(w), 4).alias("s"), F.round(F.avg("value").over(w), 4).alias("a"), F.count("value").over(w).alias("c"), F.min("value").over(w).alias("lo"), F.max("value").over(w).alias("hi"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 200 PRECEDING AND CURRENT ROW) AS near, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS so_far, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS to_come FROM events")
def win_range(spark, d):
    w = _by()
    n = F.count(F.lit(1))
    return table(spark, d, "events").select("event_id", n.over(w.rangeBetween(-200, 0)).alias("near"), n.over(w.rowsBetween(W.unboundedPreceding, 0)).alias("so_far"), n.over(w.rowsBetween(0, W.unboundedFollowing)).alias("to_come"))


@query("SELECT event_id, event_type, round(100 * value / sum(value) OVER (PARTITION BY event_type), 6) AS share FROM events")
def win_share(spark, d):
    # a few types hold all rows: their sums are made before the shuffle and joined back, where a window would sort each type in one task
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    sums = e.groupBy(F.col("event_type").alias("of_type")).agg(F.sum("value").alias("total"))
    return e.join(sums, F.col("event_type").eqNullSafe(F.col("of_type"))).select("event_id", "event_type", F.round(100 * F.col("value") / F.col("total"), 6).alias("share"))


@query("SELECT event_id, round(percent_rank() OVER (ORDER BY event_id), 6) AS pr, round(cume_dist() OVER (PARTITION BY user_id ORDER BY event_id), 6) AS cd FROM events")
def win_percent_rank(spark, d):
    """The first has no partition: ranks come from ranges of the values, so that no task sees all rows."""
    e = modifiers.ranked(table(spark, d, "events").select("event_id", "user_id"), "event_id")
    n = e.agg(F.count(F.lit(1)).alias("n")).scalar()
    return e.select("event_id", F.round((F.col("_rank") - 1) / (n - 1), 6).alias("pr"), F.round(F.cume_dist().over(_by()), 6).alias("cd"))


# --- recipes


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY 1, 2")
def hourly_timeseries(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("SELECT count(*) FILTER (v > 0) AS viewed, count(*) FILTER (v > 0 AND c > 0) AS clicked, count(*) FILTER (v > 0 AND c > 0 AND p > 0) AS bought FROM (SELECT user_id, count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'purchase') AS p FROM events GROUP BY user_id)")
def funnel(spark, d):
    n = lambda t: F.count_if(F.col("event_type") == t)
    u = table(spark, d, "events").groupBy("user_id").agg(n("view").alias("v"), n("click").alias("c"), n("purchase").alias("p"))
    v, c, p = (F.col(x) > 0 for x in "vcp")
    return u.agg(F.count_if(v).alias("viewed"), F.count_if(v & c).alias("clicked"), F.count_if(v & c & p).alias("bought"))


@query("SELECT event_type, n, round(100.0 * n / sum(n) OVER (), 4) AS pct FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)")
def topn_percentage(spark, d):
    e = table(spark, d, "events")
    total = e.agg(F.count(F.lit(1)).alias("total"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).select("event_type", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


@query("SELECT user_id, max(ts) AS ts, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_event(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_type", "event_id").alias("event_type"))


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3")
def tumbling_window(spark, d):
    from millrace.streaming import events

    return events.tumbling(table(spark, d, "events"), "ts", "1 day", [F.count(F.lit(1)).alias("n")], ["event_type"])
