"""The registered queries of the engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_FOUND: dict[str, tuple[Query, str | None]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle SQL where there is one."""

    def add(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return add


@query(
    """SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total_spent
    FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'
    GROUP BY c_custkey, c_name ORDER BY round(sum(o_totalprice), 2) DESC, c_custkey LIMIT 10"""
)
def join_agg_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return (
        customer.join(orders, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_custkey", "c_name")
        .agg(F.count("o_orderkey").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "c_custkey")
        .limit(10)
    )


def queries() -> dict[str, Query]:
    from millrace.plans import aggregation, modifying, relational, scalar, stored  # noqa: F401  they register theirs

    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: sql for name, (_, sql) in _FOUND.items() if sql is not None}
