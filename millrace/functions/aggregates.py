"""Aggregates; each may stand over a window as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["any_", "any_last", "arg_max", "arg_min", "avg", "avg_weighted", "count", "count_if", "count_star", "group_array", "group_uniq_array", "max_", "median", "median_exact", "min_", "quantile", "quantile_exact", "quantile_tdigest", "sum_", "sum_distinct", "sum_if", "sum_with_overflow", "top_k", "uniq", "uniq_combined", "uniq_exact"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_star() -> Column:
    return F.count(F.lit(1))


def count(e) -> Column:
    return F.count(_col(e))


def sum_(e) -> Column:
    return F.sum(_col(e))


def avg(e) -> Column:
    return F.avg(_col(e).cast("double"))


def min_(e) -> Column:
    return F.min(_col(e))


def max_(e) -> Column:
    return F.max(_col(e))


def any_(e) -> Column:
    """A value of the group that is not null."""
    return F.any_value(_col(e), F.lit(True))


def any_last(e, order=None) -> Column:
    """The last value met; by an order where one is given."""
    return F.last(_col(e), ignorenulls=True) if order is None else F.max_by(_col(e), _col(order))


def sum_with_overflow(e, bits: int = 64) -> Column:
    """The sum of signed integers modulo 2**bits."""
    if bits not in (8, 16, 32, 64):
        raise ValueError("bits must be 8, 16, 32 or 64")
    size = F.lit(str(1 << bits)).cast("decimal(38,0)")
    wrapped = F.pmod(F.sum(_col(e).cast("decimal(28,0)")).cast("decimal(38,0)"), size)
    signed = F.when(wrapped >= F.lit(str(1 << bits - 1)).cast("decimal(38,0)"), wrapped - size).otherwise(wrapped)
    return signed.cast({8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}[bits])


def uniq(e, rsd: float = 0.05) -> Column:
    """Approximate number of distinct values."""
    return F.approx_count_distinct(_col(e), rsd)


def uniq_exact(*e) -> Column:
    return F.count_distinct(*map(_col, e))


def uniq_combined(e, precision: int = 14) -> Column:
    """Approximate number of distinct values, from a sketch that can be stored and merged."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(_col(e), precision)), F.lit(0))


def group_array(e, limit: int | None = None) -> Column:
    found = F.collect_list(_col(e))
    return found if limit is None else F.slice(found, 1, limit)


def group_uniq_array(e) -> Column:
    return F.collect_set(_col(e))


def arg_max(value, key) -> Column:
    return F.max_by(_col(value), _col(key))


def arg_min(value, key) -> Column:
    return F.min_by(_col(value), _col(key))


def avg_weighted(value, weight) -> Column:
    """Sum of value times weight over the sum of weights; rows with a null in either do not count."""
    v, w = _col(value).cast("double"), _col(weight).cast("double")
    both = v.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, v * w)), F.sum(F.when(both, w)))


def quantile(level: float, e, accuracy: int = 10000) -> Column:
    """Approximate, from a mergeable sketch of bounded size (ranks to 1 in ``accuracy``); a value that occurs."""
    return F.percentile_approx(_col(e), level, accuracy).cast("double")


def quantile_exact(level: float, e) -> Column:
    """Exact, between neighbours where the level falls between two values; holds a group's distinct values in memory."""
    return F.percentile(_col(e), F.lit(level))


def median(e) -> Column:
    return quantile(0.5, e)


def median_exact(e) -> Column:
    return quantile_exact(0.5, e)


#: The t-digest's place is taken by the same sketch: mergeable, of bounded size, exact in rank to 1 in 10,000.
quantile_tdigest = quantile


def sum_distinct(e) -> Column:
    return F.sum_distinct(_col(e))


def top_k(k: int, e) -> Column:
    """The k most frequent values, from a sketch of fixed size."""
    return F.transform(F.call_function("approx_top_k", _col(e), F.lit(k)), lambda x: x["item"])


def count_if(condition) -> Column:
    return F.count_if(condition)


def sum_if(e, condition) -> Column:
    return F.sum(F.when(condition, _col(e)))
