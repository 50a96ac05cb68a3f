"""Functions of the engine: Columns to Columns, named as users of the dialect know them.

Result types are explicit, so that a query gives the same types wherever it runs: counts, ranks and
lengths are bigint, ``avg`` is double, ``floor`` and ``ceil`` keep the type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .aggregates import *  # noqa: F403
from .conditionals import case, case_when, if_, multi_if  # noqa: F401
from .hashes import city_hash_64, xx_hash_64  # noqa: F401

UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def now() -> Column:
    return F.localtimestamp()


def today() -> Column:
    return F.current_date()


def array_length(a) -> Column:
    """Elements of an array, null for null."""
    return F.when(col(a).isNotNull(), F.size(col(a))).cast("bigint")


def array_join(a) -> Column:
    """One row for each element."""
    return F.explode(col(a))


def has(a, e) -> Column:
    """Whether an array holds a value; false rather than null."""
    return F.coalesce(F.array_contains(col(a), e), F.lit(False))


def array_concat(*arrays) -> Column:
    return F.concat(*map(col, arrays))


def lower(s) -> Column:
    return F.lower(col(s))


def upper(s) -> Column:
    return F.upper(col(s))


def length(s, unit: str = "characters") -> Column:
    return (F.octet_length(col(s)) if unit == "bytes" else F.char_length(col(s))).cast("bigint")


def to_string(x) -> Column:
    return col(x).cast("string")


def concat(*parts) -> Column:
    return F.concat(*map(col, parts))


def substring(s, offset: int, length: int | None = None) -> Column:
    """From a 1-based offset; negative offsets count from the end."""
    return F.substring(col(s), offset, 2147483647 if length is None else length)


def to_date(x) -> Column:
    return col(x).cast("date")


def to_date_time(x) -> Column:
    """To whole seconds, without a time zone."""
    return F.date_trunc("second", col(x).cast("timestamp_ntz")).cast("timestamp_ntz")


def to_year(x) -> Column:
    return F.year(col(x)).cast("int")


def to_month(x) -> Column:
    return F.month(col(x)).cast("int")


def to_day_of_week(x) -> Column:
    """Monday is 1."""
    return (F.weekday(col(x)) + 1).cast("int")


def to_hour(x) -> Column:
    return F.hour(col(x)).cast("int")


def date_diff(unit: str, a, b) -> Column:
    """Boundaries of the unit between two times, negative where b is before a."""
    a, b = col(a), col(b)
    if unit == "day":
        return F.datediff(b.cast("date"), a.cast("date")).cast("bigint")
    if unit in ("month", "quarter", "year"):
        part = {"month": (12, F.month), "quarter": (4, F.quarter), "year": (1, lambda x: F.lit(0))}[unit]
        place = lambda x: F.year(x) * part[0] + part[1](x)
        return (place(b) - place(a)).cast("bigint")
    if unit == "week":
        monday = lambda x: F.date_sub(x.cast("date"), F.weekday(x))
        return F.floor(F.datediff(monday(b), monday(a)) / 7).cast("bigint")
    if unit in ("second", "minute", "hour"):
        size = {"second": 1, "minute": 60, "hour": 3600}[unit]
        place = lambda x: F.floor(F.unix_seconds(x.cast("timestamp")) / size)
        return (place(b) - place(a)).cast("bigint")
    raise ValueError(f"unit must be one of {UNITS}")


def abs_(x) -> Column:
    return F.abs(col(x))


def _whole(x: Column) -> Column:
    """Without the fraction, in the same type; beyond 2 ** 52 no double has one, nor have infinities and NaN."""
    far = F.lit(float(1 << 52))
    return x - F.when((x < far) & (x > -far), x % F.lit(1).cast("tinyint")).otherwise(F.lit(0).cast("tinyint"))


def floor(x, kind: str | None = None) -> Column:
    """Rounds down and keeps the type, or gives the one that is named."""
    x, one = col(x), F.lit(1).cast("tinyint")
    whole = _whole(x)
    out = F.when(whole > x, whole - one).otherwise(whole)
    return out if kind is None else out.cast(kind)


def ceil(x, kind: str | None = None) -> Column:
    """Rounds up and keeps the type, or gives the one that is named."""
    x, one = col(x), F.lit(1).cast("tinyint")
    whole = _whole(x)
    out = F.when(whole < x, whole + one).otherwise(whole)
    return out if kind is None else out.cast(kind)


def round_(x, precision: int = 0, ties: str = "away") -> Column:
    """Ties go away from zero, or to the even neighbour."""
    return F.bround(col(x), precision) if ties == "even" else F.round(col(x), precision)


def coalesce(*values) -> Column:
    return F.coalesce(*map(col, values))
