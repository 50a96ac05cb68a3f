"""Table modifiers: FINAL, SAMPLE, LIMIT BY, DISTINCT ON, WITH TOTALS and ARRAY JOIN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import InvalidQuery
from millrace.sources.tables import SEQUENCE, Engine

TOTAL = "_is_total"


def _cols(c) -> list:
    return [F.col(x) if isinstance(x, str) else x for x in (c if isinstance(c, list | tuple) else [c])]


def _first(df: DataFrame, by: list, order: list, n: int = 1, skip: int = 0) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    kept = df.withColumn("_rank", rank)
    return kept.filter(F.col("_rank") <= n + skip if not skip else (F.col("_rank") > skip) & (F.col("_rank") <= n + skip)).drop("_rank")


def limit_by(df: DataFrame, n: int, by, order, offset: int = 0) -> DataFrame:
    """At most n rows for each value of ``by``, in an order, after the first ``offset``."""
    return _first(df, _cols(by), _cols(order), n, offset)


def distinct_on(df: DataFrame, by, order=None) -> DataFrame:
    """One row for each value of ``by``: the first in the order, or any where there is none."""
    if order is not None:
        return _first(df, _cols(by), _cols(order))
    if all(isinstance(c, str) for c in (by if isinstance(by, list | tuple) else [by])):
        return df.dropDuplicates(list(by) if isinstance(by, list | tuple) else [by])
    return _first(df, _cols(by), [F.lit(1)])


def final(df: DataFrame, engine: Engine, key) -> DataFrame:
    """The rows of a table as its engine merges those of one key.

    Replacing: the row with the largest version. Summing: listed (or all other numeric) columns add
    up. Aggregating: columns merge by the aggregate in their metadata. Collapsing: the last row with
    sign 1 where the signs' sum is positive. Versioned collapsing: the same for each version. Others: all
    rows. Ties go to the row inserted last, where the table has its order of insertion.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [SEQUENCE] if SEQUENCE in df.columns else []
    kind, columns = engine.name, list(engine.columns)
    row = F.struct(*df.columns)
    # the last row by an order; a struct of the keys of the order sorts nulls first, so a version that is null loses
    last = lambda by, when=None: F.max_by(row if when is None else F.when(when, row), F.struct(*by) if when is None else F.when(when, F.struct(*by))) if by else F.any_value(row if when is None else F.when(when, row), F.lit(True))
    if kind == "ReplacingMergeTree":
        return df.groupBy(*key).agg(last([*columns, *order]).alias("_row")).select("_row.*")
    if kind == "SummingMergeTree":
        summed = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in [*key, SEQUENCE]]
        rest = [c for c in df.columns if c not in [*key, *summed]]
        return df.groupBy(*key).agg(*[F.sum(c).alias(c) for c in summed], *[F.any_value(c, F.lit(True)).alias(c) for c in rest]).select(*df.columns)
    if kind == "AggregatingMergeTree":
        return df.groupBy(*key).agg(*[merge(f).alias(f.name) for f in df.schema if f.name not in key]).select(*df.columns)
    if kind in ("CollapsingMergeTree", "VersionedCollapsingMergeTree"):
        sign, by = columns[0], [*key, *columns[1:]]
        # one aggregate: the sum of the signs, and the last row with sign 1
        found = df.groupBy(*by).agg(F.sum(sign).alias("_total"), last(order, F.col(sign) > 0).alias("_row"))
        return found.filter((F.col("_total") > 0) & F.col("_row").isNotNull()).select("_row.*")
    return df


def merge(f: T.StructField) -> Column:
    """The aggregate that merges partial results of a column."""
    how = (f.metadata or {}).get("agg", "any")
    if how == "avg":  # a partial mean is its sum and its count
        if not isinstance(f.dataType, T.StructType):
            raise InvalidQuery(f"{f.name}: a partial avg is a struct of sum and count")
        return F.struct(F.sum(f"{f.name}.sum").alias("sum"), F.sum(f"{f.name}.count").alias("count"))
    found = {
        "sum": F.sum,
        "count": F.sum,
        "min": F.min,
        "max": F.max,
        "any": lambda c: F.any_value(c, F.lit(True)),
        "anyLast": lambda c: F.last(c, ignorenulls=True),
        "groupArray": lambda c: F.flatten(F.collect_list(c)),
        "groupUniqArray": lambda c: F.array_distinct(F.flatten(F.collect_list(c))),
        "uniqCombined": F.hll_union_agg,
    }
    if how not in found:
        raise InvalidQuery(f"{f.name}: no merge for {how}")
    return found[how](F.col(f.name))


def ranked(df: DataFrame, by: str, name: str = "_rank", share: int = 100_000) -> DataFrame:
    """Adds the rank (from 1, ties alike, nulls first) of each row by a number or time over the whole frame.

    A window without a partition would send all rows to one task. Here quantiles part the values into ranges of about
    ``share`` rows; a row's rank is the number of rows in the ranges before, plus its rank within its own.
    Values that are equal share a range, and so one task.
    """
    value = F.col(by)
    place = F.when(value.isNull(), F.lit(None)).otherwise(F.unix_micros(value.cast("timestamp")) if isinstance(df.schema[by].dataType, T.TimestampType | T.TimestampNTZType | T.DateType) else value)
    n = max(1, -(-df.count() // share))
    cuts = df.agg(F.percentile_approx(place, [k / n for k in range(1, n)], 10 * n)).first()[0] or [] if n > 1 else []
    cuts = sorted(set(cuts))  # one less than the ranges
    # the range of a value by halving, so that a row costs the logarithm of their number
    def find(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(place > F.lit(cuts[mid]), find(mid + 1, hi)).otherwise(find(lo, mid))

    parted = df.withColumn("_part", F.when(value.isNull(), F.lit(-1)).otherwise(find(0, len(cuts))))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.rank().over(Window.partitionBy("_part").orderBy(by)) + F.col("_before")
    return parted.join(F.broadcast(before), "_part").withColumn(name, rank.cast("bigint")).drop("_part", "_before")


def limit_with_ties(df: DataFrame, n: int, order) -> DataFrame:
    """The first n rows of an order, and all that tie with the last of them."""
    order = _cols(order)
    if n <= 0:
        return df.limit(0)
    top = df.orderBy(*order).limit(n)
    # n rows at most stand in the one window; what ties with the last of them comes by a semi join on its keys
    keys = [_bare(c) for c in order]
    numbered = top.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.row_number().over(Window.orderBy(*order)).alias("_r"))
    last = numbered.agg(F.max_by(F.struct(*[f"_{i}" for i in range(len(keys))]), "_r").alias("_last")).select("_last.*")
    before = F.lit(False)
    same = F.lit(True)
    for i, (k, c) in enumerate(zip(keys, order)):
        down, nulls_first = "DESC" in str(c), "NULLS FIRST" in str(c)
        mine, theirs = F.col(k), F.col(f"_{i}")
        less = (mine > theirs) if down else (mine < theirs)
        less = F.coalesce(less, F.when(mine.isNull() & theirs.isNotNull(), F.lit(nulls_first)).when(mine.isNotNull() & theirs.isNull(), F.lit(not nulls_first)), F.lit(False))
        before |= same & less
        same &= mine.eqNullSafe(theirs)
    return df.crossJoin(F.broadcast(last)).filter(before | same).select(*df.columns).orderBy(*order)


def _bare(c: Column) -> str:
    """The name of a sort key's column."""
    import re

    m = re.fullmatch(r"Column<'(.+?)( (?:ASC|DESC) NULLS (?:FIRST|LAST))?'>", str(c))
    if not m:
        raise InvalidQuery("ties need named columns to sort by")
    return m[1].strip("`")


def sample(df: DataFrame, rate: float, key, offset: float = 0.0) -> DataFrame:
    """Rows whose key's hash falls in [offset, offset + rate) of its range: the same wherever they lie."""
    if not 0 <= offset <= 1 or not 0 <= rate <= 1:
        raise InvalidQuery("rate and offset lie between 0 and 1")
    place = F.pmod(F.xxhash64(*_cols(key)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    return df.filter((place >= offset) & (place < offset + rate))


def with_totals(df: DataFrame, keys: list[str], aggregates: list[Column], having: Column | None = None) -> DataFrame:
    """Groups, and one more row with ``_is_total`` for all rows; HAVING leaves that row alone."""
    keys = list(keys)
    out = df.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys]).agg(*aggregates, (F.grouping_id() > 0).alias(TOTAL))
    return out if having is None else out.filter(F.col(TOTAL) | having)


def array_join(df: DataFrame, arrays, left: bool = False, default_fill: bool = False) -> DataFrame:
    """A row for each element in place of the array. Several arrays go side by side and must be of one length.

    ``left`` keeps rows with empty or null arrays, with null or, where ``default_fill``, the type's default.
    """
    arrays = [arrays] if isinstance(arrays, str) else list(arrays)
    if len(arrays) == 1:
        out = df.withColumn(arrays[0], (F.explode_outer if left else F.explode)(arrays[0]))
    else:
        sizes = [F.coalesce(F.size(a), F.lit(0)) for a in arrays]
        same = sizes[0] == sizes[1]
        for s in sizes[2:]:
            same &= sizes[0] == s
        zipped = F.when(same, F.arrays_zip(*arrays)).otherwise(F.raise_error(F.lit("arrays of different lengths")))
        out = df.withColumn("_zip", (F.explode_outer if left else F.explode)(zipped))
        out = out.select(*[F.col(f"_zip.{c}").alias(c) if c in arrays else F.col(c) for c in df.columns])
    if left and default_fill:
        for a in arrays:
            kind = out.schema[a].dataType
            if isinstance(kind, T.NumericType | T.StringType):
                out = out.withColumn(a, F.coalesce(a, F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)))
    return out


def default_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type defaults in place of the nulls that an outer join made."""
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            df = df.withColumn(c, F.coalesce(c, F.lit("")))
        elif isinstance(kind, T.NumericType):
            df = df.withColumn(c, F.coalesce(c, F.lit(0).cast(kind)))
    return df
