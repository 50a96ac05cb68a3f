"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Which documents hold at least 80 % of an item's five-word shingles? MinHash signatures of both sides
would drown a short item in a long document, as their Jaccard similarity is near zero. So only the
items are sketched: the ``k`` least hashes of an item's shingles are a uniform sample of its shingles,
and the share of them that a document holds estimates the containment whatever the document's
length. Items are partitioned by size, and each partition has its own k and its own least number of
hits, by which a true containment of the threshold is missed with a chance below ``MISS``. Only the texts of
candidates are read again and verified: the shared distinct shingles of document and item are counted in full.

No table of the items is broadcast: a set of ``HELD`` remainders at most keeps shingles (and then texts) that no
sample has from the shuffles, and joins by the full hashes follow, so the plan is the same for every number of items.

Words are runs of letters and digits in lower case, so that punctuation and line breaks do not matter.
An item of one to four words has one shingle, its whole sequence, which is looked for in the documents at that width.
Items without a word match nothing, nor do null texts; texts may be of any length. Items with equal
shingles stand as one, named by the smallest item_id, and n_items tells their number. Rows with one
doc_id and different texts are judged each, and the row with the largest share is given. Empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work, boxed, held, let, row_key, table, unboxed

WIDTH = 5
THRESHOLD = 0.8
MISS = 1e-6
#: Sizes of the partitions of items (distinct shingles, up to; None: any), and the size of their samples.
PARTITIONS = ((16, 16), (64, 16), (256, 24), (1024, 32), (None, 48))
#: Remainders of hashes that are broadcast at most.
HELD = 1 << 20


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda x: x != "")


def _of_width(w: Column, n: int) -> Column:
    each = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
    return F.when(F.size(w) >= n, each).otherwise(F.array().cast("array<bigint>"))


def shingles(text: Column, short: tuple[int, ...] = ()) -> Column:
    """The 64-bit hashes of the five-word shingles of a text, with repeats; ``short``: and of its shingles of fewer words."""
    return let(_words(text), lambda w: F.concat(*[_of_width(w, n) for n in (WIDTH, *short)]) if short else _of_width(w, WIDTH))


def item_shingles(text: Column) -> Column:
    """The hashes of an item's shingles; one of its whole sequence where it has fewer than five words."""
    whole = lambda w: F.coalesce(*[F.when(F.size(w) == n, F.array(F.xxhash64(*[F.get(w, F.lit(k)) for k in range(n)]))) for n in range(1, WIDTH)], _of_width(w, WIDTH))
    return let(_words(text), whole)


def least_hits(n: int | None, k: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """The most hits of k samples that an item of n shingles (None: any number) with the threshold's containment fails with a chance of ``miss`` at most."""
    if n is None:  # draws from ever more shingles become independent
        chances = [comb(k, hits) * threshold**hits * (1 - threshold) ** (k - hits) for hits in range(k + 1)]
    else:
        k, good = min(n, k), -(-int(1000 * threshold) * n // 1000)
        chances = [comb(good, hits) * comb(n - good, k - hits) / comb(n, k) if k - hits <= n - good else 0.0 for hits in range(k + 1)]
    chance = 0.0
    for hits, part in enumerate(chances):
        chance += part
        if chance > miss:
            return max(1, hits)
    return k


def sketch(items: DataFrame, work: Work) -> tuple[DataFrame, DataFrame, tuple[int, ...]]:
    """All shingles of the items (item, n, n_items, h), the samples (item, least, h) and the widths below five."""
    of = items.select("item_id", F.size(_words(F.col("text"))).alias("w"), F.array_sort(F.array_distinct(item_shingles(F.col("text")))).alias("s")).filter(F.size("s") > 0)
    one = work.write(of.groupBy("s").agg(F.min("item_id").alias("item"), F.count(F.lit(1)).alias("n_items"), F.min("w").alias("w")), "items")
    n, k, least = F.size("s"), None, None
    for size, samples in PARTITIONS:
        fits = F.lit(True) if size is None else n <= size
        k = F.when(fits, samples) if k is None else k.when(fits, samples)
        # within a partition the chance falls as the item grows smaller: its largest size decides
        hit = F.when(n <= samples, F.greatest(F.lit(1), F.ceil(n * THRESHOLD))).otherwise(least_hits(size, samples)).cast("int")
        least = F.when(fits, hit) if least is None else least.when(fits, hit)
    # shingle hashes are uniform already, so the least of a second hash are the sample
    mixed = F.transform(F.array_sort(F.transform("s", lambda h: F.struct(F.xxhash64(h).alias("m"), h.alias("h")))), lambda x: x["h"])
    rows = one.select("item", "n_items", n.alias("n"), F.explode("s").alias("h"))
    sample = one.select("item", least.alias("least"), F.explode(F.slice(mixed, 1, k)).alias("h"))
    short = tuple(sorted(r.w for r in one.filter(F.col("w") < WIDTH).select("w").distinct().collect()))  # four numbers at most
    return work.write(rows, "shingles"), work.write(sample, "sample"), short


def _held(df: DataFrame, column: str) -> DataFrame:
    return F.broadcast(df.select(F.pmod(column, F.lit(HELD)).alias("_held")).distinct())


def pairs(docs: DataFrame, items: DataFrame, work: Work, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row, item, n_shared, n_shingles and n_items of every pair at or above the threshold."""
    rows, sample, short = sketch(items, work)
    keyed = docs.select("doc_id", row_key(docs).alias("row"), "text")
    distinct = F.array_distinct(shingles(F.col("text"), short))
    all_of = keyed.select("row", F.explode(distinct).alias("h"))
    some = all_of.join(_held(sample, "h"), F.pmod("h", F.lit(HELD)) == F.col("_held"), "left_semi")
    hits = some.distinct().join(sample.hint("merge"), "h").groupBy("row", "item").agg(F.count(F.lit(1)).alias("hits"), F.first("least").alias("least"))
    found = work.write(hits.filter("hits >= least").select(F.col("row").alias("_row"), F.col("item").alias("_item")), "candidates")
    # verification, on the whole shingle sets of candidates
    texts = keyed.join(_held(found, "_row.a"), held("row", HELD) == F.col("_held"), "left_semi")
    again = texts.select("doc_id", "row", F.explode(distinct).alias("h")).join(found.hint("merge"), F.col("row") == F.col("_row"))
    again = again.join(rows.hint("merge"), (rows["h"] == again["h"]) & (rows["item"] == again["_item"])).select("doc_id", "row", "item", "n", "n_items", rows["h"]).distinct()
    again = again.groupBy("doc_id", "row", "item").agg(F.count(F.lit(1)).alias("n_shared"), F.first("n").alias("n_shingles"), F.first("n_items").alias("n_items"))
    return again.filter(F.col("n_shared") >= threshold * F.col("n_shingles"))


def contaminated(docs: DataFrame, items: DataFrame, work: Work, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, n_items and containment of every pair at or above the threshold."""
    best = pairs(docs, items, work, threshold).groupBy("doc_id", F.col("item").alias("item_id")).agg(*[F.max(c).cast("long").alias(c) for c in ("n_shared", "n_shingles", "n_items")])
    return best.withColumn("containment", F.round(F.col("n_shared") / F.col("n_shingles"), 6))


def clean(docs: DataFrame, items: DataFrame, work: Work) -> DataFrame:
    """The documents that hold no item; columns as they were."""
    bad = work.write(pairs(docs, items, work).select("row").distinct(), "bad")
    rows = boxed(docs, "doc_id", "text").withColumn("_key", row_key(docs))
    return unboxed(rows.join(bad.hint("merge"), F.col("_key") == F.col("row"), "left_anti"), docs.columns)


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they hold."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Work(spark, "decontamination"))


_WORDS = "SELECT {id} AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}"
_SHINGLES = "list_sort(list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(list_slice(w, i, i + {k} - 1), ' '))))"
SQL = f"""
WITH words AS (SELECT id, w, least(len(w), 5) AS k FROM ({_WORDS.format(id="item_id", table="benchmark")}) WHERE len(w) > 0),
item AS (SELECT min(id) AS item_id, count(*) AS n_items, s FROM (SELECT id, {_SHINGLES.format(k="k")} AS s FROM words) GROUP BY s),
part AS (SELECT item_id, n_items, len(s) AS n_shingles, unnest(s) AS h FROM item),
doc AS (SELECT id AS doc_id, unnest({_SHINGLES.format(k="k")}) AS h FROM ({_WORDS.format(id="doc_id", table="documents")}), (SELECT DISTINCT k FROM words) WHERE len(w) >= k)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, n_shingles::BIGINT AS n_shingles, n_items::BIGINT AS n_items, round(count(*) / n_shingles, 6) AS containment
FROM doc JOIN part USING (h) GROUP BY doc_id, item_id, n_shingles, n_items HAVING count(*) >= {THRESHOLD} * n_shingles
"""
