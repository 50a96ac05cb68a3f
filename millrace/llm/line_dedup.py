"""Line dedup by content-defined chunks of lines.

Every line is hashed; a rolling hash over ``SPAN`` line hashes ends a chunk where it falls into one of
``1/RATE`` of its values, so inserted or removed lines shift only boundaries near them; a chunk has ``LEAST_LINES`` lines at least. A
chunk that occurs again anywhere is removed; the first occurrence, by doc_id and place, stays. Rows
are matched by a 64-bit hash first, and a chunk goes only if its bytes equal those of the one
that stays. With it go the lines before and after, as far as they equal those beside the one that stays.

Lines end at ``\\n``; white space counts. Chunks that have no word are never removed. A text all of
whose chunks are removed becomes empty, and stays as a row. Null texts stay null. Rows with equal
doc_id and text count as one, and both keep their text; a null doc_id comes before others. An
empty table gives no rows; extra columns are kept as they are, but for n_chars, which follows the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Work, boxed, held, let, row_key, table, unboxed

SPAN = 2
RATE = 3
LEAST_LINES = 2
#: Row keys, cut to so many values, that are broadcast at most.
HELD = 1 << 20


def spans(text: Column) -> Column:
    """The chunks of a text, in order: ``a``, the number of lines before, and the array of lines. All but the last have ``LEAST_LINES`` or more."""
    lines = F.split(text, "\n", -1)

    def cut(lines):
        hashes = F.transform(lines, lambda x: F.xxhash64(x))

        def ends(h):
            n = F.size(h)
            # the rolling hash of the lines up to i decides whether a chunk may end after line i
            inner = F.filter(F.sequence(F.lit(1), n), lambda i: (i >= SPAN) & (F.pmod(F.xxhash64(*[F.get(h, i - 1 - k) for k in range(SPAN)]), F.lit(RATE)) == 0))
            # and it does where the chunk has its least length
            some = F.aggregate(inner, F.array().cast("array<int>"), lambda e, i: F.when((i - F.when(F.size(e) == 0, 0).otherwise(F.get(e, F.size(e) - 1)) >= LEAST_LINES) & (i < n), F.concat(e, F.array(i))).otherwise(e))
            return let(F.concat(some, F.array(n)), lambda e: F.transform(e, lambda x, k: F.struct(F.when(k == 0, 0).otherwise(F.get(e, k - 1)).alias("a"), x.alias("b"))))

        return F.transform(let(hashes, ends), lambda r: F.struct(r["a"].alias("a"), F.slice(lines, r["a"] + 1, r["b"] - r["a"]).alias("lines")))

    return let(lines, cut)


def chunks(text: Column) -> Column:
    """The chunks of a text, in order: arrays of lines."""
    return F.transform(spans(text), lambda x: x["lines"])


def _exploded(docs: DataFrame) -> DataFrame:
    rows = docs.filter("text is not null").select("doc_id", row_key(docs).alias("row"), F.posexplode(spans(F.col("text"))).alias("k", "x")).select("doc_id", "row", "k", "x.a", "x.lines")
    rows = rows.filter(F.size("lines") >= LEAST_LINES).withColumn("chunk", F.array_join("lines", "\n")).withColumn("n", F.size("lines")).drop("lines")
    return rows.filter(F.col("chunk").rlike("[^\\x20\\x09-\\x0D]")).withColumn("h", F.xxhash64("chunk"))


def repeats(docs: DataFrame, work: Work) -> DataFrame:
    """row, k, a and n (lines before, and in it) of every chunk that has an equal, its first place, and whether it ``stays``."""
    # Light pass: hashes and places only. The place of the first is the least of all with its hash.
    place = F.struct("doc_id", "row", "k")
    twice = _exploded(docs).groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("h", "first")
    twice = work.write(twice, "twice")
    rows = work.write(_exploded(docs).join(twice.hint("merge"), "h").select("h", "row", "k", "a", "n", "chunk", "first", ((F.col("row") == F.col("first.row")) & (F.col("k") == F.col("first.k"))).alias("stays")), "chunks")
    kept = rows.filter("stays").groupBy("h").agg(F.min("chunk").alias("kept"))
    return work.write(rows.join(kept, "h").filter("chunk = kept").select("row", "k", "a", "n", "first", "stays").distinct(), "repeats")


def same_lines(x: Column, y: Column) -> Column:
    """The number of lines that two arrays both begin with."""
    equal = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
    return let(equal, lambda e: F.when(F.array_contains(e, False), F.array_position(e, False) - 1).otherwise(F.size(e))).cast("int")


def grown(docs: DataFrame, found: DataFrame, work: Work) -> DataFrame:
    """row, k, side (0: before, 1: after) and ext: the lines beside a repeated chunk that are the same beside the one that stays."""
    by_row = Window.partitionBy("row").orderBy("k")
    before = F.col("a") - F.coalesce(F.lag(F.col("a") + F.col("n")).over(by_row), F.lit(0))
    # after a common end, cuts fall alike, so the chunk that follows is enough; before, cuts may differ up to the last repeated chunk
    after = F.when(F.coalesce(F.lead("k").over(by_row) == F.col("k") + 1, F.lit(False)), 0).otherwise(1)
    sides = F.explode(F.filter(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("want")), F.struct(F.lit(1).alias("side"), F.col("after").alias("want"))), lambda x: x["want"] > 0)).alias("x")
    # the chunk that stays is always an earlier one, so of each line an equal one is left, even where a text loses part of what others refer to
    edges = found.filter("not stays").withColumn("before", before).withColumn("after", after).select("row", "k", F.col("first.row").alias("to"), F.col("first.k").alias("to_k"), sides)
    edges = work.write(edges.select("row", "k", "to", "to_k", "x.side", "x.want"), "edges")
    asked = edges.select("row", "k", "side", "want").union(edges.select("to", "to_k", "side", "want")).groupBy("row", "k", "side").agg(F.max("want").alias("want"))
    asked = asked.groupBy("row").agg(F.collect_list(F.struct("k", "side", "want")).alias("asked"))
    asked = work.write(asked, "asked")
    # a table of bounded size keeps the texts that nobody asks for from the shuffle
    some = asked.select(held("row", HELD).alias("_held")).distinct()
    texts = docs.select(row_key(docs).alias("_row"), "text").join(F.broadcast(some), held("_row", HELD) == F.col("_held"), "left_semi")
    texts = texts.join(asked.hint("merge"), F.col("_row") == F.col("row")).select("_row", "text", "asked")

    def beside(c):
        back = lambda q: F.slice(F.reverse(F.flatten(F.slice(c, F.greatest(F.lit(1), q["k"] + 1 - q["want"]), F.least(q["k"], q["want"])))), F.lit(1), q["want"])
        return F.transform(F.col("asked"), lambda q: F.struct(q["k"].alias("_k"), q["side"].alias("_side"), F.when(q["side"] == 0, back(q)).otherwise(F.get(c, q["k"] + 1)).alias("lines")))

    near = texts.select("_row", F.inline(let(chunks(F.col("text")), beside))).groupBy("_row", "_k", "_side").agg(F.first("lines").alias("lines")).filter("lines is not null")
    near = work.write(near, "beside")
    mine = edges.join(near.hint("merge"), (F.col("row") == F.col("_row")) & (F.col("k") == F.col("_k")) & (F.col("side") == F.col("_side"))).select("row", "k", "side", "to", "to_k", F.col("lines").alias("mine"))
    met = mine.join(near.hint("merge"), (F.col("to") == F.col("_row")) & (F.col("to_k") == F.col("_k")) & (F.col("side") == F.col("_side")))
    return work.write(met.select("row", "k", "side", same_lines(F.col("mine"), F.col("lines")).alias("ext")).filter("ext > 0"), "grown")


def removed(docs: DataFrame, work: Work) -> DataFrame:
    """row, the spans of lines that go (from, to), and first_doc_ids."""
    found = repeats(docs, work)
    ext = grown(docs, found, work).groupBy("row", "k").agg(*[F.max(F.when(F.col("side") == i, F.col("ext"))).alias(x) for i, x in enumerate(("lo", "hi"))])
    rows = found.filter("not stays").join(ext.withColumnsRenamed({"row": "_row", "k": "_k"}).hint("merge"), (F.col("row") == F.col("_row")) & (F.col("k") == F.col("_k")), "left")
    span = F.struct((F.col("a") - F.coalesce("lo", F.lit(0))).alias("p"), (F.col("a") + F.col("n") + F.coalesce("hi", F.lit(0))).alias("q"))
    return work.write(rows.groupBy("row").agg(F.collect_list(span).alias("_gone"), F.array_sort(F.collect_set("first.doc_id")).alias("_first")), "gone")


def dedup(docs: DataFrame, work: Work, report: bool = False) -> DataFrame:
    """The documents with repeated chunks removed. ``report``: with n_lines, n_removed (lines) and first_doc_ids."""
    gone = removed(docs, work)
    joined = boxed(docs, "doc_id", "text").withColumn("_row", row_key(docs)).join(gone.withColumnRenamed("row", "_key").hint("merge"), F.col("_row") == F.col("_key"), "left")
    parts = F.filter(F.split(F.col("text"), "\n", -1), lambda x, i: ~F.exists("_gone", lambda s: (s["p"] <= i) & (i < s["q"])))
    left = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(parts, "\n"))
    if not report:
        new = {"text": left}
        if "n_chars" in docs.columns:
            new["n_chars"] = F.when(F.col("_gone").isNull(), F.col("_d.n_chars")).otherwise(F.length(left).cast(docs.schema["n_chars"].dataType))
        return unboxed(joined, docs.columns, **new)
    n = lambda t: F.coalesce(F.size(F.split(t, "\n", -1)), F.lit(0))
    removed_lines = F.when(F.col("_gone").isNull(), 0).otherwise(n(F.col("text")) - F.size(parts))
    return joined.select("doc_id", left.alias("text"), n(F.col("text")).cast("long").alias("n_lines"), removed_lines.cast("long").alias("n_removed"), F.coalesce("_first", F.array().cast("array<bigint>")).alias("first_doc_ids"))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the text that is left, and the number of lines that went."""
    return dedup(table(spark, sf_dir, "documents"), Work(spark, "lines"), report=True)
