"""Quality rules with adaptive thresholds: per language and source, from mergeable quantile sketches.

Fixed cutoffs suit no language and no source exactly. Here each group of lang and source gets its own
bounds: a sketch of the quartiles of every measure (``approx_percentile``, whose partial sketches
merge), and from them an upper fence ``q3 + reach * max(q3 - q1, spread)``. A text fails where a
measure lies over its group's fence. ``spread`` is the least spread that is assumed, so that a group
of nearly equal texts does not reject an ordinary one. The counts of all texts are made once and written; they give
the fences, and are joined with them.

Measures: signs (characters of ``[#*$%&|<>]`` to characters in words), capitals (upper-case to all
letters that have case, in texts with a lower-case script), repeats (words in repeated 5-word
windows to words) and copied lines (lines equal to an earlier line, to lines).

A null text has no words, and fails the base rules, like an empty one; texts may be of any length. Null lang or source form groups of their own.
Repeated rows are judged each; an empty table gives no rows. Extra columns are ignored by
``verdicts`` and kept by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work, boxed, let, table, unboxed, words

SIGNS = "[#*$%&|<>]"
WINDOW = 5
#: Of each measure: the least spread that is assumed between its quartiles.
SPREAD = {"signs": 0.02, "capitals": 0.05, "repeats": 0.05, "copied": 0.1}
REACH = 3.0
#: An eighth of the sketch's relative error in ranks would be 1/8000.
ACCURACY = 1000


def repeated_words(w: Column) -> Column:
    """Words of an array that lie in 5-word windows found twice or more, each counted once."""
    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(h):
        with_place = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s):
            at = lambda j: F.get(s, j)["h"]
            same = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (at(j) == at(j - 1)) | (at(j) == at(j + 1)))
            return F.sort_array(F.transform(same, lambda j: F.get(s, j)["i"]))

        def total(p):
            steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(with_place, places), total)

    # the words are bound too: a plan that inlines their column would split the text for every word
    some = lambda w: let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return let(w, lambda w: F.when(F.size(w) < WINDOW + 1, F.lit(0)).otherwise(some(w)))


def measures(docs: DataFrame) -> DataFrame:
    """Adds ``m``, a struct of the counts of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    split = docs.withColumn("_w", words(F.col("text"))).withColumn("_l", lines)
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count(text, F.lit(SIGNS)),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_upper": F.regexp_count(text, F.lit("\\p{Lu}")),
        "n_lower": F.regexp_count(text, F.lit("\\p{Ll}")),
        "n_repeat_words": repeated_words(F.col("_w")),
    }
    return split.withColumn("m", F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])).drop("_w", "_l")


def ratios() -> dict[str, Column]:
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {
        "signs": part(F.col("m.n_symbols"), F.col("m.word_chars")),
        "capitals": part(F.col("m.n_upper"), F.col("m.n_upper") + F.col("m.n_lower")),
        "repeats": part(F.col("m.n_repeat_words"), F.col("m.n_words")),
        "copied": part(F.col("m.n_dup_lines"), F.col("m.n_lines")),
    }


def fences(counted: DataFrame, reach: float = REACH) -> DataFrame:
    """The upper fences of each lang and source, a row for each, from the texts' counts."""
    of = ratios()
    sketch = counted.groupBy("lang", "source").agg(*[F.percentile_approx(c, [0.25, 0.75], ACCURACY).alias(k) for k, c in of.items()])
    return sketch.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[(F.col(k)[1] + reach * F.greatest(F.col(k)[1] - F.col(k)[0], F.lit(SPREAD[k]))).alias(f"_{k}") for k in of])


def judged(docs: DataFrame, work: Work, *kept: str) -> DataFrame:
    """The columns ``kept`` of the documents with ``m``, ``base_failed`` and ``kept``. The counts are made once, and written."""
    counted = work.write(measures(docs).select(*dict.fromkeys((*kept, "lang", "source", "m"))), "counts")
    bounds = work.write(fences(counted), "fences")
    joined = counted.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    base = (F.col("m.n_words") < 10) | (100 * F.col("m.n_repeat_words") > 20 * F.col("m.n_words"))
    over = F.lit(False)
    for k, c in ratios().items():
        over |= c > F.col(f"_{k}")
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & ~F.coalesce(over, F.lit(False))).drop(*bounds.columns)


def verdicts(docs: DataFrame, work: Work) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row."""
    return judged(docs.select("doc_id", "text", "lang", "source"), work, "doc_id").select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame, work: Work) -> DataFrame:
    """The documents that pass, with their columns."""
    rows = judged(boxed(docs, "text", "lang", "source"), work, "_d")
    return unboxed(rows.filter("kept"), docs.columns)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Verdicts on every document."""
    return verdicts(table(spark, sf_dir, "documents"), Work(spark, "quality"))


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
SQL = f"""
WITH split AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
spans AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM spans) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
counted AS (SELECT doc_id, lang, source, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(regexp_extract_all(t, '\\p{{Lu}}')) AS up, len(regexp_extract_all(t, '\\p{{Ll}}')) AS low
    FROM split LEFT JOIN covered USING (doc_id)),
rated AS (SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0) AS signs, coalesce(up / nullif(up + low, 0), 0) AS capitals, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeats, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS copied FROM counted),
fences AS (SELECT lang, source, {", ".join(f"quantile_disc({k}, 0.75) + {REACH} * greatest(quantile_disc({k}, 0.75) - quantile_disc({k}, 0.25), {SPREAD[k]}) AS f_{k}" for k in SPREAD)} FROM rated GROUP BY lang, source)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (signs > f_signs OR capitals > f_capitals OR repeats > f_repeats OR copied > f_copied) AS kept
FROM rated JOIN fences ON rated.lang IS NOT DISTINCT FROM fences.lang AND rated.source IS NOT DISTINCT FROM fences.source
"""
