"""A corpus pipeline of five operators: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage is written as Parquet and read again as the next one's documents, so a lost executor costs a
stage at most. All stages but the last return the columns of documents, whatever further columns there are.

Null and empty texts have fewer words than the quality rules ask for and go in the first stage; so does nothing else
for a null lang or source, which form groups of their own. Repeated rows (equal doc_id and text) count as one where repeats are
looked for, so they do not remove each other, and each is packed. Rows without a doc_id stay in the near-copy stage. Of texts
that tie, the one with the smallest doc_id stays. Texts may be of any length. Empty tables give an empty result; without
benchmark items nothing is taken for a leak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontamination, line_dedup, packing, quality, simhash
from millrace.llm.common import Work, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules."""
    return quality.keep(docs, Work(spark, "quality"))


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines; every document stays, and n_chars is that of the text that is left."""
    return line_dedup.dedup(docs, Work(spark, "lines"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies."""
    return simhash.keep_one(docs, Work(spark, "simhash"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), Work(spark, "decontamination"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 1024 tokens."""
    return packing.pack(docs, Work(spark, "packing"), bpe.default_path())


STAGES = [("quality", quality_rules), ("lines", line_chunks), ("simhash", near_copies), ("decontamination", benchmark_leaks), ("packing", pack)]

#: Token ids and XXH64 fingerprints have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
