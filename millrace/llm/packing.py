"""Best-fit packing of documents into sequences of a fixed number of tokens, by best two-fit.

Best two-fit fills one sequence at a time: greedily the longest piece that still fits; when none
fits, the sequence's smallest piece gives way to the two unpacked pieces that fill its place and
the gap most tightly, if there are such. Lengths are whole numbers up to the capacity, so the plan is
made on the counts of each length (at most ``capacity`` rows, whatever the input): a sequence's
pattern is repeated as often as the counts allow, as the greedy choice would. Pieces then take the
places of their length by rank, which needs no task to see all pieces of a length.

A null text counts as empty; every document ends with ``end_id``, so no piece is empty. Longer
documents, however long, are cut into pieces of the capacity, and the first piece may be shorter. Repeated rows are
packed each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import Work, give_back, table

#: Buckets of a length's pieces at least; the session's shuffle partitions where there are more.
BUCKETS = 256


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths, and how often each is used."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a length of {length} doesn't fit")
        left[length] = n
    out = []
    while left.any():
        have, pattern, gap = left.copy(), [], capacity
        while gap and len(fits := np.flatnonzero(have[: gap + 1])):
            length = int(fits[-1])
            n = min(int(have[length]), gap // length)
            pattern += [length] * n
            have[length] -= n
            gap -= n * length
        if gap and (two := _two(have, pattern[-1], pattern[-1] + gap)):
            pattern[-1:] = two
        used = np.bincount(pattern, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        out.append((pattern, times))
    return out


def _two(have: np.ndarray, least: int, most: int) -> list[int] | None:
    """The two lengths with the largest sum over ``least`` and up to ``most``."""
    lengths = np.flatnonzero(have[:most])
    if not len(lengths):
        return None
    # the largest partner of each length: below it, or itself if there are two
    at = np.searchsorted(lengths, np.minimum(most - lengths, lengths), side="right") - 1
    partner = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
    alone = (partner == lengths) & (have[lengths] < 2)
    partner = np.where(alone, np.where(at > 0, lengths[np.maximum(at - 1, 0)], 0), partner)
    total = np.where(partner > 0, lengths + partner, 0)
    i = int(total.argmax())
    return [int(lengths[i]), int(partner[i])] if total[i] > least else None


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""

    def one(batch):
        import pyarrow as pa

        ids, bounds = bpe.encoder(tokenizer).column(batch.column(1))
        lengths = np.diff(bounds) + 1
        # the ids of all documents, each with its end id, as unsigned 32-bit integers
        data = np.insert(ids.astype("<u4"), bounds[1:], np.uint32(end_id)).tobytes()
        first = np.where(lengths <= capacity, lengths, np.where(lengths % capacity, lengths % capacity, capacity))
        n = 1 + (lengths - first) // capacity
        of = np.repeat(np.arange(len(lengths)), n)
        piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        start = np.where(piece > 0, first[of] + (piece - 1) * capacity, 0)
        length = np.where(piece > 0, capacity, first[of])
        at = 4 * ((bounds[:-1] + np.arange(len(lengths)))[of] + start)
        crc = [zlib.crc32(data[a:z]) for a, z in zip(at.tolist(), (at + 4 * length).tolist())]
        columns = [batch.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    def cut(batches):
        for batch in batches:
            yield one(batch)
            give_back()  # else what a batch took stays with the worker, besides the table of units

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, work: Work, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = work.write(pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # up to ``capacity`` rows
    slots: dict[int, list[tuple[int, int, int]]] = {}  # of a length: its ranks from, the sequence of that rank, the offset
    taken, base = dict.fromkeys(counts, 0), 0
    for pattern, times in plan(counts, capacity):
        offset = 0
        for length in pattern:
            slots.setdefault(length, []).append((taken[length], base, offset))
            taken[length] += times
            offset += length
        base += times
    table_of = {length: np.array(s, dtype=np.int64).T for length, s in slots.items()}

    # a hash bucket besides the length, so that no length meets in one task
    buckets = max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    by_length = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = bucketed.groupBy("length", "bucket").count().withColumn("before", F.coalesce(F.sum("count").over(by_length), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = bucketed.withColumn("n", F.row_number().over(within)).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("n") - 1)

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for one in np.unique(length):
                mine = length == one
                lo, first, off = table_of[int(one)]
                k = np.searchsorted(lo, rank[mine], side="right") - 1
                sequence[mine], offset[mine] = first[k] + rank[mine] - lo[k], off[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op4_best_two_fit(spark, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), Work(spark, "packing"), bpe.default_path())
