"""Token-id output: length-delimited binary records with masked checksums, and an offset index.

A shard holds records in the framing ``length (u64) | masked crc32c of length (u32) | data |
masked crc32c of data (u32)``, all little-endian. The data of a record is ``key (i64) | flags (u32)
| ids``, each of two bytes where the vocabulary allows, and of four else. Flag 1 says that the key is
null, flag 2 that ids have four bytes. Beside each shard lies an index of two u64
for every record, its offset and the length of its data, so that a reader can shuffle records with
range reads and need not scan the shard.

Rows are written in ascending key order: null keys first, ties by a hash of the text. A null text counts as
empty; each document, however long, is one record and ends with ``end_id``. Repeated rows give repeated records. An empty table gives
no records. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import Work, file_system

MASK_DELTA = 0xA282EAD8
POLYNOMIAL = 0x82F63B78  # Castagnoli, reflected
KEY = "<qI"
HEAD = "<QI"


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


_T = _byte_table()
#: _SHIFT[k]: two tables that append 2**k zero bytes to a checksum, by its lower and its upper half.
_SHIFT: list[np.ndarray] = []


def _shift_tables(k: int) -> np.ndarray:
    while len(_SHIFT) <= k:
        if not _SHIFT:
            v = np.arange(1 << 16, dtype=np.uint32)
            t = np.stack([_T[v & 255] ^ (v >> 8), v << 8])  # one zero byte: T[low byte] ^ (crc >> 8)
        else:
            t = np.stack([_apply(_SHIFT[-1], _SHIFT[-1][i]) for i in range(2)])
        _SHIFT.append(t.astype(np.uint32))
    return _SHIFT[k]


def _apply(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
    half = np.ascontiguousarray(crc, dtype="<u4").view("<u2")
    return t[0].take(half[..., 0::2]) ^ t[1].take(half[..., 1::2])


def crc32c(data: bytes) -> int:
    return int(crc32c_many([data])[0])


def crc32c_many(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each part. Parts of like size go side by side, and 4-byte words are joined pairwise."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    levels = np.array([max(0, (n - 1).bit_length() - 2) if n >= 4 else -1 for n in sizes.tolist()])
    out = np.zeros(len(parts), dtype=np.uint32)
    for level in np.unique(levels).tolist():
        mine = np.flatnonzero(levels == level)
        if level < 0:
            for i in mine.tolist():
                crc = 0xFFFFFFFF
                for x in parts[i]:
                    crc = int(_T[(crc ^ x) & 255]) ^ (crc >> 8)
                out[i] = crc ^ 0xFFFFFFFF
            continue
        width = 4 << level
        step = max(1, (1 << 22) // width)
        for at in range(0, len(mine), step):
            rows = mine[at : at + step]
            a = np.zeros((len(rows), width), dtype=np.uint8)
            for k, i in enumerate(rows.tolist()):
                n = int(sizes[i])
                a[k, width - n :] = np.frombuffer(parts[i], dtype=np.uint8)
                a[k, width - n : width - n + 4] ^= 255  # the start value: leading zeros leave a checksum of zero alone
            crc = _apply(_shift_tables(2), a.view("<u4"))
            for k in range(level):
                crc = _apply(_shift_tables(2 + k), crc[:, 0::2]) ^ crc[:, 1::2]
            out[rows] = crc[:, 0] ^ np.uint32(0xFFFFFFFF)
    return out


def masked(parts: list[bytes]) -> list[int]:
    return [((((c >> 15) | (c << 17)) & 0xFFFFFFFF) + MASK_DELTA) & 0xFFFFFFFF for c in crc32c_many(parts).tolist()]


def frames(records: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(r)) for r in records]
    return [b"".join((h, struct.pack("<I", a), r, struct.pack("<I", b))) for h, a, r, b in zip(heads, masked(heads), records, masked(records))]


def unframe(framed: list[bytes]) -> list[bytes]:
    """The data of whole framed records; ValueError if a length or a checksum is wrong."""
    heads, data = [bytes(f[:8]) for f in framed], [bytes(f[12:-4]) for f in framed]
    for f, h, d, a, b in zip(framed, heads, data, masked(heads), masked(data)):
        if struct.unpack("<Q", h)[0] != len(d) or struct.unpack_from("<I", f, 8)[0] != a or struct.unpack_from("<I", f, len(f) - 4)[0] != b:
            raise ValueError("a record's length or checksum is wrong")
    return data


def bounds(rows: DataFrame, n: int) -> np.ndarray:
    """``n - 1`` rows (k, t) or fewer that part the rows into like shares, from a sample of some hundred rows a share."""
    total = rows.count()
    if not total or n < 2:
        return np.zeros((0, 2), dtype=np.int64)
    some = rows.sample(False, min(1.0, 200 * n / total), seed=7).select("k", "t").toArrow().to_pandas().to_numpy(dtype=np.int64)
    some = some[np.lexsort((some[:, 1], some[:, 0]))]
    return some[(np.arange(1, n) * len(some)) // n] if len(some) else np.zeros((0, 2), dtype=np.int64)


def write(docs: DataFrame, work: Work, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards; gives a row for each: shard, path, n_records, n_ids, in key order by shard.

    Texts are encoded where they lie and only their ids travel. The shares of the shards come from a sample
    of (key, hash of the text), so that neither many rows of one key nor many null keys meet in one shard.
    """
    folder, spark = work.folder("shards"), docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # null keys come first, as the least number; the key itself tells them apart
    rows = rows.select("key", F.coalesce("key", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("t"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = bounds(rows, n)

    def encode(batches):
        import pyarrow as pa

        encoder = bpe.encoder(tokenizer)
        end = end_id.to_bytes(encoder.width, "little")
        for batch in batches:
            key, k, t = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            part = np.zeros(len(k), dtype=np.int32)
            lo, hi = np.searchsorted(parts[:, 0], k), np.searchsorted(parts[:, 0], k, side="right")
            part[:] = lo
            for i in np.flatnonzero(hi > lo).tolist():  # a bound has this key too
                part[i] += np.searchsorted(parts[lo[i] : hi[i], 1], t[i], side="right")
            ids, at = encoder.column(batch.column(3))
            ids = ids.view(np.uint8)
            data = [ids[a:z].tobytes() + end for a, z in zip((at[:-1] * encoder.width).tolist(), (at[1:] * encoder.width).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(part), key, batch.column(2), pa.array(data, pa.binary())], names=["part", "key", "t", "ids"])

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, width, wide = TaskContext.get(), bpe.width(tokenizer), bpe.width(tokenizer) == 4
        n_records, n_ids, at, index = 0, 0, 0, []
        path = f"{folder}/shard-{task.partitionId():06d}-{uuid.uuid4().hex[:8]}.records"
        system, where = file_system(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(where, buffer_size=1 << 20) as out:
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                while group := list(itertools.islice(rows, 500)):
                    records = [struct.pack(KEY, doc or 0, (doc is None) + 2 * wide) + ids for doc, ids in group]
                    for framed in frames(records):
                        out.write(framed)
                        index.append((at, len(framed) - 16))
                        at += len(framed)
                    n_records, n_ids = n_records + len(group), n_ids + sum(len(ids) // width for _, ids in group)
        with system.open_output_stream(f"{where}.index") as out:
            out.write(np.array(index, dtype="<u8").tobytes())
        if n_records:
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "path": [path], "n_records": [n_records], "n_ids": [n_ids]}, schema=pa.schema({"shard": pa.int32(), "path": pa.string(), "n_records": pa.int64(), "n_ids": pa.int64()}))

    encoded = rows.mapInArrow(encode, "part int, key long, t long, ids binary").repartitionById(n, "part")
    ordered = encoded.sortWithinPartitions(F.col("key").asc_nulls_first(), "t", "ids").select("key", "ids")
    return work.write(ordered.mapInArrow(put, "shard int, path string, n_records long, n_ids long"), "manifest")


def read(manifest: DataFrame, span: int = 4 << 20) -> DataFrame:
    """Reads shards back by their indexes: doc_id, start (ids of all records before), n_tokens, ids_crc32.

    The manifest has a row for each shard, so its running sum is made on the driver.
    """
    spark, base, rows = manifest.sparkSession, 0, []
    for r in sorted(manifest.collect()):
        rows.append((r.path, base))
        base += r.n_ids
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def get(batches):
        import pyarrow as pa

        for batch in batches:
            for path, start in zip(*batch.to_pydict().values()):
                system, where = file_system(path)
                with system.open_input_file(f"{where}.index") as f:
                    index = np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2).astype(np.int64)
                with system.open_input_file(where) as f:
                    i = 0
                    while i < len(index):
                        j = max(i + 1, int(np.searchsorted(index[:, 0], index[i, 0] + span)))
                        buffer = memoryview(f.read_at(int(index[j - 1].sum() + 16 - index[i, 0]), int(index[i, 0])))
                        out = ([], [], [], [])
                        base = int(index[i, 0])
                        for data in unframe([buffer[o - base : o - base + n + 16] for o, n in index[i:j].tolist()]):
                            doc, flags = struct.unpack_from(KEY, data)
                            ids = np.frombuffer(data, dtype="<u4" if flags & 2 else "<u2", offset=struct.calcsize(KEY)).astype("<u4").tobytes()
                            for column, value in zip(out, (None if flags & 1 else doc, start, len(ids) // 4, zlib.crc32(ids))):
                                column.append(value)
                            start += len(ids) // 4
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        i = j

    return spark.createDataFrame(rows, "path string, start long").repartition(len(rows)).mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    """Writes the ids of every document with end id 0, and reads the files back."""
    from .common import table

    manifest = write(table(spark, sf_dir, "documents"), Work(spark, "token-files"), bpe.default_path(), 0)
    return read(manifest)
