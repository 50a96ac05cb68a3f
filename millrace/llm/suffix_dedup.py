"""Exact substring dedup: every byte within a string of ``need`` bytes that starts anywhere else goes.

The suffix order is built column by column for many strings at once: a round adds one symbol
to every string from its end, and updates the collection's Burrows-Wheeler transform and the common
prefixes of neighbours (``repeated``). The order of a whole corpus fits no task, so the strings of one
collection are chosen such that equal windows always meet:

* Every window of ``need`` bytes picks an anchor, the ``GRAM`` bytes within it with the least hash (the last
  of equals). Equal windows pick equal anchors at the same place, whatever surrounds them.
* Windows next to each other mostly share an anchor; the text that they span is the anchor's context, of
  ``2 * need - GRAM`` bytes at most. Anchors whose bytes occur once have no repeated window.
* Contexts with equal anchors form a collection, equal contexts once with their number. So rounds
  are bounded by the context's length, and a hot passage is counted before it is moved.
* A collection falls into parts: a window holds the ``(need - GRAM) / 2`` bytes before its anchor, or those after
  it. Windows that are equal have these bytes alike, so a context's two halves go to the parts of their own
  bytes, and an anchor with many different contexts spreads over many parts. Equal halves stand as one.

Contexts are told apart by the anchor's hash and their own (128 bits). Only contexts of repeated anchors with several
contexts need their bytes; a bit map of fixed size keeps others from the shuffle. (It may let some through, and the
join by the full hash drops these.) A part of up to ``EXTERNAL`` different strings is built in memory, some ``10 * need``
bytes for each; a larger one through sequential files in the shared folder (``_construct_files``), where a round reads the
transform and the prefixes block by block and writes them anew, and memory holds the strings and a place for each. Long texts are scanned ``1 << PLACE`` bytes at a time.

Matches never cross rows. A null text counts as empty. Rows with equal doc_id and text are each an
occurrence of their strings. Texts shorter than ``need`` stay whole. An empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, Work, by_size, file_system, lean, row_key, table

NEED = 200
GRAM = 128
#: Strings of a collection that are built at a time, at least where one anchor has no more.
BATCH = 4096
#: Bytes of a symbol, where strings share an anchor.
STEP = 8
#: Different strings of a collection from which its transform lies in files.
EXTERNAL = 1 << 17
#: Rows of a file that are read at a time.
BLOCK = 1 << 20
PLACE = 20
_P = 0x9E3779B97F4A7C15 | 1


def anchors(b: np.ndarray, need: int = NEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor: its place, its hash, and the first and last start of the windows that pick it."""
    step = (1 << PLACE) - need
    parts = [_anchors(b[at : at + step + need - 1], need, at) for at in range(0, max(1, len(b) - need + 1), step)]
    return tuple(np.concatenate(c) for c in zip(*parts))


def _anchors(b: np.ndarray, need: int, base: int):
    n = len(b) - need + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, p, size = b.astype(np.uint64) + np.uint64(1), _P, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(p) + h[size:]
        p, size = p * p & (1 << 64) - 1, 2 * size
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = np.uint64((1 << PLACE) - 1)
    v = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    width, have = need - GRAM + 1, 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    if have < width:
        v = np.minimum(v[: len(v) - (width - have)], v[width - have :])
    at = (low - (v & low)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    return at[first] + base, h[at[first]], first + base, last + base


def repeated(strings: list[bytes], counts, need: int = NEED, places=None, folder: str | None = None) -> list[np.ndarray]:
    """Of each string: for every start of a window of ``need`` bytes, whether that window occurs again in the collection.

    ``places``: a byte of each string that stands at the same place in all equal windows (the anchor). Then
    ``STEP`` bytes make a symbol, cut at these places, and the construction runs once for each of
    the ``STEP`` shifts: every window is a run of whole symbols in one of them, and the work, which grows with
    the square of a string's symbols, falls to a part. Without places a byte is a symbol, and so it is where the
    transform goes to files in ``folder``.
    """
    places = None if folder else places
    out = [np.full(len(s) - need + 1, n > 1) for s, n in zip(strings, counts)]
    step = STEP if places is not None and need % STEP == 0 else 1
    for shift in range(step):
        starts = [(p + shift) % step for p in places] if places is not None and step > 1 else [0] * len(strings)
        cut = [np.frombuffer(s[a : a + (len(s) - a) // step * step], dtype=f"<u{step}") for s, a in zip(strings, starts)]
        some = [i for i, c in enumerate(cut) if len(c) >= need // step]
        if not some:
            continue
        values, symbols = np.unique(np.concatenate([cut[i] for i in some]), return_inverse=True)
        kind = np.uint8 if len(values) < 255 else np.uint16 if len(values) < 65535 else np.uint32
        symbols = np.split(symbols.astype(kind), np.cumsum([len(cut[i]) for i in some])[:-1])
        built = _construct_files(symbols, need, np.iinfo(kind).max, folder) if folder else _construct(symbols, need // step, np.iinfo(kind).max)
        for i, flags in zip(some, built):
            out[i][starts[i] :: step][: len(flags)] |= flags
    return out


def _construct(strings: list[np.ndarray], need: int, end: int) -> list[np.ndarray]:
    """The construction over strings of symbols below ``end``: which windows of ``need`` symbols occur again."""
    m, lengths = len(strings), np.array([len(s) for s in strings])
    most = int(lengths.max())
    columns = np.full((most + 1, m), end, dtype=strings[0].dtype)  # column k: the symbols k places before the ends
    for i, s in enumerate(strings):
        columns[: len(s), i] = s[::-1]
    bwt, common, at = columns[0].copy(), np.zeros(m, dtype=np.uint8), np.arange(m)
    # all symbols of the transform but the ends', ordered by symbol and place: the index is a suffix's rank
    place = np.int64((1 << 40) - 1)
    named = columns.astype(np.int64) << 40
    keys = np.sort((named[0] | at)[columns[0] != end])
    for k in range(1, most + 1):
        on = np.flatnonzero(lengths >= k)
        new = m + np.searchsorted(keys, named[k - 1, on] | at[on])
        size = len(bwt) + len(on)
        old = np.ones(size, dtype=bool)
        old[new] = False
        merged, prefixes = np.empty(size, dtype=bwt.dtype), np.empty(size, dtype=np.uint8)
        merged[old], prefixes[old] = bwt, common
        merged[new] = columns[k, on]
        # the common prefixes of the new suffixes and of those that now follow them
        rows = np.unique(np.concatenate((new, new + 1)))
        rows = rows[rows - m < len(keys)]
        hi = keys[rows - m] & place
        lo = keys[np.maximum(rows - m - 1, 0)] & place
        same = (rows > m) & (bwt[hi] == bwt[lo])
        value = np.zeros(len(rows), dtype=np.uint8)
        value[same] = np.minimum(_least(common, lo[same] + 1, hi[same]), need - 1) + 1
        prefixes[rows] = value
        # insertions move the places of what stands behind them, and leave the order as it is
        keys = keys & ~place | np.flatnonzero(old)[keys & place]
        more = np.sort((named[k, on] | new)[columns[k, on] != end])
        keys = np.insert(keys, np.searchsorted(keys, more), more)
        bwt, common = merged, prefixes
        at[on] = new
    twice = np.maximum(common, np.append(common[1:], 0)) >= need
    at = np.arange(m)
    flags = np.zeros((most + 1, m), dtype=bool)
    for k in range(1, most + 1):
        on = np.flatnonzero(lengths >= k)
        at[on] = m + np.searchsorted(keys, named[k - 1, on] | at[on])
        flags[k, on] = twice[at[on]]
    return [flags[n : need - 1 : -1, i] for i, n in enumerate(lengths)]


class Rows:
    """A sequential file of numbers, read in blocks and written once."""

    def __init__(self, path: str, kind, size: int = 0):
        self.path, self.kind, self.size = path, np.dtype(kind), size
        self.system, self.at = file_system(path)

    def write(self, parts) -> Rows:
        self.system.create_dir(self.at.rsplit("/", 1)[0], recursive=True)
        self.size = 0
        with self.system.open_output_stream(self.at, buffer_size=1 << 20) as out:
            for part in parts:
                out.write(np.ascontiguousarray(part, dtype=self.kind).tobytes())
                self.size += len(part)
        return self

    def blocks(self):
        """First place and rows of each block."""
        with self.system.open_input_stream(self.at, buffer_size=1 << 20) as f:
            for at in range(0, self.size, BLOCK):
                yield at, np.frombuffer(f.read(min(BLOCK, self.size - at) * self.kind.itemsize), dtype=self.kind)

    def drop(self) -> None:
        self.system.delete_file(self.at)


def _ranks(bwt: Rows, at: np.ndarray, symbol: np.ndarray, end: int, block=None) -> tuple[np.ndarray, np.ndarray]:
    """Of each place in the transform, which holds the symbol: the number of equal ones before; and the number of every symbol.

    ``block``: is called with each block's first place, its order by symbol and where each symbol begins in that.
    """
    count, rank = np.zeros(end + 1, dtype=np.int64), np.empty(len(at), dtype=np.int64)
    order = np.argsort(at, kind="stable")
    sorted_at = at[order]
    for first, b in bwt.blocks():
        by = np.argsort(b, kind="stable")
        starts = np.searchsorted(b[by], np.arange(end + 2))
        mine = order[slice(*np.searchsorted(sorted_at, [first, first + len(b)]))]
        if len(mine):
            place = np.empty(len(b), dtype=np.int64)
            place[by] = np.arange(len(b))
            rank[mine] = count[symbol[mine]] + place[at[mine] - first] - starts[symbol[mine]]
        if block is not None:
            block(by, starts)
        count += np.diff(starts)
    return rank, count


def _construct_files(strings: list[np.ndarray], need: int, end: int, folder: str) -> list[np.ndarray]:
    """As ``_construct``, with the transform and the common prefixes in files that each round reads and writes in order."""
    m, lengths = len(strings), np.array([len(s) for s in strings])
    most = int(lengths.max())
    columns = np.full((most + 1, m), end, dtype=strings[0].dtype)
    for i, s in enumerate(strings):
        columns[: len(s), i] = s[::-1]
    bwt = Rows(f"{folder}/bwt-0", columns.dtype).write([columns[0]])
    common = Rows(f"{folder}/common-0", np.uint8).write([np.zeros(m, dtype=np.uint8)])
    at = np.arange(m)
    for k in range(1, most + 1):
        on = np.flatnonzero(lengths >= k)
        symbol = columns[k - 1, on].astype(np.int64)
        piles: dict[int, tuple[Rows, object]] = {}
        seen, least = np.zeros(end + 1, dtype=bool), np.full(end + 1, 255, dtype=np.uint8)
        prefixes = common.blocks()

        def extend(by, starts):
            """What follows a symbol keeps its order behind it: the prefix it shares with the one before is one longer than the least between."""
            nonlocal seen, least
            _, common_block = next(prefixes)
            n = len(by)
            lo = np.empty(n, dtype=np.int64)
            lo[1:] = by[:-1] + 1
            there = np.flatnonzero(np.diff(starts))
            lo[starts[there]] = 0
            value = _least(common_block, lo, by)
            firsts = starts[there]
            value[firsts] = np.minimum(value[firsts], least[there])
            value = np.minimum(value, need - 1) + 1
            value[firsts[~seen[there]]] = 0
            for c in there.tolist():
                if c != end:
                    if c not in piles:
                        rows = Rows(f"{folder}/pile-{k}-{c}", np.uint8)
                        piles[c] = rows, rows.system.open_output_stream(rows.at)
                    piles[c][1].write(value[starts[c] : starts[c + 1]].tobytes())
                    piles[c][0].size += int(starts[c + 1] - starts[c])
            # the least since the last of each symbol
            last = by[starts[there + 1] - 1] + 1
            least = np.minimum(least, common_block.min())
            least[there] = 255
            some = last < n
            least[there[some]] = _least(common_block, last[some], np.full(int(some.sum()), n - 1))
            seen[there] = True

        rank, count = _ranks(bwt, at[on], symbol, end, extend)
        for _, out in piles.values():
            out.close()
        base = m + np.concatenate(([0], np.cumsum(count[:end])))
        new = base[symbol] + rank
        order = np.argsort(new)
        into, with_ = (new[order] - np.arange(len(on))), columns[k, on][order]

        def merged():
            done = 0
            for first, b in bwt.blocks():
                to = int(np.searchsorted(into, first + len(b)))
                yield np.insert(b, into[done:to] - first, with_[done:to])
                done = to
            yield with_[done:]

        def joined():
            yield np.zeros(m, dtype=np.uint8)
            for c in sorted(piles):
                for _, part in piles[c][0].blocks():
                    yield part

        old = [bwt, common, *(rows for rows, _ in piles.values())]
        bwt = Rows(f"{folder}/bwt-{k}", columns.dtype).write(merged())
        common = Rows(f"{folder}/common-{k}", np.uint8).write(joined())
        for rows in old:
            rows.drop()
        at[on] = new

    def twice():
        before = None
        for _, part in common.blocks():
            high = part >= need
            if before is not None:
                before[-1] |= high[0]
                yield before
            before = high.copy()
            before[:-1] |= high[1:]
        yield before

    flagged = Rows(f"{folder}/twice", np.bool_).write(twice())
    at = np.arange(m)
    flags = np.zeros((most + 1, m), dtype=bool)
    for k in range(1, most + 1):
        on = np.flatnonzero(lengths >= k)
        symbol = columns[k - 1, on].astype(np.int64)
        rank, count = _ranks(bwt, at[on], symbol, end)
        at[on] = (m + np.concatenate(([0], np.cumsum(count[:end]))))[symbol] + rank
        order = on[np.argsort(at[on])]
        for first, part in flagged.blocks():
            mine = order[slice(*np.searchsorted(at[order], [first, first + len(part)]))]
            flags[k, mine] = part[at[mine] - first]
    for rows in (bwt, common, flagged):
        rows.drop()
    return [flags[n : need - 1 : -1, i] for i, n in enumerate(lengths)]


def _least(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of x[lo..hi] for every pair, by minima over doubled widths."""
    out = np.empty(len(lo), dtype=x.dtype)
    level = np.frexp(hi - lo + 1)[1] - 1
    width = 1
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(x[lo[at]], x[hi[at] - width + 1])
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edge[0::2].tolist(), (edge[1::2] - 1).tolist()))


def _bits(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit map of 2**bits places of the column ``key``, as bytes."""
    place = F.col("key").bitwiseAND((1 << bits) - 1)
    words = keys.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("b")).collect()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for r in words:
        out[r.w] = r.b
    return out


def windows(docs: DataFrame, work: Work, need: int = NEED, external: int = EXTERNAL) -> DataFrame:
    """row, first and last: runs of starts of repeated windows."""
    from xxhash import xxh64_intdigest

    text = docs.select(row_key(docs).alias("row"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("b")).filter(F.octet_length("b") >= need)

    def signed(x):
        return np.array(x, dtype=np.uint64).view(np.int64)

    def keys(batches):
        import pyarrow as pa

        for batch in by_size(batches, 0):
            found, context = [], []
            for b in batch.column(0).to_pylist():
                at, h, first, last = anchors(np.frombuffer(b, dtype=np.uint8), need)
                found.append(h)
                context += [xxh64_intdigest(b[x : y + need], a - x) for a, x, y in zip(at.tolist(), first.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(signed(context))], names=["key", "context"])

    found = text.select("b").mapInArrow(lean(keys), "key long, context long").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("a"), F.max("context").alias("z"))
    twice = work.write(found.filter("n > 1").select("key", (F.col("a") != F.col("z")).alias("several")), "anchors")
    bits = min(24, max(16, int(8 * twice.count()).bit_length()))  # 2 MB at most
    spark = docs.sparkSession
    maps = spark.sparkContext.broadcast((_bits(twice, bits), _bits(twice.filter("several"), bits)))

    def places(batches):
        import pyarrow as pa

        any_of, several = maps.value
        held = lambda m, k: (m[(k & ((1 << bits) - 1)) >> 6] >> (k & 63)) & 1 == 1
        for batch in by_size(batches, 1):
            found, spans, context = [], [], []
            for row, b in enumerate(batch.column(1).to_pylist()):
                at, h, first, last = anchors(np.frombuffer(b, dtype=np.uint8), need)
                key = h.view(np.int64)
                on = np.flatnonzero(held(any_of, key))
                at, key, first, last = at[on], key[on], first[on], last[on]
                mine = [b[x : y + need] for x, y in zip(first.tolist(), last.tolist())]
                context += [xxh64_intdigest(s, a - x) for s, a, x in zip(mine, at.tolist(), first.tolist())]
                spans += [s if k else None for s, k in zip(mine, held(several, key).tolist())]
                found.append(np.stack((key, np.full(len(at), row), first, last, at - first)))
            key, row, first, last, place = np.concatenate(found, axis=1)
            columns = [pa.array(key), pa.array(signed(context)), batch.column(0).take(pa.array(row)), pa.array(first), pa.array(last), pa.array(place, pa.int32()), pa.array(spans, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "context", "row", "first", "last", "place", "span"])

    rows = text.mapInArrow(lean(places), f"key long, context long, row {KEY}, first long, last long, place int, span binary").join(twice.hint("merge"), "key")
    rows = work.write(rows, "places")
    whole = rows.filter("not several").select("row", "first", "last")
    strings = rows.filter("several").groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.first("span").alias("span"), F.first("place").alias("place"))

    # the halves of a context: windows that hold the bytes before the anchor, and the others
    half, starts = (need - GRAM) // 2, F.octet_length("span") - need + 1
    side = lambda k, a, z, at: F.when(a < z, F.struct(F.xxhash64("key", F.lit(k), F.substring("span", at + 1, F.lit(half))).alias("part"), a.alias("from"), (F.col("place") - a).alias("place"), F.substring("span", a + 1, z - a + need - 1).alias("span")))
    cut = F.greatest(F.lit(0), F.least(starts, F.col("place") - half + 1))
    sides = F.array_compact(F.array(side(0, F.lit(0), cut, F.col("place") - half), side(1, cut, starts, F.col("place") + GRAM)))
    halves = strings.select("key", "context", "n", F.inline(sides)) if need > GRAM + 1 else strings.select("key", "context", "n", F.col("key").alias("part"), F.lit(0).alias("from"), "place", "span")

    files = work.folder("construction")

    def build(batches):
        import pyarrow as pa

        def out(parts):
            found = []
            strings = [x for part in parts for x in part.items()]
            many = [i for i, part in enumerate(parts) for _ in part]
            # a string alone in its part needs no order
            for (span, (place, owners)), i in zip(strings, many):
                if len(parts[i]) == 1 and sum(n for *_, n in owners) > 1:
                    found += [(key, context, a, a + len(span) - need) for key, context, a, _ in owners]
            some = [x for x, i in zip(strings, many) if len(parts[i]) > 1]
            flags = repeated([span for span, _ in some], [sum(n for *_, n in owners) for _, (_, owners) in some], need, [place for _, (place, _) in some], f"{files}/{uuid.uuid4().hex}" if len(some) > external else None) if some else []
            for (_, (_, owners)), f in zip(some, flags):
                for x, y in runs(f):
                    found += [(key, context, a + x, a + y) for key, context, a, _ in owners]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(4)], names=["key", "context", "a", "z"])

        parts: list[dict] = []  # of each part: span, to its anchor's place and its owners
        last, n = None, 0
        for batch in batches:
            for key, context, number, part, start, place, span in zip(*(c.to_pylist() for c in batch.columns)):
                if part != last:
                    if n >= BATCH:
                        yield out(parts)
                        parts, n = [], 0
                    parts.append({})
                    last = part
                parts[-1].setdefault(span, (place, []))[1].append((key, context, start, number))
                n += 1
        if parts:
            yield out(parts)

    ordered = halves.repartition("part").sortWithinPartitions("part")
    found = work.write(ordered.select("key", "context", "n", "part", "from", "place", "span").mapInArrow(lean(build), "key long, context long, a long, z long"), "runs")
    parts = rows.filter("several").select("key", "context", "row", "first").join(found, ["key", "context"]).select("row", (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("z")).alias("last"))
    out = work.write(whole.union(parts), "windows")
    work.drop(twice, rows, found)
    return out


def dedup(docs: DataFrame, work: Work, need: int = NEED, text: bool = False, external: int = EXTERNAL) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; ``text``: with what is left, as ``kept``."""
    spans = windows(docs, work, need, external).distinct().groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = work.write(spans, "spans").withColumnRenamed("row", "_row")
    joined = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("b"), row_key(docs).alias("row"))
    joined = joined.join(spans.hint("merge"), F.col("row") == F.col("_row"), "left").select("doc_id", "b", "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * text

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, b, s in zip(*(c.to_pylist() for c in batch.columns)):
                n, count = 0, 0
                if s:
                    gone = np.zeros(len(b) + 1, dtype=np.int32)
                    for x in s:
                        gone[x["first"]] += 1
                        gone[x["last"] + need] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    n, count = int(gone.sum()), len(runs(gone))
                    kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
                else:
                    kept = b
                rows.append((doc, len(b), n, count, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings of all documents."""
    return dedup(table(spark, sf_dir, "documents"), Work(spark, "suffixes"))
