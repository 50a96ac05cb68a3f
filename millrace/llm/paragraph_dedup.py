"""Substring dedup of near-equal paragraphs: MinHash banding, exact Jaccard, removal by components.

Paragraphs are of two kinds, and both come from the same two passes over the texts:

* Lines of ``LEAST_WORDS`` words or more. A line's set holds its five-word shingles. ``BANDS`` bands of ``ROWS``
  MinHash rows each: lines with a similarity of 0.8 collide in one with a chance of
  ``1 - (1 - 0.8 ** ROWS) ** BANDS`` (0.994), equal ones always. Equal lines stand as one; different ones that
  collide are verified by exact Jaccard similarity, and those at 0.8 or more form components, from
  spanning forests of each bucket. Of each component's occurrences the first, by doc_id and place, stays.
* Runs of words between content-defined cuts, about 11 words each, for passages that are copied into
  otherwise different lines. A cut lies before a word where the hash of the word pair is the least within
  ``RADIUS`` words on both sides, so a passage that two texts share has the same cuts in both but
  near its ends. Runs match as equals only; the first occurrence stays. The first and last words of a passage
  lie in runs that straddle its ends, so what is found grows word by word to both sides, as far
  as the words beside the occurrence that stays are the same. Passages count from ``LEAST_WORDS``
  words of this grown length, so that stock phrases stay; 0 lets every repeated run count. A passage without a
  whole run in it is missed: about 5 % of those of 50 words, 0.3 % of those of 60.

The first pass counts band values and runs; those that occur with different lines, or at several places, are
kept in a bit map of at most 4 MB, which keeps the rest from the second pass's tables. (Where it fills up, more travels, and
the joins by the full 128-bit hashes drop it: the result is the same.)

Words: ASCII lower case, between ASCII white space. Null and empty texts have no paragraphs. Rows with
equal doc_id and text count as one. Rows of an empty table: none. Extra columns are ignored. Long texts are
hashed some MB at a time. The different lines of one bucket are held by one task, some 500 bytes for each.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, Work, boxed, by_size, lean, row_key, table, unboxed
from .components import connected

RADIUS = 5
WIDTH = 5
BANDS, ROWS = 5, 2
THRESHOLD = 0.8
LEAST_WORDS = 15
#: Bytes that are hashed at a time, up to the next white space.
SLICE = 1 << 21
#: Stands for a null doc_id.
NO_DOC = -(1 << 63)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX[k % 4])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[(k + 1) % 4])
    return x ^ (x >> np.uint64(33))


def _powers(p: int, n: int) -> np.ndarray:
    """p ** 0 .. p ** (n - 1), modulo 2 ** 64."""
    low = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(4095, p, np.uint64))))
    high = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n >> 12, pow(p, 4096, 1 << 64), np.uint64))))
    return (high[:, None] * low[None, :]).ravel()[:n]


def word_hashes(b: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of every word, and its hash. Words end at white space and at ``edges``, the ends of texts."""
    places, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(b):
        end = at + SLICE
        if end < len(b):  # no word goes on over the end of a slice
            while end < len(b) and not len(found := np.flatnonzero(_SPACE[b[end : end + SLICE]])):
                end += SLICE
            end = min(len(b), end + int(found[0]) if end < len(b) else end)
        else:
            end = len(b)
        part = _LOWER[b[at:end]]
        inside = ~_SPACE[part]
        new = np.zeros(len(part) + 1, dtype=bool)
        new[edges[(edges >= at) & (edges <= end)] - at] = True
        before = np.concatenate(([False], inside[:-1])) & ~new[:-1]
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False])) & ~new[1:]
        ends = np.flatnonzero(inside & ~after) + 1
        if len(starts):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(part)))))
            places.append(starts + at)
            hashes.append(_mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(part))[starts], 0))
        at = end
    return np.concatenate(places), np.concatenate(hashes)


def _names(h: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: int) -> np.ndarray:
    """128-bit names of runs of hashes, a row of two for each."""
    if not len(starts):
        return np.zeros((0, 2), np.uint64)
    ends = np.cumsum(sizes)
    local = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    x = h[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
    out = []
    for k in range(2):
        power = _powers(_MIX[(first + 2 * k) % 4] | 1, int(sizes.max()))
        out.append(_mix(np.add.reduceat(_mix(x, k) * power[local], ends - sizes) + sizes.astype(np.uint64), first + k))
    return np.stack(out, axis=1)


class Paragraphs:
    """Lines and runs of the texts of an Arrow column."""

    def __init__(self, texts, least: int = LEAST_WORDS, lines: bool = True):
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        b = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        at, h = word_hashes(b, edges)
        n = len(h)
        self.words = h
        #: The texts in lower case, the first byte of each word, and the number of bytes at the end.
        self.bytes, self.at = b, np.append(at, len(b))
        #: The first word of each text, and the number of all at the end.
        self.first = np.searchsorted(at, edges)
        text = np.repeat(np.arange(len(edges) - 1), np.diff(self.first))
        # runs
        cut = np.zeros(0, np.int64)
        if n > 2 * RADIUS + 1:
            pair = _mix(h[:-1] * np.uint64(3) + h[1:], 0)
            near = pair[: len(pair) - RADIUS + 1].copy()
            for k in range(1, RADIUS):
                np.minimum(near, pair[k : len(pair) - RADIUS + 1 + k], out=near)
            p = np.arange(RADIUS, len(pair) - RADIUS)
            p = p[(pair[p] < near[p - RADIUS]) & (pair[p] < near[p + 1])]
            cut = p[(p - self.first[text[p]] >= RADIUS) & (self.first[text[p] + 1] - 2 - p >= RADIUS)] + 1
        self.runs = np.unique(np.concatenate((self.first[:-1][np.diff(self.first) > 0], cut)))
        self.run_sizes = np.diff(self.runs, append=n)
        self.run_text = text[self.runs]
        self.run_names = _names(h, self.runs, self.run_sizes, 0)
        if not lines:
            return
        # lines of enough words
        row = np.searchsorted(np.flatnonzero(b == 10), at)
        new = np.ones(n, dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(starts, append=n)
        some = sizes >= max(least, WIDTH)
        self.lines, self.line_sizes = starts[some], sizes[some]
        self.line_text = text[self.lines]
        self.line_names = _names(h, self.lines, self.line_sizes, 1)
        self.shingle_counts = self.line_sizes - WIDTH + 1
        self.shingle_ends = np.cumsum(self.shingle_counts)
        if not len(self.lines):
            self.shingles, self.bands = np.zeros(0, np.uint64), np.zeros((0, BANDS), np.uint64)
            return
        s = h[: n - WIDTH + 1].copy()
        for k in range(1, WIDTH):
            s = s * np.uint64(_P) + h[k : n - WIDTH + 1 + k]
        before = self.shingle_ends - self.shingle_counts
        self.shingles = _mix(s[np.repeat(self.lines - before, self.shingle_counts) + np.arange(self.shingle_ends[-1])], 1)
        rows = [np.minimum.reduceat((self.shingles ^ np.uint64(_MIX[k % 4] >> 7 + k)) * np.uint64(_MIX[(k + 1) % 4] + 2 * k), before) for k in range(BANDS * ROWS)]
        self.bands = np.stack([_mix(rows[ROWS * j] * np.uint64(3) + rows[ROWS * j + 1] + np.uint64(j), 2) for j in range(BANDS)], axis=1)


def _binary(names: np.ndarray):
    """An Arrow column of 16-byte values."""
    import pyarrow as pa

    data = np.ascontiguousarray(names).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(np.arange(0, len(data) + 1, 16, dtype=np.int32).tobytes()), pa.py_buffer(data)])


def _place(row: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(row.view(np.uint64) + _mix(word.astype(np.uint64), 1), 3)


def _counted(least: int):
    """Of every text: (run, place), (line, place) and (band value, line) as key and seen."""

    def values(batches):
        import pyarrow as pa

        for batch in by_size(batches, 1):
            p, row = Paragraphs(batch.column(1), least), batch.column(0).field(0).to_numpy()
            keys = [p.run_names[:, 0], p.line_names[:, 0], p.bands.ravel()]
            seen = [_place(row[p.run_text], p.runs - p.first[p.run_text]), _place(row[p.line_text], p.lines - p.first[p.line_text]), np.repeat(p.line_names[:, 1], BANDS)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (keys, seen)], names=["key", "seen"])

    return values


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def bucket_links(ids: list, sets: list[np.ndarray], threshold: float = THRESHOLD) -> list[tuple]:
    """Links of a spanning forest of the pairs at the threshold or above; candidates share one of the first shingles in a common order.

    Members that are linked already are passed over as a whole, so a bucket of many near copies costs little more than its size.
    """
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out, lists = [], {}
    for i in sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i])):
        s, seen = sets[i], set()
        mine = set(s.tolist())
        least = int(np.ceil(threshold * len(s) - 1e-9))
        # prefix filter: two sets at the threshold share one of their first n - ceil(t * n) + 1 members
        prefix = s[: len(s) - least + 1].tolist()
        for x in prefix:
            # members by the root that they had; roots that became one are put together on the way
            for r in list(lists.get(x, ())):
                if (now := find(r)) == find(i):
                    continue
                for j in lists[x][r]:
                    if j not in seen and len(sets[j]) >= least:
                        seen.add(j)
                        shared = len(mine.intersection(sets[j].tolist()))
                        if shared >= threshold * (len(s) + len(sets[j]) - shared):
                            root[find(i)] = now
                            out.append((ids[i], ids[j]))
                            break
        top = find(i)
        for x in prefix:
            of = lists.setdefault(x, {})
            of.setdefault(top, []).append(i)
            if len(of) > 1:
                for r in [r for r in of if r != find(r)]:
                    of.setdefault(find(r), []).extend(of.pop(r))
    return out


def _links(batches):
    import pyarrow as pa

    def out(rows):
        found = bucket_links([r[1] for r in rows], [np.array(r[2], dtype=np.int64) for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in range(2)], names=["u", "v"])

    now = []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if now and r[0] != now[-1][0]:
                if len(now) > 1:
                    yield out(now)
                now = []
            now.append((r[0], r[1], np.array(r[2], dtype=np.int64)))
    if len(now) > 1:
        yield out(now)


def beside(p: Paragraphs, text: np.ndarray, k: np.ndarray, side: np.ndarray) -> list[bytes]:
    """The words beside run k of each text, in lower case, before (side 0) or after it.

    They go ``RADIUS + 1`` words past the neighbour's far cut: were more of them shared, the cut would be too, and the neighbour equal.
    """
    starts, i = np.append(p.runs, len(p.words)), np.searchsorted(p.run_text, text) + k
    begin, end = p.first[text], p.first[text + 1]
    first = np.where(side == 1, np.minimum(starts[np.minimum(i + 1, len(starts) - 1)], end), np.maximum(begin, starts[np.maximum(i - 1, 0)] - RADIUS - 1))
    last = np.where(side == 1, np.minimum(end, starts[np.minimum(i + 2, len(starts) - 1)] + RADIUS + 1), starts[i])
    whole = p.bytes
    return [whole[a:z].tobytes().lower() for a, z in zip(p.at[first].tolist(), p.at[np.maximum(first, last)].tolist())]


def _beside(batches):
    import pyarrow as pa

    for batch in by_size(batches, 1):
        asked = batch.column(2)
        text = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
        k, side = (asked.flatten().field(i).to_numpy() for i in range(2))
        words = beside(Paragraphs(batch.column(1), lines=False), text, k.astype(np.int64), side)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), pa.array(k, pa.int32()), pa.array(side, pa.int32()), pa.array(words, pa.binary())], names=["_row", "_k", "_side", "words"])


def shared_words(a: bytes, b: bytes, side: int) -> int:
    """Words that both begin with (side 1) or end with (side 0)."""
    x, y = a.split(), b.split()
    if not side:
        x.reverse()
        y.reverse()
    n = 0
    for v, w in zip(x, y):
        if v != w:
            break
        n += 1
    return n


def _joined(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans that touch or overlap as one: row, first and end of each, and the one that every span belongs to."""
    order = np.lexsort((a, row))
    r, x, y = row[order], a[order], b[order]
    wide = np.int64(1 << 40)
    reach = np.maximum.accumulate(y + r * wide) - r * wide
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] > reach[:-1])
    first = np.flatnonzero(new)
    of = np.empty(len(r), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    end = reach[np.append(first[1:], len(r)) - 1] if len(r) else reach
    return r[first], x[first], end, of


def passages(row, k, first, n, stays, doc, side, ext, rows: int, least: int = LEAST_WORDS) -> tuple:
    """What goes of each of ``rows`` texts: its marked paragraphs, runs longer by the words shared beside them, where they join to ``least`` words or more.

    The arrays hold paragraphs (side -1; lines with k -1) and what runs grow by (side 0 or 1). Gives n_repeated, n_removed and
    n_paragraphs_removed of each text, the spans that go (row, first, end) and the doc_ids of what stays for them (row, doc_id).
    """
    marked = side < 0
    a, b, name = first[marked].copy(), (first + n)[marked], (row * (1 << 32) + k)[marked]
    for s in (0, 1):
        grown = side == s
        key, far = (row * (1 << 32) + k)[grown], ext[grown]
        order = np.lexsort((far, key))
        key, far = key[order], far[order]
        at = np.searchsorted(key, name, side="right") - 1
        hit = (at >= 0) & (k[marked] >= 0)
        hit[hit] &= key[at[hit]] == name[hit]
        if s:
            b[hit] += far[at[hit]]
        else:
            a[hit] -= far[at[hit]]
    row, stays, doc = row[marked], stays[marked], doc[marked]
    # rows that are equal give equal spans
    _, once = np.unique(np.stack((row, k[marked], a, b)), axis=1, return_index=True)
    row, a, b, stays, doc = (x[once] for x in (row, a, b, stays, doc))
    r, x, y, of = _joined(row, a, b)
    enough = y - x >= least
    repeated = np.bincount(r[enough], weights=(y - x)[enough], minlength=rows).astype(np.int64)
    go = enough[of] & ~stays if len(of) else np.zeros(0, dtype=bool)
    r, x, y, _ = _joined(row[go], a[go], b[go])
    removed = np.bincount(r, weights=y - x, minlength=rows).astype(np.int64)
    seen = np.unique(np.stack((row[go], doc[go])), axis=1)
    return repeated, removed, np.bincount(row[go], minlength=rows), (r, x, y), seen[:, seen[1] != NO_DOC]


def _passages(least: int):
    def merge(batches):
        import pyarrow as pa

        def lists(row, values, rows):
            return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), values)

        for batch in batches:
            x, rows = batch.column(1), batch.num_rows
            cells = x.flatten()
            row = np.repeat(np.arange(rows), np.diff(x.offsets.to_numpy()))
            k, first, n, stays, doc, side, ext = (cells.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7))
            repeated, removed, paragraphs, (r, a, b), seen = passages(row, k, first, n, stays > 0, doc, side, ext, rows, least)
            spans = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b - a, pa.int64())], names=["first_word", "n_words"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(repeated), pa.array(removed), pa.array(paragraphs, pa.int64()), lists(seen[0], pa.array(seen[1], pa.int64()), rows), lists(r, spans, rows)], names=["_row", "n_repeated", "n_removed", "n_paragraphs_removed", "first_doc_ids", "gone"])

    return merge


def found(docs: DataFrame, work: Work, least: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Runs (row, doc_id, k, first_word, n_words, unit) and lines (the same without k, with bands and shingles) that may occur again."""
    from .suffix_dedup import _bits

    keyed = docs.select(row_key(docs).alias("row"), F.col("doc_id").cast("long"), "text")
    again = keyed.select("row", "text").mapInArrow(lean(_counted(least)), "key long, seen long").groupBy("key").agg(F.min("seen").alias("a"), F.max("seen").alias("z"))
    again = work.write(again.filter("a <> z").select("key"), "again")
    bits = min(25, max(16, int(8 * again.count()).bit_length()))  # 4 MB at most
    held = docs.sparkSession.sparkContext.broadcast(_bits(again, bits))
    work.drop(again)
    schema = f"row {KEY}, doc_id long, k int, first_word long, n_words long, unit binary, bands array<long>, shingles array<long>"

    def pick(batches):
        import pyarrow as pa

        names = ["row", "doc_id", "k", "first_word", "n_words", "unit", "bands", "shingles"]
        on = lambda k: (held.value[(k.view(np.int64) & ((1 << bits) - 1)) >> 6] >> (k.view(np.int64) & 63)) & 1 == 1
        longs = pa.list_(pa.int64())
        for batch in by_size(batches, 2):
            p = Paragraphs(batch.column(2), least)
            i = np.flatnonzero(on(p.run_names[:, 0]))
            at = p.run_text[i]
            k = i - np.searchsorted(p.run_text, at)  # the place among the runs of its text
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(k, pa.int32()), pa.array(p.runs[i] - p.first[at]), pa.array(p.run_sizes[i]), _binary(p.run_names[i]), pa.nulls(len(i), longs), pa.nulls(len(i), longs)], names=names)
            near = on(p.bands.ravel()).reshape(p.bands.shape)
            i = np.flatnonzero(on(p.line_names[:, 0]) | near.any(axis=1))
            at, near = p.line_text[i], near[i]
            bands = [x[y].tolist() for x, y in zip(p.bands[i].view(np.int64), near)]
            sets = [np.unique(p.shingles[z - n : z].view(np.int64)) if y else None for z, n, y in zip(p.shingle_ends[i].tolist(), p.shingle_counts[i].tolist(), near.any(axis=1).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.nulls(len(i), pa.int32()), pa.array(p.lines[i] - p.first[at]), pa.array(p.line_sizes[i]), _binary(p.line_names[i]), pa.array(bands, longs), pa.array(sets, longs)], names=names)

    units = work.write(keyed.mapInArrow(lean(pick), schema), "units")
    return units.filter("k is not null").drop("bands", "shingles"), units.filter("k is null").drop("k")


def classes(lines: DataFrame, work: Work) -> DataFrame:
    """unit and first (doc_id, row, first_word) of the lines that have an equal or near-equal one at another place."""
    place = F.struct("doc_id", "row", "first_word")
    distinct = work.write(lines.groupBy("unit").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles")), "distinct")
    # only buckets with several different lines need their shingles
    slim = distinct.select(F.explode("bands").alias("key"), "unit")
    several = slim.groupBy("key").agg(F.min("unit").alias("a"), F.max("unit").alias("z")).filter("a <> z").select("key")
    members = work.write(slim.join(several.hint("merge"), "key"), "members")
    by_band = members.join(distinct.select("unit", "shingles").hint("merge"), "unit").select("key", "unit", "shingles").repartition("key").sortWithinPartitions("key", "unit")
    links = work.write(by_band.mapInArrow(lean(_links), "u binary, v binary"), "pairs")
    component = connected(links, work)
    named = distinct.select("unit", "first", "last").join(component, F.col("unit") == F.col("node"), "left").select("unit", "first", "last", F.coalesce("component", "unit").alias("component"))
    named = work.write(named, "named")
    groups = named.groupBy("component").agg(F.min("first").alias("first"), F.max("last").alias("last")).filter("first <> last").select("component", "first")
    out = work.write(named.select("unit", "component").join(groups.hint("merge"), "component").select("unit", "first"), "classes")
    work.drop(distinct, members, links, named)
    return out


def marks(docs: DataFrame, work: Work, least: int = LEAST_WORDS) -> DataFrame:
    """_row, n_repeated, n_removed, n_paragraphs_removed, first_doc_ids and gone (first_word, n_words) of each text with repeated passages."""
    runs, lines = found(docs, work, least)
    of_line = classes(lines, work)
    doc = F.coalesce("first.doc_id", F.lit(NO_DOC)).alias("doc")
    same = (F.col("row") == F.col("first.row")) & (F.col("first_word") == F.col("first.first_word"))
    lines = lines.select("row", "first_word", "n_words", "unit").join(of_line.hint("merge"), "unit").select("row", "first_word", "n_words", same.alias("stays"), doc)
    place = F.struct("doc_id", "row", "k")
    firsts = runs.groupBy("unit").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("unit", "first")
    stays = (F.col("row") == F.col("first.row")) & (F.col("k") == F.col("first.k"))
    rows = work.write(runs.drop("doc_id").join(firsts.hint("merge"), "unit").select("row", "k", "first_word", "n_words", stays.alias("stays"), doc, F.col("first.row").alias("to"), F.col("first.k").alias("to_k")), "rows")
    # The sides of a series of neighbouring repeated runs grow word by word, as far as beside the place that stays.
    # This place is always an earlier one, so of each word an equal one is left, even where a text loses part of what others refer to.
    by_row = Window.partitionBy("row").orderBy("k").rangeBetween(-1, 1)
    edges = rows.filter("not stays").select("row", "k", "to", "to_k", F.min("k").over(by_row).alias("lo"), F.max("k").over(by_row).alias("hi"))
    sides = F.explode(F.array_compact(F.array(F.when(F.col("lo") == F.col("k"), 0), F.when(F.col("hi") == F.col("k"), 1)))).alias("side")
    edges = work.write(edges.select("row", "k", "to", "to_k", sides).distinct(), "edges")
    asked = edges.select("row", "k", "side").union(edges.select("to", "to_k", "side").distinct()).groupBy("row").agg(F.collect_set(F.struct("k", "side")).alias("asked"))
    texts = docs.select(row_key(docs).alias("_row"), "text").join(asked.hint("merge"), F.col("_row") == F.col("row")).select("row", "text", "asked")
    near = work.write(texts.mapInArrow(lean(_beside), f"_row {KEY}, _k int, _side int, words binary"), "beside").dropDuplicates(["_row", "_k", "_side"])
    mine = edges.join(near.hint("merge"), (F.col("row") == F.col("_row")) & (F.col("k") == F.col("_k")) & (F.col("side") == F.col("_side"))).select("row", "k", "side", "to", "to_k", F.col("words").alias("mine"))
    grow = F.udf(shared_words, "int", useArrow=True)
    met = mine.join(near.hint("merge"), (F.col("to") == F.col("_row")) & (F.col("to_k") == F.col("_k")) & (F.col("side") == F.col("_side")))
    met = work.write(met.select("row", "k", "side", "to", "to_k", grow("mine", "words", "side").alias("ext")).filter("ext > 0"), "grown")
    grown = met.select("row", "k", "side", "ext").union(met.groupBy("to", "to_k", "side").agg(F.max("ext")))
    none = F.lit(-1).alias
    of_run = rows.select("row", F.struct("k", "first_word", "n_words", "stays", "doc", none("side"), none("ext")).alias("x"))
    of_line = lines.select("row", F.struct(none("k"), "first_word", "n_words", "stays", "doc", none("side"), none("ext")).alias("x"))
    big = lambda name: F.lit(0).cast("long").alias(name)
    of_side = grown.select("row", F.struct("k", big("first_word"), big("n_words"), F.lit(False).alias("stays"), big("doc"), "side", "ext").alias("x"))
    items = of_run.union(of_line).union(of_side).groupBy("row").agg(F.collect_list("x").alias("x"))
    schema = f"_row {KEY}, n_repeated long, n_removed long, n_paragraphs_removed long, first_doc_ids array<long>, gone array<struct<first_word long, n_words long>>"
    out = work.write(items.mapInArrow(lean(_passages(least)), schema), "marks")
    work.drop(rows, edges, met)
    return out


def report(docs: DataFrame, work: Work) -> DataFrame:
    """A row for each document: its words, those in repeated passages, those removed, and where these were seen first."""
    n = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    marked = marks(docs, work).select("_row", "n_repeated", "n_removed", "n_paragraphs_removed", "first_doc_ids")
    rows = docs.select("doc_id", n.alias("n_words"), row_key(docs).alias("row")).join(marked.hint("merge"), F.col("row") == F.col("_row"), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_repeated", "n_removed", "n_paragraphs_removed")]
    return rows.select("doc_id", "n_words", *zero, F.coalesce("first_doc_ids", F.array().cast("array<bigint>")).alias("first_doc_ids"))


def dedup(docs: DataFrame, work: Work) -> DataFrame:
    """The documents without the words of removed paragraphs; other columns as they were."""
    gone = marks(docs, work).select("_row", F.col("gone").alias("_gone")).filter(F.size("_gone") > 0)

    @F.udf("string", useArrow=True)
    def cut(text, gone):
        if not gone:
            return text
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        out, at = [], 0
        for g in sorted(gone, key=lambda g: g["first_word"]):
            last = g["first_word"] + g["n_words"]
            out.append(text[at : words[g["first_word"]].start()])
            at = words[last].start() if last < len(words) else len(text)
        return "".join([*out, text[at:]])

    joined = boxed(docs, "doc_id", "text").withColumn("_key", row_key(docs)).join(gone.hint("merge"), F.col("_key") == F.col("_row"), "left")
    return unboxed(joined, docs.columns, text=cut("text", "_gone"))


def op1_paragraph_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents."""
    return report(table(spark, sf_dir, "documents"), Work(spark, "paragraphs"))
