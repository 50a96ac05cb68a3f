"""SimHash near-duplicates by a self-join of a binary trie over the fingerprints.

Fingerprints: A-Z lower-cased, words between ASCII white space, shingles of three words with
repeats, XXH64 with seed 42 of each; a bit is set where over half of the hashes have it. Texts of fewer
words have one shingle; null texts and texts without words have fingerprint zero, and are linked
like any other. Rows with equal fingerprints stand as one in all that follows.

The join walks pairs of trie nodes together from the root, adds up the bits in which their prefixes
differ, and drops a pair beyond the error budget. The upper levels of the trie hold counts only
(``TOP`` bits, a bounded table), and are walked on the driver until both nodes are small; each pair
of such nodes becomes the work of one group, which walks the levels below with numpy. A group gives
back a spanning forest of the links that it found, not all of them, so that a thousand near copies do
not give a million rows. Components come from the forests of all groups.

Ties: a component is named by its least doc_id. Repeated doc_ids give a row each. An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, Work, boxed, row_key, table, unboxed
from .components import connected

SHINGLE = 3
BUDGET = 2
TOP = 16
LEAF = 1 << 15
#: Node pairs that are walked at a time within a group.
FRONT = 1 << 20


def fingerprint(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < SHINGLE:
        return xxh64_intdigest(b" ".join(w), 42)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(w) - SHINGLE + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        spans = zip(starts[at : min(n, at + 65536)].tolist(), ends[SHINGLE - 1 :][at : at + 65536].tolist())
        h = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype=">u8")
        counts += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the row) and f, the fingerprint as a signed 64-bit number."""

    def make(batches):
        import pyarrow as pa

        for batch in batches:
            f = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(f)], names=["doc_id", "key", "f"])

    return docs.select(F.col("doc_id").cast("long"), "text", row_key(docs).alias("key")).mapInArrow(make, f"doc_id long, key {KEY}, f long")


def top_pairs(counts: dict[int, int], bits: int, leaf: int, budget: int) -> list[tuple[int, int, int, int]]:
    """Walks the counted levels: (depth, prefix, depth, prefix) of node pairs in budget that are small or at the bottom."""
    levels = [{} for _ in range(bits + 1)]
    levels[bits] = dict(counts)
    for depth in range(bits, 0, -1):
        for prefix, n in levels[depth].items():
            levels[depth - 1][prefix >> 1] = levels[depth - 1].get(prefix >> 1, 0) + n
    done = lambda d, p: d == bits or levels[d][p] <= leaf
    below = lambda d, p: [(d, p)] if done(d, p) else [(d + 1, c) for c in (2 * p, 2 * p + 1) if c in levels[d + 1]]
    out, todo = [], [((0, 0), (0, 0))] if counts else []
    while todo:
        a, b = todo.pop()
        if done(*a) and done(*b):
            out.append((*a, *b))
            continue
        for i in below(*a):
            for j in below(*b):
                d = min(i[0], j[0])
                if (a != b or i <= j) and ((i[1] >> (i[0] - d)) ^ (j[1] >> (j[0] - d))).bit_count() <= budget:
                    todo.append((i, j))
    return out


def trie_links(f: np.ndarray, g: np.ndarray, same: bool, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between sorted distinct fingerprints f and g (the same array: each pair once), thinned to a forest."""
    values = f if same else np.concatenate([f, g])
    shift = 0 if same else len(f)
    root = np.arange(len(values))

    def join(a, b):
        while len(a):
            x, y = root[a], root[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            new = lo < hi
            a, b, lo, hi = a[new], b[new], lo[new], hi[new]
            if not len(a):
                return
            np.minimum.at(root, hi, lo)
            while (root != root[root]).any():
                root[:] = root[root]

    # a node is a depth and a range of a sorted array; pairs: (a's range, b's range, depth, bits that differ)
    first = np.array([[0, len(f), 0, len(g), 0, 0]], dtype=np.int64)
    todo = [first]
    while todo:
        front = todo.pop()
        if len(front) > FRONT:
            todo += [front[FRONT:], front[:FRONT]]
            continue
        a0, a1, b0, b1, depth, spent = front.T
        small = (a1 - a0) * (b1 - b0) <= 4
        for i in range(4):
            for j in range(4):
                ok = small & (a0 + i < a1) & (b0 + j < b1)
                x, y = a0[ok] + i, b0[ok] + j
                if same:
                    x, y = x[x < y], y[x < y]
                near = np.bitwise_count(f[x] ^ g[y]) <= budget
                join(x[near], y[near] + shift)
        front = front[~small]
        if not len(front):
            continue
        a0, a1, b0, b1, depth, spent = front.T
        bit = (63 - depth).astype(np.uint64)
        am, bm = _middle(f, a0, a1, bit), _middle(g, b0, b1, bit)
        new = []
        for lo, hi, lo2, hi2, cost in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            ok = (lo < hi) & (lo2 < hi2) & (spent + cost <= budget)
            if same:
                ok &= ~((lo >= hi2) & (cost == 1))  # of a node with itself the mirrored pair goes
            new.append(np.stack([lo, hi, lo2, hi2, depth + 1, spent + cost], axis=1)[ok])
        todo.append(np.concatenate(new))
    child = np.flatnonzero(root != np.arange(len(values)))
    return values[child], values[root[child]]


def _middle(f: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where the bit turns to one within each range of a sorted array whose members share all bits above."""
    head = (f[lo] >> bit) | np.uint64(1)
    at = np.searchsorted(f, head << bit)
    return np.clip(at, lo, hi)


def links(prints: DataFrame, work: Work, budget: int = BUDGET, leaf: int = LEAF) -> DataFrame:
    """Links u, v between distinct fingerprints (column f): for each group of node pairs a spanning forest."""
    prints = prints.select("f")
    top = F.shiftrightunsigned("f", 64 - TOP)
    counts = {r.p: r["count"] for r in prints.groupBy(top.alias("p")).count().collect()}  # up to 2**TOP rows
    ends: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for k, (d1, p1, d2, p2) in enumerate(top_pairs(counts, TOP, leaf, budget)):
        ends.setdefault((d1, p1), []).append((k, 0))
        if (d1, p1) != (d2, p2):
            ends.setdefault((d2, p2), []).append((k, 1))
    leaf_of = np.full(1 << TOP, -1, dtype=np.int64)
    groups = []
    for k, ((d, p), mine) in enumerate(ends.items()):
        leaf_of[p << (TOP - d) : (p + 1) << (TOP - d)] = k
        groups.append(np.array(mine, dtype=np.int64))

    def deal(batches):
        import pyarrow as pa

        # what a task has for one side of a node pair travels in one row
        for batch in batches:
            f = batch.column(0).to_numpy()
            of = leaf_of[(f.view(np.uint64) >> np.uint64(64 - TOP)).astype(np.int64)]
            for k in np.unique(of):
                pair, side = groups[k].T
                mine = f[of == k].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(side), pa.array([mine] * len(pair), pa.binary())], names=["pair", "side", "f"])

    def walk(batch):
        import pyarrow as pa

        both = ([], [])
        for side, f in zip(batch.column("side").to_pylist(), batch.column("f").to_pylist()):
            both[side].append(np.frombuffer(f, dtype=np.uint64))
        f, g = (np.sort(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in both)
        u, v = trie_links(f, f, True, budget) if not both[1] else trie_links(f, g, False, budget)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    return prints.mapInArrow(deal, "pair long, side long, f binary").groupBy("pair").applyInArrow(walk, "u long, v long")


def near_duplicates(docs: DataFrame, work: Work, budget: int = BUDGET, keyed: bool = False) -> DataFrame:
    """doc_id, fingerprint and component_id of every row; ``keyed``: and its row key."""
    rows = work.write(fingerprints(docs), "fingerprints")
    prints = work.write(rows.groupBy("f").agg(F.min("doc_id").alias("least")), "distinct")
    found = connected(links(prints, work, budget), work)
    named = prints.join(found, F.col("f") == F.col("node"), "left").select("f", "least", F.coalesce("component", "f").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = work.write(named.join(least, "component").select("f", "component_id"), "components")
    return rows.join(of, "f").select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id", *["key"] * keyed)


def keep_one(docs: DataFrame, work: Work) -> DataFrame:
    """The documents without those that are near another with a smaller doc_id; columns as they were.

    Rows without a doc_id stay, and so do all rows that have the doc_id that stays.
    """
    near = near_duplicates(docs.select("doc_id", "text"), work, keyed=True)
    gone = work.write(near.filter("doc_id <> component_id").select("key").distinct(), "gone")
    rows = boxed(docs, "doc_id", "text").withColumn("_key", row_key(docs))
    return unboxed(rows.join(gone.hint("merge"), F.col("_key") == F.col("key"), "left_anti"), docs.columns)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"), Work(spark, "simhash"))
