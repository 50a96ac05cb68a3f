"""The training-data operators against brute force, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import bpe, components, decontamination, line_dedup, packing, paragraph_dedup, quality, simhash, suffix_dedup, token_files, toxicity, zip_archive
from millrace.llm.common import Work

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, sep=" "):
    return sep.join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(12)]
    shared = prose(rng, 60)
    texts = [None, "", " \n\t", "one", "two words", base[0], base[0], base[0].replace(" ", "\n", 5), base[1] + "\n" + shared, base[2][:200] + " " + shared + " " + base[3], "la " * 400, prose(rng, 4000), "é à ñ 日本 <|endoftext|>  x", *base[4:]]
    texts += [" ".join(w if i != 9 else "changed" for i, w in enumerate(base[5].split()))]
    rows = [(i, t, [None, "en", "de"][i % 3], ["s", None][i % 2], None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base[6], None, None, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns with the names that operators use inside."""
    for name in ("_d", "m", "_w", "_l", "_key", "_row", "_gone", "row", "h", "key", "k", "item", "f", "kept", "_id", "node"):
        df = df.withColumn(name, F.lit(name))
    return df


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- 10


def test_quality_counts(spark, docs, empty):
    got = Counter(map(tuple, quality.verdicts(docs, Work(spark, "q")).collect()))
    for doc, text, *_ in corpus():
        w = words(text)
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        found = [k for k in got if k[:7] == (doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), base)]
        assert found and (not base or not found[0][7])
    assert sum(got.values()) == len(corpus()) and quality.verdicts(empty, Work(spark, "q")).count() == 0


def test_quality_fences_and_stage(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 40), "en", "s", 0) for i in range(40)] + [(99, prose(rng, 40, "*** "), "en", "s", 0)]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    kept = quality.keep(df, Work(spark, "q"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(range(40))
    assert {r.m for r in kept.collect()} == {"m"}


# --- 8


def test_line_chunks(spark, docs, empty):
    rng = random.Random(2)
    block = [prose(rng, 6) for _ in range(30)]
    rows = [(1, "\n".join(block)), (2, "\n".join([prose(rng, 5), *block, prose(rng, 5)])), (3, "\n".join(prose(rng, 5) for _ in range(20))), (4, None), (5, ""), (5, ""), (6, "\n\n\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.dedup(df, Work(spark, "l"), report=True).collect()}
    assert out[1].n_removed == 0 and out[1].text == rows[0][1] and out[3].n_removed == 0
    assert out[2].n_removed > 15 and out[2].first_doc_ids == [1]
    assert out[4].text is None and out[5].text == "" and out[6].text == "\n\n\n\n"
    left = out[2].text.split("\n")
    assert len(left) == 32 - out[2].n_removed and left[0] == rows[1][1].split("\n")[0] and left[-1] == rows[1][1].split("\n")[-1]
    df = clashing(docs)
    again = line_dedup.dedup(df, Work(spark, "l"))
    assert again.columns == df.columns and again.count() == len(corpus()) and {r.row for r in again.collect()} == {"row"}
    assert line_dedup.dedup(empty, Work(spark, "l")).count() == 0


def test_repeated_lines_go_to_their_ends(spark):
    rng = random.Random(13)
    rows, n = [], 12
    for i in range(60):
        block = [prose(rng, 6) for _ in range(n)]
        rows += [(2 * i + j, "\n".join([*(prose(rng, 5) for _ in range(6)), *block, *(prose(rng, 5) for _ in range(6))])) for j in range(2)]
    df = spark.createDataFrame([*rows, (500, rows[0][1]), (501, rows[3][1])], "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.dedup(df, Work(spark, "l"), report=True).collect()}
    assert all(out[2 * i].n_removed == 0 and out[2 * i + 1].n_removed in (0, n) for i in range(60))
    assert sum(out[2 * i + 1].n_removed == n for i in range(60)) >= 50
    # of exact copies nothing is left
    assert out[500].text == out[501].text == "" and out[500].n_removed == n + 12
    for i in range(60):
        if out[2 * i + 1].n_removed:
            lines = rows[2 * i + 1][1].split("\n")
            assert out[2 * i + 1].text.split("\n") == [*lines[:6], *lines[-6:]]
    sizes = [[len(c) for c in r[0]] for r in df.select(line_dedup.chunks(F.col("text"))).collect()]
    assert all(min(s[:-1], default=2) >= 2 for s in sizes)


def test_chunks_keep_every_line(spark):
    texts = ["a", "a\nb", "", "\n", "\n".join(str(i) for i in range(100))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for t, c in df.select("text", line_dedup.chunks(F.col("text"))).collect():
        assert "\n".join(line for chunk in c for line in chunk) == t


# --- 3


def brute_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.BUDGET:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def brute_print(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, empty):
    rows = corpus()
    prints = [brute_print(r[1]) for r in rows]
    root = brute_components(prints)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = Counter((r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root))
    got = simhash.near_duplicates(docs, Work(spark, "s"))
    assert Counter(map(tuple, got.collect())) == want
    df = clashing(docs)
    kept = simhash.keep_one(df, Work(spark, "s"))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for (d, _, c), n in want.items() for _ in range(n) if d is not None and d == c)
    assert simhash.near_duplicates(empty, Work(spark, "s")).count() == 0


@pytest.mark.parametrize("leaf", [2, 50])
def test_trie_join_over_many_nodes(spark, leaf):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(int(k))) for b in base[:30] for k in rng.integers(0, 64, 4)]
    f = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "f long").repartition(3)
    work = Work(spark, "t")
    found = {r.node: r.component for r in components.connected(simhash.links(df, work, leaf=leaf), work).collect()}
    root = brute_components([int(x) for x in f])
    s = [int(x) for x in f.view(np.int64)]
    mine = [found.get(x, x) for x in s]
    assert [mine.index(m) for m in mine] == [root.index(r) for r in root]


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, None), (300, 301), (300, 301)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in components.connected(df, Work(spark, "c")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 300: 300, 301: 300}
    assert components.connected(df.limit(0), Work(spark, "c")).count() == 0


# --- 9


def test_decontamination(spark, docs, empty):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate((4, 5, 12, 30, 80, 300))] + [(50, None), (51, ""), (52, None)]
    items += [(60, items[3][1].upper())]
    filler = [prose(rng, 300) for _ in range(4)]
    half = " ".join(items[3][1].split()[:15])
    rows = [(1, f"{filler[0]} {items[3][1]}, {filler[1]}"), (2, items[4][1].replace(" ", "\n")), (3, filler[2] + half), (4, f"{items[1][1]} {items[2][1]}"), (5, None), (5, items[5][1]), (None, items[5][1]), (6, " ".join(w for i, w in enumerate(items[4][1].split()) if i != 40))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("h", F.lit(1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in decontamination.contaminated(df, bench, Work(spark, "d")).collect()}

    def shingles(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {}
    for d, t in rows:
        for i, x in items[:6]:
            if s := shingles(x):
                if (c := len(s & shingles(t)) / len(s)) >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), round(c, 6))
    assert got == want and (1, 3) in want and (6, 4) in want and (3, 3) not in want
    kept = decontamination.clean(clashing(df), bench, Work(spark, "d"))
    assert [(r.doc_id, r.text) for r in kept.orderBy("doc_id").collect()] == [(3, rows[2][1]), (5, None)]
    assert decontamination.contaminated(empty, bench, Work(spark, "d")).count() == 0
    assert decontamination.clean(docs, bench.limit(0), Work(spark, "d")).count() == len(corpus())


def test_least_hits_never_misses_often():
    for size, k in decontamination.PARTITIONS[:-1]:
        for n in range(k, min(size, 400) + 1, 7):
            rng = np.random.default_rng(n)
            good = -(-int(0.8 * 1000) * n // 1000)
            draws = rng.hypergeometric(good, n - good, min(n, k), 2000) if n > good else np.full(10, k)
            assert (draws < decontamination.least_hits(n, k)).mean() < 1e-3


# --- 4 and 7


def ids_of(text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_units_encode_as_the_whole_text():
    e = bpe.Encoder(bpe.default_path(), kept=20)
    texts = ["", " ", "a  b", "a b ", " a", "\na\n", "don't we're\nx", "it 's 12,3 x", "<|endoftext|> a", "a\r\nb", "日本 x", "x\ty z", "é à ñ½ ²", "a\n b", "***, x\n%%% y", None, *[t for _, t, *_ in corpus()]]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u2").tolist() for x in e.encode(texts)] == [ids_of(t, 0)[:-1].tolist() for t in texts]


def test_texts_with_nul_are_encoded_whole():
    e = bpe.Encoder(bpe.default_path(), kept=20)
    texts = ["a b", "a\0b", "\0", "a\0 b\0\nc", "\0a", "a\0"]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u2").tolist() for x in e.encode(texts)] == [ids_of(t, 0)[:-1].tolist() for t in texts]


def test_packing(spark, docs, empty):
    out = packing.pack(clashing(docs), Work(spark, "p"), bpe.default_path()).collect()
    want = Counter()
    for d, t, *_ in corpus():
        ids = ids_of(t, 2)
        n = len(ids)
        first = n if n <= 1024 else n % 1024 or 1024
        for i, a in enumerate([0, *range(first, n, 1024)]):
            piece = ids[a : a + (first if i == 0 else 1024)]
            want[d, i, a, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in out) == want
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty, Work(spark, "p"), bpe.default_path()).count() == 0


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    counts = Counter(rng.integers(1, 700, 5000).tolist())
    plan = packing.plan(counts, 1024)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 1024 and times > 0
        for x in pattern:
            used[x] += times
    assert used == counts
    bound = -(-sum(k * n for k, n in counts.items()) // 1024)
    assert sum(t for _, t in plan) <= 1.01 * bound
    assert packing.plan({}, 10) == [] and packing.plan({6: 1, 5: 2, 4: 1}, 10) == [([6, 4], 1), ([5, 5], 1)]


def test_two_smaller_pieces_take_the_place_of_one():
    # greedy: 6 with nothing for the gap of 4; 5 + 5 do not fit it, but replace the 6
    assert packing.plan({6: 1, 5: 2}, 10)[0] == ([5, 5], 1)


def test_token_files(spark, docs, empty):
    work = Work(spark, "f")
    manifest = token_files.write(clashing(docs), work, bpe.default_path(), 0)
    rows = token_files.read(manifest).orderBy("start").collect()
    ordered = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc, text, *_) in zip(rows, ordered, strict=True):
        ids = ids_of(text, 0)
        assert tuple(r) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.read(token_files.write(empty, work, bpe.default_path(), 0)).count() == 0


def test_checksums():
    assert [token_files.crc32c(x) for x in (b"", b"123456789", b"\0" * 32, b"\xff" * 32)] == [0, 0xE3069283, 0x8A9136AA, 0x62A8AB43]
    parts = [bytes(range(n % 256)) * (n // 99 + 1) for n in range(0, 300, 7)]
    assert token_files.crc32c_many(parts).tolist() == [token_files.crc32c(p) for p in parts]
    (framed,) = token_files.frames([b"some data"])
    assert token_files.unframe([framed]) == [b"some data"]
    for i in range(len(framed)):
        broken = bytearray(framed)
        broken[i] ^= 4
        with pytest.raises(ValueError):
            token_files.unframe([bytes(broken)])


# --- 2


def test_zip_archives(spark, tmp_path):
    rows = [(3, "u3", "<p>x</p>"), (1, "u1", "<p>x</p>"), (2, None, None), (4, "u4", ""), (5, "u5", "é" * 70000), (5, "u5", "é" * 70000), (None, "u6", "<p>x</p>"), (7, "u 7", "ü")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("d", F.lit(1)).repartition(3)
    manifest = zip_archive.write(pages, Work(spark, "z"))
    out = zip_archive.read(spark, manifest, payload=True).collect()
    assert len(out) == len(rows)
    for r in out:
        same = [p for p, _, h in rows if p is not None and any((h or "") == (x or "") for q, _, x in rows if q == r.page_id)]
        html = next(h or "" for p, _, h in rows if p == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), zip_archive.digest(html))
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == min(same) else ("revisit", min(same)))
        assert r.payload is None or bytes(r.payload) == html
    assert zip_archive.read(spark, zip_archive.write(pages.limit(0), Work(spark, "z"))).count() == 0
    import zipfile

    for r in manifest.collect():
        with zipfile.ZipFile(r.path.removeprefix("file:")) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
    plain = tmp_path / "plain.zip"
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("a/b.txt", b"hello")
        z.writestr("c.txt", b"packed" * 50, zipfile.ZIP_DEFLATED)
        z.comment = b"a note"
    system, where = zip_archive.file_system(str(plain))
    with system.open_input_file(where) as f:
        inside = zip_archive.directory(f, f.size())
        assert list(inside) == ["a/b.txt"] and f.read_at(inside["a/b.txt"][1], inside["a/b.txt"][0]) == b"hello"


# --- 5 and 1


def test_suffix_dedup(spark, docs, empty):
    rows = corpus()
    raw = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = Counter()
    for d, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[d, len(b), int(gone.sum()), len(suffix_dedup.runs(gone)), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, suffix_dedup.dedup(clashing(docs), Work(spark, "x")).collect())) == want
    assert suffix_dedup.dedup(empty, Work(spark, "x")).count() == 0


def test_column_wise_construction():
    rng = random.Random(1)
    base = [bytes(rng.choice(b"ab ") for _ in range(150)) for _ in range(3)]
    strings = list({bytes(b) for b in ([*base[i % 3][i : i + 100]] for i in range(30)) if len(b) >= 40})
    strings += [s[:50] + b"#" + s[51:] for s in strings[:8]]
    seen = Counter(s[i : i + 40] for s in strings for i in range(len(s) - 39))
    for s, flags in zip(strings, suffix_dedup.repeated(strings, [1] * len(strings), 40)):
        assert flags.tolist() == [seen[s[i : i + 40]] > 1 for i in range(len(s) - 39)]
    assert all(suffix_dedup.repeated([strings[0]], [2], 40)[0])


def test_paragraph_dedup(spark, docs, empty):
    out = {}
    for r in paragraph_dedup.report(clashing(docs), Work(spark, "g")).collect():
        out.setdefault(r.doc_id, []).append(r)
    texts = {d: t for d, t, *_ in corpus()}
    assert sum(map(len, out.values())) == len(corpus())
    assert all(r.n_words == len(words(texts[d])) for d, rs in out.items() if d is not None for r in rs)
    assert out[5][0].n_removed == 0 and out[5][0].n_repeated > 0 and out[6][0].n_removed > 0.8 * out[6][0].n_words
    assert out[8][0].n_repeated >= 20 and out[9][0].n_removed >= 20 and 8 in out[9][0].first_doc_ids
    assert out[0][0].n_repeated == out[1][0].n_repeated == out[11][0].n_repeated == 0
    df = clashing(docs)
    left = paragraph_dedup.dedup(df, Work(spark, "g"))
    assert left.columns == df.columns and left.count() == len(corpus())
    nine = next(r.text for r in left.collect() if r.doc_id == 9)
    assert len(words(nine)) == out[9][0].n_words - out[9][0].n_removed
    assert paragraph_dedup.report(empty, Work(spark, "g")).count() == 0


def test_passages_grow_to_their_ends(spark):
    rng = random.Random(12)
    blocks = [prose(rng, 60) for _ in range(40)]
    rows = [(2 * i + j, f"{prose(rng, 80)} {b} {prose(rng, 80)}") for i, b in enumerate(blocks) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in paragraph_dedup.report(df, Work(spark, "g")).collect()}
    # all of a block or, where no paragraph lies within it, nothing
    assert sum(60 <= out[2 * i + 1].n_removed <= 62 for i in range(40)) >= 38
    assert all(out[2 * i + 1].n_removed in (0, 60, 61, 62) and out[2 * i].n_removed == 0 for i in range(40))
    assert all(abs(out[2 * i].n_repeated - out[2 * i + 1].n_repeated) <= 2 for i in range(40))
    left = {r.doc_id: words(r.text) for r in paragraph_dedup.dedup(df, Work(spark, "g")).collect()}
    assert all(len(left[d]) == 220 - out[d].n_removed for d in left)
    assert all(left[2 * i + 1][:70] == words(rows[2 * i + 1][1])[:70] for i in range(40))


def test_bucket_links_find_all_pairs():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1000, 20)) for _ in range(30)]
    sets += [np.unique(np.append(s[:-1], 5000 + i)) for i, s in enumerate(sets)]
    links = paragraph_dedup.bucket_links(list(range(len(sets))), sets)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert paragraph_dedup._jaccard(sets[a], sets[b]) >= 0.8
        root[find(a)] = find(b)
    for a in range(len(sets)):
        for b in range(a):
            if paragraph_dedup._jaccard(sets[a], sets[b]) >= 0.8:
                assert find(a) == find(b)


# --- 6


def test_toxicity(spark, empty):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        w = prose(rng, 30).split()
        if bad:
            w[3], w[9] = rng.choice([("vile", "nasty"), ("nasty", "vileness"), ("viler", "nasty")])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "Vile nasty"), (1002, "Vile nasty"), (None, "nasty vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit(1))
    known = spark.createDataFrame([*labels, (1000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, known, Work(spark, "v"))
    out = {r.doc_id: r for r in toxicity.score(docs, index).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i].held_out == (i in held) for i in range(300)) and not any(index.docs[k] in held for k in range(len(index.docs)))
    assert sum(out[i].predicted == labels[i][2] for i in held) >= 0.97 * len(held)
    assert out[1002].predicted == 1 and out[1000].predicted == out[1001].predicted == 0
    assert toxicity.score(empty, index).count() == 0
    nothing = toxicity.fit(docs, known.limit(0), Work(spark, "v"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(7)
    examples = [(i, int(rng.integers(2)), sorted(set(rng.integers(0, 40, 6).tolist())), None) for i in range(700)]
    examples = [(d, y, t, rng.integers(1, 5, len(t)).tolist()) for d, y, t, _ in examples]
    index = toxicity.Index([f"t{i}" for i in range(40)], rng.uniform(1, 5, 40).tolist(), examples, 0.1)
    dense = np.zeros((len(index.docs), 40))
    for t, (p, w) in enumerate(index.postings):
        dense[p, t] = w
    for _ in range(50):
        ids, w = index.weigh(dict(zip(rng.integers(0, 40, 5).tolist(), rng.integers(1, 4, 5).tolist())))
        places, cosines = index.nearest(ids, w)
        every = dense[:, ids] @ w
        want = np.lexsort((np.arange(len(every)), -np.round(every, 12)))[: toxicity.K]
        assert np.allclose(np.sort(cosines), np.sort(every[want])) and np.allclose(every[places], cosines)


def test_construction_by_wider_symbols():
    rng = random.Random(3)
    core = prose(rng, 12).encode()[:40]
    sides = [prose(rng, 12).encode()[:60] for _ in range(4)]
    parts = sorted({(sides[rng.randrange(4)][a:], sides[rng.randrange(4)][:b]) for a in range(0, 50, 7) for b in range(8, 60, 9)})
    strings, places = [x + core + y for x, y in parts], [len(x) for x, _ in parts]
    # windows that hold the core stand at one place to it, so every string's windows do
    need = 80
    strings, places = map(list, zip(*[(s, p) for s, p in zip(strings, places) if len(s) >= need]))
    seen = Counter((s[i : i + need], p - i) for s, p in zip(strings, places) for i in range(len(s) - need + 1))
    for s, p, flags in zip(strings, places, suffix_dedup.repeated(strings, [1] * len(strings), need, places)):
        assert flags.tolist() == [seen[s[i : i + need], p - i] > 1 for i in range(len(s) - need + 1)]
