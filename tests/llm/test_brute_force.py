"""Whole operators and the pipeline against brute-force versions, and the sizes and shapes that small corpora lack."""

import functools
import math
import random
import re
import statistics
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import bpe, common, decontamination, line_dedup, paragraph_dedup, quality, suffix_dedup, token_files, toxicity
from millrace.llm.common import Work
from tests.llm.test_operators import SCHEMA, brute_components, brute_print, clashing, corpus, prose, words

MASK = (1 << 64) - 1


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


def ids_of(text, end):
    return np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values, seed=42):
    """What Spark's xxhash64 gives for longs, strings and nulls."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little") if isinstance(v, int) else v.encode(), seed)
    return signed(seed)


# --- 8


def brute_chunks(text):
    """(lines before, lines) of each chunk."""
    lines = text.split("\n")
    h, ends = [spark_hash(x) for x in lines], [0]
    for i in range(line_dedup.SPAN, len(lines)):
        if spark_hash(*[h[i - 1 - k] for k in range(line_dedup.SPAN)]) % line_dedup.RATE == 0 and i - ends[-1] >= line_dedup.LEAST_LINES:
            ends.append(i)
    return [(a, lines[a:b]) for a, b in zip(ends, [*ends[1:], len(lines)])]


def brute_lines(rows):
    """The text that is left of each (doc_id, text), in order, and the doc_ids of what stays for it."""
    chunks = {r: brute_chunks(r[1]) for r in set(rows) if r[1] is not None}
    places = {}
    for (d, t), found in chunks.items():
        for k, (_, lines) in enumerate(found):
            if len(lines) >= line_dedup.LEAST_LINES and words("\n".join(lines)):
                places.setdefault(tuple(lines), []).append((d is not None, d or 0, spark_hash(d, t), k, (d, t)))
    out = []
    for d, t in rows:
        if t is None:
            out.append((None, []))
            continue
        mine, lines, gone, firsts, before = chunks[d, t], t.split("\n"), set(), set(), 0
        for k, (a, chunk) in enumerate(mine):
            of = places.get(tuple(chunk), ())
            first = min(of, default=None)
            if len(of) < 2 or (first[3], first[4]) == (k, (d, t)):
                continue
            there, fa = chunks[first[4]], chunks[first[4]][first[3]][0]
            their = first[4][1].split("\n")
            lo = hi = 0
            while a - lo > before and fa - lo > 0 and lines[a - lo - 1] == their[fa - lo - 1]:
                lo += 1
            after = a + len(chunk)
            limits = [len(c[k2 + 1][1]) if k2 + 1 < len(c) else 0 for c, k2 in ((mine, k), (there, first[3]))]
            while hi < min(limits) and lines[after + hi] == their[fa + len(chunk) + hi]:
                hi += 1
            gone.update(range(a - lo, after + hi))
            before = after
            if first[4][0] is not None:
                firsts.add(first[4][0])
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), sorted(firsts)))
    return out


def lined(rng, n=40):
    """Texts that share blocks of lines, whole copies, empty and repeated rows."""
    blocks = [[prose(rng, rng.randint(1, 6)) for _ in range(rng.randint(2, 14))] for _ in range(8)]
    rows = []
    for i in range(n):
        lines = [prose(rng, 4) for _ in range(rng.randint(0, 8))]
        for _ in range(rng.randint(0, 3)):
            lines += rng.choice(blocks) + [prose(rng, 4) for _ in range(rng.randint(0, 3))]
        rows.append((i, "\n".join(lines)))
    return [*rows, (100, rows[5][1]), (101, rows[7][1]), rows[9], rows[9], (5, rows[11][1]), (None, rows[12][1]), (200, None), (201, ""), (202, "\n\n\n\n\n"), (203, "\n\n\n\n\n")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_of_every_text(spark, seed):
    rows = lined(random.Random(seed))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text, tuple(r.first_doc_ids)) for r in line_dedup.dedup(df, Work(spark, "l"), report=True).collect())
    assert got == Counter((d, left, tuple(f)) for (d, _), (left, f) in zip(rows, brute_lines(rows)))


# --- 9


def test_short_items_are_found_at_their_width(spark):
    items = [(1, "Quark"), (2, "blue quark"), (3, "one two three four"), (4, "one two three four five"), (5, "!?"), (6, "quark!")]
    rows = [(1, "a blue, quark here"), (2, "one two three\nfour and more words"), (3, "one two three, then four"), (4, "ONE two three four five"), (5, "Quark"), (6, None), (7, "")]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_items) for r in decontamination.contaminated(df, bench, Work(spark, "d")).collect()}
    assert got == {(1, 1, 2), (1, 2, 1), (2, 3, 1), (4, 3, 1), (4, 4, 1), (5, 1, 2)}
    assert {r.doc_id for r in decontamination.clean(clashing(df), bench, Work(spark, "d")).collect()} == {3, 6, 7}


def test_least_hits_of_any_size():
    rng = np.random.default_rng(2)
    for n in (1100, 5000, 100_000):
        draws = rng.hypergeometric(-(-int(0.8 * 1000) * n // 1000), n - -(-int(0.8 * 1000) * n // 1000), 48, 20_000)
        assert (draws < decontamination.least_hits(None, 48)).mean() < 1e-3
    assert decontamination.least_hits(None, 48) <= min(decontamination.least_hits(n, 48) for n in (1100, 4096, 50_000))


# --- 10


def brute_quality(rows):
    """Whether each (text, lang, source) is kept."""
    rated = []
    for t, lang, source in rows:
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        up, low = (sum(map(f, t or "")) for f in (str.isupper, str.islower))
        part = lambda a, b: a / b if b else 0.0
        rates = {"signs": part(len(re.findall(r"[#*$%&|<>]", t or "")), sum(map(len, w))), "capitals": part(up, up + low), "repeats": part(len(covered), len(w)), "copied": part(len(lines) - len(set(lines)), len(lines))}
        rated.append(((lang, source), rates, len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    fences = {}
    for group in {g for g, *_ in rated}:
        for k, spread in quality.SPREAD.items():
            v = sorted(r[k] for g, r, _ in rated if g == group)
            q1, q3 = (v[math.ceil(p * len(v)) - 1] for p in (0.25, 0.75))
            fences[group, k] = q3 + quality.REACH * max(q3 - q1, spread)
    return [not base and all(r[k] <= fences[g, k] for k in r) for g, r, base in rated]


def test_repeats_have_a_fence(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 100), "en", "s", 0) for i in range(30)]
    phrase = prose(rng, 9)
    rows.append((99, f"{prose(rng, 40)} {phrase} {prose(rng, 42)} {phrase}", "en", "s", 0))  # 18 of 100 words
    out = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA), Work(spark, "q")).collect()}
    assert out[99].n_repeat_words == 18 and not out[99].base_failed and not out[99].kept
    assert sum(out[i].kept for i in range(30)) == 30
    assert [out[r[0]].kept for r in rows] == brute_quality([r[1:4] for r in rows])


# --- 4 and 7


def test_units_of_any_text_encode_as_the_whole(spark):
    rng = random.Random(1)
    parts = ["a", "b", " ", "\n", "  ", "\t", "é", "日", " ", " ", "　", "“", "—", "'s", "12", "\r\n", "<|endoftext|>", "\0", "\x85", "\xa0", "😀", " ", "᠎", "ß", "½", "​", " the", "word", "supercalifragilisticexpialidocious" * 2]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    want = [ids_of(t, 0)[:-1].astype("<u2").tobytes() for t in texts]
    small, large = bpe.Encoder(bpe.default_path(), kept=50), bpe.Encoder(bpe.default_path())
    assert list(small.encode(texts)) == want and list(large.encode(texts)) == want and list(large.encode(texts)) == want
    assert list(large.encode([])) == [] and list(large.encode([None, "", None])) == [b""] * 3


def test_long_texts_pass_the_span(spark):
    rng = random.Random(2)
    long = " ".join(prose(rng, 2000) for _ in range(250))
    assert len(long) > bpe.SPAN
    e = bpe.Encoder(bpe.default_path(), kept=1000)
    got = list(e.encode(["a b", long, None, "c", long[: bpe.SPAN // 2], "x" * 100_000]))
    for text, ids in zip(["a b", long, "", "c", long[: bpe.SPAN // 2], "x" * 100_000], got):
        assert ids == ids_of(text, 0)[:-1].astype("<u2").tobytes()


def test_an_encoder_takes_bounded_memory():
    import tracemalloc

    rng = random.Random(5)
    texts = pa.array(["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(500)])
    e = bpe.Encoder(bpe.default_path())
    assert e.rows.nbytes <= 32 * e.slots
    tracemalloc.start()
    try:
        for _ in range(2):  # units that are new, and units that are known
            before = tracemalloc.get_traced_memory()[0]
            tracemalloc.reset_peak()
            e.column(texts)
            assert tracemalloc.get_traced_memory()[1] - before < 45_000_000
    finally:
        tracemalloc.stop()


def test_one_key_may_hold_most_rows(spark):
    rng = random.Random(4)
    rows = [(None if i % 3 else 7, prose(rng, 30)) for i in range(300)] + [(i, "x") for i in range(20)]
    work = Work(spark, "f")
    manifest = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), work, bpe.default_path(), 0)
    assert manifest.count() == 4 and max(r.n_records for r in manifest.collect()) < 200
    out = token_files.read(manifest).orderBy("start").collect()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in out]
    assert keys == sorted(keys) and Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == Counter((d, len(ids_of(t, 0)), zlib.crc32(ids_of(t, 0).tobytes())) for d, t in rows)


def test_batches_by_size():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (3, 0, 9, 1, 1, 20, 2)] + [None]})
    sizes = [[len(x.as_py() or "") for x in b.column(0)] for b in common.by_size([batch], 0, 10)]
    assert sizes == [[3, 0], [9, 1], [1], [20], [2, 0]]


# --- 5


def test_suffix_dedup_beyond_a_mebibyte(spark):
    rng = random.Random(5)
    core = prose(rng, 60)
    long = " ".join(prose(rng, 1000) for _ in range(210))
    assert len(long) > (1 << suffix_dedup.PLACE) - 300
    cut = (1 << suffix_dedup.PLACE) - 400
    long = long[:cut] + core + long[cut:]  # the repeat lies over the end of a scanned part
    rows = [(1, long), (2, f"{prose(rng, 50)} {core} {prose(rng, 50)}"), (3, prose(rng, 80))]
    raw = [t.encode() for _, t in rows]
    seen = Counter(xxhash.xxh3_128_digest(b[i : i + 200]) for b in raw for i in range(len(b) - 199))
    got = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), Work(spark, "x")).collect()}
    for (d, _), b in zip(rows, raw):
        gone = np.zeros(len(b) + 1, dtype=np.int32)
        for i in range(len(b) - 199):
            if seen[xxhash.xxh3_128_digest(b[i : i + 200])] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        assert got[d].n_removed == int((np.cumsum(gone[:-1]) > 0).sum())
    assert got[1].n_removed >= len(core) and got[2].n_removed >= len(core)


def test_an_anchor_in_thousands_of_contexts(spark):
    rng = random.Random(6)
    core = prose(rng, 40).encode()[:150].decode()
    left, right = [prose(rng, 20)[:90] for _ in range(60)], [prose(rng, 20)[:90] for _ in range(60)]
    rows = [(i, f"{rng.choice(left)}{rng.randint(0, 9)}{core}{rng.randint(0, 9)}{rng.choice(right)}") for i in range(3000)]
    raw = [t.encode() for _, t in rows]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    got = {r.doc_id: r.n_removed for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), Work(spark, "x")).collect()}
    for (d, _), b in zip(rows, raw):
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        assert got[d] == int(gone.sum())


def test_construction_through_files(spark, monkeypatch, tmp_path):
    rng = random.Random(9)
    base = [bytes(rng.choice(b"ab ") for _ in range(150)) for _ in range(3)]
    strings = [base[i % 3][rng.randint(0, 60) :][: rng.randint(30, 90)] for i in range(60)]
    strings = list(dict.fromkeys(s for s in strings if len(s) >= 30))
    strings += [s[:40] + b"#" + s[41:] for s in strings[:8] if len(s) > 45]
    seen = Counter(s[i : i + 30] for s in strings for i in range(len(s) - 29))
    for block in (7, 64, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        got = suffix_dedup.repeated(strings, [1] * len(strings), 30, folder=str(tmp_path / f"b{block}"))
        for s, flags in zip(strings, got):
            assert flags.tolist() == [seen[s[i : i + 30]] > 1 for i in range(len(s) - 29)]
        assert not list((tmp_path / f"b{block}").iterdir())
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    near = [(1000 + i, f"{prose(rng, 3)} {corpus()[13][1][:260]} {prose(rng, 3)}") for i in range(20)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    both = [Counter(map(tuple, suffix_dedup.dedup(docs, Work(spark, "x"), external=n).collect())) for n in (2, 1 << 17)]
    assert both[0] == both[1]


# --- 1


def shingles(line):
    w = words(line.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_equal_lines_against_all_pairs(spark):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        base = prose(rng, rng.randint(40, 90)).split()
        for j in range(3):
            w = list(base)
            for _ in range(j * rng.randint(0, 2)):
                w[rng.randrange(len(w))] = prose(rng, 1) + "q"
            rows.append((3 * i + j, "\n".join([prose(rng, 20), " ".join(w), prose(rng, 20)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lines = [(d, k, line) for d, t in rows for k, line in enumerate(t.split("\n"))]
    sets = [shingles(x) for *_, x in lines]
    _, of = paragraph_dedup.found(df, Work(spark, "g"))
    work = Work(spark, "g")
    classes = {bytes(r.unit): (r.first.doc_id, r.first.first_word) for r in paragraph_dedup.classes(of, work).collect()}
    named = {(r.doc_id, r.first_word): classes.get(bytes(r.unit)) for r in of.collect()}
    place = lambda i: (lines[i][0], sum(len(words(x)) for x in dict(rows)[lines[i][0]].split("\n")[: lines[i][1]]))
    near = [(i, j) for i in range(len(lines)) for j in range(max(0, i - 9), i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    linked = sum(named.get(place(i)) is not None and named.get(place(i)) == named.get(place(j)) for i, j in near)
    assert len(near) > 150 and linked >= 0.98 * len(near)
    # what is linked is near to something
    close = {place(i) for pair in near for i in pair}
    assert {p for p, c in named.items() if c is not None} <= close
    # near copies lose the whole line, with its changed words, and the first of each stays
    out = {r.doc_id: r for r in paragraph_dedup.report(df, Work(spark, "g")).collect()}
    first = {lines[j][0] for i, j in near}
    assert all(out[lines[i][0]].n_removed == len(words(lines[i][2])) for i, j in near if lines[i][0] not in first and named.get(place(i)) == named.get(place(j)) != None)  # noqa: E711
    assert all(out[3 * i].n_removed == 0 for i in range(150))


def test_word_hashes_over_slices(monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 50, rng.choice([" ", "\n", "\t "])) for _ in range(20)] + ["", "x" * 500, " ", "A b A B"]
    whole = paragraph_dedup.Paragraphs(pa.array(texts))
    monkeypatch.setattr(paragraph_dedup, "SLICE", 64)
    cut = paragraph_dedup.Paragraphs(pa.array(texts))
    assert whole.words.tolist() == cut.words.tolist() and whole.runs.tolist() == cut.runs.tolist()
    assert [len(words(t)) for t in texts] == np.diff(whole.first).tolist()
    a, b, c, d = whole.words[-4:].tolist()
    assert a == c and b == d and a != b
    one = paragraph_dedup.Paragraphs(pa.array([texts[3]]))
    assert one.run_names.tolist() == whole.run_names[whole.run_text == 3].tolist() and one.bands.tolist() == whole.bands[whole.line_text == 3].tolist()


def test_a_bucket_of_thousands_of_near_copies_is_quick():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 60, 60)
    sets = [np.unique(np.append(base[np.arange(60) != rng.integers(60)], rng.integers(1 << 61, 1 << 62))) for _ in range(4000)]
    links = paragraph_dedup.bucket_links(list(range(len(sets))), sets)
    assert len(links) == len(sets) - 1


# --- 6


def test_toxicity_scores_against_a_full_search(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        w = prose(rng, 25).split()
        if i % 4 == 0:
            w[3:3] = [rng.choice(["vile", "nasty", "Vileness", "nastier"]) for _ in range(rng.randint(1, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(4, "nasty vile words in another row"), (4, rows[4][1]), (1000, None), (1001, ""), (1002, "vile vile nasty"), (1003, "nastyish but vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), Work(spark, "v"))

    def counts(text):
        return Counter(x for w in re.findall(toxicity.WORD, (text or "").lower()) for x in toxicity.terms_of(w))

    label = {d: y for d, _, y in labels}
    examples = [(label[d], counts(t)) for d, t in rows if d in label and zlib.crc32(str(d).encode()) % 4 != 2]
    n, bad = len(examples), sum(y for y, _ in examples)
    df = Counter(t for _, c in examples for t in c)
    hits = Counter(t for y, c in examples if y for t in c)
    chance = statistics.NormalDist().inv_cdf(1 - toxicity.CHANCE / 2 / len(df)) ** 2
    weight = {}
    for t, k in df.items():
        a, b = hits[t], k - hits[t]
        chi = n * (a * (n - bad - b) - b * (bad - a)) ** 2 / (k * (n - k) * bad * (n - bad)) if k < n else 0
        if chi > chance:
            weight[t] = math.log(1 + n / k) * (1 - chance / chi)
    assert set(weight) == set(index.term) and "vile" in weight and "nast*" in weight

    def vector(c):
        v = {t: (1 + math.log(x)) * weight[t] for t, x in c.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    known = [(y, vector(c)) for y, c in examples]
    some = [(y, v) for y, v in known if v]
    rate = (bad - sum(y for y, _ in some) + 0.5) / (n - len(some) + 1)
    assert len(index.docs) == len(some)  # every row of a repeated doc_id is an example
    slope, offset = index.line
    for d, t in rows:
        v, raw = vector(counts(t)), rate
        near = sorted(((sum(x * u.get(k, 0) for k, x in v.items()), y) for y, u in some), reverse=True)
        near = [(c, y) for c, y in near if c > 0]
        if near:
            last = near[min(toxicity.K, len(near)) - 1][0]
            over = [x for x in near if x[0] > last + toxicity.TIE]
            ties = [x for x in near if abs(x[0] - last) <= toxicity.TIE]
            share = min(1, (toxicity.K - len(over)) / len(ties))
            votes = [(1 / (1 - min(c, 1) + toxicity.EPS), y) for c, y in over] + [(share / (1 - min(c, 1) + toxicity.EPS), y) for c, y in ties]
            raw = (sum(w * y for w, y in votes) + toxicity.PRIOR * rate) / (sum(w for w, _ in votes) + toxicity.PRIOR)
        raw = min(max(raw, 1e-6), 1 - 1e-6)
        want = 1 / (1 + math.exp(-(slope * math.log(raw / (1 - raw)) + offset)))
        assert index.score(t)[0] == pytest.approx(want, abs=1e-7)
    # neither the order of rows nor the doc_ids matter
    moved = spark.createDataFrame([(d, t) for d, t in reversed(rows)], docs.schema)
    again = toxicity.fit(moved, spark.createDataFrame(labels[::-1], "doc_id long, quality int, toxic int"), Work(spark, "v"))
    assert all(index.score(t)[0] == pytest.approx(again.score(t)[0], abs=1e-9) for _, t in rows)
    held = docs.withColumn("text", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit("nasty")).otherwise(F.col("text")))
    same = toxicity.fit(held, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), Work(spark, "v"))
    assert same.term == index.term and same.line == index.line  # held-out rows are never read


def test_scores_are_calibrated(spark):
    """A word that goes with half of its texts' labels gives about one half, though all its neighbours share it."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1200):
        kind = rng.choice(["vile", "murky", "plain", "plain", "plain"])
        bad = rng.random() < {"vile": 0.95, "murky": 0.5, "plain": 0.02}[kind]
        rows.append((i, f"{prose(rng, 12)} {kind} {prose(rng, 12)}"))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), Work(spark, "v"))
    out = [(r.score, labels[r.doc_id][2]) for r in toxicity.score(docs, index).filter("held_out").collect()]
    for lo, hi in ((0, 0.2), (0.2, 0.8), (0.8, 1.01)):
        some = [(s, y) for s, y in out if lo <= s < hi]
        assert len(some) > 10 and abs(sum(s for s, _ in some) - sum(y for _, y in some)) / len(some) < 0.15


# --- pipeline


def brute_clean(rows, items):
    def grams(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [s for x in items if (s := grams(x))]
    return [r for r in rows if not any(len(s & grams(r[1])) >= 0.8 * len(s) for s in sets)]


def brute_pipeline(rows, items):
    rows = [r for r, keep in zip(rows, brute_quality([r[1:4] for r in rows])) if keep]
    rows = [(r[0], left, *r[2:]) for r, (left, _) in zip(rows, brute_lines([r[:2] for r in rows]))]
    root = brute_components([brute_print(r[1]) for r in rows])
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    rows = [r for r, c in zip(rows, root) if r[0] is None or r[0] == least[c]]
    rows = brute_clean(rows, items)
    out = Counter()
    for d, t, *_ in rows:
        ids = ids_of(t, 2)
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        for i, a in enumerate([0, *range(first, len(ids), 1024)]):
            piece = ids[a : a + (first if i == 0 else 1024)]
            out[d, i, a, len(piece), zlib.crc32(piece.tobytes())] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pipeline_against_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    items = [prose(rng, 20), prose(rng, 40)]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), 0) for i, t in lined(rng, 30)]
    rows += [(300 + i, f"{prose(rng, 30)} {x} {prose(rng, 30)}", "en", "a", 0) for i, x in enumerate(items)]
    rows += [(400, prose(rng, 900, "\n"), "de", "b", 0), (401, prose(rng, 60, " *** "), "en", "a", 0), rows[3], rows[3], (500, rows[4][1], None, None, None)]
    spark.createDataFrame([(i, x) for i, x in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clashing(spark.createDataFrame(rows, SCHEMA)).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute_pipeline(rows, items)
    assert Counter(tuple(r)[:5] for r in out) == want and len(want) > 20


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_takes_clashing_names(spark):
    """Columns that a document table has besides do not reach the operators' own."""
    docs = clashing(spark.createDataFrame(corpus(), SCHEMA)).withColumn("gone", F.lit(1)).withColumn("hits", F.lit(1)).withColumn("label", F.lit(1)).withColumn("terms", F.lit("x"))
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string").withColumn("s", F.lit(1)).withColumn("n", F.lit(1)).withColumn("w", F.lit(1))
    assert decontamination.contaminated(docs, items, Work(spark, "c")).columns[:2] == ["doc_id", "item_id"]
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x")).withColumn("label", F.lit(9))
    assert toxicity.score(docs, toxicity.fit(docs, labels, Work(spark, "c"))).count() == len(corpus())
