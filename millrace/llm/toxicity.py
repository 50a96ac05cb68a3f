"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and their first four, five and six letters, so that compounds and endings
share a term with the word they are made of. Every term of the examples is looked at; its weight is its idf
times ``1 - chance / chi``, where chi is the chi-square of its documents and the labels and ``chance`` the value that the
largest of so many terms exceeds by chance with a probability of ``CHANCE``. Below, a term's weight is zero: what goes with
neither label has no say in what is near. No number of terms is set. An example's vector holds ``(1 + log tf) * weight`` of its terms, of length one. Examples lie in blocks of
``BLOCK``; for every term the index has the postings and the largest weight in each block. A query adds up the
block maxima of its terms, visits blocks from the highest bound down, and stops where the bound falls
below the k-th best cosine, so the result is that of a full search. The votes of the ``K`` nearest, weighted by
``1 / (1 - cosine + EPS)``, and a prior of ``PRIOR`` votes at the rate of examples without any term, give the raw
score. Examples that tie for the last places share these evenly, so neither their order nor a doc_id matters. Logistic
calibration on the examples, each scored with itself left out, makes the score a probability. The
neighbours are the evidence.

The examples are a sample of at most about ``EXAMPLES`` labelled documents, chosen by a hash of the
doc_id: this is the bound of what is collected and broadcast. All documents are scored on whole texts, however long.
Labels other than 0 and 1 and null doc_ids are no examples; of several labels of one doc_id the largest
counts, and each row of that doc_id is an example. A null or empty text, like any without a term of weight, gets the
prior's rate, calibrated. Without examples every score is zero. Repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import statistics

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, table

EXAMPLES = 8000
#: Probability that any term without a bearing on the labels has a weight.
CHANCE = 0.05
BLOCK = 64
K = 15
EPS = 0.05
PRIOR = 2.0
LIMIT = 0.3
#: Cosines that differ by less are ties.
TIE = 1e-9
PREFIXES = (4, 5, 6)

WORD = r"[^\W_]+"


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


class Index:
    """A block-max inverted index of example vectors."""

    def __init__(self, terms: list[str], idf: list[float], examples: list[tuple[int, int, list[int], list[int]]], rate: float):
        """examples: doc_id, label, term numbers and their counts. idf: the terms' weights."""
        self.term = {t: i for i, t in enumerate(terms)}
        self.idf, self.rate, self.line = np.array(idf), rate, (1.0, 0.0)
        vectors = [(doc, label, *self.weigh(dict(zip(ids, counts)))) for doc, label, ids, counts in examples if len(ids)]
        # examples with the same main term lie together, so that the block maxima are tight
        vectors.sort(key=lambda v: (int(v[2][v[3].argmax()]), -float(v[3].max()), v[1], v[2].tolist(), v[3].tolist()))
        self.vectors = [v[2:] for v in vectors]
        self.docs = np.array([v[0] for v in vectors], dtype=np.int64)
        self.labels = np.array([v[1] for v in vectors], dtype=np.float64)
        self.blocks = -(-len(vectors) // BLOCK)
        place = np.repeat(np.arange(len(vectors)), [len(v[2]) for v in vectors])
        term = np.concatenate([v[2] for v in vectors]) if vectors else np.zeros(0, dtype=np.int64)
        weight = np.concatenate([v[3] for v in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((place, term))
        place, term, weight = place[order], term[order], weight[order]
        bounds = np.searchsorted(term, np.arange(len(terms) + 1))
        self.postings = [(place[a:b], weight[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.starts = [np.searchsorted(p // BLOCK, np.arange(self.blocks + 1)) for p, _ in self.postings]
        self.most = []
        for p, w in self.postings:
            m = np.zeros(self.blocks)
            np.maximum.at(m, p // BLOCK, w)
            self.most.append(m)
        self.find, self.known, self.voted = re.compile(WORD).findall, {}, {}

    def weigh(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(sorted(counts), dtype=np.int64)
        w = (1 + np.log(np.array([counts[i] for i in ids.tolist()], dtype=np.float64))) * self.idf[ids]
        return ids, w / np.sqrt((w * w).sum())

    def counts(self, text: str | None) -> dict[int, int]:
        found, known = {}, self.known
        for word in self.find((text or "").lower()):
            ids = known.get(word)
            if ids is None:
                if len(known) > 200_000:
                    known.clear()
                ids = known[word] = tuple(i for t in terms_of(word) if (i := self.term.get(t)) is not None)
            for i in ids:
                found[i] = found.get(i, 0) + 1
        return found

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples that share a term, nearest first, and of all that tie with the last."""
        bound = np.zeros(self.blocks)
        for i, w in zip(ids.tolist(), weights.tolist()):
            bound += w * self.most[i]
        places, cosines, kth = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        for block in np.argsort(-bound, kind="stable").tolist():
            if bound[block] <= 0 or bound[block] < kth - TIE:
                break
            got = np.zeros(BLOCK)
            for i, w in zip(ids.tolist(), weights.tolist()):
                a, b = self.starts[i][block], self.starts[i][block + 1]
                if a < b:
                    got[self.postings[i][0][a:b] - block * BLOCK] += w * self.postings[i][1][a:b]
            at = np.flatnonzero(got > 0)
            at = at[at + block * BLOCK != without]
            places, cosines = np.concatenate([places, at + block * BLOCK]), np.concatenate([cosines, got[at]])
            if len(cosines) >= k:
                kth = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
                near = cosines >= kth - TIE
                places, cosines = places[near], cosines[near]
        best = np.lexsort((places, -cosines))
        return places[best], cosines[best]

    def raw(self, ids: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray]:
        """The weighted share of toxic votes, and the places of the nearest."""
        places, cosines = self.nearest(ids, weights, without=without)
        if not len(places):
            return self.rate, places
        share = np.ones(len(places))
        if len(places) > K:  # the last places are shared by all that tie for them
            last = cosines <= cosines[K - 1] + TIE
            share[last] = (K - np.count_nonzero(~last)) / np.count_nonzero(last)
        votes = share / (1 - np.minimum(np.round(cosines, 9), 1) + EPS)
        # summed label by label, so that the order of ties leaves no trace
        toxic, all_ = float(np.sort(votes[self.labels[places] > 0]).sum()), float(np.sort(votes).sum())
        return (toxic + PRIOR * self.rate) / (all_ + PRIOR), places[:K]

    def calibrate(self, rest: tuple[int, int] = (0, 0)) -> None:
        """Fits the slope and offset of the raw scores' log odds on the examples; ``rest``: examples without a term, and the toxic ones of them."""
        raw = [self.raw(*v, without=i)[0] for i, v in enumerate(self.vectors)]
        x = _odds(np.array([*raw, self.rate, self.rate]))
        n = np.array([*np.ones(len(raw)), rest[0] - rest[1], rest[1]], dtype=np.float64)
        y = np.array([*self.labels, 0.0, 1.0])
        good, bad = float((n * y).sum()), float((n * (1 - y)).sum())
        if not good or not bad:
            return
        # smoothed targets, so that separable labels do not give an endless slope
        target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
        slope, offset = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(slope * x + offset)))
            g, w = n * (p - target), n * np.maximum(p * (1 - p), 1e-9)
            gradient = np.array([(g * x).sum() + 1e-3 * (slope - 1), g.sum()])
            hessian = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
            step = np.linalg.solve(hessian, gradient)
            step *= min(1.0, 1.0 / max(1e-12, float(np.abs(step).max())))
            slope, offset = slope - float(step[0]), offset - float(step[1])
            if np.abs(step).max() < 1e-9:
                break
        if slope > 0:  # a higher raw score stays a higher score
            self.line = slope, offset

    def calibrated(self, raw: float) -> float:
        slope, offset = self.line
        return float(1 / (1 + np.exp(-(slope * _odds(np.float64(raw)) + offset))))

    def score(self, text: str | None) -> tuple[float, list[int]]:
        """The score of a text, and the doc_ids of its nearest examples."""
        if self.rate is None:
            return 0.0, []
        counts = self.counts(text)
        if not counts or not self.blocks:
            return self.calibrated(self.rate), []
        key = tuple(sorted(counts.items()))
        if key not in self.voted:
            if len(self.voted) > 20_000:
                self.voted.clear()
            raw, places = self.raw(*self.weigh(counts))
            self.voted[key] = self.calibrated(raw), self.docs[places].tolist()
        return self.voted[key]


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def examples(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, label and text of the sampled labelled documents that may be learnt from."""
    usable = F.col("doc_id").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    known = labels.filter(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    n = known.count()
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, limit / max(n, 1)) * (1 << 20)
    # the hash decides on both sides, so that only the sample is shuffled
    return docs.filter(usable & chosen).select("doc_id", "text").join(known.filter(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, work: Work, limit: int = EXAMPLES) -> Index:
    import pyarrow as pa

    def split(batches):
        import pyarrow as pa

        find = re.compile(WORD).findall
        for batch in batches:
            rows = []
            for doc, text, label in zip(*(c.to_pylist() for c in batch.columns)):
                counts: dict[str, int] = {}
                for word in find((text or "").lower()):
                    for t in terms_of(word):
                        counts[t] = counts.get(t, 0) + 1
                rows.append((doc, label, list(counts), list(counts.values())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32())))], names=["doc_id", "label", "terms", "counts"])

    known = work.write(examples(docs, labels, limit).select(F.col("doc_id").cast("long"), "text", "label").mapInArrow(split, "doc_id long, label int, terms array<string>, counts array<int>").withColumn("place", F.monotonically_increasing_id()), "examples")
    n, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n:
        return Index([], [], [], None)
    df = known.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k"))
    a, b = F.col("k").cast("double"), (F.col("n") - F.col("k")).cast("double")
    chi = n * F.pow(a * (n - n_toxic - b) - b * (n_toxic - a), 2) / (F.col("n") * (n - F.col("n")) * float(n_toxic) * float(n - n_toxic))
    df = work.write(df, "frequencies")
    chance = statistics.NormalDist().inv_cdf(1 - CHANCE / 2 / max(1, df.count())) ** 2  # one degree of freedom
    told = df.filter(F.col("n") < n).withColumn("chi", chi if 0 < n_toxic < n else F.lit(0.0)).filter(F.col("chi") > chance)
    told = work.write(told, "terms").orderBy(F.desc("chi"), "term").collect()  # bounded as the sample is
    terms, weights = [r.term for r in told], [math.log(1 + n / r.n) * (1 - chance / r.chi) for r in told]
    chosen = docs.sparkSession.createDataFrame(pa.table({"term": pa.array(terms, pa.string()), "i": pa.array(range(len(terms)), pa.int32())}))
    pairs = known.select("place", "doc_id", "label", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("place", "doc_id", "label", F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
    vectors = pairs.join(chosen.hint("merge"), "term").groupBy("place", "doc_id", "label").agg(F.collect_list("i").alias("i"), F.collect_list("n").alias("n"))
    found = [(r["doc_id"], r["label"], r["i"], r["n"]) for r in vectors.toArrow().to_pylist()]  # of the sample
    with_terms, toxic_with = len(found), sum(label for _, label, *_ in found)
    rate = (n_toxic - toxic_with + 0.5) / (n - with_terms + 1)
    index = Index(terms, weights, found, min(1.0, rate))
    index.calibrate((n - with_terms, n_toxic - toxic_with))
    return index


def score(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, held_out, score, predicted and neighbours (doc_ids of the nearest examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        import pyarrow as pa

        index = shared.value
        for batch in batches:
            found = [index.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.list_(pa.int64()))], names=["doc_id", "score", "neighbours"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, neighbours array<bigint>")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"), "neighbours")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"), Work(spark, "toxicity")))
