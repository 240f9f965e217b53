"""Quality by ordinal regression with cumulative links.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score into grades: P(grade <= k) = logistic(threshold_k - weights . features). From these come the
expected grade and the probability of reaching a grade, by which documents are selected.

Features are the presence of words and of runs of other characters, hashed into ``1 << DIM_BITS``
places, with marks for shouting, repetition and length. Weights are fitted by limited-memory BFGS on
at most ``SAMPLE_ROWS`` labelled documents, chosen by the hash of their id; only their feature places
come to the driver. Scoring is one narrow pass over whole texts.

The grades of the labels table: 0 for toxic, 1 for neither toxic nor good, 2 for good.

Edge cases: null and empty texts have the length mark as their only feature; labels with a null
grade, for ids without a document, or for null ids are not learnt from; a document labelled twice is
learnt from twice; with fewer than two grades to learn from every document gets the grades' shares
(without any label: nulls, and none is selected); repeated rows are scored alike; very long texts
count their distinct features; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

DIM_BITS = 18
#: Labelled documents that the fit takes at most.
SAMPLE_ROWS = 10_000
#: A place must occur in so many sampled documents to get a weight.
MIN_DOCS = 3
RIDGE = 0.5
STEPS = 50
SELECT_GRADE = 2
SELECT_TAIL = 0.5
_TOKEN = regex.compile(r"\p{L}+|[^\s\p{L}]+")


def _place(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) & ((1 << DIM_BITS) - 1)


class _Places(dict):
    """Feature place of each token as written, and whether it is shouted."""

    def __missing__(self, token: str) -> int:
        if len(self) > 400_000:
            self.clear()
        p = self[token] = _place(token.lower())
        return p


def features(text: str | None, cache: _Places) -> np.ndarray:
    """Sorted distinct feature places of a text."""
    tokens = _TOKEN.findall(text) if text else []
    distinct = set(tokens)
    out = {cache[t] for t in distinct}
    n = len(tokens)
    out.add(_place(f"\0length {min(8, n.bit_length())}"))
    if n:
        shouted = sum(1 for t in distinct if len(t) > 1 and t.isupper())
        other = sum(1 for t in tokens if not t[0].isalpha())
        out.add(_place(f"\0shouted {4 * shouted // len(distinct)}"))
        out.add(_place(f"\0other {6 * other // n}"))
        again = sum(1 for a, b in zip(tokens, tokens[1:]) if a == b)
        out.add(_place(f"\0again {4 * again // n}"))
    return np.fromiter(sorted(out), np.int32, len(out))


class Ordinal:
    """Weights and thresholds."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K - 1, a column each."""
        return 1 - 1 / (1 + np.exp(np.clip(score[:, None] - self.cuts[None, :], -40, 40)))


def _loss(x: np.ndarray, owner: np.ndarray, place: np.ndarray, grade: np.ndarray, n_cuts: int):
    """Penalised negative log likelihood and its gradient; x: weights, first cut, logs of the gaps."""
    w, t = x[:-n_cuts], x[-n_cuts:]
    cuts = np.cumsum(np.concatenate((t[:1], np.exp(t[1:]))))
    s = np.bincount(owner, weights=w[place], minlength=len(grade))
    edge = np.concatenate(([-np.inf], cuts, [np.inf]))
    with np.errstate(over="ignore"):
        hi, lo = 1 / (1 + np.exp(-(edge[grade + 1] - s))), 1 / (1 + np.exp(-(edge[grade] - s)))
    p = np.maximum(hi - lo, 1e-12)
    dhi, dlo = hi * (1 - hi), lo * (1 - lo)
    ds = (dhi - dlo) / p  # of the loss by the score
    g = np.empty_like(x)
    g[:-n_cuts] = np.bincount(place, weights=ds[owner], minlength=len(w)) + RIDGE * w
    dcut = np.array([-(dhi[grade == k] / p[grade == k]).sum() + (dlo[grade == k + 1] / p[grade == k + 1]).sum() for k in range(n_cuts)])
    tail = np.cumsum(dcut[::-1])[::-1]
    g[-n_cuts:] = tail * np.concatenate(([1.0], np.exp(t[1:])))
    return -np.log(p).sum() + RIDGE / 2 * (w @ w), g


def fit(rows: list[np.ndarray], grade: np.ndarray, n_grades: int) -> Ordinal:
    """Limited-memory BFGS with backtracking from zero weights and the grades' own shares."""
    place = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    common = np.bincount(place, minlength=1 << DIM_BITS) >= min(MIN_DOCS, max(1, len(rows) // 20))
    kept = np.flatnonzero(common)
    owner, place = owner[common[place]], (np.cumsum(common) - 1)[place[common[place]]]
    share = (np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] + 0.5) / (len(grade) + 1)
    cuts = np.log(share / (1 - share))
    n_cuts = n_grades - 1
    x = np.concatenate((np.zeros(len(kept)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))
    f, g = _loss(x, owner, place, grade, n_cuts)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        q, a = g.copy(), []
        for s, y in reversed(past):
            a.append((s @ q) / (y @ s))
            q -= a[-1] * y
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(g))
        for (s, y), k in zip(past, reversed(a)):
            q += s * (k - (y @ q) / (y @ s))
        slope, step = g @ q, 1.0
        while True:
            nx = x - step * q
            nf, ng = _loss(nx, owner, place, grade, n_cuts)
            if nf <= f - 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, y = nx - x, ng - g
        if s @ y > 1e-10:
            past = [*past[-7:], (s, y)]
        done = abs(f - nf) < 1e-6 * max(1.0, abs(f))
        x, f, g = nx, nf, ng
        if done:
            break
    weights = np.zeros(1 << DIM_BITS)
    weights[kept] = x[:-n_cuts]
    return Ordinal(weights, np.cumsum(np.concatenate((x[-n_cuts:][:1], np.exp(x[-n_cuts:][1:])))))


def _places(batches):
    cache = _Places()
    for rb in batches:
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([features(t.as_py(), cache) for t in rb.column(1)], pa.list_(pa.int32()))], names=["grade", "places"])


def learn(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Ordinal | None, np.ndarray]:
    """The model and the shares of grades; ratings: doc_id, grade (0, 1, ...)."""
    C.ship_package(docs.sparkSession)
    rated = ratings.where("grade is not null and doc_id is not null and grade >= 0").select(F.col("doc_id").alias("id"), F.col("grade").cast("int").alias("grade"))
    # The sample is drawn from the narrow ratings, so only its documents' texts are joined.
    both = docs.select("doc_id", "text").join(rated, F.col("doc_id") == F.col("id")).select("doc_id", "grade")
    pick = both.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows)
    text = docs.select("doc_id", "text").join(F.broadcast(pick.withColumnRenamed("doc_id", "id")), F.col("doc_id") == F.col("id")).select("grade", "text")
    got = sorted(((r.grade, list(r.places)) for r in text.mapInArrow(_places, "grade int, places array<int>").toLocalIterator()))
    grade = np.array([g for g, _ in got], np.int64)
    n = int(grade.max()) + 1 if len(grade) else 0
    shares = np.bincount(grade, minlength=n) / max(1, len(grade))
    if (shares > 0).sum() < 2:
        return None, shares
    return fit([np.array(p, np.int32) for _, p in got], grade, n), shares


def score(docs: DataFrame, model: Ordinal | None, shares: np.ndarray, select_grade: int = SELECT_GRADE, select_tail: float = SELECT_TAIL) -> DataFrame:
    """doc_id, expected_grade, tail (probability of ``select_grade`` or more), lowest (of grade 0), selected."""
    C.ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model, shares))

    def run(batches):
        m, share = sent.value
        cache = _Places()
        for rb in batches:
            if m is not None:
                s = np.array([m.weights[features(t.as_py(), cache)].sum() for t in rb.column(1)])
                tails = m.tails(s)
            else:
                tails = np.tile(np.cumsum(share[::-1])[::-1][1:], (rb.num_rows, 1))
            k = select_grade - 1
            tail = tails[:, k] if 0 <= k < tails.shape[1] else np.full(rb.num_rows, 0.0 if k >= 0 else 1.0)
            low = 1 - tails[:, 0] if tails.shape[1] else np.full(rb.num_rows, 1.0)
            known = len(share) > 0
            yield pa.RecordBatch.from_arrays([
                rb.column(0), pa.array(tails.sum(axis=1) if known else [None] * rb.num_rows, pa.float64()),
                pa.array(tail if known else [None] * rb.num_rows, pa.float64()), pa.array(low if known else [None] * rb.num_rows, pa.float64()),
                pa.array((tail >= select_tail) & known)], names=["doc_id", "expected_grade", "tail", "lowest", "selected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id long, expected_grade double, tail double, lowest double, selected boolean")


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade from quality and toxic (each 0 or 1; null if either is)."""
    g = F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNotNull(), F.col("quality") + 1)
    return labels.select("doc_id", g.cast("int").alias("grade"))


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade; one in five labelled documents (by crc32 of the id) is held out of the fit."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.pmod(C.crc_of_id("doc_id"), F.lit(5)) == 2
    model, shares = learn(docs, grades(C.table(spark, sf_dir, "labels")).where(~held))
    return score(docs, model, shares).withColumn("held_out", held)
