"""Importance resampling towards a target text collection, with hashed n-gram features.

Features are runs of one to three words; a feature's bucket is the CRC-32 of its bytes modulo the
number of buckets. A bucket's gain is the log ratio of its smoothed shares in the target and in the
raw texts; a document's weight is the sum of its features' gains, and the documents with the highest
weight plus Gumbel noise are drawn.

The vocabulary has a head and a tail. Head: the most frequent words, sent to every task with their CRC
states, and the most frequent pairs of head words, sent with their buckets and states. Tail: every
other word's CRC is taken from its bytes, and every other pair or triple continues the CRC state of
what precedes its last word over that word's bytes. Both give the same, exact bucket, so the head
only saves work and no result depends on what is in it.

Three passes over the texts (words, pairs of the first ``PAIR_WORDS`` head words, buckets); the
buckets are written once, two bytes a feature, and the totals and weights read them. Counts are
combined within a task before they are shuffled. What is broadcast is bounded by ``HEAD_WORDS`` words
of at most ``HEAD_BYTES`` bytes, ``HEAD_PAIRS`` pairs and one gain a bucket. Ranks come from ranges of
the score, so no task orders all documents.

Edge cases: a null or empty text has no features, weight 0, and is never drawn; ties go to the smaller
id, a null id counts as empty text for the noise and comes last; rows that repeat an id are each
weighed and may each be drawn; an empty raw or target table leaves gains of the smoothing alone; very
long texts are read whole; columns beside the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

BUCKETS = 10_000
HEAD_WORDS = 65_536
HEAD_PAIRS = 65_536
#: Words whose pairs are counted; two of them make a number below its square.
PAIR_WORDS = 1_024
#: Longest head word in bytes, and the longest word a CRC state is moved over by table.
HEAD_BYTES = 64
#: Counts of words that a task holds before it sends them on.
HELD_WORDS = 200_000
#: Bytes of text whose features are made at a time.
CHUNK_BYTES = 1 << 20
#: Counts are put into so many classes for each power of two, to find how many of them fit.
CLASSES = 16

#: Fixed value: the reversed CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320

_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SPACE = np.uint32(zlib.crc32(b" "))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def advance_tables() -> np.ndarray:
    """[n, k, b]: what byte k (value b) of a CRC adds to the CRC after n more bytes of zero."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> np.uint32(1)) ^ np.where(one & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0)).astype(np.uint32)
    out = np.empty((HEAD_BYTES + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, HEAD_BYTES + 1):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ one[out[n - 1] & np.uint32(255)]
    return out


class Hasher:
    """CRC states of word runs: head words and pairs from the tables given, the rest from bytes.

    words: the head, in order; pairs: sorted numbers first * len(words) + second, with their CRCs.
    """

    def __init__(self, words: list[bytes], pairs: np.ndarray, pair_crcs: np.ndarray):
        self.head = len(words)
        self.pairs, self.pair_crcs = pairs, pair_crcs
        self.move = advance_tables()
        self.words = words
        self._start()

    def _start(self):
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.crc = np.fromiter(map(zlib.crc32, self.words), np.uint32, self.head)
        self.len = np.fromiter(map(len, self.words), np.int64, self.head)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > self.head + HELD_WORDS:  # tail words are a cache: they are only hashed again
            self._start()
        ids, fresh = self.ids, []
        for w in set(words).difference(ids):
            ids[w] = len(ids)
            fresh.append(w)
        if fresh:
            self.crc = np.concatenate([self.crc, np.fromiter(map(zlib.crc32, fresh), np.uint32, len(fresh))])
            self.len = np.concatenate([self.len, np.fromiter(map(len, fresh), np.int64, len(fresh))])
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def _after(self, state: np.ndarray, ids: np.ndarray, at: np.ndarray, words: list[bytes]) -> np.ndarray:
        """The CRC of what ``state`` stands for followed by each word; ``at``: the words' places."""
        n = self.len[ids]
        near = np.minimum(n, HEAD_BYTES)
        b = state.astype(np.uint32)
        m = self.move
        out = m[near, 0, b & np.uint32(255)] ^ m[near, 1, (b >> np.uint32(8)) & np.uint32(255)] \
            ^ m[near, 2, (b >> np.uint32(16)) & np.uint32(255)] ^ m[near, 3, b >> np.uint32(24)] ^ self.crc[ids]
        for i in np.flatnonzero(n > HEAD_BYTES):
            out[i] = zlib.crc32(words[at[i]], int(state[i]))
        return out

    def _space(self, crc: np.ndarray) -> np.ndarray:
        m = self.move[1]
        return m[0, crc & np.uint32(255)] ^ m[1, (crc >> np.uint32(8)) & np.uint32(255)] ^ m[2, (crc >> np.uint32(16)) & np.uint32(255)] \
            ^ m[3, crc >> np.uint32(24)] ^ _SPACE

    def features(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(CRCs, owners) of all features of texts whose words follow one another; sizes: words of each text."""
        ids = self._ids(words)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        one = self.crc[ids]
        at = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # last words of pairs
        first, last = ids[at - 1], ids[at]
        two = np.zeros(len(at), dtype=np.uint32)
        known = np.zeros(len(at), dtype=bool)
        if len(self.pairs):
            key = first * self.head + last
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            known = (first < self.head) & (last < self.head) & (self.pairs[place] == key)
            two[known] = self.pair_crcs[place[known]]
        rest = ~known
        two[rest] = self._after(self._space(self.crc[first[rest]]), last[rest], at[rest], words)
        third = np.flatnonzero(np.diff(at) == 1) + 1 if len(at) else at  # pairs whose first word ends a pair of the same text
        third = third[owner[at[third]] == owner[at[third] - 2]] if len(third) else third
        end = at[third]
        three = self._after(self._space(two[third - 1]), ids[end], end, words)
        return np.concatenate([one, two, three]), np.concatenate([owner, owner[at], owner[end]])


def _chunks(texts):
    """Words and word numbers of consecutive texts, about CHUNK_BYTES at a time."""
    words, sizes, size = [], [], 0
    for t in texts:
        w = words_of(t)
        words += w
        sizes.append(len(w))
        size += len(t or "") + 64
        if size >= CHUNK_BYTES:
            yield words, np.array(sizes, dtype=np.int64)
            words, sizes, size = [], [], 0
    if sizes:
        yield words, np.array(sizes, dtype=np.int64)


def _texts(batches, column: str):
    for rb in batches:
        for x in rb.column(column):
            yield x.as_py()


def _count_words(batches):
    held: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for t in _texts(batches, "text"):
        held.update(words_of(t))
        if len(held) >= HELD_WORDS:
            yield rows()
            held.clear()
    if held:
        yield rows()


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` (with n) of the highest classes of n that together are at most ``most`` rows."""
    level = F.floor(F.log2("n") * CLASSES)
    classes = sorted(((r.c, r.m) for r in counts.groupBy(level.alias("c")).agg(F.count(F.lit(1)).alias("m")).collect()), reverse=True)  # 64 * CLASSES at most
    least, fits = None, 0
    for c, m in classes:
        fits += m
        if fits > most:
            break
        least = c
    return counts.where(F.lit(False) if least is None else level >= F.lit(least))


def _head_words(texts: DataFrame) -> list[bytes]:
    C.ship_package(texts.sparkSession)
    parts = texts.mapInArrow(_count_words, "word binary, n long")
    counts, path = C.written(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.octet_length("word") <= HEAD_BYTES), "resample-words")
    rows = _frequent(counts, HEAD_WORDS).collect()  # HEAD_WORDS at most
    C.drop_written(texts.sparkSession, path)
    return [bytes(r.word) for r in sorted(rows, key=lambda r: (-r.n, bytes(r.word)))]


def _head_pairs(texts: DataFrame, words: list[bytes]) -> np.ndarray:
    """Sorted numbers first * len(words) + second of the most frequent pairs of the first PAIR_WORDS words."""
    spark = texts.sparkSession
    top = min(PAIR_WORDS, len(words))
    shared = spark.sparkContext.broadcast(words[:top])

    def run(batches):
        ids = {w: i for i, w in enumerate(shared.value)}
        counts = np.zeros(top * top, dtype=np.int64)
        for words_, sizes in _chunks(_texts(batches, "text")):
            x = np.fromiter((ids.get(w, -1) for w in words_), np.int64, len(words_))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            ok = (owner[1:] == owner[:-1]) & (x[1:] >= 0) & (x[:-1] >= 0)
            counts += np.bincount(x[:-1][ok] * top + x[1:][ok], minlength=top * top)
        seen = np.flatnonzero(counts)
        for i in range(0, len(seen), 100_000):
            part = seen[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["pair", "n"])

    if not top:
        return np.zeros(0, dtype=np.int64)
    counts, path = C.written(texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "resample-pairs")
    pairs = np.array([r.pair for r in _frequent(counts, HEAD_PAIRS).select("pair").collect()], dtype=np.int64)  # HEAD_PAIRS at most
    C.drop_written(spark, path)
    return np.sort(pairs // top * len(words) + pairs % top)


def head_vocabulary(texts: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Frequent words, and frequent pairs of them with their CRCs, counted over all ``texts`` (column text)."""
    words = _head_words(texts)
    pairs = _head_pairs(texts, words)
    crcs = np.array([zlib.crc32(words[p // len(words)] + b" " + words[p % len(words)]) for p in pairs.tolist()], dtype=np.uint32)
    return words, pairs, crcs


def bucketed(texts: DataFrame, head, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets) of each row of ``texts`` (id, text); buckets: little-endian 16-bit numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("the number of buckets is 1 to 65536")
    spark = texts.sparkSession
    C.ship_package(spark)
    shared = spark.sparkContext.broadcast(head)

    def run(batches):
        hasher = Hasher(*shared.value)
        for rb in batches:
            ids, at = rb.column("id"), 0
            for words, sizes in _chunks(_texts([rb], "text")):
                crc, owner = hasher.features(words, sizes)
                order = np.argsort(owner, kind="stable")
                b = (crc % np.uint32(buckets)).astype("<u2")[order]
                n = np.bincount(owner, minlength=len(sizes))
                ends = np.concatenate([[0], np.cumsum(n)])
                data = [b[ends[i]:ends[i + 1]].tobytes() for i in range(len(sizes))]
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(sizes)), pa.array(sizes), pa.array(n), pa.array(data, pa.binary())],
                                                 names=["id", "n_words", "n_features", "buckets"])
                at += len(sizes)

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_words long, n_features long, buckets binary")


def totals(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket, over all rows."""
    def run(batches):
        n = np.zeros(buckets, dtype=np.int64)
        for rb in batches:
            for x in rb.column(0):
                n += np.bincount(np.frombuffer(x.as_py(), dtype="<u2"), minlength=buckets)
        seen = np.flatnonzero(n)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the smoothed target share over the smoothed raw share) of every bucket."""
    k = len(raw)
    all_raw, all_target = float(raw.sum() + k), float(target.sum() + k)
    ratio = (target + 1.0) * all_raw / ((raw + 1.0) * all_target)
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` without its buckets, with ``weight``, the sum of their gains."""
    shared = features.sparkSession.sparkContext.broadcast(gain)
    kind = features.schema["id"].dataType.simpleString()

    def run(batches):
        for rb in batches:
            w = [int(shared.value[np.frombuffer(x.as_py(), dtype="<u2")].sum()) for x in rb.column("buckets")]
            yield pa.RecordBatch.from_arrays([rb.column("id"), rb.column("n_words"), rb.column("n_features"), pa.array(w, pa.int64())],
                                             names=["id", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int = 42, scale: int = 1000) -> Column:
    """floor(scale * Gumbel noise) that depends on the id and the seed only."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(raw: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 5, min_words: int = 20,
             buckets: int = BUCKETS, seed: int = 42, scale: int = 1000) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every raw row; rank counts the drawn from 1, null for the others.

    Of the N rows with ``min_words`` words or more, floor(percent * N / 100) are drawn without replacement.
    """
    spark = raw.sparkSession
    rows = raw.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    goal = target.select(F.lit(0).cast(rows.schema["id"].dataType).alias("id"), F.col(text).alias("text"))
    head = head_vocabulary(rows.select("text").unionAll(goal.select("text")))
    with C.small_batches(spark, 500):
        made, made_path = C.written(bucketed(rows, head, buckets), "resample-raw")
        aim, aim_path = C.written(bucketed(goal, head, buckets), "resample-target")
    gain = gains(totals(made, buckets), totals(aim, buckets), scale)
    scored = weighed(made, gain).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed, scale))
    scored, scored_path = C.written(scored, "resample-scores")
    C.drop_written(spark, made_path, aim_path)
    enough = F.col("n_words") >= min_words
    drawn = percent * scored.where(enough).count() // 100
    placed, _ = C.positions(scored, [F.when(enough, 0).otherwise(1), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")],
                            name="resample-ranks")
    C.drop_written(spark, scored_path)
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1)
    return placed.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", rank.alias("rank"))


def draw(docs: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; for ids that are not repeated."""
    return docs.join(ranks.where("rank is not null").select(id_col), id_col, "left_semi")


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH texts AS (
  SELECT doc_id AS id, true AS raw, coalesce(text, '') AS text FROM documents UNION ALL SELECT NULL, false, coalesce(text, '') FROM benchmark
), numbered AS (
  SELECT row_number() OVER () AS k, id, raw, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT k, raw, unnest(w) AS f FROM numbered
  UNION ALL SELECT k, raw, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM numbered
  UNION ALL SELECT k, raw, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM numbered
), counted AS (
  SELECT k, raw, f, count(*) AS n FROM grams GROUP BY k, raw, f
), hashed AS (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, 2 * strlen(f), 2), lambda i: ('0x' || substr(hex(encode(f)), i, 2))::BIGINT),
           lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted)
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (raw), 0)::BIGINT AS s, coalesce(sum(n) FILTER (NOT raw), 0)::BIGINT AS t FROM counted JOIN hashed USING (f) GROUP BY bucket
), alls AS (
  SELECT sum(s)::BIGINT AS S_, sum(t)::BIGINT AS T_ FROM totals
), gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (S_ + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (T_ + 10000)::DOUBLE)))::BIGINT AS g FROM totals, alls
), weights AS (
  SELECT k, sum(n * g)::BIGINT AS weight, sum(n)::BIGINT AS n_features FROM counted JOIN hashed USING (f) JOIN gain USING (bucket) WHERE raw GROUP BY k
), scored AS (
  SELECT id AS doc_id, len(w) >= 20 AS enough, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM numbered LEFT JOIN weights USING (k) WHERE raw
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r, count(*) FILTER (enough) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND r <= 5 * n // 100 THEN r END::BIGINT AS rank FROM placed
"""
