"""Benchmark decontamination with an FM-index for each training shard.

A task cuts its documents into shards of at most ``SHARD_WORDS`` words. For each shard it builds
a suffix array over word ids (prefix doubling), the Burrows-Wheeler transform of it, a wavelet
matrix for ranks and a sample of suffix positions. All benchmark windows are searched backwards at
once; occurrences are located by walking to the next sampled suffix, and the words they cover are
merged into removal spans.

Nothing is shuffled: the documents stay where they are read, one row out for each row in, so hot
sources and groups of copies have no key to meet in (a text that repeats within a shard is indexed
once). A document longer than a shard is indexed in pieces that overlap by a window less one word.
The benchmark is sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one narrow pass
for each block, so what is broadcast stays bounded however large the benchmark grows.

Edge cases: null, empty or wordless texts have no words and no hits; items without words have no
windows, items of fewer than ``WINDOW`` words are one window; repeated items and items with equal
ids count once by id (a null ``item_id`` is written as an empty string); repeated rows are judged
row by row; with an empty benchmark nothing is hit; extra columns pass through.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.llm import common as C

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 4 << 20
#: Every suffix whose position divides by this is sampled.
SAMPLE = 16

#: A-Z become a-z; bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` stay; all others become spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

HIT_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW_HIT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("items", pa.list_(pa.string()))])


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class _Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bits.dtype)), bitorder="little").view(np.uint64)
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class _Wavelet:
    """Ranks and access over an integer sequence, one bit of the symbol a level."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        cur = seq
        for level in range(self.depth - 1, -1, -1):
            one = (cur >> level) & 1 == 1
            self.levels.append(_Bits(one))
            left = cur[~one]
            self.zeros.append(len(left))
            cur = np.concatenate((left, cur[one]))
        # Where each symbol's run starts below the last level.
        self.start = np.zeros(n_symbols, np.int64)
        change = np.flatnonzero(np.concatenate(([True], cur[1:] != cur[:-1])))
        self.start[cur[change]] = change

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            r = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1 == 1, zeros + r, i - r)
        return i - self.start[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at i and their ranks before i."""
        c = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one, r = bits.get(i), bits.rank(i)
            i = np.where(one, zeros + r, i - r)
            c = c * 2 + one
        return c, i - self.start[c]


def suffix_array(seq: np.ndarray, n_symbols: int) -> np.ndarray:
    """Sorted suffixes of a sequence whose last symbol is its smallest and occurs once."""
    n = len(seq)
    bits = max(1, int(n_symbols - 1).bit_length())
    k = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for j in range(k):  # the first k symbols in one key; past the end counts as the end symbol
        key = (key << bits) | np.concatenate((seq[j:], np.zeros(min(j, n), np.int64)))[:n]
    sa = np.argsort(key, kind="stable")
    sk = key[sa]
    head = np.concatenate(([True], sk[1:] != sk[:-1]))
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    tied = np.flatnonzero(~(head & np.concatenate((head[1:], [True]))))  # slots in groups of two or more
    while len(tied):
        pos = sa[tied]
        nxt = pos + k
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1) + 1
        key = rank[pos] * (n + 2) + second
        order = np.argsort(key, kind="stable")
        sa[tied] = pos = pos[order]
        sk = key[order]
        head = np.concatenate(([True], sk[1:] != sk[:-1]))
        rank[pos] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~(head & np.concatenate((head[1:], [True])))]
        k *= 2
    return sa


class FMIndex:
    """Backward search and location over one shard. The sequence must end in its only 0."""

    def __init__(self, seq: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        sa = suffix_array(seq, n_symbols)
        self.n = len(seq)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=n_symbols))))
        self.bwt = _Wavelet(seq[sa - 1], n_symbols)
        marked = sa % sample == 0
        self.marked, self.samples = _Bits(marked), sa[marked]

    def search(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that begin with each pattern flat[start : start + length]."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        live = np.arange(len(start))
        step = 0
        while len(live):
            live = live[length[live] > step]
            c = flat[start[live] + length[live] - 1 - step]
            a, b = self.first[c] + self.bwt.rank(c, lo[live]), self.first[c] + self.bwt.rank(c, hi[live])
            lo[live], hi[live] = a, b
            live = live[b > a]
            step += 1
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled suffix."""
        out, live, rows, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(live):
            done = self.marked.get(rows)
            out[live[done]] = self.samples[self.marked.rank(rows[done])] + steps
            live, rows = live[~done], rows[~done]
            c, r = self.bwt.access(rows)
            rows = self.first[c] + r
            steps += 1
        return out


class Phrases:
    """The windows of a block of benchmark items: word ids laid end to end, and who owns each window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        ids: dict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        seen: dict[bytes, int] = {}
        flat, start, length, owners, names = [], [], [], [], {}
        at = 0
        for name, text in items:
            w = np.array([ids[x] for x in words(text)], np.int64)
            if not len(w):
                continue
            flat.append(w)
            k = min(window, len(w))
            owner = names.setdefault(name, len(names))
            for i in range(len(w) - k + 1):
                key = w[i:i + k].tobytes()
                if key not in seen:
                    seen[key] = len(start)
                    start.append(at + i)
                    length.append(k)
                    owners.append({owner})
                else:
                    owners[seen[key]].add(owner)
            at += len(w)
        self.vocab = list(ids)
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        self.start, self.length = np.array(start, np.int64), np.array(length, np.int64)
        self.names = list(names)
        self.owner = np.array([o for s in owners for o in sorted(s)], np.int64)
        self.owner_at = np.concatenate(([0], np.cumsum([len(s) for s in owners], dtype=np.int64)))

    def occurrences(self, index: FMIndex, ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence in a shard whose vocabulary is ids."""
        local = np.fromiter((ids.get(w, -1) for w in self.vocab), np.int64, len(self.vocab))[self.flat]
        gaps = np.concatenate(([0], np.cumsum(local < 0)))
        here = np.flatnonzero(gaps[self.start + self.length] == gaps[self.start])  # all words are in the shard
        lo, hi = index.search(local, self.start[here], self.length[here])
        found = np.flatnonzero(hi > lo)
        count = hi[found] - lo[found]
        rows = np.repeat(lo[found] - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(here[found], count), index.locate(rows)


class _Shard:
    """Distinct texts of some rows, and what is found in them."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict()
        self.ids.default_factory = lambda: len(self.ids) + 2  # 0 ends the shard, 1 ends a text
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, w: list[bytes]) -> None:
        self.parts.append(np.append(np.fromiter(map(self.ids.__getitem__, w), np.int64, len(w)), 1))
        self.size += len(w) + 1

    def hits(self, phrases: Phrases) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text added: which words are hit, and the owners of the windows found there."""
        lens = np.array([len(p) for p in self.parts], np.int64)
        at = np.concatenate(([0], np.cumsum(lens)))
        seq = np.concatenate((*self.parts, [0]))
        n = len(self.ids) + 2
        win, pos = phrases.occurrences(FMIndex(seq, n), dict(self.ids)) if len(phrases.start) and len(self.ids) else (np.zeros(0, np.int64),) * 2
        if not len(win):
            return [(np.zeros(0, bool), np.zeros(0, np.int64))] * len(self.parts)
        edge = np.bincount(pos, minlength=len(seq) + 1) - np.bincount(pos + phrases.length[win], minlength=len(seq) + 1)
        covered = np.cumsum(edge) > 0
        part = np.searchsorted(at, pos, side="right") - 1
        many = phrases.owner_at[win + 1] - phrases.owner_at[win]
        own = phrases.owner[np.repeat(phrases.owner_at[win] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        pair = np.unique(np.repeat(part, many) * len(phrases.names) + own)
        part, own = pair // len(phrases.names), pair % len(phrases.names)
        cut = np.searchsorted(part, np.arange(len(self.parts) + 1))
        return [(covered[at[i]:at[i + 1] - 1], own[cut[i]:cut[i + 1]]) for i in range(len(self.parts))]


def find(texts, phrases: Phrases, shard_words: int = SHARD_WORDS):
    """For each text: number of words, hit mask (empty if nothing is hit), owners. Copies in a shard are indexed once."""
    out: list = [None] * len(texts)
    nothing = (np.zeros(0, bool), np.zeros(0, np.int64))
    shard, seen, rows = _Shard(), {}, []

    def flush():
        nonlocal shard, seen, rows
        if rows:
            found = shard.hits(phrases)
            for row, part in rows:
                out[row] = (out[row], *found[part])
        shard, seen, rows = _Shard(), {}, []

    over = int(phrases.length.max()) - 1 if len(phrases.length) else 0
    for row, t in enumerate(texts):
        if t in seen:
            out[row] = out[seen[t][0]]
            rows.append((row, seen[t][1]))
            continue
        w = words(t)
        if not w:
            out[row] = (0, *nothing)
        elif len(w) <= shard_words:
            if shard.size + len(w) > shard_words:
                flush()
            out[row] = len(w)
            seen[t] = (row, len(shard.parts))
            rows.append((row, len(shard.parts)))
            shard.add(w)
        else:
            mask, owners = np.zeros(len(w), bool), nothing[1]
            for i in range(0, len(w), shard_words):
                piece = _Shard()
                piece.add(w[i:i + shard_words + over])
                m, o = piece.hits(phrases)[0]
                mask[i:i + len(m)] |= m
                owners = np.union1d(owners, o)
            out[row] = (len(w), mask if mask.any() else nothing[0], owners)
    flush()
    return out


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Merged runs [start, end) of hit words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without its words of the given runs, and without what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flat.astype(np.int8), [0]))))
    first, last = edge[::2], edge[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:first[a]])
        at = last[b - 1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _blocks(benchmark: DataFrame, window: int):
    """The benchmark's phrases, a bounded block at a time."""
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for k in range(n):
        part = bench if n == 1 else bench.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield Phrases([tuple(r) for r in part.collect()], window)


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep_text: bool = True, cut: bool = False) -> DataFrame:
    """The documents' columns and ``hits``: n_words, n_hit, spans of hit words, ids of the items found.

    ``cut`` also removes the spans from ``text``. ``keep_text=False`` leaves ``text`` out.
    """
    spark = docs.sparkSession
    C.ship_package(spark)
    name = "__hits"
    out = docs
    blocks = list(_blocks(benchmark, window)) or [Phrases([], window)]
    for k, phrases in enumerate(blocks):
        sent = spark.sparkContext.broadcast(phrases)
        last = k == len(blocks) - 1
        drop = last and not keep_text
        fields = [f for f in out.schema.fields if f.name != name and not (drop and f.name == "text")]
        schema = T.StructType([*fields, T.StructField(name, HIT_TYPE)])
        out = out.mapInArrow(_scan(sent, name, k > 0, drop, cut and last), schema)
    return out.withColumnRenamed(name, "hits") if "hits" not in docs.columns else out


def _scan(sent, name: str, more: bool, drop: bool, cut: bool):
    def run(batches):
        phrases = sent.value
        for rb in batches:
            texts = rb.column(rb.schema.get_field_index("text")).to_pylist()
            old = rb.column(rb.schema.get_field_index(name)).to_pylist() if more else None
            hits = []
            for row, (n, mask, own) in enumerate(find(texts, phrases)):
                items = {phrases.names[o] for o in own.tolist()}
                if more:
                    was = old[row]
                    items |= set(was["items"])
                    if was["spans"]:
                        mask = mask if len(mask) else np.zeros(n, bool)
                        for s in was["spans"]:
                            mask[s["start"]:s["end"]] = True
                spans = spans_of(mask) if len(mask) else []
                hits.append({"n_words": n, "n_hit": int(mask.sum()), "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items)})
                if cut and spans:
                    texts[row] = cut_spans(texts[row], spans)
            cols, names = [], []
            for i, f in enumerate(rb.schema):
                if f.name == name or drop and f.name == "text":
                    continue
                cols.append(pa.array(texts, pa.string()) if cut and f.name == "text" else rb.column(i))
                names.append(f.name)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(hits, _ARROW_HIT)], names=[*names, name])
    return run


def remove_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents with every benchmark span cut out; those left without a word go."""
    cols = docs.columns
    d = docs.withColumnsRenamed({c: f"__in_{c}" for c in cols if c == "hits"})
    out = find_spans(d, benchmark, cut=True).where((F.col("hits.n_hit") == 0) | (F.col("hits.n_hit") < F.col("hits.n_words")))
    changed = F.col("hits.n_hit") > 0
    return out.select(*[F.when(changed, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                        else F.col("__in_hits" if c == "hits" else c).alias(c) for c in cols])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, C.table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("hits.n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT k FROM windows
), grams AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, lengths WHERE len(w) >= k)
), found AS (
  SELECT g.doc_id, g.i, g.k, item_id FROM grams g JOIN windows USING (k, s)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), who AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)
"""
