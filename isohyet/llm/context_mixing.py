"""Language-model scoring by online logistic context mixing.

A text is its lower-cased words and one end token. Every token is a few binary decisions: its path
in a Huffman code over the ``CODED_WORDS`` most frequent training words, an escape and the end. Each
decision is predicted by several hashed contexts (none, the last word, the last two, the one before
the last). Their stretched probabilities are combined by weights chosen by a gate (the depth in the
code), and the result passes an adaptive probability map. Weights and map belong to the document
being scored: they start from fixed values and are updated after every ``BLOCK`` tokens from what
that block turned out to be, so a score depends on the training counts and the text alone, never
on the order or place of the rows. A word behind the escape has its share (c + 1) of the counts of
all words that are not coded; unseen words are one class there, as they are in the base score.
``bits`` is the length of the whole text: the score in bits, and eight more for each byte of the
unseen words and of the space behind them.

Training counts cover all training documents. Word counts are an ordinary aggregate; the context
counts are fixed-size tables, filled by every task, cut into parts of ``PART`` slots and added up
in two shuffles (64 tasks at a time first), so no task holds more than a few parts and what is
shuffled grows with the number of tasks. What goes to the tasks is bounded by the parameters: one
byte a slot and the coded words. The other words, none of which is frequent, are joined with their
counts by word.

Edge cases: a null, empty or blank text is the end token alone; null ids count as the empty text
for the split into training and held-out; without training documents every count is 0 and all bits
are even odds; rows that repeat are scored alike and learnt from as often as they occur; very long
texts are worked off in blocks; extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

CODED_WORDS = 1 << 16
#: Slots of each hashed table: log2.
SLOT_BITS = 21
PART = 1 << 13
ORDERS = 4
BLOCK = 32
#: Documents scored side by side, and tokens expanded into bits at a time while counting: what numpy works on stays in the processor's cache.
LANES = 64
COUNT_TOKENS = 2_000
#: Tokens whose documents are sorted by length and scored.
SCORE_TOKENS = 1 << 19
#: Bytes of text whose words are counted, or looked up, at a time.
COUNT_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
ESC, END = 0, 1
GATES = 32
BUCKETS = 25
WEIGHTS = (0.65, 0.35, 0.25, 0.1)
RATE = 0.004
MAP_RATE = 0.02
_STEP = 16.0  # of a stretched value in a byte
_LETTER = np.array([not (c == 0x20 or 0x09 <= c <= 0x0D) for c in range(256)])
_LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], np.uint8)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of symbols with positive counts: (offset, length) of each, and its nodes and bits laid end to end."""
    n = len(counts)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    up = np.zeros(2 * n - 1, np.int64)
    side = np.zeros(2 * n - 1, np.int64)
    for node in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        up[i], up[j], side[j] = node, node, 1
        heapq.heappush(heap, (a + b, node))
    offset, nodes, bits = [0], [], []
    for s in range(n):
        path = []
        while s != 2 * n - 2:
            path.append((int(up[s]) - n, int(side[s])))
            s = int(up[s])
        for node, bit in reversed(path):
            nodes.append(node)
            bits.append(bit)
        offset.append(len(nodes))
    at = np.array(offset, np.int64)
    return at[:-1], np.diff(at), np.array(nodes, np.int64), np.array(bits, np.int8)


def token_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts end to end (binary; empty: the end token), and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    n = len(texts)
    edge = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edge[0]:edge[-1]]
    edge = edge - edge[0]
    letter = _LETTER[raw]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    border = edge[:-1][edge[:-1] < edge[1:]]
    begins[border] = letter[border]  # no word reaches into another text
    starts = np.flatnonzero(begins)
    before = np.zeros(len(raw) + 1, np.int32)  # letters before each byte
    np.cumsum(letter, out=before[1:])
    cut = np.searchsorted(starts, edge)
    n_tokens = np.diff(cut) + 1
    ends = np.cumsum(n_tokens)
    offsets = np.empty(int(n_tokens.sum()) + 1, np.int32)
    offsets[np.arange(len(starts)) + np.repeat(np.arange(n), n_tokens - 1)] = before[starts]
    offsets[ends - 1] = before[edge[1:]]
    offsets[-1] = before[-1]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[letter]])]), n_tokens


class Codebook:
    """Words with a code of their own, their counts and paths."""

    def __init__(self, words: list[tuple[bytes, int]], escapes: int, ends: int):
        self.code = {w: i + 2 for i, (w, _) in enumerate(words)}
        self.count = np.array([0, ends, *(c for _, c in words)], np.int64)
        self.at, self.size, self.node, self.bit = huffman(np.array([escapes + 1, ends + 1, *(c for _, c in words)], np.int64))
        self.n_nodes = len(words) + 1
        # Of each decision of a path: what tells its node apart in the hashed tables, where its bit counts there, and its gate.
        self.salt = self.node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        self.half = self.bit.astype(np.int32) << SLOT_BITS
        self.gate = np.minimum(np.arange(len(self.node)) - np.repeat(self.at, self.size), GATES - 1).astype(np.int8)

    def symbols(self, docs: list[list[bytes]], cache: "_Seen") -> tuple[np.ndarray, list[np.ndarray], np.ndarray, pa.DictionaryArray]:
        """:meth:`symbols_of` for the words of documents."""
        return self.symbols_of(pa.array([w for d in docs for w in (*d, b"")], pa.binary()), np.array([len(d) + 1 for d in docs], np.int64), cache)

    def symbols_of(self, tokens: pa.Array, n: np.ndarray, cache: "_Seen") -> tuple[np.ndarray, list[np.ndarray], np.ndarray, pa.DictionaryArray]:
        """Codes of the tokens of documents end to end, hashes of the words before them, where each
        document begins, and the tokens (empty: the end). n: the tokens of each document."""
        words = tokens.dictionary_encode()
        ends = np.concatenate(([0], np.cumsum(n)))
        codes, h = (x[words.indices.to_numpy()] for x in cache.look_up(words.dictionary))
        h1, h2 = np.empty_like(h), np.empty_like(h)
        h1[1:], h2[2:] = h[:-1], h[:-2]
        h1[ends[:-1]] = 1  # none reaches into another document
        h2[ends[:-1]] = 2
        h2[ends[:-1][n > 1] + 1] = 2
        one = C.mix64(h1 ^ np.uint64(0x51))
        return codes, [one, C.mix64(one ^ h2), C.mix64(h2 ^ np.uint64(0xA7))], ends, words

    def bits(self, sym: np.ndarray, ctx: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Per decision: its place in the paths of all codes and its slot in every hashed table; and the decisions of each token."""
        size = self.size[sym]
        k = np.repeat(self.at[sym] - (np.cumsum(size) - size), size)
        k += np.arange(len(k))
        salt = self.salt[k]
        slots = []
        for c in ctx:
            x = np.repeat(c, size)
            x ^= salt
            x *= np.uint64(0x9FB21C651E98DF25)
            x >>= np.uint64(64 - SLOT_BITS)
            slots.append(x.view(np.int64))
        return k, slots, size

    def table_sizes(self) -> list[int]:
        pad = -(-self.n_nodes // PART) * PART
        return [pad, *[1 << SLOT_BITS] * (ORDERS - 1)]


class _Seen:
    """Codes and hashes of different words."""

    def __init__(self, book: Codebook):
        self.coded = pa.array([b"", *book.code], pa.binary())
        self.codes = np.array([ESC, END, *book.code.values()], np.int64)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        at = pc.fill_null(pc.index_in(words, value_set=self.coded), -1).to_numpy(zero_copy_only=False)
        _, edges, data = words.buffers()
        edges = np.frombuffer(edges, np.int32)[words.offset:words.offset + len(words) + 1].tolist() if len(words) else [0]
        data = data.to_pybytes() if data else b""
        hashes = [xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(edges, edges[1:])]
        return self.codes[at + 1], np.array(hashes, np.uint64)


def _count_words(batches):
    held, size = [], 0

    def rows():
        counted = pc.value_counts(token_array(pa.concat_arrays(held))[0])
        held.clear()
        return pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], names=["w", "c"])

    for rb in batches:
        for part in _slices(rb.column(0), COUNT_BYTES):
            held.append(part)
            size += part.nbytes
            if size >= COUNT_BYTES:
                yield rows()
                size = 0
    if held:
        yield rows()


def word_counts(training: DataFrame) -> DataFrame:
    """w (binary; empty: the end token), c over all training texts."""
    C.ship_package(training.sparkSession)
    return training.select("text").mapInArrow(_count_words, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _slices(texts: pa.Array, size: int):
    """Texts of a batch a few at a time, by their bytes; none of no texts."""
    done = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(done, (done[i - 1] if i else 0) + size)) + 1
        yield texts.slice(i, j - i)
        i = j


def _count_contexts(sent):
    def run(batches):
        book = sent.value
        sizes = book.table_sizes()
        tables = [np.zeros(2 * n, np.uint32) for n in sizes[1:]]  # all slots' zeros, then all their ones
        of_symbol = np.zeros(len(book.at), np.int64)
        cache = _Seen(book)
        some = False
        for rb in batches:
            for part in _slices(rb.column(0), SLICE_BYTES):
                some = True
                sym, ctx, _, _ = book.symbols_of(*token_array(part), cache)
                of_symbol += np.bincount(sym, minlength=len(of_symbol))
                for i in range(0, len(sym), COUNT_TOKENS):
                    k, slots, _ = book.bits(sym[i:i + COUNT_TOKENS], [c[i:i + COUNT_TOKENS] for c in ctx])
                    one = book.half[k]
                    for table, slot in zip(tables, slots):
                        slot += one
                        np.add.at(table, slot, np.uint32(1))
        if some:
            z = zstandard.ZstdCompressor(level=1)
            task = TaskContext.get().partitionId()
            nodes = np.bincount(book.node + np.int64(sizes[0]) * book.bit, weights=np.repeat(of_symbol, book.size), minlength=2 * sizes[0]).astype(np.uint32)
            part = 0
            for n, table in zip(sizes, [nodes, *tables]):
                rows = []
                for i in range(0, n, PART):
                    x = np.stack((table[i:i + PART], table[n + i:n + i + PART]), axis=1)
                    if x.any():
                        rows.append((part, task // 64, z.compress(x.tobytes())))
                    part += 1
                    if len(rows) == 64 or i + PART >= n and rows:
                        yield _part_batch(rows)
                        rows = []
    return run


def _part_batch(rows):
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], names=["part", "salt", "n"])


_PARTS = "part int, salt int, n binary"


def _add_parts(batches):
    """The sum of each part in this partition."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    d = zstandard.ZstdDecompressor()
    for rb in batches:
        for p, s, n in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2)):
            x = np.frombuffer(d.decompress(n.as_py()), np.uint32)
            if (p, s) in sums:
                total = sums[p, s]
                np.minimum(total.astype(np.uint64) + x, np.iinfo(np.uint32).max, out=total, casting="unsafe")
            else:
                sums[p, s] = x.copy()
    z = zstandard.ZstdCompressor(level=1)
    for (p, s), x in sums.items():
        yield _part_batch([(p, s, z.compress(x.tobytes()))])


def _to_stretch(batches):
    d = zstandard.ZstdDecompressor()
    for rb in batches:
        out = []
        for n in rb.column(2):
            x = np.frombuffer(d.decompress(n.as_py()), np.uint32).reshape(-1, 2).astype(np.float64)
            out.append(np.clip(np.rint(np.log((x[:, 1] + 0.4) / (x[:, 0] + 0.4)) * _STEP), -127, 127).astype(np.int8).tobytes())
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(out, pa.binary())], names=["part", "st"])


def learn(training: DataFrame, counts: DataFrame) -> tuple[Codebook, list[np.ndarray]]:
    """The codebook and the stretched predictions of all contexts, from all training texts."""
    spark = training.sparkSession
    words = counts.where("octet_length(w) > 0")
    top = [(bytes(r.w), r.c) for r in words.orderBy(F.col("c").desc(), "w").limit(CODED_WORDS - 2).collect()]
    total = counts.agg(F.sum(F.when(F.octet_length("w") > 0, F.col("c"))).alias("n"), F.sum(F.when(F.octet_length("w") == 0, F.col("c"))).alias("ends")).first()
    book = Codebook(top, (total.n or 0) - sum(c for _, c in top), total.ends or 0)
    sent = spark.sparkContext.broadcast(book)
    parts = training.select("text").mapInArrow(_count_contexts(sent), _PARTS)
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(book.table_sizes()) // PART))
    parts = parts.repartition(n, "part", "salt").mapInArrow(_add_parts, _PARTS).select("part", F.lit(0).alias("salt"), "n")
    parts = parts.repartition(n, "part").mapInArrow(_add_parts, _PARTS).mapInArrow(_to_stretch, "part int, st binary")
    flat = np.zeros(sum(book.table_sizes()), np.int8)
    for r in parts.collect():  # one byte for each slot of the fixed tables
        flat[r.part * PART:(r.part + 1) * PART] = np.frombuffer(r.st, np.int8)
    edges = np.cumsum(book.table_sizes())[:-1]
    return book, np.split(flat, edges)


def log10_probabilities(book: Codebook, tables: list[np.ndarray], sym: np.ndarray, ctx: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """log10 of the probability of every document of a batch of symbols."""
    n_docs = len(ends) - 1
    size = np.diff(ends)
    order = np.argsort(-size, kind="stable")
    out = np.zeros(n_docs)
    # Weights are held divided by _STEP, a power of two, so stretched values stay the bytes that they are.
    rate = np.float32(np.float32(RATE) / np.float32(_STEP * _STEP))
    fresh = (1 / (1 + np.exp(-np.linspace(-12, 12, BUCKETS)))).astype(np.float32)
    path = 2 * tables[0][book.node].astype(np.int16) + book.bit  # of each decision: what no context predicts, and its bit
    for g in range(0, n_docs, LANES):
        lanes = order[g:g + LANES]  # longest first, so those still going are a prefix
        begin, count = ends[lanes], size[lanes]
        w = [np.full(len(lanes) * GATES, np.float32(x) / np.float32(_STEP), np.float32) for x in WEIGHTS]
        apm = np.tile(fresh, len(lanes) * GATES)
        total = np.zeros(len(lanes))
        for at in range(0, int(count[0]), BLOCK):
            live = int(np.searchsorted(-count, -at, side="left"))
            take = np.minimum(count[:live] - at, BLOCK)
            first = np.cumsum(take) - take  # of each lane's tokens in this block
            which = np.arange(first[-1] + take[-1]) + np.repeat(begin[:live] + at - first, take)
            k, slots, of_token = book.bits(sym[which], [c[which] for c in ctx])
            here = path[k]
            hit = (here & 1).astype(np.float32)
            key = np.repeat(np.repeat(np.arange(0, live * GATES, GATES), take), of_token)
            key += book.gate[k]
            s = [x.astype(np.float32) for x in (here >> 1, *(t[i] for t, i in zip(tables[1:], slots)))]
            dot = s[0] * w[0][key]
            for x, y in zip(s[1:], w[1:]):
                dot += x * y[key]
            np.maximum(dot, np.float32(-11.99), out=dot)
            np.minimum(dot, np.float32(11.99), out=dot)
            p = 1 / (1 + np.exp(-dot))
            where = (dot + np.float32(12)) * np.float32((BUCKETS - 1) / 24)
            low = where.astype(np.int32)
            part = where - low
            cell = key * BUCKETS
            cell += low.astype(np.int64)
            final = (p + apm[cell] * (1 - part) + apm[cell + 1] * part) * np.float32(0.5)
            final = np.abs(1 - hit - final)
            np.maximum(final, np.float32(1e-6), out=final)
            np.minimum(final, np.float32(1), out=final)
            bits_before = np.cumsum(of_token) - of_token
            total[:live] += np.add.reduceat(np.log10(final).astype(np.float64), bits_before[first])
            # What the block taught: one step for weights and map, used from the next block on.
            err = hit - p
            n = live * GATES
            for x, y in zip(s, w):
                y[:n] += rate * np.bincount(key, weights=err * x, minlength=n).astype(np.float32)
            cell += (part >= 0.5).astype(np.int64)
            seen = np.bincount(cell, minlength=n * BUCKETS)
            touched = np.flatnonzero(seen > 0)
            seen = seen[touched]
            hits = np.bincount(cell, weights=hit, minlength=n * BUCKETS)[touched]
            keep = (1 - MAP_RATE) ** seen
            apm[touched] = apm[touched] * keep + hits / seen * (1 - keep)
        out[lanes] = total
    return out


SCORED = ("uid long, doc_id long, held_out boolean, n_tokens long, n_bytes long, score double, known long, base double, "
          "rest array<struct<w:binary,n:long>>")
_SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]
_REST = pa.list_(pa.struct([("w", pa.binary()), ("n", pa.int64())]))


def _score(sent, n_train: int, v_train: int):
    def run(batches):
        book, tables = sent.value
        cache = _Seen(book)
        base = np.log10((book.count + 1) / (n_train + v_train + 1))
        have = book.count > 0
        uid = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # of slices whose words are done with: symbols, contexts, tokens of each document and the columns but the score

        def scored():
            codes, ctx, n_tok, columns = zip(*held)
            held.clear()
            n_tok = np.concatenate(n_tok)
            columns = [pa.concat_arrays(c) for c in zip(*columns)]
            score = log10_probabilities(book, tables, np.concatenate(codes), [np.concatenate(c) for c in zip(*ctx)], np.concatenate(([0], np.cumsum(n_tok))))
            names = ["doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "rest"]
            return pa.RecordBatch.from_arrays([pa.array(uid + np.arange(len(n_tok)), pa.int64()), pa.array(score), *columns], names=["uid", "score", *names]).select(_SCORED_NAMES)

        for rb in batches:
            at, n_held = 0, 0
            for part in _slices(rb.column(2), SLICE_BYTES):
                codes, ctx, ends, words = book.symbols_of(*token_array(part), cache)
                n_tok = np.diff(ends)
                doc = np.repeat(np.arange(len(part)), n_tok)
                coded = codes != ESC
                known = np.bincount(doc, weights=coded & have[codes], minlength=len(part)).astype(np.int64)
                b = np.bincount(doc, weights=np.where(coded, base[codes], 0), minlength=len(part))
                escaped = np.flatnonzero(~coded)
                types = np.int64(max(1, len(words.dictionary)))
                rest, n_rest = np.unique(doc[escaped] * types + words.indices.to_numpy()[escaped], return_counts=True)
                of = pa.array(np.searchsorted(rest, np.arange(len(part) + 1) * types), pa.int32())
                rest = pa.StructArray.from_arrays([words.dictionary.take(pa.array(rest % types)), pa.array(n_rest, pa.int64())], fields=list(_REST.value_type))
                n_bytes = pc.fill_null(pc.binary_length(part), 0).cast(pa.int64())
                ids, out = (rb.column(i).slice(at, len(part)) for i in (0, 1))
                at += len(part)
                held.append((codes, ctx, n_tok, [ids, out, pa.array(n_tok), n_bytes, pa.array(known), pa.array(b), pa.ListArray.from_arrays(of, rest, _REST)]))
                n_held += len(codes)
                if n_held >= SCORE_TOKENS:
                    yield (done := scored())
                    uid, n_held = uid + done.num_rows, 0
            if held:
                yield (done := scored())
                uid += done.num_rows
    return run


def score_documents(docs: DataFrame, held_out_mod: int = 7, held_out_rest: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits, bits_per_byte for every row.

    Documents whose crc32 of the id, modulo ``held_out_mod``, is ``held_out_rest`` are not learnt from.
    """
    spark = docs.sparkSession
    C.ship_package(spark)
    out = F.pmod(C.crc_of_id("doc_id"), F.lit(held_out_mod)) == held_out_rest
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text")
    train = rows.where(~F.col("held_out"))
    counts, _ = C.written(word_counts(train), "lm-words")
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = size.n or 0, size.v
    book, tables = learn(train, counts)
    uncoded = n + v + 1 - int(book.count.sum()) - int((book.count > 0).sum())  # counts and types behind the escape, and the unseen
    sent = spark.sparkContext.broadcast((book, tables))
    scored, _ = C.written(rows.mapInArrow(_score(sent, n, v), SCORED), "lm-scores")
    rest = scored.select("uid", F.explode("rest").alias("r")).select("uid", F.col("r.w").alias("w"), F.col("r.n").alias("n"))
    rest = rest.join(counts, "w", "left").select("uid", "n", F.octet_length("w").alias("len"), F.coalesce("c", F.lit(0)).alias("c"))
    share = F.log10((F.col("c") + 1) / F.lit(float(uncoded)))
    sums = rest.groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))).alias("rest_base"),
        F.sum(F.col("n") * share).alias("rest_score"),
        F.sum(F.when(F.col("c") == 0, F.col("n") * (F.col("len") + 1) * 8).otherwise(0)).alias("spelled"))
    out = scored.drop("rest").join(sums, "uid", "left").withColumn("score", F.col("score") + F.coalesce("rest_score", F.lit(0.0)))
    bits = F.coalesce("spelled", F.lit(0)) - F.col("score") / F.lit(float(np.log10(2)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"), "score",
        bits.alias("bits"), F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"))


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
