import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from isohyet.llm import common as C
from isohyet.llm import context_mixing as M

ROWS = [(i, f"the cat number {i % 5} sat on the mat . the dog {i} saw the cat {'again ' * (i % 4)}") for i in range(60)] + [(100, None), (101, ""), (None, "the cat")]


def _split(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_base_score_and_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "CODED_WORDS", 12)  # most words go the way of the join
    got = M.score_documents(spark.createDataFrame(ROWS, "doc_id long, text string")).collect()
    counts = Counter()
    for i, t in ROWS:
        if not _split(i):
            counts.update((t or "").lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(ROWS) and any(r.held_out for r in got)
    text = dict(ROWS)
    for r in got:
        tokens = [*(text[r.doc_id] or "").lower().split(), None]
        assert r.held_out == _split(r.doc_id) and r.n_tokens == len(tokens) and r.train_tokens == n
        assert r.n_known == sum(counts[x] > 0 for x in tokens)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens), rel_tol=1e-9)
        assert r.score < 0 and r.bits >= -r.score / math.log10(2) - 1e-6
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_probabilities_of_all_next_tokens_sum_to_one():
    words = [(f"w{i}".encode(), 50 - i) for i in range(30)]
    book = M.Codebook(words, 7, 11)
    rng = np.random.default_rng(1)
    tables = [np.clip(rng.normal(0, 30, n), -127, 127).astype(np.int8) for n in book.table_sizes()]
    start = [b"w3", b"w1", b"w3"] * 40  # long enough for weights and map to have moved
    alone = M.log10_probabilities(book, tables, *(lambda s: (s[0][:-1], [c[:-1] for c in s[1]], np.array([0, len(start)])))(book.symbols([start], M._Seen(book))))
    total = 0.0
    for w in [b"unseen", None, *(w for w, _ in words)]:
        codes, ctx, _, _ = book.symbols([start + ([] if w is None else [w])], M._Seen(book))
        k = len(start) + 1
        total += 10 ** (M.log10_probabilities(book, tables, codes[:k], [c[:k] for c in ctx], np.array([0, k]))[0] - alone[0])
    assert abs(total - 1) < 1e-6


def test_scores_do_not_depend_on_company():
    book = M.Codebook([(b"a", 5), (b"b", 3)], 2, 4)
    tables = [np.full(n, 9, np.int8) for n in book.table_sizes()]
    docs = [[b"a", b"b"] * k for k in (1, 100, 7)]
    together = M.log10_probabilities(book, tables, *book.symbols(docs, M._Seen(book))[:3])
    for d, want in zip(docs, together):
        assert np.isclose(M.log10_probabilities(book, tables, *book.symbols([d], M._Seen(book))[:3])[0], want)


def test_without_training_documents(spark):
    held = [i for i in range(60) if _split(i)][:2]
    got = M.score_documents(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert len(got) == 2 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in got)
    assert M.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_block_of_scoring_stays_in_the_cache():
    """What a step of numpy works on decides the time: 256 documents side by side took arrays of megabytes."""
    book = M.Codebook([(f"w{i}".encode(), 500 - i) for i in range(400)], 2, 4)
    tables = [np.full(n, 9, np.int8) for n in book.table_sizes()]
    rng = np.random.default_rng(3)
    docs = [[f"w{i}".encode() for i in rng.integers(0, 400, 64)] for _ in range(512)]
    codes, ctx, ends, _ = book.symbols(docs, M._Seen(book))
    tracemalloc.start()
    M.log10_probabilities(book, tables, codes, ctx, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20


def test_context_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "CODED_WORDS", 12)
    monkeypatch.setattr(M, "COUNT_TOKENS", 7)  # a slice of tokens ends inside documents
    df = spark.createDataFrame([(t,) for _, t in ROWS], "text string").repartition(3)
    book, tables = M.learn(df, M.word_counts(df))
    cache, want = M._Seen(book), [Counter() for _ in tables]
    for _, t in ROWS:
        codes, ctx, _, _ = book.symbols([(t or "").lower().encode().split()], cache)
        for j, sym in enumerate(codes.tolist()):
            at = int(book.at[sym])
            for node, bit in zip(book.node[at:at + book.size[sym]].tolist(), book.bit[at:at + book.size[sym]].tolist()):
                want[0][node, bit] += 1
                for c, w in zip(ctx, want[1:]):
                    x = (int(c[j]) ^ (node * 0xD6E8FEB86659FD93) % 2**64) * 0x9FB21C651E98DF25 % 2**64
                    w[x >> (64 - M.SLOT_BITS), bit] += 1
    for table, counts in zip(tables, want):
        expect = np.zeros(len(table), np.int8)
        for slot in {s for s, _ in counts}:
            expect[slot] = np.clip(np.rint(np.log((counts[slot, 1] + 0.4) / (counts[slot, 0] + 0.4)) * M._STEP), -127, 127)
        assert np.array_equal(table, expect)


def test_tokens_in_arrays_equal_words_of_each_text():
    """Tokens are cut and looked up without a Python object for each: 1,255 CPU seconds a GB went mostly into those."""
    texts = ["Ab cD", None, "", "  \t\n", "x", "\x0b\x0cé\x1cÉ z\x85q\x00r \rAb", "A", "end ", " İI"]
    for array in (pa.array(texts), pa.array(["no", *texts, "no"]).slice(1, len(texts)), pa.array(texts, pa.large_string()), pa.array([None, ""], pa.string())):
        tokens, n = M.token_array(array)
        want = [[*C.lower_words(t), b""] for t in array.to_pylist()]
        assert tokens.to_pylist() == [w for d in want for w in d] and n.tolist() == [len(d) for d in want]
        book = M.Codebook([(b"ab", 5), (b"x", 3)], 2, 4)
        codes, ctx, ends, _ = book.symbols_of(tokens, n, M._Seen(book))
        assert codes.tolist() == [M.END if not w else book.code.get(w, M.ESC) for d in want for w in d]
        h = [[1, *(xxhash.xxh3_64_intdigest(w) for w in d)] for d in want]  # of the word before
        assert np.array_equal(ctx[0], C.mix64(np.array([x for d in h for x in d[:-1]], np.uint64) ^ np.uint64(0x51)))
        two = [x for d in h for x in ([2, 2] + d[1:])[:len(d) - 1]]
        assert np.array_equal(ctx[2], C.mix64(np.array(two, np.uint64) ^ np.uint64(0xA7)))
        assert ends.tolist() == np.cumsum([0, *map(len, want)]).tolist()
    parts = list(M._slices(pa.array(texts), 4))
    assert [t for p in parts for t in p.to_pylist()] == texts and len(parts) > 3
