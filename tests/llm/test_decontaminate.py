import random

import numpy as np

from isohyet.llm import decontaminate as D


def _brute(text, items, window=10):
    w = D.words(text)
    hit, found = set(), set()
    for name, t in items:
        p = D.words(t)
        k = min(window, len(p))
        for i in range(len(p) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j:j + k] == p[i:i + k]:
                    hit.update(range(j, j + k))
                    found.add(name)
    return len(w), hit, found


def _corpus(seed, vocab=3, n=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcdefgh"[:vocab]) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + [None, "", "  ", texts[0], "A b, a-B"], [(str(i), " ".join(rng.choice("abcdefgh"[:vocab]) for _ in range(rng.randint(0, 14)))) for i in range(8)] + [("n", None)]


def test_hits_equal_brute_force_also_over_small_shards():
    for seed, shard in ((1, 1 << 20), (2, 100), (3, 7)):  # 7 words: documents are cut into overlapping pieces
        texts, items = _corpus(seed)
        ph = D.Phrases(items, 4)
        for t, (n, mask, own) in zip(texts, D.find(texts, ph, shard)):
            want = _brute(t, items, 4)
            assert (n, set(np.flatnonzero(mask).tolist()), {ph.names[o] for o in own}) == want


def test_suffix_array_and_location():
    rng = np.random.default_rng(4)
    for seq in (rng.integers(1, 4, 400), np.ones(70, np.int64), np.tile([1, 2, 3], 50)):
        seq = np.append(seq, 0).astype(np.int64)
        want = sorted(range(len(seq)), key=lambda i: seq[i:].tolist())
        assert D.suffix_array(seq, 5).tolist() == want
        fm = D.FMIndex(seq, 5)
        assert fm.locate(np.arange(len(seq))).tolist() == want


def test_spans_are_merged_and_cut():
    text = "Keep this. One two THREE four, five six; and this stays."
    items = [("1", "one two three four five"), ("2", "four five six")]
    (n, mask, own), = D.find([text], D.Phrases(items, 3))
    spans = D.spans_of(mask)
    assert n == 11 and spans == [(2, 8)] and len(own) == 2
    assert D.cut_spans(text, spans) == "Keep this. ; and this stays."


def test_frames_and_blocks(spark, monkeypatch):
    texts, items = _corpus(6)
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, hits string")
    bench = spark.createDataFrame([(int(i) if i.isdigit() else None, t) for i, t in items], "item_id long, text string")
    out = D.find_spans(docs.drop("hits"), bench, window=4)
    want = {r.doc_id: r.hits for r in out.collect()}
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)  # several passes give what one gives
    assert {r.doc_id: r.hits for r in D.find_spans(docs.drop("hits"), bench, window=4).collect()} == want
    for i, t in enumerate(texts):
        assert (want[i].n_words, want[i].n_hit) == (lambda b: (b[0], len(b[1])))(_brute(t, items, 4))
    kept = D.remove_benchmark(docs, bench)
    assert kept.columns == docs.columns
    assert D.find_spans(docs.drop("hits"), bench.limit(0)).where("hits.n_hit > 0").count() == 0
    assert D.remove_benchmark(docs.limit(0), bench).count() == 0
