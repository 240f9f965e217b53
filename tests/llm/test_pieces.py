import random

import numpy as np
import pytest
import sentencepiece

from isohyet.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(pieces.default_model_path())


def _texts():
    rng = random.Random(7)
    alphabet = " ▁  \n\tabcdeéßñ本語😀𐍈.,0123thein\x00_-ﬁ"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    return out + [" " * n for n in range(60)] + ["a" * n for n in range(40)] + ["", " the  cat", "über" * 2000]


def test_encoding_and_decoding_equal_the_library(model):
    m, sp = pieces.PieceModel(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = _texts()
    ids, at = m.encode_batch(texts)
    for k, t in enumerate(texts):
        got = ids[at[k]:at[k + 1]]
        assert got.tolist() == sp.encode(t)
        assert m.decode(got) == sp.decode(got.tolist())


def test_decoding_any_ids_equals_the_library(model):
    m, sp, rng = pieces.PieceModel(model), sentencepiece.SentencePieceProcessor(model_proto=model), random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(300) if rng.random() < 0.5 else rng.randrange(32000) for _ in range(rng.randint(0, 8))]
        assert m.decode(np.array(ids, dtype=np.int64)) == sp.decode(ids)


def test_frames_with_nulls_repeats_and_clashing_columns(spark, model):
    rows = [(1, None, "x"), (None, "the cat", "y"), (2, "", "z"), (2, "", "z"), (3, "本" * 3000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = pieces.decode(pieces.encode(df, model), model)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = out.collect()
    assert len(got) == 5
    for r in got:
        assert r.ids == sp.encode(r.text or "") and r.decoded == (r.text or "")
    assert pieces.encode(df.limit(0), model).count() == 0


def test_a_small_cache_gives_the_same_ids(model, monkeypatch):
    texts = ["one two three four"] * 3 + ["five six"]
    want = pieces.PieceModel(model).encode_batch(texts)[0].tolist()
    monkeypatch.setattr(pieces, "CACHE_WORDS", 1)
    m = pieces.PieceModel(model)
    m.encode_batch(["seven eight nine"])
    assert m.encode_batch(texts)[0].tolist() == want
