import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from isohyet.llm import target_resampling as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, id string, pos long, n_words string"
BENCH = "item_id long, text string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    w = WORD.findall(lowered(text))
    return len(w), [" ".join(w[i:i + n]).encode() for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, bench):
    bucket = lambda f: zlib.crc32(f) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for _, text in docs:
        for f in features(text)[1]:
            s[bucket(f)] += 1
    for _, text in bench:
        for f in features(text)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    out = []
    for i, text in docs:
        n, fs = features(text)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n >= 20])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["The", "of", "été", "naïve", "x" * 70, "42", "ÀB", "𝔘𝔫𝔦", "the"] + [f"w{i}" for i in range(60)]
    text = lambda k: rng.choice(["", "-"]) + "".join(rng.choice(words) + rng.choice([" ", "_", "\n", ", ", " ", "\x85"]) for _ in range(k))
    docs = [(i * 3, text(rng.choice([0, 1, 2, 3, 19, 20, 21, 200])), "id", 1, None) for i in range(n)]
    return docs, [(i, text(40)) for i in range(10)]


def run(spark, docs, bench, path):
    spark.createDataFrame(docs, DOCS).repartition(4).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, BENCH).write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
    return sorted((tuple(r) for r in R.op13_target_resampling(spark, str(path)).collect()), key=str)


@pytest.mark.parametrize("head", [0, 12, 65_536])
def test_equals_brute_force_whatever_the_head(spark, tmp_path, monkeypatch, head):
    monkeypatch.setattr(R, "HEAD_WORDS", head)
    monkeypatch.setattr(R, "HEAD_PAIRS", head)
    monkeypatch.setattr(R, "CHUNK_BYTES", 700)
    docs, bench = corpus(150, head)
    assert run(spark, docs, bench, tmp_path) == brute([r[:2] for r in docs], bench)


def test_edge_rows_and_sql_twin(spark, tmp_path):
    docs, bench = corpus(60, 5)
    docs += [(None, "one two " * 30, "", 0, ""), (7, None, "", 0, ""), (9, docs[5][1], "", 0, ""), (9, docs[5][1], "", 0, ""), (11, "long text " * 30_000, "", 0, "")]
    bench += [(99, None)]
    got = run(spark, docs, bench, tmp_path)
    assert got == brute([r[:2] for r in docs], bench) and len(got) == len(docs)
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{tmp_path}/{n}.parquet/*.parquet'")
    assert sorted(con.execute(R.SQL).fetchall(), key=str) == got


def test_empty_tables(spark, tmp_path):
    docs, bench = corpus(30, 6)
    assert run(spark, [], bench, tmp_path / "a") == []
    assert run(spark, docs, [], tmp_path / "b") == brute([r[:2] for r in docs], [])


def test_hasher_equals_direct_crcs():
    rng = random.Random(1)
    words = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 3, 8, 64, 65, 300]))) for _ in range(40)]
    head = words[:10]
    pairs = np.array(sorted({rng.randrange(100) for _ in range(30)}))
    h = R.Hasher(head, pairs, np.array([zlib.crc32(head[p // 10] + b" " + head[p % 10]) for p in pairs], dtype=np.uint32))
    for _ in range(30):
        sizes = np.array([rng.choice([0, 1, 2, 3, 9]) for _ in range(6)])
        text = [rng.choice(words) for _ in range(sizes.sum())]
        crc, owner = h.features(text, sizes)
        want, at = [], 0
        for k, n in enumerate(sizes):
            w = text[at:at + n]
            at += n
            want += [(k, zlib.crc32(b" ".join(w[i:i + m]))) for m in (1, 2, 3) for i in range(n - m + 1)]
        assert sorted(zip(owner.tolist(), crc.tolist())) == sorted(want)


def test_drawn_rows_favour_the_target(spark):
    docs = spark.createDataFrame([(i, ("alpha beta gamma " if i % 10 == 0 else "other words here ") * 10) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([("alpha beta gamma " * 20,)], "text string")
    ranks = R.resample(docs, target, percent=5)
    drawn = R.draw(docs, ranks).collect()
    assert len(drawn) == 20 and all(r.doc_id % 10 == 0 for r in drawn)
