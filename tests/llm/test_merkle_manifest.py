import hashlib
import random
import zlib

import duckdb
import pytest

from isohyet.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, total long, g string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(enc(r[0]), enc(r[3]), enc(r[2]), enc(r[4]), enc(text))


def tree(nodes):
    """Levels of a tree from the leaves to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i:i + 3]) for i in range(0, len(low), 3)])
    return levels


def steps(levels, at):
    out = []
    for low in levels[:-1]:
        first = at // 3 * 3
        out.append((low[first:at], low[at + 1:first + 3]))
        at //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tree([leaf(r, r[1]) for r in by[s]])
    over = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            proof = steps(trees[s], i) + steps(over, k)
            crc = zlib.crc32(("" if r[0] is None else str(r[0])).encode())
            text = r[1].replace("\n", "") if crc % 2 == 0 and r[1] is not None else r[1]
            node = leaf(r, text)
            for left, right in proof:
                node = h(*left, node, *right)
            root = over[-1][0]
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], root, h(*[x for a, b in proof for x in a + b]), node, node == root))
    return sorted(out, key=str)


def rows(n, sources, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = rng.choice([None, "", "a\nb", "plain", "é\n" * 3, "long " * 3000])
        out.append((i * 7, text, rng.choice([None, "en", ""]), rng.choice(sources), rng.choice([None, 0, 12]), "x", -1, "clash"))
    return out


def run(spark, data, tmp_path):
    spark.createDataFrame(data, SCHEMA).repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in M.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("n,sources", [(1, ["s"]), (4, [None, "", "a"]), (40, ["é", "z", "a", None, "", "aa"])])
def test_equals_brute_force(spark, tmp_path, n, sources):
    data = rows(n, sources, n)
    assert run(spark, data, tmp_path) == brute(data)


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    data = [(None, "t\n", None, "s", 1, "", 0, ""), (5, "one\n", None, "s", 1, "", 0, ""), (5, "two", None, "s", 1, "", 0, ""),
            (5, "two", None, "s", 1, "", 0, ""), (6, None, None, None, None, "", 0, "")]
    assert run(spark, data, tmp_path / "a") == brute(data)
    assert run(spark, [], tmp_path / "b") == []


def test_several_rounds(spark, tmp_path, monkeypatch):
    """Blocks of nine leaves: a hot source needs several rounds, as does the tree of the sources."""
    monkeypatch.setattr(M, "LEVELS", 2)
    monkeypatch.setattr(M, "_STEP", 9)
    data = rows(700, ["hot"] * 20 + [f"s{i}" for i in range(25)], 3)
    assert run(spark, data, tmp_path) == brute(data)


def test_sql_twin(spark, tmp_path):
    data = rows(60, ["a", "b", "c", "d", None], 9)
    got = run(spark, data, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(M.SQL).fetchall(), key=str) == got


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, "s", f"text {i}") for i in range(30)], "doc_id long, source string, text string")
    out = M.build(docs.select("doc_id", "source", M.leaf_hash([F.col("text")]).alias("leaf")))
    good = out.where(M.fold(F.col("leaf"), F.col("proof")) == M.hex_text(F.col("root"))).count()
    bad = out.where(M.fold(F.unhex(F.sha2("leaf", 256)), F.col("proof")) == M.hex_text(F.col("root"))).count()
    assert (good, bad) == (30, 0)
