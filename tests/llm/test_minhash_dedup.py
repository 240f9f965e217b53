import random

from isohyet.llm import common as C
from isohyet.llm import minhash_dedup as M


def _brute(rows, percent=85):
    """Components by all pairs of exact shingle sets."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def _corpus(seed, n_bases=12, copies=9):
    rng = random.Random(seed)
    rows, k = [], 0
    for _ in range(n_bases):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(5, 200))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((k, " ".join(w)))
            k += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = _corpus(1) + [(10001, None), (10002, ""), (10003, "one two"), (10004, "One  two"), (10005, " \n")]
    got = {r.doc_id: r for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, (n, root) in _brute(rows).items():
        assert (got[d].n_shingles, got[d].component_id, got[d].kept) == (n, root, d == root)


def test_a_large_group_of_near_copies_is_one_component_if_linked(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(120):  # about half of the pairs are links, all are candidates
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = f"x{k}"
        rows.append((k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: root for d, (_, root) in _brute(rows).items()}


def test_members_that_stay_outside_meet_their_bucket_in_one_step(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):  # edits of a small vocabulary: few shingles are of one row alone, many rows link with none
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[10 * rng.randrange(12)] = f"x{rng.randrange(3)}"
        rows.append((k, " ".join(w)))
    steps = []
    counted = M._counted
    monkeypatch.setattr(M, "_counted", lambda df, name, *h: (steps.append(name), counted(df, name, *h))[1])
    monkeypatch.setattr(M, "BLOCK", 500, raising=False)  # many blocks
    got = {r.doc_id: r.component_id for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: root for d, (_, root) in _brute(rows).items()}
    assert got == want
    assert len(set(want.values())) > 20 and steps.count("minhash-rows") <= 3


def test_star_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, k) for k in range(400, 460)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out, _ = M.components(spark.createDataFrame(edges, "x long, y long"))
    assert {r.node: r.comp for r in out.collect()} == {k: find(k) for k in root}


def test_keep_one_and_edge_rows(spark):
    same = " ".join(f"w{i}" for i in range(60))
    rows = [(2, same, 1), (1, same, 1), (1, same, 1), (None, same, 1), (3, None, 1), (4, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    out = M.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in out.collect()) == sorted([(False, 1), (True, None), (False, 3), (False, 4)], key=lambda x: (x[0], x[1] or 0))
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_signature_estimates_the_similarity():
    a, b = M._universal()
    cache = C.new_cache()
    x = M.shingle_set(" ".join(f"w{i}" for i in range(400)), cache)
    y = M.shingle_set(" ".join(f"w{i}" for i in range(40, 440)), cache)
    true = len(set(x) & set(y)) / len(set(x) | set(y))
    assert abs((M.signature(x, a, b) == M.signature(y, a, b)).mean() - true) < 0.15
