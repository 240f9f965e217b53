"""Near-duplicate documents: universal hash minima, banding, signature check, exact check, components.

A document's set is its distinct five-word shingles (64-bit hashes). Documents with equal sets
form one class, kept as its smallest ``doc_id``. Classes meet in band buckets, and every bucket
compares its members with a leader at first: a pair is held against the signature, then
confirmed on the full sets, and confirmed links are joined into
components by alternating large-star and small-star.

Only classes that share a bucket go on. Shingles that no other of them has bound what a pair can
reach: a class that cannot reach the threshold in its bucket leaves it, and pairs that cannot are
not compared. The leaders are the most central members (fewest shingles of their own), so two
rounds of one leader a bucket join most of a group of copies at once. A bucket whose members lie in
one component needs no more work. In the others every member outside the largest component then
meets all members, by the full sets and inside the tasks: the outside members are dealt into blocks
that are held while the bucket passes, and only links that join two components come out. So no link
is lost to the choice of leaders, and a bucket of m near copies of which k stay outside sends m rows
for every block of the k, and no pairs.

Bands: 32 of 4 minima. Two sets at the threshold (0.85) share a band with probability
1 - 5e-11. The signature check lets through every pair whose estimate is above
``threshold - 6 standard errors``.

Hot keys: class and bucket minima are combined before the shuffle; the joins back are plain sort
merge joins of written tables, whose hot partitions adaptive execution splits.

Edge cases: a null, empty or blank text has an empty set and links with nothing; a text of fewer
than five words is one shingle; rows that repeat a ``doc_id`` each take the component of their own
set; a row with a null ``doc_id`` cannot be named, so it links nothing, has a null component and is
kept; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import common as C

HASHES = 128
BANDS = 32
ROWS = HASHES // BANDS
#: Bands of the first round; most copies are joined by these, and all bands follow.
FIRST_BANDS = 4
#: Rounds in which a bucket's members meet one leader; then all that are not joined meet.
LEADER_ROUNDS = 2
#: Shingles of the members that a task holds against their bucket at a time.
BLOCK = 250_000
SHINGLE = 5
_CHUNK = 4096

SET_SCHEMA = "doc_id long, n_shingles long, fp binary, sig binary"


def _universal(seed: int = 20240607) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the multiply-shift family, by a fixed rule from the seed."""
    i = np.arange(1, HASHES + 1, dtype=np.uint64)
    return C.mix64(i + np.uint64(seed)) | np.uint64(1), C.mix64(i * np.uint64(3) + np.uint64(seed))


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each of the hashes over the set, as 32-bit values."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(x), _CHUNK):
        part = x[None, i:i + _CHUNK] * a[:, None]
        part += b[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def shingle_set(text: str | None, cache: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(C.window_hashes(C.word_hashes(C.lower_words(text), cache), SHINGLE))


def _describe(batches):
    a, b = _universal()
    cache = C.new_cache()
    for rb in batches:
        ids, ns, fps, sigs = rb.column(0), [], [], []
        for t in rb.column(1):
            s = shingle_set(t.as_py(), cache)
            ns.append(len(s))
            fps.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            sigs.append(signature(s, a, b).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(ns, pa.int64()), pa.array(fps, pa.binary()),
                                          pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "fp", "sig"])


def _band_keys(batches):
    for rb in batches:
        sig = np.frombuffer(b"".join(x.as_py() for x in rb.column(1)), dtype=np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
        for j in range(ROWS):
            key = C.mix64(key * np.uint64(0x100000001B3) ^ sig[:, :, j])
        n = len(sig)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(rb.column(0).to_numpy(zero_copy_only=False), BANDS), pa.int64()),
            pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
            pa.array(key.reshape(-1).view(np.int64))], names=["rep", "band", "key"])


def _sets(batches):
    cache = C.new_cache()
    for rb in batches:
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([shingle_set(t.as_py(), cache).tobytes() for t in rb.column(1)], pa.large_binary())],
                                         names=["rep", "s"])


def _single(batches):
    """(h, rep, n): each shingle of a task's sets once, with its owner if it has one alone."""

    def out(hs, owners):
        h, at, n = np.unique(np.concatenate(hs), return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.concatenate(owners)[at]), pa.array(np.minimum(n, 2).astype(np.int32))], names=["h", "rep", "n"])

    hs, owners, size = [], [], 0
    for rb in batches:
        for rep, s in zip(rb.column(0).to_pylist(), rb.column(1)):
            hs.append(np.frombuffer(s.as_py(), np.uint64))
            owners.append(np.full(len(hs[-1]), rep, np.int64))
            size += len(hs[-1])
            if size > 2_000_000:
                yield out(hs, owners)
                hs, owners, size = [], [], 0
    if hs:
        yield out(hs, owners)


def _agreeing(least: int):
    """Pairs whose signatures agree in at least ``least`` places, with that number."""

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            p, q = (np.frombuffer(b"".join(x.as_py() for x in rb.column(i)), dtype=np.uint32).reshape(-1, HASHES) for i in (2, 3))
            same = (p == q).sum(axis=1).astype(np.int32)
            ok = pa.array(same >= least)
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(ok), rb.column(1).filter(ok), pa.array(same).filter(ok)], names=["x", "y", "same"])
    return run


def _confirmed(percent: int):
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches):
        for rb in batches:
            ok = []
            for p, q in zip(rb.column(2), rb.column(3)):
                p, q = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            m = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(m), rb.column(1).filter(m)], names=["x", "y"])
    return run


def _meet(percent: int):
    """Links between a block's first rows (role 0) and all rows of the bucket that join two components of the block.

    Rows come by bucket, block and role, so the first rows are held and the others pass one by one. Intersections
    are counted by the places of the held shingles, all held sets at once.
    """

    def run(batches):
        group, reps, roots, parts, index = None, [], [], [], None
        up: dict[int, int] = {}

        def root(c):
            while up.get(c, c) != c:
                up[c] = c = up.get(up[c], up[c])
            return c

        for rb in batches:
            xs, ys = [], []
            for key, block, role, rep, comp, s in zip(*(rb.column(i).to_pylist() for i in range(5)), rb.column(5)):
                s = np.frombuffer(s.as_py(), np.uint64)
                if (key, block) != group:
                    group, reps, roots, parts, index = (key, block), [], [], [], None
                    up.clear()
                if not role:
                    reps.append(rep), roots.append(comp), parts.append(s)
                    continue
                if index is None:
                    flat, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
                    order = np.argsort(flat, kind="stable")
                    owner = np.repeat(np.arange(len(parts)), sizes)[order]
                    values, at = np.unique(flat[order], return_index=True)
                    index = values, np.append(at, len(flat)), owner, sizes
                values, at, owner, sizes = index
                i = np.minimum(np.searchsorted(values, s), len(values) - 1)
                i = i[values[i] == s]
                n = at[i + 1] - at[i]
                took = np.arange(n.sum()) + np.repeat(at[i] - (np.cumsum(n) - n), n)
                shared = np.bincount(owner[took], minlength=len(reps))
                for k in np.flatnonzero(100 * shared >= percent * (sizes + len(s) - shared)).tolist():
                    p, q = root(roots[k]), root(comp)
                    if p != q:
                        up[max(p, q)] = min(p, q)
                        xs.append(reps[k]), ys.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["x", "y"])
    return run


def _meetings(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) that join the components which share a bucket, by the full sets.

    Members outside the bucket's largest component meet all its members. They are dealt into blocks of
    ``BLOCK`` shingles and every block is a group of its own, so a task holds one block at a time and a hot
    bucket is many groups.
    """
    of_comp = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    blocks = of_comp.groupBy("key").agg(F.max(F.struct("n", "comp", "s")).alias("m"), F.sum("s").alias("all")) \
        .select("key", F.col("m.comp").alias("main"), F.ceil((F.col("all") - F.col("m.s")) / BLOCK).cast("int").alias("blocks"))
    dealt = rows.select("key", "rep", "comp").join(blocks, "key")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    first = dealt.where("comp <> main").select("key", own.alias("block"), F.lit(0).alias("role"), "rep", "comp")
    met = first.union(dealt.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"), "rep", "comp"))
    return met.join(sets, "rep").select("key", "block", "role", "rep", "comp", "s").repartition("key", "block") \
        .sortWithinPartitions("key", "block", "role").mapInArrow(_meet(percent), "x long, y long")


def _counted(df: DataFrame, name: str, *hashed: str) -> tuple[DataFrame, str, tuple]:
    """Write a table and learn its row count and an order-free digest of its rows in the same job."""
    seen = Observation()
    digest = F.sum(F.xxhash64(*hashed).cast("decimal(38,0)")) if hashed else F.lit(0)
    out, path = C.written(df.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("d")), name)
    return out, path, (seen.get["n"], seen.get["d"])


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, comp) for every node of the edges (x, y): comp is the smallest node reachable.

    Large-star and small-star alternate; minima per node are combined before the shuffle and no
    neighbourhood is ever gathered, so a hub only makes a hot join key. Each round is one job,
    written to the shared folder. Returns the written table and its path.
    """
    spark = edges.sparkSession
    cur, path, before = _counted(edges.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "cc", "u", "v")
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        # Each node and its neighbours go to the smallest of them; (v, m) also for v = m's own row, which drops out.
        small = large.join(low2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where("u <> v").distinct()
        cur, new, now = _counted(small, "cc", "u", "v")
        C.drop_written(spark, path)
        path = new
        if now == before:
            # At the fixed point every node has one edge, to the root of its star.
            return cur.union(cur.select(F.col("v").alias("u"), "v")).distinct().select(F.col("u").alias("node"), F.col("v").alias("comp")), path
        before = now


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp (digest of the set), sig (its minima); the last two null for an empty set."""
    C.ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_describe, SET_SCHEMA)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links need 100 * I >= percent * U."""
    spark = docs.sparkSession
    C.ship_package(spark)
    trash: list[str] = []

    def put(df, name):
        out, path = C.written(df, name)
        trash.append(path)
        return out

    with C.small_batches(spark, 1000):
        desc = put(describe(docs), "minhash-sets")
    named = desc.where("fp is not null and doc_id is not null")
    reps = put(named.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "minhash-classes")
    sigs = reps.select("rep", "sig")
    active = sigs.mapInArrow(_band_keys, "rep long, band int, key long")
    least = int(np.floor(HASHES * percent / 100 - 6 * np.sqrt(HASHES * percent / 100 * (1 - percent / 100))))
    # Buckets of one class have nothing to compare and go before the first round.
    active = put(active.join(active.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("key"), "key", "left_semi"), "minhash-bands")
    with C.small_batches(spark, 1000):
        sets = put(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(active.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                   .mapInArrow(_sets, "rep long, s binary"), "minhash-full")
    # Shingles that one class alone has cannot be shared: with m the smaller rest, J <= m / (sizes - m).
    own = sets.select("rep", "s").mapInArrow(_single, "h long, rep long, n int").groupBy("h").agg(F.sum("n").alias("n"), F.min("rep").alias("rep")) \
        .where("n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    sizes = sets.select("rep", (F.octet_length("s") / 8).cast("long").alias("size")).distinct()
    info = put(sizes.join(own, "rep", "left").select("rep", "size", F.coalesce("own", F.lit(0)).alias("own")).join(sigs, "rep"), "minhash-info")
    # In a bucket whose smallest set has s shingles, a class can reach no more than rest / (size + max(s, rest) - rest).
    with_own = active.join(info.select("rep", "size", "own"), "rep")
    least_size = with_own.groupBy("key").agg(F.min("size").alias("s"))
    rest = F.col("size") - F.col("own")
    active = put(with_own.join(least_size, "key").where(rest * 100 >= percent * (F.col("size") + F.greatest("s", rest) - rest)).drop("s"), "minhash-active")

    def joined(found: DataFrame, comps: DataFrame | None) -> DataFrame:
        # What is joined already stands for its links: the stars of the last round and the new ones.
        edges = found if comps is None else found.union(comps.where("node <> comp").select(F.col("node").alias("x"), F.col("comp").alias("y")))
        out, path = components(edges)
        trash.append(path)
        return out

    comps: DataFrame | None = None
    rounds = 0
    while True:
        rows = active.where(F.col("band") < FIRST_BANDS) if rounds == 0 else active
        if comps is not None:
            rows = rows.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        else:
            rows = rows.withColumn("comp", F.col("rep"))
        rows = rows.select("rep", "band", "key", "size", "own", "comp")
        if rounds:  # buckets that still span two components
            rows = rows.join(rows.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key"), "key", "left_semi")
        rows, path, (n, _) = _counted(rows, "minhash-rows")
        trash.append(path)
        if rounds and not n:
            break
        if rounds == LEADER_ROUNDS:
            with C.small_batches(spark, 500):
                found, path, (n, _) = _counted(_meetings(rows, sets, percent).distinct(), "minhash-links")
            trash.append(path)
            if n:
                comps = joined(found, comps)
            break
        # One leader of each bucket, the most central member at first.
        order = F.xxhash64("key", "rep", F.lit(rounds))
        leaders = rows.groupBy("key").agg(F.min(F.struct(F.col("own").alias("f"), order.alias("o"), "rep", "comp", "size", "own")).alias("l")) \
            .select("key", F.col("l.rep").alias("y"), F.col("l.comp").alias("yc"), F.col("l.size").alias("ys"), F.col("l.own").alias("yo"))
        both = F.least(F.col("size") - F.col("own"), F.col("ys") - F.col("yo"))
        reach = both * 100 >= percent * (F.col("size") + F.col("ys") - both)
        pairs = rows.join(leaders, "key").where((F.col("comp") != F.col("yc")) & reach).select(F.col("rep").alias("x"), "y").distinct()
        near = pairs.join(info.select(F.col("rep").alias("x"), F.col("sig").alias("p")), "x") \
            .join(info.select(F.col("rep").alias("y"), F.col("sig").alias("q")), "y") \
            .select("x", "y", "p", "q").mapInArrow(_agreeing(least), "x long, y long, same int")
        if rounds == 0:
            # The closest leader first: one exact check per class joins most of them.
            near = near.groupBy("x").agg(F.max(F.struct("same", "y")).alias("b")).select("x", F.col("b.y").alias("y"))
        near, path, (n, _) = _counted(near, "minhash-near")
        trash.append(path)
        if n:
            met = sets.join(near.select(F.col("x").alias("rep")).union(near.select("y")).distinct(), "rep", "left_semi")
            with C.small_batches(spark, 500):
                found, path, (n, _) = _counted(near.join(met.select(F.col("rep").alias("x"), F.col("s").alias("p")), "x")
                                               .join(met.select(F.col("rep").alias("y"), F.col("s").alias("q")), "y")
                                               .select("x", "y", "p", "q").mapInArrow(_confirmed(percent), "x long, y long"), "minhash-links")
            trash.append(path)
        if n:
            comps = joined(found, comps)
        if rounds:
            active = put(rows.select("rep", "band", "key", "size", "own").join(leaders.select("key", F.col("y").alias("rep")), ["key", "rep"], "left_anti"), "minhash-active")
        rounds += 1

    label = reps.select("fp", "rep")
    if comps is not None:
        label = label.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("comp", "rep").alias("comp"))
    else:
        label = label.select("fp", F.col("rep").alias("comp"))
    out = put(desc.select("doc_id", "n_shingles", "fp").join(label, "fp", "left")
              .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")), "minhash-out")
    C.drop_written(spark, *trash[:-1])
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The documents' own columns with one row for each near-duplicate group.

    Rows that repeat a kept ``doc_id`` are copies when their sets are equal, and one stays.
    """
    name = "__doc_id"
    kept = near_duplicates(docs, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    # One row of each id: the join already deals rows by id, so this adds no shuffle.
    one = docs.where("doc_id is not null").withColumn(name, F.col("doc_id").cast("long")) \
        .join(kept, name, "left_semi").dropDuplicates([name]).select(*docs.columns)
    return one.unionByName(docs.where("doc_id is null"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM words
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.node WHERE r.root < l.y
), comp AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id JOIN comp c ON c.node = w.doc_id
"""
