"""Merkle manifest of a dataset: a hash for every row, a root for every source and one for all, and a proof a row.

A row's leaf is the SHA-256 of its fields. The leaves of a source, in the order of their ids, are the
lowest nodes of its tree; each run of three consecutive nodes becomes their parent until one node is
left, and the sources' roots are the leaves of the tree above them. A level is a slot pivot:
conditional aggregates spread the children of each parent into one column a slot; the hash of the
concatenated columns is the parent, and the columns without the own slot are the siblings.

``LEVELS`` levels are done after one exchange: blocks of 3**LEVELS consecutive leaves are dealt by
(source, block), and each level is a window over a parent's leaves within that dealing. The blocks'
roots are the nodes of the next round, so rounds grow with the logarithm of the largest source, and
proofs come back down by a join on (source, block). A source that holds a third of all rows is many
blocks, as the places of its leaves come from ranges of (source, id). The driver reads one number a
round, the largest number of nodes of a source.

Edge cases: a null field is ``-``, so null and empty differ; a null source is a source of its own and
comes first, as does a null id within its source; rows that share an id stay apart, in the order of their leaves; a source
of one row has its leaf as its root; an empty table gives no rows; very long texts are hashed whole;
columns beside those of the leaf are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isohyet.llm import common as C

FANOUT = 3
#: Levels that are done after one exchange.
LEVELS = 6
#: Fields of a leaf of ``documents``, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = FANOUT ** LEVELS


def _or_none(c: Column) -> Column:
    return F.coalesce(c, F.unhex(F.lit("")))


def encoded(c: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def hex_text(c: Column) -> Column:
    return F.lower(F.hex(c))


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 over the encoded fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in fields]), 256))


def _parent(children: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[hex_text(_or_none(c)) for c in children]), 256))


def _round(nodes: DataFrame) -> DataFrame:
    """LEVELS levels: ``top`` is the node above each of ``nodes`` (g, pos, total, hash), ``proof`` its siblings on the way."""
    kept = nodes.columns
    d = nodes.withColumn("block", F.floor(F.col("pos") / _STEP)).repartition("g", "block").withColumn("top", F.col("hash"))
    steps = []
    for level in range(LEVELS):
        slot = F.floor(F.col("pos") / FANOUT ** level) % FANOUT
        run = Window.partitionBy("g", "block", F.floor(F.col("pos") / FANOUT ** (level + 1)))
        d = d.select("*", *[F.max(F.when(slot == s, F.col("top"))).over(run).alias(f"slot{s}") for s in range(FANOUT)])
        slots = [F.col(f"slot{s}") for s in range(FANOUT)]
        others = lambda keep: F.concat(*[_or_none(F.when(keep(s), c)) for s, c in enumerate(slots)])
        siblings = F.struct(others(lambda s: slot > s).alias("left"), others(lambda s: slot < s).alias("right"))
        d = d.withColumn(f"step{level}", siblings) \
            .withColumn("top", F.when(F.col("total") > FANOUT ** level, _parent(slots)).otherwise(F.col("top"))) \
            .drop(*[f"slot{s}" for s in range(FANOUT)])
        steps.append((F.col("total") > FANOUT ** level).cast("int"))
    proof = F.slice(F.array(*[f"step{i}" for i in range(LEVELS)]), F.lit(1), sum(steps[1:], steps[0]))
    return d.select(*kept, "block", "top", proof.alias("proof"))


def _climb(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The written rounds from the leaves to one node for each g; ``most`` is the largest total."""
    rounds = []
    while True:
        done, _ = C.written(_round(nodes), f"{name}-{len(rounds)}")
        rounds.append(done)
        if most <= _STEP:
            return rounds
        most = -(-most // _STEP)
        nodes = done.where(F.col("pos") % _STEP == 0).select(
            "g", F.col("block").alias("pos"), F.ceil(F.col("total") / _STEP).alias("total"), F.col("top").alias("hash"))


def _descend(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Proofs and roots of the last round, joined down to the first by block."""
    for below in reversed(rounds[:-1]):
        above = top.select("g", F.col("pos").alias("block"), F.col("proof").alias("_above"), "subroot", "root")
        top = below.drop("top").join(above, ["g", "block"]).withColumn("proof", F.concat("proof", "_above")).drop("_above")
    return top


def _most(nodes: DataFrame) -> int:
    return nodes.agg(F.max("total")).first()[0] or 0


def build(leaves: DataFrame, id_col: str = "doc_id", group: str = "source") -> DataFrame:
    """``leaves`` (id, group, 32-byte ``leaf`` and more) with ``subroot``, ``root`` (32 bytes) and ``proof``.

    ``proof`` is an array from the leaf to the root of the siblings left and right of the node, each the
    concatenation of 32-byte hashes; a level without siblings is an entry too, as its node is hashed again.
    """
    given = leaves.columns
    base, _ = C.written(leaves.select(F.struct(*given).alias("row"), encoded(F.col(group)).alias("g"), F.col(group).alias("by"),
                                      F.col(id_col).alias("id"), F.col("leaf").alias("hash")), "merkle-leaves")
    placed, _ = C.positions(base, [F.col("id").asc_nulls_first(), F.col("hash")], "g", "merkle-order")
    placed = placed.drop("id")
    rounds = _climb(placed, _most(placed.select("total")), "merkle-rows")
    first = rounds[0].where("pos = 0").select("g", "by")  # a source's name, for the order of the sources
    last = rounds[-1]
    subroots = last.where("pos = 0").select("g", F.col("top").alias("hash"))
    subroots, _ = C.written(subroots.join(first, "g"), "merkle-sources")
    ordered, _ = C.positions(subroots, [F.col("by").asc_nulls_first()], name="merkle-source-order")
    ordered = ordered.select(F.lit("").alias("g"), F.col("g").alias("member"), "pos", "total", "hash")
    over = _climb(ordered, _most(ordered.select("total")), "merkle-roots")
    roots = _descend(over, over[-1].withColumn("root", F.col("top")).withColumn("subroot", F.col("hash")))
    sources = roots.select(F.col("member").alias("g"), F.col("hash").alias("subroot"), "root", F.col("proof").alias("_above"))
    top = last.drop("top").join(sources, "g").withColumn("proof", F.concat("proof", "_above")).drop("_above")
    return _descend(rounds, top).select("row.*", "subroot", "root", "proof")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give, as hex text."""
    step = lambda h, s: F.sha2(F.concat(hex_text(s["left"]), h, hex_text(s["right"])), 256)
    return F.aggregate(proof, hex_text(leaf), step)


def proof_text(proof: Column) -> Column:
    """All siblings from the leaf up, left to right, as one hex text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(hex_text(s["left"]), hex_text(s["right"]))), "")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select(*FIELDS)
    cut = F.when(C.crc_of_id("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "source", leaf_hash([F.col(f) for f in FIELDS]).alias("leaf"),
                         leaf_hash([cut if f == "text" else F.col(f) for f in FIELDS]).alias("tampered"))
    out = build(leaves)
    out = out.select("doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), hex_text(F.col("root")).alias("root"),
                     F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), fold(F.col("tampered"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(':' || source, '-') AS g,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT),
           lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, source, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS tampered
  FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), up AS (
  SELECT 0 AS lvl, g, pos, leaf AS h FROM placed
  UNION ALL
  SELECT lvl + 1, g, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM up) WHERE n > 1 GROUP BY lvl, g, pos // 3
), tops AS (
  SELECT g, max(lvl) AS top FROM up GROUP BY g
), subs AS (
  SELECT u.g, u.h, row_number() OVER (ORDER BY s.source NULLS FIRST) - 1 AS pos
  FROM up u JOIN tops t ON u.g = t.g AND u.lvl = t.top JOIN (SELECT DISTINCT g, source FROM leaves) s ON s.g = u.g
), over_ AS (
  SELECT 0 AS lvl, pos, h FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM over_) WHERE n > 1 GROUP BY lvl, pos // 3
), nodes AS (
  SELECT u.g, u.lvl, u.pos, u.h FROM up u JOIN tops t ON u.g = t.g AND u.lvl < t.top
), steps AS (
  SELECT p.g, p.pos, l.lvl, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < p.pos // (3 ** l.lvl)::BIGINT), '') AS before,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > p.pos // (3 ** l.lvl)::BIGINT), '') AS after
  FROM placed p JOIN (SELECT DISTINCT g, lvl FROM nodes) l ON l.g = p.g
  JOIN nodes n ON n.g = p.g AND n.lvl = l.lvl AND n.pos // 3 = (p.pos // (3 ** l.lvl)::BIGINT) // 3
  GROUP BY p.g, p.pos, l.lvl
  UNION ALL
  SELECT p.g, p.pos, t.top + l.lvl, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < s.pos // (3 ** l.lvl)::BIGINT), ''),
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > s.pos // (3 ** l.lvl)::BIGINT), '')
  FROM placed p JOIN subs s ON s.g = p.g JOIN tops t ON t.g = p.g JOIN (SELECT DISTINCT lvl FROM over_ WHERE lvl < (SELECT max(lvl) FROM over_)) l ON true
  JOIN over_ n ON n.lvl = l.lvl AND n.pos // 3 = (s.pos // (3 ** l.lvl)::BIGINT) // 3
  GROUP BY p.g, p.pos, t.top + l.lvl
), folds AS (
  SELECT 0 AS lvl, g, pos, tampered AS h FROM placed
  UNION ALL
  SELECT f.lvl + 1, f.g, f.pos, sha256(s.before || f.h || s.after) FROM folds f JOIN steps s ON s.g = f.g AND s.pos = f.pos AND s.lvl = f.lvl
), proofs AS (
  SELECT g, pos, sha256(string_agg(before || after, '' ORDER BY lvl)) AS proof FROM steps GROUP BY g, pos
), ends AS (
  SELECT g, pos, max_by(h, lvl) AS folded FROM folds GROUP BY g, pos
), root AS (
  SELECT max_by(h, lvl) AS root FROM over_
)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.root, coalesce(x.proof, sha256('')) AS proof_sha256, e.folded AS folded_root, e.folded = r.root AS verified
FROM placed p JOIN subs s ON s.g = p.g CROSS JOIN root r JOIN ends e ON e.g = p.g AND e.pos = p.pos LEFT JOIN proofs x ON x.g = p.g AND x.pos = p.pos
"""
