"""Language identification: words first, then ever shorter character n-grams.

A known word adds its log frequency in every language. A word the model does not know falls back
to its character n-grams of the longest length of which the model knows any, and adds their mean
log frequency times the word's length in n-grams of that length, as if they overlapped no more than
needed. The language with the highest sum (ties: the first by name) is the prediction, its share
of the softmax the score.

Word and n-gram counts cover every training document and are all kept, as two written tables; n-grams
are counted from the word counts. The ``KNOWN_WORDS`` most frequent words and ``KNOWN_GRAMS`` most
frequent n-grams of each length go to every task, which bounds what is sent; the other words of the
documents are joined with the table of words, and the n-grams of those not found there, but for the
frequent ones, with the table of n-grams. So a score does not depend on the bounds, and what is joined
has no hot key that the training documents know. Counts are combined inside a task before they are
shuffled, so a hot language, source or word is one row a task.

Edge cases: a text that is null or has no letter is ``und`` with score 0, as is every text when
nothing could be learnt; rows with a null ``lang`` or ``text`` are not learnt from; null ids count as
the empty text for the split; repeated rows are predicted alike; very long texts are counted whole;
extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from isohyet.llm import common as C

KNOWN_WORDS = 100_000
KNOWN_GRAMS = 50_000
LONGEST = 5
SMOOTH = 0.5
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters (with their marks)."""
    return _WORD.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its edges; none if it is too short."""
    w = f"<{word}>" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _flush(counts: Counter) -> pa.RecordBatch:
    ks = list(counts)
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in ks], pa.string()), pa.array([k[1] for k in ks], pa.string()),
                                       pa.array(list(counts.values()), pa.int64())], names=["lang", "w", "c"])


def _count_words(batches):
    held: dict[str, Counter] = {}

    def rows():
        out = Counter({(lang, w): c for lang, ws in held.items() for w, c in ws.items()})
        held.clear()
        return _flush(out)

    for rb in batches:
        for lang, t in zip(rb.column(0), rb.column(1)):
            held.setdefault(lang.as_py(), Counter()).update(words(t.as_py()))
            if sum(map(len, held.values())) > 300_000:
                yield rows()
    if held:
        yield rows()


def _count_grams(batches):
    held: dict[str, dict[str, int]] = {}
    size = 0

    def rows():
        out = Counter({(lang, g): c for lang, gs in held.items() for g, c in gs.items()})
        held.clear()
        return _flush(out)

    for rb in batches:
        for lang, w, c in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2).to_pylist()):
            of = held.setdefault(lang, {})
            before = len(of)
            for n in range(1, LONGEST + 1):
                for g in grams(w, n):
                    of[g] = of.get(g, 0) + c
            size += len(of) - before
        if size > 300_000:
            yield rows()
            size = 0
    if held:
        yield rows()


def _dealt(df: DataFrame) -> DataFrame:
    """Few bytes but much work a row: dealt over all tasks, as a scan of small files would be a handful."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class Model:
    """Log frequencies by language of the frequent words and n-grams, and the tables of all of them."""

    def __init__(self, langs: list[str], priors: list[int], words: tuple, grams: list[tuple], word_total: np.ndarray, gram_total: list[np.ndarray],
                 types: list[int], tables: tuple[DataFrame, DataFrame]):
        """types: how many words (first) and n-grams of each length the tables hold."""
        self.langs = langs
        self.at = {lang: j for j, lang in enumerate(langs)}
        self.prior = np.log(np.array(priors, float) / sum(priors)) if priors else np.zeros(0)
        self.totals = [t + SMOOTH * (n + 1) for t, n in zip([word_total, *gram_total], types)]
        self.words, self.word_rows = self._table(words, 0)
        self.grams = [self._table(g, n) for n, g in enumerate(grams, 1)]
        self.tables = tables

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "tables"}  # the tables stay on the driver

    def rows(self, counts: list[dict[str, int]], n: int) -> np.ndarray:
        """Log frequencies from counts by language, of words (n = 0) or n-grams."""
        rows = np.zeros((len(counts), len(self.langs)), np.float64)
        for i, by in enumerate(counts):
            for lang, c in by.items():
                rows[i, self.at[lang]] = c
        return self._log(rows, n)

    def _log(self, rows: np.ndarray, n: int) -> np.ndarray:
        return np.log((rows + SMOOTH) / self.totals[n]).astype(np.float32)

    def _table(self, frequent: tuple[list[str], np.ndarray], n: int):
        return {k: i for i, k in enumerate(frequent[0])}, self._log(frequent[1], n)

    def spell(self, word: str) -> list[str]:
        """Its n-grams that are not among the frequent ones."""
        return [g for n in range(1, LONGEST + 1) for g in grams(word, n) if g not in self.grams[n - 1][0]]

    def back_off(self, word: str, rare: dict[str, dict[str, int]]) -> np.ndarray:
        """Of a word that is not known; rare: the counts of what ``spell`` gave, as far as there are any."""
        for n in range(LONGEST, 0, -1):
            index, rows = self.grams[n - 1]
            gs = grams(word, n)
            known = rows[[index[g] for g in gs if g in index]]
            found = [rare[g] for g in gs if g in rare]
            if len(known) or found:
                known = np.concatenate((known, self.rows(found, n))) if found else known
                return known.mean(axis=0) * max(1.0, (len(word) + 2) / n)
        return np.zeros(len(self.langs), np.float32)


def _by(pairs) -> dict[str, int]:
    return {x["lang"]: x["c"] for x in pairs}


def _frequent(df: DataFrame, n: int, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """The n most frequent of a table and their counts by language; one compact array on the driver."""
    best = df.orderBy(F.col("t").desc(), "w").limit(n).select("w", F.col("by.lang").alias("l"), F.col("by.c").alias("c")).toArrow().combine_chunks()
    out = np.zeros((best.num_rows, len(langs)))
    if best.num_rows:
        lang, c = best.column("l").chunk(0), best.column("c").chunk(0)
        owner = np.repeat(np.arange(best.num_rows), np.diff(lang.offsets.to_numpy()))
        code = lang.flatten().dictionary_encode()
        at = np.array([langs.index(x) for x in code.dictionary.to_pylist()], np.int64)
        out[owner, at[code.indices.to_numpy()]] = c.flatten().to_numpy()
    return best.column("w").to_pylist(), out


def _table_of(counts: DataFrame, name: str) -> DataFrame:
    """w, n (its length), t (its count), by (its counts by language): one row for each w."""
    counts = counts.repartition("w").groupBy("w", "lang").agg(F.sum("c").alias("c"))
    by = counts.groupBy("w").agg(F.sum("c").alias("t"), F.collect_list(F.struct("lang", "c")).alias("by"))
    return C.written(by.select("w", F.length("w").alias("n"), "t", "by"), name)[0]


def learn(training: DataFrame) -> Model:
    """A model of the columns ``lang`` and ``text``; all counts are kept, as tables that ``predict`` joins with."""
    spark = training.sparkSession
    C.ship_package(spark)
    rows = training.where("lang is not null and text is not null").select("lang", "text")
    counts = _table_of(rows.mapInArrow(_count_words, "lang string, w string, c long"), "lang-words")
    one = counts.select("w", F.explode("by").alias("x")).select("x.lang", "w", "x.c")
    gram = _table_of(_dealt(one).mapInArrow(_count_grams, "lang string, w string, c long"), "lang-grams")
    # The rows learnt from; a language is learnt when it has a word.
    docs = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    totals = {r.lang: r.c for r in one.groupBy("lang").agg(F.sum("c").alias("c")).collect()}
    langs = sorted(totals)

    sizes = gram.select("n", F.explode("by").alias("x")).groupBy("n", "x.lang").agg(F.sum("x.c").alias("c")).collect()
    types = {r.n: r.c for r in gram.groupBy("n").agg(F.count("*").alias("c")).collect()}
    by_n = []
    for n in range(1, LONGEST + 1):
        t = {r.lang: r.c for r in sizes if r.n == n}
        by_n.append((_frequent(gram.where(F.col("n") == n), KNOWN_GRAMS, langs), np.array([t.get(x, 0) for x in langs], float)))
    return Model(langs, [docs[x] for x in langs], _frequent(counts, KNOWN_WORDS, langs), [g for g, _ in by_n], np.array([totals[x] for x in langs], float), [t for _, t in by_n],
                 [counts.count(), *[types.get(n, 0) for n in range(1, LONGEST + 1)]], (counts, gram))


_REST = pa.list_(pa.struct([("w", pa.string()), ("n", pa.int64())]))
_SUMS = pa.list_(pa.float64())


def _first_sums(sent, keep: list[str]):
    """Of each document: the sums over its frequent words, and the other words."""
    def run(batches):
        m = sent.value
        uid = TaskContext.get().partitionId() << 33
        for rb in batches:
            for i in range(0, rb.num_rows, 500):
                part = rb.slice(i, 500)
                n_words, sums, rest = [], [], []
                for t in part.column(part.schema.get_field_index("text")):
                    ws = words(t.as_py())
                    at = [m.words[w] for w in ws if w in m.words]
                    n_words.append(len(ws))
                    sums.append((m.prior + m.word_rows[at].sum(axis=0, dtype=np.float64)).tolist())
                    rest.append([{"w": w, "n": n} for w, n in Counter(w for w in ws if w not in m.words).items()])
                k = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in keep], pa.array(uid + np.arange(k)), pa.array(n_words, pa.int64()), pa.array(sums, _SUMS), pa.array(rest, _REST)],
                    names=[*keep, "__uid", "__words", "__sums", "__rest"])
                uid += k
    return run


def _spell(sent):
    def run(batches):
        for rb in batches:
            w, g = [], []
            for x in rb.column(0).to_pylist():
                s = set(sent.value.spell(x))
                w += [x] * len(s)
                g += s
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(g, pa.string())], names=["word", "w"])
    return run


def _word_sums(sent):
    """Log frequencies of words from their counts (by), or else from their n-grams (rare)."""
    def run(batches):
        m = sent.value
        for rb in batches:
            out = []
            for w, by, rare in zip(*(rb.column(i).to_pylist() for i in range(3))):
                row = m.rows([_by(by)], 0)[0] if by is not None else m.back_off(w, {x["w"]: _by(x["by"]) for x in rare or ()})
                out.append(row.astype(float).tolist())
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(out, _SUMS)], names=["w", "v"])
    return run


def _decide(langs: list[str], keep: list[str]):
    def run(batches):
        for rb in batches:
            names, scores = [], []
            for n, a, b in zip(*(rb.column(rb.schema.get_field_index(c)).to_pylist() for c in ("__words", "__sums", "__more"))):
                if not n or not langs:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = np.array(a) + (np.array(b) if b else 0.0)
                best = int(np.argmax(total))
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*[rb.column(rb.schema.get_field_index(c)) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The frame's columns but ``text``, and lang_pred and score (0 to 1)."""
    spark = docs.sparkSession
    C.ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name not in ("text", "lang_pred", "score")]
    names = [f.name for f in keep]
    first = StructType([*keep]).add("__uid", "long").add("__words", "long").add("__sums", ArrayType(DoubleType())).add("__rest", ArrayType(StructType().add("w", "string").add("n", "long")))
    scored, _ = C.written(docs.mapInArrow(_first_sums(sent, names), first), "lang-sums")
    rest = scored.select("__uid", F.explode("__rest").alias("r")).select("__uid", "r.w", "r.n")
    counts, gram = model.tables
    found, path = C.written(rest.select("w").distinct().join(counts.select("w", "by"), "w", "left"), "lang-rest")
    rare = _dealt(found.where("by is null").select("w")).mapInArrow(_spell(sent), "word string, w string").join(gram.select("w", "by"), "w") \
        .groupBy(F.col("word").alias("w")).agg(F.collect_list(F.struct("w", "by")).alias("rare"))
    rows, _ = C.written(found.join(rare, "w", "left").select("w", "by", "rare").mapInArrow(_word_sums(sent), "w string, v array<double>"), "lang-rows")
    C.drop_written(spark, path)
    sums = [F.sum(F.col("n") * F.col("v")[j]) for j in range(len(model.langs))]
    more = rest.join(rows, "w").groupBy("__uid").agg((F.array(*sums) if sums else F.array().cast("array<double>")).alias("__more"))
    return scored.drop("__rest").join(more, "__uid", "left").mapInArrow(_decide(model.langs, names), StructType([*keep]).add("lang_pred", "string").add("score", "double"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(C.crc_of_id("doc_id"), F.lit(4)) == 2
    docs = C.table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "lang", "text")
    model = learn(docs.where(~F.col("held_out")).select("lang", "text"))
    return predict(docs.select("doc_id", "held_out", "text"), model)
