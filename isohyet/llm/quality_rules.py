"""Line-first quality rules, in DataFrame functions only.

Each line is judged on its own (punctuation, navigation, boilerplate, no letters); failing
lines are removed, and a document that loses too much of its text, or fails the base counts
(too few words, too many repeated three-word windows), is rejected.

Everything is a narrow projection: no shuffle, no Python, one pass over the text, so a hot
source, a group of copies or a long document only costs its own length.

Edge cases: null and empty texts have no words, fail the base rule (fewer than
``MIN_WORDS``) and are rejected, with zero counts and an empty cleaned text; a very long text
is one row's array work, ``n log n`` in its words; repeated rows and equal ids are judged
row by row; an empty table gives an empty result. Extra columns pass through; those named
like a result column are replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.session import materialize

MIN_WORDS = 50
#: Percent of words that may lie in repeated three-word windows.
MAX_REPEAT_PERCENT = 50
#: A line fails when more than this percent of its characters are symbols.
MAX_SYMBOL_PERCENT = 10
#: A document is rejected when failing lines hold more than this percent of its characters.
MAX_LOST_PERCENT = 50

_SPACES = "\t\n\x0b\x0c\r"
_WORD = r"[^\x20\x09-\x0D]+"
_BOILERPLATE = (r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)"
                r"|use cookies|enable javascript|skip to (main )?content|click here to"
                r"|sign up for our newsletter|back to top|powered by [a-z]+)\b")

RESULT_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                  "n_lines", "n_bad_lines", "n_kept_chars", "n_lost_chars", "clean_text", "kept"]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), "")


def _repeat_words(tri: Column) -> Column:
    """Words inside three-word windows that occur at least twice, from (hash, start) sorted by hash."""
    hit = F.filter(tri, lambda x, i: (x["h"] == F.get(tri, i - 1)["h"]) | (x["h"] == F.get(tri, i + 1)["h"]))
    starts = F.sort_array(F.transform(hit, lambda x: x["i"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("int").alias("last"))
    return F.aggregate(starts, zero, lambda a, s: F.struct(
        (a["n"] + F.least(F.lit(3), s - a["last"])).cast("long").alias("n"), s.cast("int").alias("last")),
        lambda a: a["n"])


def _good_line(line: Column) -> Column:
    chars = F.length(line)
    symbols = F.length(F.translate(line, "#*$%&<>", ""))
    words = F.regexp_count(line, F.lit(_WORD))
    pipes = F.regexp_count(line, F.lit(r"\|"))
    bangs = F.regexp_count(line, F.lit("!!"))
    punct = line.rlike(r"[#*$%&<>!]") & (((chars - symbols) * 100 > chars * MAX_SYMBOL_PERCENT) | (bangs * 2 > words))
    nav = line.contains("|") & (pipes * 5 >= words)
    return ~(punct | nav | ~line.rlike(r"\p{L}") | line.rlike(_BOILERPLATE))


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input's columns plus ``RESULT_COLUMNS``; see the module text for the edge cases."""
    keep = [c for c in docs.columns if c.lower() not in RESULT_COLUMNS]
    t = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in keep], t.alias("__t"))
    base = base.select(*keep, "__t", words_of(F.col("__t")).alias("__w"),
                       F.filter(F.split("__t", "\n"), lambda x: x.rlike(_WORD)).alias("__l"))
    w = F.col("__w")
    n = F.size(w)
    tri = F.arrays_zip(F.slice(w, 1, F.greatest(n - 2, F.lit(0))).alias("a"),
                       F.slice(w, 2, F.greatest(n - 2, F.lit(0))).alias("b"),
                       F.slice(w, 3, F.greatest(n - 2, F.lit(0))).alias("c"))
    base = base.select(*keep, "__t", "__l", n.cast("long").alias("n_words"),
                       F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                       F.sort_array(F.transform(tri, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i")))).alias("__tri"),
                       F.filter("__l", _good_line).alias("__good"))
    base = base.select(
        *keep, "n_words", "word_chars",
        (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__tri")).alias("n_repeat_words"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size("__good")).cast("long").alias("n_bad_lines"),
        F.length(F.array_join("__l", "")).cast("long").alias("__chars"),
        F.length(F.array_join("__good", "")).cast("long").alias("n_kept_chars"),
        F.array_join("__good", "\n").alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    base = base.withColumn("base_failed", failed).withColumn("n_lost_chars", F.col("__chars") - F.col("n_kept_chars"))
    lost = F.col("n_lost_chars") * 100 > F.col("__chars") * MAX_LOST_PERCENT
    return base.withColumn("kept", ~F.col("base_failed") & ~lost).select(*keep, *RESULT_COLUMNS)


def keep_clean(docs: DataFrame) -> DataFrame:
    """Documents that pass, with their failing lines removed and ``n_chars`` brought up to date.

    A text without a failing line stays byte for byte as it was.
    """
    cols = docs.columns
    extra = [c for c in cols if c.lower() in RESULT_COLUMNS]  # a clash: carried under another name meanwhile
    d = docs.withColumnsRenamed({c: f"__in_{c}" for c in extra})
    # Written first: a filter pushed below the projections would work out every rule many times over.
    r = materialize(judge(d), "judged").where("kept")
    text = F.when(F.col("n_bad_lines") == 0, F.col("text")).otherwise(F.col("clean_text"))
    out = []
    for c in cols:
        if c == "text":
            out.append(text.alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("n_bad_lines") == 0, F.col("n_chars")).otherwise(
                F.length("clean_text")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            out.append(F.col(f"__in_{c}" if c in extra else c).alias(c))
    return r.select(*out)


SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM base
), grams AS (
  SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM parts WHERE len(w) >= 3)
), twice AS (
  SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN twice USING (doc_id, g)) GROUP BY doc_id
), lines AS (
  SELECT doc_id, x, length(x) AS chars,
         NOT ((regexp_matches(x, '[#*$%&<>!]')
               AND ((length(x) - length(translate(x, '#*$%&<>', ''))) * 100 > length(x) * 10
                    OR len(regexp_extract_all(x, '!!')) * 2 > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))))
              OR (contains(x, '|') AND len(regexp_extract_all(x, '\|')) * 5 >= len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))
              OR NOT regexp_matches(x, '\p{L}')
              OR regexp_matches(x, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|use cookies|enable javascript|skip to (main )?content|click here to|sign up for our newsletter|back to top|powered by [a-z]+)\b')) AS good
  FROM (SELECT doc_id, unnest(l) AS x FROM parts)
), by_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT good) AS n_bad_lines, count(*) - count(DISTINCT x) AS n_dup_lines,
         sum(chars) AS chars, coalesce(sum(chars) FILTER (WHERE good), 0) AS kept_chars
  FROM lines GROUP BY doc_id
), counts AS (
  SELECT p.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines,
         coalesce(kept_chars, 0)::BIGINT AS n_kept_chars, (coalesce(chars, 0) - coalesce(kept_chars, 0))::BIGINT AS n_lost_chars,
         coalesce(chars, 0) AS chars
  FROM parts p LEFT JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines, n_kept_chars, n_lost_chars,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_chars * 100 <= chars * 50 AS kept
FROM counts
"""


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *[c for c in RESULT_COLUMNS if c != "clean_text"])
