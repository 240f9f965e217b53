"""SentencePiece encoding and decoding with a merge-type model, by a prefix table.

For every prefix of a piece of text, exactly one token can be the last of the prefix's encoding.
Its candidates are the tokens that an automaton finds ending there; the right one is compatible
with the last token of the prefix before it. Two tokens are compatible when undoing their merges
from the latest back never meets a pair at the seam that would have merged earlier. The ids are
then read off the table from the end. No agenda of merges is kept and the work is linear.

No token of such a model runs from a letter into a space mark, so a text falls into words that are
encoded alone; a task keeps the encodings of words it has met (at most ``CACHE_WORDS``). Runs of
space marks, whose tokens all have one score, merge from the left. Characters outside the model
become byte tokens.

Encoding and decoding are narrow: rows stay where they are, and no key is shuffled.

Edge cases: null and empty texts give no ids, and null or empty id lists the empty text; very long
texts are linear, also without spaces; repeated rows are encoded alike; empty tables stay empty;
extra columns pass through, and one named like the result is replaced. Ids outside the model raise.
"""

from __future__ import annotations

import codecs
import re
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.llm import common as C

CACHE_WORDS = 200_000
#: Rows of a result batch: keeps what a task holds at once small.
BATCH_ROWS = 1000
_MARK = "▁"
_WORD = re.compile(f"{_MARK}*[^{_MARK}]+|{_MARK}+")


def _one_by_one(e: UnicodeDecodeError):
    return "�", e.start + 1


codecs.register_error("isohyet_each_byte", _one_by_one)


class PieceModel:
    """Tables of one model, and the encoding of words."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.size = n
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = {i: sp.get_score(i) for i in plain}
        self.runs = {len(names[i]): i for i in plain if not names[i].strip(_MARK)}
        merged = [i for i in plain if len(names[i]) > 1 and names[i].strip(_MARK)]
        low = max((scores[i] for i in self.runs.values()), default=-np.inf)
        if sp.normalize("ﬁ  x") != f"{_MARK}ﬁ{_MARK}{_MARK}x":
            raise ValueError("only models that leave the text as it is, but for one space before it, are supported")
        if len({scores[i] for i in merged}) < len(merged) or any(scores[i] <= low for i in merged) \
                or any(re.search(f"[^{_MARK}]{_MARK}|{_MARK}{_MARK}.", names[i]) for i in merged):
            raise ValueError("only merge-type models with one order of merges, split at spaces, are supported")
        self.byte_id = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        if not all(sp.is_byte(i) for i in self.byte_id.values()):
            raise ValueError("the model has no byte tokens to fall back on")
        self.of_byte = {i: b for b, i in self.byte_id.items()}
        self.text_of = np.array([" ⁇ " if sp.is_unknown(i) else "" if sp.is_control(i) or sp.is_byte(i) else names[i].replace(_MARK, " ") for i in range(n)], dtype=object)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.is_control = np.array([bool(sp.is_control(i)) for i in range(n)])
        self.starts_marked = np.array([names[i].startswith(_MARK) and not sp.is_unknown(i) for i in range(n)])

        # Ranks: single characters first, then merges from the best score down.
        self.id_of_rank = [i for i in plain if len(names[i]) == 1] + sorted(merged, key=lambda i: -scores[i])
        singles = len(self.id_of_rank) - len(merged)
        self.known = {names[i] for i in self.id_of_rank[:singles]}
        self.split = [(r, r) for r in range(singles)]
        self.merge: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        rank_of = {names[i]: r for r, i in enumerate(self.id_of_rank)}
        self.tokens = ahocorasick.Automaton()
        for r in range(singles):
            self.tokens.add_word(names[self.id_of_rank[r]], (1, r))
        # A merge is usable when the encoding of its own text, with the tokens before it, ends in two that join to it.
        for r in range(singles, len(self.id_of_rank)):
            text = names[self.id_of_rank[r]]
            two = self._two(text, rank_of, r)
            self.split.append(two or (r, r))
            if two:
                self.merge[two] = r
                self.tokens.add_word(text, (len(text), r))
        self.tokens.make_automaton()
        self.words: dict[str, int] = {}
        self._clear()

    def _two(self, text: str, rank_of: dict[str, int], top: int) -> tuple[int, int] | None:
        """The last two parts of a token's own text, merged in order of rank below ``top``."""
        parts = list(text)
        if any(c not in self.known for c in parts):
            return None
        while len(parts) > 2:
            best = min(((rank_of.get(a + b, top), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best[0] >= top:
                return None
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return rank_of[parts[0]], rank_of[parts[1]]

    def _clear(self) -> None:
        self.words.clear()
        self.flat: list[int] = []
        self.at: list[int] = [0]

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens (by rank) a and b stay apart when their texts stand side by side."""
        known = self.pairs.get(a << 32 | b)
        if known is not None:
            return known
        x, y, limit, ok = a, b, len(self.split) + 1, None
        while ok is None:
            joined = self.merge.get((x, y))
            if joined is not None and joined < limit:
                ok = False
            elif x > y:
                limit = x
                x = self.split[x][1]
                if x == limit:
                    limit = y + 1
                    y = self.split[y][0]
                    if y + 1 == limit:
                        ok = True
            else:
                limit = y + 1
                y = self.split[y][0]
                if y + 1 == limit:
                    limit = x
                    x = self.split[x][1]
                    if x == limit:
                        ok = True
        if len(self.pairs) > 300_000:  # bounds memory
            self.pairs.clear()
        self.pairs[a << 32 | b] = ok
        return ok

    def _known_run(self, text: str) -> list[int]:
        """Ranks of the encoding of a text of known characters."""
        n = len(text)
        last, width = [-1] * n, [0] * n
        known = self.pairs.get
        for end, (k, r) in self.tokens.iter(text):
            if last[end] < 0:
                before = end - k
                if before >= 0:
                    ok = known(last[before] << 32 | r)
                    if not (self.compatible(last[before], r) if ok is None else ok):
                        continue
                last[end], width[end] = r, k
        out, i = [], n - 1
        while i >= 0:
            out.append(last[i])
            i -= width[i]
        return out[::-1]

    def _marks(self, n: int) -> list[int]:
        """Ids of a run of n space marks: equal scores, so the leftmost pair merges first."""
        done, cur, left = [], 1, n - 1
        while True:
            if done and done[-1] + cur in self.runs:
                cur += done.pop()
            elif left and cur + 1 in self.runs:
                cur, left = cur + 1, left - 1
            else:
                done.append(cur)
                if not left:
                    return [self.runs[x] for x in done]
                cur, left = 1, left - 1

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word with the space marks before it."""
        ids = self.id_of_rank
        if self.known.issuperset(word):
            out = [ids[r] for r in self._known_run(word)]
        else:
            out = []
            for known, run in groupby(word, self.known.__contains__):
                run = "".join(run)
                out += [ids[r] for r in self._known_run(run)] if known else [self.byte_id[b] for b in run.encode("utf-8", "surrogatepass")]
        mark = self.runs[1]
        if out[:2] != [mark, mark]:
            return out
        lead = next((i for i, x in enumerate(out) if x != mark), len(out))
        return self._marks(lead) + out[lead:]

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin (one more entry than texts)."""
        if len(self.words) > CACHE_WORDS:
            self._clear()
        index: list[int] = []
        ends = [0]
        for t in texts:
            if t:
                ws = _WORD.findall(_MARK + t.replace(" ", _MARK))
                try:
                    index += map(self.words.__getitem__, ws)
                except KeyError:
                    for w in set(ws):
                        if w not in self.words:
                            self.flat += self.encode_word(w)
                            self.at.append(len(self.flat))
                            self.words[w] = len(self.at) - 2
                    del index[ends[-1]:]
                    index += map(self.words.__getitem__, ws)
            ends.append(len(index))
        which, at = np.array(index, np.int64), np.array(self.at, np.int64)
        size = at[which + 1] - at[which]
        begin = np.concatenate(([0], np.cumsum(size)))
        ids = np.array(self.flat, np.int32)[np.repeat(at[which] - begin[:-1], size) + np.arange(begin[-1])]
        return ids, begin[np.array(ends)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: spaces for marks, one leading space dropped, bytes joined, bad bytes replaced one by one."""
        ids = ids[~self.is_control[ids]]
        if not len(ids):
            return ""
        parts = self.text_of[ids].tolist()
        if self.starts_marked[ids[0]]:
            parts[0] = parts[0][1:]
        if self.is_byte[ids].any():
            out, at = [], 0
            for is_byte, run in groupby(ids.tolist(), self.of_byte.__contains__):
                run = list(run)
                out.append(bytes(map(self.of_byte.__getitem__, run)).decode("utf-8", "isohyet_each_byte") if is_byte else "".join(parts[at:at + len(run)]))
                at += len(run)
            return "".join(out)
        return "".join(parts)


@lru_cache(maxsize=2)
def _model(proto: bytes) -> PieceModel:
    """One model's tables, kept by the Python worker."""
    return PieceModel(proto)


def load_model(path: str) -> bytes:
    """The model file's bytes (a vocabulary file: about half a megabyte), sent to the tasks as they are."""
    with open(path, "rb") as f:
        return f.read()


def _without(df: DataFrame, name: str, out: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name.lower() != name.lower()], T.StructField(name, out)])


def encode(df: DataFrame, model: bytes, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """The frame's columns and ``out_col``: array of int ids."""
    C.ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = _model(sent.value)
        for rb in batches:
            for i in range(0, rb.num_rows, BATCH_ROWS):
                part = rb.slice(i, BATCH_ROWS)
                ids, at = m.encode_batch(part.column(part.schema.get_field_index(text_col)).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                keep = [(f.name, part.column(k)) for k, f in enumerate(part.schema) if f.name.lower() != out_col.lower()]
                yield pa.RecordBatch.from_arrays([*[c for _, c in keep], lists], names=[*[n for n, _ in keep], out_col])

    return df.mapInArrow(run, _without(df, out_col, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The frame's columns and ``out_col``: the text of the ids."""
    C.ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = _model(sent.value)
        for rb in batches:
            for i in range(0, rb.num_rows, BATCH_ROWS):
                part = rb.slice(i, BATCH_ROWS)
                lists = part.column(part.schema.get_field_index(ids_col))
                at = lists.offsets.to_numpy(zero_copy_only=False)
                flat = lists.values.to_numpy(zero_copy_only=False)
                null = lists.is_null().to_numpy(zero_copy_only=False)
                texts = pa.array(["" if null[k] else m.decode(flat[at[k]:at[k + 1]]) for k in range(len(lists))], pa.string())
                keep = [(f.name, part.column(k)) for k, f in enumerate(part.schema) if f.name.lower() != out_col.lower()]
                yield pa.RecordBatch.from_arrays([*[c for _, c in keep], texts], names=[*[n for n, _ in keep], out_col])

    return df.mapInArrow(run, _without(df, out_col, T.StringType()))


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    model = load_model(model_path or default_model_path())
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encode(docs, model).select("doc_id", "ids")
    both = decode(ids, model)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
