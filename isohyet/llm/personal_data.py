"""Personal data by anchor expansion: an Aho-Corasick pass finds anchors, local parsers find the spans around them.

One automaton over the text reports at-signs, ``+`` before a digit, pairs of digits, digits around a
dot, schemes (``https://``) and identifier cues (``iban``, ``token``). From each anchor a parser
expands to the boundaries of the value and validates it; what an earlier span of the same kind
already took is not read again, so a text is scanned a bounded number of times.

The base kinds are ``email``, ``ip``, ``card`` and ``phone``: leftmost matches that do not overlap
within a kind, dropped when a part of an address is over 255, when a card has not 14 to 19 digits
that pass Luhn's check, or a phone number not 10 to 15 digits. The other kinds are added to them:

* ``mailbox``: an address whose boundaries differ from the base email's (letters beyond ASCII, quoted names);
* ``handle``: an at-sign before an account name;
* ``url``: an address with a scheme that names a person, a login or a machine (user part, numeric host, telling parameter);
* ``account``: IBANs (ISO 7064 check), social security numbers and account numbers after their cue;
* ``secret``: a key, token or password after its cue and a sign of assignment.

No row needs another one: there is no shuffle, a worker holds one Arrow batch, and a hot source or a
group of copies is only more rows. Edge cases: a null or empty text has no spans; very long texts are
scanned whole; rows that repeat an id are each read; an empty table gives no rows; other columns pass,
except one that is named as the result (whatever its case), which it replaces.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.llm import common as C

#: Kinds in the order that spans of one start have; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "mailbox", "handle", "url", "account", "secret")
BASE_KINDS = KINDS[:4]
#: Texts in a batch that a worker holds.
BATCH_ROWS = 500

_EMAIL, _IP, _CARD, _PHONE, _MAILBOX, _HANDLE, _URL, _ACCOUNT, _SECRET = range(len(KINDS))
_AT, _PAIR, _DOT, _PLUS, _SCHEME, _IBAN, _SSN, _NUMBER, _KEY = range(9)

# Schemes, cues in the languages of the corpus, and parameters that name a person or a login.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "ws://", "wss://", "smb://", "ldap://",
           "postgres://", "postgresql://", "mysql://", "mongodb://", "redis://", "amqp://")
IBAN_CUES = ("iban",)
SSN_CUES = ("ssn", "social security")
NUMBER_CUES = ("account", "acct", "passport", "driver licence", "driver license", "tax id", "customer id", "member id", "patient id",
               "konto", "kontonummer", "reisepass", "cuenta", "pasaporte", "compte", "passeport")
KEY_CUES = ("token", "password", "passwd", "pwd", "secret", "api key", "api_key", "apikey", "access key", "access_key",
            "private key", "private_key", "passwort", "mot de passe")
TELLING = ("email", "mail", "user", "username", "login", "account", "phone", "token", "key", "password", "session", "sid")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WIDE_LOCAL = frozenset(".!#$%&'*+/=?^`{|}~-_")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_RUN = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HANDLE_NAME = re.compile(r"[A-Za-z0-9_](?:[A-Za-z0-9_.-]{0,37}[A-Za-z0-9_])?")
_URL_RUN = re.compile(r"[^\s<>\"'`{}|\\^]+")
_IBAN_RUN = re.compile(r"[\s:#=.\"']{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){10,30})(?![A-Za-z0-9])")
_SSN_RUN = re.compile(r"[\s:#=.\"']{0,4}(?:(?:number|no\.?|nr\.?)[\s:#=]{0,3})?([0-9]{3}[- ][0-9]{2}[- ][0-9]{4})(?![0-9-])", re.I)
_NUMBER_RUN = re.compile(r"(?:[ _-]?(?:numbers?|no\.?|nr\.?|id|nummer|número|numéro))?[ \t]{0,2}[:#=][ \t\"']{0,3}([A-Za-z0-9][A-Za-z0-9-]{4,38}[A-Za-z0-9])(?![A-Za-z0-9])", re.I)
_KEY_RUN = re.compile(r"[\"']?[ \t]{0,2}(?::=|[:=])[ \t]{0,2}(?:\"([^\s\"]{8,512})\"|'([^\s']{8,512})'|([^\s\"',;]{8,512}))")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors with what they announce and their length; schemes and cues in lower, upper and title case."""
    a = ahocorasick.Automaton()
    a.add_word("@", (_AT, 1))
    for x in "0123456789":
        a.add_word("+" + x, (_PLUS, 2))
        for y in "0123456789":
            a.add_word(f"{x}.{y}", (_DOT, 3))
            for sep in ("", " ", "-"):
                a.add_word(x + sep + y, (_PAIR, 2 + len(sep)))
    for what, cues in ((_SCHEME, SCHEMES), (_IBAN, IBAN_CUES), (_SSN, SSN_CUES), (_NUMBER, NUMBER_CUES), (_KEY, KEY_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                a.add_word(form, (what, len(cue)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (v * 2 if v < 5 else v * 2 - 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) < 4 and (not p or int(p) <= 255)


def _iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _email(text: str, at: int, since: int) -> tuple[int, int] | None:
    start = at
    while start > since and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _mailbox(text: str, at: int, since: int) -> tuple[int, int] | None:
    """Wider boundaries: letters of any script, or a quoted name, before a domain that could exist."""
    start = at
    if text[at - 1:at] == '"':
        start = text.rfind('"', max(since, at - 66), at - 1)
        if start < 0 or "\n" in text[start:at]:
            return None
    else:
        while start > since and at - start <= 64 and (text[start - 1].isalnum() or text[start - 1] in _WIDE_LOCAL):
            start -= 1
        while start < at and not (text[start].isalnum() or text[start] == "_"):
            start += 1
        if text[at - 1:at] == ".":
            return None
    m = _WIDE_DOMAIN.match(text, at + 1) if 0 < at - start <= 64 else None
    if not m:
        return None
    labels = m.group().split(".")
    fine = len(m.group()) <= 253 and all(0 < len(x) <= 63 and not (x[0] == "-" or x[-1] == "-") for x in labels)
    return (start, m.end()) if fine and len(labels[-1]) > 1 and labels[-1].isalpha() else None


def _url(text: str, start: int, rest: int) -> int | None:
    """The end of an address that names a person, a login or a machine; None if it names none."""
    m = _URL_RUN.match(text, rest)
    if not m:
        return None
    body = m.group().rstrip(".,;:!?)]")
    authority, _, query = re.split(r"[/?#]", body, maxsplit=1)[0], "", body.partition("?")[2]
    user, at, host = authority.rpartition("@")
    host = host.partition(":")[0]
    if not host:
        return None
    numeric = _NUMBERS.fullmatch(host) and host.count(".") == 3 and all(map(_octet, host.split(".")))
    telling = any(p.partition("=")[0].lower() in TELLING and p.partition("=")[2] for p in re.split("[&;]", query))
    return rest + len(body) if (at and user) or numeric or telling else None


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in code points, by start and kind; the end is exclusive."""
    out: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)  # end of the last text that a kind has consumed
    wide: list[tuple[int, int]] = []
    for last, (what, length) in automaton().iter(text):
        at = last - length + 1
        if what == _AT:
            got = _email(text, at, done[_EMAIL])
            if got:
                out.append((got[0], _EMAIL, got[1]))
                done[_EMAIL] = got[1]
            box = _mailbox(text, at, done[_MAILBOX])
            if box:
                done[_MAILBOX] = box[1]
                if box != got:
                    out.append((box[0], _MAILBOX, box[1]))
            if not got and not box and at >= done[_HANDLE] and not (at and (text[at - 1].isalnum() or text[at - 1] in "_.@/")):
                m = _HANDLE_NAME.match(text, at + 1)
                if m and len(m.group()) > 1 and any(c.isalpha() for c in m.group()) and text[m.end():m.end() + 1] != "@":
                    out.append((at, _HANDLE, m.end()))
                    done[_HANDLE] = m.end()
        elif what == _PAIR:
            if at >= done[_CARD]:
                m = _DIGITS.match(text, at)
                done[_CARD] = m.end()
                if m.end() - at >= 14:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, _CARD, m.end()))
        elif what == _DOT:
            if at >= done[_IP]:
                start = at
                while start > done[_IP] and "0" <= text[start - 1] <= "9":
                    start -= 1
                m = _NUMBERS.match(text, start)
                done[_IP] = m.end()
                parts = m.group().split(".")
                for i in range(0, len(parts) - 3, 4):  # a longer chain of numbers is cut into fours from the left
                    end = start + sum(map(len, parts[i:i + 4])) + 3
                    if all(map(_octet, parts[i:i + 4])):
                        out.append((start, _IP, end))
                    start = end + 1
        elif what == _PLUS:
            if at >= done[_PHONE]:
                m = _PHONE_RUN.match(text, at)
                if m:
                    done[_PHONE] = m.end()
                    if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                        out.append((at, _PHONE, m.end()))
        elif what == _SCHEME:
            if at >= done[_URL] and not (at and text[at - 1].isalnum()):
                end = _url(text, at, last + 1)
                if end:
                    out.append((at, _URL, end))
                    done[_URL] = end
        elif not (at and (text[at - 1].isalnum() or text[at - 1] == "-")):
            wide.append((what, last + 1))
    for what, rest in wide:
        kind = _SECRET if what == _KEY else _ACCOUNT
        m = (_IBAN_RUN if what == _IBAN else _SSN_RUN if what == _SSN else _NUMBER_RUN if what == _NUMBER else _KEY_RUN).match(text, rest)
        if not m:
            continue
        group = next(i for i in range(1, m.re.groups + 1) if m.group(i) is not None)
        value, start, end = m.group(group), m.start(group), m.end(group)
        if start < done[kind]:
            continue
        if what == _IBAN:
            fine = _iban(value)
        elif what == _SSN:
            fine = value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000"
        elif what == _NUMBER:
            fine = sum("0" <= c <= "9" for c in value) >= 5
        else:
            fine = any(c.isdigit() for c in value) or len(set(value)) >= 6
        if fine:
            out.append((start, kind, end))
            done[kind] = end
    out.sort()
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, text: str = "text", out: str = "spans", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``out``, an array of (kind, start, end); ``keep_text`` False leaves the text out."""
    C.ship_package(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name.lower() != out.lower() and (keep_text or f.name != text)]
    names = [f.name for f in kept]

    def run(batches):
        for rb in batches:
            for at in range(0, rb.num_rows, BATCH_ROWS):
                part = rb.slice(at, BATCH_ROWS)
                found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t)] if t else [] for t in (x.as_py() for x in part.column(0))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, _ARROW_SPANS)], names=[*names, out])

    body = "_text"
    while body in {n.lower() for n in names}:
        body += "_"
    source = docs.select(F.col(f"`{text}`").cast("string").alias(body), *[F.col(f"`{n}`") for n in names])
    return source.mapInArrow(run, T.StructType([*kept, T.StructField(out, _SPANS)]))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the one that starts first, and the longest, counts."""
    first = F.array_sort(F.col(spans), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    body = F.col(text)
    zero = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
        F.concat(acc["done"], F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("done"), s["end"].alias("at")))
    rest = lambda acc: F.concat(acc["done"], F.substring(body, acc["at"] + 1, F.length(body)))
    return found.withColumn(text, F.when(F.size(spans) == 0, body).otherwise(F.aggregate(first, zero, step, rest)))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(C.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
