import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isohyet.llm import personal_data as P

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def check_digit(s):
    odd = sum(int(c) for c in s[::-1][::2])
    even = sum(sum(divmod(2 * int(c), 10)) for c in s[::-1][1::2])
    return (odd + even) % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and check_digit(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def mine(text):
    return [s for s in P.spans_of(text) if s[1] < 4]


def named(text):
    return [(P.KINDS[k], text[s:e]) for s, k, e in P.spans_of(text)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="@@..++--  ()0012345%aZé\n:/_", max_size=60))
def test_base_kinds_equal_the_patterns(text):
    assert mine(text) == base(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "255.255.255.256", "001.02.3.4", ".", "-", " ", "+1 (017) 555-7713", "+49 30 1234567890",
                                 "a.b@c.de", "x@y@z.com", "é", "@", "9", "mailto:", "token = ", "\U0001f600", "6011000990139424", "12345678901234"]), max_size=12))
def test_base_kinds_equal_the_patterns_on_joined_pieces(parts):
    text = "".join(parts)
    assert mine(text) == base(text)


def test_added_kinds():
    assert named("mail jörg.müller@bücher.example now") == [("mailbox", "jörg.müller@bücher.example")]
    assert named('"john doe"@example.com') == [("mailbox", '"john doe"@example.com')]
    assert named("plain a.b@c.example.com.") == [("email", "a.b@c.example.com")]
    assert named("ask @jane_doe, or a@ b") == [("handle", "@jane_doe")]
    assert named("see https://bob:pw@host.example/x.") == [("url", "https://bob:pw@host.example/x"), ("email", "pw@host.example")]
    assert [k for k, _ in named("http://10.0.0.1:80/a")] == ["url", "ip"]
    assert named("HTTPS://shop.example/?id=4&email=x") == [("url", "HTTPS://shop.example/?id=4&email=x")]
    assert named("https://news.example/a?page=2") == []
    assert named("IBAN: DE89 3704 0044 0532 0130 00 paid")[-1] == ("account", "DE89 3704 0044 0532 0130 00")
    assert named("iban DE88370400440532013000") == []
    assert named("SSN 123-45-6789") == [("account", "123-45-6789")] and named("ssn 666-45-6789") == []
    assert named("Account number: AB-123456") == [("account", "AB-123456")] and named("on account of 1999 things") == []
    assert named('token = "04dbebab91ab85687d33"') == [("secret", "04dbebab91ab85687d33")]
    assert named("password=hunter22x; tokens = aaaaaaaaaaaaaaaaa") == [("secret", "hunter22x")]


def test_long_texts_and_runs():
    long = "word " * 40_000 + "a@b.example" + " 1" * 50_000 + "@" * 20_000 + "a" * 50_000 + "." + "9" * 6000 + ".1.1.1"
    assert mine(long) == base(long[:-6006]) and mine("x" * 200_000 + "@y.zz")[0][0] == 0


def test_operator_edges(spark):
    rows = [(1, "a@b.cc", "x", 1), (2, None, "y", 2), (3, "", "z", 3), (1, "+1 (017) 555-7713 \n é a@b.cc", None, None), (None, "1.2.3.4", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Spans string, _text long")
    got = P.find(docs)
    assert got.columns == ["doc_id", "text", "_text", "spans"] and got.count() == 5 and P.find(docs.limit(0)).count() == 0
    out = {(r.doc_id, r.text): r.spans for r in got.collect()}
    assert out[2, None] == out[3, ""] == [] and [tuple(s) for s in out[None, "1.2.3.4"]] == [("ip", 0, 7)]
    masked = {r.text for r in P.mask(got).collect()}
    assert masked == {"<email>", None, "", "<phone> \n é <email>", "<ip>"}


def test_query_over_a_table_equals_the_patterns(spark):
    got = {r.doc_id: r for r in P.op12_personal_data(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for d in docs:
        want = base(d.text or "")
        text = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in want)
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in want) for i in range(4))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(r.spans.split(","))
    assert any(r.n_email for r in got.values()) and F is not None
