import hashlib
import os
import random

import zstandard

from isohyet.llm import warc as W


def test_archive_has_a_dictionary_frame_and_single_records():
    rng = random.Random(1)
    words = [f"word{i}" for i in range(200)]
    records = [W.record(i, f"http://x/{i}", ("<html>" + " ".join(rng.choices(words, k=200)) + "</html>").encode(), False, None) for i in range(300)]
    data, size = W.archive_bytes(records)
    assert int.from_bytes(data[:4], "little") == W.SKIPPABLE and int.from_bytes(data[4:8], "little") == size > 1000
    assert list(W.read_records(data)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=W.LEVEL).compress(r)) for r in records)
    assert len(data) - size < plain  # the dictionary pays
    assert list(W.read_records(W.archive_bytes(records[:1])[0])) == records[:1]


def test_round_trip_with_edge_rows(spark, tmp_path):
    big = "x" * 200_000
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "http://a b\r\nX: y", None), (4, "u", ""), (5, "u", big), (5, "u", big), (None, "u", "same"), (None, "v", "lone"), (6, "é", "ünï")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("page_id", "page_id")
    folder = str(tmp_path / "warc")
    manifest = W.write_archives(pages, folder)
    assert manifest.count() == len(os.listdir(folder)) > 0
    got = W.read_archives(manifest).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert by[1][0].record_type == "response" and bytes(by[1][0].payload) == b"same" and by[1][0].refers_to is None
    assert by[2][0].record_type == "revisit" and by[2][0].refers_to == 1 and by[2][0].payload is None and by[2][0].payload_bytes == 4
    assert by[3][0].record_type == "response" and by[3][0].payload_bytes == 0 and by[3][0].url == "http://a%20b%0D%0AX:%20y"
    assert by[4][0].refers_to == 3
    assert [r.record_type for r in by[5]] == ["response"] * 2 and by[5][0].payload_bytes == len(big)
    assert sorted((r.record_type, r.refers_to) for r in by[None] if r.payload_bytes == 4 and r.refers_to) == [("revisit", 1)]
    assert by[6][0].url == "é" and by[6][0].payload_digest == W.sha1_base32("ünï".encode())
    assert len(W.sha1_base32(b"")) == 32 and hashlib.sha1(b"").digest_size == 20


def test_small_payloads_are_responses_when_asked(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in W.read_archives(W.write_archives(pages, str(tmp_path / "w"), min_revisit_bytes=3)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert W.read_archives(W.write_archives(pages.limit(0), str(tmp_path / "e"))).count() == 0
