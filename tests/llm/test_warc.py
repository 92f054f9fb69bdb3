import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stridelake.llm import warc


def member(page, payload, refers_to=None, url="http://a"):
    digest = hashlib.sha256(payload).hexdigest()
    return warc.gzip_member(warc.record_bytes(page, url, payload, digest, refers_to, warc.ARCHIVE_DATE), 6)


def pieces(data, size):
    return (data[i:i + size] for i in range(0, len(data), size))


@pytest.mark.parametrize("size", [1, 7, 1000, 1 << 20])
def test_records_come_back_whatever_the_pieces(size):
    payloads = [b"", b"x", b"a\r\n\r\nb" * 50, bytes(range(256)) * 900, "ä€漢".encode()]
    data = b"".join(member(str(i), p) for i, p in enumerate(payloads)) + member("9", payloads[2], "2")
    found = list(warc.read_records(pieces(data, size)))
    assert [r.payload for r in found] == [*payloads, b""]
    assert [r.fields["warc-type"] for r in found] == ["response"] * 5 + ["revisit"]
    assert found[5].fields["warc-refers-to"] == "<urn:page:2>" and int(found[5].http["content-length"]) == len(payloads[2])


def test_damage_is_found():
    good = member("1", b"payload" * 100)
    plain = zlib.decompress(good, 31)
    changed = [
        good[:-5], good[:20], b"junk" + good, warc.gzip_member(plain.replace(b"payloadp", b"Payloadp", 1), 6),
        warc.gzip_member(plain + b"more", 6), warc.gzip_member(plain[:-1], 6), warc.gzip_member(b"no record\r\n\r\n", 6)]
    for data in changed:
        with pytest.raises(warc.DamagedArchive):
            list(warc.read_records(pieces(data, 64)))
    lines = member("1", b"p" * 200, url="http://a\r\nWARC-Type: other")
    assert list(warc.read_records([lines]))[0].fields["warc-type"] == "response"


def test_odd_pages(spark, odd_documents, tmp_path):
    pages = odd_documents.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "score", "key")
    warc.write_archives(pages, str(tmp_path), least=20, file_bytes=200)
    back = warc.read_archives(spark, str(tmp_path)).collect()
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    assert len(back) == len(rows)
    firsts = {}
    for i, p in rows:
        if len(p) >= 20 and i is not None:
            firsts[p] = min(firsts.get(p, i), i)
    none = lambda row: tuple(str(x or "") for x in row)
    want = sorted(none(x) for x in ((str(i) if i is not None else "", len(p), hashlib.sha256(p).hexdigest(),
                   str(firsts[p]) if p in firsts and firsts[p] != i else None) for i, p in rows))
    assert sorted(none((r.record_id, r.payload_bytes, r.payload_digest, r.refers_to)) for r in back) == want
    assert {(r.record_type == "revisit") == (r.refers_to is not None) for r in back} == {True}
    assert sorted(bytes(r.payload) for r in back if r.record_type == "response") == sorted(
        p for i, p in rows if p not in firsts or firsts[p] == i)


def test_no_pages(spark, no_documents):
    pages = no_documents.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))
    assert warc.page_records(pages).count() == 0
