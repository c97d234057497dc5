import hashlib
import random
import zlib

from corpusloom.llm.warc import (
    format_record,
    gzip_member,
    parse_record,
    read_warc,
    salvage,
    write_warc,
)



def record(n, payload, revisit=False):
    digest = hashlib.sha1(payload).hexdigest()
    return format_record(n, f"http://h/{n}", payload, digest, 9 if revisit else None, revisit, "2024-01-01T00:00:00Z")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_revisits_and_odd_rows(spark):
    big = "<p>é</p>" * 300
    rows = [(k, "http://a", big) for k in (4, 9, 2)]
    rows += [(1, None, None), (3, "u\r\nX: y", "small"), (5, "u", "small"), (None, "u", big), (7, "u", "x" * 100_000)]
    rows = [(*row, "clash") for row in rows]
    manifest = write_warc(pages(spark, rows).repartition(3))
    files = [row["file"] for row in manifest.collect()]
    found = read_warc(spark, files, manifest).collect()
    assert all(row["gap"] is None for row in found) and len(found) == len(rows)
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in found}
    assert {(4, "revisit", "<urn:page:9>"), (2, "revisit", "<urn:page:9>"), (9, "response", None)} <= kinds
    assert (None, "response", None) in kinds and (3, "response", None) in kinds
    for row in found:
        if row["record_type"] == "response":
            assert hashlib.sha1(row["payload"]).hexdigest() == row["payload_digest"]
            assert len(row["payload"]) == row["payload_bytes"]
    assert {r["payload_bytes"] for r in found if r["page_id"] in (2, 4)} == {len(big.encode())}


def test_rows_with_the_largest_id_twice_are_responses(spark):
    rows = [(1, "u", "y" * 2000, ""), (1, "u", "y" * 2000, "")]
    manifest = write_warc(pages(spark, rows))
    found = read_warc(spark, [r["file"] for r in manifest.collect()], manifest)
    assert [r["record_type"] for r in found.collect()] == ["response", "response"]


def test_empty_table(spark):
    assert write_warc(pages(spark, [])).count() == 0


def test_salvage_recovers_later_records():
    whole = [record(n, bytes([65 + n]) * (50 + n)) for n in range(6)]
    for pack in (gzip_member, bytes):
        parts = [pack(r) for r in whole]
        parts[1] = parts[1][:-9]  # cut off
        parts[3] = parts[3][:60] + b"\x00\x01" + parts[3][62:]  # damaged
        data = b"".join(parts) + b"trailing junk"
        out = list(salvage(data))
        ids = [h["warc-record-id"] for _, _, h, _, _ in out if h]
        assert ids == [f"<urn:page:{n}>" for n in (0, 2, 4, 5)]
        assert sum(length for _, length, _, _, _ in out) == len(data)
        at = 0
        for offset, length, headers, _, reason in out:
            assert offset == at and (headers is None) == (reason is not None)
            at += length
        assert sum(h is None for _, _, h, _, _ in out) == 3


def test_salvage_of_random_damage_never_fails():
    random.seed(3)
    data = b"".join(gzip_member(record(n, b"x" * n * 9)) for n in range(8))
    for _ in range(200):
        broken = bytearray(data)
        for _ in range(random.randint(1, 4)):
            broken[random.randrange(len(broken))] ^= 1 << random.randrange(8)
        out = list(salvage(bytes(broken)))
        assert sum(row[1] for row in out) == len(broken)
        for _, _, headers, block, _ in out:
            if headers:
                n = int(headers["warc-record-id"][10:-1])
                assert block == b"x" * n * 9


def test_plain_records_that_hold_version_lines():
    inner = b"WARC/1.1\r\nnot a record"
    data = record(1, inner) + record(2, b"")
    assert [h is not None for _, _, h, _, _ in salvage(data)] == [True, True]
    assert parse_record(data)[1] == inner
    assert zlib.decompress(gzip_member(data), 31) == data


def test_gaps_are_rows(spark, tmp_path):
    good = gzip_member(record(1, b"a"))
    (tmp_path / "x.warc.gz").write_bytes(good + good[:30] + good)
    rows = read_warc(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r["gap"] is None for r in rows] == [True, False, True]
    assert rows[1]["length"] == 30 and rows[1]["record_type"] is None
