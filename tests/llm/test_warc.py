import base64
import gzip
import hashlib
import io
import os

import pytest

from lexweave.llm import warc

SCHEMA = "page_id long, url string, html string, sha string, payload int"


def test_round_trip(spark, tmp_path):
    html = [None, "", "<p>é\U0001f600</p>", "<p>é\U0001f600</p>", "x" * 400_000, "x" * 400_000, "a\r\n\r\nWARC/1.1\r\n\r\n", "<p>é\U0001f600</p>"]
    rows = [(7 - i, None if i == 3 else f"http://h/{i}?q=a b\r\nX: y", h, "clash", 1) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, SCHEMA)
    found = {r["page_id"]: r for r in warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"))).collect()}
    assert set(found) == {r[0] for r in rows}
    for page, _, text, *_ in rows:
        body = (text or "").encode()
        first = min(p for p, _, t, *_ in rows if (t or "") == (text or ""))
        r = found[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == first else ("revisit", first))
        assert r["payload"] is None if page != first else bytes(r["payload"]) == body


def test_threshold_repeated_rows_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab", "", 0), (1, "u", "ab", "", 0), (2, "u", "ab", "", 0), (None, "u", "ab", "", 0), (3, "u", "", "", 0), (4, "u", "", "", 0)], SCHEMA)
    made = warc.read_archives(warc.write_archives(pages, str(tmp_path / "w"), least_bytes=1)).collect()
    assert sorted(((r["page_id"] or 0), r["record_type"], r["refers_to"] or 0) for r in made) == [
        (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "revisit", 1), (3, "response", 0), (4, "response", 0)
    ]
    assert warc.archive_pages(pages.where("page_id > 9")).count() == 0


def test_one_member_per_record_and_damage(spark, tmp_path):
    record = warc.record(1, "u", b"payload", None, False, "2024-01-01T00:00:00Z")
    assert gzip.decompress(record).startswith(b"WARC/1.1\r\n")
    assert [p for _, p, _ in warc.read_archive(io.BytesIO(record * 3))] == [b"payload"] * 3
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_archive(io.BytesIO(record[:-9])))
    whole = gzip.decompress(record)
    for changed in (whole.replace(b"payload\r\n", b"pbyload\r\n"), whole.replace(b"Content-Length: 7", b"Content-Length: 8"), b"x" + whole):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(gzip.compress(changed))))
    assert not [f for f in os.listdir(tmp_path) if f.startswith(".")]
