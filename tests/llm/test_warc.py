import base64
import hashlib
import random

import pyarrow.fs
import pytest

from ledgerlake.llm import warc as W
from ledgerlake.sources.workspace import fresh_path

PAGES = "page_id long, url string, html string, digest string, offset long"


@pytest.fixture
def pages(spark):
    rng = random.Random(1)
    bodies = [None, "", "a", "é\r\n\r\nWARC/1.1 \r\n", "x" * 20_000, "<p>" + "ñ" * 50]
    rows = [(i, rng.choice([None, "http://a.b/é ?q=1\n#x", f"http://c/{i}"]), rng.choice(bodies), "d", 1)
            for i in rng.sample(range(500), 80)]
    return rows, spark.createDataFrame(rows, PAGES).repartition(3)


def brute(rows, least=0):
    newest = {}
    for r in rows:
        newest[r[2] or ""] = max(newest.get(r[2] or "", -1), r[0])
    out = []
    for r in rows:
        raw, last = (r[2] or "").encode(), newest[r[2] or ""]
        again = last != r[0] and len(raw) >= least
        out.append((r[0], len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", last if again else None))
    return sorted(out)


def test_as_brute_force(pages):
    rows, df = pages
    assert sorted(tuple(r) for r in W.archived(df).collect()) == brute(rows)
    assert sorted(tuple(r) for r in W.archived(df, least_bytes=2).collect()) == brute(rows, 2)


def test_selected_records_come_back_whole(pages, spark, monkeypatch):
    monkeypatch.setattr(W, "GAP_BYTES", 100)
    rows, df = pages
    folder = f"file://{fresh_path(spark, 'warc')}"
    index = W.write_archives(df, folder)
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    files = fs.get_file_info(pyarrow.fs.FileSelector(path))
    assert sum(f.size for f in files) == index.groupBy().sum("length").first()[0]
    chosen = index.filter("record_type = 'response' AND page_id % 2 = 0")
    got = {r.page_id: bytes(r.payload).decode() for r in W.read_records(chosen).collect()}
    of = {r[0]: r[2] or "" for r in rows}
    want = {r[0] for r in brute(rows) if r[3] == "response" and r[0] % 2 == 0}
    assert got == {i: of[i] for i in want}


def test_a_record_is_as_the_format_says():
    raw = W.record(7, "http://a/é", b"<p>", W.digest_of(b"<p>"), None, "2024-01-01T00:00:00Z")
    head, body = raw.split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"<p>\r\n\r\n")
    assert int(head.rpartition(b"Content-Length: ")[2]) == len(body) - 4
    assert W.parse(raw)["payload"] == b"<p>"
    with pytest.raises(ValueError):
        W.parse(raw.replace(b"<p>", b"<q>"))


def test_close_parts_are_one_read():
    parts = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 20 + W.GAP_BYTES * 2, 5), ("b", 0, 3), ("b", 0, 3)]
    assert [(x, s, len(p)) for x, s, p in W._coalesced(parts)] == [
        ("a", 0, 3), ("a", 20 + W.GAP_BYTES * 2, 1), ("b", 0, 1), ("b", 0, 1)]


def test_repeated_rows_missing_ids_and_no_pages(spark):
    df = spark.createDataFrame([(1, "u", "x", "", 0), (1, "u", "x", "", 0), (None, "u", "x", "", 0),
                                (None, None, "y", "", 0)], PAGES)
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in W.archived(df).collect())
    assert got == [("1", "response", "None"), ("1", "response", "None"), ("None", "response", "None"),
                   ("None", "revisit", "1")]
    assert W.archived(df.limit(0)).count() == 0
