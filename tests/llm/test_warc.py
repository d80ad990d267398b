"""Round trip through archives, with revisits."""

import gzip
import hashlib
import os

from helpers import frame
from measures.llm import warc

PAGES = "page_id bigint, url string, html string"


def test_round_trip_and_revisits(spark, workdir):
    big, small = "<p>é</p>" * 40, "<b>x</b>"
    odd = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" * 5
    pages = [(5, "http://a/ b\r\nX: y", big), (3, "http://b", big), (9, None, big), (4, "u", small),
             (6, "u", small), (7, "u", None), (8, "u", ""), (1, "u", odd), (2, "u", odd),
             (None, "n", odd), (10, "u", "z" * 400_000)]
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    raw, lean = os.path.join(workdir, "raw"), os.path.join(workdir, "lean")
    warc.write_archive(df, raw)
    full = {r.page_id: r for r in warc.read_archive(spark, raw, payloads=True).collect()}
    assert {i: bytes(r.payload).decode() for i, r in full.items()} == {
        i: h or "" for i, _, h in pages}
    warc.write_deduplicated(spark, raw, lean)
    rows = {r.page_id: r for r in warc.read_archive(spark, lean, payloads=True).collect()}
    assert {i: (r.kind, r.refers_to) for i, r in rows.items()} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 4: ("response", None),
        6: ("response", None), 7: ("response", None), 8: ("response", None),
        1: ("response", None), 2: ("revisit", 1), None: ("revisit", 1), 10: ("response", None)}
    for i, _, html in pages:
        data = (html or "").encode()
        assert rows[i].payload_bytes == len(data)
        assert rows[i].payload_digest == hashlib.sha256(data).hexdigest()
        assert bytes(rows[i].payload) == (b"" if rows[i].kind == "revisit" else data)


def test_records_of_many_gzip_members(spark, workdir):
    raw = os.path.join(workdir, "raw")
    warc.write_archive(spark.createDataFrame([(1, "u", "a" * 200), (2, "v", "b")], PAGES).coalesce(1),
                       raw)
    [name] = [f for f in os.listdir(raw) if f.endswith(".gz")]
    data = gzip.decompress(open(os.path.join(raw, name), "rb").read())
    cut = data.index(b"WARC/1.1", 10)
    members = gzip.compress(data[:cut]) + gzip.compress(data[cut:])
    assert [(h[1], p) for h, p in warc.records(members)] == [(1, b"a" * 200), (2, b"b")]


def test_empty(spark, workdir):
    raw, lean = os.path.join(workdir, "raw"), os.path.join(workdir, "lean")
    warc.write_archive(spark.createDataFrame([], PAGES), raw)
    warc.write_deduplicated(spark, raw, lean)
    assert warc.read_archive(spark, lean).count() == 0
