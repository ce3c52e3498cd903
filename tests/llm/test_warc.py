import hashlib
import struct

import zstandard

from cohortlens.llm import warc
from cohortlens.llm.common import scratch

from .frames import prose

PAGES = "page_id long, url string, html string, digest string, key string, payload string, refers_to string"


def rows():
    long, short = "<p>" + prose(1, 50) + "é\r\n\r\n</p>", "<p>short</p>"
    data = [(5, "http://a/5", long), (3, "http://a/3", long), (9, None, long), (1, "http://a/1", short), (2, "http://a/2\r\nX: y", short),
            (4, "http://b/4", None), (6, "http://b/6", ""), (7, "http://c/7", "x" * 300_000), (None, "http://c/n", long), (8, "http://d/8", "<" * 99),
            (10, "http://d/10", "<" * 99), (11, "http://d/11", ">" * 100), (12, "http://d/12", ">" * 100), (12, "http://d/12", ">" * 100)]
    return [(*r, "d", "k", "p", "r") for r in data + [(100 + k, f"http://e/{k}", "<html>" + prose(k, 30)) for k in range(300)]]


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), PAGES)
    first = {}
    for i, _, html, *_ in rows():
        data = (html or "").encode()
        if i is not None:
            first[data] = min(first.get(data, i), i)
    want = []
    for i, url, html, *_ in rows():
        data = (html or "").encode()
        again = len(data) >= 100 and first.get(data, i) != i
        want.append((i, None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), len(data), hashlib.sha256(data).hexdigest(),
                     "revisit" if again else "response", first[data] if again else None))
    got = [tuple(r) for r in warc.round_trip(pages).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_an_id_with_several_repeated_payloads(spark):
    a, b = "a" * 200, "b" * 200
    data = [(7, "u", a), (7, "v", b), (3, "w", a), (4, "x", b), (7, "u", a), (None, "n", a)]
    got = sorted((r.page_id or 0, r.payload_digest[:4], r.record_type, r.refers_to) for r in warc.round_trip(
        spark.createDataFrame([(*r, None, None, None, None) for r in data], PAGES)).collect())
    name = {x: hashlib.sha256(x.encode()).hexdigest()[:4] for x in (a, b)}
    assert got == sorted([(7, name[a], "revisit", 3), (7, name[b], "revisit", 4), (3, name[a], "response", None), (4, name[b], "response", None),
                          (7, name[a], "revisit", 3), (0, name[a], "revisit", 3)])


def test_file_format(spark):
    pages = spark.createDataFrame(rows(), PAGES)
    manifest = warc.write(pages, scratch(spark, "test-warc")).collect()
    assert sum(m.n_records for m in manifest) == len(rows())
    for m in manifest:
        data = open(m.path.removeprefix("file://"), "rb").read()
        magic, n = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + n]))
        one = plain.decompressobj()
        assert one.decompress(data[8 + n:]).startswith(b"WARC/1.1\r\n") and (one.unused_data or m.n_records == 1)


def test_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []
