import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from turnwarden.llm import warc
from turnwarden.sources.shared import new_folder


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/1", "<p>é WARC/1.0\r\n\r\nWARC-Type: response\r\n</p>"), (2, "http://a/2", "<p>x</p>"), (3, None, "<p>x</p>"),
            (0, "http://a/\nb", "<p>x</p>"), (5, "u", None), (4, "u", ""), (6, "u", "y" * 300000), (6, "u", "y" * 300000), (7, "u", "y" * 300000),
            (None, "u", "<p>x</p>"), (None, "u", "alone")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_id", F.lit("clash"))


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, pages, compression):
    path = new_folder(spark, "warc")
    warc.write(pages.repartition(3), path, records_per_file=4, compression=compression)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == pages.count()
    payloads = {}
    for r in pages.collect():
        payloads.setdefault(r.html or "", []).append(r.page_id)
    for r in got:
        if r.payload is not None:
            text = r.payload.decode()
            digest = base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
            assert text in payloads and r.payload_digest == "sha1:" + digest and r.payload_length == len(r.payload)
    seen = sorted((r.record_type, r.record_id, r.refers_to) for r in got)
    name = "<urn:x-page:{}>".format
    want = []
    for ids in payloads.values():
        first = min((i for i in ids if i is not None), default=None)
        want += [("response", name("none" if i is None else i), None) if i in (None, first) else ("revisit", name(i), name(first)) for i in ids]
    assert seen == sorted(want, key=str) or sorted(map(str, seen)) == sorted(map(str, want))


def test_predicates_and_least_size(spark, pages):
    path = new_folder(spark, "warc")
    warc.write(pages, path, least=20)
    assert {r.record_id for r in warc.read_warc(spark, path, ["revisit"]).collect()} == {"<urn:x-page:7>"}
    assert [r.payload for r in warc.read_warc(spark, path, ["response"], payload=False, record_id="<urn:x-page:2>").collect()] == [None]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = warc.read_warc(spark, path).filter("record_type = 'response' and record_id in ('<urn:x-page:2>', '<urn:x-page:7>')")
        assert [r.record_id for r in df.collect()] == ["<urn:x-page:2>"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_empty(spark, pages):
    path = new_folder(spark, "warc")
    warc.write(pages.limit(0), path)
    assert warc.read_warc(spark, path).count() == 0
