import gzip
import hashlib
import io
import random

from pyspark.sql import types as T

from cadenza.llm import warc

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("run", T.StringType())])
BIG, ODD = "<p>same</p>" * 20, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\nä漢" * 9


def rows():
    out = [(9, "http://b.example.com/x", BIG), (4, "https://www.a.example.org/y?q=1#f", BIG), (6, "http://B.example.com/x", BIG), (1, None, None), (2, "no scheme", ""), (3, "http://x/\r\nA: b", "short"), (5, "http://y/", "short"), (7, "http://z/é ü", ODD), (8, "http://z/", ODD), (None, "http://n/", BIG)]
    out += [(100 + i, f"http://h{i % 5}.example.net/{i % 7}", f"<html>{i}</html>" * (i % 90)) for i in range(300)]
    return [(*r, "clash", "clash") for r in out]


def test_round_trip_and_global_order(spark):
    pages = spark.createDataFrame(rows(), PAGES).repartition(4)
    index, files, folder = warc.archive(pages)
    found = {r["page_id"]: r for r in index.collect()}
    whole = {r[0]: r for r in rows() if r[0] is not None}
    first = {}
    for i in sorted(whole):
        first.setdefault((whole[i][2] or "").encode(), i)
    assert set(found) == set(whole)
    for i, (_, _, html, *_) in whole.items():
        payload = (html or "").encode()
        original = first[payload] if len(payload) >= 100 else i
        r = found[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if original == i else ("revisit", original))
    ordered = sorted(found.values(), key=lambda r: (r["range"], r["position"]))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in ordered]
    assert keys == sorted(keys)
    # A record's place in the index is enough to read it alone.
    r = found[7]
    with open(f"{folder.removeprefix('file://')}/{r['file']}", "rb") as f:
        f.seek(r["offset"])
        record = gzip.decompress(f.read(r["length"]))
    assert record.startswith(b"WARC/1.1\r\n") and record.rstrip(b"\r\n").endswith(ODD.encode().rstrip())
    assert files.count() >= 1


def test_ranges_cut_inside_a_hot_url(spark):
    pages = spark.createDataFrame([(i, "http://hot.example.com/", "x", "", "") for i in range(500)], PAGES).repartition(3)
    index, _, folder = warc.archive(pages)
    merged = warc.merge_runs(index.drop("range", "position"), range_rows=100)
    ordered = sorted(merged.collect(), key=lambda r: (r["range"], r["position"]))
    assert [r["page_id"] for r in ordered] == list(range(500)) and len({r["range"] for r in ordered}) > 2


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_damaged_archives_are_refused():
    member = gzip.compress(warc.record(1, "http://x/", "2020-01-01T00:00:00Z", "abc", None))
    assert len(list(warc.records_of(io.BytesIO(member * 2)))) == 2
    try:
        list(warc.records_of(io.BytesIO(member[:-9])))
        raise AssertionError
    except ValueError:
        pass


def test_no_pages_and_repeated_rows(spark):
    assert warc.archive(spark.createDataFrame([], PAGES))[0].count() == 0
    twice = spark.createDataFrame([(1, "http://a/", BIG, "", "")] * 2, PAGES)
    assert [r["record_type"] for r in warc.archive(twice)[0].collect()] == ["response"] * 2
