"""Archives written and read back, against the rule applied to the rows."""

import gzip
import hashlib

from skein.llm import warc as W


def model(rows):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        last = max((p for p, _, h in rows if h == html and p is not None), default=None)
        again = len(raw) >= W.MIN_REVISIT and last is not None and page_id != last
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(),
                    "revisit" if again else "response", last if again else None))
    return sorted(map(repr, out))


LONG = "<p>é" * 400
ROWS = [(1, "http://A.Example.org/x?q=1#f", LONG), (2, "http://a.example.org/x?q=1#f", LONG),
        (3, None, LONG), (4, "no scheme", None), (5, "", ""), (6, "http://b/\r\nnew line", "x" * 999),
        (7, "http://b/", "x" * 999), (8, "http://b/", "x" * 1000), (9, "http://b/", "x" * 1000),
        (9, "http://b/", "x" * 1000), (9, "http://b/", "other"), (None, "http://b/", LONG),
        (None, None, "y" * 2000), (None, "http://é.org/ü", "y" * 2000), (10, "http://c\x00d/", "z" * 300000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_LINES", 2)
    rows = ROWS + [(100 + i, f"https://h{i % 7}.example.com/p{i % 50}", f"page {i % 90} " * 200) for i in range(400)]
    df = frame(spark, rows).repartition(3)
    manifest = W.write_archives(df)
    got = W.look_up(manifest, df.select("page_id", "url"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == model(rows)
    files = manifest.collect()
    assert sum(f.records for f in files) == len(rows)
    # plain WARC readers see one gzip member per record
    seen = sum(gzip.open(f.path.removeprefix("file:")).read().count(b"WARC/1.1\r\n") for f in files)
    assert seen == len(rows)


def test_some_keys(spark):
    manifest = W.write_archives(frame(spark, ROWS))
    asked = spark.createDataFrame([(8, "http://B/"), (8, "http://b/"), (77, "http://b/"), (1, "zzz")],
                                  "page_id long, url string")
    assert [r.page_id for r in W.look_up(manifest, asked).collect()] == [8]


def test_empty(spark):
    df = frame(spark, [])
    assert W.look_up(W.write_archives(df), df).count() == 0
