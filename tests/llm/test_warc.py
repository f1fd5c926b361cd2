import base64
import gzip
import hashlib
import os

from cardsentry.llm import op10_warc


def rows():
    html = ["<p>a</p>", "", None, "é" * 50, "x\r\n\r\nWARC/1.1\r\n" * 3]
    out = [(i, f"http://h/{i}", html[i % 5] if i % 3 else f"<b>{i}</b>", "extra") for i in range(120)]
    return out + [(None, None, "<p>a</p>", "e"), (None, "http://x y\n", "only", "e"), (2000, "u", "z" * 3_000_000, "e")]


def expected(data):
    first = {}
    for i, _, h, _ in data:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h, _ in data:
        p = (h or "").encode()
        f = first.get(p)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "response" if f == i else "revisit", None if f == i else f))
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip_rolls_and_repeats(spark, tmp_path):
    df = spark.createDataFrame(rows(), "page_id long, url string, html string, first string")
    got = {}
    for name in ("one", "two"):
        folder = f"file://{tmp_path}/{name}"
        back = op10_warc.round_trip(df.repartition(3 + len(got)), folder, roll_bytes=2000).select(*COLUMNS)
        assert sorted(map(tuple, back.collect()), key=str) == expected(rows())
        got[name] = sorted(f for f in os.listdir(tmp_path / name) if f.endswith(".gz"))
        assert not [f for f in os.listdir(tmp_path / name) if f.startswith("_temporary")]
    assert len(got["one"]) > 2
    text = b"".join(gzip.decompress((tmp_path / "one" / f).read_bytes()) for f in got["one"])
    same = b"".join(gzip.decompress((tmp_path / "two" / f).read_bytes()) for f in got["two"])
    assert text == same


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert op10_warc.round_trip(df).collect() == []
