"""Landed feeds, images and silver files as they come: other dialects, other formats, damaged."""

import struct

from pyspark.sql import functions as F

from hazlake.functions.media import image_size
from hazlake.operators import media, ranges
from hazlake.plans.lake import Lake
from hazlake.sources import payloads, tables


def segment(mark, body):
    return bytes([0xFF, mark]) + struct.pack(">H", len(body) + 2) + body


def frame(width, height, mark=0xC0):
    return segment(mark, b"\x08" + struct.pack(">HH", height, width) + b"\x03")


JPEG = b"\xff\xd8"
CONTENTS = {
    "png": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", 70000, 3), (70000, 3)),
    "png cut": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR\0\0", None),
    "gif": (b"GIF87a" + struct.pack("<HH", 300, 65535), (300, 65535)),
    "jpeg": (JPEG + segment(0xE0, b"JFIF") + frame(640, 480), (640, 480)),
    # A thumbnail inside a segment is not the picture; fill bytes and a bare marker come before the frame.
    "jpeg exif": (JPEG + segment(0xE1, b"Exif" + JPEG + frame(16, 12)) + b"\xff\xff\xff\x01" + frame(5, 6, 0xC2), (5, 6)),
    "jpeg many segments": (JPEG + segment(0xE2, b"p" * 30) * 255 + segment(0xC4, b"t") + frame(9, 8), (9, 8)),
    "jpeg without a frame": (JPEG + segment(0xE0, b"JFIF") + segment(0xDA, b"x") + frame(1, 1), None),
    "jpeg cut": (JPEG + segment(0xE0, b"JFIF") + frame(640, 480)[:6], None),
    "jpeg of noise": (JPEG + b"\xff\xe0\x00\x04ab" + b"noise" * 99, None),
    "webp": (b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\0\0\0\0" + b"\x7f\x02\0" + b"\xdf\x01\0", (640, 480)),
    "webp lossy": (b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 0x4000 + 320, 200), (320, 200)),
    "webp lossless": (b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + struct.pack("<I", (319) | (199 << 14)), (320, 200)),
    "zero": (b"GIF89a\0\0\0\0", None),
    "text": (b"nothing", None),
    "empty": (b"", None),
    "null": (None, None),
}


def test_sizes_from_headers(spark):
    rows = [(name, content and bytearray(content) if content is not None else None) for name, (content, _) in CONTENTS.items()]
    got = spark.createDataFrame([(n, bytes(c) if c is not None else None) for n, c in rows], "name string, content binary")
    sizes = {r["name"]: r["size"] and tuple(r["size"]) for r in got.select("name", image_size(F.col("content")).alias("size")).collect()}
    assert sizes == {name: want for name, (_, want) in CONTENTS.items()}


def test_long_files_are_listed_but_not_opened(spark, tmp_path):
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "a.png").write_bytes(CONTENTS["png"][0])
    (tmp_path / "images" / "b.png").write_bytes(CONTENTS["png"][0] + b"x" * 100)
    files = media.landed_files(spark, str(tmp_path), max_bytes=50)
    assert sorted(map(tuple, files.collect())) == [("images/a.png", 24, 70000, 3), ("images/b.png", 124, None, None)]
    assert "LessThanOrEqual(length,50)" in files._jdf.queryExecution().toString()


ATOM = """<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>News</title><link href="https://home/"/>
<entry><title>Flood &amp; rain</title><link rel="enclosure" href="https://e/1.mp3"/><link rel="alternate" href="https://e/1"/>
<published>2024-03-08T04:30:00Z</published><updated>2024-03-09T00:00:00Z</updated><summary type="html">Water</summary><category term="in"/></entry>
<entry><title>Quake</title><link rel="enclosure" href="https://e/2.mp3"/><updated>2024-03-07T01:00:00+05:30</updated><content>Long text</content></entry>
<entry><title>Bare</title></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns="http://purl.org/rss/1.0/"
 xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>C</title></channel><item><title>Storm</title><link>https://r/1</link>
<content:encoded><![CDATA[<p>Wind</p>]]></content:encoded><dc:date>2024-03-06T10:00:00Z</dc:date></item></rdf:RDF>"""


def test_feeds_of_several_dialects(spark, tmp_path):
    (tmp_path / "one.atom").write_text(ATOM)
    (tmp_path / "two.xml").write_text(RDF)
    (tmp_path / "none.xml").write_text("<rss><channel><title>Empty</title></channel></rss>")
    got = {r["title"]: tuple(r)[:1] + tuple(r)[2:] for r in payloads.read_feed(spark, str(tmp_path)).collect()}
    assert got == {
        "Flood & rain": ("one", "Water", "https://e/1", "2024-03-08T04:30:00Z", "2024-03-09T00:00:00Z", ["in"]),
        "Quake": ("one", "Long text", "https://e/2.mp3", None, "2024-03-07T01:00:00+05:30", None),
        "Bare": ("one", None, None, None, None, None),
        "Storm": ("two", "<p>Wind</p>", "https://r/1", None, "2024-03-06T10:00:00Z", None),
    }
    records = payloads.parse_rss(payloads.read_feed(spark, str(tmp_path)), F.lit("now"), keywords=["quake", "storm"])
    assert {(r["url"], r["published_at"]) for r in records.collect()} == {
        ("https://e/2.mp3", "2024-03-06T19:30:00+00:00"), ("https://r/1", "2024-03-06T10:00:00+00:00")
    }


def test_unread_silver_files_are_named(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))
    assert lake.unread_files().count() == 0
    rows = spark.range(6000).select(
        F.concat(F.lit("id"), "id").alias("lake_id"), F.lit("rss").alias("source_type"),
        F.format_string("2024-03-0%d", F.col("id") % 3 + 1).alias("date_partition"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    empty = spark.createDataFrame([], tables.LAKE_ON_DISK).select(*tables.LAKE_COLUMNS)
    tables.write_silver(rows.coalesce(1).unionByName(empty, allowMissingColumns=True), lake.silver_dir)
    assert lake.unread_files().count() == 0
    files = {d: next((tmp_path / "lake").rglob(f"date=2024-03-0{d}/*/*.parquet")) for d in (1, 2)}
    whole = files[1].read_bytes()
    files[1].write_bytes(whole[: len(whole) // 2])
    files[2].write_bytes(b"PAR")
    for f in files.values():
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    got = [(r["file"].split("date=")[1][:10], r["length"], r["promised"], r["found"]) for r in lake.unread_files().collect()]
    assert sorted(got) == [("2024-03-01", len(whole) // 2, None, 0), ("2024-03-02", 3, None, 0)]
    assert tables.reload_silver(spark, lake.silver_dir).count() == 2000


def test_boxes_may_be_open(spark):
    rows = spark.createDataFrame([(1, 10.0, 70.0), (2, -30.0, 75.0), (3, 10.0, None)], "id int, lat double, lon double")
    celled = rows.withColumns({"lat_cell": ranges.cell_of(F.col("lat")), "lon_cell": ranges.cell_of(F.col("lon"))})
    inf = float("inf")
    for table in (rows, celled):
        assert [r["id"] for r in ranges.bbox(table, 0, inf, -inf, inf).collect()] == [1]
        assert [r["id"] for r in ranges.bbox(table, -inf, 10, 71, 80).collect()] == [2]
