"""Archives: exact round trip, rolling, determinism and commits."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gabarito.llm.warc import read_archives, write_archives

LARGE, OTHER = "<p>é" * 400, "y" * 1000


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)


ROWS = [
    (1, "http://a/1", LARGE), (2, "http://a/2", LARGE), (9, "http://b/", LARGE), (4, None, OTHER), (3, "x\r\nWARC-Type: bad", "small"),
    (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (10, "u", OTHER[:-1]), (11, "u", OTHER[:-1]),
    (-3, "u", "b" * 300_000),
]


def want(rows):
    largest = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= 1000:
            largest[raw] = max(page, largest.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        holder = largest.get(raw, page) if page is not None else page
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if holder == page else "revisit", None if holder == page else holder))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "w")
    write_archives(pages_of(spark, ROWS), folder)
    back = read_archives(spark, folder)
    assert got(back) == want(ROWS)
    payloads = {r["page_id"]: r["payload"] for r in back.where("record_type = 'response'").collect()}
    assert payloads == {i: bytearray((h or "").encode()) for i, _, h in ROWS if i not in (1, 2)}
    assert back.where("page_id = 3").first()["url"] == "x  WARC-Type: bad"


def test_missing_and_repeated_ids(spark, tmp_path):
    rows = [(None, "u", LARGE), (None, "u", LARGE), (5, "u", LARGE), (5, "u", LARGE), (4, "u", LARGE)]
    write_archives(pages_of(spark, rows), str(tmp_path / "w"))
    assert got(read_archives(spark, str(tmp_path / "w"))) == want(rows)


def test_empty_table_and_extra_columns(spark, tmp_path):
    df = pages_of(spark, ROWS[:3]).withColumns({"digest": F.lit("x"), "range": F.lit(1), "original": F.lit(2)})
    write_archives(df, str(tmp_path / "a"))
    assert got(read_archives(spark, str(tmp_path / "a"))) == want(ROWS[:3])
    write_archives(df.where("false"), str(tmp_path / "b"))
    assert read_archives(spark, str(tmp_path / "b")).count() == 0


def files(folder):
    return {p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")}


def test_files_depend_on_rows_alone_and_roll(spark, tmp_path):
    rows = [(i, f"http://h/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 30) for i in range(400)]
    for name, parts in (("a", 2), ("b", 7)):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        manifest = write_archives(df, str(tmp_path / name), file_bytes=2000).collect()
        assert sum(m["records"] for m in manifest) == 400
        assert max(m["compressed_bytes"] for m in manifest) <= 2000 and len(manifest) > 40
        for m in manifest:
            raw = (tmp_path / name / m["file"]).read_bytes()
            assert hashlib.sha1(raw).hexdigest() == m["sha1"] and gzip.decompress(raw).startswith(b"WARC/1.1\r\n")
    assert files(tmp_path / "a") == files(tmp_path / "b")
    ordered = [r["page_id"] for r in read_archives(spark, str(tmp_path / "a")).collect()]
    assert sorted(ordered) == list(range(400))


def test_only_listed_files_count_and_damage_shows(spark, tmp_path):
    folder = tmp_path / "w"
    write_archives(pages_of(spark, ROWS), str(folder))
    (folder / "range-999999-0000.warc.gz").write_bytes(b"left by a lost task")
    assert got(read_archives(spark, str(folder))) == want(ROWS)
    assert not [p for p in folder.iterdir() if p.name.startswith(".range")]
    (victim,) = [p for p in folder.glob("range-0*.warc.gz") if b"b" * 300_000 in gzip.decompress(p.read_bytes())]
    victim.write_bytes(gzip.compress(gzip.decompress(victim.read_bytes()).replace(b"b" * 50, b"c" * 50)))
    with pytest.raises(Exception, match="damaged"):
        read_archives(spark, str(folder)).count()
