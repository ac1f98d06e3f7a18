import base64
import hashlib
import io
import random

import pytest
import zstandard

from sparktab.llm import warc_bundles as w
from sparktab.session import fresh_path

SCHEMA = "page_id long, url string, html string"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    last: dict[bytes, tuple] = {}
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        if len(data) >= least:
            last[data] = max(last.get(data, (False, 0, -1)), (page is not None, page or 0, i))
    out = []
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        first = last.get(data)
        mine = first is None or first == (page is not None, page or 0, i)
        out.append((page, len(data), sha1(data), "response" if mine else "revisit", None if mine or not first[0] else first[1]))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    found = [(i, f"http://a/{i}", rng.choice(["<p>one</p>", "<p>two é 😀</p>", "", None, f"<p>{i}</p>"])) for i in range(400)]
    found += [(None, None, "<p>one</p>"), (None, "u", "only without id"), (None, "u", "only without id"), (7000, "http://x/\r\nWARC-Type: fake", "\r\n\r\nWARC/1.1\r\n\r\n"), (7001, "", "y" * 900_000)]
    return found + [(7002, "u", "twice"), (7002, "u", "twice")]


def same(got, want):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_table_equals_plain_form(spark, rows):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    same(w.page_table(pages), expected(rows))
    same(w.page_table(pages.select("*", *[F.lit(7).alias(c) for c in "payload mark same first first_mark n last named bundle ids".split()])), expected(rows))


def test_least_size_and_small_frames(spark, rows):
    path = fresh_path(spark, "warc")
    w.archived(spark.createDataFrame(rows, SCHEMA), path, min_bytes=11, frame_bytes=2000, bundle_bytes=20_000)
    found = w.records(spark, path)
    same(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), expected(rows, 11))
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in found.where("record_type = 'response'").collect()}
    assert texts == {(r[0], r[2] or "") for r, e in zip(rows, expected(rows, 11)) if e[3] == "response"}
    spots = w.places(spark, path)
    assert spots.count() == len(rows) == spots.select("record_id").distinct().count()
    assert spots.select("bundle").distinct().count() > 5 and spots.select("bundle", "frame").distinct().count() > 30


def test_bundles_are_plain_zstandard(spark, rows, tmp_path):
    path = fresh_path(spark, "warc")
    w.archived(spark.createDataFrame(rows, SCHEMA), path, frame_bytes=3000, bundle_bytes=30_000)
    sizes = {r["bundle"]: r["bytes"] for r in w.exported(spark, path, f"file://{tmp_path}/out").collect()}
    files = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    assert {k: len(v) for k, v in files.items()} == sizes
    spots = {}
    for r in w.places(spark, path).collect():
        spots.setdefault(r["bundle"], []).append(r)
    for name, data in files.items():
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        bundle = w.Bundle(data)
        frames = [bundle.frame(k) for k in range(len(bundle.entries))]
        assert b"".join(frames) == whole
        assert sum(r["size"] for r in spots[name]) == len(whole)
        for r in spots[name]:
            assert w.parsed(frames[r["frame"]][r["offset"] : r["offset"] + r["size"]])[0] == r["record_id"]


def test_fetching_some_records(spark, rows):
    path = fresh_path(spark, "warc")
    w.archived(spark.createDataFrame(rows, SCHEMA), path, frame_bytes=3000)
    wanted = w.places(spark, path).where("record_id LIKE '%:7:%' OR record_id LIKE '%:700_:%'").select("record_id")
    got = w.fetched(spark, path, wanted.union(wanted)).collect()
    assert sorted(r["page_id"] for r in got) == [7, 7000, 7001, 7002, 7002]
    assert next(r["payload"] for r in got if r["page_id"] == 7001) == b"y" * 900_000
    assert next(r["url"] for r in got if r["page_id"] == 7000) == "http://x/ WARC-Type: fake"


def test_damage_is_seen():
    bundle = w.Bundler()
    bundle.add("a", w.record("<urn:page:1:00>", "u", b"payload"))
    data = bytearray(bundle.payload())
    assert w.parsed(w.Bundle(bytes(data)).frame(0))[7] == b"payload"
    data[-9] ^= 1
    with pytest.raises(ValueError):
        w.Bundle(bytes(data))
    data[-9] ^= 1
    data[-10] ^= 1  # the frame's checksum
    with pytest.raises(ValueError):
        w.Bundle(bytes(data)).frame(0)


def test_hot_payload_is_salted(spark, monkeypatch):
    """The way for many groups: the payload that most pages have is spread, rows are as before."""
    from sparktab.operators import support

    monkeypatch.setattr(support, "SMALL_ROWS", 1)
    monkeypatch.setattr(w, "pinned", lambda table: support.pinned(table, 1))
    pages = [(i, "u", "hot" if i % 3 else f"p{i // 9}") for i in range(900)]
    same(w.page_table(spark.createDataFrame(pages, SCHEMA).repartition(3)), expected(pages))


def test_nothing(spark):
    assert w.page_table(spark.createDataFrame([], SCHEMA)).count() == 0
