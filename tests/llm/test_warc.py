from __future__ import annotations

import hashlib
import io
import random
from collections import Counter, defaultdict

import zstandard
from pyspark.sql import functions as F

from textlake.llm import files, warc

SCHEMA = "page_id long, url string, html string"


def cases() -> list[tuple]:
    rng = random.Random(7)
    words = ["<p>", "</p>", "<a href='/x'>", "the", "Straße", "日本", "\r\n\r\n", "WARC/1.1"]
    page = lambda n: "".join(rng.choice(words) for _ in range(n))
    shared = [page(600) for _ in range(5)] + ["x" * 999, "x" * 1000, "é" * 500]
    pages = [(i, f"https://e.org/{i}", page(rng.randint(0, 800))) for i in range(150)]
    pages += [(1000 + i, None, rng.choice(shared)) for i in range(120)]
    pages += [(2000, "a b\r\nX: y\n", ""), (2001, "", None), (None, "u", shared[0]), (-3, "u", shared[0]), (2002, "u", page(40_000))]
    pages += [(1500, "u", shared[1]), (1500, "v", shared[1]), (2003, "u", None)]
    rng.shuffle(pages)
    return pages


def expected(pages: list[tuple]) -> Counter:
    groups = defaultdict(list)
    for i, _, html in pages:
        body = (html or "").encode()
        if len(body) >= 1000:
            groups[body].append(i)
    found = Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        if len(body) < 1000:
            found[(i, len(body), hashlib.sha1(body).hexdigest(), "response", None)] += 1
    for body, ids in groups.items():
        sha, top = hashlib.sha1(body).hexdigest(), max(i for i in ids if i is not None)
        rest = Counter(ids)
        rest[top] -= 1
        found[(top, len(body), sha, "response", None)] += 1
        for i, n in rest.items():
            found[(i, len(body), sha, "revisit", top)] += n
    return +found


def test_archived_pages(spark):
    pages = cases()
    df = spark.createDataFrame(pages, SCHEMA).repartition(3).withColumn("digest", F.lit("x"))
    assert Counter(tuple(r) for r in warc.archived(df).collect()) == expected(pages)


def test_payloads_come_back(spark):
    pages = cases()
    archives = warc.write_archives(spark.createDataFrame(pages, SCHEMA))
    rows = warc.read_archives(archives).collect()
    texts = Counter((html or "").encode() for _, _, html in pages)
    assert {bytes(r["payload"]) for r in rows if r["type"] == "response"} == set(texts)
    assert all(r["payload"] is None for r in rows if r["type"] == "revisit")


def test_file_format(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    archives = warc.write_archives(spark.createDataFrame(cases(), SCHEMA).coalesce(1)).collect()
    assert len(archives) > 5 and sum(r["records"] for r in archives) == len(cases())
    raw = files.read_range(archives[0]["path"])
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(raw[4:8], "little")
    known = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    first = reader.decompress(raw[8 + size :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and first.endswith(b"\r\n\r\n")
    assert list(warc.frames(io.BytesIO(raw), 7))[0] == first


def test_few_records_need_no_dictionary(spark):
    assert [tuple(r) for r in warc.archived(spark.createDataFrame([(1, None, "a")], SCHEMA)).collect()] == [
        (1, 1, hashlib.sha1(b"a").hexdigest(), "response", None)
    ]
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert Counter(tuple(r) for r in warc.archived(pages).collect()) == expected(rows)


def test_sample_of_whole_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 9000)
    pages = [(i, "u", f"{i} " * (100 + i)) for i in range(60)] * 3 + [(99, "u", "long " * 4000), (100, None, None)]
    first = [tuple(r) for r in warc.sampled(spark.createDataFrame(pages, SCHEMA).repartition(5))]
    again = [tuple(r) for r in warc.sampled(spark.createDataFrame(pages[::-1], SCHEMA).repartition(2))]
    assert first == again and len(set(first)) == len(first)
    assert {(page, url, html) for html, page, url in first} <= set(pages)
    assert 9000 - 400 <= sum(len(html) for html, *_ in first) <= 9000
    assert warc.sampled(spark.createDataFrame([], SCHEMA)) == []
