"""WARC archives in Zstandard, each record a frame of its own, with a shared dictionary.

The dictionary is built from a bounded sample of the records to be archived, whole ones chosen
by hash, and embedded in a skippable frame at the head of every file, so that a file can be
read by itself. Pages with
equal payloads of some size are archived once, with the largest page_id; the others become
revisit records that refer to it.

Defined results: a null page is an empty payload; a null url gets a urn of the page. Of rows
with the same page_id and payload one is the response. A null page_id counts as smaller than
any other. An empty table gives no records. Other columns don't matter.
"""

from __future__ import annotations

import hashlib
import struct
from base64 import b16encode, b32decode, b32encode
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from textlake.llm import files
from textlake.plans.staging import new_path, stage

LEAST = 1000  # bytes from which equal payloads are archived once
FILE_BYTES = 64_000_000  # a file that has grown so large is followed by another
SAMPLE_RECORDS, SAMPLE_BYTES = 2000, 8_000_000  # different records, and bytes of them together, for the dictionary
DICTIONARY_BYTES, LEVEL = 65_536, 3
SKIPPABLE = 0x184D2A5D  # fixed value: mark of a dictionary frame in a .warc.zst file
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def name_of(page_id: int | None, digest: str, number: int) -> str:
    """The name of the number-th record of a page with that payload."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}:{number}>"


def record(kind: str, name: str, url: str | None, payload: bytes, refers: str | None, day: str) -> bytes:
    """One WARC/1.1 record; a revisit has the head of the response but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    uri = name[1:-1] if url is None else "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url)
    digest = b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {day}", f"WARC-Target-URI: {uri}"]
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Type, names, digest, payload and its full length from a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = b16encode(b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))).decode().lower()
    return {
        "type": fields["WARC-Type"],
        "name": fields["WARC-Record-ID"],
        "refers": fields.get("WARC-Refers-To"),
        "uri": fields["WARC-Target-URI"],
        "digest": digest,
        "length": length,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def page_of(name: str | None) -> int | None:
    """The page id in a record's name."""
    digits = name.split(":")[2] if name else ""
    return int(digits) if digits else None


def dictionary(samples: list[bytes]) -> bytes | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return None


def frames(stream, size: int = 1 << 18) -> Iterator[bytes]:
    """The records of an open archive, one frame at a time."""
    head, known = stream.read(8), None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        known = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", head[4:])[0]))
        head = b""
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    frame, out = reader.decompressobj(), []
    while True:
        chunk, head = head or stream.read(size), b""
        if not chunk:
            return
        while chunk:
            out.append(frame.decompress(chunk))
            if not frame.eof:
                break
            yield b"".join(out)
            chunk, frame, out = frame.unused_data, reader.decompressobj(), []


def _typed(pages: DataFrame) -> DataFrame:
    """Pages with digest, number among rows of the same page and payload, and for revisits _of.

    Which payloads repeat is found on narrow rows; the pages themselves move once, by page.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = keyed.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html"))
    narrow = keyed.where(F.col("bytes") >= LEAST).groupBy("page_id", "digest", "bytes").agg(F.count("*").alias("n"))
    narrow = stage(narrow, "digests")
    best = narrow.groupBy("digest", "bytes").agg(F.sum("n").alias("rows"), F.max("page_id").alias("_of")).where("rows > 1")
    again = narrow.join(best.drop("rows"), ["digest", "bytes"])
    again = stage(again.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "_of"), "repeated")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    number = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url"))
    rows = keyed.join(again, same, "left").withColumn("_number", number)
    visited = F.col("_digest").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("_of")) | (F.col("_number") > 1))
    return rows.select("page_id", "url", "html", "digest", "_number", "_of", visited.alias("_again"))


def sampled(pages: DataFrame) -> list[Row]:
    """Whole pages for the dictionary, equal rows once: the first ones by hash that fit.

    Lengths are looked at first, so that no more than SAMPLE_BYTES come to the driver. A page that
    doesn't fit into what is left is left out alone.
    """
    keyed = pages.select("page_id", "url", "html").where("html is not null")
    keyed = keyed.withColumn("key", F.xxhash64("page_id", "url", "html"))
    sizes = keyed.select("key", F.octet_length("html").alias("bytes")).where(F.col("bytes") <= SAMPLE_BYTES)
    left, chosen = SAMPLE_BYTES, []
    for row in sizes.distinct().orderBy("key", "bytes").limit(SAMPLE_RECORDS).collect():
        if row["bytes"] <= left:
            left -= row["bytes"]
            chosen.append(row["key"])
    rows = keyed.where(F.col("key").isin(chosen)).groupBy("key").agg(F.max(F.struct("html", "page_id", "url")).alias("page"))
    return rows.orderBy("key").select("page.*").collect()


def write_archives(pages: DataFrame, day: str | None = None) -> DataFrame:
    """Write an archive record per page; returns the written list of files (path, records)."""
    spark = pages.sparkSession
    rows, folder = _typed(pages), new_path(spark, "warc")
    day = day or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    learned = dictionary([record("response", name_of(r["page_id"], "", 1), r["url"], r["html"].encode(), None, day) for r in sampled(pages)])
    shared = spark.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value and zstandard.ZstdCompressionDict(shared.value)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known) if known else zstandard.ZstdCompressor(level=LEVEL)

        def records() -> Iterator[bytes]:
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                    refers = name_of(row["_of"], row["digest"], 1) if row["_again"] else None
                    name = name_of(row["page_id"], row["digest"], row["_number"])
                    kind = "revisit" if row["_again"] else "response"
                    yield packer.compress(record(kind, name, row["url"], row["html"].encode(), refers, day))

        source = records()
        frame = next(source, None)
        while frame is not None:
            with files.new_file(folder, ".warc.zst") as (path, stream):
                if known:
                    stream.write(struct.pack("<II", SKIPPABLE, len(shared.value)) + shared.value)
                count, size = 0, 0
                while frame is not None and size < FILE_BYTES:
                    stream.write(frame)
                    count, size, frame = count + 1, size + len(frame), next(source, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return stage(rows.mapInArrow(run, "path string, records bigint"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, url, type, refers_to, digest, length, payload) of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("uri", pa.string()), ("type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("length", pa.int64()), ("payload", pa.binary())]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input(path) as stream:
                    rows = []
                    for raw in frames(stream):
                        x = parsed(raw)
                        rows.append(x | {"page_id": page_of(x["name"]), "refers_to": page_of(x["refers"])})
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    kinds = "page_id bigint, uri string, type string, refers_to bigint, digest string, length bigint, payload binary"
    spread = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return archives.repartition(spread, "path").mapInArrow(run, kinds)


def archived(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), from the archives.

    The payload of a response is measured, that of a revisit is what its record says.
    """
    found = read_archives(write_archives(pages))
    whole = F.col("type") == "response"
    return found.select(
        "page_id",
        F.when(whole, F.octet_length("payload")).otherwise(F.col("length")).cast("bigint").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )
