"""WARC archives with a Zstandard dictionary built from the archived records.

Layout of an archive: a leading skippable frame (magic 0x184D2A5D) that holds
the dictionary, then every record as a Zstandard frame of its own, compressed
with that dictionary. Between frames stands an empty skippable frame, which
any Zstandard reader passes over: it is the line separator of Spark's text
writer, so archives are written through Spark's committed output to whatever
file system the folder is on, one file a partition (small ones are merged), and
a lost task leaves no half archive behind. They are read back with the binary file reader.

Equal payloads of at least ``REVISIT_BYTES`` are stored once: the record of the
largest page_id is the response, the others are revisits that name it. The
digests are grouped as small rows (digest, page_id), with partial maxima per
task, and only the resulting (page_id, digest) rows are joined to the pages.

Defined cases: a null html is an empty payload; a null url is written as an
empty target; a null page_id is read back as null and always a response; rows
with equal page_id and equal payload are all responses, or all revisits of the
same page; an empty table writes and returns nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.store import fresh_path, parts_for, pick, ship_code

REVISIT_BYTES = 1000
DICT_BYTES = 64 * 1024        # size of the dictionary
DICT_RECORDS = 500            # records that it is built from, by hash of the payload
DICT_RECORD_BYTES = 32 * 1024  # larger records don't take part: they need no dictionary
LEVEL = 3
ARCHIVE_BYTES = 4 << 20       # payload of an archive, on average, where there are partitions to merge
DICT_FRAME = 0x184D2A5D       # fixed values of the formats
EMPTY_FRAME = b"P*M\x18\x00\x00\x00\x00"
SKIPPABLE = range(0x184D2A50, 0x184D2A60)


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the HTTP header alone."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if revisit else http + payload
    target = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_id(refers_to)}"]
    return "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("ascii").split("\r\n")
    f = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(f["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
    if f["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {f['WARC-Record-ID']} differs from its digest")
    return {"page_id": _page(f["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": f["WARC-Type"], "refers_to": _page(f.get("WARC-Refers-To", "")),
            "url": f["WARC-Target-URI"], "payload": payload if f["WARC-Type"] == "response" else None}


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(magic, content) of an archive's frames; records are decompressed with the archive's dictionary."""
    import zstandard

    reader, at, view = zstandard.ZstdDecompressor(), 0, memoryview(data)
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if at + 4 <= len(data) else 0
        if magic in SKIPPABLE:
            size = struct.unpack_from("<I", data, at + 4)[0]
            body = bytes(view[at + 8:at + 8 + size])
            at += 8 + size
            if magic == DICT_FRAME:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            yield magic, body
            continue
        one, out, step = reader.decompressobj(), [], 16 * 1024
        while not one.eof:
            chunk = view[at:at + step]
            if not len(chunk):
                raise ValueError("an archive ends within a record")
            out.append(one.decompress(chunk))
            at += len(chunk) - (len(one.unused_data) if one.eof else 0)
            step = min(2 * step, 1 << 20)
        yield magic, b"".join(out)


def dictionary(pages: DataFrame) -> bytes:
    """A dictionary from at most DICT_RECORDS records of at most DICT_RECORD_BYTES; empty if they are too few.

    One task builds it from the records with the smallest hashes.
    """
    sample = (pages.filter((F.length("payload") > 0) & (F.length("payload") <= DICT_RECORD_BYTES) & F.col("refers_to").isNull())
              .select(F.xxhash64("payload").alias("h"), "page_id", "url", "payload", "digest")
              .orderBy("h", "page_id").limit(DICT_RECORDS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        records = [record(r["page_id"], r["url"], r["payload"], r["digest"], None)
                   for b in batches for r in b.to_pylist()]
        if not records:
            return
        try:
            out = zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, records)) // 8), records).as_bytes()
        except zstandard.ZstdError:        # too little text to train on
            out = b""
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["d"])

    got = sample.coalesce(1).mapInArrow(build, "d binary").collect()
    return bytes(got[0].d) if got else b""


def with_targets(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every page."""
    base = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    small = base.filter((F.length("payload") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    # members of a digest that has a larger page: a partial maximum in each task, then a join that AQE may split
    largest = small.groupBy("digest").agg(F.max("page_id").alias("top"), F.min("page_id").alias("low")) \
        .filter("low < top").select(F.col("digest").alias("d"), F.col("top"))
    revisits = small.join(largest, (F.col("digest") == F.col("d")) & (F.col("page_id") < F.col("top"))) \
        .select(F.col("page_id").alias("p"), "d", "top").distinct()
    return base.join(revisits, (F.col("page_id") == F.col("p")) & (F.col("digest") == F.col("d")), "left") \
        .select("page_id", "url", "payload", "digest", F.col("top").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Archive every row of ``pages`` under ``path``, a file per partition.

    Partitions of less than ARCHIVE_BYTES are merged: each file holds the dictionary, and opening, closing
    and committing it costs a task more than a little payload does.
    """
    ship_code(pages.sparkSession)
    total = pick(pages, "html").agg(F.sum(F.octet_length(F.col("html").cast("string")))).first()[0]
    every = with_targets(pages, least).coalesce(parts_for(total, ARCHIVE_BYTES))
    # only small records matter to the dictionary, so revisits need not be told apart here
    plain = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
        F.lit(None).cast("long").alias("refers_to")).withColumn("digest", F.sha1("payload"))
    trained = dictionary(plain)        # DICT_BYTES at most

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        writer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **(
            {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}))
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            out, size = [], 0
            if first and trained:
                out.append(struct.pack("<II", DICT_FRAME, len(trained)) + trained)
            first = False
            cols = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                out.append(writer.compress(record(*(c[i].as_py() for c in cols))))
                size += len(out[-1])
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    every.mapInArrow(compress, "frame binary").select(F.col("frame").cast("string").alias("value")) \
        .write.option("lineSep", EMPTY_FRAME.decode("latin-1")).text(path)


RECORD_DDL = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
              "url string, payload binary")
RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``; digests are verified."""
    ship_code(spark)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in RECORD], schema=RECORD)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for magic, body in frames(batch.column(0)[i].as_py()):
                    if magic in SKIPPABLE:
                        continue
                    r = parsed(body)
                    if not payloads:
                        r["payload"] = None
                    rows.append(r)
                    size += len(body)
                    if size > 1 << 24:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(unpack, RECORD_DDL)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and return what the archives hold, without payloads."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
