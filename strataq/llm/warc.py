"""WARC archives with a Zstandard dictionary.

A writer task gathers records up to ``archive_bytes``, trains a dictionary on a part of them, and writes one
archive: a skippable frame that holds the dictionary, then each record as a frame of its own, compressed
with it. Of equal payloads, the record with the smallest identifier is a response and the others
revisit it, without a payload. Archives go to the shared folder through pyarrow's file systems, under names that no
other attempt of a task uses; the manifest, a table that Spark commits, lists those of the attempts that counted.

Nulls: a null html is an empty payload; a null url is written as about:blank; a row with a null identifier
revisits the smallest identifier, and is a response where equal payloads have none. Rows that repeat the
smallest identifier are responses all. Line breaks and control bytes in urls are percent-encoded. Empty
tables write no archive and give no rows. Extra columns are ignored. One record has to fit in memory.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm.common import fresh_path, mark_maybe, stash

#: Fixed values of the format: the skippable frame that holds a dictionary, and the revisit profile.
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICT_BYTES = 32 << 10
#: Of each record at most so many bytes, and at most so many bytes in all, train a dictionary.
SAMPLE_EACH, SAMPLE_ALL = 8 << 10, 2 << 20


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _uri(url: str | None) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url) if url else "about:blank"


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record. A revisit names the response and carries the length and digest of its payload."""
    digest = digest_of(payload)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Target-URI", _uri(url)), ("WARC-Date", date),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary for these records; where they are too few to train one, their own first bytes."""
    step = max(1, sum(min(len(r), SAMPLE_EACH) for r in records) // SAMPLE_ALL + 1)
    samples = [r[:SAMPLE_EACH] for r in records[::step]]
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * DICT_BYTES:
        try:
            return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8, f=18, accel=4, split_point=1.0, level=3).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:DICT_BYTES]


def archive_parts(records: list[bytes], level: int = 3) -> Iterator[bytes]:
    """The archive's frames: the dictionary's, then one for each record."""
    d = train_dictionary(records)
    yield DICT_MAGIC.to_bytes(4, "little") + len(d).to_bytes(4, "little") + d
    c = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=True)
    for r in records:
        yield c.compress(r)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, from a binary file; one record in memory at a time."""
    head = stream.read(8)
    if int.from_bytes(head[:4], "little") != DICT_MAGIC:
        raise ValueError("the archive doesn't begin with its dictionary")
    d = stream.read(int.from_bytes(head[4:], "little"))
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None).stream_reader(stream, read_across_frames=True)
    buffer = b""

    def more(n: int) -> bool:
        nonlocal buffer
        got = [buffer]
        have = len(buffer)
        while have < n:
            x = plain.read(max(n - have, 1 << 16))
            if not x:
                break
            got.append(x)
            have += len(x)
        buffer = b"".join(got)
        return have >= n

    while buffer or more(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more(len(buffer) + 1):
                raise ValueError("the archive ends within a record's header")
        lines = buffer[:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        if not more(end + 4 + n + 4):
            raise ValueError("the archive ends within a record")
        yield fields, buffer[end + 4: end + 4 + n]
        buffer = buffer[end + 4 + n + 4:]


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(folder: str, archive_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        ctx, made = TaskContext.get(), 0
        held, size = [], 0

        def flush():
            nonlocal held, size, made
            name = f"{folder}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{made:04d}.warc.zst"
            store, path = _open(name)
            with store.open_output_stream(path, compression=None) as f:
                for part in archive_parts(held):
                    f.write(part)
                written = f.tell()
            row = pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "raw_bytes": [size], "archive_bytes": [written]}, schema=MANIFEST)
            held, size, made = [], 0, made + 1
            return row

        for batch in batches:
            cols = [batch.column(k) for k in range(4)]
            for k in range(batch.num_rows):
                page_id, url, payload, refers_to = (c[k].as_py() for c in cols)
                r = record_bytes(page_id, url, payload or b"", refers_to, refers_to is not None)
                held.append(r)
                size += len(r)
                if size >= archive_bytes:
                    yield flush()
        if held:
            yield flush()

    return run


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("raw_bytes", pa.int64()), ("archive_bytes", pa.int64())])


def payload_of(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """id, url, payload, refers_to. Equal payloads meet as digests only. Rows that may be revisits are shuffled once, by
    identifier and digest, so that a hot payload is spread over all tasks; all others, which a bit filter tells, stay where they are."""
    p = payload_of(F.col(html_col))
    light = pages.select(F.col(id_col).alias("i"), F.sha2(p, 256).alias("k")).where(F.length(p) >= min_bytes)
    owner = light.groupBy("k").agg(F.min("i").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").select("k", "refers_to")
    revisits = stash(pages.sparkSession, light.join(owner, "k").where("i is null or i != refers_to").distinct(), "revisits")
    full = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), p.alias("payload")).withColumn("key", F.sha2("payload", 256)).withColumn("both", F.xxhash64("id", "key"))
    full = mark_maybe(full, revisits.select(F.xxhash64("i", "k").alias("id")), {"may": "both"})
    some, rest = full.where("may"), full.where("not may")
    some = some.join(revisits, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left").select("id", "url", "payload", "refers_to")
    return some.union(rest.select("id", "url", "payload", F.lit(None).cast(revisits.schema["refers_to"].dataType).alias("refers_to")))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, folder: str | None = None,
                   archive_bytes: int = 16 << 20) -> DataFrame:
    """Write all rows; returns the manifest: path, records, raw_bytes, archive_bytes. Identifiers are integers."""
    spark = pages.sparkSession
    folder = (folder or fresh_path(spark, "warc")).rstrip("/")
    _make(spark, folder)
    rows = mark_revisits(pages, id_col, url_col, html_col, min_bytes)
    schema = "path string, records long, raw_bytes long, archive_bytes long"
    return stash(spark, rows.mapInArrow(_write(folder, archive_bytes), schema), "manifest")


def _make(spark: SparkSession, folder: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(p)


RECORDS = ("page_id long, url string, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, at = _open(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as f:
                    for h, block in read_records(f):
                        revisit, digest = h["WARC-Type"] == "revisit", h["WARC-Payload-Digest"].removeprefix("sha1:")
                        payload = None if revisit else block[block.index(b"\r\n\r\n") + 4:]
                        if payload is not None and digest_of(payload) != digest:
                            raise ValueError(f"{path}: {h['WARC-Record-ID']} has another payload than its digest says")
                        rows.append((int(h["X-Page-Id"]) if "X-Page-Id" in h else None, h["WARC-Target-URI"], h["WARC-Record-ID"], int(h["X-Payload-Length"]), digest,
                                     h["WARC-Type"], int(h["X-Refers-To-Page-Id"]) if revisit else None, payload if with_payload else None))
                        size += len(payload or b"") if with_payload else 0
                        if len(rows) >= 4096 or size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives that a manifest lists; each archive is streamed by one task and every
    response's digest is checked."""
    paths = manifest.select("path")
    n = max(1, manifest.count())
    return paths.repartition(min(n, 10_000)).mapInArrow(_read(with_payload), RECORDS)
