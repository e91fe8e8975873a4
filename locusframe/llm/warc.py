"""WARC archives with an embedded Zstandard dictionary.

Each task writes archives of its pages: it trains a dictionary on the first records (at most
`sample_bytes` of them), puts it in a leading skippable frame, and compresses every record as a
frame of its own. Of pages with equal payloads of at least `least_bytes` the one with the smallest
page_id is a response and the others are revisits that refer to it.

Null html is an empty payload. Null page_ids count as the largest. Rows that are equal in page_id,
url and payload are the same capture: all of them are responses where one is. Fewer than eight
records, or too little to train on, give an archive without a dictionary. Payloads of any length are
written whole; an empty table gives an empty manifest. Columns of pages other than page_id, url and
html, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.shared import bounded_batches, ranges_for, shared_dir, stored

#: Fixed by the WARC/Zstandard convention: the magic number of the dictionary's skippable frame.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_record_types(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload (binary), digest (hex SHA-256), record_type, refers_to."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    shared = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.min(first).alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first")
    )
    revisit = F.col("first").isNotNull() & ~(F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")))
    return rows.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first.page_id")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    n = name.strip("<>").rpartition(":")[2]
    return int(n) if n else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    target = "".join((url or "").split()) or _name(page_id).strip("<>")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int):
    """A trained dictionary, or None where the samples are too few."""
    import zstandard

    if len(samples) < 8:
        return None
    for k in (256, 48):  # segments of text; short ones where there is little to train on
        try:
            return zstandard.train_dictionary(max(256, min(size, sum(map(len, samples)) // 8)), samples, k=k, d=8)
        except zstandard.ZstdError:
            pass
    return None


class Archive:
    """One file: the dictionary's frame, a warcinfo record, and a frame for each record."""

    def __init__(self, out, dictionary, level: int, date: str):
        import zstandard

        self.out, self.bytes, self.records = out, 0, 0
        raw = dictionary.as_bytes() if dictionary else b""
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True).compress
        if raw:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        info = b"software: locusframe\r\nformat: WARC File Format 1.1\r\n"
        self._put(self.compress("\r\n".join(["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, date)}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(info)}"]).encode() + b"\r\n\r\n" + info + b"\r\n\r\n"))

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.bytes += len(b)

    def add(self, rec: bytes) -> None:
        self._put(self.compress(rec))
        self.records += 1


def write_archives(pages: DataFrame, path: str | None = None, level: int = 3, dictionary_bytes: int = 65_536, sample_bytes: int = 1_500_000, most_bytes: int = 1 << 30, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 100) -> DataFrame:
    """Writes archives under `path`; returns the manifest: file, records, bytes (stored, so written once).

    A file's name holds its task attempt, and only the manifest's files count: an attempt that was
    lost leaves files that nothing reads."""
    base = path or shared_dir(bounded_batches(pages).sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = files.FileSystem.from_uri(base)
        store.create_dir(root, recursive=True)
        context, made, archive, name = TaskContext.get(), [], None, ""
        held: list[bytes] = []

        def begin() -> None:
            nonlocal archive, name
            name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{len(made):04d}.warc.zst"
            archive = Archive(store.open_output_stream(f"{root}/{name}", compression=None), train(held, dictionary_bytes), level, date)
            for x in held:
                archive.add(x)
            held.clear()

        def end() -> None:
            nonlocal archive
            archive.out.close()
            made.append((f"{base}/{name}", archive.records, archive.bytes))
            archive = None

        size = 0
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")), strict=True):
                rec = record(*row, date)
                if archive:
                    archive.add(rec)
                    if archive.bytes >= most_bytes:
                        end()
                        size = 0
                else:
                    held.append(rec)
                    size += len(rec)
                    if size >= sample_bytes:
                        begin()
        if held:
            begin()
        if archive:
            end()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["file", "records", "bytes"])

    return stored(with_record_types(pages, least_bytes).mapInArrow(run, "file string, records long, bytes long"))


def frames(source, block: int = 65_536) -> Iterator[bytes]:
    """The content of each frame of an archive, by its own dictionary."""
    import zstandard

    buf = source.read(8)
    dictionary = None
    if len(buf) == 8 and struct.unpack("<I", buf[:4])[0] == DICTIONARY_FRAME:
        dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<I", buf[4:])[0]))
        buf = b""
    ctx = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        buf = buf or source.read(block)
        if not buf:
            return
        frame, out = ctx.decompressobj(), []
        while not frame.eof:
            if not buf and not (buf := source.read(block)):
                raise ValueError("an archive ends within a frame")
            out.append(frame.decompress(buf))
            buf = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def parse(rec: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if fields["WARC-Type"] == "warcinfo":
        return fields, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url (and payload, null for revisits).

    A response's payload is hashed again and must agree with its header."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b["file"].to_pylist():
                store, name = files.FileSystem.from_uri(uri)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as source:
                    for rec in frames(source):
                        fields, http, payload = parse(rec)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        digest, n = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
                        if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{uri}: a payload doesn't match its digest")
                        rows.append((_number(fields["WARC-Record-ID"]), n, digest, kind, _number(fields["WARC-Refers-To"]) if kind == "revisit" else None, fields["WARC-Target-URI"], *[payload if kind == "response" else None] * with_payload))
                        size += len(rec)
                        if size > 16_000_000:
                            yield _batch(rows, with_payload)
                            rows, size = [], 0
                yield _batch(rows, with_payload)

    return manifest.select("file").repartition(ranges_for(manifest.sparkSession)).mapInArrow(run, schema)


def _batch(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), *[("payload", pa.binary())] * with_payload]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])
