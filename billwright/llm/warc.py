"""WARC archives of pages: written by tasks, and read back record by record.

An archive is a row of gzip members, one for each record, so that a reader can begin at
any member and never holds more than one record. Reading inflates a member piece by
piece, takes the block by its Content-Length and compares both digests with what it
has read. Files lie in a folder that all executors reach by a URI (file, hdfs, s3, ...).
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billwright.llm.common import by_batches, shared_path, written

#: Payloads of fewer bytes are always stored whole, and an archive's size in bytes.
LEAST_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
_PIECE = 1 << 16
_DATE = "1970-01-01T00:00:00Z"  # the table has no crawl time

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, record_type string, refers_to long, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary"
)


class WarcError(ValueError):
    """An archive that is cut off, wrongly framed, or does not match its digests."""


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _page_urn(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<{uuid.uuid4().urn}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
    revisit: bool = False,
) -> bytes:
    """One record, not yet compressed. A revisit leaves the payload out and keeps its digest."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_page_urn(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if url is not None:
        header.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=';/?:@&=+$,#%[]!*()~')}")
    if revisit:
        header.append(f"WARC-Refers-To: {_page_urn(refers_to)}")
        header.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Member:
    """Bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, stream, held: bytes):
        self._stream, self._inflate = stream, zlib.decompressobj(31)
        self._packed, self._plain = held, b""

    def _more(self) -> bool:
        while not self._inflate.eof:
            if not self._packed:
                self._packed = self._stream.read(_PIECE)
                if not self._packed:
                    raise WarcError("the archive ends within a record")
            try:
                plain = self._inflate.decompress(self._packed, _PIECE)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            self._packed = self._inflate.unconsumed_tail
            if plain:
                self._plain += plain
                return True
        return False

    def until(self, end: bytes, most: int) -> bytes:
        while (at := self._plain.find(end)) < 0:
            if len(self._plain) > most or not self._more():
                raise WarcError("a header without an end")
        found, self._plain = self._plain[:at], self._plain[at + len(end) :]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """``size`` bytes in pieces."""
        while size:
            if not self._plain and not self._more():
                raise WarcError("a block is shorter than its Content-Length")
            piece, self._plain = self._plain[:size], self._plain[size:]
            size -= len(piece)
            yield piece

    def close(self) -> bytes:
        """What follows the member in the file, which has to end here."""
        while self._more():
            pass
        if self._plain != b"\r\n\r\n":
            raise WarcError("a block does not end where its Content-Length says")
        return self._inflate.unused_data


def _fields(header: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in header.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def read_records(stream) -> Iterator[dict]:
    """The records of one archive, in order; raises WarcError for one that is damaged."""
    held = stream.read(_PIECE)
    while held:
        member = _Member(stream, held)
        fields = _fields(member.until(b"\r\n\r\n", 1 << 20))
        http, payload, size = b"", [], int(fields["content-length"])
        block_sum, payload_sum, in_http = hashlib.sha256(), hashlib.sha256(), True
        for piece in member.take(size):
            block_sum.update(piece)
            if in_http:
                http += piece
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                in_http, piece, http = False, http[at + 4 :], http[:at]
            payload_sum.update(piece)
            payload.append(piece)
        held = member.close() or stream.read(_PIECE)
        if f"sha256:{block_sum.hexdigest()}" != fields["warc-block-digest"]:
            raise WarcError("a block does not match its digest")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and f"sha256:{payload_sum.hexdigest()}" != fields["warc-payload-digest"]:
            raise WarcError("a payload does not match its digest")
        yield {
            "page_id": _page_of(fields["warc-record-id"]),
            "record_type": fields["warc-type"],
            "refers_to": _page_of(fields.get("warc-refers-to")),
            "target_uri": fields.get("warc-target-uri"),
            "payload_bytes": int(_fields(http)["content-length"]),
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
            "payload": None if revisit else b"".join(payload),
        }


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to) per row of ``pages``; refers_to is set for revisits.

    Of rows with equal payloads of at least 100 bytes, those with the smallest page_id
    are responses and the others revisit it. Null html is an empty payload. Rows with a
    null id are responses, repeated rows are repeated records.

    Digests alone are grouped. What they say is written, so that Spark knows its size: where
    it is small it goes to the pages, which then are not shuffled, and where it isn't, a
    payload of very many pages can be divided among tasks.
    """
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
        F.coalesce(pages["html"], F.lit("")).alias("html"),
    ).withColumn("_digest", F.sha2(F.col("html").cast("binary"), 256))
    firsts = written(
        rows.where(F.octet_length("html") >= LEAST_REVISIT_BYTES)
        .groupBy("_digest").agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"))
        .where(F.col("_first") < F.col("_last"))  # of few payloads there are several pages
        .select(F.col("_digest").alias("_same"), "_first")
    )
    joined = rows.join(firsts, F.col("_digest") == F.col("_same"), "left")
    return joined.select(
        "page_id", "url", "html",
        F.when(F.col("page_id") > F.col("_first"), F.col("_first")).alias("refers_to"),
    )


def write_archives(
    planned: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes a record per row of ``plan_records`` and returns the manifest of the archives.

    Each attempt of a task writes files of its own. The manifest is written by Spark, so
    that it names the files of the attempts that counted and no others.
    """
    folder = folder or shared_path(planned.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _place(folder)
        system.create_dir(top, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, records, size = f"{uuid.uuid4()}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                plain = record(
                    row["page_id"], row["url"], row["html"].encode(), row["refers_to"],
                    row["refers_to"] is not None,
                )
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(plain) + packer.flush()
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        if done:
            paths, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "records", "bytes"],
            )

    return written(by_batches(planned, run, MANIFEST))


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of all archives in ``manifest``, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.partition(" ")[0] for field in RECORDS.split(", ")]
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row[n] for row in rows], types.get(n, pa.string())) for n in names], names=names
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = _place(path)
                rows, size = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for row in read_records(stream):
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    spread = manifest.select("path").repartition(max(1, manifest.count()), F.xxhash64("path"))
    return spread.mapInArrow(run, RECORDS)
