"""WARC archives: write them, normalise whole-file gzip streams, read records by offset.

An archive that was compressed as one stream can only be read from its start. The
normaliser inflates such a file once, writes every record as a gzip member of its own
and a sidecar index of the members' offsets, so that any record can be read alone.

Archives are files of bounded size, and a task handles whole files one record at a
time: memory is bounded by the longest record. Files are written through `pyarrow.fs`,
so the folder may be on any store that it reaches and that all executors share. Each
attempt of a task writes under names of its own, and only the names that a finished
attempt reports are read, so lost or repeated tasks do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.session import new_path, settle

CHUNK = 1 << 20
#: a fixed date in every record, so that equal input gives equal archives
RECORD_DATE = "2024-01-01T00:00:00Z"
INDEX_SCHEMA = "archive string, offset long, length long, record_id string, record_type string, uri string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`records` (page_id, url, payload) plus `row`, `digest`, `record_type`, `refers_to`, settled.

    Of records with equal payloads of at least `least_bytes` bytes, the one with the
    largest page_id is a response and the others revisit it; of several rows with that
    page_id, one (the last as stored) is the response. Null page_ids count as smallest.
    Payloads are equal if their SHA-256 and length are. `row` numbers the rows.

    The digests are reduced on the map side to one row each, so a payload that a third
    of all rows share is one row per task in the exchange.
    """
    hashed = settle(
        records.select(
            "page_id",
            "url",
            "payload",
            F.sha2("payload", 256).alias("sha256"),
            F.octet_length("payload").cast("long").alias("bytes"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "payloads",
    )
    same = ["sha256", "bytes"]
    # nulls first: a struct's order puts a null page_id below all others
    newest = (
        hashed.where(F.col("bytes") >= least_bytes)
        .groupBy(*same)
        .agg(F.max(F.struct("page_id", "row")).alias("newest"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .select(*same, "newest")
    )
    joined = hashed.join(settle(newest, "newest"), same, "left")
    revisit = F.col("newest").isNotNull() & (F.col("newest.row") != F.col("row"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "row",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("newest.page_id")).alias("refers_to"),
    )


def _record(page_id, url, payload: bytes, kind: str, refers_to) -> bytes:
    """The bytes of one WARC record; a revisit carries the headers without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {RECORD_DATE}",
        # a header is one line; what an address has beyond that is escaped
        f"WARC-Target-URI: {_escaped(url)}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
    ]
    if kind == "revisit":
        head.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _escaped(url: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url or "")


def write_monolithic(records: DataFrame, folder: str, file_bytes: int = 64 << 20) -> DataFrame:
    """Write marked records as WARC files of one gzip stream each; a settled table of `archive` and `records`.

    A task closes a file once it holds `file_bytes` bytes before compression.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if sink is None:
                    name, count, held = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
                page, refers = (None if pd.isna(v) else int(v) for v in (row.page_id, row.refers_to))
                data = _record(page, row.url, bytes(row.payload), row.record_type, refers)
                sink.write(squeeze.compress(data))
                count, held = count + 1, held + len(data)
                if held >= file_bytes:
                    sink.write(squeeze.flush())
                    sink.close()
                    sink = None
                    yield pd.DataFrame({"archive": [f"{folder}/{name}"], "records": [count]})
        if sink is not None:
            sink.write(squeeze.flush())
            sink.close()
            yield pd.DataFrame({"archive": [f"{folder}/{name}"], "records": [count]})

    return settle(
        records.select("page_id", "url", "payload", "record_type", "refers_to").mapInPandas(
            write, "archive string, records long"
        ),
        "archives",
    )


class _Inflated:
    """The plain bytes of a gzip file of one or many members, inflated once from start to end."""

    def __init__(self, source):
        self.source, self.inflate, self.ready = source, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            if not data and not (data := self.source.read(CHUNK)):
                return False
            self.inflate = zlib.decompressobj(31)
        elif not (data := self.inflate.unconsumed_tail or self.source.read(CHUNK)):
            raise EOFError("the gzip stream ends early")
        self.ready += self.inflate.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with a mark; None at the end of the file."""
        start = 0
        while (at := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self._more():
                if self.ready:
                    raise EOFError("the archive ends inside a record's head")
                return None
        return self.exactly(at + len(mark))

    def exactly(self, count: int) -> bytes:
        while len(self.ready) < count:
            if not self._more():
                raise EOFError("the archive ends inside a record")
        taken = bytes(self.ready[:count])
        del self.ready[:count]
        return taken


def parse_head(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def records_of(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, the record's bytes) of each record of an archive, one at a time."""
    plain = _Inflated(source)
    while (head := plain.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        fields = parse_head(head)
        yield fields, head + plain.exactly(int(fields["content-length"]) + 4)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with one gzip member per record; the settled index of all members.

    Beside `x.warc.gz` lies the sidecar `x.cdx`: a line per record with offset, length,
    record id, type and address, parted by tabs. The result holds the same rows with
    the archive's path. One task inflates a file once and holds one record of it.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, root = fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        for batch in batches:
            for path in batch["archive"]:
                source, inner = fs.FileSystem.from_uri(path)
                name, offset, index = uuid.uuid4().hex, 0, []
                with (
                    source.open_input_stream(inner, compression=None) as packed,
                    target.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as sink,
                    target.open_output_stream(f"{root}/{name}.cdx") as sidecar,
                ):
                    for fields, data in records_of(packed):
                        squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
                        member = squeeze.compress(data) + squeeze.flush()
                        sink.write(member)
                        row = (
                            f"{folder}/{name}.warc.gz",
                            offset,
                            len(member),
                            fields.get("warc-record-id", ""),
                            fields.get("warc-type", ""),
                            fields.get("warc-target-uri", ""),
                        )
                        sidecar.write("\t".join(map(str, row[1:])).encode() + b"\n")
                        index.append(row)
                        offset += len(member)
                        if len(index) >= 10_000:
                            yield pd.DataFrame(index, columns=INDEX_COLUMNS)
                            index = []
                yield pd.DataFrame(index, columns=INDEX_COLUMNS)

    parts = max(1, archives.count())
    return settle(archives.select("archive").repartition(parts, "archive").mapInPandas(rewrite, INDEX_SCHEMA), "index")


INDEX_COLUMNS = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]
READ_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
)


def read_records(index: DataFrame) -> DataFrame:
    """The records that an index names, each read alone by its offset.

    `payload` is null for a revisit, `payload_bytes` and `payload_digest` are those of
    the full payload. A response whose payload does not match its digest is an error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_path, source = None, None
        for batch in batches:
            rows = []
            for entry in batch.itertuples(index=False):
                if entry.archive != open_path:
                    store, inner = fs.FileSystem.from_uri(entry.archive)
                    source, open_path = store.open_input_file(inner), entry.archive
                rows.append(_parsed(zlib.decompress(source.read_at(entry.length, entry.offset), 31)))
                if len(rows) >= 256:
                    yield pd.DataFrame(rows, columns=READ_COLUMNS).convert_dtypes()
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=READ_COLUMNS).convert_dtypes()

    return index.mapInPandas(read, READ_SCHEMA)


READ_COLUMNS = [field.split()[0] for field in READ_SCHEMA.split(", ")]


def _page(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parsed(data: bytes) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = parse_head(head)
    http, _, body = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(parse_head(http)["content-length"])
    if kind == "response" and (len(body) != length or sha1_base32(body) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    refers = _page(fields.get("warc-refers-to", ""))
    return (
        _page(fields["warc-record-id"]),
        length,
        digest,
        kind,
        refers,
        fields.get("warc-target-uri", ""),
        body if kind == "response" else None,
    )


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write pages (page_id, url, html) as monolithic archives, normalise them, and read them back.

    A row per page as `read_records` gives it. A null html is an empty payload, a null
    page_id or url comes back as null and as an empty text. Empty input writes nothing.
    Other columns of `pages` are not looked at.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marked = mark_revisits(pages.select("page_id", "url", payload.alias("payload")), least_bytes)
    return read_records(normalise(write_monolithic(marked, f"{folder}/streams"), f"{folder}/members"))
