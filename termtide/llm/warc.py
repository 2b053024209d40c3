"""WARC archives: a writer and a sequential reader, one gzip member per record.

The writer turns pages into `response` records; a payload that another page with a smaller id
has too becomes a `revisit` record that refers to it and carries no body. Each task writes its
archives under a shared folder and reports them in a manifest, which Spark commits as a table:
files of a task that was lost are in no manifest and are never read.

The reader goes through an archive once, in chunks: it inflates one member at a time, frames the
block by the record's content length and recomputes the digests, so its memory does not depend
on the size of the archive. It also reads archives that others wrote: only the type and the
content length of a record are required. `response` and `revisit` records are returned and all
other types passed over, framed and verified alike.

Defined results: a null html is an empty payload; a null url is written without target; a null
page id is read back as null, and such a page is a revisit if any page with an id has its
payload, else a response; repeated rows with the smallest id are all responses; other columns are
not read. Pages have equal payloads if SHA-256 and length agree. Of foreign records the page ids
are null, the payload is what follows the HTTP header as stored (the whole block if the block is
not HTTP), and a revisit that does not tell length or SHA-1 has null there. Digests are verified
if the archive names one of the algorithms of `DIGESTS`; a record in segments has no payload of
its own to verify. Truncated archives, missing or wrong lengths, wrong digests, headers above
`HEADER_BYTES` and members of several records raise `ArchiveError`.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm.common import batch_of, columns_of, cut, join_spread
from termtide.session import scratch_dir

CHUNK = 1 << 18
ARCHIVE_BYTES = 256 << 20
MOST_TASKS = 20_000
HEADER_BYTES = 1 << 20
DIGESTS = ("sha1", "sha256", "sha512", "md5")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: names that are URLs

_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RECORDS = pa.schema(
    [
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("payload", pa.binary()),
        ("record_id", pa.string()),
        ("refers_to_record", pa.string()),
    ]
)
_RECORDS_DDL = (
    "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to string, payload binary, record_id string, refers_to_record string"
)


class ArchiveError(ValueError):
    """The archive is not what its headers say."""


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page or ""}/{digest}')}>"


def _head(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [first] + [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([*lines, "", ""]).encode()


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member; `refers_to` makes it a revisit."""
    digest = base32_sha1(hashlib.sha1(payload).digest())
    http = _head(
        "HTTP/1.1 200 OK",
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
    )
    block = http if refers_to is not None else http + payload
    head = _head(
        "WARC/1.1",
        [
            ("WARC-Type", "revisit" if refers_to is not None else "response"),
            ("WARC-Record-ID", _record_id(page, digest)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else None),
            ("WARC-Profile", PROFILE if refers_to is not None else None),
            ("WARC-Refers-To", _record_id(refers_to, digest) if refers_to is not None else None),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(hashlib.sha1(block).digest())}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
            ("X-Page-Id", page),
            ("X-Refers-To-Page-Id", refers_to),
            ("X-Payload-Bytes", str(len(payload))),
        ],
    )
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


class _Source:
    """Chunks of a stream, with those bytes given back that belong to the next member."""

    def __init__(self, stream) -> None:
        self._stream = stream
        self._back = b""

    def take(self) -> bytes:
        chunk, self._back = self._back or self._stream.read(CHUNK), b""
        return chunk

    def give_back(self, chunk: bytes) -> None:
        self._back = chunk


class _Member:
    """What one gzip member inflates to, a chunk at a time."""

    def __init__(self, source: _Source) -> None:
        self._source = source
        self._inflate = zlib.decompressobj(31)
        self._held = b""

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        packed = self._inflate.unconsumed_tail or self._source.take()
        if not packed:
            raise ArchiveError("the archive ends within a record")
        try:
            self._held += self._inflate.decompress(packed, CHUNK)
        except zlib.error as error:
            raise ArchiveError(f"not a gzip member: {error}") from error
        if self._inflate.eof:
            self._source.give_back(self._inflate.unused_data)
        return True

    def through(self, mark: bytes, most: int) -> bytes:
        while mark not in self._held:
            if len(self._held) > most:
                raise ArchiveError("a record's header is too long")
            if not self._more():
                raise ArchiveError("a record's header does not end")
        found, _, self._held = self._held.partition(mark)
        return found

    def exactly(self, size: int) -> Iterator[bytes]:
        while size:
            if not self._held and not self._more():
                raise ArchiveError("a record is shorter than its content length")
            part, self._held = self._held[:size], self._held[size:]
            size -= len(part)
            yield part

    def ends_with(self, mark: bytes) -> bool:
        """Whether just this is left of the member."""
        while len(self._held) <= len(mark) and self._more():
            pass
        return self._held == mark


def _fields(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ArchiveError("a record does not start with its version")
    found: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t"):  # a folded line goes on
            found[name] = f"{found.get(name, '')} {line.strip()}".strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        found[name] = value.strip()
    return found


def _number(fields: dict[str, str], name: str) -> int | None:
    value = fields.get(name)
    if value is not None and not (value.isascii() and value.isdigit()):
        raise ArchiveError(f"{name} is not a number: {value!r}")
    return None if value is None else int(value)


def _digest(fields: dict[str, str], name: str) -> tuple[str, bytes] | None:
    """Algorithm and value of a labelled digest in base 32 or 16, if it can be verified."""
    label, _, value = fields.get(name, "").partition(":")
    label = label.strip().lower().replace("-", "")
    if label not in DIGESTS:
        return None
    value = value.strip().upper()
    size = hashlib.new(label).digest_size
    try:
        if len(value) == 2 * size:
            return label, bytes.fromhex(value)
        raw = base64.b32decode(value.rstrip("=") + "=" * (-len(value.rstrip("=")) % 8))
    except ValueError as error:
        raise ArchiveError(f"{name} cannot be read: {value!r}") from error
    if len(raw) != size:
        raise ArchiveError(f"{name} has the wrong length: {value!r}")
    return label, raw


def _is_http(fields: dict[str, str]) -> bool:
    kind = fields.get("content-type", "application/http").partition(";")[0]
    return kind.strip().lower() == "application/http"


def _read_record(member: _Member, keep_payload: bool) -> dict | None:
    """One record; None if it is of a type that holds no page."""
    fields = _fields(member.through(b"\r\n\r\n", HEADER_BYTES))
    length, kind = _number(fields, "content-length"), fields.get("warc-type")
    if length is None or kind is None:
        raise ArchiveError("a record has no content length or no type")
    told_block = _digest(fields, "warc-block-digest")
    told_payload = _digest(fields, "warc-payload-digest")
    is_page, revisit = kind in ("response", "revisit"), kind == "revisit"
    block = hashlib.new(told_block[0]) if told_block else None
    sha1 = hashlib.sha1()
    verified = is_page and not revisit and "warc-segment-number" not in fields
    other = hashlib.new(told_payload[0]) if told_payload and told_payload[0] != "sha1" else None
    size, kept, before, in_payload = 0, [], b"", not _is_http(fields)
    for part in member.exactly(length):
        if block:
            block.update(part)
        if not is_page or revisit:
            continue
        if not in_payload:
            joined = before + part
            _, mark, part = joined.partition(b"\r\n\r\n")
            in_payload, before = bool(mark), joined[-3:]
        if in_payload:
            sha1.update(part)
            size += len(part)
            if other:
                other.update(part)
            if keep_payload:
                kept.append(part)
    if not member.ends_with(b"\r\n\r\n"):
        raise ArchiveError("a record does not end where its content length says")
    if block and told_block[1] != block.digest():
        raise ArchiveError("a block differs from its digest")
    if not is_page:
        return None
    told_size = _number(fields, "x-payload-bytes")
    if verified:
        if told_payload and told_payload[1] != (other or sha1).digest():
            raise ArchiveError("a payload differs from its digest")
        if told_size not in (None, size):
            raise ArchiveError("a payload differs from its length")
    if not revisit:
        digest = base32_sha1(sha1.digest())
    elif told_payload and told_payload[0] == "sha1":
        digest = base32_sha1(told_payload[1])
    else:
        digest = None
    return {
        "page_id": fields.get("x-page-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": told_size if revisit else size,
        "payload_digest": digest,
        "refers_to": fields.get("x-refers-to-page-id"),
        "payload": b"".join(kept) if keep_payload and not revisit else None,
        "record_id": fields.get("warc-record-id"),
        "refers_to_record": fields.get("warc-refers-to"),
    }


def read_records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """The pages of an archive, in order, from a stream of its bytes."""
    source = _Source(stream)
    while chunk := source.take():
        source.give_back(chunk)
        found = _read_record(_Member(source), keep_payload)
        if found is not None:
            yield found


def with_references(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """`(page, url, raw, refers_to)`: `refers_to` is null for pages whose payload comes first.

    Payloads are compared by SHA-256 and length, and only ids and digests of repeated payloads are
    joined, those of very frequent payloads (empty pages) by broadcast; bodies meet the outcome by
    page id, which no group of copies makes large.
    """
    raw = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), raw.alias("raw")
    ).withColumn("digest", F.concat_ws("/", F.sha2("raw", 256), F.octet_length("raw")))
    digests = cut(rows.select("page", "digest"), "warc-digests")
    groups = digests.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    repeated = cut(groups.filter("n > 1 AND first IS NOT NULL"), "warc-repeated")
    revisits = (
        join_spread(digests, repeated, "digest", digests.count(), "n")
        .filter("page > first OR page IS NULL")
        .select("page", "digest", F.col("first").alias("refers_to"))
        .distinct()
    )
    same = rows["digest"] == revisits["digest"]
    found = rows.join(revisits, rows["page"].eqNullSafe(revisits["page"]) & same, "left")
    return found.select(rows["page"], rows["url"], rows["raw"], "refers_to")


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of `with_references` as archives below a shared folder; returns the manifest."""

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        scheme = folder[: len(folder) - len(root)]
        written, out, path, records, size = [], None, "", 0, 0
        for batch in batches:
            for page, url, raw, refers_to in zip(
                *columns_of(batch, "page", "url", "raw", "refers_to")
            ):
                if out is None:
                    path, records, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(path, compression=None)
                member = record(page, url, raw, refers_to)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    written.append((scheme + path, records, size))
                    out = None
        if out is not None:
            out.close()
            written.append((scheme + path, records, size))
        if written:
            yield batch_of(_MANIFEST, zip(*written))

    as_text = rows.select(
        F.col("page").cast("string").alias("page"),
        "url",
        "raw",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    manifest = as_text.mapInArrow(run, "path string, records bigint, bytes bigint")
    return cut(manifest, "warc-manifest")


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """The records of all archives in a manifest, each archive read by one task from end to end."""

    def run(batches):
        for batch in batches:
            for path in columns_of(batch, "path")[0]:
                # Spark lists local files as file:/..., without the empty host.
                files, own = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
                with files.open_input_stream(own, compression=None) as stream:
                    held, size = [], 0
                    for found in read_records(stream, keep_payload):
                        held.append(tuple(found.values()))
                        size += len(found["payload"] or b"")
                        if len(held) == 4096 or size > 32 << 20:
                            yield batch_of(_RECORDS, zip(*held))
                            held, size = [], 0
                    if held:
                        yield batch_of(_RECORDS, zip(*held))

    paths = manifest.select("path")
    tasks = min(MOST_TASKS, max(1, paths.count()))
    return paths.repartition(tasks).mapInArrow(run, _RECORDS_DDL)


def archives_in(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """The archives below a folder as a manifest for `read_archives`; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", pattern).load(folder).select("path")


def archive_round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    keep_payload: bool = False,
) -> DataFrame:
    """Write pages as archives in a fresh shared folder and read them back."""
    kind = pages.schema[id_col].dataType
    folder = scratch_dir(pages.sparkSession, "warc")
    rows = with_references(pages, id_col, url_col, html_col)
    found = read_archives(write_archives(rows, folder, archive_bytes), keep_payload)
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn(
        "refers_to", F.col("refers_to").cast(kind)
    )
