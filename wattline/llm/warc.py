"""WARC archives: writing pages as response and revisit records, and a reader that salvages damaged files.

A record is a column expression; a task compresses each record as a gzip member of its own, and the text sink
writes the members' bytes end to end, on any file system that Spark can write. The sink wants a separator, which is an
empty gzip member. Reading takes each archive file as one row of the ``binaryFile`` source and walks it inside a task.

The reader checks every record: framing, length, the form of its header (see `header_fault`), block digest, payload digest, and for
compressed members the checksum. After a failed check it trusts nothing it has not seen valid: it resumes at the place the length field points to if a valid
record begins there, or else searches for the next gzip member or version line that starts a valid record. The bytes
between are logged as a gap with the reason. Later records are never lost with a damaged one.
A damaged or truncated member is inflated up to its fault; the records before it are kept if they pass their checks, which
in a damaged member (its checksum is of no use) includes a digest, and only the rest is the gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.batches import pieces
from wattline.storage import scratch_path

#: Payloads shorter than this are always stored as responses.
LEAST_REVISIT_BYTES = 100
#: Rows of one archive file; keeps a file small enough to be one row of a scan.
RECORDS_PER_ARCHIVE = 4000
#: Compression level of the members.
LEVEL = 1

_END = "\r\n\r\n"
#: A gzip member without content, which readers pass over.
_EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003") + bytes.fromhex("0300") + bytes(8)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_TRUNCATED = "gzip member truncated"
#: Digests that are checked, and those that are only known by their names.
_ALGORITHMS = ("sha1", "sha256", "md5")
_OTHER_ALGORITHMS = ("sha224", "sha384", "sha512", "sha-1", "sha-256", "sha-384", "sha-512", "blake2b", "blake2s", "blake3", "crc32", "crc32c", "xxh64", "xxh3")
#: Bytes that a faulty member is inflated by.
_STEP = 1 << 12
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
#: A header goes on to an empty line; the next version line ends a header that has none, as does this many bytes.
_HEAD_END = re.compile(rb"\r\n\r\n|\r\n(?=WARC/1\.[01]\r\n)")
_MOST_HEADER = 1 << 20
_NAME = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
_CONTROL = re.compile(rb"[\x00-\x08\x0a-\x1f\x7f]")
_URI = re.compile(r"<[A-Za-z][A-Za-z0-9+.-]*:[^\s<>]+>")
_STAMP = re.compile(r"\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01])(T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?Z)?)?)?")
_MEDIA = re.compile(r"(application|audio|chemical|example|font|image|message|model|multipart|text|video|x-[^/;\s]+)/[^/;\s]+((\s*;\s*[^=;\s]+=(\"[^\"]*\"|[^;\s]+))*)")

# Fixed values of the format: record types, field names, and revisit profiles.
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
FIELDS = (
    "warc-type", "warc-record-id", "warc-date", "content-length", "content-type", "warc-concurrent-to", "warc-block-digest", "warc-payload-digest", "warc-ip-address",
    "warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date", "warc-target-uri", "warc-truncated", "warc-warcinfo-id", "warc-filename", "warc-profile",
    "warc-identified-payload-type", "warc-segment-origin-id", "warc-segment-number", "warc-segment-total-length",
)
PROFILES = tuple(f"http://netpreserve.org/warc/{v}/revisit/{k}" for v in ("1.0", "1.1") for k in ("identical-payload-digest", "server-not-modified"))

_LONGS = {c: "Int64" for c in ("payload_bytes", "inner_offset", "inner_length")}
RECORD_SCHEMA = (
    "archive string, offset long, length long, inner_offset long, inner_length long, kind string, reason string, warc_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


# Writing


def plan_revisits(pages: DataFrame, body: str, key: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Add ``payload_bytes``, ``payload_digest`` and ``owner`` (the id whose record holds an equal long payload).

    One combinable aggregation finds the smallest id of every digest; only digests that occur again meet the pages. A
    digest that many pages share is one row on that side, so adaptive execution can split its pages.
    """
    text = F.coalesce(F.col(body), F.lit("")).cast("binary")
    sized = pages.withColumn("payload_bytes", F.octet_length(text).cast("long")).withColumn("payload_digest", F.sha2(text, 256))
    owners = (
        sized.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("of_digest"))
        .agg(F.min(key).alias("owner"), F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
    )
    return sized.join(owners, F.col("payload_digest") == F.col("of_digest"), "left").drop("of_digest")


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def warc_record(key: Column, uri: Column, body: Column, size: Column, digest: Column, owner: Column) -> Column:
    """A whole record."""
    revisit = owner.isNotNull() & ~key.eqNullSafe(owner)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(_END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.coalesce(body, F.lit(""))))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(key)),
        line("WARC-Date", F.lit(_DATE)),
        line("WARC-Target-URI", F.regexp_replace(uri, r"[\r\n]", "")),
        line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        line("WARC-Refers-To", F.when(revisit, _urn(owner))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
        F.lit(_END),
    )


def write_archives(
    pages: DataFrame, path: str, body: str = "html", key: str = "page_id", uri: str = "url", least: int = LEAST_REVISIT_BYTES,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
) -> None:
    """Write one record per row of ``pages`` below ``path``.

    Null bodies are empty payloads. Of rows with equal payloads of at least ``least`` bytes, those with the smallest key
    become responses and the others revisits of it; rows without a key never own a payload that has another owner. A null address leaves its
    line out. An empty table writes no record.
    """

    def compress(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "value"):
                members = []
                for record in piece.column("value"):
                    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    members.append(engine.compress(record.as_py()) + engine.flush())
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    narrow = pages.select(F.col(key).alias("page_id"), F.col(uri).alias("url"), F.col(body).alias("html"))
    planned = plan_revisits(narrow, "html", "page_id", least)
    record = warc_record(*[F.col(c) for c in ("page_id", "url", "html", "payload_bytes", "payload_digest", "owner")])
    members = planned.select(record.cast("binary").alias("value")).mapInArrow(compress, "value binary")
    writer = members.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", records_per_archive)
    writer.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1")).text(path)


# Reading


def _digest_fits(claim: str | None, data: bytes) -> bool:
    """Whether a labelled digest belongs to ``data``; unknown algorithms and absent claims are no failure."""
    algorithm, colon, value = (claim or "").partition(":")
    if not colon or algorithm.lower() not in _ALGORITHMS:
        return True
    actual = hashlib.new(algorithm.lower(), data)
    return value.lower() == actual.hexdigest() or value.upper().rstrip("=") == base64.b32encode(actual.digest()).decode().rstrip("=")


def _misspelt(name: str, known: tuple[str, ...]) -> bool:
    """Whether one character parts ``name`` from a known one."""
    return name not in known and any(len(k) == len(name) and sum(a != b for a, b in zip(k, name, strict=True)) == 1 for k in known)


def header_fault(header: dict[str, str]) -> str:
    """What is wrong with the form of a header, or ''.

    Digests cover the block alone, so damage of a header shows in its form only: a type that is none, an id that is no URI, a date that is none, a digest
    without algorithm, a content type that does not belong to the record, a field or algorithm that one character parts from a known one. What stays
    undetected is damage that leaves a valid header: other characters in an id, an address or the figures of a date, a version of the other
    number, letters in the other case, and changes in fields that are not known.
    """
    if "warc-type" not in header or "warc-record-id" not in header:
        return "mandatory field missing"
    if any(_misspelt(name, FIELDS) for name in header):
        return "misspelt field"
    if header["warc-type"] not in TYPES:
        return "unknown record type"
    for name in ("warc-record-id", "warc-concurrent-to", "warc-warcinfo-id"):
        if name in header and not _URI.fullmatch(header[name]):
            return "id is no URI"
    refers = header.get("warc-refers-to")
    if refers is not None and not _URI.fullmatch(refers):
        return "id is no URI"
    if "warc-date" in header and not _STAMP.fullmatch(header["warc-date"]):
        return "date is none"
    for name in ("warc-block-digest", "warc-payload-digest"):
        if name in header:
            algorithm, colon, value = header[name].partition(":")
            if not colon or not value or algorithm.lower() not in _ALGORITHMS + _OTHER_ALGORITHMS:
                return "digest is none"
    if header["warc-type"] == "revisit" and _misspelt(header.get("warc-profile", ""), PROFILES):
        return "misspelt profile"
    media = header.get("content-type")
    if media is not None:
        found = _MEDIA.fullmatch(media)
        if not found:
            return "content type is none"
        web = header.get("warc-target-uri", "").lower().startswith(("http:", "https:"))
        if media.split(";")[0].strip().lower() == "application/http":
            message = {"response": "response", "revisit": "response", "request": "request"}.get(header["warc-type"])
            for part in media.split(";")[1:]:
                name, _, value = part.strip().partition("=")
                if name.lower() not in ("msgtype", "version") or (name.lower() == "msgtype" and message and value.strip('"').lower() != message):
                    return "content type is not the record's"
        elif web and header["warc-type"] in ("response", "request") and _misspelt(media.split(";")[0].strip().lower(), ("application/http",)):
            return "content type is not the record's"
    return ""


def parse_record(data: bytes, at: int) -> tuple[int, dict | None, str, bytes, bytes]:
    """The record that starts at ``at``: its end, header, failed check (empty: none), block and payload.

    The end is the place that the length field points to, or -1 without a usable one.
    """
    if not _VERSION.match(data, at):
        return -1, None, "no version line", b"", b""
    found = _HEAD_END.search(data, at + 8, at + _MOST_HEADER)
    if not found or found.group() != b"\r\n\r\n":
        return -1, None, "header without end", b"", b""
    head_end = found.start()
    header = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.fullmatch(name.rstrip(b" \t")):
            return -1, None, "broken header line", b"", b""
        name = name.strip().lower().decode("latin-1")
        # an address is kept as it was crawled
        if _CONTROL.search(value) and name != "warc-target-uri":
            return -1, None, "broken header line", b"", b""
        if name in header and name in FIELDS and name != "warc-concurrent-to":
            # two headers run into one where a record was cut
            return -1, None, "field repeated", b"", b""
        header[name] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch("0|[1-9][0-9]*", header.get("content-length", "")):
        return -1, None, "no content length", b"", b""
    begin, end = head_end + 4, head_end + 4 + int(header["content-length"])
    if end > len(data):
        return -1, None, "truncated block", b"", b""
    stop = end
    if data[end : end + 4] == b"\r\n\r\n":
        stop += 4
    elif end < len(data):
        return -1, None, "record without end", b"", b""
    fault = header_fault(header)
    if fault:
        return stop, None, fault, b"", b""
    block = data[begin:end]
    if not _digest_fits(header.get("warc-block-digest"), block):
        return stop, None, "block digest differs", b"", b""
    http = header.get("content-type", "").startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    if header["warc-type"] != "revisit" and not _digest_fits(header.get("warc-payload-digest"), payload):
        return stop, None, "payload digest differs", b"", b""
    return stop, header, "", block, payload


def _member(data: bytes, at: int) -> tuple[int, bytes | None, str]:
    """The gzip member that starts at ``at``: its end, content, and failed check."""
    engine = zlib.decompressobj(31)
    try:
        content = engine.decompress(memoryview(data)[at:])
    except zlib.error:
        return -1, None, "gzip member damaged"
    if not engine.eof:
        return -1, None, _TRUNCATED
    return len(data) - len(engine.unused_data), content, ""


def _until_fault(data: bytes, at: int) -> bytes:
    """What the faulty gzip member at ``at`` inflates to before its fault."""
    engine, parts = zlib.decompressobj(31), []
    for k in range(at, len(data), _STEP):
        before, rest = engine.copy(), data[k : k + _STEP]
        try:
            parts.append(engine.decompress(rest))
        except zlib.error:
            # once more, a byte at a time on both sides: an error takes the output of its call with it
            try:
                for j in range(len(rest)):
                    one = rest[j : j + 1]
                    while one:
                        parts.append(before.decompress(one, 1))
                        one = before.unconsumed_tail
            except zlib.error:
                pass
            break
    return b"".join(parts)


def _input_for(data: bytes, at: int, size: int) -> int:
    """Where the input ends that the member at ``at`` needs for its first ``size`` bytes; they inflate without a fault."""
    engine = zlib.decompressobj(31)
    for k in range(at, len(data), _STEP):
        before, rest = engine.copy(), data[k : k + _STEP]
        try:
            got = len(engine.decompress(rest, size))
        except zlib.error:
            got = size
        if got < size:
            size -= got
            continue
        for j in range(len(rest)):
            one = rest[j : j + 1]
            while one and size:
                size -= len(before.decompress(one, size))
                one = before.unconsumed_tail
            if not size:
                return k + j + 1
    return len(data)


def _vouched(header: dict) -> bool:
    """Whether a record that passed its checks had a digest to check."""
    claims = [header.get("warc-block-digest")] + [header.get("warc-payload-digest")] * (header["warc-type"] != "revisit")
    return any((c or "").partition(":")[0].lower() in _ALGORITHMS and ":" in c for c in claims if c)


def _before_fault(data: bytes, at: int, reason: str) -> tuple[int, list[tuple]]:
    """Records and gaps of the faulty member at ``at``, up to its last good record, with their places in it; and where the input of that record ends."""
    content, found, good, upto = _until_fault(data, at), [], 0, 0
    for begin, stop, header, why, block, payload in salvage(content):
        if header is not None and reason != _TRUNCATED and not _vouched(header):
            header, why, block, payload = None, "no digest in a damaged member", b"", b""
        if header is not None and reason == _TRUNCATED and stop == len(content):
            break  # the cut may have taken a part of it
        found.append((begin, stop, header, why, block, payload))
        if header is not None:
            good, upto = len(found), stop
    # the last byte of a cut archive stays in the gap, which says that the member is not whole
    return (min(_input_for(data, at, upto), len(data) - 1) if good else at), found[:good]


def _valid_start(data: bytes, at: int) -> bool:
    if data.startswith(b"\x1f\x8b\x08", at):
        _, content, reason = _member(data, at)
        return content is not None or bool(_before_fault(data, at, reason)[1])
    return parse_record(data, at)[1] is not None


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, str, bytes, bytes]]:
    """Walk an archive, whole or per-record compressed: (start, end, header, failed check, block, payload) for every record and gap.

    Inside a compressed member start and end are the member's; `walk` has the places inside it too.
    """
    for start, end, _, header, why, block, payload in walk(data):
        yield start, end, header, why, block, payload


def walk(data: bytes) -> Iterator[tuple[int, int, tuple[int, int] | None, dict | None, str, bytes, bytes]]:
    """As `salvage`, with the place inside a compressed member behind start and end: (begin, stop) of its content, or None.

    The bytes of an archive, or of a member's content, are parted among records and gaps: none lies in two of them.
    """
    at = 0
    while at < len(data):
        if data.startswith(b"\x1f\x8b\x08", at):
            end, content, reason = _member(data, at)
            if content is not None:
                # the content is searched like a plain archive
                for begin, stop, header, why, block, payload in salvage(content):
                    yield at, end, (begin, stop), header, why, block, payload
                at = end
                continue
            stop, kept = _before_fault(data, at, reason)
            for begin, inner_stop, header, why, block, payload in kept:
                yield at, stop, (begin, inner_stop), header, why, block, payload
            at = stop
        else:
            end, header, reason, block, payload = parse_record(data, at)
            if header is not None:
                yield at, end, None, header, "", block, payload
                at = end
                continue
        start = at
        if end > at and (end == len(data) or _valid_start(data, end)):
            at = end
        else:
            at = len(data)
            for found in _START.finditer(data, start + 1):
                if _valid_start(data, found.start()):
                    at = found.start()
                    break
        yield start, at, None, None, reason, b"", b""


def _http_length(block: bytes) -> int | None:
    found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", block.partition(b"\r\n\r\n")[0])
    return int(found[1]) if found else None


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records and gaps below ``path``.

    ``kind`` is ``record`` or ``gap``; a gap has only archive, its place and reason. ``offset`` and ``length`` are those of the gzip member if it is in one, and
    ``inner_offset`` and ``inner_length`` its place in the member's content (else null). Digest and size of a response are those of
    the payload that was read; those of a revisit come from its own headers. ``payload`` is null when not asked for. An
    empty file has neither. One archive is the unit of work: files above 2 GB are beyond a row of Spark.
    """

    def read(frames):
        import pandas as pd

        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                rows = []
                for start, end, inner, header, reason, block, body in walk(bytes(content)):
                    place = archive, start, end - start, *((inner[0], inner[1] - inner[0]) if inner else (None, None))
                    if header is None:
                        rows.append((*place, "gap", reason, *[None] * 7))
                        continue
                    kind = header["warc-type"]
                    again = kind == "revisit"
                    digest = (header.get("warc-payload-digest") or ":").partition(":")[2] if again else hashlib.sha256(body).hexdigest()
                    size = _http_length(block) if again else len(body)
                    rows.append(
                        (*place, "record", None, kind, header["warc-record-id"], header.get("warc-target-uri"),
                         header.get("warc-refers-to"), digest, size, body if payload else None)
                    )
                    if len(rows) >= 500:
                        yield pd.DataFrame(rows, columns=names).astype(_LONGS)
                        rows = []
                yield pd.DataFrame(rows, columns=names).astype(_LONGS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(read, RECORD_SCHEMA)


def page_id(urn: Column) -> Column:
    """The page id of a record id written by this module; null when it has none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: one row per page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    records = read_archives(spark, path, payload=False).where(F.col("kind") == "record")
    return records.select(
        page_id(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page_id(F.col("refers_to")).alias("refers_to"),
    )
