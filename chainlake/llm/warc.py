"""WARC derivatives: metadata and plain-text conversion records of response records.

A derived record names its source in WARC-Refers-To, repeats its target, date and payload digest, and has a digest of its
own block. Files are written as gzip, one member a record, so that any record can be read alone; files of many records in a member, or not
compressed at all, are read as well. Bodies are decoded as their HTTP headers say before text is taken from them.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import arrow_step, saved, tuned, values
from chainlake.session import work_folder
from chainlake.sources.store import open_store

VERSION = "WARC/1.1"
LEVEL = 1
# Compressed bytes read at a time, and records handed on at a time.
CHUNK = 1 << 20
RECORDS = 100
# Date of records made from tables that have none.
NO_DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "block_digest string, payload_digest string, source_headers string, block binary"
)
NAMES = tuple(f.split()[0] for f in RECORD.split(", "))

# Within a tag: a quote opens a value only after an equals sign, and no choice is taken back, so that long pages take linear time.
_INSIDE = r"""(?>=\s*(?:"[^"]*"|'[^']*')|[^>])*+"""
_BREAK = re.compile(r"<(?:/?(?:p|div|article|section|h[1-6]|li|ul|ol|tr|table|header|footer|nav|aside|blockquote|pre|title)\b|br\b)" + _INSIDE + ">", re.I)
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_TAG = re.compile("<[a-zA-Z/!?]" + _INSIDE + ">")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.I | re.S)
_LINK = re.compile(r"""<(a|img|link|script|iframe|form)\b[^>]*?\s(href|src|action)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", re.I)
_CHARSET = re.compile(r"""charset=["']?([A-Za-z0-9_.:-]+)""", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def named_id(*parts: str | None) -> str:
    """A record id that follows from what it names, so that a repeated run gives the same."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(p or '' for p in parts).encode()).digest())}>"


# ======== records as bytes ========


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def header_of(record: dict) -> str:
    """The header lines of a record. Lines of `source_headers` that name none of its own fields follow."""
    fields = [
        ("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]),
        ("WARC-Refers-To", record["refers_to"]), ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["warc_date"]),
        ("WARC-Block-Digest", record["block_digest"]), ("WARC-Payload-Digest", record["payload_digest"]),
        ("Content-Type", record["content_type"]), ("Content-Length", str(len(record["block"] or b""))),
    ]
    lines = [f"{k}: {_clean(v)}" for k, v in fields if v is not None]
    own = {k.lower() for k, _ in fields}
    for line in (record["source_headers"] or "").split("\r\n"):
        if line and line.partition(":")[0].strip().lower() not in own:
            lines.append(_clean(line))
    return "\r\n".join([VERSION, *lines]) + "\r\n\r\n"


def as_member(record: dict) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(header_of(record).encode() + (record["block"] or b"") + b"\r\n\r\n") + packer.flush()


def parsed(raw: bytes) -> dict | None:
    """A record of its bytes; None for what is no WARC record. Header names match in any case."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        return None
    found, kept = {}, []
    for line in lines[1:]:
        if line[:1] in " \t" and kept:  # a folded line continues the one above
            kept[-1] += " " + line.strip()
        else:
            kept.append(line)
    for line in kept:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    length = found.get("content-length", "")
    block = rest[: int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    own = {n: found.get(f"warc-{n.replace('_', '-')}") for n in ("target_uri", "block_digest", "payload_digest", "refers_to")}
    return {
        "warc_type": found.get("warc-type"), "record_id": found.get("warc-record-id"), "warc_date": found.get("warc-date"),
        **{**own, "target_uri": found.get("warc-target-uri")}, "content_type": found.get("content-type"),
        "source_headers": "\r\n".join(kept), "block": block,
    }


def unpacked(source) -> Iterator[bytes]:
    """The contents of a file in pieces: of one gzip member after another, or as they are. A member cut short raises an error."""
    rest = source.read(CHUNK)
    if rest[:2] != b"\x1f\x8b":
        while rest:
            yield rest
            rest = source.read(CHUNK)
        return
    unpacker, begun = zlib.decompressobj(31), False
    while rest:
        # Bounded, however well a member is compressed.
        yield unpacker.decompress(rest, CHUNK)
        begun, rest = True, unpacker.unconsumed_tail
        if unpacker.eof:
            rest, begun = unpacker.unused_data, False
            unpacker = zlib.decompressobj(31)
        rest = rest or source.read(CHUNK)
    if begun:
        tail = unpacker.flush()
        if not unpacker.eof:
            raise ValueError("the archive ends within a record")
        yield tail


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a file's contents, header and block, by their Content-Length; at most one is held. What lies between is left out.

    A record without a length lasts until the next begins; one that is cut short raises an error."""
    held, ended = bytearray(), False

    def more() -> bool:
        nonlocal ended
        piece = b"" if ended else next(pieces, None)
        ended = piece is None or ended
        held.extend(piece or b"")
        return not ended

    while True:
        start = held.find(b"WARC/")
        while start < 0:
            del held[: max(0, len(held) - 4)]
            if not more():
                return
            start = held.find(b"WARC/")
        del held[:start]
        while (at := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if at < 0:
            return
        told = _LENGTH.search(held[: at + 2])
        if told:
            size = at + 4 + int(told[1])
            while len(held) < size:
                if not more():
                    raise ValueError("the archive ends within a record")
        else:
            while (size := held.find(b"\r\n\r\nWARC/", at)) < 0 and more():
                pass
            size = len(held) if size < 0 else size + 4
        yield bytes(held[:size])
        del held[:size]


# ======== folders of files ========


def write_warc(records: DataFrame) -> DataFrame:
    """Write records to one file for each task; (path, n_records) of each file."""
    folder = work_folder(records.sparkSession, "warc")

    def step(batches):
        store, root = open_store(folder)
        store.create_dir(root)
        private, path = f"{root}/.{uuid.uuid4().hex}", f"/part-{TaskContext.get().partitionId():07d}.warc.gz"
        n = 0
        with store.open_output_stream(private) as target:
            for batch in batches:
                for record in batch.to_pylist():
                    target.write(as_member(record))
                    n += 1
        if n:
            store.move(private, root + path)
            yield {"path": [path], "n_records": [n]}
        else:
            store.delete_file(private)

    files = saved(arrow_step(records.select(*NAMES), step, "path string, n_records long"), "warc-files")
    return files.select(F.concat(F.lit(folder), "path").alias("path"), "n_records")


def read_warc(files: DataFrame) -> DataFrame:
    """The records of the files that column `path` names; a file is read by one task, record by record.

    What is no WARC record is left out; a file cut within a record raises an error.
    """
    tuned(files.sparkSession)

    def step(batches):
        for batch in batches:
            for path in values(batch, "path"):
                store, inner = open_store(path)
                held = []
                with store.open_input_stream(inner, compression=None) as source:
                    for raw in split_records(unpacked(source)):
                        record = parsed(raw)
                        if record:
                            held.append(record)
                        if len(held) >= RECORDS:
                            yield {n: [r[n] for r in held] for n in NAMES}
                            held = []
                yield {n: [r[n] for r in held] for n in NAMES}

    return arrow_step(files.select("path").repartition(max(1, files.count()), "path"), step, RECORD)


# ======== derivation ========


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """(status line, headers in lower case, body) of an HTTP response; a block without a status line is all body."""
    if not block.startswith(b"HTTP/"):
        return "", {}, block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("iso-8859-1").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), value.strip())
    return lines[0], headers, body


def unchunked(body: bytes) -> bytes:
    """The data of a chunked body; from where its sizes make no sense on, the rest as it is."""
    parts, at = [], 0
    while at < len(body):
        line, mark, _ = body[at : at + 1000].partition(b"\r\n")
        try:
            size = int(line.partition(b";")[0], 16) if mark else -1
        except ValueError:
            size = -1
        if size < 0:
            return body if not at else b"".join(parts) + body[at:]
        if not size:
            break
        at += len(line) + 2
        parts.append(body[at : at + size])
        at += size + 2
    return b"".join(parts)


def content_of(headers: dict[str, str], body: bytes) -> tuple[bytes, str | None]:
    """(a body's content, the encoding that could not be taken off or null): chunks are joined, gzip and deflate undone."""
    if "chunked" in headers.get("transfer-encoding", "").lower():
        body = unchunked(body)
    for name in reversed([n.strip().lower() for n in headers.get("content-encoding", "").split(",") if n.strip()]):
        if name == "identity":
            continue
        for bits in {"gzip": (47,), "x-gzip": (47,), "deflate": (15, -15)}.get(name, ()):
            unpacker = zlib.decompressobj(bits)
            try:
                body = unpacker.decompress(body) + unpacker.flush()
                break
            except zlib.error:
                continue
        else:
            return body, name
    return body, None


def decoded(body: bytes, content_type: str) -> str:
    """The body as text, by the header's charset, else the page's own, else UTF-8; wrong bytes are replaced."""
    told = _CHARSET.search(content_type) or _CHARSET.search(body[:1024].decode("ascii", "replace"))
    try:
        return body.decode(told[1] if told else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(page: str) -> str:
    """A page's visible text, a line for each block, without blank lines."""
    body = _BREAK.sub("\n", _HIDDEN.sub("", page).replace("\r", " ").replace("\n", " "))
    text = html.unescape(_TAG.sub("", body))
    return "\n".join(t for t in (" ".join(line.split()) for line in text.split("\n")) if t)


def metadata_of(source: dict, status: str, headers: dict[str, str], page: str | None, body: bytes, encoding: str | None = None) -> str:
    """What the metadata record says, as JSON with sorted names; the encoding of a body that could not be decoded."""
    told = {
        "source-record": source["record_id"], "source-headers": source["source_headers"], "status": status, "http-headers": headers,
        "payload-length": len(body), "payload-digest": digest(body),
    }
    if encoding is not None:
        told["not-decoded"] = encoding
    if page is not None:
        seen = _HIDDEN.sub("", page)
        title = _TITLE.search(seen)
        metas = [dict((k.lower(), html.unescape(a or b or c)) for k, a, b, c in _ATTRIBUTE.findall(m)) for m in _META.findall(seen)]
        links = [
            {"element": e.lower(), "attribute": k.lower(), "url": html.unescape(a or b or c)} for e, k, a, b, c in _LINK.findall(page)
        ]
        told |= {"title": " ".join(html.unescape(title[1]).split()) if title else None, "metas": metas, "links": links}
    return json.dumps(told, ensure_ascii=False, sort_keys=True)


def derived(source: dict) -> list[dict]:
    """The metadata record of a response, and its conversion where its payload is text."""
    status, headers, body = split_http(source["block"] or b"")
    kind = headers.get("content-type", "text/html" if not status else "")
    marked = "html" in kind.lower()
    content, encoding = content_of(headers, body)
    page = decoded(content, kind) if encoding is None and (marked or kind.lower().startswith("text/")) else None
    common = {
        "refers_to": source["record_id"], "target_uri": source["target_uri"], "warc_date": source["warc_date"],
        "payload_digest": source["payload_digest"] or digest(body),
        # Lines that name none of the derived record's own fields are written with it.
        "source_headers": source["source_headers"],
    }
    told = metadata_of(source, status, headers, page if marked else None, body, encoding).encode()
    out = [{"warc_type": "metadata", "content_type": "application/json", "block": told, **common}]
    if page is not None:
        text = (plain_text(page) if marked else page).encode()
        out.append({"warc_type": "conversion", "content_type": "text/plain", "block": text, **common})
    for record in out:
        record["record_id"] = named_id(record["warc_type"], source["record_id"], source["target_uri"])
        record["block_digest"] = digest(record["block"])
    return out


def derive(records: DataFrame) -> DataFrame:
    """Derived records of all response records in `records`, in WARC columns; others are passed over.

    Every response yields a metadata record, and a conversion record if its payload is text; a null block counts as empty.
    Missing headers stay missing, a missing payload digest is computed. Repeated responses yield repeated records. Columns
    beside those of WARC records are not read; no records, no rows.
    """
    tuned(records.sparkSession)

    def step(batches):
        for batch in batches:
            made = [d for r in batch.to_pylist() for d in derived(r)]
            yield {n: [r[n] for r in made] for n in NAMES}

    return arrow_step(records.where("lower(warc_type) = 'response'").select(*NAMES), step, RECORD)


def responses(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Pages as the response records a crawler would have written. Null pages are empty ones, null URLs none."""
    tuned(pages.sparkSession)

    def step(batches):
        for batch in batches:
            made = []
            for key, url, page in zip(values(batch, "page"), values(batch, "url"), values(batch, "html")):
                body = (page or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                made.append({
                    "warc_type": "response", "record_id": named_id("response", str(key), url), "refers_to": None, "target_uri": url,
                    "warc_date": NO_DATE, "content_type": "application/http; msgtype=response", "block_digest": digest(head + body),
                    "payload_digest": digest(body), "source_headers": f"X-Page-ID: {key}" if key is not None else None, "block": head + body,
                })
            yield {n: [r[n] for r in made] for n in NAMES}

    source = pages.select(
        F.col(id_column).cast("long").alias("page"), F.col(url_column).cast("string").alias("url"),
        F.col(html_column).cast("string").alias("html"),
    )
    return arrow_step(source, step, RECORD)


def warc_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the WARC files below a folder, listed by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{,.gz}").option("recursiveFileLookup", "true").load(folder)
    return files.select("path")
