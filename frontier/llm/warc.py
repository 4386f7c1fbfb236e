r"""WARC derivatives: metadata and plain-text conversion records of response records.

Input is one row per WARC record with its bytes (named header fields, an empty line, the
block). Every ``response`` record gives two records that name it in ``WARC-Refers-To`` and
carry its target URI, date and payload digest:

* ``metadata`` (``application/warc-fields``): HTTP status, every source header of the WARC
  record and of the HTTP message, whether length and digests of the source agree with its
  bytes, charset, title, outlinks, and the id of the conversion record;
* ``conversion`` (``text/plain``): the text of the page, one line a block, scripts, styles
  and markup left out. In WARC form the metadata record names it in ``WARC-Concurrent-To``.

New record ids are name-based UUIDs of the source id and the kind of record, so a task that
runs again writes the same records. Work is by row; there is no shuffle.

Defined results: null and empty rows, and records of other types, give nothing. A record
without an id, without the empty line, or whose block is no HTTP message gives a metadata
record with an ``error`` field and no conversion record. A payload that is not text (by its
content type) gives a metadata record only. Bytes that don't decode become U+FFFD. Content
codings are undone from the last to the first, gzip with all its members; a stream that is cut,
and a coding that can't be undone (``br`` and others), give an ``error`` field and no conversion
record. Text that isn't HTML or XML is taken as it is. Repeated rows give repeated records, with
equal ids.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .blocks import read

SCHEMA = ("refers_to string, warc_type string, record_id string, target_uri string, warc_date string, content_type string, "
          "content_length bigint, block_digest string, payload_digest string, digest_ok boolean, block string")
#: Largest decoded payload of a compressed message, as a multiple of its bytes and a floor.
MAX_RATIO, MIN_DECODED = 1000, 64 << 20

_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
_META_CHARSET = re.compile(rb"<meta[^>]{0,512}?charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
_TITLE = re.compile(r"<title(?=[\s>])[^>]*>([^<]*)", re.I)
_LINK = re.compile(r"<a\s(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>", re.I)
_HREF = re.compile(r"(?<![\w-])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_BLANK = re.compile(r"\s+")


class Malformed(ValueError):
    """A record that isn't a WARC record with an HTTP message."""


def fields(head: bytes) -> list[tuple[str, str]]:
    """Named fields of a header, in order; a line that begins with white space goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def split_head(data: bytes) -> tuple[bytes, bytes, bytes]:
    """First line, other header lines, and what follows the empty line."""
    m = re.search(rb"\r?\n\r?\n", data)
    if m is None:
        raise Malformed("no empty line after the header")
    first, _, rest = data[:m.start()].partition(b"\n")
    return first.rstrip(b"\r"), rest, data[m.end():]


def get(named: list[tuple[str, str]], name: str) -> str | None:
    return next((v for n, v in named if n.lower() == name.lower()), None)


def digest_agrees(stated: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest (``sha1:BASE32``, ``sha256:hex`` and the like) is that of the
    bytes; null without one or for an unknown algorithm."""
    if not stated or ":" not in stated:
        return None
    kind, _, value = stated.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return None
    made = hashlib.new(kind, data)
    return value.lower() == made.hexdigest() or value.upper().rstrip("=") == base64.b32encode(made.digest()).decode().rstrip("=")


def payload(http: list[tuple[str, str]], body: bytes) -> bytes:
    """The entity of an HTTP message: chunks joined, gzip and deflate undone."""
    if "chunked" in (get(http, "Transfer-Encoding") or "").lower():
        out, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0:
            try:
                size = int(body[at:end].split(b";")[0], 16)
            except ValueError:
                break
            if size == 0:
                break
            out.append(body[end + 2:end + 2 + size])
            at = end + 2 + size + 2
        body = b"".join(out) if out else body
    most = max(MIN_DECODED, MAX_RATIO * len(body))
    codings = [c.strip().lower() for n, v in http if n.lower() == "content-encoding" for c in v.split(",")]
    for coding in reversed(codings):
        if coding in ("", "identity") or not body:
            continue
        if coding not in ("gzip", "x-gzip", "deflate"):
            raise Malformed(f"the payload has the coding {coding}")
        try:
            body = _inflate(body, 31 if coding != "deflate" else 15, most)
        except zlib.error as e:
            if coding != "deflate":
                raise Malformed("the payload doesn't decompress") from e
            try:   # many servers send the bare stream
                body = _inflate(body, -15, most)
            except zlib.error:
                raise Malformed("the payload doesn't decompress") from e
    return body


def _inflate(data: bytes, form: int, most: int) -> bytes:
    """A whole stream, of gzip all members; what follows the last one is no part of it."""
    out, left = [], most
    while True:
        undo = zlib.decompressobj(form)
        out.append(undo.decompress(data, left + 1))
        left -= len(out[-1])
        if left < 0:
            raise Malformed("the payload expands beyond all measure")
        if not undo.eof:
            raise Malformed("the payload is cut")
        data = undo.unused_data
        if form != 31 or not data.startswith(b"\x1f\x8b"):
            return b"".join(out)


def _decode(data: bytes, http: list[tuple[str, str]]) -> tuple[str, str]:
    """Text and the name of its charset: by the HTTP header, else by the page, else UTF-8."""
    m = _CHARSET.search(get(http, "Content-Type") or "")
    name = m[1] if m else None
    if name is None and (b := _META_CHARSET.search(data, 0, 4096)):
        name = b[1].decode("ascii")
    try:
        return data.decode(name or "utf-8", "replace"), (name or "utf-8").lower()
    except LookupError:
        return data.decode("utf-8", "replace"), "utf-8"


def _one_line(text: str) -> str:
    return _BLANK.sub(" ", text).strip()


def new_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"


def derive(record: bytes | None) -> list[dict]:
    """The derived records of one record, as rows of :data:`SCHEMA`."""
    if not record:
        return []
    warc: list[tuple[str, str]] = []
    out: list[tuple[str, str]] = []
    text: str | None = None
    agrees: list[bool] = []
    try:
        version, head, block = split_head(record)
        if not version.startswith(b"WARC/"):
            raise Malformed("no WARC version line")
        warc = fields(head)
        if (get(warc, "WARC-Type") or "").lower() != "response":
            return []
        if not get(warc, "WARC-Record-ID"):
            raise Malformed("no record id")
        stated = get(warc, "Content-Length")
        if stated is not None and stated.isdigit():
            out.append(("length-ok", str(len(block) >= int(stated)).lower()))
            block = block[:int(stated)]
        status, http_head, body = split_head(block)
        if not status.startswith(b"HTTP/"):
            raise Malformed("the block is no HTTP message")
        http = fields(http_head)
        code = status.split(b" ")
        out.append(("status", code[1].decode("ascii", "replace") if len(code) > 1 else ""))
        for name, data in (("WARC-Block-Digest", block), ("WARC-Payload-Digest", body)):
            ok = digest_agrees(get(warc, name), data)
            if ok is not None:
                agrees.append(ok)
                out.append((f"{name.lower()}-ok", str(ok).lower()))
        out += [(f"warc-header-{n.lower()}", v) for n, v in warc] + [(f"http-header-{n.lower()}", v) for n, v in http]
        kind = (get(http, "Content-Type") or "text/html").partition(";")[0].strip().lower()
        data = payload(http, body)
        if kind.startswith("text/") or kind in ("application/xhtml+xml", "application/xml"):
            decoded, charset = _decode(data, http)
            out.append(("charset", charset))
            if kind not in ("text/html", "text/xml", "application/xhtml+xml", "application/xml"):
                text = decoded
            else:
                title = _TITLE.search(decoded)
                if title:
                    out.append(("title", _one_line(html.unescape(title[1]))))
                base = get(warc, "WARC-Target-URI") or ""
                out += [("outlink", link) for link in dict.fromkeys(_links(decoded, base))]
                text = "\n".join(b.text for b in read(decoded))
    except Malformed as e:
        out.append(("error", str(e)))
        text = None
    source = get(warc, "WARC-Record-ID") or f"sha256:{hashlib.sha256(record).hexdigest()}"
    about = {"refers_to": source, "target_uri": get(warc, "WARC-Target-URI"), "warc_date": get(warc, "WARC-Date"),
             "payload_digest": get(warc, "WARC-Payload-Digest"), "digest_ok": all(agrees) if agrees else None}
    metadata, conversion = new_id(source, "metadata"), new_id(source, "conversion")
    if text is not None:
        out.append(("conversion", conversion))
    rows = [about | _record("metadata", metadata, "application/warc-fields", "".join(f"{n}: {_one_line(v)}\r\n" for n, v in out))]
    if text is not None:
        rows.append(about | _record("conversion", conversion, "text/plain; charset=UTF-8", text))
    return rows


def _links(text: str, base: str):
    for tag in _LINK.findall(text):
        m = _HREF.search(tag)
        if m:
            try:
                link = urljoin(base, html.unescape(m[1] or m[2] or m[3] or "").strip())
            except ValueError:
                continue
            if link.startswith(("http://", "https://")):
                yield _BLANK.sub("%20", link)


def _record(kind: str, record_id: str, content_type: str, block: str) -> dict:
    data = block.encode("utf-8", "replace")
    return {"warc_type": kind, "record_id": record_id, "content_type": content_type, "content_length": len(data),
            "block_digest": f"sha256:{hashlib.sha256(data).hexdigest()}", "block": data.decode()}


_ARROW = pa.schema([
    ("refers_to", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
    ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()), ("payload_digest", pa.string()),
    ("digest_ok", pa.bool_()), ("block", pa.string())])


def derivatives(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Metadata and conversion records (:data:`SCHEMA`) of all response records."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = [r for one in batch.column(0).slice(lo, 256) for r in derive(one.as_py())]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    K.bounded_batches(records.sparkSession)
    return records.select(record_col).mapInArrow(run, SCHEMA)


def as_text(derived: DataFrame) -> DataFrame:
    """The records in WARC/1.0 form, one string a row, for :func:`write`."""
    field = lambda name, col: F.when(F.col(col).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(col).cast("string"), F.lit("\r\n"))).otherwise("")
    other = F.regexp_extract("block", r"(?m)^conversion: (\S+)", 1)
    return derived.select(F.concat(
        F.lit("WARC/1.0\r\n"), field("WARC-Type", "warc_type"), field("WARC-Record-ID", "record_id"), field("WARC-Refers-To", "refers_to"),
        field("WARC-Target-URI", "target_uri"), field("WARC-Date", "warc_date"), field("WARC-Block-Digest", "block_digest"),
        F.when((F.col("warc_type") == "metadata") & (other != ""), F.concat(F.lit("WARC-Concurrent-To: "), other, F.lit("\r\n"))).otherwise(""),
        field("Content-Type", "content_type"), field("Content-Length", "content_length"), F.lit("\r\n"), F.col("block")).alias("value"))


def write(derived: DataFrame, path: str) -> None:
    """WARC files (one a partition) with Spark's text writer: every record ends with two line ends."""
    as_text(derived).write.option("lineSep", "\r\n\r\n").mode("overwrite").text(path)


def responses(pages: DataFrame) -> DataFrame:
    """Stand-in input of the registered query: a crawler's response records of a pages table
    (``page_id``, ``url``, ``html``). Only gives bytes in the form the job reads."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nServer: example\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    digest = lambda data: F.concat(F.lit("sha256:"), F.sha2(data, 256))
    key = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url").cast("binary"))
    uid = F.concat_ws("-", F.substring(key, 1, 8), F.substring(key, 9, 4), F.substring(key, 13, 4), F.substring(key, 17, 4), F.substring(key, 21, 12))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"), uid, F.lit(">\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Payload-Digest: "), digest(body), F.lit("\r\nWARC-Block-Digest: "), digest(F.concat(http, body)),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(F.concat(http, body)).cast("string"),
        F.lit("\r\n\r\n")).cast("binary")
    return pages.select(F.concat(head, http, body, F.lit("\r\n\r\n").cast("binary")).alias("record"))
