"""WARC: archives of request, response or revisit, and metadata records, and their assembly into captures."""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orogrid.llm._shared import Scratch

_END = "\r\n\r\n"
#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"


def _header(*lines: Column | str) -> Column:
    return F.concat(*[F.concat(F.lit(x) if isinstance(x, str) else x, F.lit("\r\n")) for x in lines], F.lit("\r\n"))


def _field(name: str, value: Column) -> Column:
    """A header line; control characters of the value are percent-encoded, as they would end the line. Null: an empty value."""
    value = F.coalesce(value, F.lit(""))
    for c in ("\r", "\n"):
        value = F.replace(value, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = LEAST_REVISIT) -> None:
    """Writes a transaction of three records for every row as WARC files under path, gzipped, one for each partition.

    Of rows with equal payloads of at least `least` bytes, those with the largest id become
    responses, the others revisits without a payload, which refer to the record of a response; equality
    is that of SHA-1 and length. A null payload is empty, a null URL an empty header and a request for
    /. Rows with a null id are responses. Repeated rows are written as often as they occur, with the
    same record ids.
    """
    page = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("body"))
    page = page.withColumn("digest", F.sha1(F.col("body").cast("binary"))).withColumn("bytes", F.octet_length("body").cast("long"))
    # a capture is named by its id and, since ids may repeat, by its url and payload
    name = F.concat_ws("-", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.hex(F.xxhash64("url", "digest")))
    groups = page.where(F.col("bytes") >= least).select("digest", "bytes", F.when(F.col("id").isNotNull(), F.struct("id", name.alias("name"))).alias("one"))
    groups = groups.groupBy("digest", "bytes").agg(F.max("one").alias("one"), F.count("*").alias("n")).where("n > 1").select("digest", "bytes", F.col("one.id").alias("whole"), F.col("one.name").alias("whole_name"))
    scratch = Scratch(pages.sparkSession)
    groups = scratch.keep(groups, "groups")
    page = page.join(groups, ["digest", "bytes"], "left")
    again = F.coalesce(F.col("whole") != F.col("id"), F.lit(False))
    urn = lambda kind, x: F.concat(F.lit(f"<urn:capture:{kind}:"), x, F.lit(">"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    head = F.concat(http, F.col("bytes").cast("string"), F.lit(_END))
    block = F.concat(head, F.when(again, F.lit("")).otherwise(F.col("body")))
    common = lambda kind, record: ["WARC/1.1", f"WARC-Type: {kind}" if isinstance(kind, str) else kind, _field("WARC-Record-ID", record), f"WARC-Date: {DATE}", _field("WARC-Target-URI", F.col("url"))]
    record = lambda lines, content: F.concat(_header(*lines, F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string"))), content)
    response = record(
        [
            *common(F.when(again, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")), urn("response", name)),
            _field("WARC-Payload-Digest", digest),
            F.concat(F.when(again, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn("response", F.col("whole_name")), F.lit("\r\n"))).otherwise(""), F.lit("Content-Type: application/http; msgtype=response")),
        ],
        block,
    )
    url = F.translate(F.coalesce("url", F.lit("")), "\r\n ", "+++")
    host, target = F.regexp_extract(url, r"^[^/?#]*://([^/?#]*)", 1), F.regexp_extract(url, r"^[^/?#]*://[^/?#]*([^#]*)", 1)
    target = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target))
    ask = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(_END))
    request = record([*common("request", urn("request", name)), _field("WARC-Concurrent-To", urn("response", name)), "Content-Type: application/http; msgtype=request"], ask)
    meta = F.concat(F.lit("capture: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\nlength: "), F.col("bytes").cast("string"), F.lit("\r\n"))
    metadata = record([*common("metadata", urn("metadata", name)), _field("WARC-Concurrent-To", urn("response", name)), "Content-Type: application/warc-fields"], meta)
    info = F.concat(request, F.lit(_END), response, F.lit(_END), metadata).alias("value")
    page.select(info).write.mode("overwrite").option("lineSep", _END).option("compression", "gzip").text(path)
    scratch.drop("groups")


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$")
_FIELDS = ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "date", "digest")
_NAMES = (b"warc-type", b"warc-record-id", b"warc-concurrent-to", b"warc-refers-to", b"warc-target-uri", b"warc-date", b"warc-payload-digest")
SCHEMA = ", ".join(f"{f} string" for f in _FIELDS) + ", http_head binary, payload binary, payload_bytes long, payload_digest string"


def _digest(value: str | None) -> str | None:
    """SHA-1 in hex from a header's value in hex or base 32, without its name."""
    if not value:
        return None
    text = value.partition(":")[2] or value
    return base64.b32decode(text).hex() if len(text) == 32 else text.lower()


def _records(with_payload: bool):
    import hashlib

    def build(head: bytes, content: bytes):
        fields = {}
        for line in head.split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            fields.setdefault(key.strip().lower(), value.strip().decode("utf-8", "replace"))
        values = [fields.get(n) or None for n in _NAMES]
        values[-1] = _digest(values[-1])
        http, payload = (b"", content)
        if values[0] in ("response", "revisit", "request") and b"\r\n\r\n" in content:
            http, _, payload = content.partition(b"\r\n\r\n")
        whole = values[0] in ("response", "metadata")
        return (*values, http, payload if with_payload or values[0] == "metadata" else None, len(payload) if whole else None, hashlib.sha1(payload).hexdigest() if whole else None)

    def run(batches):
        names = [*_FIELDS, "http_head", "payload", "payload_bytes", "payload_digest"]
        types = [pa.string()] * len(_FIELDS) + [pa.binary(), pa.binary(), pa.int64(), pa.string()]
        file, parts, need, out, size = None, [], None, [], 0

        def pack():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        # pieces between CRLFCRLF arrive in order: first a head, then pieces until its length is full
        for batch in batches:
            for path, piece, part in zip(*(batch.column(c).to_pylist() for c in ("path", "piece", "part")), strict=True):
                if part:
                    raise ValueError(f"{path} is split between tasks: gzip it, or set spark.sql.files.maxPartitionBytes above its size")
                if path != file:
                    if need is not None:
                        raise ValueError(f"{file} ends within a record")
                    file, parts, need = path, [], None
                if need is None:
                    piece = piece.lstrip(b"\r\n") if not piece.startswith(b"WARC/") else piece
                    if not piece.startswith(b"WARC/"):
                        continue
                    found = _LENGTH.search(piece)
                    if not found:
                        raise ValueError(f"{file} has a record without its length, or ends within a record")
                    head, need, have = piece, int(found[1]), -4
                    if need == 0:
                        out.append(build(head, b""))
                        need = None
                    continue
                parts.append(piece)
                have += len(piece) + 4
                if have + 4 >= need:  # the content ends before this separator or within it
                    content = b"\r\n\r\n".join(parts) + b"\r\n\r\n"[: need - have]
                    out.append(build(head, content))
                    size += len(content)
                    parts, need = [], None
                if size > 1 << 23 or len(out) >= 5000:
                    yield pack()
                    out, size = [], 0
        if need is not None:
            raise ValueError(f"{file} ends within a record")
        if out:
            yield pack()

    return run


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of the WARC files under path: headers, HTTP head, payload (payload=False: only that of metadata), its length and SHA-1.

    Files stream through any store that Spark reads, one record in memory at a time; contents are
    delimited by their length only, so they may hold anything. A file is read by one task, as only its
    start tells where records begin: a file that Spark would split (not compressed, and longer than a
    partition) and one that ends within a record raise an error.
    """
    meta = F.col("_metadata")
    part = ~meta["file_path"].rlike(r"\.(gz|bz2)$") & (meta["file_block_length"] < meta["file_size"])
    pieces = spark.read.option("lineSep", _END).text(path).select(meta["file_path"].alias("path"), F.col("value").cast("binary").alias("piece"), part.alias("part"))
    return pieces.mapInArrow(_records(payload), SCHEMA)


def _told(records: DataFrame, kind: str) -> DataFrame:
    part = records.where(F.col("type") == kind).where("concurrent_to is not null").groupBy(F.col("concurrent_to").alias("record_id"))
    return part.agg(F.min(F.struct("http_head", "payload", F.col("record_id").alias("id"))).alias(kind))


def assemble(records: DataFrame) -> DataFrame:
    """One row for each response or revisit: its record's columns, request and metadata as structs.

    Requests and metadata are joined by their concurrent-to id; of several for one capture the least
    by content is taken, so repeated captures stay as many as their responses. A capture without one
    of them has null there; requests and metadata without a capture are left out.
    """
    main = records.where("type in ('response', 'revisit')").drop("concurrent_to")
    for kind in ("request", "metadata"):
        main = main.join(_told(records, kind), "record_id", "left")
    return main


def captures(pages: DataFrame, path: str | None = None, payload: bool = False, **names) -> DataFrame:
    """Writes pages as archives, reads them back and returns (capture, payload_bytes, payload_digest, record_type, refers_to, ...).

    Length and digest of a response are those of the payload read; a revisit has those that its
    metadata record and digest header tell. capture and refers_to are ids as text; refers_to is that of
    the capture whose record a revisit refers to, null if the archives don't hold it.
    """
    spark = pages.sparkSession
    path = path or f"{Scratch(spark).base}/warc"
    write_archives(pages, path, **names)
    rows = assemble(read_records(spark, path, payload))
    told = F.col("metadata.payload").cast("string")
    capture = F.nullif(F.regexp_extract(told, r"(?m)^capture: (.*?)\r?$", 1), F.lit(""))
    length = F.regexp_extract(told, r"(?m)^length: ([0-9]+)\r?$", 1).cast("long")
    full = F.col("type") == "response"
    rows = rows.withColumn("_to", F.coalesce("refers_to", "record_id"))  # a record that refers to none stands for itself, so that no null is a hot key
    named = _told(read_records(spark, path, False), "metadata").select(F.col("record_id").alias("_to"), capture.alias("_whole"))
    rows = rows.join(named, "_to", "left")
    return rows.select(
        capture.alias("capture"), F.when(full, F.col("payload_bytes")).otherwise(length).alias("payload_bytes"), F.when(full, F.col("payload_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(F.col("refers_to").isNotNull(), F.col("_whole")).alias("refers_to"), "target_uri", "http_head", "payload", "request", "metadata",
    )
