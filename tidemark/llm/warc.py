"""WARC archives: writing captures, reading records, assembling transactions.

Archives are gzipped text files in the shared folder, written and read by Spark,
so that any file system it knows will do. A record is its header, a blank line and
its block, and two line ends follow: exactly what the text writer puts down for a
row with that separator. Reading splits at blank lines again, streams the pieces of
a file through a parser that puts them together by Content-Length, and so never
holds more than a batch of pieces and one record.

A capture is a response or revisit record and the request and metadata records
that were made with it. They name each other in WARC-Concurrent-To, in either
direction and possibly by way of a third one; assembly joins them on these names and
gives one nested row per capture.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import scratch_dir

from .common import store

#: Payloads of fewer bytes are not deduplicated.
LEAST_REVISIT = 100
END = "\r\n"
CAPTURES = ("response", "revisit")

RECORD = (
    "record_id string, type string, target_uri string, date string, concurrent_to array<string>, "
    "refers_to string, headers map<string,string>, payload binary, payload_bytes bigint, payload_digest string"
)


def _lines(*lines: Column) -> Column:
    """Lines that are not null, each with its end."""
    kept = F.filter(F.array(*lines), lambda x: x.isNotNull())
    return F.concat(F.array_join(kept, END), F.lit(END))


def _record(kind: str | Column, name: Column, block: Column, *more: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = _lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), name, F.lit(">")),
        *more, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END), block)


def _clean(value: Column) -> Column:
    """A header's value: without line ends."""
    return F.regexp_replace(value, "[\\x00-\\x1F\\x7F]+", " ")


def originals(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) as (page_id, url, html, digest, bytes, original).

    original is the least page_id of those with an equal payload of ``least`` bytes
    or more. A null html is the empty payload.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.octet_length(body).cast("bigint").alias("bytes"), F.sha2(body, 256).alias("digest"))
    first = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("original"))
    # the hot side of the join has rows that can be split, the other one row per digest
    return rows.join(first, "digest", "left")


def write_captures(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = LEAST_REVISIT) -> None:
    """Write a response or revisit, a request and a metadata record per page to ``path``.

    Of equal payloads of ``least`` bytes or more the one with the least page_id is a
    response, the others revisit it; shorter ones are all responses. Record ids are
    made of page_id and payload digest, so a task that runs again writes the same.
    """
    rows = originals(pages, least)
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    tail = F.concat(F.lit(":"), F.substring("digest", 1, 32))
    name = F.concat(F.lit("urn:page:"), number, tail)
    revisit = F.coalesce(F.col("original") != F.col("page_id"), F.col("original").isNotNull())
    url = _clean(F.coalesce("url", F.lit("")))
    about = [
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {date}"),
    ]
    together = F.concat(F.lit("WARC-Concurrent-To: <"), name, F.lit(">"))
    head = _lines(
        F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")),
    )
    block = F.concat(head, F.lit(END), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    refers = F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("original").cast("string"), tail, F.lit(">")))
    profile = F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    capture = _record(
        kind, name, block, *about, F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")), refers, profile,
        F.lit("Content-Type: application/http; msgtype=response"),
    )
    host = F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)
    target = F.regexp_extract(url, "^[a-z]+://[^/?#]*([^#]*)", 1)
    asked = F.concat(_lines(F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1")), F.concat(F.lit("Host: "), host)), F.lit(END))
    request = _record(
        "request", F.concat(name, F.lit(":request")), asked, *about, together, F.lit("Content-Type: application/http; msgtype=request")
    )
    note = _lines(F.concat(F.lit("page-id: "), number))
    metadata = _record(
        "metadata", F.concat(name, F.lit(":metadata")), note, *about, together, F.lit("Content-Type: application/warc-fields")
    )
    # a capture's records lie together, as a crawler writes them
    records = rows.select(F.concat_ws(END + END, request, capture, metadata).alias("value"))
    records.write.option("lineSep", END + END).option("compression", "gzip").text(path)


def _fields(head: bytes) -> list[tuple[str, str]]:
    out = []
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out.append((name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()))
    return out


def _named(value: str | None) -> str | None:
    return value.strip().removeprefix("<").removesuffix(">") if value else None


def _row(head: bytes, block: bytes) -> dict:
    fields = _fields(head)
    first = dict(reversed(fields))
    kind = first.get("warc-type", "")
    http, payload = {}, block
    if first.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        http = dict(reversed(_fields(top)))
    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    if kind == "revisit":  # the payload is with the record it refers to
        length = http.get("content-length", "")
        size = int(length) if length.isdigit() else None
        digest = first.get("warc-payload-digest", "").rpartition(":")[2].lower() or None
        payload = None
    return {
        "record_id": _named(first.get("warc-record-id")),
        "type": kind,
        "target_uri": first.get("warc-target-uri"),
        "date": first.get("warc-date"),
        "concurrent_to": [_named(v) for n, v in fields if n == "warc-concurrent-to"],
        "refers_to": _named(first.get("warc-refers-to")),
        "headers": list((first | {f"http:{n}": v for n, v in http.items()}).items()),
        "payload": payload,
        "payload_bytes": size,
        "payload_digest": digest,
    }


_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)


BLANK = b"\r\n\r\n"


def _records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of the records in a stream whose pieces all end at a blank line."""
    parts, have, head, need = [], 0, None, 0
    for piece in pieces:
        parts += [piece, BLANK]
        have += len(piece) + 4
        while True:
            if head is None:
                held = b"".join(parts).lstrip(b"\r\n")
                parts, have = [held], len(held)
                if not held:
                    break
                if not held.startswith(b"WARC/"[: len(held)]):
                    raise ValueError(f"not a WARC record: {held[:40]!r}")
                end = held.find(BLANK)
                if end < 0:
                    break
                head, rest = held[:end], held[end + 4 :]
                need = int(dict(_fields(head))["content-length"])
                parts, have = [rest], len(rest)
            if have < need + 4:
                break
            held = b"".join(parts)
            if held[need : need + 4] != BLANK:
                raise ValueError(f"a record is longer than its Content-Length of {need}")
            yield head, held[:need]
            head, rest = None, held[need + 4 :]
            parts, have = [rest], len(rest)
    if head is not None or have:
        raise ValueError("an archive ends within a record")


def _parse(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces between blank lines, in file order, to records."""
        rows, size = [], 0
        for head, block in _records(piece.as_py() or b"" for batch in batches for piece in batch.column(0)):
            rows.append(_row(head, block))
            if not payloads:
                rows[-1]["payload"] = None
            size += len(block)
            if len(rows) >= 1000 or size >= 4 << 20:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return run


def read_records(spark, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the gzipped archives at ``path``.

    Without ``payloads`` these are read, measured and hashed but not handed on.
    payload_bytes and payload_digest are of the payload as read; for revisits, what
    their headers say of the payload they refer to, and payload is null. A file that
    breaks off or states a wrong length fails the read.
    """
    pieces = spark.read.option("lineSep", END + END).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_parse(payloads), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, copies, response, request, metadata.

    ``records`` as from `read_records`. A request or metadata record belongs to the
    capture it names as concurrent, that names it, or that a record does which it is
    concurrent with; if these are several, to each. response holds the response or
    revisit record, request the least by id, metadata all of them. Records that
    repeat an id are one capture, counted by ``copies``. A capture without request
    has a null one. Records without a capture, or without an id, are left out.
    """
    known = records.where(F.col("record_id").isNotNull())
    fields = ["record_id", "target_uri", "date", "headers", "payload", "payload_bytes", "payload_digest"]
    captured = known.where(F.col("type").isin(*CAPTURES))
    # column by column, so that those not asked for aren't shuffled
    held = ["type", "target_uri", "date", "refers_to", "headers", "payload", "payload_bytes", "payload_digest"]
    heads = captured.groupBy(F.col("record_id").alias("capture_id")).agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(f"_{c}") for c in held]
    )
    named = known.select("record_id", "type", F.explode("concurrent_to").alias("other"))
    is_capture = F.col("type").isin(*CAPTURES)
    # (record, capture): named by the record, or naming it
    direct = named.where(~is_capture).select("record_id", F.col("other").alias("capture_id"))
    back = named.where(is_capture).select(F.col("other").alias("record_id"), F.col("record_id").alias("capture_id"))
    either = direct.unionByName(back).distinct()
    sides = known.where(~is_capture)
    real = either.join(captured.select(F.col("record_id").alias("capture_id")).distinct(), "capture_id", "left_semi")
    # one step further, over a record that is no capture
    steps = direct.unionByName(direct.select(F.col("capture_id").alias("record_id"), F.col("record_id").alias("capture_id")))
    steps = steps.withColumnRenamed("capture_id", "via")
    further = steps.join(real.withColumnRenamed("record_id", "via"), "via").select("record_id", "capture_id")
    ties = real.unionByName(further).distinct()
    beside = sides.select("type", *fields).join(ties, "record_id")
    part = F.struct(*fields)
    grouped = beside.groupBy("capture_id").agg(
        F.min_by(F.when(F.col("type") == "request", part), F.when(F.col("type") == "request", F.col("record_id"))).alias("request"),
        F.array_sort(F.collect_list(F.when(F.col("type") == "metadata", part)), lambda a, b: F.when(a.record_id < b.record_id, -1).when(a.record_id > b.record_id, 1).otherwise(0)).alias("metadata"),
    )
    response = F.struct(F.col("capture_id").alias("record_id"), *[F.col(f"_{c}").alias(c) for c in held])
    return heads.join(grouped, "capture_id", "left").select(
        "capture_id", "copies", response.alias("response"), "request", F.coalesce("metadata", F.array()).alias("metadata")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Captures of ``pages`` written to the shared scratch folder, read back and assembled.

    Payloads are read for their size and digest only; records are parsed once and
    kept, as assembly reads them several times.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_captures(pages, path)
    return assemble(store(read_records(spark, path, payloads=False), "records"))
