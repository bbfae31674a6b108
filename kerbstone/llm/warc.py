"""Web archives: writing captures, reading records, assembling transactions.

A capture is three records: the request, the response (or a revisit of an
equal payload) and the metadata. Request and metadata name the response by
``WARC-Concurrent-To``; after reading, the three meet again by that name and
become one nested row. Archives are written and read by Spark's own sources,
so they may lie in any store.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone.llm.batches import slices
from kerbstone.plans.cut import cut
from kerbstone.plans.skew import lookup_join
from kerbstone.session import ship

#: Payloads of fewer bytes are never written as revisits.
REVISIT_BYTES = 0
#: Captures of one archive at most; a reader holds one archive at a time.
ARCHIVE_CAPTURES = 1000
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, fields: list[tuple[str, str]], content_type: str, block: str) -> str:
    """One record. Its two closing line ends are completed by the text writer."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    head += [f"{name}: {value}" for name, value in fields if value]
    head += [f"Content-Type: {content_type}", f"Content-Length: {len(block.encode())}"]
    return VERSION + "\r\n" + "\r\n".join(head) + "\r\n\r\n" + block + "\r\n\r"


def target(url: str | None) -> str:
    """A URL as a header value: white space and controls percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def capture_records(
    capture: str, page: int | None, url: str | None, payload: str, first: int | None, first_url: str | None
) -> str:
    """The three records of a capture; ``first`` is the page that has its payload, if another."""
    size, digest = len(payload.encode()), f"sha1:{sha1_base32(payload.encode())}"
    uri = target(url)
    ids = {kind: uuid.uuid5(uuid.NAMESPACE_OID, f"{capture}/{kind}").urn for kind in ("request", "response", "metadata")}
    path, _, host = uri.partition("://")[2].partition("/")[::-1]
    request = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    together = ("WARC-Concurrent-To", f"<{ids['response']}>")
    common = [("WARC-Target-URI", uri)]
    revisits = first is not None
    notes = [] if page is None else [f"page-id: {page}"]
    answer = [*common, ("WARC-Payload-Digest", digest)]
    if revisits:
        notes.append(f"refers-to-page-id: {first}")
        answer += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Target-URI", target(first_url)),
                   ("WARC-Refers-To-Date", DATE)]
    return "\n".join([
        record("request", ids["request"], [*common, together], "application/http; msgtype=request", request),
        record("revisit" if revisits else "response", ids["response"], answer,
               "application/http; msgtype=response", head if revisits else head + payload),
        record("metadata", ids["metadata"], [*common, together], "application/warc-fields",
               "".join(f"{n}\r\n" for n in notes)),
    ])


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write a capture for each row of ``pages`` as compressed archives in ``path``.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes, that with
    the smallest id (all rows that repeat it) is a response and the others are
    revisits of it; a null payload is empty. A row without id is a response if
    no row of its payload has an id, and a revisit otherwise. White space in a
    URL is percent-encoded; a null URL gives no target. Other columns are not
    read. No rows give no captures.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    marked = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page"),
        F.col(f"`{url_col}`").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    firsts = cut(
        marked.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("page").isNotNull(), F.struct("page", "url"))).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    # A page's text stays where it was read unless the repeated payloads are
    # too many to be sent along.
    rows = lookup_join(marked, firsts, "digest").select(
        F.monotonically_increasing_id().alias("row"), "page", "url", "payload",
        F.when(~F.col("page").eqNullSafe(F.col("first.page")), F.col("first.page")).alias("first"),
        F.col("first.url").alias("first_url"),
    )
    run = uuid.uuid4().hex

    def written(batches):
        for batch in batches:
            for part in slices(batch, "payload"):
                columns = [part.column(i).to_pylist() for i in range(part.num_columns)]
                text = [capture_records(f"{run}/{row}", *rest) for row, *rest in zip(*columns)]
                yield pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["value"])

    rows.mapInArrow(written, "value string").write.option("compression", "gzip").option(
        "lineSep", "\n").option("maxRecordsPerFile", ARCHIVE_CAPTURES).text(path)


RECORD = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("concurrent_to", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
])


def fields(lines: bytes) -> dict[str, str]:
    """Named fields, names in lower case."""
    found = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return found


def read_records(data: bytes) -> Iterator[dict]:
    """The records of an archive, by their content lengths; a cut-off last one is an error."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if data[at:at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        split = data.find(b"\r\n\r\n", at)
        if split < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        head = fields(data[at:split])
        length = int(head["content-length"])
        block = data[split + 4:split + 4 + length]
        if len(block) < length:
            raise ValueError(f"the record at byte {at} is cut off")
        at = split + 4 + length
        yield parsed(head, block)


def parsed(head: dict[str, str], block: bytes) -> dict:
    kind = head.get("warc-type")
    out = {
        "record_id": head.get("warc-record-id"), "type": kind,
        "concurrent_to": head.get("warc-concurrent-to"), "target_uri": head.get("warc-target-uri"),
        "date": head.get("warc-date"), "headers": head, "http_headers": {}, "payload": block,
        "payload_bytes": len(block), "payload_digest": None,
    }
    if kind in ("request", "response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        out |= {"http_headers": fields(http.partition(b"\r\n")[2]), "payload": body, "payload_bytes": len(body)}
    if kind == "response":
        out["payload_digest"] = sha1_base32(body)
        if head.get("warc-payload-digest", f"sha1:{out['payload_digest']}") != f"sha1:{out['payload_digest']}":
            raise ValueError(f"the payload of {out['record_id']} does not have its digest")
    elif kind == "revisit":
        # its payload is elsewhere; what it was is written in its headers
        out["payload_bytes"] = int(out["http_headers"].get("content-length", 0))
        out["payload_digest"] = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    elif kind == "metadata":
        out["http_headers"] = fields(block)
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in ``path``, one row each.

    A response's payload is checked against its digest. A revisit has no
    payload of its own; its size and digest are those of the one it repeats.
    """
    ship(spark)

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from in_batches(read_records(batch.column("content")[i].as_py()))

    def in_batches(records):
        held, size = [], 0
        for r in records:
            held.append(r)
            size += len(r["payload"])
            if size > 4 << 20:
                yield rows_of(held)
                held, size = [], 0
        if held:
            yield rows_of(held)

    def rows_of(held):
        kinds = {"headers": pa.map_(pa.string(), pa.string()), "http_headers": pa.map_(pa.string(), pa.string()),
                 "payload": pa.binary(), "payload_bytes": pa.int64()}
        arrays = []
        for name in RECORD.names:
            values = [list(r[name].items()) if "headers" in name else r[name] for r in held]
            arrays.append(pa.array(values, kinds.get(name, pa.string())))
        return pa.RecordBatch.from_arrays(arrays, names=RECORD.names)

    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("content")
        .mapInArrow(read, RECORD)
    )


def assemble(records: DataFrame, fields: list[str] = RECORD.names) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata, others``.

    A response or revisit leads a capture; requests and metadata join it by
    the record they are concurrent to. All records meet in one shuffle by that
    name, each read once. A missing one is null; of several of a kind the one
    with the least record id is taken, and the rest, repeated records included,
    are in ``others``, by type and id. What names no leading record belongs to no
    capture. ``fields`` are those that the records keep.
    """
    leads = F.col("type").isin("response", "revisit")
    one = F.struct(
        F.when(leads, 0).when(F.col("type") == "request", 1).when(F.col("type") == "metadata", 2).otherwise(3).alias("kind"),
        F.col("record_id").alias("id"), F.struct(*fields).alias("r"))
    met = (
        records.select(F.when(leads, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"), one.alias("one"))
        .where("capture_id is not null")
        .groupBy("capture_id")
        .agg(F.array_sort(
            F.collect_list("one"),
            lambda a, b: F.when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1)
            .when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("all"))
    )

    def place(kind: int):
        return F.array_position(F.col("all")["kind"], kind)

    def first(kind: int):
        return F.get("all", place(kind).cast("int") - 1)["r"]

    taken = F.array(*[place(k) for k in range(3)])
    others = F.filter(
        F.transform("all", lambda x, i: F.when(~F.array_contains(taken, (i + 1).cast("bigint")), x["r"])), lambda x: x.isNotNull())
    return met.where(place(0) > 0).select(
        "capture_id", first(0).alias("response"), first(1).alias("request"), first(2).alias("metadata"), others.alias("others"))


def page_columns(captures: DataFrame) -> DataFrame:
    """What a capture says of its page: id, type, payload size and digest, and the page it repeats."""
    note = F.col("metadata.http_headers")
    return captures.select(
        note["page-id"].cast("bigint").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        note["refers-to-page-id"].cast("bigint").alias("refers_to"),
    )
