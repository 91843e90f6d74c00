"""WARC archives: pages to records, records to captures.

Writing. A page becomes three records: a request, its response (or a revisit of the response with the
smallest page_id of those with the same payload), and metadata. Request and metadata name the
response in WARC-Concurrent-To. Archives are written by Spark's text writer, since a record ends in
two line breaks, which is the separator it puts after every row; so files are committed like any
other output. Payloads are compared by SHA-1 and SHA-256.

Reading. A file is walked record by record by its Content-Length. Records are then assembled: those
that name a response as concurrent are reduced to one per kind and response, joined to it, and one
nested row per capture comes out. A revisit gets its payload's length from the response it refers to.

Defined results: null html is an empty payload, null urls stay null; of equal payloads the smallest
(page_id, url), null last, is the response; of rows equal in all three one is, and the others revisit it;
every row gives a capture, and repeated revisits share their record ids; an empty table gives an empty
archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import cut_lineage

#: Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Rows of one archive file.
FILE_RECORDS = 3000
#: Copies of a repeated row that one task writes out.
COPIES = 10_000

RECORD = (
    "kind string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, content_type string, payload_digest string, block_bytes long, payload_bytes long, "
    "found_digest string, fields map<string, string>, payload binary"
)


def payload_digest(payload: bytes) -> str:
    """Base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(repr, parts)))}>"


def _record(headers: list[tuple[str, str | None]], block: str) -> str:
    """A record without the two line breaks that end it."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers if v is not None)]
    return BREAK.join([*lines, f"Content-Length: {len(block.encode())}", "", block])


def _clean(url: str | None) -> str | None:
    """A url as a header value: line breaks and blanks at the ends would be lost, so they are escaped."""
    if url is None:
        return None
    out = "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in url)
    return out if out == out.strip() else out.replace(" ", "%20").replace("\t", "%09")


def page_records(page_id, url, html, digest, first_id, first_url, copy=0) -> list[str]:
    """Request, response or revisit, and metadata of a page; `copy` numbers rows equal to the response."""
    payload, target = html or "", _clean(url)
    own = _urn("response", page_id, url, digest, *([copy] if copy else []))
    revisit = copy > 0 or (page_id, url) != (first_id, first_url)
    status = f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    labelled = ("WARC-Payload-Digest", f"sha1:{digest}")
    kind = ("Content-Type", "application/http;msgtype=response")
    if revisit:
        refers = [("WARC-Refers-To", _urn("response", first_id, first_url, digest)), ("WARC-Profile", REVISIT_PROFILE)]
        main = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *refers, labelled, kind]
        block = status + BREAK
    else:
        main = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, labelled, kind]
        block = f"{status}Content-Length: {len(payload.encode())}{BREAK}{BREAK}{payload}"
    try:
        host, path = urlsplit(target or "").netloc, urlsplit(target or "").path or "/"
    except ValueError:  # not every text is a url
        host, path = "", "/"
    asked = f"GET {path} HTTP/1.1{BREAK}Host: {host}{BREAK}{BREAK}"
    beside = ("WARC-Concurrent-To", own)
    request = [("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", own)), *common, beside]
    request.append(("Content-Type", "application/http;msgtype=request"))
    about = [("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", own)), *common, beside]
    about.append(("Content-Type", "application/warc-fields"))
    fields = "" if page_id is None else f"page-id: {page_id}{BREAK}"
    fields += "" if first_id is None else f"first-page-id: {first_id}{BREAK}"
    return [_record(request, asked), _record(main, block), _record(about, fields)]


def _numbered(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows that are equal to their payload's response, numbered; only number 0 carries the payload."""
    keys = ["sha1", "sha2"]
    html = pages.join(repeated.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max("html").alias("html"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("same") / COPIES) - 1)).alias("part")
    parts = repeated.join(html, keys).select("*", part)
    parts = parts.withColumn("html", F.when(F.col("part") == 0, F.col("html")).otherwise("")).repartition("sha1", "part")
    last = F.least(F.col("same"), (F.col("part") + 1) * COPIES) - 1
    copies = parts.withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, last)))
    return copies.select(
        F.col("first_id").alias("page_id"), F.col("first_url").alias("url"),
        F.when(F.col("copy") == 0, F.col("html")).otherwise("").alias("html"), "sha1", "first_id", "first_url", "copy",
    )


def write(pages: DataFrame, path: str, compression: str = "gzip", file_records: int = FILE_RECORDS) -> None:
    """Write the pages' records as archives below `path`."""
    pages = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.sha1(F.coalesce("html", F.lit(""))).alias("sha1"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("sha2"),
    )
    place = [F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url"]
    rows = pages.groupBy("sha1", "sha2", "page_id", "url").agg(F.count("*").alias("same"))
    firsts = rows.groupBy("sha1", "sha2").agg(F.min(F.struct(*place, "same")).alias("first"), F.sum("same").alias("n"))
    firsts = firsts.where("n > 1").select(
        "sha1", "sha2", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
        F.col("first.same").alias("same"), F.lit(True).alias("known"),
    )
    firsts = cut_lineage(firsts)
    # only pages whose payload stands more than once need a partner; the join's sides are plain, so that
    # Spark can split a payload that a third of all pages have
    joined = pages.join(firsts, ["sha1", "sha2"], "left")
    own = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    joined = joined.where(F.col("known").isNull() | (F.col("same") == 1) | ~own).select(
        "page_id", "url", "html", "sha1",
        F.when(F.col("known").isNull(), F.col("page_id")).otherwise(F.col("first_id")).alias("first_id"),
        F.when(F.col("known").isNull(), F.col("url")).otherwise(F.col("first_url")).alias("first_url"),
        F.lit(0).cast("long").alias("copy"),
    )
    repeated = firsts.where("same > 1")
    if not repeated.isEmpty():  # responses that stand more than once
        joined = joined.unionByName(_numbered(pages, repeated))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                out = []
                for row in batch.slice(i, 500).to_pylist():
                    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    out += page_records(
                        row["page_id"], row["url"], row["html"], digest, row["first_id"], row["first_url"], row["copy"]
                    )
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    records = joined.mapInArrow(run, "value string")
    writer = records.write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", file_records)
    writer.option("compression", compression).text(path)


def _headers(lines: bytes) -> list[tuple[str, str]]:
    pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split(BREAK)[1:] if ":" in line)
    return [(k.strip().lower(), v.strip()) for k, v in pairs]


def parse_records(content: bytes, with_payload: bool) -> Iterator[dict]:
    """The records of an archive, in order. Content-Length alone says where a record ends."""
    at, line = 0, BREAK.encode()
    while (at := content.find(b"WARC/", at)) >= 0:
        end = content.find(line * 2, at)
        if end < 0:
            raise ValueError(f"record at byte {at} has no end of headers")
        headers = _headers(content[at:end])
        of = dict(headers)
        begin = end + 4
        size = int(of["content-length"])
        if begin + size > len(content):
            raise ValueError(f"record at byte {at} is cut off")
        block = content[begin : begin + size]
        http = of.get("content-type", "").startswith("application/http")
        payload = block.partition(line * 2)[2] if http else block
        kind = of.get("warc-type")
        fields = None
        if kind == "metadata":
            rows = (x.split(":", 1) for x in block.decode("utf-8", "replace").split(BREAK) if ":" in x)
            fields = [(k.strip(), v.strip()) for k, v in rows]
        whole = kind != "revisit"  # whose payload is elsewhere
        yield {
            "kind": kind,
            "record_id": of.get("warc-record-id"),
            "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
            "refers_to": of.get("warc-refers-to"),
            "target_uri": of.get("warc-target-uri"),
            "date": of.get("warc-date"),
            "content_type": of.get("content-type"),
            "payload_digest": of.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "block_bytes": size,
            "payload_bytes": len(payload) if whole else None,
            "found_digest": payload_digest(payload) if whole else None,
            "fields": fields,
            "payload": payload if with_payload and whole else None,
        }
        at = begin + size


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """RECORD rows of all archives below `path`, gzipped or not."""
    def unpacked(content: bytes) -> bytes:
        if content[:2] != b"\x1f\x8b":
            return content
        out, rest = [], content
        while rest[:2] == b"\x1f\x8b":  # one member for each record, or one for all
            member = zlib.decompressobj(31)
            out.append(member.decompress(rest))
            rest = member.unused_data
        return b"".join(out)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    kinds["map<string, string>"] = pa.map_(pa.string(), pa.string())
    schema = pa.schema([(f.split(" ", 1)[0], kinds[f.split(" ", 1)[1]]) for f in _fields(RECORD)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for record in parse_records(unpacked(batch.column("content")[i].as_py()), with_payload):
                    rows.append(record)
                    held += len(record["payload"] or b"")
                    if len(rows) >= 2000 or held > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def _fields(schema: str) -> list[str]:
    """The columns of a schema text; a comma inside < > parts nothing."""
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [f.strip() for f in out]


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, target_uri, main, request, metadata), where `main` is the
    response or revisit, and the others the record of that kind that is concurrent to it, the one with
    the smallest id if there are several."""
    names = [f.split(" ", 1)[0] for f in _fields(RECORD)]
    main = records.where("kind in ('response', 'revisit')")
    main = main.select(F.col("record_id").alias("id"), "target_uri", F.struct(*names).alias("main"))
    beside = records.where("kind in ('request', 'metadata')").select(
        F.explode("concurrent_to").alias("id"), "kind", F.struct(*[n for n in names if n != "payload"]).alias("record")
    )
    one = beside.groupBy("id").agg(
        *(
            F.min_by(F.when(F.col("kind") == kind, F.col("record")), F.when(F.col("kind") == kind, F.col("record.record_id")))
            .alias(kind)
            for kind in ("request", "metadata")
        )
    )
    return main.join(one, "id", "left").withColumnRenamed("id", "record_id")


def pages(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every capture of pages."""
    flat = found.select(
        F.col("record_id"),
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"),
        F.col("metadata.fields")["first-page-id"].cast("long").alias("first_id"),
        F.col("main.kind").alias("record_type"),
        F.col("main.refers_to").alias("target"),
        F.col("main.payload_bytes").alias("own_bytes"),
        F.col("main.found_digest").alias("own_digest"),
    )
    flat = cut_lineage(flat)
    # a record may stand in several archives
    targets = flat.where("record_type = 'response'").groupBy(F.col("record_id").alias("target")).agg(
        F.min("own_bytes").alias("bytes"), F.min("own_digest").alias("digest"), F.min("page_id").alias("refers_to")
    )
    revisits = flat.where("record_type = 'revisit'").join(cut_lineage(targets), "target", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = flat.where("record_type = 'response'").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    again = revisits.withColumnsRenamed({"bytes": "payload_bytes", "digest": "payload_digest"})
    return first.select(columns).unionByName(again.select(columns))
