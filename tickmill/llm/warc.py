"""WARC archives: writing, and reading back with segment reassembly.

The writer emits one HTTP response record for each page, its body in chunked
transfer framing, cut into a first segment and continuation records when the block is
larger than a segment; payloads that another response already holds become revisit records. Records are
joined by the CRLF CRLF that ends a record, by Spark's text writer, so archives go to any file system that Spark
writes to. Files hold a bounded number of bounded records. The reader parses files record by record, groups
continuations by their origin, orders them by segment number, verifies the
total length, and decodes the chunked body.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SEGMENT, CHUNK, RECORDS_A_FILE = 32768, 8192, 400
#: Fixed, so that archives of the same pages are equal.
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    out = b"".join(b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size))
    return out + b"0\r\n\r\n"


def unchunked(block: bytes) -> bytes:
    """The body of chunked framing; ValueError if it is broken."""
    out, at = [], 0
    while True:
        line = block.index(b"\r\n", at)
        size = int(block[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = line + 2
        if block[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without end")
        out.append(block[at : at + size])
        at += size + 2


def record(kind: str, record_id: str, url: str, block: bytes, **more) -> bytes:
    """A record without its closing CRLF CRLF."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:tickmill:{record_id}>", "WARC-Date": DATE, **{k.replace("_", "-"): v for k, v in more.items()}}
    if url:
        head["WARC-Target-URI"] = re.sub(r"[\r\n]+", " ", url)
    head["Content-Length"] = str(len(block))
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block


def page_records(key: str, url: str, body: bytes, refers_to: str | None, segment: int = SEGMENT):
    """All records of one page."""
    digest = "sha1:" + hashlib.sha1(body).hexdigest()
    if refers_to is not None:
        yield record("revisit", key, url, b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest=digest, WARC_Refers_To=f"<urn:tickmill:{refers_to}>", WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
    if len(block) <= segment:
        yield record("response", key, url, block, WARC_Payload_Digest=digest)
        return
    yield record("response", key, url, block[:segment], WARC_Payload_Digest=digest, WARC_Segment_Number=1)
    for n, at in enumerate(range(segment, len(block), segment), 2):
        last = {"WARC_Segment_Total_Length": len(block)} if at + segment >= len(block) else {}
        yield record("continuation", f"{key}/{n}", url, block[at : at + segment], WARC_Segment_Origin_ID=f"<urn:tickmill:{key}>", WARC_Segment_Number=n, **last)


def decisions(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, body, several (whether the id has more rows), and refers_to: the largest page_id with an equal payload of at least `least` bytes, null for that page itself, for smaller payloads and for payloads that occur once.

    Payloads are grouped by SHA-1 and length with partial aggregation; only digests that
    occur again are joined back, so a payload that fills a third of the table is one row there.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("body")).withColumns({"digest": F.sha1("body"), "bytes": F.octet_length("body").cast("long")})
    again = keyed.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").select("digest", "bytes", "holder")
    again = common.settled(again)
    out = keyed.join(common.maybe_broadcast(again), ["digest", "bytes"], "left")
    several = common.settled(pages.groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select("page_id", F.lit(True).alias("several")))
    out = out.join(common.maybe_broadcast(several), "page_id", "left")
    return out.select("page_id", "url", "body", F.when(F.col("holder") != F.col("page_id"), F.col("holder")).alias("refers_to"), F.coalesce("several", F.lit(False)).alias("several"))


def write(pages: DataFrame, folder: str, least: int = 1000, segment: int = SEGMENT) -> None:
    """Archives of all pages with an id, as gzip files in folder. Null html is an empty payload, null url no target; rows of null page_id are left out.

    A record's id is its page's; each row of an id that has several gets a suffix of its own, so that rows are
    never taken for segments of each other. Revisits refer to the page's id, without a suffix.
    """

    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "body", "refers_to", "several")]
            out, held = [], 0
            for key, url, body, ref, several in zip(*cols):
                row += 1
                for r in page_records(f"{key}+{task}.{row}" if several else str(key), url or "", body or b"", None if ref is None else str(ref), segment):
                    out.append(r)
                    held += len(r)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    rows = decisions(pages.where(F.col("page_id").isNotNull()), least).mapInArrow(run, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE).text(folder)


def parse(data: bytes):
    """(headers in lower case, block) of each record of an archive; ValueError if it ends early."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        end = data.index(_END, at)
        lines = data[at:end].decode().split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin, n = end + 4, int(head["content-length"])
        if len(data) < begin + n:
            raise ValueError("record cut short")
        yield head, data[begin : begin + n]
        at = begin + n
        if data[at : at + 4] != _END:
            raise ValueError("record without end")
        at += 4


def records(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record of all archives (plain or gzip) in folder."""
    import zlib

    def run(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                if data[:2] == b"\x1f\x8b":
                    out = []
                    while data:  # members one after the other
                        z = zlib.decompressobj(31)
                        out.append(z.decompress(data))
                        data = z.unused_data
                    data = b"".join(out)
                rows = []
                for head, block in parse(data):
                    key = head["warc-record-id"].strip("<>").removeprefix("urn:tickmill:")
                    origin = head.get("warc-segment-origin-id")
                    rows.append((head["warc-type"], origin.strip("<>").removeprefix("urn:tickmill:") if origin else key, head.get("warc-target-uri"), head.get("warc-payload-digest", "").removeprefix("sha1:") or None, (head.get("warc-refers-to") or "").strip("<>").removeprefix("urn:tickmill:") or None, int(head["warc-segment-number"]) if "warc-segment-number" in head else None, int(head["warc-segment-total-length"]) if "warc-segment-total-length" in head else None, block))
                kinds = (pa.string(),) * 5 + (pa.int32(), pa.int64(), pa.binary())
                cols = list(zip(*rows)) or [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["type", "origin", "url", "digest", "refers_to", "segment", "total", "block"])

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, "type string, origin string, url string, digest string, refers_to string, segment int, total long, block binary")


def assembled(found: DataFrame) -> DataFrame:
    """One row for each response or revisit: origin, type, url, digest, refers_to, body, ok.

    Whole records are decoded where they are. Segments are grouped by origin (one page's, so as
    large as that page), ordered by number and joined; `ok` is false, and body null, unless their numbers run from 1
    without a gap or repeat, their lengths add up to the announced total, the chunked framing is whole,
    and the body has the announced digest. A repeated record counts once.
    """
    whole = found.where(F.col("segment").isNull()).withColumn("good", F.lit(True))
    parts = F.array_sort(F.collect_set(F.struct("segment", "block")))
    cut = (
        found.where(F.col("segment").isNotNull())
        .groupBy("origin")
        .agg(F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("type"), F.max("url").alias("url"), F.max("digest").alias("digest"), F.max("refers_to").alias("refers_to"), F.max("total").alias("total"), parts.alias("parts"))
        .withColumn("joined", F.aggregate(F.col("parts"), F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x["block"])))
        .withColumn("numbers", F.transform("parts", lambda x: x["segment"]))
        .select("type", "origin", "url", "digest", "refers_to", F.array_join(F.transform("parts", lambda x: F.hex(x["block"])), "").alias("hexed"), F.coalesce((F.col("numbers") == F.sequence(F.lit(1), F.size("numbers"))) & (F.col("joined") == F.col("total")), F.lit(False)).alias("good"))
        .select("type", "origin", "url", "digest", "refers_to", F.unhex("hexed").alias("block"), "good")
    )

    def run(batches):
        for batch in batches:
            bodies, ok = [], []
            for kind, digest, block, good in zip(*(batch.column(c).to_pylist() for c in ("type", "digest", "block", "good"))):
                body = None
                if kind == "response" and good:
                    try:
                        head, _, rest = block.partition(_END)
                        body = unchunked(rest) if b"transfer-encoding: chunked" in head.lower() else rest
                    except ValueError:
                        body = None
                    if digest and body is not None and hashlib.sha1(body).hexdigest() != digest:
                        body = None
                bodies.append(body)
                ok.append(kind == "revisit" or body is not None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("origin", "type", "url", "digest", "refers_to")), pa.array(bodies, pa.binary()), pa.array(ok, pa.bool_())], ["origin", "type", "url", "digest", "refers_to", "body", "ok"])

    rows = whole.select("type", "origin", "url", "digest", "refers_to", "block", "good").unionByName(cut)
    return rows.mapInArrow(run, "origin string, type string, url string, digest string, refers_to string, body binary, ok boolean")


def op1(spark, sf_dir):
    """What is read back of the archives of all pages: a row for each row of pages that has an id; a broken page raises.

    Null html is an empty payload, null url no target. Repeated rows and further rows of an id come back as
    often as they are written. Of equal payloads the largest page_id is the response (all of its rows are, if it
    has several). An empty table gives no rows. Other columns are not read.
    """
    folder = f"{common.shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    pages = common.table(spark, sf_dir, "pages")
    write(pages, folder)
    got = assembled(records(spark, folder)).select(
        F.substring_index("origin", "+", 1).cast("long").alias("page_id"),
        F.when(F.col("ok"), F.octet_length("body").cast("long")).otherwise(F.raise_error(F.concat(F.lit("broken record "), F.col("origin")))).alias("payload_bytes"),
        F.coalesce(F.sha1("body"), F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )
    got = common.settled(got)
    # a revisit's payload is that of the response it refers to
    wanted = got.where("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    held = got.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("held"))
    held = common.settled(held.join(wanted, ["refers_to", "payload_digest"], "left_semi").distinct())
    return got.join(common.maybe_broadcast(held), ["refers_to", "payload_digest"], "left").select("page_id", F.coalesce("payload_bytes", "held").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
