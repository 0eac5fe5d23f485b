"""WARC archives: segmented, chunked records written and put together again."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialise

#: Fixed values of the format (ISO 28500).
VERSION, END = "WARC/1.1", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: Bytes of a block that one record holds; longer blocks go on in continuation records.
SEGMENT_BYTES = 1 << 15
#: Bytes in a chunk of the transfer framing.
CHUNK_BYTES = 4096


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write one WARC record for each row, gzipped, as files under path.

    A null payload is empty. Of rows with equal payloads of at least LEAST_REVISIT bytes,
    those with the smallest id are responses (several, if the id repeats) and the others
    revisits of it; all smaller ones are responses. A null id comes after all others, and
    copies with a null id alone are responses. A response block is an HTTP message in
    chunked framing; a block longer than `segment_bytes` is cut into a first record and
    continuation records. An empty table gives a folder without records.

    Spark's text writer writes the bytes, the end of a record being its line end, so files
    are committed whole and a lost executor leaves none half written.
    """
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256))
    large = own.filter(F.length("payload") >= LEAST_REVISIT).select("page_id", "digest")
    copies = materialise(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "copies")
    marked = own.join(copies, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    marked = marked.withColumn("refers_to", F.when(revisit, F.col("first"))).withColumn("record", F.expr("uuid()"))
    body = F.when(F.col("refers_to").isNull(), F.concat(F.lit(HTTP).cast("binary"), _chunked(F.col("payload"), chunk_bytes)))
    block = F.coalesce(body, F.lit(HTTP).cast("binary"))
    cut = marked.withColumn("block", block).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.length("block") / segment_bytes)).cast("int"))
    parts = cut.withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    piece = F.substr(F.col("block"), (F.col("part") - 1) * segment_bytes + 1, F.lit(segment_bytes))
    record = F.concat(_head(piece, F.col("part"), F.col("parts")).cast("binary"), piece)
    records = parts.select(record.cast("string").alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


def _head(piece: Column, part: Column, parts: Column) -> Column:
    first = part == 1
    name = lambda r: F.concat(F.lit("<urn:uuid:"), r, F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value.cast("string"), F.lit("\r\n"))
    when = lambda test, text: F.when(test, text).otherwise(F.lit(""))
    kind = F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    return F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", name(F.when(first, F.col("record")).otherwise(F.concat(F.col("record"), F.lit("-"), part)))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        when(first, line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", ""))),
        when(first, line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        when(first, line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))),
        when(first & F.col("refers_to").isNotNull(), line("X-Refers-To-Page", F.coalesce("refers_to", F.lit(0)))),
        when(first, line("Content-Type", F.lit("application/http; msgtype=response"))),
        when(parts > 1, line("WARC-Segment-Number", part)),
        when(~first, line("WARC-Segment-Origin-ID", name(F.col("record")))),
        when((parts > 1) & (part == parts), line("WARC-Segment-Total-Length", F.length("block"))),
        line("Content-Length", F.length(piece)),
        F.lit("\r\n"),
    )


def _chunked(payload: Column, size: int) -> Column:
    """The payload in chunked transfer framing, as bytes."""
    count = F.ceil(F.length(payload) / size).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    framed = F.transform(starts, lambda i: _chunk(F.substr(payload, i * size + 1, F.lit(size))).cast("string"))
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n")).cast("binary")


def _chunk(data: Column) -> Column:
    head = F.concat(F.hex(F.length(data).cast("long")), F.lit("\r\n"))
    return F.concat(head.cast("binary"), data, F.lit("\r\n").cast("binary"))


READ = "record_id string, record_type string, origin_id string, segment int, total long, page_id long, url string, refers_to long, digest string, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under path, gzipped or plain; each file is one row in
    the reading task, so files should stay below some hundred MB."""
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(_records, READ)


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            rows, held = [], 0
            for row in parse(content):
                rows.append(row)
                held += len(row[-1])
                if held > 4 << 20:
                    yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])


def parse(content: bytes) -> Iterator[tuple]:
    """The records of one archive as tuples of READ."""
    file = io.BytesIO(content)
    file = gzip.GzipFile(fileobj=file) if content[:2] == b"\x1f\x8b" else file
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := file.readline()).strip():
            key, _, value = line.decode("utf-8").partition(":")
            head[key.strip().lower()] = value.strip()
        block = file.read(size := int(head["content-length"]))
        if len(block) != size:
            raise ValueError(f"record {head.get('warc-record-id')} ends early")
        number = lambda key: int(head[key]) if head.get(key) else None  # noqa: B023, E731
        yield (
            head["warc-record-id"], head["warc-type"], head.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"),
            number("x-page-id"), head.get("warc-target-uri"), number("x-refers-to-page"), head.get("warc-payload-digest", "").partition(":")[2] or None, block,
        )


def reassemble(records: DataFrame) -> DataFrame:
    """One row for each whole record: segments are gathered by the identifier of their
    origin, put in order of segment number, and their length is held against the total.

    Only records that were cut are shuffled; a group is the segments of one record.
    `complete` is false where a segment is missing or the length differs.
    """
    cut = F.col("segment").isNotNull()
    whole = records.filter(~cut).select("record_type", "page_id", "url", "refers_to", "digest", "block", F.lit(True).alias("complete"))
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    pieces = (
        records.filter(cut)
        .withColumn("origin", F.coalesce("origin_id", "record_id"))
        .groupBy("origin")
        .agg(*[first(x) for x in ("record_type", "page_id", "url", "refers_to", "digest")], F.max("total").alias("total"), F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"))
    )
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    in_order = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    joined = pieces.withColumn("block", block).withColumn("complete", F.coalesce(in_order & (F.length(block) == F.col("total")), F.lit(False)))
    return whole.unionByName(joined.drop("origin", "parts", "total"))


BODY = "record_type string, page_id long, url string, refers_to long, complete boolean, payload_bytes long, payload_digest string, payload binary, digest string"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The pages of the archives: record_type, page_id, url, refers_to, complete,
    payload_bytes, payload_digest and, if asked for, payload.

    Chunked framing is decoded. A revisit gets length and payload of the response with the
    id it refers to and the digest in its own header; without one it has that digest and
    no payload. `complete` is false then; it is false too, and the digest that of what is there, where segments are
    missing or the payload does not match the digest in its header.
    """

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [decode(b) for b in rows["block"]]
            rows["payload_bytes"] = [len(p) for p, _ in found]
            rows["payload_digest"] = [hashlib.sha256(p).hexdigest() for p, _ in found]
            right = (rows["payload_digest"] == rows["digest"]) | rows["digest"].isna() | (rows["record_type"] == "revisit")
            rows["complete"] = rows["complete"] & pd.Series([ok for _, ok in found], index=rows.index) & right
            rows["payload"] = [p for p, _ in found] if payloads else None
            yield rows.drop(columns=["block"])

    made = materialise(reassemble(read_records(spark, path)).mapInPandas(bodies, BODY), "bodies")
    responses = made.filter("record_type = 'response'").drop("digest")
    # Ids may repeat with other payloads: a revisit's own header says which one it means.
    key = ["refers_to", "payload_digest"]
    origin = responses.filter("page_id is not null").select(F.col("page_id").alias("refers_to"), "complete", "payload_bytes", "payload_digest", "payload").dropDuplicates(key)
    wanted = made.filter("record_type = 'revisit'").select("record_type", "page_id", "url", "refers_to", F.col("digest").alias("payload_digest"))
    revisits = wanted.join(materialise(origin.join(wanted.select(*key).distinct(), key, "left_semi"), "origins"), key, "left")
    pages = responses.unionByName(revisits.withColumn("complete", F.coalesce("complete", F.lit(False))))
    return pages if payloads else pages.drop("payload")


def decode(block: bytes) -> tuple[bytes, bool]:
    """The payload of an HTTP message, and whether its framing was sound."""
    head, found, body = block.partition(END.encode())
    if not found or b"transfer-encoding: chunked" not in head.lower():
        return body, bool(found)
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            size = -1
        if size <= 0:
            return b"".join(parts), size == 0
        parts.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size
