"""WARC archives as a chunked record table.

An archive is a folder of WARC/1.1 files. A payload past ``segment_bytes`` is
written as the standard's segmented record: a first segment and continuation
records, so no row of the write or the read holds more than a segment. Equal
payloads of at least ``revisit_bytes`` are stored once; later ones become
revisit records that carry length and digest of the full payload.

Reading gives the chunk table: one row per segment with record identifier,
chunk number, payload bytes and offset. Payload digests are carried along the
chunks of a record (``digests``), each chunk being dropped once it is added.

Files are written by Spark's text sink with the blank line that ends a WARC
record as line separator, and read by the text source with that blank line
and the next record's version line as separator. A segment ends inside every
version string that a payload holds, so no payload can pass for a separator.

Defined cases: a null payload is empty; rows with equal identifier and payload
are records of their own; a null identifier is kept as null, and never the
smallest; null urls are written without target; an empty table gives an
archive without records. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, stored, sums_before

SEGMENT_BYTES = 64 << 10
REVISIT_BYTES = 100
END = "\r\n\r\n"
VERSION = "WARC/1.1"
SEPARATOR = f"{END}{VERSION}\r\n"
#: Bytes of a version string in a payload that stay in the segment that ends there.
_KEEP = 2
DATE = "2024-01-01T00:00:00Z"


def _cuts(column: str, segment_bytes: int) -> F.Column:
    """Segments of a binary payload as an array of (at, to): cut by size, and within version strings."""
    payload = F.col(column)
    text = payload.cast("string")
    pattern = VERSION.replace(".", "[.]")
    # Bytes up to the end of each version string; the last piece ends in none.
    marks = f"transform(split(cast({column} as string), '{pattern}', -1), t -> octet_length(t) + {len(VERSION)})"
    ends = f"zip_with(_p, {sums_before('_p')}, (n, b) -> b + n - {len(VERSION) - _KEEP})"
    raw = F.expr(let("_p", marks, f"slice({ends}, 1, size(_p) - 1)"))
    odd = F.when(text.contains(VERSION), raw).otherwise(F.expr("cast(array() as array<int>)"))
    size = F.octet_length(payload)
    even = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(segment_bytes))
    starts = F.array_sort(F.array_distinct(F.concat(even, odd)))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(size))
    ends = F.when(F.size(starts) > 1, ends).otherwise(F.array(size))
    return F.arrays_zip(starts.alias("at"), ends.alias("to"))


def _header(name: str, value: F.Column) -> F.Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, payload: str = "html", page_id: str = "page_id", url: str = "url", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(record_id, page_id, url, payload, bytes, digest, refers_to): refers_to is set for revisits."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.col("bytes") >= revisit_bytes).groupBy("digest")
    # Only payloads that occur again are looked up; this side is a stored table, so a hot digest's join can be split.
    first = large.agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page")).filter("n > 1").drop("n")
    rows = rows.join(stored(first, "warc-first"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_page")) & F.col("first_page").isNotNull() & (F.col("bytes") >= revisit_bytes), F.col("first_page"))
    rows = rows.withColumn("refers_to", refers)
    return rows.select(F.expr("uuid()").alias("record_id"), "page_id", "url", "payload", "bytes", "digest", "refers_to")


def write_archive(recs: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Writes ``recs`` (of ``records``) as WARC files under ``path``."""
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    rows = recs.withColumn("payload", body).withColumn("cuts", _cuts("payload", segment_bytes))
    rows = rows.withColumn("segments", F.size("cuts")).select("*", F.posexplode("cuts").alias("n", "cut")).drop("cuts")
    rows = rows.withColumn("block", F.expr("substring(payload, cut.at + 1, cut.to - cut.at)"))
    first, last, parted = F.col("n") == 0, F.col("n") == F.col("segments") - 1, F.col("segments") > 1
    revisit = F.col("refers_to").isNotNull()
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    urn = F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.when(first, "").otherwise(F.concat(F.lit("-"), F.col("n"))), F.lit(">"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", urn),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]+", "%20")),
        _header("WARC-Page-ID", F.col("page_id")),
        _header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("digest")))),
        _header("WARC-Payload-Length", F.when(first, F.col("bytes"))),
        _header("WARC-Profile", F.when(first & revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Refers-To-Page-ID", F.when(first, F.col("refers_to"))),
        _header("WARC-Segment-Number", F.when(parted, F.col("n") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(parted & ~first, F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">")))),
        _header("WARC-Segment-Total-Length", F.when(parted & last, F.col("bytes"))),
        _header("Content-Type", F.lit("text/html")),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END),
    )
    value = F.concat(head.cast("binary"), F.col("block")).cast("string")
    rows.select(value.alias("value")).write.option("lineSep", END).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of an archive: one row per segment, in no order.

    (record_id, chunk_no, segmented, type, page_id, url, digest, bytes, refers_to, total, chunk);
    digest, bytes and refers_to stand on chunk 0, total on the last chunk of a segmented record.
    """
    raw = spark.read.schema("value string").option("lineSep", SEPARATOR).text(path)
    # The first record of a file still has its version line, the last one its blank line.
    rows = raw.filter(F.length("value") > 0).select(
        F.regexp_replace(F.substring_index("value", END, 1), r"\AWARC/1\.1\r\n", "").alias("head"),
        F.expr(f"substring(cast(value as binary), octet_length(substring_index(value, '{END}', 1)) + {len(END) + 1})").alias("rest"),
    )

    def field(name: str) -> F.Column:
        found = F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head"), F.lit("\r\n")), rf"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(found != "", found)

    own = F.regexp_replace(field("WARC-Record-ID"), r"^<urn:uuid:|>$", "")
    rows = rows.select(
        F.coalesce(F.regexp_replace(field("WARC-Segment-Origin-ID"), r"^<urn:uuid:|>$", ""), own).alias("record_id"),
        (F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)) - 1).alias("chunk_no"),
        field("WARC-Segment-Number").isNotNull().alias("segmented"), field("WARC-Type").alias("type"), field("WARC-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("digest"), field("WARC-Payload-Length").cast("long").alias("bytes"),
        field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"), field("WARC-Segment-Total-Length").cast("long").alias("total"),
        field("Content-Length").cast("int").alias("length"), "rest",
    )
    chunk = F.expr("substring(rest, 1, length)")
    whole = F.octet_length("rest") >= F.col("length")
    checked = F.when(whole, chunk).otherwise(F.raise_error(F.concat(F.lit("WARC: truncated record "), F.col("record_id"))).cast("binary"))
    return rows.withColumn("chunk", checked).drop("rest", "length")


DIGESTS = "record_id string, chunk_no int, chunk_end long, running string, is_last boolean"


def digests(chunks: DataFrame) -> DataFrame:
    """Each chunk with the payload's length and SHA-256 up to and with it, carried along a record's chunks.

    A record's chunks pass through one task in order; the task holds a chunk
    and the digest's state, never a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, state, at, want = None, hashlib.sha256(), 0, 0
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for rid, no, total, data in zip(b.column(0), b.column(1), b.column(2), b.column(3), strict=True):
                rid, no, total = rid.as_py(), no.as_py(), total.as_py()
                if rid != record:
                    record, state, at, want = rid, hashlib.sha256(), 0, 0
                if no != want:
                    raise ValueError(f"WARC: record {rid} lacks segment {want + 1}")
                piece = data.as_buffer()
                state.update(piece)
                at, want = at + piece.size, want + 1
                if total is not None and total != at:
                    raise ValueError(f"WARC: record {rid} has {at} bytes of {total}")
                for column, x in zip(out, (rid, no, at, state.copy().hexdigest(), total is not None), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(out[4], pa.bool_())], ["record_id", "chunk_no", "chunk_end", "running", "is_last"])

    parts = chunks.select("record_id", "chunk_no", "total", "chunk")
    return parts.repartition("record_id").sortWithinPartitions("record_id", "chunk_no").mapInArrow(run, DIGESTS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, bytes, digest, refers_to) per record, checked against its stored payload.

    Unsegmented payloads are digested where they are read; only the chunks of
    segmented records are brought together.
    """
    chunks = read_chunks(spark, path)
    heads = chunks.filter("chunk_no = 0").select("record_id", "segmented", "type", "page_id", "url", "digest", "bytes", "refers_to", F.sha2("chunk", 256).alias("own"), F.octet_length("chunk").cast("long").alias("own_bytes"))
    ends = digests(chunks.filter("segmented")).filter("is_last").select("record_id", F.col("running").alias("joined"), "chunk_end")
    out = heads.join(ends, "record_id", "left")
    found = F.when(F.col("type") == "revisit", F.col("digest")).when(F.col("segmented"), F.col("joined")).otherwise(F.col("own"))
    size = F.when(F.col("type") == "revisit", F.col("bytes")).when(F.col("segmented"), F.col("chunk_end")).otherwise(F.col("own_bytes"))
    wrong = F.raise_error(F.concat(F.lit("WARC: payload of record "), F.col("record_id"), F.lit(" differs from its header"))).cast("string")
    checked = F.when(found.eqNullSafe(F.col("digest")) & size.eqNullSafe(F.col("bytes")), found).otherwise(wrong)
    return out.select("page_id", "url", F.col("type").alias("record_type"), size.alias("bytes"), checked.alias("digest"), "refers_to")
