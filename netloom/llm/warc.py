"""Web archives: records written as gzip streams, and a normaliser that gives every record a member of its own.

Spark's text writer makes the raw archives: a part is one gzip stream over all its records, as crawlers that
compress whole files leave them. The normaliser inflates such a stream once, piece by piece, finds the records by their
lengths, deflates each as a member and notes in a sidecar index where it lies. A record is then read by inflating its member alone.

Archives are cut to a bounded size when they are written, so a task holds one compressed archive, not a corpus.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.session import Stages

_DATE = "2000-01-01T00:00:00Z"
ARCHIVE_BYTES = 16 << 20  # of records, before compression
_READ = 1 << 16


def gzip_member(data: bytes) -> bytes:
    """``data`` as one gzip member, without name or time."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class Records:
    """Cuts an inflated stream, given in pieces, into records: a header, the length it names, and two line ends."""

    def __init__(self):
        self.buffer = bytearray()

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.buffer += data
        at = 0
        while (record := self._length(at)) is not None:
            yield bytes(self.buffer[at : at + record])
            at += record
        del self.buffer[:at]

    def _length(self, at: int) -> int | None:
        end = self.buffer.find(b"\r\n\r\n", at)
        if end < 0:
            return None
        total = end - at + 4 + int(header_fields(bytes(self.buffer[at:end]))["content-length"]) + 4
        return total if at + total <= len(self.buffer) else None

    def close(self) -> None:
        if self.buffer.strip():
            raise ValueError("the archive ends inside a record")


def header_fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record begins with {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and content of a record."""
    end = record.index(b"\r\n\r\n")
    return header_fields(record[:end]), record[end + 4 : -4]


def normalise(stream: bytes) -> Iterator[tuple[int, bytes, dict[str, str]]]:
    """(offset, member, header fields) of the records in a gzip file of one or more members, rewritten one member each."""
    records, offset, data, at = Records(), 0, stream, 0
    inflate = zlib.decompressobj(31)
    while at < len(data) or inflate.unconsumed_tail:
        piece = inflate.unconsumed_tail or data[at : at + _READ]
        if not inflate.unconsumed_tail:
            at += len(piece)
        for record in records.feed(inflate.decompress(piece, 1 << 20)):
            member = gzip_member(record)
            yield offset, member, parse_record(record)[0]
            offset += len(member)
        if inflate.eof:
            rest = inflate.unused_data
            data, at = rest + data[at:], 0
            if not data.strip(b"\0"):
                break
            inflate = zlib.decompressobj(31)
    records.close()


# --- on Spark ---------------------------------------------------------------------------------------


def text_cell(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[\r\n]+", " ")


def digest_32(payload: Column) -> Column:
    """Base-32 SHA-1 of a binary column: its 160 bits in 32 groups of five."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    sha = F.sha1(payload)
    out = []
    for n in range(4):  # ten hexadecimal digits are eight letters
        number = F.conv(F.substring(sha, 10 * n + 1, 10), 16, 10).cast("long")
        for k in range(8):
            five = F.shiftright(number, 35 - 5 * k).bitwiseAND(F.lit(31)).cast("int")
            out.append(F.substring(F.lit(letters), five + 1, F.lit(1)))
    return F.concat(*out)


def plan_records(
    pages: DataFrame, stages: Stages, least_bytes: int = 0, id_col: str = "page_id", payload_col: str = "html"
) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, refers_to) of every row; ``refers_to`` is null for those written in full."""
    payload = whole_text(pages, payload_col)
    facts = stages.store(
        "facts",
        pages.select(
            column(pages, id_col).alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"),
            digest_32(payload.cast("binary")).alias("payload_digest"), F.sha2(payload, 256).alias("sha"),
        ),
    )
    # Of equal payloads (by digest of 256 bits and length) the largest id; null ids are smaller than all others.
    leaders = stages.store(
        "leaders",
        facts.where(F.col("payload_bytes") >= least_bytes).groupBy("sha", "payload_bytes").agg(F.max("page_id").alias("leader")),
    )
    return facts.join(leaders, ["sha", "payload_bytes"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "sha",
        F.when(F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader")), F.col("leader")).alias("refers_to"),
    )


def record_text(kind: str, page_id: Column, url: Column, digest: Column, extra: list[Column], content: Column) -> Column:
    """A record but for its last line end, which the text writer adds."""
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), content)
    fields = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"), page_id, F.lit(f">\r\nWARC-Date: {_DATE}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest, *extra,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n"),
    ]
    return F.concat(*fields)


def write_raw(pages: DataFrame, plan: DataFrame, path: str, url_col: str = "url", id_col: str = "page_id", payload_col: str = "html") -> None:
    """Raw archives below ``path``: every part is one gzip stream. Only payloads that are written in full are moved."""
    payload = whole_text(pages, payload_col)
    rows = pages.select(
        column(pages, id_col).alias("page_id"), text_cell(column(pages, url_col)).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("sha"),
    )
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    written = F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(0) + 512
    mean = plan.agg(F.avg(written)).first()[0] or ARCHIVE_BYTES
    kept = plan.select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "payload_digest", "refers_to").distinct()
    joined = rows.join(kept, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")))
    refers = F.concat(
        F.lit("\r\nWARC-Refers-To: <urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Payload-Length: "),
        F.octet_length("payload").cast("string"),
    )
    full = record_text("response", key, F.col("url"), F.col("payload_digest"), [], F.col("payload"))
    short = record_text("revisit", key, F.col("url"), F.col("payload_digest"), [refers], F.lit(""))
    joined.select(F.when(F.col("refers_to").isNull(), full).otherwise(short).alias("value")).write.options(
        compression="gzip", lineSep="\r\n", maxRecordsPerFile=max(1, int(ARCHIVE_BYTES / mean))
    ).text(path)


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (archive, content, entries) of raw archives (path, content): the new file, and where each record lies in it."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            members, entries = [], []
            for offset, member, fields in normalise(content.as_py()):
                members.append(member)
                entries.append({"offset": offset, "size": len(member), "record_id": fields["warc-record-id"]})
            name = hashlib.sha1(path.encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([b"".join(members)], pa.binary()), pa.array([entries], _ENTRIES)],
                names=["archive", "content", "entries"],
            )


_ENTRIES = pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64()), ("record_id", pa.string())]))
_ENTRY = "array<struct<offset: bigint, size: bigint, record_id: string>>"


def normalise_archives(spark: SparkSession, raw: str, archives: str, index: str, stages: Stages) -> None:
    """Rewrite all gzip files below ``raw``: files with one member per record below ``archives``, and the offset index ``index``.

    Every archive is a file in a folder of its name; a zero byte ends it, which gzip readers pass over. The index is a table of tab-separated
    (archive, nth, offset, size, record id).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).select("path", "content")
    done = stages.store("normalised", files.mapInArrow(_normalised, f"archive string, content binary, entries {_ENTRY}"))
    stages.drop("raw")
    done.select("archive", F.col("content").cast("string").alias("value")).write.partitionBy("archive").options(
        lineSep="\0", maxRecordsPerFile=1
    ).text(archives)
    done.select("archive", F.posexplode("entries").alias("nth", "e")).select("archive", "nth", "e.*").write.csv(index, sep="\t")
    stages.drop("normalised")


_INDEX = "archive string, nth bigint, offset bigint, size bigint, record_id string"
_FOUND = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "url"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of archives (content, entries), each inflated from its own member."""
    for batch in batches:
        for content, entries in zip(batch.column(0), batch.column(1).to_pylist()):
            data, out = content.as_py(), []
            for entry in entries:
                record = zlib.decompress(data[entry["offset"] : entry["offset"] + entry["size"]], 31)
                fields, block = parse_record(record)
                if fields["warc-record-id"] != entry["record_id"]:
                    raise ValueError("the index names another record")
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "revisit":
                    length = int(fields["warc-payload-length"])
                else:
                    length = len(payload)
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{fields['warc-record-id']} is damaged")
                out.append((
                    entry["record_id"], fields["warc-type"], fields.get("warc-refers-to"), length, digest, fields["warc-target-uri"],
                ))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_FOUND)


def read_archives(spark: SparkSession, archives: str, index: str) -> DataFrame:
    """(record_id, record_type, refers_to, payload_bytes, payload_digest, url) of all records that the index lists."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archives).select("archive", "content")
    entries = spark.read.schema(_INDEX).csv(index, sep="\t").groupBy("archive").agg(
        F.sort_array(F.collect_list(F.struct("offset", "size", "record_id"))).alias("entries")
    )
    schema = "record_id string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, url string"
    return files.join(entries, "archive").select("content", "entries").mapInArrow(_read, schema)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html), normalise the archives and read them back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, url. Of rows with equal payloads of at least ``least_bytes``
    bytes, that with the largest page_id is written in full and the others point to it; rows that repeat it are written in full too. Null
    and empty payloads are payloads of 0 bytes. A null page_id is smaller than all others, and comes back null. Line breaks in a url
    become spaces, a null url is empty. An empty table gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # an archive is a batch
    stages = Stages(spark, "warc")
    plan = plan_records(pages, stages, least_bytes)
    kind = plan.schema["page_id"].dataType
    raw, archives, index = (stages.folder(n) for n in ("raw", "archives", "index"))
    if plan.isEmpty():
        return spark.createDataFrame([], T.StructType([
            T.StructField("page_id", kind), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
            T.StructField("record_type", T.StringType()), T.StructField("refers_to", kind), T.StructField("url", T.StringType()),
        ]))
    write_raw(pages, plan, raw)
    stages.drop("facts", "leaders")
    normalise_archives(spark, raw, archives, index, stages)
    found = stages.store("read", read_archives(spark, archives, index))
    stages.drop("archives", "index")
    own_id = lambda c: F.nullif(F.regexp_extract(c, "<urn:page:(.*)>", 1), F.lit("")).cast(kind)
    return found.select(
        own_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        own_id(F.col("refers_to")).alias("refers_to"), F.col("url"),
    )
