"""WARC archives as a table of chunks.

An archive is kept as rows (archive, record_id, chunk, data, running_sha1). Chunk 0 is the
header of a record, chunks 1 to n its payload in pieces of at most `CHUNK` bytes, and the last
chunk its end; the data of a record's rows in order are its bytes in the file, and the records
of an archive in order are the file. Headers and pieces are made by SQL functions; Python gets
single pieces and hashes them, never a whole record. running_sha1 is the digest of the
payload up to and with the row; readers check every piece against it.

Every row of pages is a record. Rows that are equal in page_id, url and html are numbered in their
records' names, and all are responses or revisits alike. Urls come back as they were, null and
empty ones apart; a null html is an empty payload. Columns of other names play no part.
"""

from __future__ import annotations

import base64
import hashlib
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.storage import stored

CHUNK = 64 << 10
#: Payloads at least this long are written once; others refer to them.
MIN_REVISIT_BYTES = 0
DATE = "2020-01-01T00:00:00Z"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, sha1, payload_bytes, refers_to, record_id, refers_id) per row of pages, sha1 as
    bytes; refers_to is the largest page_id of an equal payload, null for that page itself and for
    short payloads, and refers_id a record of it. A null page_id can't be referred to."""
    payload = F.coalesce("html", F.lit(""))
    digest = F.sha1(payload.cast("binary"))
    number = F.col("page_id").cast("long")
    named = pages.select(
        number.alias("page_id"),
        F.unhex(digest).alias("sha1"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        record_name(number, digest, F.col("url")).alias("record_id"),
    )
    target = F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id")))
    largest = named.groupBy("sha1").agg(target.alias("largest"), F.count("*").alias("n")).where("n > 1")
    joined = named.join(largest.drop("n"), "sha1", "left")
    again = (F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest.page_id"))
    return joined.select(
        "page_id",
        "sha1",
        "payload_bytes",
        F.when(again, F.col("largest.page_id")).alias("refers_to"),
        "record_id",
        F.when(again, F.col("largest.record_id")).alias("refers_id"),
    )


def record_name(page_id, sha1, url):
    """The name of a record; page_id and the payload's digest (hex, lower case) can be read from
    it. Of the url it has the md5."""
    page, address = F.coalesce(page_id.cast("string"), F.lit("none")), F.coalesce(F.md5(url), F.lit("none"))
    return F.concat(F.lit("urn:page:"), page, F.lit(":"), sha1, F.lit(":"), address)


def _base32(sha1):
    """Upper-case base 32 of a SHA-1 in hex: 20 bits are five hex digits and four of base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _escaped(url):
    """The url with the characters that could end a header line, and %, percent-encoded."""
    for character in ["%", *map(chr, range(0x21)), "\x7f"]:
        url = F.replace(url, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return url


def _header():
    """The header of a record, from its narrow columns only."""
    end, revisit = "\r\n", F.col("refers_id").isNotNull()
    profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    size = F.col("payload_bytes").cast("string")
    lines = F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{end}WARC-Record-ID: <"),
        F.col("record_id"),
        F.lit(f">{end}WARC-Date: {DATE}{end}WARC-Payload-Digest: sha1:"),
        _base32(F.split("record_id", ":")[3]),
        F.lit(f"{end}X-Payload-Bytes: "),
        size,
        F.coalesce(F.concat(F.lit(f"{end}WARC-Target-URI: "), _escaped(F.col("url"))), F.lit("")),
        F.when(revisit, F.concat(F.lit(f"{end}{profile}{end}WARC-Refers-To: <"), F.col("refers_id"), F.lit(">"))).otherwise(""),
        F.lit(f"{end}Content-Length: "),
        F.when(revisit, "0").otherwise(size),
        F.lit(end + end),
    )
    return lines.cast("binary")


def _running(batches):
    """Adds the digest of each record's payload so far. The rows of a record follow each other."""
    record, digest = None, None
    for batch in batches:
        names, kinds, pieces = (batch.column(c) for c in ("record_id", "kind", "data"))
        out = []
        for at in range(batch.num_rows):
            name = names[at].as_py()
            if name != record:
                record, digest = name, hashlib.sha1()
            if kinds[at].as_py() == 1:
                digest.update(pieces[at].as_buffer())
            out.append(digest.digest())
        columns = [batch.column(c) for c in ("archive", "record_id", "chunk", "data")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(out, pa.binary())], ["archive", "record_id", "chunk", "data", "running_sha1"]
        )


def _piece(payload, chunk):
    """Header, piece `chunk` of the payload, or the end of a record."""
    whole, start = F.octet_length(payload), (chunk - 1) * CHUNK
    data = (
        F.when(chunk == 0, _header())
        .when(start < whole, F.substring(payload, start + 1, F.lit(CHUNK)))
        .otherwise(F.lit(b"\r\n\r\n"))
    )
    kind = F.when(chunk == 0, 0).when(start < whole, 1).otherwise(2)
    return F.struct(kind.alias("kind"), data.alias("data"))


def chunk_rows(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The chunk table of the records of `pages` (columns page_id, url, html). Payloads are
    shuffled once: the join finds them already dealt and sorted by record_id."""
    revisits = plan_records(pages, min_bytes).where("refers_id IS NOT NULL").select("record_id", "refers_id")
    revisits = revisits.groupBy("record_id").agg(F.max("refers_id").alias("refers_id"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    name = record_name(F.col("page_id"), F.sha1(F.col("html").cast("binary")), F.col("url"))
    own = own.groupBy(name.alias("record_id")).agg(
        F.first("url").alias("url"), F.first("html").alias("html"), F.count("*").alias("copies")
    )
    size = F.octet_length("html").cast("long").alias("payload_bytes")
    payload = F.when(F.col("refers_id").isNull(), F.col("html")).otherwise("").cast("binary")
    named = own.join(revisits, "record_id", "left").select(
        F.explode(F.expr("sequence(1L, copies)")).alias("copy"), "record_id", "url", size, "refers_id", payload.alias("payload")
    )
    # Copies are equal rows; a record is named by its number among them, and revisits name the first.
    named = named.withColumn("record_id", F.concat("record_id", F.lit(":"), "copy"))
    named = named.withColumn("refers_id", F.concat("refers_id", F.lit(":1")))
    # One list of all pieces: the payload is taken from its row once, not for each of them.
    last = f"cast((octet_length(payload) + {CHUNK - 1}) div {CHUNK} AS int) + 1"
    numbers = F.expr(f"sequence(0, {last})")
    pieces = F.transform(F.array("payload"), lambda p: F.transform(numbers, lambda chunk: _piece(p, chunk)))[0]
    cut = named.select("record_id", F.posexplode(pieces).alias("chunk", "piece"))
    rows = cut.select(F.spark_partition_id().alias("archive"), "record_id", "chunk", "piece.kind", "piece.data")
    return rows.mapInArrow(_running, "archive int, record_id string, chunk int, data binary, running_sha1 binary")


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    chunk_rows(pages, min_bytes).write.parquet(path)


class _Reader:
    """Takes the rows of records one by one and checks each piece against its digest."""

    def __init__(self):
        self.record = None

    def expects(self, record, chunk) -> bool:
        """Whether the row begins a record or follows the row before it."""
        return chunk == 0 or (record == self.record and chunk == self.chunk + 1)

    def take(self, record, chunk, data, running):
        """A record's result at its last row, else None."""
        self.chunk = chunk
        if chunk == 0:
            lines = data.to_pybytes().decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError("a record does not begin with its version line")
            self.head = dict(line.split(": ", 1) for line in lines[1:] if line)
            self.record, self.left, self.digest = record, int(self.head["Content-Length"]), hashlib.sha1()
        elif self.left:
            self.digest.update(data)
            self.left -= len(data)
            if self.digest.digest() != running:
                raise ValueError(f"a chunk of {record} differs from its digest")
        else:
            if data.to_pybytes() != b"\r\n\r\n":
                raise ValueError(f"{record} has no end")
            self.record = None
            return self.result()

    def result(self):
        head = self.head
        named = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and base64.b32encode(self.digest.digest()).decode() != named:
            raise ValueError(f"the payload of {head['WARC-Record-ID']} differs from its digest")
        refers, url = head.get("WARC-Refers-To"), head.get("WARC-Target-URI")
        return (
            _page_of(head["WARC-Record-ID"]),
            None if url is None else unquote(url),
            int(head["X-Payload-Bytes"]),
            named,
            head["WARC-Type"],
            _page_of(refers) if refers else None,
        )


def _page_of(urn):
    number = urn.strip("<>").split(":")[2]
    return None if number == "none" else int(number)


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _parsed(whole: bool):
    """One row per record whose rows follow each other in order. Of others the name, as `cut`;
    where records have to be whole they fail the job."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [*(c.split()[0] for c in RECORD.split(", ")), "cut"]

    def cut(record):
        if whole:
            raise ValueError(f"rows of {record} are missing")
        return (None,) * 6 + (record,)

    def batch_of(out):
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches):
        reader, last = _Reader(), None
        for batch in batches:
            out = []
            records, numbers, pieces, running = (batch.column(c) for c in ("record_id", "chunk", "data", "running_sha1"))
            for at in range(batch.num_rows):
                record, chunk = records[at].as_py(), numbers[at].as_py()
                if not reader.expects(record, chunk) or (chunk == 0 and reader.record is not None):
                    if reader.record not in (None, record):
                        out.append(cut(reader.record))
                    if chunk:
                        if record != last:
                            out.append(cut(record))
                        reader.record, last = None, record
                        continue
                found = reader.take(record, chunk, pieces[at].as_buffer(), running[at].as_py())
                if found:
                    out.append((*found, None))
            yield batch_of(out)
        if reader.record is not None:
            yield batch_of([cut(reader.record)])

    return run


def read_archives(spark, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record. A
    damaged record fails the job, also one without all its rows.

    Records are read where they lie. Only those that a border between two tasks cuts, about one a
    task, are read again and brought together by a shuffle."""
    schema = "archive int, record_id string, chunk int, data binary, running_sha1 binary"
    rows = spark.read.schema(schema).parquet(path).drop("archive")
    found = stored(rows.mapInArrow(_parsed(False), f"{RECORD}, cut string"), "records")
    cut = stored(found.where("cut IS NOT NULL").select(F.col("cut").alias("record_id")).distinct(), "cut_records")
    ordered = rows.join(cut, "record_id", "left_semi").repartition("record_id").sortWithinPartitions("record_id", "chunk")
    joined = ordered.mapInArrow(_parsed(True), f"{RECORD}, cut string")
    return found.where("cut IS NULL").unionByName(joined).drop("cut")
