"""WARC writing with revisit resolution, and reading the archives back.

Headers are grouped by payload digest, every other record of a digest becomes a
revisit of one response, and the archives are written with fresh headers by
Spark's own text writer, so any store that Spark reaches will do and a lost
executor costs its tasks only. Reading goes by Content-Length from each record
to the next; revisits get their payload's facts from the response they name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.plans.lineage import cut

#: Fixed values of the WARC/1.1 format.
VERSION, PROFILE, RECORD_END = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "\r\n\r\n"
#: Digests that occur more than once are broadcast up to this many; beyond, they are joined by shuffle.
BROADCAST_DIGESTS = 500_000
#: Records of an archive file at most, and its bytes, about.
RECORDS_PER_FILE, FILE_BYTES = 2_000, 64 << 20
#: Records are written by classes of size, each so many times the one before; a file of any class stays near FILE_BYTES.
CLASS_STEP = 32


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary payload; 40 bits of hex at a time are 8 signs."""
    hexed = F.sha1(payload)
    part = lambda k: F.translate(F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[part(k) for k in range(4)])


def resolve(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to.

    Of rows with equal payloads of at least ``least_bytes`` the one with the
    largest key is the response and the others revisit it; shorter payloads are
    all responses. Null payloads are empty. A null key is never the response
    while another row of its payload has a key. Rows that agree in payload and
    largest key (a repeated row) are all responses. Only digests and keys are
    shuffled; texts stay where they are read, whatever their length. Columns of
    ``pages`` that are called like one of the four are replaced; an empty table
    gives no rows.
    """
    raw = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    headed = pages.drop("payload_bytes", "payload_digest", "record_type", "refers_to").withColumn("payload_bytes", F.octet_length(raw).cast("long")).withColumn("payload_digest", base32_sha1(raw))
    groups = headed.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.max(key).alias("__response"), F.count(F.lit(1)).alias("__n"))
    repeated = cut(groups.filter(F.col("__n") > 1).select(F.col("payload_digest").alias("__digest"), F.col("payload_bytes").alias("__bytes"), "__response"), "warc-repeated")
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    joined = headed.join(repeated, (F.col("payload_digest") == F.col("__digest")) & (F.col("payload_bytes") == F.col("__bytes")), "left")
    again = F.col("__response").isNotNull() & ~F.col(key).eqNullSafe(F.col("__response"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("__response"))).drop("__digest", "__bytes", "__response")


def record_id(key: Column) -> Column:
    """A urn:uuid made from the key, the same on every run."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def write_archives(resolved: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z", per_file: int = RECORDS_PER_FILE, compression: str = "none", file_bytes: int = FILE_BYTES) -> None:
    """Write a record for each row of ``resolve``'s result, revisits without their payload.

    The block of a response is an HTTP head and the payload; a revisit keeps the
    head alone and names the response's record and key. Line ends in urls are
    dropped, as headers are lines. Records that are no longer than
    ``file_bytes`` / ``per_file`` share files by ``per_file``; longer ones go to
    files of fewer records, so that no file is much longer than ``file_bytes``
    unless one record is. A table of no rows leaves an empty folder.
    """
    clean = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", "")
    is_new = F.col("record_type") == "response"
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(is_new, F.concat(head, F.coalesce(F.col(payload), F.lit("")))).otherwise(head)
    fields = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col(key))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), clean),
        F.when(F.col(key).isNotNull(), F.concat(F.lit("X-Page-Key: "), F.col(key).cast("string"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(~is_new, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(~is_new, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
        F.when(~is_new, F.concat(F.lit("X-Refers-To-Key: "), F.col("refers_to").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(F.encode(block, "UTF-8")).cast("string")),
    ]
    text = F.concat(F.concat_ws("\r\n", *fields), F.lit("\r\n\r\n"), block)
    bounds = [max(1, file_bytes // per_file)]
    while bounds[-1] < file_bytes:
        bounds.append(bounds[-1] * CLASS_STEP)
    size = F.when(is_new, F.col("payload_bytes")).otherwise(F.lit(0).cast("long"))
    kind = sum((F.when(size > b, 1).otherwise(0) for b in bounds), F.lit(0))
    kinds = sorted(r[0] for r in resolved.select(kind.alias("kind")).distinct().collect())  # a few numbers
    for k in kinds or [0]:
        most = max(1, file_bytes // bounds[k]) if k < len(bounds) else 1
        resolved.filter(kind == k).select(text.alias("value")).write.mode("append").option("lineSep", RECORD_END).option("maxRecordsPerFile", most).option("compression", compression).text(path)


def records(content: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Headers and block of each record of an archive, in order; raises where the file doesn't hold to the format."""
    at, view = 0, memoryview(content)
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split("\r\n") if end >= 0 else [""]
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        stop = end + 4 + int(head["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        yield head, view[end + 4 : stop]
        at = stop + 4


_READ = pa.schema([("record_type", pa.string()), ("key", pa.string()), ("refers_to", pa.string()), ("stated", pa.string()), ("payload", pa.binary()), ("url", pa.string())])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            held = 0
            for head, block in records(content.as_py()):
                raw = bytes(block)
                body = raw[raw.index(b"\r\n\r\n") + 4 :]
                rows.append((head["WARC-Type"], head.get("X-Page-Key"), head.get("X-Refers-To-Key"), head["WARC-Payload-Digest"].removeprefix("sha1:"), body if head["WARC-Type"] == "response" else None, head["WARC-Target-URI"]))
                held += len(body)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_type, key, refers_to, stated (digest in the header), payload (null for revisits), url."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.col("length") > 0).select("content")
    return files.mapInArrow(_parse, "record_type string, key string, refers_to string, stated string, payload binary, url string")


def resolved_records(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, revisits by way of their response.

    The digest of a response is taken anew from its payload; one that differs
    from its header fails the job, as does a revisit whose response is missing.
    """
    read = read_archives(spark, path)
    digest = base32_sha1(F.col("payload"))
    facts = cut(read.select("record_type", F.col("key").cast(key_type).alias("page_id"), F.col("refers_to").cast(key_type).alias("refers_to"), "stated", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("digest")), "warc-facts")
    wrong = F.raise_error(F.concat(F.lit("payload digest differs from its header, page "), F.col("page_id").cast("string")))
    responses = facts.filter("record_type = 'response'").select("page_id", "payload_bytes", F.when(F.col("digest") == F.col("stated"), F.col("digest")).otherwise(wrong).alias("payload_digest"), "record_type", "refers_to")
    wanted = facts.filter("record_type = 'revisit'").select(F.col("stated").alias("payload_digest")).distinct()
    originals = facts.filter("record_type = 'response'").join(F.broadcast(wanted) if wanted.count() <= BROADCAST_DIGESTS else wanted, F.col("stated") == F.col("payload_digest"), "left_semi").groupBy(F.col("digest").alias("__digest")).agg(F.max("payload_bytes").alias("__bytes"))
    if originals.count() <= BROADCAST_DIGESTS:
        originals = F.broadcast(originals)
    missing = F.raise_error(F.concat(F.lit("no response for the revisit of page "), F.col("page_id").cast("string")))
    revisits = facts.filter("record_type = 'revisit'").join(originals, F.col("stated") == F.col("__digest"), "left").select("page_id", F.coalesce(F.col("__bytes"), missing).alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(revisits)
