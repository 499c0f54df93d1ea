"""A content-addressed archive of WARC records: payload bytes once, exact record headers apart."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.shared import stored

#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
END = b"\r\n\r\n"


class ArchiveError(ValueError):
    """Bytes of an archive are not what their digests say."""


def base32(sha1: Column) -> Column:
    """A hexadecimal SHA-1 in base32: 20 bits are five digits of the one and four of the other."""
    parts = [F.lpad(F.conv(F.substring(sha1, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _field(name: str, value: Column) -> Column:
    """A header line; none where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Writes one WARC record per row of ``pages`` (page_id, url, html) as two tables.

    ``payloads`` has the bytes of each different payload once, under its SHA-256; ``records`` the
    exact bytes before and after the payload, its address, and whether the record holds it. Of the
    records with one payload of ``min_bytes`` or more that with the largest page_id is a response and
    the others revisit it; smaller ones are all responses.

    A NULL html is an empty payload, a NULL url leaves its line out, line breaks in a url are
    percent-encoded. A NULL page_id is less than all others. Rows that repeat the largest page_id
    of a payload are all responses. Other columns are ignored; no rows make an archive of no
    records. Only addresses and ids move for the headers; a payload moves once, after equal
    ones of a task have become one. A payload that a third of all rows have is one row after that,
    and the join that gives the rows their header can be split by adaptive execution.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    found = pages.select("page_id", "url", body.alias("payload"))
    addressed = found.withColumn("address", F.unhex(F.sha2("payload", 256)))
    measured = addressed.select(
        "address", "page_id", "payload", F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    once = measured.groupBy("address").agg(
        F.first("payload").alias("payload"), F.max("page_id").alias("newest"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("sha1", "bytes") for f in (F.min, F.max)],
    )
    # Equal addresses must be equal in a second digest and in length too.
    sure = (F.col("min_sha1") == F.col("max_sha1")) & (F.col("min_bytes") == F.col("max_bytes"))
    clash = F.raise_error(F.concat(F.lit("two payloads at "), F.hex("address")))
    once.select(
        "address", F.when(sure, F.col("payload")).otherwise(clash.cast("binary")).alias("payload"),
        "newest", F.col("min_bytes").alias("bytes"), F.col("min_sha1").alias("sha1"),
    ).write.parquet(f"{folder}/payloads")

    held = spark.read.parquet(f"{folder}/payloads").select("address", "newest", "bytes", "sha1")
    joined = addressed.select("address", "page_id", "url").join(held, "address").select(
        "*", ((F.col("bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("newest")))
        .alias("inline"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
        ).alias("http"),
    )
    inline = F.col("inline")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.octet_length("http") + F.when(inline, F.col("bytes")).otherwise(0)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(inline, "response").otherwise("revisit")),
        _field("WARC-Record-ID", _urn(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _field("WARC-Profile", F.when(~inline, PROFILE)),
        _field("WARC-Refers-To", F.when(~inline, _urn(F.col("newest")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length.cast("string")),
        F.lit("\r\n"), F.col("http"),
    )
    joined.select(
        "address", "inline", F.encode(head, "UTF-8").alias("head"), F.lit(END).alias("tail")
    ).write.parquet(f"{folder}/records")


def rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """The records byte by byte: (address, record). Only those that hold a payload meet one."""
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads").select("address", "payload")
    whole = records.filter("inline").join(payloads, "address")
    bare = records.filter("NOT inline")
    return whole.select("address", F.concat("head", "payload", "tail").alias("record")).unionByName(
        bare.select("address", F.concat("head", "tail").alias("record"))
    )


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of one record and the payload in its block; ArchiveError if it is none."""
    end = record.find(END) + len(END)
    version, *lines = record[:max(0, end - len(END))].decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ArchiveError("a record without its version")
    fields = dict(line.split(": ", 1) for line in lines)
    block = record[end:-len(END)]
    if len(block) != int(fields["Content-Length"]) or not record.endswith(END):
        raise ArchiveError(f"{fields.get('WARC-Record-ID')}: a block of another length")
    return fields, block[block.find(END) + len(END):]


def read_records(records: DataFrame) -> DataFrame:
    """(address, page_id, record_type, payload_digest, payload_bytes, refers_to) of rebuilt records.

    Payloads in responses are hashed again and must fit both their header and their address. A
    revisit has no payload of its own, so its payload_bytes are NULL.
    """
    schema = T.StructType([
        T.StructField("address", T.BinaryType()), T.StructField("page_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()), T.StructField("refers_to", T.LongType()),
    ])

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(number) if number else None

    def read(address: bytes, record: bytes) -> tuple:
        fields, payload = parse(record)
        kind = fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (
            digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()
            or address != hashlib.sha256(payload).digest()
        ):
            raise ArchiveError(f"{fields['WARC-Record-ID']}: a payload of another digest")
        return (
            address, page(fields["WARC-Record-ID"]), kind, digest,
            len(payload) if kind == "response" else None, page(fields.get("WARC-Refers-To")),
        )

    def run(batches) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            made = [read(a.as_py(), r.as_py()) for a, r in zip(*batch.columns)]
            columns = list(zip(*made)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names
            )

    return records.select("address", "record").mapInArrow(run, schema)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive, read from its rebuilt bytes, with the facts of its full payload.

    A revisit takes the size from the response with its address and must have its digest. Columns:
    page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    read = stored(read_records(rebuild(spark, folder)), "warc-read")
    responses = read.filter("record_type = 'response'")
    facts = responses.groupBy("address").agg(
        F.max("payload_bytes").alias("_bytes"), F.max("payload_digest").alias("_digest")
    )
    revisits = read.filter("record_type = 'revisit'").join(facts, "address", "left")
    wrong = F.raise_error(F.concat(F.lit("a revisit without its response at "), F.hex("address")))
    found = F.when(F.col("_digest") == F.col("payload_digest"), F.col("_bytes"))
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return responses.select(*columns).unionByName(
        revisits.withColumn("payload_bytes", F.coalesce(found, wrong.cast("long"))).select(*columns)
    )
