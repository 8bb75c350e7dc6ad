"""Content-addressed WARC archive: payloads once by digest, record headers apart.

``write_archive`` stores two tables: ``payloads`` (sha256, payload), each distinct payload
once, and ``records`` (page_id, sha256, the exact header bytes of the record).
``read_archive`` joins the two, which gives back the complete records byte for byte, and takes what
it says of a payload from there: it cuts the block out of the rebuilt record by its Content-Length,
the payload out of the block, and verifies both digests. A revisit has the payload of the
record that it refers to.

Of the records with equal payloads the one with the smallest page_id is a ``response``, the
others are ``revisit`` records that refer to it and carry no block of their own.

Defined results: null html is an empty payload; a null url leaves out WARC-Target-URI, and
characters below U+0021 in a url are percent-encoded, so no header can be forged; a null
page_id comes after all others and is written as "none"; of rows with equal page_id and payload
the one with the least url is the response, the others revisit it, each under a record id of its own; an
empty table gives an empty archive. Only the
three named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WARC 1.1 names and the base32 alphabet of RFC 4648 beside the digits of conv().
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

#: Payloads below this many bytes are never deduplicated.
MIN_REVISIT_BYTES = 0
CAPTURED = "2024-01-01T00:00:00Z"

RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("sha256", T.StringType()),
    T.StructField("header", T.StringType())])
PAYLOADS = T.StructType([
    T.StructField("sha256", T.StringType()), T.StructField("payload", T.BinaryType())])


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as bare upper-case base32: 20 bits at a time, as four digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def _record_uri(page_id: Column, sha256: Column, url: Column, copy: Column) -> Column:
    """A name of one record only, also among rows that share a page_id."""
    rest = F.md5(F.concat_ws("|", sha256, F.coalesce(url, F.lit(""))).cast("binary"))
    return F.concat(F.lit("<urn:tallyroom:page:"),
                    F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), rest, F.lit(":"),
                    copy.cast("string"), F.lit(">"))


def _safe_url(url: Column) -> Column:
    for code in range(33):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _header(kind: Column, uri: Column, url: Column, first_uri: Column, digest: Column,
            n_bytes: Column) -> Column:
    """The record header and, for a response, its HTTP header, up to the payload."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          f"Content-Length: "), n_bytes.cast("string"), F.lit(CRLF * 2))
    revisit = kind == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    block = F.when(revisit, F.lit(0)).otherwise(F.length(http) + n_bytes)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind),
        line("WARC-Record-ID", uri),
        F.coalesce(line("WARC-Target-URI", _safe_url(url)), F.lit("")),
        line("WARC-Date", F.lit(CAPTURED)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, F.concat(line("WARC-Refers-To", first_uri),
                                 line("WARC-Profile", F.lit(REVISIT_PROFILE))))
        .otherwise(line("Content-Type", F.lit("application/http;msgtype=response"))),
        line("Content-Length", block.cast("string")), F.lit(CRLF),
        F.when(revisit, F.lit("")).otherwise(http))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> None:
    """Write the archive of ``pages`` into the new folder ``path``.

    The payload store is one aggregate by SHA-256: map tasks send a payload once
    however many copies they hold. The records are narrow rows, equal ones counted in the map
    tasks, joined to the first row of their payload; a payload that a third of all pages share makes one
    row there on the aggregated side, and the other side may be split.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "utf-8")
    rows = (pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
                         F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
            .withColumn("sha256", F.sha2("payload", 256)))
    known = F.struct(F.col("page_id").isNull().alias("unknown"), F.col("page_id").alias("id"),
                     F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))
    # Two digests of different strength must agree before payloads count as equal.
    store = (rows.groupBy("sha256")
             .agg(F.first("payload").alias("payload"), F.min(known).alias("first"),
                  F.min(F.sha1("payload")).alias("least"), F.max(F.sha1("payload")).alias("most"))
             .withColumn("payload", F.when(F.col("least") == F.col("most"), F.col("payload"))
                         .otherwise(F.raise_error(F.lit("equal SHA-256, different SHA-1"))))
             .withColumn("digest", base32_sha1(F.col("payload")))
             .withColumn("n_bytes", F.length("payload"))
             .select("sha256", "payload", "first.id", F.col("first.url").alias("first_url"), "digest",
                     "n_bytes"))
    store.write.parquet(f"{path}/payloads")
    firsts = (spark.read.parquet(f"{path}/payloads")
              .select("sha256", F.col("id").alias("first"), "first_url", "digest", "n_bytes"))
    narrow = (rows.groupBy("page_id", "url", "sha256").agg(F.count(F.lit(1)).alias("copies"))
              .select("page_id", "url", "sha256",
                      F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")))
    own = (F.col("page_id").eqNullSafe(F.col("first")) & F.col("url").eqNullSafe(F.col("first_url"))
           & (F.col("copy") == 1))
    kind = F.when(own | (F.col("n_bytes") < MIN_REVISIT_BYTES), F.lit("response")).otherwise(
        F.lit("revisit"))
    (narrow.join(firsts, "sha256").withColumn("kind", kind)
     .select("page_id", "sha256",
             _header(F.col("kind"),
                     _record_uri(F.col("page_id"), F.col("sha256"), F.col("url"), F.col("copy")),
                     F.col("url"),
                     _record_uri(F.col("first"), F.col("sha256"), F.col("first_url"), F.lit(1)),
                     F.col("digest"), F.col("n_bytes")).alias("header"))
     .write.parquet(f"{path}/records"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?m)^{name}: ([^\r\n]*)", 1)


def _checked(right: Column, value: Column, message: Column) -> Column:
    return F.when(right, value).otherwise(F.raise_error(message))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records: page_id, header, payload, ``record``, and what the archive says of them.

    ``record`` is the record byte for byte, with the payload left out of a revisit. ``payload``,
    ``payload_bytes`` and ``payload_digest`` are cut out of the record, for revisits out of the one
    they refer to. A payload that has not its digests fails the read.
    """
    end = F.lit(CRLF * 2).cast("binary")
    records = spark.read.schema(RECORDS).parquet(f"{path}/records").withColumn(
        "record_type", _field("WARC-Type"))
    stored = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads").withColumnRenamed(
        "payload", "stored")
    # One response for each payload, rebuilt. Its block starts behind the first empty line of the
    # header, its payload behind the second.
    start = F.octet_length(F.substring_index("header", CRLF * 2, 1)) + 4
    first = (records.where("record_type = 'response'").groupBy("sha256")
             .agg(F.min("header").alias("header")).join(stored, "sha256")
             .withColumn("whole", F.concat(F.col("header").cast("binary"), "stored", end))
             .withColumn("block", F.substring(F.col("whole"), start + 1,
                                              _field("Content-Length").cast("int")))
             .withColumn("payload", F.substring(
                 F.col("block"), F.octet_length("header") - start + 1, F.length("block")))
             .withColumn("digest", base32_sha1(F.col("payload")))
             .withColumn("digest", _checked(
                 (F.sha2("payload", 256) == F.col("sha256"))
                 & (F.concat(F.lit("sha1:"), F.col("digest")) == _field("WARC-Payload-Digest")),
                 F.col("digest"), F.concat(F.lit("damaged payload "), F.col("sha256"))))
             .select("sha256", "payload", F.length("payload").cast("bigint").alias("payload_bytes"),
                     F.col("digest").alias("payload_digest")))
    said = _field("WARC-Payload-Digest")
    refers = F.regexp_extract(_field("WARC-Refers-To"), r"^<urn:tallyroom:page:(-?\d+):", 1)
    return (
        records.join(first, "sha256")
        .withColumn("payload_digest", _checked(
            F.concat(F.lit("sha1:"), F.col("payload_digest")) == said, F.col("payload_digest"),
            F.concat(F.lit("header and payload differ: "), said)))
        .withColumn("refers_to", F.when(refers != "", refers.cast("bigint")))
        .withColumn("record", F.concat(
            F.col("header").cast("binary"),
            F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload")), end)))
