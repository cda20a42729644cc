"""A content-addressed web archive.

Payload bytes are stored once per SHA-256 digest; the exact header block of every record is kept in a table of its own. The
original records come back through a join of the two, and every stored payload is digested again on the way.

Defined results: a null payload is the empty payload; of records with equal payloads those with the smallest page_id are
responses (repeated rows of that page included) and all others revisit it; a null page_id counts as larger than any other,
and is a response only where no other page has the payload; a null url leaves out its header line, line ends in a url are
percent-encoded. An empty table gives an empty archive. Columns other than page_id, url and the payload are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beamwright.llm.common import HOT_SHARE, attach_by_key

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_SLOT = 64


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32: ten hexadecimal digits are eight digits to base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _header(page: Column, url: Column, first: Column, is_response: Column, digest: Column, size: Column, date: str) -> Column:
    """The whole header of a record: the WARC fields and the HTTP head that opens its block."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), _line("Content-Length", size.cast("string")), F.lit(CRLF))
    block = F.length(head) + F.when(is_response, size).otherwise(F.lit(0))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.when(is_response, F.lit("response")).otherwise(F.lit("revisit"))),
        _line("WARC-Record-ID", urn(page)), F.lit(f"WARC-Date: {date}{CRLF}"), F.coalesce(_line("WARC-Target-URI", uri), F.lit("")),
        F.when(is_response, F.lit("")).otherwise(F.concat(_line("WARC-Refers-To", urn(first)), F.lit(f"WARC-Profile: {PROFILE}{CRLF}"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", block.cast("string")), F.lit(CRLF), head)


def write_archive(pages: DataFrame, folder: str, payload: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``folder/payloads`` (each payload once) and ``folder/records`` (each record's header and payload address).

    The payloads of a digest are merged before the shuffle. A payload that very many records share is later read in several
    copies, so that its records need not meet in one task: ``slots`` says in how many.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumn("address", F.unhex(F.sha2("payload", 256)))
    total = pages.count()
    per_slot = max(total // HOT_SHARE, LEAST_SLOT)
    rows.groupBy("address").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_page"), F.count("*").alias("n")).withColumn(
        "slots", F.ceil(F.col("n") / per_slot)).write.parquet(f"{folder}/payloads")

    facts = spark.read.parquet(f"{folder}/payloads").select("address", "n", "first_page", "slots")
    light = rows.select("page_id", "url", "address", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    salt = F.xxhash64("page_id", "url")
    known = attach_by_key(light, facts, "address", "n", total, salt)
    is_response = F.col("page_id").eqNullSafe(F.col("first_page"))
    known.select(
        "page_id", "address", F.pmod(salt, F.col("slots")).alias("slot"),
        _header(F.col("page_id"), F.col("url"), F.col("first_page"), is_response, F.col("digest"), F.col("size"), date).alias("header"),
    ).write.parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Records as they were: address, header, record (all its bytes), payload (for revisits that of the record referred to).

    Fails if the bytes of a payload no longer have the digest they are stored under.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), F.hex("address"))).cast("binary"))
    stored = payloads.select("address", checked.alias("payload"), F.col("slots").alias("copies"))
    stored = stored.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    records = spark.read.parquet(f"{folder}/records").join(stored.drop("copies"), ["address", "slot"])
    is_response = F.col("header").contains(f"{CRLF}WARC-Type: response{CRLF}")
    block = F.when(is_response, F.col("payload")).otherwise(F.lit("").cast("binary"))
    record = F.concat(F.col("header").cast("binary"), block, F.lit(CRLF * 2).cast("binary"))
    return records.select("page_id", "address", "header", record.alias("record"), "payload", F.col("digest").alias("stored_digest"))


def describe(records: DataFrame) -> DataFrame:
    """What the headers say, held against the payloads: page_id, payload_bytes, payload_digest, record_type, refers_to, record_sha256."""
    kind = records.schema["page_id"].dataType
    field = lambda name, value: F.regexp_extract("header", rf"\r\n{name}: {value}\r\n", 1)
    digest = field("WARC-Payload-Digest", "sha1:([A-Z2-7]{32})")
    return records.select(
        F.nullif(field("WARC-Record-ID", "<urn:page:([^>]*)>"), F.lit("")).cast(kind).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == F.col("stored_digest"), digest).otherwise(F.raise_error(F.lit("a header states another payload digest"))).alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        F.nullif(field("WARC-Refers-To", "<urn:page:([^>]*)>"), F.lit("")).cast(kind).alias("refers_to"),
        F.sha2("record", 256).alias("record_sha256"))
