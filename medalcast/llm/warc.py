"""WARC archives: writing, reading, and revisit resolution.

A record is its header, a blank line and its block (HTTP head and payload), and
ends with two line ends. Spark's text writer writes one record per row with those
line ends as its separator, gzip over the file, straight from the JVM. The text
reader splits at the version mark; a record whose length its parts don't reach
yet goes on in the next part, so marks inside payloads do no harm, and only one
record at a time is held however large an archive is. (Gzip files aren't split.)

Revisit resolution: headers alone are shuffled by payload digest; the record
with the smallest source id (nulls last, then the earliest) of each digest stays
a response, the others become revisit records that refer to it, and the archives
are written anew with fresh headers. Payloads are only moved if Spark's measured
threshold doesn't let the list of records to replace be broadcast. A digest that
more than 1 / ``HOT`` of the records share (fewer than ``HOT`` digests can be) is
joined by broadcast, so no task gets a hot digest's records.

Cases: null payloads are empty; null urls and ids have no header of theirs; line
ends in a url are percent-encoded. Repeated rows are records of their own, of
which one is the response. A revisit whose response isn't in the archives keeps
its reference and has no size. An archive that ends inside a record raises. An
empty table gives archives without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from .stage import Scratch

# --- fixed values: the format ---
MARK = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
SOURCE = "X-Source-ID"           # the caller's id of a record
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HOT = 1000
STORED = ("response", "resource")     # records whose payload can be replaced by a revisit

HEADER = ("record_type string, record_id string, source_id long, uri string, date string, content_type string, digest string, payload_bytes long, "
          "refers_to string, refers_uri string, refers_date string, http binary")
_FIELDS = {"warc-type": 0, "warc-record-id": 1, SOURCE.lower(): 2, "warc-target-uri": 3, "warc-date": 4, "content-type": 5, "warc-payload-digest": 6,
           "warc-refers-to": 8, "warc-refers-to-target-uri": 9, "warc-refers-to-date": 10}


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: four times 40 bits to the base 32."""
    x = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(x, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> DataFrame:
    """Response records of pages, with their payload."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(f"`{id_col}`").cast("long").alias("source_id"), F.col(f"`{url_col}`").cast("string").alias("uri"), payload.alias("payload"))
    x = F.md5(F.concat_ws("|", F.lit(uuid.uuid4().hex), F.monotonically_increasing_id().cast("string")))
    urn = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))
    size = F.octet_length("payload").cast("long")
    none = F.lit(None).cast("string")
    return src.select(F.lit("response").alias("record_type"), urn.alias("record_id"), "source_id", "uri", F.lit(date).alias("date"),
                      F.lit(HTTP).alias("content_type"), sha1_base32(F.col("payload")).alias("digest"), size.alias("payload_bytes"),
                      none.alias("refers_to"), none.alias("refers_uri"), none.alias("refers_date"),
                      F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END)).cast("binary").alias("http"),
                      "payload")


def _line(name: str, value: Column) -> Column:
    """A header line; null if there is no value."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), clean)


def write_archives(records: DataFrame, path: str) -> None:
    """Write records (the columns of ``HEADER`` and ``payload``) as gzip WARC files, one per partition."""
    c = F.col
    size = F.octet_length("http") + F.octet_length("payload")
    head = F.concat_ws(
        "\r\n", F.lit(MARK + "1"), _line("WARC-Type", c("record_type")), _line("WARC-Record-ID", c("record_id")), _line("WARC-Date", c("date")),
        _line("WARC-Target-URI", c("uri")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c("digest"))), _line(SOURCE, c("source_id").cast("string")),
        _line("WARC-Profile", F.when(c("record_type") == "revisit", F.lit(PROFILE))), _line("WARC-Refers-To", c("refers_to")),
        _line("WARC-Refers-To-Target-URI", c("refers_uri")), _line("WARC-Refers-To-Date", c("refers_date")),
        _line("Content-Type", c("content_type")), _line("Content-Length", size.cast("string")))
    record = F.concat(head, F.lit(END), c("http").cast("string"), c("payload").cast("string"))
    records.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _parsed(raw: bytes, with_payload: bool):
    """Header values (and payload) of one record, and where its block ends; None if more bytes are needed."""
    at = raw.find(b"\r\n\r\n")
    if at < 0:
        return None
    row, length = [None] * 12, None
    for line in raw[:at].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        name, value = name.strip().lower().decode("ascii", "replace"), value.strip().decode("utf-8", "replace")
        if name == "content-length":
            length = int(value)
        elif name in _FIELDS:
            row[_FIELDS[name]] = value
    if length is None:
        raise ValueError("a record without a length")
    end = at + 4 + length
    if len(raw) < end:
        return None
    if raw[end:].strip(b"\r\n"):
        raise ValueError("bytes behind a record")
    block = raw[at + 4:end]
    http, payload = b"", block
    if (row[5] or "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        cut = len(block) if cut < 0 else cut + 4
        http, payload = block[:cut], block[cut:]
    row[2] = int(row[2]) if row[2] else None
    if row[0] == "revisit":               # digest and size are those of the response
        row[6] = row[6] and row[6].split(":", 1)[-1].upper()
    else:
        row[6], row[7] = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    row[11] = http
    return [*row, payload] if with_payload else row


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of gzip WARC files: the columns of ``HEADER``, and ``payload``.

    The digest is computed from the payload, but for revisits, whose size is null.
    """
    schema = HEADER + (", payload binary" if with_payload else "")
    kinds = [pa.int64() if " long" in f else pa.binary() if " binary" in f else pa.string() for f in schema.split(",")]
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    src = spark.read.option("lineSep", MARK).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches):
        file, held, out, weight = None, None, [], 0
        for b in batches:
            for f, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if f != file:
                    if held is not None:
                        raise ValueError(f"{file} ends inside a record")
                    if part.strip():
                        raise ValueError(f"{f} doesn't begin with a record")
                    file = f
                    continue
                held = part if held is None else held + MARK.encode() + part
                row = _parsed(held, with_payload)
                if row is not None:
                    out.append(row)
                    weight += len(held)
                    held = None
                    if weight > 4 * tv.PIECE or len(out) >= 10_000:
                        yield batch(out)
                        out, weight = [], 0
        if held is not None:
            raise ValueError(f"{file} ends inside a record")
        if out:
            yield batch(out)
    return src.mapInArrow(tv.lean(run), schema)


def attach(rows: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``one`` (one row a key), whatever share of the rows a key has.

    Both should be written tables, as they are read twice. A key with more than 1 / ``HOT`` of the
    keyed rows goes by broadcast; there are fewer than ``HOT`` of them. Rows without a key stay where they are.
    """
    keyed = rows.filter(F.col(key).isNotNull())
    total = keyed.count()
    hot_keys = keyed.groupBy(key).count().filter(F.col("count") * HOT > total).select(key)
    hot = one.join(F.broadcast(hot_keys), key, "left_semi")
    cold = one.join(F.broadcast(hot_keys), key, "left_anti")
    mine = keyed.join(F.broadcast(hot_keys), key, "left_semi").join(F.broadcast(hot), key, "left")
    other = keyed.join(F.broadcast(hot_keys), key, "left_anti").join(cold, key, "left")
    none = rows.filter(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in one.schema.fields if f.name != key])
    return mine.unionByName(other).unionByName(none)


def resolve(headers: DataFrame) -> DataFrame:
    """Headers with the id, source id, digest and size of the response that each revisit refers to.

    By its record id, as ``WARC-Refers-To`` names it. Adds ``of_source``; a revisit gets digest and size.
    """
    stored = headers.filter(F.col("record_type").isin(*STORED)).select(
        F.col("record_id").alias("refers_to"), F.col("source_id").alias("of_source"), F.col("digest").alias("of_digest"), F.col("payload_bytes").alias("of_bytes"))
    out = attach(headers, stored, "refers_to")
    again = F.col("record_type") == "revisit"
    return out.withColumns({"digest": F.when(again, F.coalesce("of_digest", "digest")).otherwise(F.col("digest")),
                            "payload_bytes": F.when(again, F.col("of_bytes")).otherwise(F.col("payload_bytes"))}).drop("of_digest", "of_bytes")


def dedupe_archives(spark: SparkSession, src: str, dst: str, min_bytes: int = 0, date: str | None = None) -> None:
    """Write the archives of ``src`` to ``dst`` with every repeated payload of ``min_bytes`` or more as a revisit.

    Revisits already there are pointed at the response that stays, if their digest is in the archives.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    scratch = Scratch(spark, "warc")
    headers = scratch.write(read_archives(spark, src, with_payload=False), "headers")
    stored = headers.filter(F.col("record_type").isin(*STORED) & (F.col("payload_bytes") >= min_bytes))
    rank = F.struct(F.col("source_id").isNull(), "source_id", "date", "record_id")
    firsts = scratch.write(stored.groupBy("digest").agg(F.min_by(F.struct("record_id", "uri", "date"), rank).alias("o"))
                           .select("digest", F.col("o.record_id").alias("o_id"), F.col("o.uri").alias("o_uri"), F.col("o.date").alias("o_date")), "firsts")
    can = F.col("record_type").isin(*STORED) & (F.col("payload_bytes") >= min_bytes) | (F.col("record_type") == "revisit")
    again = attach(headers.filter(can), firsts, "digest").filter(F.col("o_id") != F.col("record_id"))
    again = scratch.write(again, "again")
    # a revisit's block is its HTTP head alone
    revisits = again.select(F.lit("revisit").alias("record_type"), "record_id", "source_id", "uri", F.lit(date).alias("date"), "content_type", "digest",
                            F.lit(0).cast("long").alias("payload_bytes"), F.col("o_id").alias("refers_to"), F.col("o_uri").alias("refers_uri"),
                            F.col("o_date").alias("refers_date"), F.when(F.col("content_type").startswith("application/http"), F.col("http")).otherwise(F.lit(b"")).alias("http"),
                            F.lit(b"").alias("payload"))
    kept = read_archives(spark, src).join(again.select("record_id"), "record_id", "left_anti").select(revisits.columns)
    write_archives(kept.unionByName(revisits), dst)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write pages as records, resolve repeats, read the archives back: (source_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "archives")
    raw, clean = f"{scratch.base}/raw", f"{scratch.base}/deduplicated"
    write_archives(records_of(pages, id_col, url_col, html_col), raw)
    dedupe_archives(spark, raw, clean, min_bytes)
    headers = scratch.write(read_archives(spark, clean, with_payload=False), "headers")
    return resolve(headers).select("source_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("of_source").alias("refers_to"))
