"""WARC archives with segmented, chunked records, written and read back."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import ROW
from tillstar.session import new_path, write_shared

VERSION = "WARC/1.1\r\n"
CRLF = "\r\n"
CHUNK_CHARS = 8192
SEGMENT_CHARS = 65536
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # of Spark's conv() to base 32


def digest_of(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text's UTF-8 bytes."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def target_uri(page_id: Column, url: Column) -> Column:
    """A record's URI: the url, blanks and control characters escaped, or a name made of the id."""
    plain = F.regexp_replace(url, r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$", "")
    plain = F.regexp_replace(F.replace(plain, F.lit(" "), F.lit("%20")), r"[\x00-\x1F\x7F]", "%EF%BF%BD")
    plain = F.regexp_replace(plain, r"WARC/1\.1$", "WARC/1%2E1")  # archives are split at version lines
    named = F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("unknown")))
    return F.coalesce(F.nullif(plain, F.lit("")), named)


def assign_types(pages: DataFrame, page_id: str, html: str, least_bytes: int = 0, url: str | None = None) -> DataFrame:
    """Rows (id, payload, digest, revisit, uri, and of the record that a revisit refers to, target).

    Of records with equal payloads of at least ``least_bytes`` bytes the one with
    the largest id (NULL is smallest) is the response and the others revisit it;
    rows equal in both id and payload are alike, so all of them are responses if
    one is.  Digests alone decide: a payload held by a third of all records is
    one row per task after the partial maximum, and the join back is one that
    adaptive execution splits.
    """
    uri = target_uri(F.col(page_id), F.col(url) if url else F.lit(None).cast("string"))
    rows = pages.select(F.col(page_id).alias("__id"), F.coalesce(F.col(html), F.lit("")).alias("payload"), uri.alias("uri"))
    rows = rows.withColumn("digest", digest_of(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    equal = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
    chosen = equal.agg(
        F.max("__id").alias("chosen"), F.max_by("uri", "__id").alias("target"), F.count("*").alias("n")
    ).filter("n > 1").drop("n")
    later = F.col("chosen").isNotNull() & (F.col("__id").isNull() | (F.col("__id") < F.col("chosen")))
    return rows.join(chosen, ["digest", "bytes"], "left").select(
        "__id", "payload", "digest", F.coalesce(later, F.lit(False)).alias("revisit"), "uri", "target"
    )


def chunked(payload: Column) -> Column:
    """The payload in chunked transfer framing.

    Chunks are of about ``CHUNK_CHARS`` characters, and end inside every
    occurrence of the version line, so that the line stands at the start of
    records only and archives can be split there.
    """
    safe = F.split(payload, r"(?<=WARC/)(?=1\.1\r\n)", -1)
    pieces = F.flatten(
        F.transform(
            safe,
            lambda part: F.transform(
                F.sequence(F.lit(0), F.floor(F.greatest(F.length(part) - 1, F.lit(0)) / CHUNK_CHARS).cast("int")),
                lambda i: F.substring(part, i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS)),
            ),
        )
    )
    framed = F.transform(
        F.filter(pieces, lambda piece: piece != ""),
        lambda piece: F.concat(F.lower(F.hex(F.octet_length(piece))), F.lit(CRLF), piece, F.lit(CRLF)),
    )
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def records(typed: DataFrame, segment_chars: int = SEGMENT_CHARS, date: Column | None = None) -> DataFrame:
    """One text per WARC record: responses (cut into segments where long) and revisits.

    All have the fields that the format asks for: type, record id, date (``date``,
    by default the time of writing, in UTC), target URI and length; a revisit also
    tells the URI and date of what it refers to.
    """
    if date is None:
        date = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    date = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    urn = lambda row: F.concat(F.lit("<urn:record:"), row.cast("string"), F.lit(">"))
    http = F.when(
        ~F.col("revisit"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"),
            chunked(F.col("payload")),
        ),
    ).otherwise("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    typed = typed.withColumn("http", http).withColumn(ROW, F.monotonically_increasing_id())
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("http") - 1) / segment_chars).cast("int")),
        lambda i: F.substring(F.col("http"), i * segment_chars + 1, F.lit(segment_chars)),
    )
    cut = typed.select(
        ROW, "__id", "digest", "revisit", "uri", "target", F.octet_length("http").alias("total"),
        F.size(parts).alias("segments"), F.posexplode(parts).alias("place", "block"),
    )
    first, several = F.col("place") == 0, F.col("segments") > 1
    last = F.col("place") == F.col("segments") - 1
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    own = F.when(first, urn(F.col(ROW))).otherwise(
        F.concat(F.lit("<urn:record:"), F.col(ROW).cast("string"), F.lit("."), (F.col("place") + 1).cast("string"), F.lit(">"))
    )
    kind = F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")
    header = F.concat(
        F.lit(VERSION),
        line("WARC-Type", kind),
        line("WARC-Record-ID", own),
        line("WARC-Date", date),
        line("WARC-Target-URI", F.col("uri")),
        F.when(first, F.lit("Content-Type: application/http; msgtype=response\r\n")).otherwise(""),
        F.when(first & F.col("__id").isNotNull(), line("WARC-Page-ID", F.col("__id").cast("string"))).otherwise(""),
        F.when(first, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))).otherwise(""),
        F.when(
            first & F.col("revisit"),
            F.concat(
                F.lit(f"WARC-Profile: {PROFILE}\r\n"),
                line("WARC-Refers-To-Target-URI", F.coalesce("target", "uri")),
                line("WARC-Refers-To-Date", date),
            ),
        ).otherwise(""),
        F.when(several, line("WARC-Segment-Number", (F.col("place") + 1).cast("string"))).otherwise(""),
        F.when(~first, line("WARC-Segment-Origin-ID", urn(F.col(ROW)))).otherwise(""),
        F.when(several & last, line("WARC-Segment-Total-Length", F.col("total").cast("string"))).otherwise(""),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF),
    )
    return cut.select(F.concat(header, "block").alias("value"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", html: str = "html", least_bytes: int = 0,
    segment_chars: int = SEGMENT_CHARS, url: str | None = None,
) -> None:
    """Write a record per page into gzipped archives under ``path``.

    Every file is a sequence of WARC records, each ended by two line ends.
    Spark's own text writer commits them, so tasks may be lost and run again and
    the folder may be in any store.  A NULL html is an empty payload, a NULL id
    is left out of its record, repeated rows get records of their own.  A record
    without a url gets a name made of its id as its URI.
    """
    made = records(assign_types(pages, page_id, html, least_bytes, url), segment_chars)
    made.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def split_headers(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record; the block has the length that the record states."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split(CRLF) if ": " in x)
    length = int(fields.get("Content-Length", -1))
    if length < 0 or len(rest) < length:
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short: {len(rest)} of {length} bytes")
    return fields, rest[:length]


def parse_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for value in batch["value"]:
            if not value:  # before the first version line
                continue
            f, block = split_headers(value)
            own = f["WARC-Record-ID"]
            rows.append((
                f.get("WARC-Segment-Origin-ID", own), int(f.get("WARC-Segment-Number", 0)),
                int(f.get("WARC-Segment-Total-Length", -1)), f["WARC-Type"], int(f["WARC-Page-ID"]) if "WARC-Page-ID" in f else None,
                f.get("WARC-Payload-Digest", "").removeprefix("sha1:"), block,
            ))
        frame = pd.DataFrame(rows, columns=PARSED_NAMES)
        frame["page_id"] = frame["page_id"].astype("Int64")
        yield frame


PARSED = "origin string, number int, total long, type string, page_id long, digest string, block binary"
PARSED_NAMES = [x.split()[0] for x in PARSED.split(", ")]


def dechunk(body: bytes) -> bytes:
    """The payload inside chunked transfer framing; an error if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        if len(parts[-1]) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is shorter than it states")
        at = end + 4 + size


def decode_payloads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, digests, payloads = [], [], []
        for kind, block, stated in zip(batch["type"], batch["block"], batch["digest"]):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "revisit":
                sizes.append(None), digests.append(stated), payloads.append(None)
                continue
            payload = dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if stated and stated != digest:
                raise ValueError(f"payload digest {digest} differs from the stated {stated}")
            sizes.append(len(payload)), digests.append(digest), payloads.append(payload)
        out = batch[["origin", "page_id", "type"]].copy()
        out["bytes"] = pd.array(sizes, dtype="Int64")
        out["digest"], out["payload"] = digests, payloads
        yield out


DECODED = "origin string, page_id long, type string, bytes long, digest string, payload binary"


def assemble(parsed: DataFrame) -> DataFrame:
    """Records whole again: segments are grouped by origin, ordered by number, checked and joined.

    Only segmented records are shuffled.  A missing segment or a wrong total
    length is an error that names the record.
    """
    whole = parsed.filter("number = 0").select("origin", "type", "page_id", "digest", "block")
    parts = parsed.filter("number > 0").groupBy("origin").agg(
        F.max(F.when(F.col("number") == 1, F.struct("type", "page_id", "digest"))).alias("head"),
        F.max("total").alias("total"),
        F.max("number").alias("last"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
    )
    joined = F.aggregate(
        F.col("parts.block"), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)
    )
    parts = parts.withColumn("joined", joined)
    bad = (
        (F.octet_length("joined") != F.col("total")) | (F.size("parts") != F.col("last")) | F.col("head").isNull()
    )
    block = F.when(
        bad, F.raise_error(F.concat(F.lit("segments missing or of a wrong length: "), "origin"))
    ).otherwise(F.col("joined"))
    return whole.unionByName(
        parts.select("origin", "head.type", "head.page_id", "head.digest", block.alias("block"))
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record in the archives: record id, page id, type, size, digest, payload.

    Revisits have no payload of their own; they name their response by its payload digest.  Cut or inconsistent records are errors, never
    dropped.  An empty folder of archives gives no rows.
    """
    raw = spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary").alias("value"))
    raw = raw.filter(F.length("value") > 0)
    decoded = assemble(raw.mapInPandas(parse_records, PARSED)).mapInPandas(decode_payloads, DECODED)
    return decoded


def page_records(decoded: DataFrame) -> DataFrame:
    """Per page record its full payload's size and digest, its type and whom it refers to.

    Payloads are left out before anything is stored, so the archives are decoded
    once and revisits are resolved on narrow rows.
    """
    rows = write_shared(decoded.drop("payload"), "warc-read")
    targets = rows.filter("type = 'response'").groupBy("digest").agg(
        F.max("page_id").alias("target"), F.max("bytes").alias("full_bytes")
    )
    found = rows.join(targets, "digest", "left")
    revisit = F.col("type") == "revisit"
    lost = F.raise_error(F.concat(F.lit("no response with the payload of "), "origin"))
    return found.select(
        "page_id",
        F.when(revisit & F.col("full_bytes").isNull(), lost.cast("long"))
        .otherwise(F.coalesce("bytes", "full_bytes"))
        .alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("target")).alias("refers_to"),
    )


def round_trip(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", least_bytes: int = 0,
    segment_chars: int = SEGMENT_CHARS, url: str | None = None,
) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, return :func:`page_records`."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, page_id, html, least_bytes, segment_chars, url)
    return page_records(read_archives(spark, path))
