"""WARC archives: writing with revisits, and reading with a verified chain of record boundaries.

Writing is a plain text write whose line separator is the blank lines that end a record.  Reading
splits archives at the record magic with Spark's splittable text reader; every piece is a candidate
that claims an offset for its successor.  Pointer jumping from the start of each file keeps only the
candidates that the chain reaches, so magic inside payloads never starts a record.

Defined cases: a null html is an empty payload; a null page id is written as such and never refers to
itself; rows that repeat a page id and payload are responses alike; line breaks in a url are escaped;
a chain that breaks ends there; bytes before the first record hide the whole file; an empty table gives
an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.sized import keep, scratch_path

# The format.  Fixed values.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
URN = "urn:x-page:"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@F.pandas_udf(T.StringType())
def payload_digest(payload: pd.Series) -> pd.Series:
    return payload.map(lambda p: sha1_base32(p.encode()))


def records(pages: DataFrame, min_bytes: int, date: str) -> DataFrame:
    """One text per page: headers and block of its record, without the final blank lines."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", payload_digest("html")).withColumn("size", F.octet_length("html"))
    grouped = rows.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
    owners = keep(grouped.filter("n > 1").select("digest", "owner"))  # payloads that occur once need no lookup
    joined = rows.join(owners, "digest", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))

    def urn(c):
        return F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    joined = joined.withColumn("block", F.when(revisit, http).otherwise(F.concat(http, "html")))
    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.lit(f"WARC-Date: {date}"),
        F.when(F.col("url") != "", F.concat(F.lit("WARC-Target-URI: "), "url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn("owner"))),
        F.concat(F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string")),
    )
    return joined.select(F.concat(lines, F.lit(END), "block").alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one archive per partition; equal payloads of at least ``min_bytes`` are stored once, at the largest page id."""
    records(pages, min_bytes, date).write.option("lineSep", END).text(path)


def _header(block: bytes, end: int) -> dict[str, str]:
    out = {}
    for line in block[:end].decode("utf-8", "replace").split("\r\n"):
        name, found, value = line.partition(":")
        if found:
            out[name.strip().lower()] = value.strip()
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"[0-9]{1,18}", text) else None


def _page(text: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?[0-9]+)>", text or "")
    return int(found[1]) if found else None


def parse(block: bytes) -> dict | None:
    """Fields of a record from the bytes after its magic; ``None`` if they are no record head."""
    end = block.find(END.encode())
    if end < 0:
        return None
    head = _header(block, end)
    length = _number(head.get("content-length"))
    if length is None or "warc-type" not in head:
        return None
    body = block[end + 4 : end + 4 + length]
    http = body.find(END.encode())
    sent = _number(_header(body, http).get("content-length")) if http >= 0 else None
    payload = body[http + 4 :] if http >= 0 else body
    own = head["warc-type"] != "revisit"
    return {
        "reach": end + 4 + length + 4, "whole": len(block) >= end + 4 + length, "page_id": _page(head.get("warc-record-id")), "url": head.get("warc-target-uri"),
        "record_type": head["warc-type"], "refers_to": _page(head.get("warc-refers-to")), "payload_bytes": len(payload) if own else sent,
        "payload_digest": sha1_base32(payload) if own else head.get("warc-payload-digest", "").removeprefix("sha1:"),
        "stated_digest": head.get("warc-payload-digest", "").removeprefix("sha1:"),
    }


_FIELDS = (
    "reach long, whole boolean, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, stated_digest string"
)
_PIECES = "path long, split_at long, local long, size long, " + _FIELDS


def _parse_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with their offset from the first piece of their split; a task reads its splits one after the other."""
    now, local = None, 0
    empty = dict.fromkeys(name.split()[0] for name in _FIELDS.split(", "))
    for batch in batches:
        out = []
        for path, split_at, value in zip(*(batch.column(c).to_pylist() for c in ("path", "split_at", "value")), strict=True):
            if (path, split_at) != now:
                now, local = (path, split_at), 0
            out.append({"path": path, "split_at": split_at, "local": local, "size": len(value), **(parse(value) or empty)})
            local += len(value) + len(MAGIC)
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


_ARROW = pa.schema(
    [("path", pa.int64()), ("split_at", pa.int64()), ("local", pa.int64()), ("size", pa.int64()), ("reach", pa.int64()), ("whole", pa.bool_()),
     ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("stated_digest", pa.string())]
)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, by file (a hash of its path) and split, in file order within a task."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_at"), F.col("value").cast("binary").alias("value"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All pieces with their offset ``at`` in the file, that of the magic before them, and their claimed successor ``next``."""
    parsed = keep(pieces(spark, path).mapInArrow(_parse_pieces, _PIECES))
    sums = parsed.groupBy("path", "split_at").agg(F.sum(F.col("size") + len(MAGIC)).alias("n"))
    before = Window.partitionBy("path").orderBy("split_at").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(sums.select("path", "split_at", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base")))
    placed = parsed.join(bases, ["path", "split_at"]).withColumn("at", F.col("base") + F.col("local") - len(MAGIC))
    return placed.withColumn("next", F.col("at") + len(MAGIC) + F.col("reach"))


def reachable(found: DataFrame) -> DataFrame:
    """``path, at`` of the candidates on the chain from each file's start, by pointer jumping.

    In round k the reached set grows by jumps of 2^k records, and jumps are joined to jumps.
    """
    jumps = keep(found.filter("next IS NOT NULL AND at >= 0").select("path", "at", "next"))
    reached = keep(jumps.filter("at = 0").select("path", "at"))
    parts, total = [reached], reached.count()
    while total:
        step = reached.join(jumps, ["path", "at"]).select("path", F.col("next").alias("at"))
        step = keep(step)
        total = step.count()
        parts.append(step)
        reached = keep(reached.union(step))
        onward = jumps.select("path", F.col("at").alias("next"), F.col("next").alias("after"))
        jumps = keep(jumps.join(onward, ["path", "next"]).select("path", "at", F.col("after").alias("next")))
    return reached


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records on the chains: page, url, type, reference, payload size and digest, and the digest its header states."""
    found = keep(candidates(spark, path))
    on_chain = found.join(reachable(found), ["path", "at"])
    fields = [name.split()[0] for name in _FIELDS.split(", ") if not name.startswith(("reach", "whole"))]
    whole = on_chain.filter("whole").select(*fields)
    broken = keep(on_chain.filter("NOT whole").select("path", "at", "next"))
    if broken.isEmpty():
        return whole
    return whole.unionByName(_reassembled(spark, path, found, broken).select(*fields))


def _reassembled(spark: SparkSession, path: str, found: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their pieces are read again and joined.

    Each piece finds its record by the last chain start before it; a record is one group.
    """
    starts = broken.select("path", "at", F.col("at").alias("owner"), F.col("next").alias("stop"))
    line = found.select("path", "at", "split_at", "local").join(starts, ["path", "at"], "left")
    span = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = line.select("path", "at", "split_at", "local", F.last("owner", True).over(span).alias("owner"), F.last("stop", True).over(span).alias("stop"))
    owned = keep(owned.filter("at < stop").select("path", "split_at", "local", "at", "owner"))

    def with_places(batches):
        now, local = None, 0
        for batch in batches:
            places = []
            for p, s, v in zip(*(batch.column(c).to_pylist() for c in ("path", "split_at", "value")), strict=True):
                if (p, s) != now:
                    now, local = (p, s), 0
                places.append(local)
                local += len(v) + len(MAGIC)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=["path", "split_at", "value", "local"])

    placed = pieces(spark, path).mapInArrow(with_places, "path long, split_at long, value binary, local long")
    parts = placed.join(owned, ["path", "split_at", "local"]).groupBy("path", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))

    def rebuild(batches):
        for batch in batches:
            out = []
            for row in batch.column("parts").to_pylist():
                out.append({k: v for k, v in (parse(MAGIC.encode().join(p["value"] for p in row)) or {}).items()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([f for f in _ARROW][4:]))

    return parts.select("parts").mapInArrow(rebuild, _FIELDS)


def archive_and_read(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages to archives (at ``path``, or a new folder in shared storage) and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark)
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
