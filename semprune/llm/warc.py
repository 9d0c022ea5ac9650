"""WARC archives: written as text records, read back by a verified chain of record boundaries.

Writing. A record is its header and its payload; Spark's text writer puts the two line ends behind
it that close a record, so archives go to any store Spark can write. Records with equal payloads of a
minimum size are stored once, by the largest page id; the others become revisit records without payload.

Reading. Files are read in splits, cut at every occurrence of the magic line; a payload may contain it too.
Tasks emit, for each occurrence, its offset and the offset at which the next record would
begin if this one is real. Offsets of splits follow from the bytes of the splits before. Then pointer jumping from
the start of each file marks what the chain reaches: a round joins the marked offsets with pointers over
1, 2, 4, ... records. All else is content of a payload and is put back into it. A table of offsets is moved for
that, payloads only where a magic line cut them.

Defined cases: missing html is an empty payload; a missing page id or url is an empty field; rows equal
in page id and payload are all responses, if that id is the largest; line ends in a url are percent-encoded;
a chain ends at a broken header, records behind it and records whose bytes end early are left out; an empty table
gives no records. Payloads of any length and other columns in the table make no difference.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from semprune.llm.common import broadcast_if_small
from semprune.session import materialize

MAGIC = "WARC/1.1\r\n"
CLOSE = "\r\n\r\n"
MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUCKET = 16  # bits of the offset ranges by which pieces meet their record


# --- writing ---------------------------------------------------------------------------------


def _identifier(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records_of(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(value): a record of each page, without the line ends that close it."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"), F.octet_length(html).alias("bytes"), F.sha1(html.cast("binary")).alias("digest"))
    same = rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    same = materialize(same.where("n > 1 AND holder IS NOT NULL").select("digest", "holder"), "equal-payloads")
    rows = rows.join(broadcast_if_small(same, 96), "digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _identifier(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _identifier(F.col("holder"))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    return rows.select(record.alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    records_of(pages, min_revisit_bytes).write.option("lineSep", CLOSE).text(path)


# --- reading ---------------------------------------------------------------------------------


_LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*(\d+)[ \t]*(?=\r\n|$)", re.I)


def _extent(value: bytes) -> tuple[int, int] | None:
    """(bytes of the header, bytes of the payload) of what follows a magic line, if it is a header."""
    end = value.find(b"\r\n\r\n")
    length = _LENGTH.search(value[:end]) if end >= 0 else None
    return (end + 4, int(length[1])) if length else None


def _located(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows of splits with their offset in the split: the content or what it says of its length."""
    place, at, sep = None, 0, len(MAGIC)
    for batch in batches:
        files, blocks = batch.column(1), batch.column(2).to_pylist()
        offsets, contents, nexts, ends = [], [], [], []
        for i, (value, file) in enumerate(zip(batch.column(0), files.to_pylist(), strict=True)):
            content = value.as_py()
            if (file, blocks[i]) != place:
                place, at = (file, blocks[i]), 0
            offsets.append(at - sep)
            at += len(content) + sep
            ends.append(at - sep)
            if whole:
                contents.append(content)
            else:
                extent = _extent(content)
                nexts.append(offsets[-1] + sep + sum(extent) + len(CLOSE) if extent else None)
        last = pa.array(contents, pa.binary()) if whole else pa.array(nexts, pa.int64())
        yield pa.RecordBatch.from_arrays([files, batch.column(2), pa.array(offsets, pa.int64()), pa.array(ends, pa.int64()), last], ["file", "block", "start", "stop", "last"])


def _pieces(spark: SparkSession, path: str, whole: bool) -> DataFrame:
    """(file, block, start, stop, last) of all that lies between magic lines.

    ``start`` is where the magic line before it begins and ``stop`` where the one behind it does, relative to the
    split; ``last`` is the content, or the place of the next record.
    """
    read = spark.read.option("lineSep", MAGIC).text(path)
    rows = read.select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    kind = "binary" if whole else "long"
    return rows.mapInArrow(lambda b: _located(b, whole), f"file long, block long, start long, stop long, last {kind}")


def chained(candidates: DataFrame) -> DataFrame:
    """(file, start) of the candidates that the chain from offset 0 of their file reaches.

    ``candidates`` is a written table of (file, start, next).
    """
    pointers = candidates.where("next IS NOT NULL").select("file", "start", "next")
    reached = fresh = materialize(candidates.where("start = 0").select("file", "start"), "chain-starts")
    while fresh.limit(1).count():
        moved = reached.join(pointers, ["file", "start"]).select("file", F.col("next").alias("start"))
        fresh = materialize(moved, "chain-reached")
        reached = reached.unionByName(fresh)
        behind = pointers.select("file", F.col("start").alias("next"), F.col("next").alias("then"))
        pointers = materialize(pointers.join(behind, ["file", "next"]).select("file", "start", F.col("then").alias("next")), "chain-pointers")
    return reached.join(candidates.select("file", "start"), ["file", "start"], "left_semi")


def boundaries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bases, odd): offsets of splits, and the rows that are no whole record.

    ``bases`` is (file, block, base). ``odd`` is (file, start, owner): the record a row is a part of, null if of none.
    """
    found = materialize(_pieces(spark, path, False), "warc-candidates")
    # the magic line behind a split's last row opens the next split
    sizes = found.groupBy("file", "block").agg(F.max(F.col("stop") + len(MAGIC)).alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(sizes.select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base")), "warc-bases")
    moved = found.join(broadcast_if_small(bases, 32), ["file", "block"])
    rows = moved.select("file", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("stop")).alias("stop"), (F.col("base") + F.col("last")).alias("next"))
    rows = materialize(rows, "warc-offsets")
    reached = materialize(chained(rows.where("start >= 0").select("file", "start", "next")), "warc-records")
    # the last row of a file ends with the file, so its record may end there but not behind it
    ends = rows.groupBy("file").agg(F.max("stop").alias("end"))
    records = rows.join(reached, ["file", "start"], "left_semi").join(ends, "file")
    torn = records.where("next IS NOT NULL AND stop < next AND next <= end").select("file", F.col("start").alias("owner"), "next")
    torn = materialize(torn, "warc-torn")
    whole = records.where("next IS NOT NULL AND next <= stop").select("file", "start")
    others = rows.join(whole, ["file", "start"], "left_anti").select("file", "start")
    ranges = torn.withColumn("bucket", F.explode(F.sequence(F.shiftright("owner", BUCKET), F.shiftright(F.col("next") - 1, BUCKET))))
    placed = others.withColumn("bucket", F.shiftright("start", BUCKET)).join(ranges, ["file", "bucket"], "left")
    inside = F.when((F.col("start") >= F.col("owner")) & (F.col("start") < F.col("next")), F.col("owner"))
    odd = placed.groupBy("file", "start").agg(F.max(inside).alias("owner"))
    return bases, materialize(odd, "warc-odd")


def _header(fields: bytes, name: bytes) -> bytes | None:
    m = re.search(rb"(?:^|\r\n)" + name + rb":[ \t]*([^\r\n]*)", fields, re.I)
    return m[1] if m else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    page = lambda x: int(m[1]) if x and (m := re.fullmatch(rb"<urn:x-page:(-?\d+)>", x)) else None
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for value in batch.column(0):
            content = value.as_py()
            head, length = _extent(content)
            fields = content[:head]
            digest = _header(fields, b"WARC-Payload-Digest") or b""
            row = (
                page(_header(fields, b"WARC-Record-ID")),
                (_header(fields, b"WARC-Type") or b"").decode(),
                page(_header(fields, b"WARC-Refers-To")),
                (_header(fields, b"WARC-Target-URI") or b"").decode(errors="replace"),
                digest.removeprefix(b"sha1:").decode(),
                content[head : head + length],
            )
            for column, x in zip(out, row, strict=True):
                column.append(x)
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["page_id", "record_type", "refers_to", "url", "digest", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, url, digest, payload) of the records whose boundaries hold."""
    bases, odd = boundaries(spark, path)
    pieces = _pieces(spark, path, True).join(broadcast_if_small(bases, 32), ["file", "block"])
    pieces = pieces.select("file", (F.col("base") + F.col("start")).alias("start"), F.col("last").alias("value"))
    whole = pieces.join(broadcast_if_small(odd, 32), ["file", "start"], "left_anti").select("value")
    parts = odd.where("owner IS NOT NULL")
    cut = pieces.join(broadcast_if_small(parts, 32), ["file", "start"])
    joined = cut.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
    texts = F.transform("parts", lambda p: F.hex(p["value"]))
    healed = joined.select(F.unhex(F.array_join(texts, "".join(f"{b:02X}" for b in MAGIC.encode()))).alias("value"))
    fields = "page_id long, record_type string, refers_to long, url string, digest string, payload binary"
    return whole.unionByName(healed).mapInArrow(_parsed, fields)


def payload_facts(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): a revisit has those of its response."""
    own = records.select("page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"))
    own = materialize(own, "warc-facts")
    held = own.where("record_type <> 'revisit'").select(F.col("page_id").alias("refers_to"), F.col("sha1").alias("digest"), F.col("bytes").alias("full")).distinct()
    wanted = own.where("record_type = 'revisit'").select("refers_to").distinct()
    held = materialize(held.join(wanted, "refers_to", "left_semi"), "warc-held")
    revisits = own.where("record_type = 'revisit'").join(broadcast_if_small(held, 96), ["refers_to", "digest"])
    return (
        own.where("record_type <> 'revisit'")
        .select("page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", "refers_to")
        .unionByName(revisits.select("page_id", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"))
    )
