import hashlib

from pyspark.sql import functions as F

from semprune.llm import warc

MAGIC = warc.MAGIC
TRICKY = [
    f"start {MAGIC} inside",
    f"{MAGIC}WARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n{MAGIC}Content-Length: 99\r\n\r\nx" + MAGIC,
    "\r\n\r\n" + MAGIC + MAGIC + "\r\n\r\n",
    "",
    "é ß 汉字 " * 50,
    "same payload " * 100,
    "x" * 200_000 + MAGIC + "y" * 100_000,
]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, value string, digest string")


def archived(spark, tmp_path, rows, name="a"):
    path = f"file://{tmp_path}/{name}"
    warc.write_archives(pages_of(spark, rows).coalesce(2), path)
    return warc.read_archives(spark, path)


def brute(rows):
    group = {}
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            group[data] = max(group.get(data, page_id), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        n = sum((r[2] or "").encode() == data for r in rows)
        holder = group.get(data) if n > 1 else None
        revisit = holder is not None and page_id != holder
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", holder if revisit else None))
    return sorted(out, key=str)


def test_round_trip_with_magic_in_payloads(spark, tmp_path):
    rows = [(i, f"http://h/{i}", TRICKY[i % len(TRICKY)], "clash", "clash") for i in range(40)]
    rows += [(None, None, None, None, None), (None, "u\r\nWARC/1.1\r\n", "same payload " * 100, None, None), (3, "http://h/3", "", None, None)]
    for split in ("3000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            records = archived(spark, tmp_path, rows, split)
            facts = sorted((tuple(r) for r in warc.payload_facts(records).collect()), key=str)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert facts == brute(rows)


def test_payloads_come_back(spark, tmp_path):
    rows = [(i, "u", text, "", "") for i, text in enumerate(TRICKY)]
    back = {r.page_id: bytes(r.payload).decode() for r in archived(spark, tmp_path, rows).collect()}
    assert back == dict(enumerate(TRICKY))


def test_largest_page_id_holds_equal_payloads(spark, tmp_path):
    rows = [(i, "u", "p" * (1000 if i < 50 else 999), "", "") for i in range(100)]
    kinds = warc.payload_facts(archived(spark, tmp_path, rows)).groupBy("record_type", "refers_to").agg(F.count("*").alias("n")).collect()
    assert sorted((r[0], r[1], r[2]) for r in kinds) == [("response", None, 51), ("revisit", 49, 49)]


def test_no_pages(spark, tmp_path):
    assert warc.payload_facts(archived(spark, tmp_path, [])).count() == 0


def test_chain_stops_at_a_broken_header_and_a_cut_file(spark, tmp_path):
    record = lambda i, text: f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{i}>\r\nContent-Length: {len(text)}\r\n\r\n{text}\r\n\r\n"
    folder = tmp_path / "broken"
    folder.mkdir()
    (folder / "a").write_bytes((record(1, "one") + f"{MAGIC}no length\r\n\r\n" + record(2, "two")).encode())
    (folder / "b").write_bytes((record(3, "three") + record(4, "four" * 10))[:-20].encode())
    (folder / "c").write_bytes(b"junk" + record(5, "five").encode())
    got = warc.read_archives(spark, f"file://{folder}").collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(1, b"one"), (3, b"three")]
