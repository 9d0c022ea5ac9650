"""The registered queries of the corpus operators, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from semprune.llm import (
    chat,
    conversation_repair,
    decontaminate,
    external_shuffle,
    line_dedup,
    mixing,
    packing,
    pseudonyms,
    quality,
    simhash,
    sql,
    trust,
    vector_codes,
    warc,
)
from semprune.session import materialize, scratch_path

N_SHARDS = 8

#: Verdict, host, start of the path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

PLANTED_TEXT = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    size = external_shuffle.record_bytes(F.col("text"))
    shards = external_shuffle.shuffle_into_shards(docs, N_SHARDS, size)
    return shards.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measures(_table(spark, sf_dir, "documents")).select("doc_id", "lang", "quality")
    measured, path = materialize(measured, "measures"), scratch_path(spark, "references")
    quality.write_references(quality.references(quality.trusted(measured, _table(spark, sf_dir, "labels"))), path)
    judged = quality.judge(measured, quality.read_references(spark, path))
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[q[n].alias(n) for n in names], quality.base_failed(q).alias("base_failed"), "kept")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is a reply tree of one branch: a turn answers the one before it."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turn = F.col("id")
    role = F.when(turn == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    rows = rows.unionByName(planted)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    name = lambda n: F.when(n > 0, F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), n.cast("string")))
    messages = rows.withColumn("place", place).select(name(F.col("place")).alias("node"), name(F.col("place") - 1).alias("parent"), "role", "text")
    whole = chat.format_reply_trees(messages).select(F.col("root"), "formatted", "loss")
    read = whole.select("root", "formatted", chat.read_back(F.col("formatted")).alias("turns"), F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss")), "").alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    conv_id = F.substring_index("root", ":", 1)
    return read.select(
        F.when(conv_id != "", conv_id).cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_replaced")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.payload_facts(warc.read_archives(spark, path))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; ``removed`` lists the numbers of the lines that go."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(line_dedup.removed_lines(docs), "lines-removed")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    narrow = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"), n_lines.cast("long").alias("n_lines"))
    mine = found.select(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"), "judged", "removed")
    both = narrow.join(mine, (F.col("doc_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return both.select(
        "doc_id",
        "n_lines",
        F.coalesce("judged", F.lit(0)).cast("long").alias("n_judged"),
        F.size(gone).cast("long").alias("n_removed"),
        F.array_join(gone.cast("array<string>"), ",").alias("removed"),
    )


def op9_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = trust.judge_pages(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("print")).alias("fingerprint"), F.col("component").alias("component_id"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation of which no row is left has zeros, an empty audit and the digest of an empty text."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    facts, turns = conversation_repair.repair(conversation_repair.damage(rows))
    key = conversation_repair.KEY
    named = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    named = named.select("conv_id", F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("missing"))
    whole = named.join(facts, key, "left").join(conversation_repair.digests(turns), key, "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and name[2].isdigit()}
SQL = {
    "op3_quality_rules": sql.quality_rules(),
    "op4_chat_format": sql.chat_format(PLANTED_TEXT),
    "op7_warc": sql.warc(),
    "op9_url_trust": sql.url_trust(URL_RULES),
    "op11_conversation_repair": sql.conversation_repair(),
    "op12_mixing": sql.mixing(),
    "op13_vector_codes": sql.vector_codes(),
}
