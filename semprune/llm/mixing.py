"""Mixing of sources to target weights: whole repetitions, and one more copy by a seeded coin.

Words are added up for each source. The words of the mix are shared out by weight; a target stops at ``most`` times the
words of its source, and what is over goes to the others by weight until no target is above. That is one level: each
target is ``min(most * words, level * weight)``, and the level is found by raising it, each time to what the sources not yet
full must carry; a round adds up the (written) table of sources and brings back two sums.

A document of a source with rate ``target / words`` is emitted ``floor(rate)`` times, and once more if its coin, a hash of
seed, id, source and text, falls below the fraction. Equal rows are numbered and each has a coin of its own, so
that a crowd of copies follows the rate as other rows do. Results depend on the rows alone, not on files, partitions or runs.

Everything is DataFrame functions. Sources are added up before the shuffle; their table is broadcast if small, and otherwise joined by a
shuffle in which adaptive execution splits a hot source. Texts are never shuffled, save those of repeated rows.

Defined cases: a missing text has no words; a missing source is a source, the last; a source without words has target 0. Texts are read
whole. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.llm.common import WORD, broadcast_if_small, clean_text
from semprune.operators.positions import position_by_order
from semprune.session import materialize

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a part of all words; most repeats of a source.
SHARE = 1.5
MOST = 2.0
SEED = 42
#: The coin has 52 bits, as many as a double holds exactly.
COIN_DIGITS = 13


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def identity(doc_id: Column, source: Column, text: Column) -> Column:
    """Equal for rows of equal id, source and text."""
    known = lambda c: F.coalesce(F.md5(c.cast("binary")), F.lit(""))
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), known(source), known(text)).cast("binary"))


def coin(key: Column, number: Column, seed: int) -> Column:
    """A number from 0 to 1, below 1, that is the same in every run."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key, number.cast("string")).cast("binary")), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**COIN_DIGITS)


def water_level(sources: DataFrame, share: float = SHARE, most: float = MOST) -> float:
    """The level of written ``sources(weight, words)``; the sums over sources are two numbers a round."""
    level = 0.0
    full = lambda at: F.lit(most) * F.col("words") <= F.lit(at) * F.col("weight")
    while True:
        row = sources.agg(
            F.sum("words").alias("total"),
            F.sum(F.when(full(level), F.col("words")).otherwise(0)).alias("full"),
            F.sum(F.when(full(level), 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row.weight:
            return level
        raised = (share * row.total - most * row.full) / row.weight
        if raised <= level:
            return level
        level = raised


def source_targets(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, words, weight, target) for each source of ``measured(source, size)``."""
    sums = materialize(measured.groupBy("source").agg(F.sum("size").alias("words")), "source-words")
    ranked = position_by_order(sums, [], [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(ranked.select("source", "words", weight.cast("long").alias("weight")), "sources")
    level = water_level(sources, share, most)
    target = F.least(F.lit(most) * F.col("words"), F.lit(level) * F.col("weight"))
    return sources.select("source", "words", "weight", target.alias("target"))


def _numbered(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """``rows`` with ``number``: 0, 1, … among rows of one key; only rows with repeated keys move."""
    repeated = materialize(measured.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated")
    if not repeated.limit(1).count():
        return rows.withColumn("number", F.lit(0).cast("long"))
    marked = broadcast_if_small(repeated, 48)
    many = rows.join(marked, "key", "left_semi").withColumn("whole", F.xxhash64("doc")).withColumn("row", F.monotonically_increasing_id())
    numbered = position_by_order(many, ["key"], [F.col("whole"), F.col("row")], "number").drop("whole", "row")
    return rows.join(marked, "key", "left_anti").withColumn("number", F.lit(0).cast("long")).unionByName(numbered)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(doc, size, source_size, target, copies) for each row of ``docs(doc_id, source, text, …)``; ``doc`` holds the row."""
    text = clean_text("doc.text")
    key = identity(F.col("doc.doc_id"), F.col("doc.source"), F.col("doc.text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select("doc", words(text).alias("size"), key.alias("key"))
    measured = materialize(rows.select(F.col("doc.source").alias("source"), "size", "key"), "documents-measured")
    targets = materialize(source_targets(measured, weights, share, most).select("source", "words", "target"), "targets")
    both = _numbered(rows, measured).join(broadcast_if_small(targets, 128), F.col("doc.source").eqNullSafe(F.col("source")))
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    whole = F.floor(rate)
    more = coin(F.col("key"), F.col("number"), seed) < rate - whole
    return both.select("doc", "size", F.col("words").alias("source_size"), "target", (whole + more.cast("long")).cast("int").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, each as many times as it has copies."""
    times = F.sequence(F.lit(1), F.col("copies"))
    return mixed.where("copies > 0").select("doc", F.explode(times).alias("copy")).select("doc.*")
