"""Near-equal lines across all documents: an exact set-similarity join that removes later matches.

A line is the set of its lower-cased words. It is removed if an earlier line (by document id, then line
number) has a Jaccard similarity of 0.8 or more to it, removed itself or not. Lines without
words are not judged.

Plan. Words are counted in 2^20 hash buckets, a table of fixed size that is broadcast; words in rare buckets
come first in the order of every line. Lines with equal sets are one class, numbered by its first line,
so copies never meet; up to ``EQUAL_WORDS`` words nothing else is similar. Similar sets share a word in their prefixes (the first n - ceil(0.8 n) + 1 words), so
classes meet by prefix word, and length, positional and bitmap bounds drop nearly all pairs that cannot be
similar; each bound is exact. A class needs one earlier match only: a word proposes the
earliest few partners first, these are verified on the texts, and the next round proposes further ones for
classes that have none yet, until none are left. A crowd of n near-equal lines thus has about n pairs verified. A task keeps no more than
the earliest partners that its round wants. The lines of a very frequent prefix word are dealt over tiles, each pair of tiles a
group of its own, and what the groups say of a line is put together; which words are frequent is told by a sample, on which
only the dealing depends.

Defined cases: a missing text is empty; rows equal in id and text are one document and get one decision; a missing
id comes last; lines are cut at ``\\n`` and read whole. Where documents are returned, columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.llm.common import BROADCAST_BYTES, broadcast_if_small, clean_text
from semprune.llm.word_hashes import mixed, word_hashes
from semprune.session import materialize

#: Lines with fewer different words are not judged.
MIN_WORDS = 1
#: A set of at most so many words is similar to no other set: 3 of 4 words are 0.75.
EQUAL_WORDS = 3
BUCKET_BITS = 20
SLICES = 64
#: Partners of a class that a word proposes by round: from, up to.
ROUNDS = ((0, 1), (1, 32), (32, 1 << 10), (1 << 10, 1 << 15), (1 << 15, 1 << 62))
KEPT_LINES = 300_000
BYTES_AT_ONCE = 1_000_000
PAIRS_AT_ONCE = 2_000_000
#: Pairs a task keeps before it drops those beyond the earliest.
PAIRS_KEPT = 4_000_000
#: A word with more lines is dealt over tiles, of so many lines at least and at most where there are many.
TILE_LINES = 512
TILES = 16
MOST_TILE_LINES = 8192
#: One class in so many tells how many lines a word has.
COUNTED = 16
WIDEST = 65535

LINES = "doc_id long, doc_hash long, line int, k1 long, k2 long, k3 long, size int, prefix array<int>"
PAIRS = "i long, j long"


def document_key() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("doc_hash")]


# --- rarity ----------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """(keys of documents, their texts), about a megabyte at a time."""
    keys, texts, size = [], [], 0
    for batch in batches:
        *names, text = batch.columns
        for key, value in zip(zip(*[n.to_pylist() for n in names], strict=True) if names else [()] * len(text), text, strict=True):
            keys.append(key)
            texts.append((value.as_py() or "").encode())
            size += len(texts[-1])
            if size >= BYTES_AT_ONCE:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for _, texts in _chunks(batches):
        words, _ = word_hashes(b"\n".join(texts))
        counts += np.bincount((words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
    parts = counts.reshape(SLICES, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "counts"])


def _add_counts(key: tuple, rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in rows.column("counts"))
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def rarity(docs: DataFrame) -> np.ndarray:
    """Place of each hash bucket in the order from rare to frequent; always 2^20 numbers."""
    counted = docs.select(F.col("text").cast("string")).mapInArrow(_count_words, "slice int, counts binary")
    added = counted.groupBy("slice").applyInArrow(_add_counts, "slice int, counts binary").collect()
    counts = np.zeros((SLICES, (1 << BUCKET_BITS) // SLICES), np.int64)
    for row in added:
        counts[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    places = np.empty(1 << BUCKET_BITS, np.uint32)
    places[np.argsort(counts.ravel(), kind="stable")] = np.arange(1 << BUCKET_BITS, dtype=np.uint32)
    return places


# --- lines -----------------------------------------------------------------------------------


def prefix_length(n):
    """Words of which two similar sets must share one: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


def _by_line(key: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Order by (line, key); the first bits of both decide unless different words share them."""
    short = (line.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20))
    order = np.argsort(short)
    key, short = key[order], short[order]
    unsure = (short[1:] == short[:-1]) & (key[1:] != key[:-1])
    return np.lexsort((key[np.argsort(order)], line)) if unsure.any() or (len(line) and line[-1] >> 20) else order


def _line_rows(keys: list[tuple], texts: list[bytes], places: np.ndarray, seen: set) -> pa.RecordBatch:
    data = b"\n".join(texts)
    value, begin = word_hashes(data)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    low = np.uint64(64 - BUCKET_BITS)
    key = (places[(value >> low).astype(np.int64)].astype(np.uint64) << low) | (value & np.uint64((1 << (64 - BUCKET_BITS)) - 1))
    line = np.searchsorted(ends, begin)
    order = _by_line(key, line)
    key, line = key[order], line[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
    key, line = key[fresh], line[fresh]
    # only lines with words, numbered anew
    counts = np.bincount(line, minlength=len(ends) + 1)
    judged = np.flatnonzero(counts >= MIN_WORDS)
    kept = counts[line] >= MIN_WORDS
    key, size = key[kept], counts[judged]
    start = np.cumsum(size) - size
    line = np.repeat(np.arange(len(size)), size)
    word = mixed(key)
    # a bitmap of 128 bits, of which each word turns one
    turned, half = np.uint64(1) << (word & np.uint64(63)), (word >> np.uint64(6) & np.uint64(1)) == 1
    bit = lambda mine: np.bitwise_xor.reduceat(np.where(mine, turned, np.uint64(0)), start) if len(start) else np.zeros(0, np.uint64)
    k1 = np.add.reduceat(word, start) if len(start) else np.zeros(0, np.uint64)
    k2, k3 = bit(half), bit(~half)
    new = np.zeros(len(size), bool)
    for i, name in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
        if name not in seen:
            new[i] = True
            if len(seen) < KEPT_LINES:
                seen.add(name)
    # sets that can be similar to another one
    paired = new & (size > EQUAL_WORDS)
    at = np.arange(len(key)) - start[line]
    chosen = (at < prefix_length(size)[line]) & paired[line]
    name = (word[chosen] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    offsets = np.concatenate([[0], np.cumsum(np.where(paired, prefix_length(size), 0))]).astype(np.int32)
    prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(name), mask=pa.array(~paired))
    # line numbers count from the first line of their document
    lines_of = np.array([t.count(b"\n") + 1 for t in texts])
    first = np.cumsum(lines_of) - lines_of
    doc = np.searchsorted(first, judged, "right") - 1
    column = lambda k: pa.array([key[k] for key in keys], pa.int64()).take(pa.array(doc))
    bits = [pa.array(x.view(np.int64)) for x in (k1, k2, k3)]
    number, width = (pa.array(x.astype(np.int32)) for x in (judged - first[doc], np.minimum(size, WIDEST)))
    return pa.RecordBatch.from_arrays([column(0), column(1), number, *bits, width, prefix], ["doc_id", "doc_hash", "line", "k1", "k2", "k3", "size", "prefix"])


def _lines(batches: Iterator[pa.RecordBatch], places) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()
    for keys, texts in _chunks(batches):
        yield _line_rows(keys, texts, places.value, seen)


def judged_lines(docs: DataFrame, places: np.ndarray) -> DataFrame:
    """(doc_id, doc_hash, line, k1, k2, k3, size, prefix) of each judged line; (k1, k2, k3) names its set, k2 and k3 are its bitmap.

    The prefix, 32 bits of each word's hash in order, is there once at least for each set.
    """
    held = docs.sparkSession.sparkContext.broadcast(places)
    rows = docs.select(*document_key(), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _lines(b, held), LINES)


def line_classes(lines: DataFrame) -> DataFrame:
    """(cid, doc_id, doc_hash, line, k2, k3, size, prefix) of each different set; ``cid`` ascends with the first line."""
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc_hash", "line")
    classes = lines.groupBy("k1", "k2", "k3").agg(F.min(first).alias("first"), F.max("size").alias("size"), F.max("prefix").alias("prefix"))
    numbered = classes.orderBy("first").withColumn("cid", F.monotonically_increasing_id())
    return numbered.select("cid", "first.doc_id", "first.doc_hash", "first.line", "k2", "k3", "size", "prefix")


# --- candidates ------------------------------------------------------------------------------


def _likely(i: np.ndarray, j: np.ndarray, size: np.ndarray, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Pairs of lines that the place of the shared word and the word bitmaps do not rule out."""
    a, b = size[i], size[j]
    needed = (4 * (a + b) + 8) // 9
    wide = np.maximum(a, b) == WIDEST
    # the shared word is the first one for one of the words that bring a similar pair together
    left = np.flatnonzero((np.minimum(a - at[i], b - at[j]) >= needed) | wide)
    i, j = i[left], j[left]
    apart = np.bitwise_count(bits[0][i] ^ bits[0][j]).astype(np.int32) + np.bitwise_count(bits[1][i] ^ bits[1][j])
    return left[(apart <= (a + b - 2 * needed)[left]) | wide[left]]


def _earliest(i: np.ndarray, j: np.ndarray, cid: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, rank): partners of each line at a word, earliest first, one more than ``end`` at most."""
    order = np.lexsort((cid[i], j))
    i, j = i[order], j[order]
    rank = np.arange(len(j)) - np.searchsorted(j, j, "left")
    near = rank <= end
    return i[near], j[near], rank[near]


def _pairs(table: pa.Table, end: int) -> tuple[np.ndarray, ...]:
    """(word, cid, i, j, rank) with lines i and j by place, from all lines of the groups of a task."""
    packed = table.column("packed").to_numpy().view(np.uint64)
    tiled = "tiles" in table.column_names
    group = np.unique(np.stack([packed >> np.uint64(32), table.column("tiles").to_numpy().view(np.uint64)]), axis=1, return_inverse=True)[1].astype(np.uint64) if tiled else packed >> np.uint64(32)
    # by group, then by size: only lines of similar size are paired
    key = group << np.uint64(16) | (packed >> np.uint64(16) & np.uint64(WIDEST))
    order = np.argsort(key, kind="stable")
    packed, group, key = packed[order], group[order], key[order]
    cid, asks = table.column("cid").to_numpy()[order], table.column("open").to_numpy(zero_copy_only=False)[order]
    side = table.column("side").to_numpy()[order] if tiled else None
    bits = [table.column(k).to_numpy().view(np.uint64)[order] for k in ("k2", "k3")]
    size = (packed >> np.uint64(16) & np.uint64(WIDEST)).astype(np.int32)
    at = (packed & np.uint64(WIDEST)).astype(np.int32)
    least = np.where(size == WIDEST, 0, (4 * size + 4) // 5).astype(np.uint64)
    first = np.searchsorted(key, (group << np.uint64(16)) | least)
    total = np.cumsum(np.arange(len(key)) - first)
    found_i, found_j, held = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], 0
    low = 0
    while low < len(key):
        base = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, base + PAIRS_AT_ONCE, "right")))
        n = np.arange(low, high) - first[low:high]
        b = np.repeat(np.arange(low, high, dtype=np.int32), n)
        a = (np.arange(len(b)) + np.repeat(first[low:high] - (np.cumsum(n) - n), n)).astype(np.int32)
        if tiled:
            # lines of one of two different tiles meet in a group of their own
            some = (side[a] != side[b]) | (side[a] == BOTH)
            a, b = a[some], b[some]
        some = _likely(a, b, size, at, bits)
        a, b = a[some], b[some]
        later = np.where(cid[a] > cid[b], a, b)
        some = asks[later] & (cid[a] != cid[b])
        found_j.append(later[some])
        found_i.append((a + b - later)[some])
        held += len(found_j[-1])
        low = high
        if held > PAIRS_KEPT:
            i, j, _ = _earliest(np.concatenate(found_i), np.concatenate(found_j), cid, end)
            found_i, found_j, held = [i], [j], 0
    return packed >> np.uint64(32), cid, *_earliest(np.concatenate(found_i), np.concatenate(found_j), cid, end)


def _propose(batches: Iterator[pa.RecordBatch], begin: int, end: int) -> Iterator[pa.RecordBatch]:
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    word, cid, i, j, rank = _pairs(pa.Table.from_batches(tables), end)
    wanted, more = (rank >= begin) & (rank < end), np.unique(j[rank >= end])
    pairs = np.unique(np.stack([cid[i[wanted]], cid[j[wanted]]]), axis=1)
    left = np.concatenate([pairs[0], -1 - word[more].astype(np.int64)])
    yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(np.concatenate([pairs[1], cid[more]]))], ["i", "j"])


def _propose_tiled(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[pa.RecordBatch]:
    tables = [b for b in batches if b.num_rows]
    if tables:
        word, cid, i, j, _ = _pairs(pa.Table.from_batches(tables), end)
        yield pa.RecordBatch.from_arrays([pa.array(word[j].astype(np.int64)), pa.array(cid[j]), pa.array(cid[i])], ["word", "j", "i"])


def word_of(packed: str) -> Column:
    return F.shiftrightunsigned(packed, 32)


#: Side of a line in a group that is one tile.
BOTH = 2


def frequent_words(words: DataFrame) -> DataFrame:
    """(word, n_tiles) of the words that are dealt over tiles, written."""
    few = words.where(F.pmod(F.xxhash64("cid"), F.lit(COUNTED)) == 0).groupBy(word_of("packed").alias("word")).agg((F.count("*") * COUNTED).alias("n"))
    tiles = F.greatest(F.least(F.ceil(F.col("n") / TILE_LINES), F.lit(TILES)), F.ceil(F.col("n") / MOST_TILE_LINES))
    return materialize(few.where(F.col("n") > TILE_LINES).select("word", F.least(tiles, F.lit(1 << 20)).cast("long").alias("n_tiles")), "words-frequent")


def propose(words: DataFrame, begin: int, end: int) -> DataFrame:
    """(i, j): earlier partners number ``begin`` to ``end`` of each open class at each word.

    Where a class has more partners at a word, there is a row with i = -1 - word.
    """
    alone = lambda rows: rows.repartition(word_of("packed")).mapInArrow(lambda b: _propose(b, begin, end), PAIRS)
    frequent = frequent_words(words)
    if not frequent.limit(1).count():
        return alone(words).distinct()
    listed = broadcast_if_small(frequent.withColumnRenamed("word", "frequent"), 24)
    rare = words.join(listed, word_of("packed") == F.col("frequent"), "left_anti")
    rows = words.join(listed, word_of("packed") == F.col("frequent"))
    own = F.pmod(F.xxhash64("cid"), "n_tiles")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1)))
    pair = F.shiftleft(F.least("own", "other"), 20).bitwiseOR(F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), BOTH).otherwise((F.col("own") > F.col("other")).cast("int"))
    rows = rows.select("cid", "k2", "k3", "packed", "open", pair.alias("tiles"), side.alias("side"))
    found = rows.repartition(word_of("packed"), "tiles").mapInArrow(lambda b: _propose_tiled(b, end), "word long, j long, i long")
    whole = found.groupBy("word", "j").agg(F.sort_array(F.collect_set("i")).alias("all"))
    chosen = F.slice("all", begin + 1, min(end, 1 << 30) - begin)
    more = F.when(F.size("all") > min(end, 1 << 30), F.array(-1 - F.col("word"))).otherwise(F.array().cast("array<long>"))
    tiled = whole.select(F.explode(F.concat(chosen, more)).alias("i"), "j")
    return alone(rare).unionByName(tiled).distinct()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
            x, y = (set(t.as_py().encode().lower().split()) for t in (a, b))
            both = len(x & y)
            kept.append(5 * both >= 4 * (len(x) + len(y) - both))
        yield batch.filter(pa.array(kept, pa.bool_())).select(["i", "j"])


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose first lines have a Jaccard similarity of 0.8 or more."""
    needed = pairs.select(F.col("i").alias("cid")).unionByName(pairs.select(F.col("j").alias("cid"))).distinct()
    needed = materialize(classes.select("cid", "doc_id", "doc_hash", "line").join(needed, "cid"), "lines-needed")
    keyed = docs.select(*document_key(), clean_text().alias("text"))
    here = needed.select("cid", F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"), "line")
    found = keyed.join(broadcast_if_small(here, 32), (keyed.doc_hash == F.col("_hash")) & keyed.doc_id.eqNullSafe(F.col("_id")))
    texts = found.select("cid", F.get(F.split("text", "\n"), F.col("line")).alias("t")).groupBy("cid").agg(F.min("t").alias("t"))
    texts = materialize(texts, "lines-proposed")
    both = pairs.join(texts.select(F.col("cid").alias("i"), F.col("t").alias("a")), "i").join(texts.select(F.col("cid").alias("j"), F.col("t").alias("b")), "j")
    return both.select("i", "j", "a", "b").mapInArrow(_verify, PAIRS)


def dropped_classes(classes: DataFrame, docs: DataFrame, rounds=ROUNDS) -> DataFrame:
    """(cid) of classes to which an earlier one is similar."""
    every = classes.select("cid", "k2", "k3", "size", F.posexplode("prefix").alias("at", "word"))
    place = F.shiftleft("size", 16).bitwiseOR(F.least("at", F.lit(WIDEST))).cast("long").bitwiseAND(0xFFFFFFFF)
    every = every.select("cid", "k2", "k3", F.shiftleft(F.col("word").cast("long"), 32).bitwiseOR(place).alias("packed"))
    words, dropped = every.withColumn("open", F.lit(True)), None
    for begin, end in rounds:
        proposed = materialize(propose(words, begin, end), "line-pairs")
        matched = materialize(verified(proposed.where("i >= 0"), classes, docs).select(F.col("j").alias("cid")).distinct(), "lines-matched")
        dropped = matched if dropped is None else materialize(dropped.unionByName(matched), "lines-matched")
        more = proposed.where("i < 0").select((-1 - F.col("i")).alias("word"), F.col("j").alias("cid")).join(dropped, "cid", "left_anti")
        more = materialize(more, "lines-open")
        if not more.limit(1).count():
            break
        # the next round needs the lines of these words only
        wanted = materialize(more.select("word").distinct(), "words-open")
        rows = every.withColumn("word", word_of("packed")).join(broadcast_if_small(wanted, 16), "word", "left_semi")
        still = more.withColumn("open", F.lit(True))
        words = rows.join(broadcast_if_small(still, 24), ["word", "cid"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    return dropped


# --- documents -------------------------------------------------------------------------------


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, judged, removed): line numbers that go, for each document with judged lines."""
    lines = materialize(judged_lines(docs, rarity(docs)), "lines")
    classes = materialize(line_classes(lines), "line-classes")
    kept = classes.select("cid", "doc_id", "doc_hash", "line").join(dropped_classes(classes, docs), "cid", "left_anti")
    narrow = lines.select("doc_id", "doc_hash", "line", F.lit(False).alias("kept"))
    both = narrow.unionByName(kept.select("doc_id", "doc_hash", "line", F.lit(True).alias("kept")))
    stays = F.collect_list(F.when(F.col("kept"), F.col("line")))
    judged = F.collect_set("line")
    removed = both.groupBy("doc_id", "doc_hash").agg(F.size(judged).alias("judged"), F.sort_array(F.array_except(judged, stays)).alias("removed"))
    return removed


def removed_of(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """(doc, gone): each document whole, and the numbers of its lines that go, from the written ``removed``.

    The short lists go to the documents if they are small together; only beyond that are documents shuffled.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *document_key())
    mine = removed.where(F.size("removed") > 0).select(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_hash"), "removed")
    size = mine.agg(F.sum(F.size("removed") * 4 + 64)).first()[0] or 0
    mine = F.broadcast(mine) if size <= BROADCAST_BYTES else mine
    joined = keyed.join(mine, (keyed.doc_hash == F.col("_hash")) & keyed.doc_id.eqNullSafe(F.col("_id")), "left")
    return joined.select("doc", F.coalesce("removed", F.array().cast("array<int>")).alias("gone"))


def with_removed(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with ``removed_lines``, an array of line numbers, empty where nothing goes."""
    return removed_of(docs.drop("removed_lines"), removed).select("doc.*", F.col("gone").alias("removed_lines"))


def without_lines(text: Column, gone: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(gone, i))
    return F.when(F.size(gone) > 0, F.array_join(lines, "\n")).otherwise(text)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with later matches taken out of ``text``, and ``removed_lines``. It is read often: pass a written table."""
    found = materialize(removed_lines(docs), "lines-removed")
    return with_removed(docs, found).withColumn("text", without_lines(F.col("text"), F.col("removed_lines")))
