"""Keeping the documents below a similarity threshold, with full accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from semprune.functions.names import keep_name
from semprune.operators.quantiles import thresholds_at
from semprune.session import materialize

# Largest kept-set bitmap (bytes) sent to every executor, and the size of one of its pages.
BITMAP_LIMIT = 1 << 29
BITMAP_PAGE = 4096
# Join slots over which rows without a uid are spread; they meet nothing there.
NULL_SLOTS = 1 << 20


def uid_column(df: DataFrame, uid_key: str | None = None) -> Column:
    """The column ``uid_key`` if the dataset has it, else the row index."""
    return F.col(uid_key) if uid_key and uid_key in df.columns else F.col("idx")


def numeric_similarity(sim: Column) -> Column:
    """Similarity stored as a number or as text; text that is no number becomes null."""
    return F.coalesce(sim.cast("string").try_cast("double"))


def keep_test(scores: DataFrame, threshold: float | None = None, column: str = "sim") -> Column:
    """Keep predicate: a flag stands for itself, a similarity must be strictly below the threshold."""
    kind = scores.schema[column].dataType.typeName()
    if kind == "boolean":
        return F.col(column)
    if threshold is None:
        raise ValueError("a similarity needs a threshold")
    value = F.col(column)
    if kind in ("string", "binary"):
        value = numeric_similarity(value)
    return value < F.lit(float(threshold))


def keep_flags(scores: DataFrame, quantile_table: DataFrame, fractions: list[float]) -> DataFrame:
    """One strict boolean column per keep fraction, in one pass."""
    thresholds = thresholds_at(quantile_table, fractions)
    flags = [(F.col("sim") < F.lit(t)).alias(keep_name(q)) for q, t in zip(fractions, thresholds)]
    return scores.select("uid", *flags)


def keep_map(scores: DataFrame, threshold: float | None = None) -> DataFrame:
    """(uid, keep) from similarities or flags; rows without a usable value are dropped."""
    return scores.select("uid", keep_test(scores, threshold).alias("keep")).where(F.col("keep").isNotNull())


def status_column(uid: Column, keep: Column) -> Column:
    return (
        F.when(uid.isNull(), F.lit("no_uid"))
        .when(keep.isNull(), F.lit("not_found"))
        .when(keep, F.lit("kept"))
        .otherwise(F.lit("removed"))
    )


def _lookup(narrow: DataFrame, keeps: DataFrame) -> DataFrame:
    """Left join by uid in which rows without a uid do not all meet in one task."""
    slot = F.when(F.col("uid").isNull(), F.pmod(F.xxhash64("row", "length"), F.lit(NULL_SLOTS))).otherwise(F.lit(0))
    left = narrow.withColumn("_slot", slot.cast("int"))
    return left.join(keeps.withColumn("_slot", F.lit(0)), ["uid", "_slot"], "left").drop("_slot", "row")


def _row(documents: DataFrame) -> Column:
    """What tells rows without a uid apart: the index, if there is one."""
    return (F.col("idx") if "idx" in documents.columns else F.monotonically_increasing_id()).alias("row")


def judge(
    documents: DataFrame,
    keeps: DataFrame,
    uid_key: str | None = None,
    source_key: str | None = None,
    text_key: str = "text",
) -> DataFrame:
    """Fate of every document: (uid, source, length, status).

    Only the length of the text takes part in the join, never the text.
    """
    source = F.col(source_key) if source_key and source_key in documents.columns else F.lit(None).cast("string")
    narrow = documents.select(
        uid_column(documents, uid_key).alias("uid"), source.alias("source"), F.length(text_key).alias("length"), _row(documents)
    )
    joined = _lookup(narrow, keeps)
    return joined.select("uid", "source", "length", status_column(F.col("uid"), F.col("keep")).alias("status"))


def totals(judged: DataFrame) -> DataFrame:
    """n_samples, mean_length of the kept rows, found, not_found, no_uid, removed (one row)."""

    def is_(*names: str) -> Column:
        return F.col("status").isin(*names)

    return judged.agg(
        F.count_if(is_("kept")).alias("n_samples"),
        F.avg(F.when(is_("kept"), F.col("length"))).alias("mean_length"),
        F.count_if(is_("kept", "removed")).alias("found"),
        F.count_if(is_("not_found")).alias("not_found"),
        F.count_if(is_("no_uid")).alias("no_uid"),
        F.count_if(is_("removed")).alias("removed"),
    )


def source_totals(judged: DataFrame) -> DataFrame:
    """n_samples and mean_length of the kept rows per source; rows without a source stay out."""
    kept = judged.where((F.col("status") == "kept") & F.col("source").isNotNull())
    return kept.groupBy("source").agg(F.count("*").alias("n_samples"), F.avg("length").alias("mean_length"))


def _in_bitmap(uids: DataFrame, documents: DataFrame, uid: Column) -> tuple[DataFrame, Column] | None:
    """``documents`` with a broadcast bitmap of an integer uid set, and the membership test.

    None when uids are no integers or are so sparse that the bitmap exceeds its limit.
    """
    if uids.schema["uid"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return None
    position = F.bitmap_bit_position("uid")
    pages = uids.groupBy(F.bitmap_bucket_number("uid").alias("_page")).agg(F.bitmap_construct_agg(position).alias("_bits"))
    return _marked(documents, uid, materialize(pages, "kept-bitmap"))


def _bit(bits: str, uid: Column) -> Column:
    """Whether the bit of ``uid`` is set in its page."""
    bit = F.bitmap_bit_position(uid)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))


def _marked(documents: DataFrame, uid: Column, pages: DataFrame) -> tuple[DataFrame, Column] | None:
    """``documents`` with the written ``pages(_page, _bits)`` of their uids, and the membership test; None beyond the limit."""
    if pages.count() * BITMAP_PAGE > BITMAP_LIMIT:
        return None
    marked = documents.withColumn("_page", F.bitmap_bucket_number(uid)).join(F.broadcast(pages), "_page", "left")
    return marked, _bit("_bits", uid)


def _by_index(uids: DataFrame, documents: DataFrame, uid: Column) -> tuple[DataFrame, Column] | None:
    """As ``_in_bitmap``, by the index of the documents with such a uid; no text is moved."""
    if "idx" not in documents.columns:
        return None
    narrow = documents.select("idx", uid.alias("_uid")).where(F.col("_uid").isNotNull())
    wanted = uids.select(F.col("uid").alias("_uid"))
    inside = materialize(narrow.join(wanted, "_uid", "left_semi").select(F.col("idx").alias("uid")), "kept-index")
    return _in_bitmap(inside, documents, F.col("idx"))


def prune_to_set(documents: DataFrame, kept_uids: DataFrame, uid_key: str | None = None) -> DataFrame:
    """The documents whose uid is in a kept set, with all their columns.

    Texts are far larger than the set, so the set goes to the texts where it can: integer
    uids as a bitmap of one bit each, as long as that stays within ``BITMAP_LIMIT``. For other
    uids, those of the set are looked up beside the dense ``idx`` of the documents, and the
    bitmap is one of ``idx``. Only without either are the texts joined.
    """
    uid = uid_column(documents, uid_key)
    found = _in_bitmap(kept_uids, documents, uid) or _by_index(kept_uids, documents, uid)
    if found is not None:
        return found[0].where(found[1]).select(*documents.columns)
    kept = kept_uids.select(F.col("uid").alias("_uid"))
    return documents.join(kept, uid == F.col("_uid"), "left_semi")


def prune_to_pages(documents: DataFrame, pages: DataFrame, uid_key: str | None = None) -> DataFrame:
    """The documents whose uid is set in ``pages(page, bits)``, as stored; pages are looked up, not unpacked."""
    uid = uid_column(documents, uid_key).cast("long")
    stored = materialize(pages.select(F.col("page").alias("_page"), F.col("bits").alias("_bits")), "kept-pages")
    found = _marked(documents, uid, stored)
    if found is None:
        marked = documents.withColumn("_page", F.bitmap_bucket_number(uid)).join(stored, "_page")
        found = marked, _bit("_bits", uid)
    return found[0].where(found[1]).select(*documents.columns)


def _statuses(documents: DataFrame, keeps: DataFrame, uid: Column) -> DataFrame:
    """``documents`` with ``_status``; texts stay where they are as long as two bitmaps (known, kept) are small enough."""

    def by_bits(of: DataFrame, value: Column) -> DataFrame | None:
        if of.schema["uid"].dataType.typeName() not in ("byte", "short", "integer", "long"):
            return None
        place = F.bitmap_bit_position("uid")
        pages = of.groupBy(F.bitmap_bucket_number("uid").alias("_page")).agg(
            F.bitmap_construct_agg(place).alias("_known"), F.bitmap_construct_agg(F.when(F.col("keep"), place)).alias("_kept")
        )
        pages = materialize(pages, "keep-bitmaps")
        if 2 * pages.count() * BITMAP_PAGE > BITMAP_LIMIT:
            return None
        marked = documents.withColumn("_page", F.bitmap_bucket_number(value)).join(F.broadcast(pages), "_page", "left")
        keep = F.when(_bit("_known", value), _bit("_kept", value))
        return marked.withColumn("_status", status_column(uid, keep)).drop("_page", "_known", "_kept")

    found = by_bits(keeps, uid)
    if found is None and "idx" in documents.columns:
        narrow = documents.select("idx", uid.alias("uid")).where(F.col("uid").isNotNull())
        found = by_bits(materialize(narrow.join(keeps, "uid").select(F.col("idx").alias("uid"), "keep"), "keeps-by-index"), F.col("idx"))
    if found is None:
        known = keeps.select(F.col("uid").alias("_uid"), "keep")
        found = documents.join(known, uid == F.col("_uid"), "left").withColumn("_status", status_column(uid, F.col("keep"))).drop("_uid", "keep")
    return found


#: Sources that are counted while documents are written.
OBSERVED_SOURCES = 64


class ObservedPrune:
    """The kept documents, and the statistics that fall out of writing them once.

    ``kept`` must be written (or run otherwise) once; then ``totals`` and ``source_totals`` are those of ``totals`` and
    ``source_totals`` of this module, without a second pass over the documents. A write that failed
    says nothing: make a new object for the next try. Sources are listed first, from their column alone; with more than
    ``OBSERVED_SOURCES`` of them, ``source_totals`` is None.
    """

    def __init__(self, documents: DataFrame, keeps: DataFrame, uid_key: str | None = None, source_key: str | None = None, text_key: str = "text"):
        self.spark = documents.sparkSession
        self.sources: list | None = []
        if source_key and source_key in documents.columns:
            listed = documents.select(F.col(source_key).alias("source")).where("source IS NOT NULL").distinct().limit(OBSERVED_SOURCES + 1)
            found = sorted(r.source for r in listed.collect())
            self.sources = found if len(found) <= OBSERVED_SOURCES else None
            self._source_type = documents.schema[source_key].dataType.simpleString()
        marked = _statuses(documents, keeps.select("uid", "keep"), uid_column(documents, uid_key))
        status, length = F.col("_status"), F.length(text_key)
        is_kept = status == "kept"
        counts = [F.count_if(status == name).alias(name) for name in ("kept", "removed", "not_found", "no_uid")]
        counts.append(F.sum(F.when(is_kept, length)).alias("length"))
        for i, source in enumerate(self.sources or []):
            own = is_kept & (F.col(source_key) == F.lit(source))
            counts += [F.count_if(own).alias(f"n{i}"), F.sum(F.when(own, length)).alias(f"length{i}")]
        self._observation = Observation()
        self.kept = marked.observe(self._observation, *counts).where(is_kept).select(*[F.col(f"`{c}`") for c in documents.columns])

    def totals(self) -> DataFrame:
        """One row, as ``totals``."""
        x = self._observation.get
        mean = x["length"] / x["kept"] if x["kept"] else None
        row = (x["kept"], mean, x["kept"] + x["removed"], x["not_found"], x["no_uid"], x["removed"])
        return self.spark.createDataFrame([row], "n_samples long, mean_length double, found long, not_found long, no_uid long, removed long")

    def source_totals(self) -> DataFrame | None:
        """A row for each source with kept documents, as ``source_totals``."""
        if self.sources is None:
            return None
        x = self._observation.get
        rows = [(s, x[f"n{i}"], x[f"length{i}"] / x[f"n{i}"]) for i, s in enumerate(self.sources) if x[f"n{i}"]]
        kind = self._source_type if self.sources else "string"
        return self.spark.createDataFrame(rows, f"source {kind}, n_samples long, mean_length double")


def prune_documents(documents: DataFrame, keeps: DataFrame, uid_key: str | None = None) -> DataFrame:
    """The kept documents with all their columns."""
    return prune_to_set(documents, keeps.where("keep").select("uid"), uid_key)


def outside_set(documents: DataFrame, kept_uids: DataFrame, uid_key: str | None = None) -> DataFrame:
    """The documents whose uid is not in a kept set (removed, in set form)."""
    uid = uid_column(documents, uid_key)
    named = documents.where(uid.isNotNull())
    found = _in_bitmap(kept_uids, named, uid) or _by_index(kept_uids, named, uid)
    if found is not None:
        return found[0].where(~found[1]).select(*documents.columns)
    kept = kept_uids.select(F.col("uid").alias("_uid"))
    return named.join(kept, uid == F.col("_uid"), "left_anti")


def set_totals(documents: DataFrame, kept_uids: DataFrame, uid_key: str | None = None, text_key: str = "text") -> DataFrame:
    """Totals for the set form: a document outside the set is both not found and removed."""
    narrow = documents.select(uid_column(documents, uid_key).alias("uid"), F.length(text_key).alias("length"), _row(documents))
    marked = _lookup(narrow, kept_uids.select("uid").distinct().withColumn("keep", F.lit(True)))
    kept, outside = F.col("keep").isNotNull(), F.col("uid").isNotNull() & F.col("keep").isNull()
    return marked.agg(
        F.count_if(kept).alias("n_samples"),
        F.avg(F.when(kept, F.col("length"))).alias("mean_length"),
        F.count_if(F.col("uid").isNotNull()).alias("found"),
        F.count_if(outside).alias("not_found"),
        F.count_if(F.col("uid").isNull()).alias("no_uid"),
        F.count_if(outside).alias("removed"),
    )
