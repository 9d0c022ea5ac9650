"""Quality rules: word and line measures, and how far a text is from the references of its language.

Two histograms of a document are compared with the references of its language by Jensen-Shannon
distance (square root of the divergence to base 2, from 0 to 1): character classes, and common
words. References are the mean histograms over trusted documents of a language: those that are labelled as good and pass the
base rules. They are fitted once, written with a version and read again, so a verdict depends on the document and the references alone,
whatever else is in the table. A document is rejected if its characters are far off, or if both histograms are somewhat
off. Histograms of short texts are noise, so each comparison needs a minimum length. All steps are
DataFrame operations; the text is read once, without a shuffle.

Defined cases: a missing text has no words and fails; a language that is missing or has no reference
is compared with the mean over all languages, as is a table without ``lang``; with no reference at all (nothing trusted
passed the base rules) only the base rules judge; a document too short for a comparison passes it. Texts are read whole,
repeated rows are judged each. Columns of any name are kept; ``quality`` and ``kept`` are set here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semprune.llm.common import SPACE, broadcast_if_small, clean_text, words_of
from semprune.session import materialize

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Frequent words of each language; together the bins of the word histogram. Fixed values.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this", "from", "or", "an"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus", "pas", "au"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo"],
}
COMMON = sorted({w for words in COMMON_WORDS.values() for w in words})
LONGEST_COMMON = max(map(len, COMMON))

#: Character classes in the order of their histogram.
CLASSES = ("word", "space", "upper", "symbol", "other")
MIN_CHARS = 200
MIN_COMMON_WORDS = 50
FAR_CHARS = 0.25
ODD_CHARS = 0.12
ODD_WORDS = 0.2


def _without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, f"[{characters}]+", "")


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda s, x: s + x)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``quality``: the base measures and both histograms as counts."""
    kept = [c for c in docs.columns if c.lower() not in ("quality", "kept")]
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), clean_text().alias("t"))
    df = df.select("doc", "t", words_of(F.col("t")).alias("words"), _without(F.col("t"), r"\p{Ll}\p{Nd}").alias("t1"))
    df = df.select("*", F.size("words").cast("long").alias("n_words"), _without(F.col("t1"), SPACE).alias("t2"))
    df = df.select("*", _without(F.col("t2"), r"\p{Lu}").alias("t3"))
    df = df.select("*", _without(F.col("t3"), "#*$%&|<>").alias("t4"))
    length = [F.length(c).cast("long") for c in ("t", "t1", "t2", "t3", "t4")]

    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    short = F.regexp_extract_all(F.lower("t"), F.lit(rf"(?<!\p{{L}})\p{{L}}{{1,{LONGEST_COMMON}}}(?!\p{{L}})"), F.lit(0))
    windows = F.when(
        F.col("n_words") > 2,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    )
    df = df.select(
        "doc", "n_words",
        (length[0] - length[1] + length[2]).alias("word_chars"),
        F.array(length[0] - length[1], length[1] - length[2], length[2] - length[3], length[3] - length[4], length[4]).alias("chars"),
        lines.alias("lines"),
        F.sort_array(F.filter(short, lambda w: w.isin(COMMON))).alias("found"),
        windows.alias("windows"),
    )

    # windows next to an equal one, once sorted, are repeated; the sort is left out where all differ
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.select("*", F.array_distinct("found").alias("bins"), F.when(repeats, pairs).alias("pairs"))
    same = lambda x, j: F.coalesce(x["h"] == F.get("pairs", j)["h"], F.lit(False))
    twice = F.filter("pairs", lambda x, i: same(x, i - 1) | same(x, i + 1))
    df = df.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("at"))
    covered = F.transform("at", lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("at", i - 1), F.lit(-3))).cast("long"))
    # the bins are sorted, so a bin ends where the next one begins
    begin = lambda w: F.array_position("found", w)
    ends = lambda i: F.coalesce(begin(F.get("bins", i + 1)), F.size("found") + F.lit(1).cast("long"))
    common = F.transform("bins", lambda w, i: F.struct(w.alias("word"), (ends(i) - begin(w)).alias("n")))
    quality = F.struct(
        "n_words", "word_chars",
        F.get("chars", F.lit(3)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_total(covered), F.lit(0).cast("long")).alias("n_repeat_words"),
        "chars",
        common.alias("common"),
    )
    return df.select("doc.*", quality.alias("quality"))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MAX_REPEATED_PERCENT)


def trusted(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``measured`` documents that ``labels(doc_id, quality)`` calls good."""
    good = materialize(labels.where("quality = 1").select("doc_id").distinct(), "labelled-good")
    return measured.join(broadcast_if_small(good, 16), "doc_id", "left_semi")


def references(measured: DataFrame) -> DataFrame:
    """(lang, chars, words, rest): mean histograms of a language; lang ``*`` is over all given documents.

    ``words`` maps a common word to its share, ``rest`` is the share of all other words.
    """
    q = F.col("quality")
    lang = F.col("lang") if "lang" in measured.columns else F.lit(None).cast("string")
    passed = measured.where(~base_failed(q)).select(F.explode(F.array(lang, F.lit("*"))).alias("lang"), q.alias("q")).where("lang IS NOT NULL")
    n_chars = _total(F.col("q.chars"))
    shares = [F.avg(F.get("q.chars", F.lit(i)) / n_chars).alias(f"c{i}") for i in range(len(CLASSES))]
    chars = passed.groupBy("lang").agg(F.count("*").alias("docs"), *shares)
    one = passed.select("lang", "q.n_words", F.explode("q.common").alias("bin"))
    words = one.groupBy("lang", "bin.word").agg(F.sum(F.col("bin.n") / F.col("n_words")).alias("share"))
    words = words.groupBy("lang").agg(F.collect_list(F.struct("word", "share")).alias("bins"))
    joined = chars.join(words, "lang", "left")
    bins = F.transform(F.coalesce("bins", F.array().cast("array<struct<word:string,share:double>>")), lambda b: F.struct(b["word"].alias("word"), (b["share"] / F.col("docs")).alias("share")))
    total = F.aggregate(bins, F.lit(0.0), lambda s, b: s + b["share"])
    return joined.select("lang", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("chars"), F.map_from_entries(bins).alias("words"), (1 - total).alias("rest"))


def write_references(found: DataFrame, path: str) -> None:
    """References, few rows, with a version that depends on all of them."""
    found = materialize(found, "quality-references")
    words = F.sort_array(F.map_entries("words"))
    version = found.select(F.coalesce(F.sum(F.xxhash64("lang", "chars", words, "rest").cast("decimal(38,0)")), F.lit(0)).cast("string")).first()[0]
    found.withColumn("version", F.lit(version)).coalesce(1).write.parquet(path)


def read_references(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Written references; with ``version``, any other fails."""
    found = spark.read.parquet(path)
    if version is not None and found.where(F.col("version") != version).limit(1).count():
        raise ValueError(f"{path} does not hold version {version}")
    return found.drop("version")


def _part(p: Column, q: Column) -> Column:
    """Contribution of one bin to twice the divergence."""
    term = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return term(p) + term(q)


def char_distance(q: Column, reference: Column) -> Column:
    shares = F.transform(q["chars"], lambda n: n / _total(q["chars"]))
    parts = F.zip_with(shares, reference["chars"], _part)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def word_distance(q: Column, reference: Column) -> Column:
    """Bins the document lacks count with their whole share."""
    share = lambda b: b["n"] / q["n_words"]
    expected = lambda b: F.coalesce(F.element_at(reference["words"], b["word"]), F.lit(0.0))
    parts = F.aggregate(q["common"], F.lit(0.0), lambda s, b: s + _part(share(b), expected(b)))
    seen = F.aggregate(q["common"], F.lit(0.0), lambda s, b: s + expected(b))
    rest = 1 - F.aggregate(q["common"], F.lit(0.0), lambda s, b: s + share(b))
    lacking = F.greatest(1 - seen - reference["rest"], F.lit(0.0))
    whole = parts + _part(F.greatest(rest, F.lit(0.0)), F.greatest(reference["rest"], F.lit(0.0))) + lacking
    return F.sqrt(F.greatest(whole / 2, F.lit(0.0)))


def judge(measured: DataFrame, found: DataFrame) -> DataFrame:
    """``measured`` with ``kept``, by the references ``found``."""
    overall = found.where("lang = '*'").select(F.struct("chars", "words", "rest").alias("r")).first()
    everyone = F.lit(None)
    if overall:
        r = overall["r"]
        words = F.map_from_arrays(F.array(*map(F.lit, r["words"])), F.array(*map(F.lit, r["words"].values()))) if r["words"] else F.create_map().cast("map<string,double>")
        everyone = F.struct(F.array(*map(F.lit, r["chars"])).alias("chars"), words.alias("words"), F.lit(r["rest"]).alias("rest"))
    by_lang = found.where("lang <> '*'").select(F.col("lang").alias("_lang"), F.struct("chars", "words", "rest").alias("_own"))
    lang = F.col("lang") if "lang" in measured.columns else F.lit(None).cast("string")
    df = measured.join(broadcast_if_small(by_lang, 4096), lang == F.col("_lang"), "left")
    q, reference = F.col("quality"), F.coalesce(F.col("_own"), everyone)
    chars = F.when(_total(q["chars"]) >= MIN_CHARS, char_distance(q, reference))
    words = F.when(q["n_words"] >= MIN_COMMON_WORDS, word_distance(q, reference))
    off = (chars > FAR_CHARS) | ((chars > ODD_CHARS) & (words > ODD_WORDS))
    kept = ~base_failed(q) & ~F.coalesce(off, F.lit(False))
    return df.withColumn("kept", kept).drop("_lang", "_own")
