import random

from edge import documents, no_documents
from pyspark.sql import functions as F

from semprune.llm import line_dedup as ld
from semprune.llm.word_hashes import word_hashes
from semprune.session import materialize


def test_word_hashes_name_the_words():
    data = "Hello  wOrld\n\tfoo bar\x0b hello é É x\x00y x a\x85b".encode() + b" " + b"z" * 2_200_000 + b" foo"
    hashes, begins = word_hashes(data)
    words = data.lower().split()
    assert len(hashes) == len(words)
    assert [data[b : b + 1].lower() for b in begins] == [w[:1] for w in words]
    assert len(set(hashes.tolist())) == len(set(words))
    assert hashes[0] == hashes[4]
    assert len(word_hashes(b"")[0]) == len(word_hashes(b" \n ")[0]) == 0


def brute(rows):
    """{(doc_id, text): removed line numbers}, by comparing each line with all earlier ones."""
    seen, out = [], {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        gone = []
        for n, line in enumerate((text or "").encode().lower().split(b"\n")):
            words = set(line.split())
            if len(words) < ld.MIN_WORDS:
                continue
            if any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                gone.append(n)
            seen.append(words)
        out[doc_id, text] = gone
    return out


def crowd():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    line = lambda n: [r.choice(vocabulary) for _ in range(n)]
    base = [line(r.randint(8, 60)) for _ in range(12)]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(r.randint(1, 6)):
            words = list(r.choice(base)) if r.random() < 0.6 else line(r.randint(1, 40))
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    return texts


def test_later_matches_go(spark):
    docs = documents(spark, extra=crowd()).where("doc_id IS NULL OR doc_id % 2 = 0").repartition(5)
    docs = materialize(docs, "docs")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(map(len, expected.values())) > 150
    out = ld.dedup_lines(docs)
    assert [c for c in out.columns if c != "removed_lines"] == [c for c in docs.columns if c != "removed_lines"]
    rows = ld.with_removed(docs, materialize(ld.removed_lines(docs), "removed")).collect()
    assert {(r.doc_id, r.text): list(r.removed_lines) for r in rows} == expected
    assert len(rows) == docs.count()
    left = {r.doc_id: r.text for r in out.where("doc_id IS NOT NULL").collect()}
    for (doc_id, text), gone in expected.items():
        if doc_id is not None:
            assert left[doc_id] == (text if not gone else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))


def test_rounds_make_no_difference(spark):
    docs = materialize(spark.createDataFrame(list(enumerate(crowd())), "doc_id long, text string"), "docs")
    classes = materialize(ld.line_classes(materialize(ld.judged_lines(docs, ld.rarity(docs)), "lines")), "classes")
    few = ld.dropped_classes(classes, docs, ((0, 1), (1, 2), (2, 5), (5, 1 << 62)))
    once = ld.dropped_classes(classes, docs, ((0, 1 << 62),))
    assert sorted(r.cid for r in few.distinct().collect()) == sorted(r.cid for r in once.distinct().collect())


def test_tiles_and_kept_pairs_make_no_difference(spark, monkeypatch):
    docs = materialize(spark.createDataFrame(list(enumerate(crowd())), "doc_id long, text string"), "docs")
    classes = materialize(ld.line_classes(materialize(ld.judged_lines(docs, ld.rarity(docs)), "lines")), "classes")
    plain = sorted(r.cid for r in ld.dropped_classes(classes, docs).distinct().collect())
    for name, value in (("COUNTED", 1), ("TILE_LINES", 5), ("TILES", 3), ("MOST_TILE_LINES", 20), ("PAIRS_KEPT", 10), ("PAIRS_AT_ONCE", 50)):
        monkeypatch.setattr(ld, name, value)
    for rounds in (ld.ROUNDS, ((0, 1), (1, 2), (2, 7), (7, 1 << 62))):
        assert sorted(r.cid for r in ld.dropped_classes(classes, docs, rounds).distinct().collect()) == plain


def test_a_crowd_of_near_equal_lines(spark):
    n = 3000
    shared = " ".join(f"common{i}" for i in range(30))
    texts = [f"{shared} only{i} {'again' if i % 2 else 'ever'}" for i in range(n)]
    docs = materialize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "docs")
    assert {r.doc_id: list(r.removed_lines) for r in ld.dedup_lines(docs).collect()} == {i: [0] if i else [] for i in range(n)}


def test_repeated_rows_are_one_document(spark):
    text = "some words that make a line of more than eight words\n" * 2
    docs = materialize(spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string"), "docs")
    got = sorted((str(r.doc_id), tuple(r.removed_lines)) for r in ld.dedup_lines(docs).select("doc_id", F.col("removed_lines")).collect())
    assert got == [("1", (1,)), ("1", (1,)), ("2", (0, 1)), ("None", (0, 1))]


def test_short_lines_are_judged(spark):
    r = random.Random(4)
    vocabulary = [f"s{i}" for i in range(14)]
    texts = ["Released under the MIT License.\nhome\na b c d\n\n1 2 3 4", "released under the MIT License.\nHOME home\ne a b c d\na b c\n \n1 2 3", "la " * 60]
    texts += ["\n".join(" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 9))) for _ in range(4)) for _ in range(60)] + ["la " * 70]
    seen, expected = [], {}
    for n, text in enumerate(texts):
        for k, line in enumerate(text.lower().split("\n")):
            words = set(line.split())
            if words and any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                expected.setdefault(n, []).append(k)
            seen += [words] if words else []
    assert expected[1] == [0, 1, 2] and len(texts) - 1 in expected
    docs = materialize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "docs")
    assert {x.doc_id: x.removed_lines for x in ld.dedup_lines(docs).collect() if x.removed_lines} == expected


def test_no_documents(spark):
    assert ld.dedup_lines(materialize(no_documents(spark), "docs")).count() == 0
