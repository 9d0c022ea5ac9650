import random
import re
from collections import Counter

import duckdb
import pytest
from edge import documents, no_documents
from pyspark.sql import functions as F

from semprune.llm import mixing, queries, sql


def shared_out(words, weights, share=1.5, most=2.0):
    """Targets by repeated resharing of what is over."""
    target = dict.fromkeys(words, 0.0)
    left, open_ = share * sum(words.values()), set(words)
    while open_ and left > 1e-9:
        total = sum(weights[s] for s in open_)
        over = 0.0
        for s in sorted(open_, key=str):
            target[s] += left * weights[s] / total
        for s in list(open_):
            if target[s] >= most * words[s]:
                over += target[s] - most * words[s]
                target[s] = most * words[s]
                open_.discard(s)
        left = over
    return target


def ranked(sources):
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    return {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def targets_of(spark, words):
    docs = table(spark, [(i, s, "w " * n) for i, (s, n) in enumerate(words.items())])
    return {r.doc["source"]: r.target for r in mixing.mix(docs).collect()}


def test_targets_equal_resharing(spark):
    r = random.Random(4)
    for n in (1, 2, 7, 23):
        names = [None, *("S", "a", "b", "é", "z", "Z", "", "￿", "\U0001f600"), *(f"s{i}" for i in range(14))][:n]
        words = {s: r.choice([0, 1, 5, 40, 300, 2000]) for s in names}
        want = shared_out(words, ranked(names))
        got = targets_of(spark, words)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)
        assert sum(got.values()) == pytest.approx(1.5 * sum(words.values()))


def test_many_sources_fill_one_after_the_other(spark):
    words = {f"s{i:02}": 3**i for i in range(16)}
    got, want = targets_of(spark, words), shared_out(words, ranked(words))
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_taken_words_come_near_the_targets(spark):
    r = random.Random(1)
    rows = [(i, f"s{min(i % 9, 5)}", " ".join(["w"] * r.randint(1, 30))) for i in range(6000)]
    rows += [(7, "s5", "one two three")] * 3000 + [(90_000 + i, "s0", "same text in all") for i in range(2000)]
    mixed = mixing.mix(table(spark, rows).repartition(7))
    taken, target = Counter(), {}
    for x in mixed.collect():
        assert x.copies in (0, 1, 2) and x.size == len((x.doc["text"] or "").split())
        taken[x.doc["source"]] += x.size * x.copies
        target[x.doc["source"]] = x.target
    assert all(abs(taken[s] - t) < 0.04 * t + 30 for s, t in target.items())
    copies = [x.copies for x in mixed.where("doc.doc_id = 7 and doc.source = 's5'").collect()]
    assert len(copies) >= 3000 and len(set(copies)) > 1 or target["s5"] in (0, 2 * sum(x.size for x in mixed.where("doc.source = 's5'").collect()))


def test_reruns_and_partitions_agree(spark):
    docs = documents(spark)
    runs = []
    for parts in (1, 5):
        rows = mixing.mix(docs.repartition(parts)).select("doc.doc_id", "doc.text", "size", "target", "copies").collect()
        runs.append(Counter(map(tuple, rows)))
    assert runs[0] == runs[1] and sum(runs[0].values()) == docs.count()
    assert Counter(map(tuple, mixing.mix(docs, seed=1).select("doc.doc_id", "doc.text", "size", "target", "copies").collect())) != runs[0]


def test_emitted_documents(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    out = mixing.emit(mixed)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixed.collect():
        want[r.doc["doc_id"], r.doc["text"], r.doc["a.b"]] += r.copies
    assert Counter((r.doc_id, r.text, r["a.b"]) for r in out.collect()) == +want


def test_sizes_are_words_between_ascii_spaces(spark):
    texts = [None, "", " \n\t\x0b\x0c\r ", "one", "a b c", "é\nü\x0bx"]
    sizes = {r.text: r.n for r in table(spark, [(1, "s", t) for t in texts]).select("text", mixing.words(F.coalesce("text", F.lit(""))).alias("n")).collect()}
    assert sizes == {t: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for t in texts}


def test_no_documents(spark):
    assert mixing.mix(no_documents(spark)).count() == 0
    assert {r.target for r in mixing.mix(table(spark, [(1, "s", None), (2, None, "")])).collect()} == {0.0}


@pytest.mark.parametrize("part", ["small", "odd", "none"])
def test_query_equals_sql(spark, tmp_path, part):
    if part == "small":
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    else:
        docs = documents(spark) if part == "odd" else no_documents(spark)
        docs = docs.select("doc_id", F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))).alias("source"), "text")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(sql.mixing())
    names = [c[0] for c in result.description]
    found = queries.op12_mixing(spark, str(tmp_path))
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(result.fetchall())


def test_main_path_stays_in_the_jvm(spark, capsys):
    mixing.emit(mixing.mix(documents(spark))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
