import random
import sys
from pathlib import Path

import numpy as np
import pytest
from edge import documents
from test_line_dedup import brute as removed_by_brute_force
from test_packing import check as check_packed
from test_simhash import components, fingerprint, near_matrix

from semprune.llm import decontaminate, packing, simhash
from semprune.session import materialize

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = materialize(spark.read.parquet(f"{SF}/documents.parquet"), "docs"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name.replace(" ", "-"))
        out.append(docs)
    return [[r.asDict() for r in d.collect()] for d in out]


def test_stages_keep_the_columns(stages):
    assert all(set(rows[0]) == set(stages[0][0]) for rows in stages[:-1])
    assert [len(pipeline.STAGES), pipeline.STAGES[0][0]] == [5, "quality rules"]


def test_quality_equals_sql(stages):
    import duckdb

    from semprune.llm import sql

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.quality_rules()}) WHERE kept").fetchall()}
    assert {r["doc_id"] for r in stages[1]} == kept


def test_lines_equal_brute_force(stages):
    gone = removed_by_brute_force([(r["doc_id"], r["text"]) for r in stages[1]])
    expected = {}
    for (doc_id, text), lines in gone.items():
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lines)
        if not lines or left.split():
            expected[doc_id] = left
    assert {r["doc_id"]: r["text"] for r in stages[2]} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def groups(rows):
    """Group of each text by all pairs of fingerprints."""
    prints = np.array([fingerprint(r["text"]) for r in rows], np.uint64)
    return components(near_matrix(prints, simhash.BUDGET)).tolist()


def test_one_document_of_each_group_stays(stages):
    rows = stages[2]
    label = groups(rows)
    group = dict(zip((r["doc_id"] for r in rows), label, strict=True))
    kept = [group[r["doc_id"]] for r in stages[3]]
    assert sorted(kept) == sorted(set(label))


def test_contaminated_documents_go(spark, stages):
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for r in stages[3]:
        text = decontaminate.normal(r["text"])
        if not any(i in text or decontaminate.myers(i, text)[0] <= decontaminate.budget_of(i) for i in items):
            clean.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[4]) == sorted(clean)


def test_packed_tokens_are_those_kept(spark, stages):
    pieces = spark.createDataFrame(stages[5], packing.SCHEMA.replace(", left_over boolean", "")).collect()
    check_packed(pieces, [(r["doc_id"], r["text"]) for r in stages[4]], packing.WINDOW)


def test_near_copies_are_caught_and_others_stay(spark):
    r = random.Random(2)
    vocabulary = [f"word{i}" for i in range(3000)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(300, 900))] for _ in range(60)]
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in enumerate(base)]
    for i, words in enumerate(base[:30]):
        new = list(words)
        new[r.randrange(len(new))] = r.choice(vocabulary)
        rows += [(100 + i, " ".join(new), "en", "s", 1), (200 + i, " ".join(words), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_dedup(spark, docs, SF).collect()
    label = groups([x.asDict() for x in docs.collect()])
    assert sorted(x.doc_id % 100 for x in kept)[:1] == [0] and {x.doc_id % 100 for x in kept} == set(range(60))
    assert len(kept) == len(set(label)) <= 66


def test_rows_of_all_kinds_and_clashing_columns(spark):
    docs = documents(spark, extra=[" ".join(f"word{i}." for i in range(300)) + f"\nLine {k} of this text says something of its own." for k in range(3)])
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "any")
        if name != "packing":
            assert out.schema == docs.schema
            assert all(x.quality == "q" and x.kept == 3 and x.removed_lines == "r" and x["a.b"] == "dotted" for x in out.collect())
            docs = out
    assert out.count() > 0


def test_a_table_without_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("lang", "n_chars")
    for name, stage in pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, SF), "plain")
    assert docs.columns == ["doc_id", "text", "source"] and docs.count() > 50


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "none")
        assert docs.count() == 0
