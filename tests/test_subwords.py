"""Subword pieces against the public library, and means of token states against each token by itself."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF
from pyspark.sql import functions as F

from semprune.operators import chunk, embed, subwords, token_states
from semprune.operators.subwords import Pieces, words_of
from semprune.plans import jobs

ODD = [
    "Hello, World! isn't it?", "Étion çouelle ÜBER straße ǅ İstanbul ΣΑΣ", "数学 mixed汉字and かな", "a b c　d", "x​ýz\x0bq\x0cr\x85s",
    "tabs\tand\nlines\r\n  end  ", "é vs é ﬁ ½ ⑨", "[CLS] ## ##ing", "x" * 150, "$#@*^~`|<>=+", "„Quoted“ — dash… ¿qué? «oui»", "�bad\x00\x7f", "😀 emoji👍🏽", "; greek `", "0123456789 3.14", "", " ",
]


def pieces_of_model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary(spark):
    found = subwords.read_vocabulary(spark, pieces_of_model())
    return list(dict.fromkeys([subwords.UNKNOWN, subwords.START, subwords.END, *found]))


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    made = Tokenizer(models.WordPiece({p: i for i, p in enumerate(vocabulary)}, unk_token=subwords.UNKNOWN, max_input_chars_per_word=100))
    made.normalizer, made.pre_tokenizer = normalizers.BertNormalizer(), pre_tokenizers.BertPreTokenizer()
    return made


def test_pieces_equal_the_public_library(vocabulary, library):
    pieces = Pieces(vocabulary)
    r = random.Random(1)
    letters = "abcdeéüßÄ .,-'! ́漢#[]\x0b"
    for text in ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(1500)]:
        own = [p for s in subwords_between_spaces(text) for w in words_of(s) for p in pieces.of(w)]
        assert own == library.encode(text, add_special_tokens=False).tokens, repr(text)


def subwords_between_spaces(text):
    import re

    return [s for s in re.split("[ \t\n\r]+", text) if s]


def test_few_strings_are_taken_apart_at_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(subwords.F, "arrow_udf", lambda _: lambda f: made.append(f) or (lambda column: column))
    subwords.WordPieces(vocabulary=SimpleNamespace(value=["a", "##b"])).tokens(F.lit(""))
    rows = [["ab", "a"] * 5_000 for _ in range(60)] + [["a"] * 300_000, [], ["abb"]]
    found = list(made[0](iter([pa.array(rows, pa.list_(pa.string()))])))
    assert len(found) > 4
    for x, end in zip(found, np.cumsum([len(x) for x in found]), strict=True):
        taken = rows[end - len(x) : end]
        assert len(taken) == 1 or sum(map(len, taken)) <= subwords.STRING_BATCH
    assert [y for x in found for y in x.to_pylist()] == [["a", "##b", "a"] * 5_000] * 60 + [["a"] * 300_000, [], ["a", "##b", "##b"]]


def test_chunks_of_documents_equal_the_public_library(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*ODD, None])], docs.schema))
    docs.write.parquet(str(tmp_path / "docs"))
    jobs.chunk_job(spark, str(tmp_path / "docs"), str(tmp_path / "chunks"), 40, "query: ", uid_key="doc_id", index_key="doc_id", vocabulary=pieces_of_model())
    found = {}
    for r in spark.read.parquet(str(tmp_path / "chunks")).orderBy("uid", "chunk").collect():
        assert r.n_tokens == len(r.tokens) <= 40
        found.setdefault(r.uid, []).append(r.tokens)
    head = [subwords.START, *library.encode("query: ", add_special_tokens=False).tokens]
    content = 40 - len(head) - 1
    for r in docs.collect():
        tokens = library.encode(r.text or "", add_special_tokens=False).tokens
        parts = [tokens[i : i + content] for i in range(0, max(1, len(tokens)), content)]
        assert found[r.doc_id] == [[*head, *p, subwords.END] for p in parts]


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "v.txt").write_text("[UNK]\nab\n##c\nd\n", encoding="utf-8")
    (tmp_path / "v.json").write_text('{"model": {"vocab": {"[UNK]": 0, "ab": 1, "##c": 2, "d": 3}}}', encoding="utf-8")
    for name in ("v.txt", "v.json"):
        tokenizer = subwords.word_pieces(spark, str(tmp_path / name), start=(), end=())
        docs = spark.createDataFrame([(1, "ABCC d abd"), (2, None)], "idx long, text string")
        rows = {r.idx: r.tokens for r in chunk.chunk_documents(docs, 50, tokenizer=tokenizer).collect()}
        assert rows == {1: ["ab", "##c", "##c", "d", "[UNK]"], 2: []}
    assert Pieces(["a", "##a"]).of("aaa") == ["a", "##a", "##a"] and Pieces(["##a"]).of("a") == ["[UNK]"] and Pieces(["a"]).of("") == []


# --- token states ----------------------------------------------------------------------------


def one_by_one(tokens, dim):
    """The mean state of a chunk, from its own tokens."""
    model = token_states.HashedContext(dim)
    model.load()
    total = np.zeros(dim)
    for i, n in enumerate(model.numbers(tokens)):
        total[n] += 1 + 0.5 * (i > 0) + 0.5 * (i < len(tokens) - 1)
    return total / max(1, len(tokens))


def some_chunks(seed, n):
    r = random.Random(seed)
    return [[r.choice("abcdefghij") * r.randint(1, 3) for _ in range(r.choice([0, 1, 2, 7, 40, 126]))] for _ in range(n)]


@pytest.mark.parametrize("places", [1, 100, 1 << 14])
def test_vectors_do_not_depend_on_micro_batches(places):
    chunks = some_chunks(3, 60)
    model = token_states.HashedContext(16, places)
    model.load()
    array = pa.array([["x"], *chunks], pa.list_(pa.string())).slice(1)
    np.testing.assert_allclose(model.embed(array), [one_by_one(c, 16) for c in chunks], atol=1e-12)


def test_micro_batches_hold_chunks_of_like_length():
    lengths = np.array([5, 100, 3, 0, 100, 4, 700, 5])
    found = list(token_states.micro_batches(lengths, 210))
    assert sorted(np.concatenate(found).tolist()) == list(range(8))
    assert [lengths[f].tolist() for f in found] == [[0, 3, 4, 5, 5], [100, 100], [700]]


def test_masked_mean_leaves_padding_out():
    states = np.arange(24.0).reshape(2, 3, 4)
    mask = np.array([[True, False, False], [True, True, False]])
    np.testing.assert_allclose(embed.masked_mean(states, mask), [states[0, 0], states[1, :2].mean(axis=0)])
    assert (embed.masked_mean(states, np.zeros((2, 3), bool)) == 0).all()


def test_document_vectors_for_any_batch(spark):
    docs = spark.createDataFrame([(i, " ".join(c)) for i, c in enumerate(some_chunks(5, 30))], "idx long, text string")
    runs = []
    for batch, places in ((640, 1 << 14), (3, 50), (1, 1)):
        rows = embed.embed_documents(docs, token_states.HashedContext(8, places), 20, batch_size=batch).orderBy("idx").collect()
        runs.append([r.embedding for r in rows])
    np.testing.assert_allclose(runs[0], runs[1], atol=1e-6)
    np.testing.assert_allclose(runs[0], runs[2], atol=1e-6)


def test_padding_is_reported(spark):
    chunks = spark.createDataFrame([(n,) for n in (5, 100, 3, 0, 100, 4, 700, 5)], "n_tokens int").coalesce(1)
    row = token_states.padding(chunks, 210).first()
    assert (row.batches, row.tokens, row.places) == (3, 917, 25 + 200 + 700)
    assert token_states.padding(chunks.limit(0)).first().places == 0
