import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from edge import LONG, TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from semprune.llm import packing
from semprune.llm.tokens import encoder

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def unpack(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


@pytest.mark.parametrize("text", [*TEXTS, " a", "a ", "a  b", "a \n b", "don't we'll 12,5 x", "x\u00a0 y \u3000z", "a <|endoftext|> b", "\n\n a\n"])
def test_ids_are_those_of_the_tokenizer(text):
    assert unpack(encoder().encode(text or "")) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\tab'sé1,.\u00a0😀<|>", max_size=60))
def test_ids_of_any_text(text):
    assert unpack(encoder().encode(text)) == ids_of(text)


def check(pieces, docs, window):
    """All ids once, sequences without gaps; returns the lengths of the sequences."""
    expected = defaultdict(list)
    for doc_id, text, *_ in docs:
        expected[doc_id].append(tuple([*ids_of(text), packing.END_ID]))
    sequences, tokens = defaultdict(list), defaultdict(int)
    for p in pieces:
        ids = unpack(p.ids)
        assert len(ids) == p.length > 0
        assert any(len(e) == p.doc_tokens and list(e[p.start : p.start + p.length]) == ids for e in expected[p.doc_id])
        sequences[p.sequence_id].append((p.offset, p.length))
        tokens[p.doc_id] += p.length
    assert dict(tokens) == {d: sum(map(len, e)) for d, e in expected.items()}
    used = []
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
        used.append(at)
    return used


@pytest.mark.parametrize("window, open_windows", [(2048, 64), (16, 2)])
def test_every_token_is_packed_once(spark, window, open_windows):
    docs = documents(spark).repartition(5)
    used = check(packing.pack_documents(docs, window, open_windows).collect(), docs.collect(), window)
    assert sum(u < window for u in used) <= len(used) * 0.5


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack_documents(docs)
    check(pieces.collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], packing.WINDOW)
    row = packing.padding(pieces).first()
    assert row.padded < 0.03 * row.tokens


def test_best_fit_and_fullest_first():
    out = []
    packer = packing.Packer(10, 2, lambda pieces, left: out.append(([p[0] for p in pieces], left)))
    for name, size in (("a", 6), ("b", 5), ("c", 4), ("d", 7), ("e", 8), ("f", 3)):
        packer.add((name, 0, bytes(4 * size), size))
    packer.close()
    # c fills a's window; e fits none, so d's window, the fullest, is emitted; f goes to b's
    assert out == [(["a", "c"], False), (["d"], False), (["b", "f"], True), (["e"], True)]


def test_leftovers_are_cut_to_windows():
    pieces = [("a", 0, bytes(4 * 7), 7), ("b", 3, bytes(4 * 9), 12)]
    got = [[(p[0], p[1], len(p[2]) // 4) for p in w] for w in packing.cut_to_windows(iter(pieces), 5)]
    assert got == [[("a", 0, 5)], [("a", 5, 2), ("b", 3, 3)], [("b", 6, 5)], [("b", 11, 1)]]


def test_no_documents(spark):
    assert packing.pack_documents(no_documents(spark)).count() == 0


def test_crc_in_spark(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    row = packing.pack_documents(docs).withColumn("crc", F.crc32("ids")).orderBy("start").first()
    assert row.crc == zlib.crc32(bytes(row.ids))
