"""Cutting documents into token chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.functions.text import character_chunks, token_chunks, whitespace_tokens
from semprune.operators.prune import uid_column


# Characters of the texts a tokenizer gets at once; their tokens are Python objects.
TEXT_BATCH = 1 << 20


def runs_within(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows whose sizes add up to at most ``most``; a larger row is a run of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total + size > most and i > start:
            yield slice(start, i)
            start, total = i, 0
        total += size
    yield slice(start, len(sizes))


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer plug-in.

    ``load`` builds, once per task, a function from a list of texts to their token lists, which
    gets at most ``TEXT_BATCH`` characters at once, or one text; without it texts are cut at white space by Spark itself. ``start`` and ``end`` are the
    special tokens every chunk carries and that count towards the chunk size.
    """

    load: Callable[[], Callable[[list[str]], list[list[str]]]] | None = None
    start: tuple[str, ...] = ()
    end: tuple[str, ...] = ()

    def tokens(self, text: Column) -> Column:
        if self.load is None:
            return whitespace_tokens(text)
        load = self.load

        @F.pandas_udf("array<string>")
        def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                for run in runs_within(texts.str.len().to_numpy(), TEXT_BATCH):
                    yield pd.Series(model(texts.iloc[run].tolist()))

        return tokenize(text)

    def instruction(self, text: str) -> list[str]:
        return text.split() if self.load is None else self.load()([text])[0]


WHITESPACE = Tokenizer()
TOKENIZERS: dict[str, Tokenizer] = {"whitespace": WHITESPACE}


def chunk_documents(
    documents: DataFrame,
    chunk_size: int = 512,
    instruction: str | None = None,
    tokenizer: Tokenizer = WHITESPACE,
    uid_key: str | None = None,
    text_key: str = "text",
) -> DataFrame:
    """(idx, uid, chunk, tokens, n_tokens): consecutive chunks of at most ``chunk_size`` tokens.

    Special tokens and the instruction, which follows the start token of every chunk, count
    towards ``chunk_size``. Chunks of one document stay next to each other; no shuffle.
    """
    head = [*tokenizer.start, *(tokenizer.instruction(instruction) if instruction else [])]
    tail = list(tokenizer.end)
    content = chunk_size - len(head) - len(tail)
    chunks = token_chunks(tokenizer.tokens(F.coalesce(text_key, F.lit(""))), content, head, tail)
    cut = documents.select("idx", uid_column(documents, uid_key).alias("uid"), F.posexplode(chunks).alias("chunk", "tokens"))
    return cut.withColumn("n_tokens", F.size("tokens"))


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("uid").agg(F.count("*").alias("n_chunks"))


def chunk_characters(documents: DataFrame, width: int, uid_key: str | None = None, text_key: str = "text") -> DataFrame:
    """(idx, uid, chunk, piece): consecutive pieces of ``width`` characters."""
    pieces = F.posexplode(character_chunks(F.coalesce(text_key, F.lit("")), width)).alias("chunk", "piece")
    return documents.select("idx", uid_column(documents, uid_key).alias("uid"), pieces)
