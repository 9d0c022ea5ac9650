"""Models that give a state for each token: micro-batches of chunks of like length, and means over the real tokens.

A model takes a rectangle of tokens, so short chunks beside a long one are mostly padding. Chunks are buffered, put in order of length
and cut into rectangles of at most ``PADDED_TOKENS`` places (one chunk at least); vectors go back in the order of the chunks.
Padding has no part in a mean, and what a chunk gets does not depend on its rectangle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.operators.embed import KNOWN_TOKENS, MODEL_BATCH, Embedder, masked_mean

#: Places of a micro-batch.
PADDED_TOKENS = 1 << 14


def micro_batches(lengths: np.ndarray, places: int = PADDED_TOKENS) -> Iterator[np.ndarray]:
    """Chunks of each micro-batch, in order of length."""
    order = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and max(1, int(lengths[order[end]])) * (end + 1 - begin) <= places:
            end += 1
        yield order[begin:end]
        begin = end


class TokenStates(Embedder):
    """A model plug-in that maps token numbers and a mask (chunks, tokens) to states (chunks, tokens, dim)."""

    places: int = PADDED_TOKENS

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """Numbers of distinct tokens."""
        raise NotImplementedError

    def states(self, numbers: np.ndarray, mask: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def embed(self, features: pa.ListArray) -> np.ndarray:
        offsets = features.offsets.to_numpy()
        offsets = offsets - offsets[0]
        lengths = np.diff(offsets)
        coded = features.flatten().dictionary_encode()
        flat = self.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        out = np.zeros((len(lengths), self.dim))
        for rows in micro_batches(lengths, self.places):
            width = max(1, int(lengths[rows].max()))
            mask = np.arange(width)[None, :] < lengths[rows, None]
            numbers = np.zeros(mask.shape, np.int64)
            numbers[mask] = flat[np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in rows])]
            out[rows] = masked_mean(self.states(numbers, mask), mask)
        return out


class HashedContext(TokenStates):
    """A token's state is 1 at its own hash bucket and a half at those of the tokens beside it."""

    def __init__(self, dim: int = 768, places: int = PADDED_TOKENS):
        self.dim, self.places = dim, places

    def load(self) -> None:
        self._known: dict[str, int] = {}

    def numbers(self, tokens: list[str]) -> np.ndarray:
        known = self._known
        if len(known) > KNOWN_TOKENS:
            known.clear()
        for token in tokens:
            if token not in known:
                known[token] = int.from_bytes(md5(token.encode()).digest()[:4], "big") % self.dim
        return np.array([known[t] for t in tokens], np.int64)

    def states(self, numbers: np.ndarray, mask: np.ndarray) -> np.ndarray:
        n, width = mask.shape
        states = np.zeros((n, width, self.dim))
        row, place = np.nonzero(mask)
        states[row, place, numbers[row, place]] = 1.0
        for step in (-1, 1):
            beside = np.zeros_like(mask)
            shifted = np.roll(mask, step, axis=1)
            shifted[:, -1 if step < 0 else 0] = False
            beside[:] = mask & shifted
            row, place = np.nonzero(beside)
            np.add.at(states, (row, place, numbers[row, place - step]), 0.5)
        return states


def padding(chunks: DataFrame, places: int = PADDED_TOKENS, batch_size: int = MODEL_BATCH) -> DataFrame:
    """(batches, tokens, places): one row that says how many places the micro-batches of ``chunks(n_tokens)`` have for how many tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                lengths = batch.column("n_tokens").to_numpy()[start : start + batch_size]
                sizes = [len(rows) * max(1, int(lengths[rows].max())) for rows in micro_batches(lengths, places)]
                yield pa.RecordBatch.from_arrays([pa.array([len(sizes)]), pa.array([int(lengths.sum())]), pa.array([sum(sizes)])], ["batches", "tokens", "places"])

    found = chunks.select(F.col("n_tokens").cast("long").alias("n_tokens")).mapInArrow(run, "batches long, tokens long, places long")
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("batches", "tokens", "places")])
