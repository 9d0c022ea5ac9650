"""Document vectors from token chunks, with a pluggable model."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semprune.functions.arrow import matrix_list
from semprune.functions.vectors import NORM_FLOOR, is_zero_vector, l2_normalize
from semprune.operators.chunk import WHITESPACE, Tokenizer, chunk_documents

# Chunks given to the model at once.
MODEL_BATCH = 640
# Tokens whose bucket a task remembers before it starts anew.
KNOWN_TOKENS = 1 << 16


def masked_mean(states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean of token states (chunks, tokens, dim) over the tokens that are not padding."""
    weight = mask.astype(states.dtype)[:, :, None]
    return (states * weight).sum(axis=1) / np.maximum(weight.sum(axis=1), 1)


class Embedder:
    """A model plug-in: ``dim`` components, one vector per chunk.

    ``features`` is evaluated by Spark on the token array and is what reaches the model;
    ``load`` runs once per task; ``embed`` maps an Arrow list array (one entry per chunk) to
    a matrix. Models that return token states pool them with ``masked_mean``.
    """

    dim: int

    def features(self, tokens: Column) -> Column:
        return tokens

    def load(self) -> None:
        pass

    def embed(self, features: pa.ListArray) -> np.ndarray:
        raise NotImplementedError


class HashedWords(Embedder):
    """Each token is a unit vector along its hash bucket; a chunk is the mean of its tokens.

    The bucket of a token comes from the first 32 bits of its MD5. Only the distinct tokens of
    a batch are looked up, and a task remembers the buckets it has computed.
    """

    def __init__(self, dim: int = 768):
        self.dim = dim

    def load(self) -> None:
        self._known: dict[bytes, int] = {}

    def _buckets(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > KNOWN_TOKENS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = int.from_bytes(md5(word).digest()[:4], "big") % self.dim
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def embed(self, features: pa.ListArray) -> np.ndarray:
        lengths = np.diff(features.offsets.to_numpy())
        words = features.flatten().dictionary_encode()
        buckets = self._buckets(words.dictionary.cast(pa.binary()).to_pylist())
        cells = np.repeat(np.arange(len(lengths)), lengths) * self.dim + buckets[words.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(lengths) * self.dim).reshape(len(lengths), self.dim)
        return counts / np.maximum(lengths, 1)[:, None]


EMBEDDERS: dict[str, Callable[[int], Embedder]] = {"hashed_words": HashedWords}


def chunk_vectors(chunks: DataFrame, embedder: Embedder, batch_size: int = MODEL_BATCH) -> DataFrame:
    """(idx, uid, chunk, tokens) -> (idx, uid, chunk, embedding), one vector per chunk."""
    fields = [T.StructField(c, chunks.schema[c].dataType) for c in ("idx", "uid", "chunk")]
    schema = T.StructType([*fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder.load()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                vectors = matrix_list(embedder.embed(part.column("features")), pa.float64())
                columns = [*(part.column(c) for c in ("idx", "uid", "chunk")), vectors]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    features = chunks.select("idx", "uid", "chunk", embedder.features(F.col("tokens")).alias("features"))
    return features.mapInArrow(run, schema)


def document_means(vectors: DataFrame, key: str = "uid") -> DataFrame:
    """Unweighted mean of the chunk vectors of every document, summed before the shuffle."""
    mean = Summarizer.mean(array_to_vector("embedding"))
    return vectors.groupBy(key).agg(vector_to_array(mean).alias("embedding"))


def post_process(vectors: DataFrame, key: str = "uid") -> DataFrame:
    """Mean over chunks, then unit length."""
    return document_means(vectors, key).withColumn("embedding", l2_normalize(F.col("embedding")))


def embed_documents(
    documents: DataFrame,
    embedder: Embedder,
    chunk_size: int = 512,
    instruction: str | None = None,
    tokenizer: Tokenizer = WHITESPACE,
    uid_key: str | None = None,
    text_key: str = "text",
    batch_size: int = MODEL_BATCH,
) -> DataFrame:
    """(idx, uid, n_chunks, embedding): one unit-length vector per document, without a shuffle.

    The chunks of a document leave the scan next to each other, so a task sums them as they
    pass and holds one running sum; a long document never has to fit a batch.
    """
    chunks = chunk_documents(documents, chunk_size, instruction, tokenizer, uid_key, text_key)
    features = chunks.select("idx", "uid", embedder.features(F.col("tokens")).alias("features"))
    schema = T.StructType(
        [
            T.StructField("idx", features.schema["idx"].dataType),
            T.StructField("uid", features.schema["uid"].dataType),
            T.StructField("n_chunks", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
        ]
    )
    types = [None, None, pa.int64(), None]

    def finish(ids: pa.Array, uids: pa.Array, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        means = sums / counts[:, None]
        means /= np.maximum(np.linalg.norm(means, axis=1), NORM_FLOOR)[:, None]
        columns = [ids, uids, pa.array(counts, types[2]), matrix_list(means.astype(np.float32), pa.float32())]
        return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder.load()
        held = None  # (idx, uid, chunk count, sum) of the document that may continue
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                keys = part.column("idx").to_numpy()
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                counts = np.diff(np.r_[first, len(keys)])
                sums = np.add.reduceat(embedder.embed(part.column("features")).astype(np.float64), first, axis=0)
                ids, uids = part.column("idx").take(pa.array(first)), part.column("uid").take(pa.array(first))
                if held is not None:
                    if held[0][0] == ids[0]:
                        counts[0] += held[2][0]
                        sums[0] += held[3][0]
                    else:
                        yield finish(*held)
                if len(first) > 1:
                    yield finish(ids[:-1], uids[:-1], counts[:-1], sums[:-1])
                held = (ids[-1:], uids[-1:], counts[-1:], sums[-1:])
        if held is not None:
            yield finish(*held)

    return features.mapInArrow(run, schema)


def zero_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose vector has only zero components."""
    return vectors.where(is_zero_vector(F.col("embedding")))
