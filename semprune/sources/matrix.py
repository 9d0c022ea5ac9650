"""Headerless row-major float32 matrices as a Spark data source (``raw_matrix``).

Files are read by ranges of rows through ``pyarrow.fs``, so any file system URI it knows
works and a task holds one Arrow batch at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from semprune.functions.arrow import list_matrix, matrix_list
from semprune.sources.paths import qualified

FLOAT_BYTES = 4
SUFFIX = ".f32"
SPLIT_BYTES = 128 << 20
BATCH_BYTES = 8 << 20


def matrix_shape(n_bytes: int, n_samples: int | None, dim: int | None) -> tuple[int, int]:
    """(rows, columns) of a matrix file; one of the two is enough, both must fit exactly."""
    floats, rest = divmod(n_bytes, FLOAT_BYTES)
    if n_samples is None and dim is None:
        raise ValueError("give n_samples, dim or both")
    if rest:
        raise ValueError(f"{n_bytes} bytes are no whole number of float32 values")
    if n_samples is not None and dim is not None:
        if n_samples * dim != floats:
            raise ValueError(f"{floats} values do not have the shape {n_samples} x {dim}")
        return n_samples, dim
    known = dim if dim is not None else n_samples
    if known < 1 or floats % known:
        raise ValueError(f"{floats} values cannot be divided by {known}")
    return (floats // known, known) if dim is not None else (known, floats // known)


def open_location(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it, for a path with a scheme (see ``paths.qualified``)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


@dataclass
class RowRange(InputPartition):
    path: str
    shard: str
    start: int
    stop: int
    dim: int


class MatrixReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.dim = int(options["dim"]) if options.get("dim") else None
        self.n_samples = int(options["n_samples"]) if options.get("n_samples") else None
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[RowRange]:
        fs, path = open_location(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info]
        if info.type == pafs.FileType.Directory:
            if self.n_samples is not None:
                raise ValueError("n_samples describes a single file, not a folder")
            files = sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda f: f.path)
            files = [f for f in files if f.is_file and f.path.endswith(SUFFIX)]
        ranges = []
        for file in files:
            rows, dim = matrix_shape(file.size, self.n_samples, self.dim)
            step = max(1, self.split_bytes // (FLOAT_BYTES * dim))
            for start in range(0, rows, step):
                ranges.append(RowRange(file.path, file.base_name, start, min(start + step, rows), dim))
        return ranges

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        fs, _ = open_location(self.path)
        width = FLOAT_BYTES * partition.dim
        step = max(1, BATCH_BYTES // width)
        with fs.open_input_file(partition.path) as file:
            for start in range(partition.start, partition.stop, step):
                n = min(step, partition.stop - start)
                values = np.frombuffer(file.read_at(n * width, start * width), dtype="<f4").reshape(n, partition.dim)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition.shard] * n, pa.string()),
                        pa.array(np.arange(start, start + n), pa.int64()),
                        matrix_list(values, pa.float32()),
                    ],
                    names=["shard", "idx", "embedding"],
                )


@dataclass
class WrittenFile(WriterCommitMessage):
    temporary: str | None
    final: str | None


class MatrixWriter(DataSourceArrowWriter):
    """One file per non-empty partition, named after its first index; files appear on commit."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        fs, root = open_location(self.path)
        fs.create_dir(root, recursive=True)
        temporary, out, first, last = f"{root}/_{uuid.uuid4().hex}", None, 0, -1
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                index = batch.column("idx").to_numpy()
                if index[0] <= last or (np.diff(index) <= 0).any():
                    raise ValueError("rows of a partition must be sorted by idx")
                if out is None:
                    out, first = fs.open_output_stream(temporary), int(index[0])
                last = int(index[-1])
                out.write(list_matrix(batch.column("embedding"), dtype=np.dtype("<f4")).tobytes())
        finally:
            if out is not None:
                out.close()
        if out is None:
            return WrittenFile(None, None)
        return WrittenFile(temporary, f"{root}/embeddings_{first:018d}{SUFFIX}")

    def commit(self, messages: list[WrittenFile | None]) -> None:
        fs, _ = open_location(self.path)
        for message in messages:
            if message is not None and message.temporary:
                fs.move(message.temporary, message.final)

    def abort(self, messages: list[WrittenFile | None]) -> None:
        fs, _ = open_location(self.path)
        for message in messages:
            if message is not None and message.temporary:
                fs.delete_file(message.temporary)


class RawMatrixSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_matrix"

    def schema(self) -> str:
        return "shard string, idx bigint, embedding array<float>"

    def reader(self, schema) -> MatrixReader:
        return MatrixReader(self.options)

    def writer(self, schema, overwrite: bool) -> MatrixWriter:
        return MatrixWriter(self.options)


def read_matrix(spark: SparkSession, path: str, n_samples: int | None = None, dim: int | None = None) -> DataFrame:
    """(shard, idx, embedding) of a matrix file or of a folder of them; ``idx`` counts per file."""
    spark.dataSource.register(RawMatrixSource)
    reader = spark.read.format("raw_matrix").option("path", qualified(spark, path))
    if n_samples is not None:
        reader = reader.option("n_samples", n_samples)
    if dim is not None:
        reader = reader.option("dim", dim)
    return reader.load()


def write_matrix(vectors: DataFrame, path: str) -> None:
    """Write (idx, embedding) as matrix files whose name order is the order of ``idx``."""
    vectors.sparkSession.dataSource.register(RawMatrixSource)
    ordered = vectors.select("idx", "embedding").repartitionByRange("idx").sortWithinPartitions("idx")
    target = qualified(vectors.sparkSession, path)
    ordered.write.format("raw_matrix").option("path", target).mode("append").save()
