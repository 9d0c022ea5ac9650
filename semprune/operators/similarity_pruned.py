"""Scores of distinct vectors with tiles that bounds rule out.

The tiles of ``similarity`` follow the order in the cluster, so any pair of them may hold near vectors. Here the tiles of a large
cluster are neighbourhoods: rows go to the nearest of a few pivots, and a neighbourhood of many rows is dealt over several
tiles. A tile has a centre, a radius and the places of its first and last row. The product of a row with any row of a tile is at
most its product with the centre plus its length times the radius.

Rows are first scored inside their own tile. Then a row visits only those other tiles that hold an earlier row and whose bound
is above its best so far; a vector with copies also visits tiles with later rows whose bound is above its own square, as
these may be nearer to a later copy. Rows and tiles without visits are never shuffled again. No bound is needed
for right results: it only says which products cannot matter.

The rows that visit one tile are dealt over tasks of at most about a tile of visitors each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.functions.arrow import list_matrix, matrix_list
from semprune.operators.joins import join_counts
from semprune.operators.similarity import EARLIER_STRIP, QUERY_STRIP, best_of_tiles, max_similarity, records, score_distinct, tile_height, tile_scores
from semprune.session import materialize

#: Largest table of pivots or centres that goes to every task; beyond it, tiles are not ruled out.
CENTRE_BYTES = 128 << 20
#: Pivots for as many rows as a tile may have: small neighbourhoods have small radii.
PIVOTS = 4
#: Tiles of a neighbourhood are numbered below this.
SLICES = 1 << 20
#: Relative rounding error of a bound that is allowed for, many times over.
SLACK = 1e-9

_ROW = "cid int, pos long, ord long, copied boolean, tile long, embedding array<float>"


def _by_cluster(table: pa.Table, dim: int, *names: str) -> dict[int, tuple[np.ndarray, ...]]:
    """Arrays of each cluster; the first is the matrix of vectors."""
    cid = table.column("cid").to_numpy()
    order = np.argsort(cid, kind="stable")
    matrix = list_matrix(table.column("centre"), dim)[order]
    arrays = [matrix, *(table.column(n).to_numpy()[order] for n in names)]
    edges = np.flatnonzero(np.r_[True, np.diff(cid[order]) != 0, True])
    return {int(cid[order[a]]): tuple(x[a:b] for x in arrays) for a, b in zip(edges, edges[1:], strict=False)} if len(cid) else {}


def _runs(cids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(cluster, rows) of a batch."""
    order = np.argsort(cids, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(cids[order])) + 1) if len(cids) else []:
        yield int(cids[rows[0]]), rows


def _near_pivot(batches: Iterator[pa.RecordBatch], pivots, dim: int) -> Iterator[pa.RecordBatch]:
    known = pivots.value
    for batch in batches:
        x = list_matrix(batch.column("embedding"), dim)
        cell = np.zeros(len(x), np.int64)
        for cid, rows in _runs(batch.column("cid").to_numpy()):
            if cid in known:
                (matrix,) = known[cid]
                cell[rows] = (x[rows] @ matrix.T - (matrix * matrix).sum(axis=1) / 2).argmax(axis=1)
        yield batch.append_column("cell", pa.array(cell))


def _radii(batches: Iterator[pa.RecordBatch], centres, dim: int) -> Iterator[pa.RecordBatch]:
    """The largest distance of the rows of a task from the centre of their tile."""
    known, most = centres.value, {}
    for batch in batches:
        x, tiles = list_matrix(batch.column("embedding"), dim), batch.column("tile").to_numpy()
        for cid, rows in _runs(batch.column("cid").to_numpy()):
            if cid in known:
                matrix, numbers = known[cid][:2]
                order = np.argsort(numbers)
                own = matrix[order[np.searchsorted(numbers[order], tiles[rows])]]
                far = np.sqrt(((x[rows] - own) ** 2).sum(axis=1))
                for tile, d in zip(tiles[rows].tolist(), far.tolist(), strict=True):
                    most[cid, tile] = max(most.get((cid, tile), 0.0), d)
    keys = list(most)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int64()), pa.array([most[k] for k in keys], pa.float64())], ["cid", "tile", "radius"])


def _own_tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Scores inside one tile, each with its row, and what is told of copies, without."""
    cid, tile = key
    found = tile_scores((cid, tile, tile), table)
    order = np.argsort(table.column("pos").to_numpy(), kind="stable")
    rows = table.take(pa.array(order)).select(["cid", "pos", "ord", "copied", "tile", "embedding"])
    best = found.filter(found.column("after").is_null())
    told = found.filter(found.column("after").is_valid())
    nulls = {n: pa.nulls(told.num_rows, rows.schema.field(n).type) for n in ("ord", "copied", "tile", "embedding")}
    more = pa.table({"cid": told.column("cid"), "pos": told.column("pos"), **nulls, "sim": told.column("sim"), "after": told.column("after")})
    scored = rows.append_column("sim", best.column("sim")).append_column("after", best.column("after"))
    return pa.concat_tables([scored, more.cast(scored.schema)])


def _visits(batches: Iterator[pa.RecordBatch], centres, dim: int) -> Iterator[pa.RecordBatch]:
    """Tiles that each row has to visit, beside its own."""
    known = centres.value
    for batch in batches:
        x, pos = list_matrix(batch.column("embedding"), dim), batch.column("pos").to_numpy()
        own, best = batch.column("tile").to_numpy(), batch.column("sim").to_numpy()
        copied = batch.column("copied").to_numpy(zero_copy_only=False)
        wanted: list[list[int]] = [[] for _ in range(len(x))]
        for cid, rows in _runs(batch.column("cid").to_numpy()):
            if cid in known:
                matrix, tiles, radius, first, last, norm = known[cid]
                square = (x[rows] * x[rows]).sum(axis=1)
                length = np.sqrt(square)[:, None]
                bound = np.minimum(x[rows] @ matrix.T + length * radius[None, :], length * norm[None, :])
                bound += SLACK * length * (norm[None, :] + 1)
                go = (first[None, :] < pos[rows, None]) & (bound > best[rows, None])
                go |= copied[rows, None] & (last[None, :] > pos[rows, None]) & (bound > square[:, None])
                go &= tiles[None, :] != own[rows, None]
                for i, row in enumerate(rows.tolist()):
                    wanted[row] = tiles[go[i]].tolist()
        yield batch.append_column("visited", pa.array(wanted, pa.list_(pa.int64())))


def _visit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Scores of the visitors of a tile against its rows."""
    cid = key[0].as_py()
    order = np.argsort(table.column("pos").to_numpy(), kind="stable")
    pos, begins = table.column("pos").to_numpy()[order], table.column("ord").to_numpy()[order]
    vectors = list_matrix(table.column("embedding"), dtype=np.float32)[order]
    copied = table.column("copied").to_numpy(zero_copy_only=False)[order]
    asks = table.column("asks").to_numpy(zero_copy_only=False)[order]
    queries, q_pos, q_copied = vectors[asks], pos[asks], copied[asks]
    rows, r_pos, r_ord = vectors[~asks], pos[~asks], begins[~asks]
    best = np.zeros(len(queries))
    squares = np.where(q_copied, np.einsum("ij,ij->i", queries, queries, dtype=np.float64), np.inf)
    told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(0, len(queries), QUERY_STRIP):
        part = slice(q, q + QUERY_STRIP)
        strip = queries[part].astype(np.float64)
        for e in range(0, len(rows), EARLIER_STRIP):
            sims = strip @ rows[e : e + EARLIER_STRIP].T.astype(np.float64)
            earlier = r_pos[None, e : e + EARLIER_STRIP] < q_pos[part, None]
            np.maximum(best[part], np.where(earlier, sims, 0.0).max(axis=1), out=best[part])
            if q_copied[part].any():
                later = np.where(earlier, -np.inf, sims).T
                row, column, value = records(later, squares[part])
                told.append((q_pos[q + column], r_ord[e + row], value))
    where, after, value = (np.concatenate(x) for x in zip(*told, strict=True)) if told else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table(
        {
            "cid": pa.array(np.full(len(best) + len(where), cid), pa.int32()),
            "pos": pa.array(np.concatenate([q_pos, where]), pa.int64()),
            "sim": pa.array(np.concatenate([best, value])),
            "after": pa.array([None] * len(best) + after.tolist(), pa.int64()),
        }
    )


def _tiles(rows: DataFrame, dim: int, limit: int) -> DataFrame | None:
    """(cid, pos, ord, copied, tile, embedding, height), written; none if there are too many pivots."""
    spark = rows.sparkSession
    large = F.col("n_distinct") > F.col("height")
    pivots = rows.where(large & (F.col("pos") % F.ceil(F.col("height") / PIVOTS) == 0)).select("cid", F.col("embedding").alias("centre"))
    pivots = materialize(pivots, "pivots")
    if pivots.count() * dim * 8 > limit:
        return None
    shared = spark.sparkContext.broadcast(_by_cluster(pivots.toArrow(), dim))
    narrow = rows.select("cid", "pos", "ord", "copied", "embedding", F.col("height").cast("long").alias("height"))
    schema = "cid int, pos long, ord long, copied boolean, embedding array<float>, height long, cell long"
    celled = materialize(narrow.mapInArrow(lambda b: _near_pivot(b, shared, dim), schema), "neighbourhoods")
    sizes = celled.groupBy("cid", "cell").agg(F.count("*").alias("size"))
    slices = F.least(F.ceil(F.col("size") / F.col("height")), F.lit(SLICES))
    tile = F.col("cell") * SLICES + F.pmod(F.xxhash64("pos"), slices)
    return join_counts(celled, sizes, ["cid", "cell"]).select("cid", "pos", "ord", "copied", tile.alias("tile"), "embedding", "height")


def _summaries(tiled: DataFrame, dim: int) -> DataFrame:
    """(cid, tile, centre, first, last, norm, radius) of the tiles of clusters with several tiles."""
    spark = tiled.sparkSession
    several = materialize(tiled.groupBy("cid").agg(F.count_distinct("tile").alias("tiles")).where("tiles > 1").select("cid"), "large-clusters")
    rows = join_counts(tiled, several, ["cid"])
    vector = array_to_vector("embedding")
    facts = rows.groupBy("cid", "tile").agg(
        vector_to_array(Summarizer.mean(vector)).alias("centre"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("norm"),
    )
    facts = materialize(facts, "tiles")
    shared = spark.sparkContext.broadcast(_by_cluster(facts.select("cid", "centre", "tile").toArrow(), dim, "tile"))
    radii = rows.select("cid", "tile", "embedding").mapInArrow(lambda b: _radii(b, shared, dim), "cid int, tile long, radius double")
    radii = radii.groupBy("cid", "tile").agg(F.max("radius").alias("radius"))
    return materialize(facts.join(radii, ["cid", "tile"]), "tiles-with-radii")


def score_distinct_pruned(
    placed: DataFrame, vectors: DataFrame, tile_rows: int | None = None, limit: int = CENTRE_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """``score_distinct``, and the (cid, pos, visited) rows and tiles that bounds left; none where they were too many to use."""
    spark = placed.sparkSession
    narrow = placed.select("cid", "idx", "ord", (F.col("copies") > 1).alias("copied"), "pos", "n_distinct")
    rows = narrow.join(vectors.select("idx", F.col("embedding").cast("array<float>").alias("embedding")), "idx")
    rows = materialize(rows.withColumn("height", tile_height(placed, tile_rows)), "distinct-vectors")
    widths = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    tiled = _tiles(rows, widths, limit)
    if tiled is None:
        return score_distinct(placed, vectors, tile_rows), None
    tiled = materialize(tiled, "tiled-vectors")
    facts = _summaries(tiled, widths)
    own = tiled.drop("height").groupBy("cid", "tile").applyInArrow(_own_tile, f"{_ROW}, sim double, after long")
    own = materialize(own, "own-tiles")
    shared = spark.sparkContext.broadcast(_by_cluster(facts.toArrow(), widths, "tile", "radius", "first", "last", "norm"))
    scored = own.where("after IS NULL").drop("after")
    schema = f"{_ROW}, sim double, visited array<long>"
    asked = scored.mapInArrow(lambda b: _visits(b, shared, widths), schema).where(F.size("visited") > 0)
    asked = materialize(asked, "visitors")
    heights = tiled.groupBy("cid", "tile").agg(F.max("height").alias("height"))
    asking = asked.select("cid", "pos", "ord", "copied", "embedding", F.explode("visited").alias("tile"))
    counts = asking.groupBy("cid", "tile").agg(F.count("*").alias("n")).join(heights, ["cid", "tile"])
    counts = materialize(counts.select("cid", "tile", F.ceil(F.col("n") / F.col("height")).alias("parts")), "tiles-visited")
    asking = join_counts(asking, counts, ["cid", "tile"]).withColumn("part", F.pmod(F.xxhash64("pos"), "parts"))
    told = join_counts(tiled, counts, ["cid", "tile"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    columns = ["cid", "tile", "part", "pos", "ord", "copied", "embedding"]
    both = asking.select(*columns, F.lit(True).alias("asks")).unionByName(told.select(*columns, F.lit(False).alias("asks")))
    found = both.groupBy("cid", "tile", "part").applyInArrow(_visit, "cid int, pos long, sim double, after long")
    return best_of_tiles(own.select("cid", "pos", "sim", "after").unionByName(found)), asked.select("cid", "pos", "visited")


def max_similarity_pruned(members: DataFrame, vectors: DataFrame, tile_rows: int | None = None, **options) -> DataFrame:
    """``max_similarity`` with tiles that bounds rule out; same scores."""
    return max_similarity(members, vectors, tile_rows, score=lambda p, v, t: score_distinct_pruned(p, v, t)[0], **options)
