"""Highest similarity of every document to an EARLIER member of its cluster.

A cluster may hold a large share of all rows, so it is never handled as one group:

* copies of one vector are scored through their first occurrence, and through those
  distinct vectors between the copies that are nearer to it than it is to itself;
* the distinct vectors of a cluster are cut into tiles, and one task scores one pair of
  tiles, keeping one maximum per row (never the pairs themselves).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.functions.arrow import list_matrix
from semprune.functions.vectors import fingerprint, squared_norm
from semprune.operators.joins import SMALL_ROWS, join_counts
from semprune.operators.positions import position_by_key
from semprune.session import materialize

# Tiles of a cluster. A row is sent to as many tasks as its cluster has tiles, so tiles are as large
# as TILE_BYTES of float32 values allow. Only a cluster whose pairs are more than a fair share of a
# task (all pairs / (TASK_SHARES x cores)) is cut finer, into up to TILES_AIM tiles.
TILE_ROWS = 4096
TILES_AIM = 32
TASK_SHARES = 4
TILE_BYTES = 64 << 20
# Rows of the two tiles multiplied at once, in double precision.
QUERY_STRIP = 1024
EARLIER_STRIP = 4096
# Copies of one vector from which on the group counts as hot, and the parts it is split into.
HOT_COPIES = 100_000
HOT_PARTS = 256


def records(sims: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) where a column reaches a new highest value, going down; ``best`` is updated."""
    before = np.maximum.accumulate(np.vstack([best[None, :], sims[:-1]]), axis=0) if len(sims) else sims
    row, column = np.nonzero(sims > before)
    np.maximum(best, sims.max(axis=0), out=best)
    return row, column, sims[row, column]


def tile_scores(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Maximum over earlier rows for one pair of tiles of one cluster.

    A row with ``after`` says that the copies of ``pos`` behind that place are at least as near as ``sim``
    to a vector between; only new highest values, above the vector's own square, are told.
    """
    cid, first, second = (k.as_py() for k in key)
    place = table.column("pos").to_numpy()
    order = np.argsort(place, kind="stable")
    place = place[order]
    vectors = list_matrix(table.column("embedding"), dtype=np.float32)[order]
    begins = table.column("ord").to_numpy()[order]
    copied = table.column("copied").to_numpy(zero_copy_only=False)[order]
    is_query = table.column("tile").to_numpy()[order] == second
    queries, query_place, query_begin = vectors[is_query], place[is_query], begins[is_query]
    rest = slice(None) if first == second else ~is_query
    earlier, earlier_place, copied = vectors[rest], place[rest], copied[rest]
    best = np.zeros(len(queries))
    own = np.where(copied, np.einsum("ij,ij->i", earlier, earlier, dtype=np.float64), np.inf)
    told: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(0, len(queries), QUERY_STRIP):
        strip = queries[q : q + QUERY_STRIP].astype(np.float64)
        top = best[q : q + QUERY_STRIP]
        # Inside one tile a row is compared with the rows above it only.
        stop = q + len(strip) if first == second else len(earlier)
        for e in range(0, stop, EARLIER_STRIP):
            sims = strip @ earlier[e : min(e + EARLIER_STRIP, stop)].T.astype(np.float64)
            if first == second and e + sims.shape[1] > q:
                sims[np.arange(e, e + sims.shape[1])[None, :] >= np.arange(q, q + len(strip))[:, None]] = 0.0
            np.maximum(top, sims.max(axis=1), out=top)
            if copied[e : e + sims.shape[1]].any():
                row, column, value = records(sims, own[e : e + sims.shape[1]])
                told.append((earlier_place[e + column], query_begin[q + row], value))
    where, after, value = (np.concatenate(x) for x in zip(*told, strict=True)) if told else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table(
        {
            "cid": pa.array(np.full(len(best) + len(where), cid), pa.int32()),
            "pos": pa.array(np.concatenate([query_place, where]), pa.int64()),
            "sim": pa.array(np.concatenate([best, value])),
            "after": pa.array([None] * len(best) + after.tolist(), pa.int64()),
        }
    )


def tile_height(placed: DataFrame, tile_rows: int | None) -> Column:
    """Rows of a tile; ``tile_rows`` is the least, as a cluster of many more rows would send each row to as many more tasks."""
    most = F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (4 * F.size("embedding"))))
    aim = F.ceil(F.col("n_distinct") / TILES_AIM)
    if tile_rows:
        return F.greatest(F.lit(tile_rows).cast("long"), F.least(most, aim))
    pairs = F.col("n_distinct").cast("double") * F.col("n_distinct")
    total = placed.select("cid", "n_distinct").distinct().agg(F.sum(pairs)).first()[0] or 0.0
    share = total / (TASK_SHARES * placed.sparkSession.sparkContext.defaultParallelism)
    fine = F.least(most, F.greatest(F.lit(TILE_ROWS), aim))
    return F.when(pairs > share, fine).otherwise(most)


def tile_rows_of_pairs(placed: DataFrame, vectors: DataFrame, tile_rows: int | None = None) -> DataFrame:
    """(cid, first, second, pos, ord, copied, tile, embedding): each row once for each pair of tiles it is part of.

    Tiles follow the order in the cluster. With ``n_old``, the rows below that place have their scores already: they have tiles
    of their own, and no pair of two of those is formed.
    """
    n_old = F.col("n_old") if "n_old" in placed.columns else F.lit(0)
    narrow = placed.select("cid", "idx", "ord", (F.col("copies") > 1).alias("copied"), "pos", "n_distinct", n_old.cast("long").alias("n_old"))
    rows = narrow.join(vectors.select("idx", F.col("embedding").cast("array<float>").alias("embedding")), "idx")
    rows = rows.withColumn("height", tile_height(placed, tile_rows))
    old_tiles = F.ceil(F.col("n_old") / F.col("height"))
    is_old = F.col("pos") < F.col("n_old")
    new_tile = lambda place: old_tiles + F.floor((place - F.col("n_old")) / F.col("height"))
    tile = F.when(is_old, F.floor(F.col("pos") / F.col("height"))).otherwise(new_tile(F.col("pos")))
    begin = F.when(is_old, old_tiles).otherwise(F.lit(0).cast("long"))
    tiled = rows.select(
        "cid",
        "pos",
        "ord",
        "copied",
        "embedding",
        tile.cast("int").alias("tile"),
        F.explode(F.sequence(begin.cast("int"), new_tile(F.col("n_distinct") - 1).cast("int"))).alias("partner"),
    )
    return tiled.select(
        "cid",
        F.least("tile", "partner").alias("first"),
        F.greatest("tile", "partner").alias("second"),
        "pos",
        "ord",
        "copied",
        "tile",
        "embedding",
    )


def best_of_tiles(partial: DataFrame) -> DataFrame:
    """(cid, pos, sim, nearer) from what tasks say of (cid, pos, sim, after)."""
    between = F.col("after").isNotNull()
    return partial.groupBy("cid", "pos").agg(
        F.max(F.when(~between, F.col("sim"))).alias("sim"),
        F.collect_list(F.when(between, F.struct("after", "sim"))).alias("nearer"),
    )


def score_distinct(placed: DataFrame, vectors: DataFrame, tile_rows: int | None = None) -> DataFrame:
    """(cid, idx, ord, copies, pos, n_distinct) with vectors by ``idx`` -> (cid, pos, sim, nearer).

    A row of a cluster with t tiles is sent to the t pairs its tile is part of, and a task
    holds two tiles whatever the size of the cluster. ``nearer`` lists (after, sim) for the copies.
    """
    pairs = tile_rows_of_pairs(placed, vectors, tile_rows)
    return best_of_tiles(pairs.groupBy("cid", "first", "second").applyInArrow(tile_scores, "cid int, pos long, sim double, after long"))


VECTOR_KEY = ["cid", "fp1", "fp2"]


def _with_traits(members: DataFrame, vectors: DataFrame) -> DataFrame:
    high, low = fingerprint(F.col("embedding"))
    traits = vectors.select("idx", high.alias("fp1"), low.alias("fp2"), squared_norm(F.col("embedding")).alias("self_sim"))
    return materialize(members.select("cid", "ord", "idx", "uid").join(traits, "idx"), "members")


def _firsts(narrow: DataFrame) -> DataFrame:
    """The first member of each distinct vector of a cluster, and the number of copies."""
    return narrow.groupBy(*VECTOR_KEY).agg(F.min("ord").alias("ord"), F.min_by("idx", "ord").alias("idx"), F.count("*").alias("copies"))


def _spread(narrow: DataFrame, placed: DataFrame, scored: DataFrame, hot_copies: int) -> DataFrame:
    """Scores of all members from those of the first ones (``placed``, written)."""
    scored = placed.join(scored, ["cid", "pos"])
    # Vectors with very many copies are split over HOT_PARTS join keys on both sides.
    is_hot = F.col("copies") > hot_copies
    hot = placed.where(is_hot).select(*VECTOR_KEY, F.lit(True).alias("hot"))
    scores = scored.select(*VECTOR_KEY, F.col("ord").alias("first_ord"), "sim", "nearer", "copies")
    n_hot = hot.count()
    if n_hot:
        parts = F.sequence(F.lit(0), F.when(is_hot, F.lit(HOT_PARTS - 1)).otherwise(F.lit(0)))
        scores = scores.withColumn("part", F.explode(parts))
        # At most rows / hot_copies of them.
        marked = narrow.join(F.broadcast(hot) if n_hot <= SMALL_ROWS else hot, VECTOR_KEY, "left")
        part = F.when(F.col("hot"), F.pmod("ord", F.lit(HOT_PARTS))).otherwise(F.lit(0)).cast("int")
        joined = marked.withColumn("part", part).join(scores, [*VECTOR_KEY, "part"])
    else:
        joined = narrow.join(scores, VECTOR_KEY)
    between = F.array_max(F.transform(F.filter("nearer", lambda x: x["after"] < F.col("ord")), lambda x: x["sim"]))
    sim = F.when(F.col("ord") == F.col("first_ord"), F.col("sim")).otherwise(F.greatest("sim", "self_sim", between))
    return joined.select("cid", "ord", "idx", "uid", sim.alias("sim"))


def max_similarity(
    members: DataFrame,
    vectors: DataFrame,
    tile_rows: int | None = None,
    hot_copies: int = HOT_COPIES,
    score: Callable[[DataFrame, DataFrame, int | None], DataFrame] = score_distinct,
) -> DataFrame:
    """Score of every member: ``max(0, highest inner product with an earlier member)``.

    ``members(cid, ord, idx, uid)`` with ``ord`` unique in the cluster, ``vectors(idx,
    embedding)`` -> ``cid, ord, idx, uid, sim``. The first member of a cluster scores 0. Of a
    group of copies the first is scored against the other vectors before it. A later copy has
    its score, the square of its own length, and what longer vectors between the copies add.
    ``score`` scores the distinct vectors.
    """
    narrow = _with_traits(members, vectors)
    placed = materialize(position_by_key(_firsts(narrow), ["cid"], "ord", "pos", size_out="n_distinct"), "distinct")
    return _spread(narrow, placed, score(placed, vectors, tile_rows), hot_copies)


def _new_distinct(earlier: DataFrame, narrow: DataFrame, vectors: DataFrame) -> DataFrame:
    """Distinct earlier vectors of the clusters that get members, then distinct new ones; ``n_old`` counts the earlier."""
    touched = materialize(narrow.select("cid").distinct(), "clusters-touched")
    old = _with_traits(join_counts(earlier.select("cid", "ord", "idx", "uid"), touched, ["cid"]), vectors)
    old = _firsts(old).withColumn("copies", F.lit(1).cast("long")).withColumn("old", F.lit(1))
    both = materialize(old.unionByName(_firsts(narrow).withColumn("old", F.lit(0))), "distinct-of-both")
    order = both.groupBy("cid").agg(F.max(F.when(F.col("old") == 1, F.col("ord"))).alias("last"), F.min(F.when(F.col("old") == 0, F.col("ord"))).alias("first"))
    if order.where("last >= first").limit(1).count():
        raise ValueError("new members must follow the earlier ones of their cluster")
    placed = position_by_key(both, ["cid"], "ord", "pos", size_out="n_distinct")
    return materialize(join_counts(placed, both.groupBy("cid").agg(F.sum("old").alias("n_old")), ["cid"]), "distinct")


def new_similarity(earlier: DataFrame, members: DataFrame, vectors: DataFrame, tile_rows: int | None = None, hot_copies: int = HOT_COPIES) -> DataFrame:
    """Scores of new ``members`` that follow all ``earlier`` ones of their cluster.

    The scores of earlier members do not change, so only pairs of tiles with new rows are formed, and clusters without new
    members are not read. A vector that comes again is scored anew, against its earlier copy too.
    """
    narrow = _with_traits(members, vectors)
    placed = _new_distinct(earlier, narrow, vectors)
    scored = score_distinct(placed, vectors, tile_rows)
    return _spread(narrow, placed.where("old = 0"), scored, hot_copies)
