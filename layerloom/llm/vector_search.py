"""Exact top-k search by inner product, with candidates ruled out by a table of distances to pivots.

A few vectors far from each other are the pivots, and every vector stores its distances to all of them. For a
query and a candidate the distances to any pivot differ by no more than the distance between the two, so the
largest difference over the pivots is a lower bound of that distance, and
``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2`` makes it an upper bound of the product. A query takes the candidates in the order
of their bounds and stops where the next bound is below its k-th score; what it has not seen by then cannot enter.

Candidates are sorted by their nearest pivot and the distance to it, and cut into shards; queries form blocks. A
block meets every shard once, in a task that holds one of each. Each meeting gives the best of the shard, and
the best of those are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.llm.scratch import Scratch
from layerloom.llm.vector_codes import EXACT, usable, whole

#: Scores listed for each query, and units in one.
TOP, SCALE = 5, 256

#: Pivots, and vectors they are chosen from.
PIVOTS, PIVOT_SAMPLE = 32, 2000

#: Most candidates of a shard, the number of shards smaller tables are cut into, and queries of a block.
SHARD_ROWS, LEAST_SHARDS, BLOCK_ROWS = 32_768, 64, 1024

#: Queries whose bounds are worked out together, and candidates taken from an order of bounds at first.
TOGETHER, FIRST_TAKEN = 32, 64

#: Share of the norms that bounds are widened by for the rounding of the stored distances.
SLACK = 1e-6


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each the farthest from those before it (ties: the first)."""
    if not len(sample):
        return sample
    chosen, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (points, pivots) of whole-numbered doubles."""
    squares = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * (points @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(batch.num_rows, size).astype(np.float64)


def _near_pivots(pivots: np.ndarray):
    """Each candidate with the number of its nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = distances(_matrix(batch, pivots.shape[1]), pivots)
            cell = table.argmin(axis=1)
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(table[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "gap"])

    return run


_PACKED = "n int, rows binary, ids binary, unnamed binary, points binary, table binary"


def _packed(size: int, most: int, pivots: np.ndarray | None = None):
    """Vectors of a task in pieces of up to ``most`` rows; with pivots the pieces hold the pivot table, too."""

    def piece(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = _matrix(batch, size)
        table = b"" if pivots is None else np.ascontiguousarray(distances(points, pivots).T, dtype="<f4").tobytes()
        ids = batch.column("vec_id")
        values = [
            batch.column("row").to_numpy().astype("<i8").tobytes(),
            ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
            ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
            points.astype("<i4").tobytes(),
            table,
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([batch.num_rows], pa.int32()), *[pa.array([v], pa.binary()) for v in values]],
            names=[c.split()[0] for c in _PACKED.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - rows)
                held, rows, batch = [*held, part], rows + part.num_rows, batch.slice(part.num_rows)
                if rows == most:
                    yield piece(_one(held))
                    held, rows = [], 0
        if rows:
            yield piece(_one(held))

    return run


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


class _Piece:
    """Rows, ids and vectors of a shard or of a block of queries."""

    def __init__(self, columns: dict, size: int):
        n = columns["n"]
        self.rows, self.ids = (np.frombuffer(columns[c], "<i8") for c in ("rows", "ids"))
        self.unnamed = np.frombuffer(columns["unnamed"], np.uint8)
        self.points = np.frombuffer(columns["points"], "<i4").reshape(n, size).astype(np.float64)
        self.squares = (self.points**2).sum(axis=1)
        self.table = np.frombuffer(columns["table"], "<f4").reshape(-1, n) if columns["table"] else None


def _bounds(queries: np.ndarray, squares: np.ndarray, shard: _Piece, pivots: np.ndarray) -> np.ndarray:
    """An upper bound of each product (queries, candidates of a shard)."""
    own = distances(queries, pivots).astype(np.float32)
    gap = np.zeros((len(queries), len(shard.rows)), dtype=np.float32)
    for i in range(len(pivots)):
        np.maximum(gap, np.abs(own[:, i, None] - shard.table[i][None, :]), out=gap)
    norms = squares[:, None] + shard.squares[None, :]
    rounding = np.float32(SLACK) * (own.max(initial=0) + shard.table.max(initial=0))
    gap = np.maximum(gap - rounding, 0).astype(np.float64)
    return (norms - gap * gap) / 2 + SLACK * norms


def _best(bound: np.ndarray, query: np.ndarray, shard: _Piece, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the shard and scores of a query's best, by score, then id; exact."""
    places, scores = np.zeros(0, np.int64), np.zeros(0)
    left, take = np.flatnonzero(bound > -np.inf), FIRST_TAKEN
    while len(left):
        if len(left) > take:
            cut = np.argpartition(-bound[left], take - 1)
            now, left = left[cut[:take]], left[cut[take:]]
        else:
            now, left = left, left[:0]
        places = np.concatenate([places, now])
        scores = np.concatenate([scores, shard.points[now] @ query])
        order = np.lexsort((shard.ids[places], shard.unnamed[places], -scores))[:top]
        places, scores = places[order], scores[order]
        if len(scores) == top:
            left = left[bound[left] >= scores[-1]]
        take *= 4
    return places, scores


def _meetings(pivots: np.ndarray, size: int, top: int):
    """The best candidates of a shard for each query of a block."""
    names = [c.split()[0] for c in _PACKED.split(", ")]

    def meet(block: _Piece, shard: _Piece) -> pa.RecordBatch:
        found = []
        for at in range(0, len(block.rows), TOGETHER):
            part = slice(at, at + TOGETHER)
            bounds = _bounds(block.points[part], block.squares[part], shard, pivots)
            bounds[block.rows[part][:, None] == shard.rows[None, :]] = -np.inf
            for i, bound in enumerate(bounds, at):
                places, scores = _best(bound, block.points[i], shard, top)
                found.append((np.full(len(places), i), places, scores))
        of, places, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = lambda piece, i: pa.array(piece.ids[i], pa.int64(), mask=piece.unnamed[i].astype(bool))
        return pa.RecordBatch.from_arrays(
            [pa.array(block.rows[of]), ids(block, of), ids(shard, places), pa.array(scores.astype(np.int64))],
            names=["query", "query_id", "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                block = _Piece({c: row[f"q_{c}"] for c in names}, size)
                yield meet(block, _Piece({c: row[c] for c in names}, size))

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    top: int = TOP,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    row_column: str | None = None,
) -> DataFrame:
    """The ``top`` other rows of highest inner product for each query row: query_id, rank, vec_id, score.

    ``is_query`` picks the queries by a condition on ``vectors``; null does not pick. Components become
    ``floor(scale * x)``. A query meets every row but itself; equal scores rank by ascending id, nulls last. All
    are listed if there are fewer than ``top``.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do those of another length than
    that of the smallest id left (null ids last; of equal ids the smaller vector counts). Repeated rows are rows of
    their own: a copy of a query is a candidate, and a repeated query id has a list for each of its rows. Ids are
    integers. Other columns are ignored, whatever their names. A table without queries gives no rows. Components must
    be such that products are exact in doubles and whole in 32 bits; others are an error.
    """
    scratch, number = Scratch(vectors.sparkSession), "_row_of_search"
    numbered = scratch.numbered(vectors.withColumn("_is_query", F.coalesce(is_query, F.lit(False))), number, row_column)
    kept = numbered.where(usable(vector_column)).select(
        F.col(number).alias("row"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.col("_is_query").alias("asks"),
        whole(vector_column, scale).alias("v"),
    )
    leader = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v")).first()
    size = leader[0] if leader else 0
    kept = scratch.write(kept.where(F.size("v") == size))
    none = kept.where(F.lit(False))
    n_rows, largest = kept.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not n_rows:
        return none.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("bigint").alias("score")
        )
    if largest and (4 * largest * largest * size >= EXACT or largest >= 2**31):
        raise ValueError("Components are too large for exact products")

    sample = kept.orderBy(F.xxhash64("row"), "row").limit(PIVOT_SAMPLE).collect()
    pivots = spread_out(np.array([r.v for r in sample], dtype=np.float64).reshape(len(sample), size), PIVOTS)
    near = kept.drop("asks").mapInArrow(
        _near_pivots(pivots), "row bigint, vec_id bigint, v array<bigint>, cell int, gap double"
    )
    n_shards = max(math.ceil(n_rows / SHARD_ROWS), min(LEAST_SHARDS, math.ceil(n_rows / BLOCK_ROWS)))
    # Equally far vectors are dealt out by their numbers, so that copies do not meet in one task.
    by = ["cell", "gap", F.xxhash64("row")]
    shards = scratch.write(
        near.repartitionByRange(n_shards, *by)
        .mapInArrow(_packed(size, SHARD_ROWS, pivots), _PACKED)
        .withColumn("shard", F.spark_partition_id())
    )
    last = shards.agg(F.max("shard")).first()[0]
    names = [c.split()[0] for c in _PACKED.split(", ")]
    blocks = scratch.write(kept.where("asks").mapInArrow(_packed(size, BLOCK_ROWS), _PACKED))
    asking = blocks.select(*[F.col(c).alias(f"q_{c}") for c in names]).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(last)))
    )
    found = scratch.write(
        asking.join(shards, "shard")
        .drop("shard")
        .mapInArrow(_meetings(pivots, size, top), "query bigint, query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
