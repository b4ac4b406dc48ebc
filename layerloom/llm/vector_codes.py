"""Vector code compression: codebooks for equal parts of vectors, trained and applied in whole numbers.

Each part position is a clustering of its own. Its points are sorted along a Hilbert curve, so that neighbours in
the order are neighbours in space, and stand in flat blocks of up to ``BLOCK`` points. A block stores the box around
its points, their sum and their count. Each round a block compares its box with the codebook: an entry whose
smallest distance to the box exceeds another's largest cannot be nearest to any of the points, nor can one that is
farther than the entry nearest to the middle throughout the box. What is left is the block's shortlist. A shortlist
of one takes the stored sum; otherwise a kernel works out the distances to the few entries exactly. Sums of tasks
are added up by Spark; only codebooks, of a fixed size, reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.scratch import Scratch

#: Equal parts of a vector, entries of a codebook, rounds, and units in one.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: Points of a block, and of a task that sorts them.
BLOCK, SORT_ROWS = 256, 200_000

#: Bits of a component, and of all components of a point, in its place on the curve.
COMPONENT_BITS, KEY_BITS = 8, 96

#: Labels up to which their sums are sent to all tasks, and pieces a label's rows are dealt into beyond.
LABELS, PIECES = 100_000, 32

#: Below this distances are exact in doubles.
EXACT = 2**53


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """Components in whole units of ``1 / scale``, all floors going down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))


def curve_place(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points (n, dims; unsigned numbers of ``bits`` bits) on the Hilbert curve, as rows of bytes."""
    x = points.T.astype(np.uint32).copy()
    dims, n = x.shape
    # Undo the turns and flips of each level, from the coarsest to the finest.
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, dtype=np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint32(1 << level)) != 0, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    # The first bit of every component, then the second of every component, and so on.
    levels = np.stack([(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)])
    return np.packbits(levels.transpose(2, 0, 1).reshape(n, bits * dims).astype(np.uint8), axis=1)


def binaries(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(rows)
    width = data.strides[0] if data.size else 0
    offsets = np.arange(len(data) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
    ).cast(pa.binary())


def _placed(low: np.ndarray, high: np.ndarray):
    """Each vector's parts with their places on the curves of their positions."""
    dims = len(low) // PARTS
    bits = max(1, min(COMPONENT_BITS, KEY_BITS // max(dims, 1)))
    width = np.maximum(high - low, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, len(low))
            cell = (((values - low) / width) * ((1 << bits) - 1)).astype(np.uint32)
            for part in range(PARTS):
                own = slice(part * dims, (part + 1) * dims)
                places = curve_place(cell[:, own], bits) if dims else np.zeros((batch.num_rows, 1), np.uint8)
                points = values[:, own].astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"),
                        pa.array(np.full(batch.num_rows, part, np.int32)),
                        binaries(places),
                        binaries(points),
                    ],
                    names=["row", "part", "place", "point"],
                )

    return run


def _blocks(dims: int):
    """Flat blocks of the sorted points of a task; a block holds points of one part position."""

    def block(part: int, rows: np.ndarray, values: np.ndarray) -> tuple:
        box = (values.min(axis=0), values.max(axis=0), values.sum(axis=0)) if dims else 3 * (np.zeros(0, np.int64),)
        return part, len(rows), rows.tobytes(), values.tobytes(), *(x.tobytes() for x in box)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            points = np.frombuffer(b"".join(batch.column("point").to_pylist()), dtype="<i8").reshape(len(rows), dims)
            made = []
            limits = np.concatenate([[0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]]).tolist()
            for lo, hi in zip(limits[:-1], limits[1:], strict=True):
                for at in range(lo, hi, BLOCK):
                    end = min(at + BLOCK, hi)
                    made.append(block(int(parts[at]), rows[at:end], points[at:end]))
            columns = [list(x) for x in zip(*made, strict=True)] if made else [[] for _ in BLOCK_NAMES]
            kinds = [pa.int32(), pa.int32(), *5 * [pa.binary()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=list(BLOCK_NAMES)
            )

    return run


BLOCK_NAMES = ("part", "n", "rows", "points", "low", "high", "total")
BLOCK_SCHEMA = "part int, n int, rows binary, points binary, low binary, high binary, total binary"


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries of a codebook, ascending, that may be nearest to a point of a box; ties stay."""
    nearest = np.maximum(np.maximum(low - book, book - high), 0)
    farthest = np.maximum(np.abs(book - low), np.abs(book - high))
    keep = np.flatnonzero((nearest**2).sum(axis=1) <= (farthest**2).sum(axis=1).min())
    if len(keep) > 1:
        # d(x, e) - d(x, f) is linear in x, so its smallest value in the box is at a corner.
        centre = 2 * book[keep] - (low + high)
        rival = book[keep[np.argmin((centre**2).sum(axis=1))]]
        slope = 2 * (rival - book[keep])
        least = np.where(slope > 0, slope * low, slope * high).sum(axis=1)
        keep = keep[least + (book[keep] ** 2).sum(axis=1) - (rival**2).sum() <= 0]
    return keep


def assign(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point (ties: the first) and the squared distance, both exact."""
    most = max((int(np.abs(x).max()) for x in (points, book) if x.size), default=0)
    kind = np.float64 if 4 * most * most * points.shape[1] < EXACT else np.int64
    p, b = points.astype(kind), book.astype(kind)
    # The distance without the square of the point itself, which is the same for all entries.
    relative = (b * b).sum(axis=1) - 2 * (p @ b.T)
    found = relative.argmin(axis=1)
    distance = np.take_along_axis(relative, found[:, None], axis=1)[:, 0] + (p * p).sum(axis=1)
    return found, distance.astype(np.int64)


def _read(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in BLOCK_NAMES], strict=True):
            part, n, rows, points, *box = row
            low, high, total = (np.frombuffer(x, dtype="<i8") for x in box)
            yield part, n, np.frombuffer(rows, "<i8"), np.frombuffer(points, "<i8").reshape(n, dims), low, high, total


def _round(books: list[np.ndarray], dims: int):
    """Sums and counts of the points nearest to each entry, one row for each entry a task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), dims), np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for part, n, _, points, low, high, total in _read(batches, dims):
            entries = shortlist(low, high, books[part])
            if len(entries) == 1:
                sums[part][entries[0]] += total
                counts[part][entries[0]] += n
                continue
            found = entries[assign(points, books[part][entries])[0]]
            np.add.at(sums[part], found, points)
            counts[part] += np.bincount(found, minlength=len(counts[part]))
        for part, (s, c) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), part, np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(c[used]),
                    *[pa.array(np.ascontiguousarray(s[used, i])) for i in range(dims)],
                ],
                names=["part", "entry", "n", *[f"s{i}" for i in range(dims)]],
            )

    return run


def _codes(books: list[np.ndarray], dims: int):
    """Row, part position, nearest entry and squared distance of each point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n, rows, points, low, high, _ in _read(batches, dims):
            entries = shortlist(low, high, books[part])
            found, distance = assign(points, books[part][entries])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(entries[found].astype(np.int32)),
                    pa.array(distance),
                ],
                names=["row", "part", "entry", "error"],
            )

    return run


def _limits(vectors: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest value of each component, from one row of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, size)
                low = values.min(axis=0) if low is None else np.minimum(low, values.min(axis=0))
                high = values.max(axis=0) if high is None else np.maximum(high, values.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(low), pa.array(high)], names=["i", "low", "high"]
            )

    found = vectors.select("v").mapInArrow(run, "i int, low bigint, high bigint")
    rows = found.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    return np.array([r.low for r in rows], np.int64), np.array([r.high for r in rows], np.int64)


def trained(blocks: DataFrame, books: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """The codebooks after all rounds; at most entries times parts rows reach the driver in each."""
    schema = ", ".join(["part int, entry int, n bigint", *[f"s{i} bigint" for i in range(dims)]])
    totals = [F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(dims)]]]
    for _ in range(ROUNDS):
        books = [b.copy() for b in books]
        for row in blocks.mapInArrow(_round(books, dims), schema).groupBy("part", "entry").agg(*totals).collect():
            books[row.part][row.entry] = [row[f"s{i}"] // row.n for i in range(dims)]
    return books


def compress(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    row_column: str | None = None,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors, and the codebooks (entries, components) of the part positions.

    The frame has a row for each vector kept: vec_id, code, error, label_error, codebooks_sha256. ``code`` names the
    nearest entry of each part in two hexadecimal digits, ``error`` sums the squared distances, ``label_error`` sums
    the errors of all rows of the label, null being a label. Codebooks start as the parts of the vectors of the 256
    smallest ids (fewer, if there are fewer) and are trained in four rounds.

    Vectors that are null or hold null, NaN or infinite components are dropped, and so are those of another length
    than that of the smallest id that is left whose length is a multiple of 4. Null ids come last; of equal ids the
    smaller vector comes first. Repeated rows are rows of their own. Other columns are ignored, whatever their names.
    A table without usable vectors gives no rows and codebooks without entries. Components times 1024 must be such
    that squared distances fit into 64 bits; others are an error.
    """
    scratch = Scratch(vectors.sparkSession)
    numbered = scratch.numbered(vectors, "_row_of_codes", row_column)
    kept = numbered.where(usable(vector_column) & (F.size(vector_column) % PARTS == 0)).select(
        F.col("_row_of_codes").alias("row"),
        F.col(id_column).alias("vec_id"),
        F.col(label_column).alias("label"),
        whole(vector_column, SCALE).alias("v"),
    )
    first = [F.asc_nulls_last("vec_id"), "v"]
    leader = kept.orderBy(*first).select(F.size("v")).first()
    size = leader[0] if leader else 0
    kept = scratch.write(kept.where(F.size("v") == size))
    dims = size // PARTS
    start = [r.v for r in kept.orderBy(*first).limit(ENTRIES).collect()]
    start = np.array(start, dtype=np.int64).reshape(len(start), size)
    books = [start[:, part * dims : (part + 1) * dims] for part in range(PARTS)]
    n_rows = kept.count()
    if not n_rows:
        none = {"code": "string", "error": "bigint", "label_error": "bigint"}
        return kept.select("vec_id", *[F.lit(None).cast(k).alias(c) for c, k in none.items()], _digest(books)), books
    low, high = _limits(kept, size)
    if size and 4 * int(max(abs(low.min()), abs(high.max()))) ** 2 * size >= 2**62:
        raise ValueError("Components are too large for exact squared distances in 64 bits")

    places = scratch.write(
        kept.select("row", "v").mapInArrow(_placed(low, high), "row bigint, part int, place binary, point binary")
    )
    # Rows of one place are dealt out by their number, so that equal vectors do not meet in one task.
    n_tasks = max(math.ceil(n_rows * PARTS / SORT_ROWS), PARTS)
    by = ["part", "place", F.xxhash64("row")]
    sorted_places = places.repartitionByRange(n_tasks, *by).sortWithinPartitions(*by)
    blocks = scratch.write(sorted_places.select("part", "row", "point").mapInArrow(_blocks(dims), BLOCK_SCHEMA))
    scratch.drop(places)

    books = trained(blocks, books, dims)
    codes = blocks.mapInArrow(_codes(books, dims), "row bigint, part int, entry int, error bigint")
    kinds = {f.name: f.dataType for f in kept.schema.fields}
    unknown = lambda name, kind: F.lit(None).cast(kind).alias(name)
    base = kept.select("row", "vec_id", "label", unknown("part", "int"), unknown("entry", "int"), unknown("error", "bigint"))
    parts = codes.select(
        "row", unknown("vec_id", kinds["vec_id"]), unknown("label", kinds["label"]), "part", "entry", "error"
    )
    digits = [
        F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(PARTS)
    ]
    coded = scratch.write(
        base.unionByName(parts)
        .groupBy("row")
        .agg(
            F.max("vec_id").alias("vec_id"),
            F.max("label").alias("label"),
            F.concat(*digits).alias("code"),
            F.sum("error").alias("error"),
        )
    )
    found = _with_label_errors(coded, scratch)
    return found.select("vec_id", "code", "error", "label_error", _digest(books)), books


def _digest(books: list[np.ndarray]) -> Column:
    """SHA-256 of all components by part, entry and place, in decimals with commas between."""
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")


def _with_label_errors(coded: DataFrame, scratch: Scratch) -> DataFrame:
    """Every row with the errors of its label summed; a label of many rows is dealt into pieces."""
    sums = scratch.write(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    sums = sums.withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= LABELS:
        return coded.join(F.broadcast(sums), same)
    pieces = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("_piece"))
    piece = F.pmod(F.xxhash64("row"), F.lit(PIECES)).cast("int")
    return coded.withColumn("_own_piece", piece).join(pieces, same & (F.col("_own_piece") == F.col("_piece")))
