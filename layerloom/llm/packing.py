"""Packing token sequences into as few bins as possible by bin completion.

Pieces are packed by their lengths alone, and there are at most ``capacity`` lengths, so the search works
on a table of lengths and counts that has the same bound whatever the corpus. Around the longest length
left it completes one bin: it walks the fillings of the space beside it, leaves out those dominated by a
filling with a longer last piece, and prunes those that must waste as much as the best so far, the
best-fit filling being the first incumbent. The chosen filling is used for
as many bins as its lengths allow, then the next is searched. This packing is the incumbent of the whole. If it has more
bins than the lower bound, all lengths over the capacity, the search branches over the undominated fillings of each bin and
the number of bins that take them, and prunes what wastes more in total than one bin less leaves. Spark numbers the
pieces of each length and looks up their bins.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.llm.byte_pairs import text_encoder
from layerloom.llm.scratch import Scratch

CAPACITY = 2048

#: Search nodes per bin; a filling without waste ends the search at once.
NODES = 2000

#: Steps of the search over whole packings, and those that list the fillings of one bin; beyond, the best packing so far
#: may not be the best of all.
STEPS, LISTED = 200_000, 5_000


class _Supply:
    """Lengths that are left, sorted, with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.count)

    def longest_up_to(self, room: int, below: int | None = None) -> int | None:
        """The longest length within ``room`` and, if given, shorter than ``below``."""
        at = bisect.bisect_right(self.lengths, room if below is None else min(room, below - 1))
        return self.lengths[at - 1] if at else None

    def take(self, filling: Counter, times: int) -> None:
        for n, c in filling.items():
            self.count[n] -= c * times
            if not self.count[n]:
                del self.count[n]
                self.lengths.pop(bisect.bisect_left(self.lengths, n))


def _best_fit(supply: _Supply, room: int, used: Counter) -> list[int]:
    """The longest length that fits, again and again."""
    filling, used = [], Counter(used)
    n = supply.longest_up_to(room)
    while n is not None:
        if used[n] < supply.count[n]:
            filling.append(n)
            used[n] += 1
            room -= n
            n = supply.longest_up_to(room)
        else:
            n = supply.longest_up_to(room, n)
    return filling


def complete(supply: _Supply, capacity: int, nodes: int = NODES) -> Counter:
    """The filling of one bin around the longest length left that wastes least."""
    largest = supply.lengths[-1]
    room, first = capacity - largest, Counter([largest])
    incumbent = _best_fit(supply, room, first)
    waste = room - sum(incumbent)
    # What all pieces up to a length add up to: more than that cannot be filled with them.
    totals = dict(
        zip(supply.lengths, accumulate(n * supply.count[n] for n in supply.lengths), strict=True)
    )
    # Depth first, longer pieces first; each entry: chosen lengths, space, longest allowed.
    stack: list[tuple[list[int], int, int]] = [([], room, room)]
    while stack and waste and nodes:
        nodes -= 1
        chosen, space, most = stack.pop()
        used, options, closed = first + Counter(chosen), [], False
        n = supply.longest_up_to(min(space, most))
        while n is not None and space - totals[n] < waste:
            if used[n] < supply.count[n]:
                if space - n >= supply.lengths[0]:
                    options.append(n)
                elif not closed:
                    # Nothing fits beside this last piece; a shorter last piece is dominated by it.
                    closed = True
                    if space - n < waste:
                        incumbent, waste = [*chosen, n], space - n
            n = supply.longest_up_to(min(space, most), n)
        if space < waste:
            incumbent, waste = chosen, space
        stack += [([*chosen, n], space - n, n) for n in reversed(options)]
    return first + Counter(incumbent)


def _greedy(counts: dict[int, int], capacity: int, nodes: int) -> list[tuple[Counter, int]]:
    """Fillings and the numbers of their bins, one bin of least waste after the other."""
    supply, blocks = _Supply(counts), []
    while supply.lengths:
        filling = complete(supply, capacity, nodes)
        bins = min(supply.count[n] // c for n, c in filling.items())
        blocks.append((filling, bins))
        supply.take(filling, bins)
    return blocks


class _Search:
    """Packings within a total waste, by fillings in falling order for each longest length."""

    def __init__(self, capacity: int, steps: int):
        self.capacity, self.steps, self.whole = capacity, steps, True

    def _dominated(self, lengths: list[int], count: dict[int, int], filling: tuple, waste: int) -> bool:
        """Whether a longer piece that is left fits in place of one of the filling, or beside it."""
        used = Counter(filling)
        for n in {0, *filling[1:]}:
            at = bisect.bisect_right(lengths, n)
            while at < len(lengths) and lengths[at] <= n + waste:
                if used[lengths[at]] < count[lengths[at]]:
                    return True
                at += 1
        return False

    def fillings(self, count: dict[int, int], below: tuple | None, slack: int) -> list[tuple]:
        """Undominated fillings around the longest length that waste at most ``slack``, the least waste first."""
        lengths = sorted(count)
        totals = list(accumulate(n * count[n] for n in lengths))
        found, stack = [], [((lengths[-1],), self.capacity - lengths[-1], len(lengths) - 1)]
        listed = 0
        while stack and self.steps > 0:
            if listed == LISTED:
                self.whole = False
                break
            self.steps -= 1
            listed += 1
            filling, space, top = stack.pop()
            if space <= slack and (below is None or filling < below):
                if not self._dominated(lengths, count, filling, space):
                    found.append((space, filling))
            at = min(top, bisect.bisect_right(lengths, space) - 1)
            while at >= 0 and space - totals[at] <= slack:
                n = lengths[at]
                if filling.count(n) < count[n]:
                    stack.append(((*filling, n), space - n, at))
                at -= 1
        return [f for _, f in sorted(found, key=lambda x: (x[0], [-n for n in x[1]]))]

    def _choices(self, count: dict[int, int], below: tuple | None, slack: int):
        for filling in self.fillings(count, below, slack):
            used, waste = Counter(filling), self.capacity - sum(filling)
            most = min(count[n] // c for n, c in used.items())
            if waste:
                most = min(most, slack // waste)
            for bins in range(most, 0, -1):
                self.steps -= 1
                if self.steps <= 0:
                    return
                left = {n: c - used[n] * bins for n, c in count.items() if c > used[n] * bins}
                yield used, bins, filling, left, slack - waste * bins

    def within(self, counts: dict[int, int], slack: int) -> list[tuple[Counter, int]] | None:
        """A packing that wastes at most ``slack``, or None: there is none, or the steps ran out."""
        levels, blocks = [self._choices(counts, None, slack)], []
        while levels and self.steps > 0:
            choice = next(levels[-1], None)
            if choice is None:
                levels.pop()
                if blocks:
                    blocks.pop()
                continue
            used, bins, filling, left, rest = choice
            blocks.append((used, bins))
            if not left:
                return blocks
            levels.append(self._choices(left, filling if max(left) == filling[0] else None, rest))
        return None


def best_blocks(
    counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS
) -> tuple[list[tuple[Counter, int]], bool]:
    """Fillings with the numbers of their bins, and whether fewer bins are known to be impossible."""
    counts = {n: c for n, c in counts.items() if c > 0}
    best, total = _greedy(counts, capacity, nodes), sum(n * c for n, c in counts.items())
    search = _Search(capacity, steps)
    while (fewer := sum(b for _, b in best) - 1) >= -(-total // capacity):
        found = search.within(counts, fewer * capacity - total)
        if found is None:
            return best, search.whole and search.steps > 0
        best = found
    return best, True


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple]:
    """(length, first rank, copies, offset, bins, first bin) of each place, in blocks of like bins.

    Bins ``first bin`` and on, ``bins`` of them, hold the pieces of that length with ranks from
    ``first rank``, ``copies`` next to each other from ``offset``.
    """
    rank, next_bin, places = Counter(), 0, []
    for filling, bins in best_blocks(counts, capacity, nodes)[0]:
        offset = 0
        for n, copies in sorted(filling.items(), reverse=True):
            places.append((n, rank[n], copies, offset, bins, next_bin))
            rank[n] += copies * bins
            offset += n * copies
        next_bin += bins
    return places


def _cut(tokenizer_path: str, capacity: int, end_id: int):
    """Pieces of each text with a number among the task's pieces of the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = text_encoder(tokenizer_path), TaskContext.get().partitionId()
        end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        seen: Counter = Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                data = encoder.encode(text.as_py()) + end
                # The first piece takes the remainder, so all others are full.
                first = len(data) % width or width
                starts = [0, *range(first, len(data), width)]
                ends = [*starts[1:], len(data)]
                for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
                    n = (b - a) // 4
                    rows.append((doc.as_py(), k, a // 4, n, zlib.crc32(data[a:b]), part, seen[n]))
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64()]
            kinds += [pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and then ``end_id``; a null or empty text is ``end_id`` alone. Only
    documents longer than ``capacity`` are cut, the first piece taking the remainder. Each sequence is
    filled without gaps from 0. Ids may be null or repeat (each row is packed for itself); other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = scratch.write(
        rows.mapInArrow(
            _cut(tokenizer_path, capacity, end_id),
            f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, "
            "number bigint",
        )
    )
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = by_part.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )
    # At most ``capacity`` rows reach the driver.
    totals = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["length"]: r["n"] for r in totals}
    # Each block of bins uses up one length or is a step of the search, so the places are bounded too.
    places = spark.createDataFrame(
        plan_bins(counts, capacity),
        "length bigint, first bigint, copies bigint, at bigint, bins bigint, first_bin bigint",
    )
    inside = F.col("rank") - F.col("first")
    return (
        pieces.join(shifts, ["length", "part"])
        .withColumn("rank", F.col("number") + F.col("shift"))
        .join(
            F.broadcast(places.withColumnRenamed("length", "_length")),
            (F.col("length") == F.col("_length"))
            & (F.col("rank") >= F.col("first"))
            & (F.col("rank") < F.col("first") + F.col("copies") * F.col("bins")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_bin") + F.floor(inside / F.col("copies"))).cast("long").alias("sequence_id"),
            (F.col("at") + inside % F.col("copies") * F.col("length")).alias("offset"),
        )
    )
