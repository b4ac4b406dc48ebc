"""Byte strings that documents share, by interval expansion on a Burrows-Wheeler transform.

Of each 50-byte string that also starts in a document with a smaller id, all bytes are removed. Finding them
takes four steps.

1. Anchors. In each window of 50 bytes the 24-byte string of the smallest hash is an anchor, so equal windows
   have equal anchors. Anchors travel as compressed blocks per hash range, first once for each block and hash
   with the smallest and the largest row; those that only one document has need nothing more.
2. Contexts. Runs of shared anchors are cut into chunks where the content says so, and equal chunks become
   one with the smallest id of their documents, however many copies there are. Around an anchor of a chunk lie the
   at most 76 bytes of all windows that contain it; equal contexts become one as well.
3. Expansion. Of contexts that differ around the same anchor, the common strings are found on the Burrows-Wheeler
   transform of a batch of them. Sorting its suffixes by doubling gives the intervals of strings of 28 bytes;
   from there all intervals are extended backwards by one byte at a time, breadth first, so each level holds
   the strings of one length more. Intervals of one context end there, and the search ends at 50 bytes; an
   interval left is a string that contexts share, and its smallest id counts for each of them.
4. Removal. A chunk goes as a whole from all documents but the one with its smallest id. There goes what is covered by
   the windows of its contexts that a smaller id has as well; nothing else of step 3 is moved.

An anchor around which more contexts differ than one batch may hold has its windows grouped by their bytes in
Spark instead, which splits and pre-aggregates them; this is the exact way for frequent passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.scratch import Scratch

LENGTH, ANCHOR = 50, 24

#: Anchors of one block of a task, and anchors per hash range on average.
BLOCK_ANCHORS, RANGE_ANCHORS = 1 << 19, 500_000

#: Bytes of texts that are hashed together.
PIECE_BYTES = 1 << 18

#: Contexts of one transform, and the most that may differ around one anchor for it.
BATCH_CONTEXTS, MOST_CONTEXTS = 20_000, 20_000

#: Anchors of a chunk on average; a run without a boundary is cut at four times as many.
CHUNK_ANCHORS = 16

NO_ID = (1 << 63) - 1


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the anchor's bytes from each place on, eight at a time."""
    # Eight bytes from each place on, without a copy for each of the eight.
    eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (max(0, len(data) - 7),), (1,))
    n = len(data) - ANCHOR + 1
    x = np.zeros(n, dtype=np.uint64)
    moved = np.empty_like(x)
    for at in range(0, ANCHOR, 8):
        x ^= eight[at : at + n]
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= np.right_shift(x, np.uint64(29), out=moved)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(32), out=moved)
    return x


def _sliding(x: np.ndarray, width: int, step: np.ufunc) -> np.ndarray:
    """Smallest or largest of each ``width`` neighbours: of 2, 4, 8 ... of them, and of two such that overlap."""
    size = 1
    while 2 * size <= width:
        x = step(x[:-size], x[size:])
        size *= 2
    return step(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of some texts: the text's number, the place in it and the hash."""
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(joined) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, width = _hashes(joined), LENGTH - ANCHOR + 1
    lowest = _sliding(h, width, np.minimum)
    # No window runs over the end of a text.
    ends = np.cumsum([len(t) for t in texts])
    over = np.unique((ends[:, None] - np.arange(1, LENGTH)).ravel())
    lowest[over[(over >= 0) & (over < len(lowest))]] = 0
    # A place is an anchor if it is the lowest of some window around it.
    around = np.concatenate([np.zeros(width - 1, np.uint64), lowest, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_sliding(around, width, np.maximum) == h)
    number = np.searchsorted(ends, at, side="right")
    sizes = np.diff(ends, prepend=0)[number]
    place = at - (ends[number] - sizes)
    inside = (sizes >= LENGTH) & (place + ANCHOR <= sizes)
    # The lowest of some hashes are small; an odd factor spreads them, so that ranges get equal shares. What meets by
    # 40 bits is compared by its bytes later; the others would only be moved.
    spread = h[at[inside]] * np.uint64(0x9E3779B97F4A7C15) & np.uint64(0xFFFFFFFFFF000000)
    return number[inside], place[inside], spread


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text, and their hashes."""
    return _anchors([data])[1:]


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts (from, to) of about ``PIECE_BYTES`` in all."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= PIECE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _packed(x: np.ndarray) -> bytes:
    """Integers by planes of bytes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _blocks(ranges: int, ends: bool = False):
    """Anchors of a task's documents as blocks per hash range: differences of hashes, rows, places.

    With ``ends`` each hash is in a block once, and its smallest and largest rows stand for rows and places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            at, h, rows = (np.concatenate([x[i] for x in held]) for i in range(3))
            order = np.argsort(h, kind="stable")
            at, h, rows = at[order], h[order], rows[order]
            number = ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            bounds = np.flatnonzero(np.diff(number, prepend=-1, append=ranges))
            out = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                first, x, own, places = int(rows[lo:hi].min()), h[lo:hi], rows[lo:hi], at[lo:hi]
                if ends:
                    x, own, places = _ends(x, own, own)
                    places = places - first
                out.append(
                    (
                        int(number[lo]),
                        int(hi - lo),
                        first,
                        _packed(np.diff(x, prepend=np.uint64(0))),
                        _packed((own - first).astype(np.uint64)),
                        _packed(places.astype(np.uint64)),
                    )
                )
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            names = ["bucket", "n", "first_row", "hashes", "rows", "places"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            ids = batch.column("row_id").to_numpy()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for start, end in _pieces(texts):
                number, at, h = _anchors(texts[start:end])
                if len(at):
                    held.append((at, h, ids[start:end][number]))
                    size += len(at)
                if size >= BLOCK_ANCHORS:
                    yield batch_of()
                    held, size = [], 0
        if held:
            yield batch_of()

    return run


def _ends(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each of the sorted hashes once, the smallest and the largest row."""
    starts = np.flatnonzero(np.diff(h, prepend=~h[:1]))
    return h[starts], np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)


def _several(table: pa.Table) -> pa.Table:
    """Of one hash range: its number of anchors, and the hashes that several rows have.

    Blocks are added when they hold as many hashes as the sum so far, so what is held are some blocks and the
    distinct hashes of the range, and each hash is sorted a few times only.
    """
    held, size, n = [], 0, 0

    def added() -> list[tuple[np.ndarray, ...]]:
        x = [np.concatenate(c) for c in zip(*held, strict=True)]
        order = np.argsort(x[0], kind="stable")
        return [_ends(*(c[order] for c in x))]

    for i in range(table.num_rows):
        r = {c: table.column(c)[i].as_py() for c in table.column_names}
        n += r["n"]
        h = np.cumsum(_unpacked(r["hashes"]), dtype=np.uint64)
        held.append((h, *(_unpacked(r[c]).astype(np.int64) + r["first_row"] for c in ("rows", "places"))))
        size += len(h)
        if size >= max(RANGE_ANCHORS, 2 * len(held[0][0])):
            held = added()
            size = len(held[0][0])
    h, low, high = added()[0]
    found = _packed(np.diff(h[low != high], prepend=np.uint64(0)))
    bucket = table.column("bucket")[:1].combine_chunks()
    return pa.table({"bucket": bucket, "n": pa.array([n], pa.int64()), "shared": pa.array([found], pa.binary())})


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and places of shared anchors; ahead of the blocks of a range comes a row with its shared hashes."""
    shared = np.zeros(0, np.uint64)
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i].as_py() for c in ("shared", "first_row", "hashes", "rows", "places")}
            if r["shared"] is not None:
                shared = np.cumsum(_unpacked(r["shared"]), dtype=np.uint64)
                continue
            if not len(shared):
                continue
            h = np.cumsum(_unpacked(r["hashes"]), dtype=np.uint64)
            kept = shared[np.minimum(np.searchsorted(shared, h), len(shared) - 1)] == h
            rows = _unpacked(r["rows"])[kept].astype(np.int64) + r["first_row"]
            at = _unpacked(r["places"])[kept].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(at)], names=["row_id", "place"])


def _shared_anchors(texts: DataFrame, ranges: int, scratch: Scratch) -> DataFrame:
    """(row_id, place) of the anchors that several rows have; ``texts`` has row_id and text.

    No task holds all places of an anchor: a range is judged by one entry for each block and hash, and its
    blocks are then read one by one, by several tasks where the range is large.
    """
    kinds = "bucket int, n bigint, first_row bigint, hashes binary, rows binary, places binary"
    ends = texts.mapInArrow(_blocks(ranges, ends=True), kinds)
    several = scratch.write(
        ends.groupBy("bucket").applyInArrow(_several, "bucket int, n bigint, shared binary")
    ).withColumn("parts", (1 + F.floor(F.col("n") / (4 * RANGE_ANCHORS))).cast("int"))
    sent = several.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "shared"
    )
    blocks = (
        texts.mapInArrow(_blocks(ranges), kinds)
        .join(F.broadcast(several.where("parts > 1").select("bucket", "parts")), "bucket", "left")
        .withColumn("part", F.pmod(F.xxhash64("hashes", "rows", "places"), F.coalesce("parts", F.lit(1))).cast("int"))
        .drop("n", "parts")
    )
    return (
        blocks.unionByName(sent, allowMissingColumns=True)
        .repartition("bucket", "part")
        .sortWithinPartitions("bucket", "part", F.col("shared").isNull())
        .mapInArrow(_shared, "row_id bigint, place int")
    )


def _boundaries(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which anchors end a chunk by their content."""
    words = np.lib.stride_tricks.sliding_window_view(data, ANCHOR)[places].view("<u8")
    x = np.zeros(len(places), dtype=np.uint64)
    for i in range(words.shape[1]):
        x = (x ^ words[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    return x % np.uint64(CHUNK_ANCHORS) == 0


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of shared anchors with the bytes around them, cut behind every 16th anchor by content."""
    side = LENGTH - ANCHOR
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        number = np.repeat(np.arange(len(texts)), batch.column("places").value_lengths().to_numpy())
        joined = b"".join(texts)
        # Places count from the begin of the first text.
        places = np.sort(batch.column("places").flatten().to_numpy() + begins[number])
        number = np.searchsorted(begins[1:], places, side="right")
        ends = _boundaries(np.frombuffer(joined, dtype=np.uint8), places) if len(places) else np.zeros(0, bool)
        ends[:-1] |= (np.diff(places) > side + 1) | (np.diff(number) > 0)
        ends[-1:] = True
        # What is longer than four times the average is cut there.
        starts = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
        since = np.arange(len(places)) - np.repeat(starts, np.diff(starts, append=len(places)))
        ends |= since % (4 * CHUNK_ANCHORS) == 4 * CHUNK_ANCHORS - 1
        last = np.flatnonzero(ends)
        first = np.concatenate([[0], last[:-1] + 1])[: len(last)]
        low = np.maximum(begins[number[first]], places[first] - side)
        high = np.minimum(begins[number[last] + 1], places[last] + LENGTH)
        offsets = (places - np.repeat(low, last - first + 1)).astype(np.int32)
        inside, lists = offsets.tobytes(), np.append(first, len(places))
        chunks = [joined[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        of_chunk = zip(chunks, (4 * lists[:-1]).tolist(), (4 * lists[1:]).tolist(), strict=True)
        keys = [hashlib.md5(c + inside[a:b]).digest() for c, a, b in of_chunk]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.binary()),
                pa.array(chunks, pa.binary()),
                pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(offsets, pa.int32())),
                batch.column("row_id").take(pa.array(number[first])),
                batch.column("id").take(pa.array(number[first])),
                pa.array(low - begins[number[first]], pa.int32()),
            ],
            names=["chunk_key", "chunk", "offsets", "row_id", "id", "start"],
        )


def _contexts(chunks: DataFrame) -> DataFrame:
    """The bytes around each anchor of a chunk: where they begin, and a hash of the anchor to meet by."""
    side = LENGTH - ANCHOR
    at = F.greatest(F.col("offset") - side, F.lit(0))
    return chunks.select("chunk_id", "id", "chunk", F.explode("offsets").alias("offset")).select(
        F.xxhash64(F.substring(F.col("chunk"), F.col("offset") + 1, F.lit(ANCHOR))).alias("anchor"),
        "chunk_id",
        at.alias("at"),
        F.substring(F.col("chunk"), at + 1, F.col("offset") + LENGTH - at).alias("context"),
        "id",
    )


def suffix_array(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of all suffixes by their first ``length`` symbols (0 to 257) at least, by doubling.

    Also the rank of each suffix by its first symbols alone, and how many those are: fewer than ``length``,
    as many as the last step ahead of it knew.
    """
    n = len(text)
    # The symbols that occur, numbered in order; as many as 63 bits hold are compared at once.
    number = np.cumsum(np.bincount(text) > 0) - 1
    bits = max(1, int(number[-1]).bit_length())
    step = min(63 // bits, length - 1)
    shorter, known = np.zeros(n, dtype=np.int64), 0
    padded = np.append(number[text], np.zeros(step, dtype=np.int64))
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key = key << bits | padded[i : n + i]
    while True:
        order = np.argsort(key)
        if step >= length:
            return order, shorter, known
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
        shorter, known = rank, step
        # Three ranks fit into one key for short texts: fewer sorts then.
        times, width = (3, 21) if 2 * step < length and n + 1 < 1 << 21 else (2, 31)
        key = rank.copy()
        for ahead in range(step, times * step, step):
            key <<= width
            key[: max(0, n - ahead)] |= rank[ahead:] + 1
        step *= times


def common_strings(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where strings of ``length`` bytes lie that several of the contexts have: string, context, place.

    Places of one string stand next to each other and have its number.
    """
    # Bytes are 2 to 257, 1 ends a context, 0 ends the text: no string runs over an end.
    joined = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    sizes = np.array([len(c) for c in contexts])
    n = len(joined) + len(contexts) + 1
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    place = np.arange(n - 1) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    text = np.ones(n, dtype=np.int64)
    text[:-1][place < sizes[owner]] = joined.astype(np.int64) + 2
    text[-1] = 0
    order, shorter, known = suffix_array(text, length)
    before = text[order - 1].astype(np.uint16)  # the transform: the symbol ahead of each suffix
    # Where the suffix that begins one symbol earlier stands, also of suffixes that the order leaves tied.
    earlier = np.empty(n, dtype=np.int64)
    earlier[order] = np.arange(n)
    earlier = earlier[order - 1]
    of_row = np.append(owner, len(contexts))[order]
    # Rows of live intervals in order, and the number of the interval of each.
    left = np.zeros(n, dtype=np.int64)
    left[:-1] = sizes[owner] - place  # symbols up to the end of the context
    # Strings are extended to the front, so that much must lie ahead of them.
    left[:-1][place < length - known] = 0
    rows = np.flatnonzero(left[order] >= max(1, known))
    of_rows = shorter[order[rows]]
    interval = np.cumsum(np.diff(of_rows, prepend=of_rows[:1]) != 0)
    for _ in range(length - known):
        symbol = before[rows]
        inside = np.flatnonzero(symbol > 1)
        # Rows of one interval and symbol move to a new interval side by side.
        moved = inside[np.argsort(symbol[inside], kind="stable")]
        rows, old, symbol = earlier[rows[moved]], interval[moved], symbol[moved]
        if not len(rows):
            break
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (old[1:] != old[:-1]) | (symbol[1:] != symbol[:-1])
        starts = np.flatnonzero(new)
        # An interval of a single context has nothing in common with another.
        owners = of_row[rows]
        several = np.minimum.reduceat(owners, starts) != np.maximum.reduceat(owners, starts)
        interval = np.cumsum(new) - 1
        live = several[interval]
        rows, interval = rows[live], interval[live]
    places = order[rows]
    return interval, owner[places], place[places]


#: Bytes ``a`` to ``b`` of a chunk, covered by windows that a smaller id than that of the chunk has as well.
RUNS = "chunk_id bigint, a int, b int"


def _smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is covered by windows of contexts, sorted by anchors, that a smaller id than theirs has as well."""

    def solved(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        chunk, at, ids, anchor = (table.column(c).to_numpy() for c in ("chunk_id", "at", "id", "anchor"))
        # Equal contexts are one, with the smallest id.
        encoded = table.column("context").combine_chunks().dictionary_encode()
        texts = encoded.dictionary
        group = np.cumsum(np.diff(anchor, prepend=anchor[:1]) != 0)
        pairs, which = np.unique(group * len(texts) + encoded.indices.to_numpy(), return_inverse=True)
        least = np.full(len(pairs), NO_ID, dtype=np.int64)
        np.minimum.at(least, which, ids)
        text_of = pairs % len(texts)
        windows = pc.binary_length(texts).to_numpy()[text_of] - LENGTH + 1
        lowest = np.repeat(least[:, None], LENGTH - ANCHOR + 1, axis=1)
        # Contexts alone around their anchor share no window with another.
        several = np.flatnonzero(np.bincount(pairs // len(texts))[pairs // len(texts)] > 1)
        if len(several):
            string, owners, places = common_strings(texts.take(pa.array(text_of[several])).to_pylist(), LENGTH)
            if len(string):
                starts = np.flatnonzero(np.diff(string, prepend=-1))
                of_string = np.minimum.reduceat(least[several][owners], starts)
                found = np.repeat(of_string, np.diff(starts, append=len(string)))
                lowest[several[owners], places] = np.minimum(least[several[owners]], found)
        # Runs of such windows: where they begin and where they end.
        rows = np.flatnonzero(lowest.min(axis=1)[which] < ids)
        smaller = np.zeros((len(rows), LENGTH - ANCHOR + 3), dtype=np.int8)
        smaller[:, 1:-1] = lowest[which[rows]] < ids[rows, None]
        smaller[:, 1:-1] &= np.arange(LENGTH - ANCHOR + 1) < windows[which[rows]][:, None]
        change = np.diff(smaller, axis=1)
        row, low = np.nonzero(change == 1)
        row, high = rows[row], np.nonzero(change == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunk[row], pa.int64()),
                pa.array(at[row] + low, pa.int32()),
                pa.array(at[row] + high + LENGTH, pa.int32()),
            ],
            names=["chunk_id", "a", "b"],
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        # Contexts of an anchor stay together: a batch is cut where the last anchor begins.
        cut = int(np.searchsorted(anchor, anchor[-1]))
        if held and (cut or held[-1].column("anchor")[-1].as_py() != anchor[0]) and size + cut >= BATCH_CONTEXTS:
            yield solved([*held, batch.slice(0, cut)])
            held, size, batch = [], 0, batch.slice(cut)
        held.append(batch)
        size += batch.num_rows
    if held:
        yield solved(held)


def _windows(context: str) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.octet_length(context) - LENGTH + 1),
        lambda i: F.substring(F.col(context), i, F.lit(LENGTH)),
    )


def _smaller_of_frequent(contexts: DataFrame) -> DataFrame:
    """What ``_smaller`` gives, by grouping the windows."""
    windows = contexts.select("chunk_id", "id", "at", F.posexplode(_windows("context")).alias("low", "window"))
    least = windows.groupBy("window").agg(F.min("id").alias("least"))
    a = F.col("at") + F.col("low")
    found = windows.join(least, "window").where("least < id")
    return found.select("chunk_id", a.alias("a"), (a + LENGTH).alias("b"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the spans from each text and gives their union."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        counts = batch.column("spans").value_lengths().to_numpy()
        spans = batch.column("spans").flatten()
        # Texts lie one behind the other, with a gap: a span joins those before it that reach its begin.
        far = np.int64(1 << 32) * np.repeat(np.arange(len(texts)), counts)
        a, b = (spans.field(c).to_numpy().astype(np.int64) + far for c in ("a", "b"))
        order = np.argsort(a)
        a, b = a[order], np.maximum.accumulate(b[order])
        first = np.flatnonzero(np.concatenate([a[:1] == a[:1], a[1:] > b[:-1]]))
        lows, highs = a[first], b[np.append(first[1:], len(a)) - 1] if len(a) else a
        number = lows >> 32
        lows, highs = lows & 0xFFFFFFFF, highs & 0xFFFFFFFF
        bounds = np.searchsorted(number, np.arange(len(texts) + 1)).tolist()
        begins, ends = lows.tolist(), highs.tolist()
        kept, removed = [], []
        for i, text in enumerate(texts):
            parts, end = [], 0
            for k in range(bounds[i], bounds[i + 1]):
                parts.append(text[end : begins[k]])
                end = ends[k]
            parts.append(text[end:])
            kept.append(b"".join(parts))
            removed.append(len(text) - len(kept[-1]))
        pairs = pa.array(np.stack([lows, highs], axis=1).ravel(), pa.int64())
        inner = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pairs) + 1, 2), pa.int32()), pairs)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_id"),
                pa.array(removed, pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), inner),
                pa.array(kept, pa.binary()),
            ],
            names=["row_id", "n_removed", "spans", "kept"],
        )


def drop_shared_strings(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans, kept.

    A byte is removed if a 50-byte string that covers it also starts in a document with a smaller id,
    judged on the input texts as UTF-8. ``spans`` are the maximal removed runs as [start, end); ``kept`` is
    null where nothing is removed (the text is kept), else the remaining bytes. A null text counts as empty.
    A null id is larger than all others; rows with the same id are not smaller than each other, so repeated
    rows keep their bytes. Ids are integers; other columns are ignored, whatever their names. An empty table
    gives no rows. ``row_column`` is as in ``Scratch.numbered``.
    """
    scratch = Scratch(docs.sparkSession)
    taken = docs.select(
        *([F.col(row_column).alias("row")] if row_column else []),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    rows = scratch.numbered(taken, "row_id", "row" if row_column else None)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About 2 anchors per window's width of places.
    ranges = 1 + int(total * 2 / (LENGTH - ANCHOR + 2) / RANGE_ANCHORS)
    shared = scratch.write(_shared_anchors(rows.select("row_id", "text"), ranges, scratch))
    places = shared.groupBy("row_id").agg(F.collect_list("place").alias("places"))
    # Texts move once: they are kept in buckets by row, which the last join finds in place.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = scratch.write_buckets(
        rows.repartition(n, "row_id").join(places, "row_id").select("row_id", "id", "text", "places"),
        "row_id",
        n,
    )
    scratch.drop(shared)
    whole = scratch.write(
        marked.mapInArrow(
            _chunks,
            "chunk_key binary, chunk binary, offsets array<int>, row_id bigint, id bigint, start int",
        )
    )
    # Read from files, chunks are numbered alike each time.
    distinct = scratch.write(whole.groupBy("chunk_key", "chunk", "offsets").agg(F.min("id").alias("id")))
    end = F.col("start") + F.octet_length("chunk")
    found = scratch.write(whole.select("chunk_key", "row_id", "id", "start", end.alias("end")))
    scratch.drop(whole)
    chunks = distinct.withColumn("chunk_id", F.monotonically_increasing_id())
    contexts = _contexts(chunks)
    sizes = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    many = scratch.write(sizes.where(F.col("n") > MOST_CONTEXTS).select("anchor"))
    runs = (
        contexts.join(many, "anchor", "left_anti")
        .select("anchor", "chunk_id", "at", "context", "id")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_smaller, RUNS)
        .unionByName(_smaller_of_frequent(contexts.join(many, "anchor")))
    )
    covers = runs.groupBy("chunk_id").agg(F.collect_list(F.struct("a", "b")).alias("covers"))
    of_chunk = scratch.write(
        chunks.select("chunk_id", "chunk_key", F.col("id").alias("least"))
        .join(covers, "chunk_id", "left")
        .drop("chunk_id")
    )
    scratch.drop(distinct)
    # The document with the smallest id has the chunk first: there only what a smaller id has goes, elsewhere all.
    moved = F.transform(
        "covers",
        lambda c: F.struct((F.col("start") + c["a"]).alias("a"), (F.col("start") + c["b"]).alias("b")),
    )
    all_of_it = F.array(F.struct(F.col("start").alias("a"), F.col("end").alias("b")))
    starts = (
        found.join(of_chunk, "chunk_key")
        .select("row_id", F.when(F.col("least") < F.col("id"), all_of_it).otherwise(moved).alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy("row_id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    cut = scratch.write(
        marked.select("row_id", "text")
        .join(starts, "row_id")
        .mapInArrow(_cut, "row_id bigint, n_removed bigint, spans array<array<bigint>>, kept binary")
    )
    scratch.drop(found, of_chunk)
    return (
        rows.select(
            "row_id",
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2("text", 256).alias("text_sha256"),
        )
        .join(cut, "row_id", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
            "spans",
            "kept",
            F.when(F.col("kept").isNull(), F.col("text_sha256"))
            .otherwise(F.sha2("kept", 256))
            .alias("kept_sha256"),
        )
    )
