"""Near duplicates by SimHash, found through an inverted index on bytes and their positions.

A fingerprint has eight bytes. Two that differ in at most three bits differ in at most three bytes, so
they share at least five bytes in place. The index has an entry for each choice of five positions and the
bytes there; fingerprints that meet in one entry have reached the guaranteed count of shared bytes, and
their differing bits are counted. Equal fingerprints are one entry.

Rows of one entry differ in three bytes only, so there are at most 2^24 of them, however large the
corpus is. Of the links inside an entry only as many are returned as connect its groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.components import components
from layerloom.llm.scratch import Scratch

BITS, BYTES, MAX_BITS, WORDS, SEED = 64, 8, 3, 3, 42

#: Shingles whose bits are counted at a time.
SHINGLE_BLOCK = 1 << 16

#: Entries up to this size compare each pair; larger ones look their neighbours up.
PAIRS_UP_TO = 1500


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash over word shingles of the text with A-Z in lower case; 0 without words."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    shifted = [parts[i:] for i in range(words)]
    shingles = list(map(b" ".join, zip(*shifted, strict=False))) or [b" ".join(parts)]
    counts, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for at in range(0, len(shingles), SHINGLE_BLOCK):
        hashes = b"".join([digest(s, SEED) for s in shingles[at : at + SHINGLE_BLOCK]])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, BYTES), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame,
    words: int = WORDS,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
) -> DataFrame:
    """row_id, doc_id and fp of each row; a null text counts as empty and has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(found, pa.int64())],
                names=["row_id", "doc_id", "fp"],
            )

    rows = docs.select(
        (F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("row_id"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id bigint, doc_id {kind}, fp bigint")


def _masks(max_bits: int) -> list[int]:
    """A mask over each choice of as many bytes as fingerprints within ``max_bits`` share."""
    chosen = combinations(range(BYTES), BYTES - max_bits)
    masks = (sum(0xFF << 8 * i for i in c) for c in chosen)
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Of links between the numbers below n, as many as connect the same groups."""
    parent, kept = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[q] = p
            kept.append((x, y))
    return kept


def _flips(mask: int, max_bits: int) -> np.ndarray:
    """All changes of up to ``max_bits`` bits outside a mask."""
    free = [np.uint64(1 << i) for i in range(BITS) if not (mask >> i) & 1]
    return np.array(
        [np.bitwise_or.reduce(c) for k in range(1, max_bits + 1) for c in combinations(free, k)],
        dtype=np.uint64,
    )


def _links_within(fps: np.ndarray, mask: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect the distinct, sorted fingerprints of one entry within ``max_bits``."""
    n = len(fps)
    if n <= PAIRS_UP_TO:
        bits = np.bitwise_count(fps[:, None] ^ fps[None, :])
        a, b = np.nonzero(np.triu(bits <= max_bits, 1))
        return _forest(a, b, n)
    kept, numbers = [], np.arange(n)
    group = numbers.copy()
    for flip in _flips(mask, max_bits):
        near = fps ^ flip
        at = np.minimum(np.searchsorted(fps, near), n - 1)
        hit = (fps[at] == near) & (numbers < at) & (group != group[at])
        if hit.any():
            found = _forest(group[numbers[hit]], group[at[hit]], n)
            kept += found
            # Groups joined by these links take one number.
            to = numbers.copy()
            for x, y in found:
                to[max(x, y)] = min(x, y)
            while (to != to[to]).any():
                to = to[to]
            group = to[group]
    return kept


def _entries(masks: list[int], max_bits: int):
    """Links inside each entry of a partition sorted by entry and fingerprint."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        held: list[np.ndarray] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            choice, shared, fp = (batch.column(c).to_numpy() for c in ("choice", "shared", "fp"))
            starts = np.flatnonzero((np.diff(shared) != 0) | (np.diff(choice) != 0)) + 1
            bounds = np.concatenate([[0], starts, [len(fp)]])
            # Entries of one row need nothing, but the first and last may go on in other batches.
            many = np.flatnonzero(np.diff(bounds) > 1)
            for i in sorted({0, len(bounds) - 2, *many.tolist()}):
                lo, hi = bounds[i], bounds[i + 1]
                key = int(choice[lo]), int(shared[lo])
                if key != last:
                    if last is not None and sum(map(len, held)) > 1:
                        yield last[0], np.concatenate(held)
                    held, last = [], key
                held.append(fp[lo:hi])
        if last is not None and sum(map(len, held)) > 1:
            yield last[0], np.concatenate(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )
        for choice, fps in runs(batches):
            fps = np.sort(fps.astype(np.uint64))
            signed = fps.astype(np.int64)
            mask = masks[choice] & ((1 << BITS) - 1)
            for x, y in _links_within(fps, mask, max_bits):
                found.add((int(signed[x]), int(signed[y])))
            if len(found) > 100_000:
                yield batch()
                found.clear()
        yield batch()

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``max_bits`` bits."""
    masks = _masks(max_bits)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])
    entries = fps.select("fp", F.explode(choices).alias("c")).select(
        F.col("c.choice").alias("choice"),
        F.col("fp").bitwiseAND(F.col("c.mask")).alias("shared"),
        "fp",
    )
    return (
        entries.repartition("choice", "shared")
        .sortWithinPartitions("choice", "shared")
        .mapInArrow(_entries(masks, max_bits), "a bigint, b bigint")
    )


def _grouped(
    docs: DataFrame, scratch: Scratch, words: int, max_bits: int, **columns
) -> tuple[DataFrame, DataFrame]:
    """(row_id, doc_id, fp) of each row, and (fp, root, n_same, component_id) of each fingerprint."""
    rows = scratch.write(fingerprints(docs, words, **columns))
    distinct = scratch.write(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_same"))
    )
    roots = scratch.write(components(links(distinct.select("fp"), max_bits), scratch))
    rooted = scratch.write(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "root", F.coalesce("root", "fp")
        )
    )
    lowest = scratch.write(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return rows, scratch.write(rooted.join(lowest, "root"))


def near_duplicates(
    docs: DataFrame, *, words: int = WORDS, max_bits: int = MAX_BITS, **columns
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (hex), component_id, n_same.

    Fingerprints are linked when they differ in at most ``max_bits`` bits; ``component_id`` is the smallest id
    reachable over links, and null only if no other is. ``n_same`` counts the rows of the same fingerprint. A
    null text counts as empty; texts without words share fingerprint 0. Repeated rows are rows of their
    own. ``columns``: id_column and text_column; others are ignored, whatever their names. An empty table
    gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    rows, groups = _grouped(docs, scratch, words, max_bits, **columns)
    return rows.join(groups, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "n_same",
    )


def drop_near_duplicates(
    docs: DataFrame,
    *,
    words: int = WORDS,
    max_bits: int = MAX_BITS,
    row_column: str | None = None,
    **columns,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component that of the smallest id.

    A null id comes last; of rows with the same id the first by ``row_column`` stays (see
    ``Scratch.numbered``).
    """
    scratch, number = Scratch(docs.sparkSession), "_row_of_simhash"
    numbered = scratch.numbered(docs, number, row_column)
    rows, groups = _grouped(numbered, scratch, words, max_bits, row_column=number, **columns)
    rooted = scratch.write(rows.join(groups.select("fp", "root"), "fp"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), "row_id")
    stays = scratch.write(rooted.groupBy("root").agg(F.min(order)["row_id"].alias("stays")))
    gone = scratch.write(
        rooted.join(stays, "root").where("row_id != stays").select(F.col("row_id").alias(number))
    )
    return numbered.join(gone, number, "left_anti").select(*docs.columns)
