"""Ranked lexical search: the best documents for each item, found in tries of restricted term vectors.

Only terms of the items count, so a document is cut down to them: its restricted vector. Vectors of a block of
documents form a trie in the order of document frequency, most frequent first, so that documents of alike
vocabulary share paths. A node knows for each term below it the largest frequency, and the smallest length
measure ``m`` of its documents. A score grows with the first and falls with the second, so both together bound
every score below the node. Each item walks the trie depth first, best bound first, and leaves out nodes whose
bound cannot enter its list of best documents; the list goes on from block to block within a task.

Items are taken in blocks of a bounded number of bytes, each a pass over the documents; counts of terms and
documents cover all of them. A task sends its best documents of each item, never its vectors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.llm.scratch import Scratch

#: Documents listed for each item.
TOP = 50

#: Bytes of item texts that are searched for in one pass; their terms are held by every task.
ITEM_BYTES = 4 << 20

#: Documents, and entries of restricted vectors, of one trie.
TRIE_DOCS, TRIE_ENTRIES = 16384, 1_500_000

#: Documents up to which a branch is not split further, and levels of branches.
LEAF, LEVELS = 256, 64

#: Partial lists of an item that are merged first, before those of all tasks.
FIRST_MERGE = 64

#: A term is a longest run of these characters, with A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b if b > 127 else ord(chr(b).lower()) if re.fullmatch(TERM, chr(b)) else ord(" ") for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in UTF-8, in order and with repeats."""
    return text.encode().translate(_FOLD).split()


def _vectors(number: dict[bytes, int]):
    """Document id, count of all terms, and numbers and frequencies of those that items have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ends, terms, counts = [], [0], [], []
            for text in batch.column("text"):
                found = Counter(terms_of(text.as_py()))
                shared = found.keys() & number.keys()
                lengths.append(found.total())
                terms += [number[t] for t in shared]
                counts += [found[t] for t in shared]
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
            )

    return run


class _Branch:
    """A node of a trie with what its children (in a leaf, its documents) hold, sorted by term."""

    def __init__(self, trie: _Trie, lo: int, hi: int, depth: int, level: int):
        self.trie, self.lo, self.level, self.children = trie, lo, level, {}
        self.parts, self.depth = trie.split(lo, hi, depth, level)
        self.is_leaf = self.parts is None
        starts = np.arange(lo, hi) if self.is_leaf else self.parts[:-1]
        first = trie.ends[lo]
        unit = np.searchsorted(starts, trie.owner[first : trie.ends[hi]], side="right") - 1
        terms, counts = trie.terms[first : trie.ends[hi]], trie.counts[first : trie.ends[hi]]
        m = np.minimum.reduceat(trie.m[lo:hi], starts - lo)
        self.least_id = np.minimum.reduceat(trie.keys[lo:hi], starts - lo)
        if not len(terms):
            self.terms, self.unit, self.gain = terms, unit, np.zeros(0, np.int64)
            return
        order = np.lexsort((unit, terms))
        terms, unit, counts = terms[order], unit[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(terms) != 0) | (np.diff(unit) != 0)]))
        self.terms, self.unit = terms[heads], unit[heads]
        most = np.maximum.reduceat(counts, heads).astype(np.int64)
        self.gain = trie.weights[self.terms] * (1_000_000_000 * most // (1000 * most + 20 * m[self.unit]))

    def sums(self, wanted: np.ndarray) -> np.ndarray:
        """For each child a bound of the scores below it; for each document of a leaf its score."""
        total = np.zeros(len(self.least_id), dtype=np.int64)
        lo, hi = np.searchsorted(self.terms, wanted, "left"), np.searchsorted(self.terms, wanted, "right")
        sizes = hi - lo
        if sizes.any():
            at = np.arange(sizes.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            np.add.at(total, self.unit[at], self.gain[at])
        return total

    def child(self, i: int) -> _Branch:
        if i not in self.children:
            self.children[i] = _Branch(self.trie, self.parts[i], self.parts[i + 1], self.depth, self.level + 1)
        return self.children[i]


class _Trie:
    """Restricted vectors of a block of documents, sorted along their paths."""

    def __init__(self, keys, nulls, m, ends, terms, counts, place, weights):
        n, sizes = len(keys), np.diff(ends)
        owner = np.repeat(np.arange(n), sizes)
        order = np.lexsort((place[terms], owner))
        path, terms, counts = place[terms][order], terms[order], counts[order]
        big = path.astype(">u4").tobytes()
        names = [big[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        keyed = keys.tolist()
        docs = np.array(sorted(range(n), key=lambda i: (names[i], nulls[i], keyed[i])), dtype=np.int64)
        self.names = [names[i] for i in docs.tolist()]
        self.keys, self.nulls, self.m = keys[docs], nulls[docs], m[docs]
        self.ends = np.concatenate([[0], np.cumsum(sizes[docs])])
        entries = np.arange(self.ends[-1]) + np.repeat(ends[:-1][docs] - self.ends[:-1], sizes[docs])
        self.path, self.terms, self.counts = path[entries], terms[entries], counts[entries]
        self.owner = np.repeat(np.arange(n), sizes[docs])
        self.weights = weights
        self.root = _Branch(self, 0, n, 0, 0)

    def split(self, lo: int, hi: int, depth: int, level: int) -> tuple[np.ndarray | None, int]:
        """Limits of the children of a node, and the depth of their paths; None for a leaf."""
        first, last = self.names[lo], self.names[hi - 1]
        if hi - lo <= LEAF or level >= LEVELS or first == last:
            return None, depth
        # Sorted paths share what the first and the last of them share: a chain is one step.
        while len(first) > 4 * depth and first[4 * depth : 4 * depth + 4] == last[4 * depth : 4 * depth + 4]:
            depth += 1
        at = self.ends[lo:hi] + depth
        ended = at >= self.ends[lo + 1 : hi + 1]
        term = np.where(ended, -1, self.path[np.minimum(at, max(len(self.path) - 1, 0))].astype(np.int64))
        limits = lo + np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1, [hi - lo]])
        return limits, depth + 1


class _Best:
    """The best documents found for one item."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.keys, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def may_enter(self, score: int, least_id: int) -> bool:
        if score <= 0 or len(self.scores) < self.top:
            return score > 0
        return score > self.scores[-1] or score == self.scores[-1] and least_id <= self.keys[-1]

    def offer(self, scores: np.ndarray, keys: np.ndarray, nulls: np.ndarray) -> None:
        least = self.scores[-1] if len(self.scores) == self.top else 1
        use = scores >= max(least, 1)
        if not use.any():
            return
        pairs = (self.scores, scores), (self.keys, keys), (self.nulls, nulls)
        scores, keys, nulls = (np.concatenate([held, new[use]]) for held, new in pairs)
        order = np.lexsort((keys, nulls, -scores))[: self.top]
        self.scores, self.keys, self.nulls = scores[order], keys[order], nulls[order]


def _walk(branch: _Branch, wanted: np.ndarray, best: _Best) -> None:
    """Depth first below a node, the child of the highest bound first."""
    sums = branch.sums(wanted)
    if branch.is_leaf:
        part = slice(branch.lo, branch.lo + len(sums))
        best.offer(sums, branch.trie.keys[part], branch.trie.nulls[part])
        return
    for i in np.argsort(-sums, kind="stable").tolist():
        if best.may_enter(sums[i], branch.least_id[i]):
            _walk(branch.child(i), wanted, best)


def _searches(items: dict[int, np.ndarray], weights: np.ndarray, place: np.ndarray, n_docs: int, n_terms: int, top: int):
    """The best documents of each item among those of a task."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, docs, entries = [], 0, 0
        for batch in batches:
            held.append(batch)
            docs, entries = docs + batch.num_rows, entries + len(batch.column("terms").flatten())
            if docs >= TRIE_DOCS or entries >= TRIE_ENTRIES:
                yield held
                held, docs, entries = [], 0, 0
        if docs:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {row: _Best(top) for row in items}
        for block in blocks(batches):
            table = pa.Table.from_batches(block).combine_chunks()
            column = lambda name: table.column(name).combine_chunks()
            nulls = np.asarray(column("doc_id").is_null().to_numpy(zero_copy_only=False))
            keys = column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            lists = column("terms")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            m = 50 + 50 * column("n").to_numpy() * n_docs // n_terms
            trie = _Trie(
                keys, nulls, m, ends, lists.flatten().to_numpy(), column("counts").flatten().to_numpy(), place, weights
            )
            for row, wanted in items.items():
                _walk(trie.root, wanted, best[row])
        for row, found in best.items():
            if len(found.scores):
                ids = pa.array(found.keys, pa.int64(), mask=found.nulls)
                rows = pa.array(np.full(len(found.scores), row), pa.int64())
                yield pa.RecordBatch.from_arrays([rows, ids, pa.array(found.scores)], names=["item", "doc_id", "score"])

    return run


def _found(docs: DataFrame, texts: dict[int, str], top: int, scratch: Scratch) -> DataFrame | None:
    """(item, doc_id, score) of the best documents of each item of one block, by task."""
    wanted = {row: sorted(set(terms_of(text))) for row, text in texts.items()}
    number = {t: i for i, t in enumerate(sorted({t for terms in wanted.values() for t in terms}))}
    vectors = scratch.write(
        docs.mapInArrow(_vectors(number), "doc_id bigint, n bigint, terms array<int>, counts array<int>").where("n > 0")
    )
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not number:
        return None
    df = np.zeros(len(number), dtype=np.int64)
    held = vectors.select(F.explode("terms").alias("t")).groupBy("t").count()
    for row in held.toLocalIterator():
        df[row["t"]] = row["count"]
    rarity = ((2 * n_docs + 2) / (2 * x + 1) for x in df.tolist())
    weights = np.array([math.floor(1000 * math.log(x)) for x in rarity], dtype=np.int64)
    place = np.empty(len(number), dtype=np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(len(number))
    items = {row: np.array([number[t] for t in terms], dtype=np.int32) for row, terms in wanted.items()}
    return vectors.select("doc_id", "n", "terms", "counts").mapInArrow(
        _searches(items, weights, place, n_docs, n_terms, top), "item bigint, doc_id bigint, score bigint"
    )


def _leading(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The ``top`` documents of highest score above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. With N
    documents that have a term, L their terms, n those of one document, df documents that hold a term and tf its
    occurrences, a term weighs ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document measures
    ``m = 50 + 50 n N div L``, and a score sums ``w * (10^9 tf div (1000 tf + 20 m))`` over the different terms of the
    item, in integers. Equal scores rank by ascending id, nulls last.

    Texts are whole, of any length; a null text has no terms, and documents or items without terms occur in no
    result. Repeated documents rank one after the other; a repeated item id has a list for each of its rows. Ids
    of documents are integers. Other columns of either table are ignored, whatever their names. Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    chosen = items.select(
        F.col(item_id_column).alias("item_id"), F.coalesce(F.col(item_text_column), F.lit("")).alias("text")
    )
    numbered = scratch.numbered(chosen, "item", None)
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = math.ceil(size / item_bytes) or 1
    read = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    found = []
    for block in range(n_blocks):
        rows = numbered.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).select("item", "text")
        found.append(_found(read, {row.item: row.text for row in rows.toLocalIterator()}, top, scratch))
    found = [f.withColumn("_part", F.spark_partition_id() % FIRST_MERGE) for f in found if f is not None]
    if not found:
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("rank", "int"), ("doc_id", "bigint"), ("score", "bigint"))]
        return chosen.where(F.lit(False)).select("item_id", *none)
    # A task's lists stand in files before they are sorted, so that no search runs twice.
    lists = scratch.write(reduce(DataFrame.unionByName, found))
    ranked = _leading(_leading(lists, ["item", "_part"], top).drop("rank"), ["item"], top)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
