"""Language identification with bit-sliced Bloom filters of n-grams.

One filter of each language, all of the same size and hashes, lie side by side: place i of the table holds bit
i of every language's filter. So looking up an n-gram reads a few places and combines them to a mask with
one bit per language that may contain it. For a text, the bits are counted per language, the false positives
that a filter of its fill gives are taken out, and the language with most n-grams left decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.scratch import Scratch

NGRAM = 4

#: An n-gram belongs to a language if it makes up at least this share of the language's n-grams. So no
#: language has more than 1 / MIN_RATE of them, however large the corpus is.
MIN_RATE = 1e-5

HASHES, BITS_PER_NGRAM = 4, 10

#: Different n-grams that a task holds before it passes their counts on.
HELD_NGRAMS = 2_000_000

UNKNOWN = "und"


class _Letters:
    """Code points of a text in lower case: letters as they are, each run of anything else as one 0."""

    def __init__(self):
        self.low = np.array([chr(i).isalpha() for i in range(0x10000)])

    def __call__(self, text: str) -> np.ndarray:
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype="<u4")
        letters = self.low[np.minimum(points, 0xFFFF)]
        high = np.flatnonzero(points > 0xFFFF)
        if len(high):
            letters = letters.copy()
            letters[high] = [chr(p).isalpha() for p in points[high].tolist()]
        kept = letters.copy()
        kept[1:] |= letters[:-1]
        kept[0] = True
        return np.where(letters, points, 0)[kept]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _ngrams(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number for each n-gram; a text of a few letters is one n-gram."""
    if len(points) < n:
        points = np.concatenate([points, np.zeros(n - len(points), dtype=points.dtype)])
    points = points.astype(np.uint64)
    found = points[: len(points) - n + 1]
    for i in range(1, n):
        found = found * np.uint64(0x1000003) + points[i : len(points) - n + 1 + i]
    return _mixed(found)


def _counted(n: int):
    """Counts of the n-grams of each language, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

        def summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
            grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)

        def batch_of(lang: str, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(grams), pa.string()),
                    pa.array(grams.astype(np.int64)),
                    pa.array(counts),
                ],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            texts = defaultdict(list)
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                points = letters(text.as_py())
                if points.any():
                    texts[lang.as_py()].append(_ngrams(points, n))
            for lang, parts in texts.items():
                grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                held[lang].append((grams, counts))
                if len(held[lang]) > 8:
                    held[lang] = [summed(held[lang])]
            if sum(len(g) for parts in held.values() for g, _ in parts) > HELD_NGRAMS:
                for lang, parts in held.items():
                    yield batch_of(lang, *summed(parts))
                held.clear()
        for lang, parts in held.items():
            yield batch_of(lang, *summed(parts))

    return run


class LanguageFilters:
    """The table of filters: ``slices[i]`` has bit l set if bit i of language l's filter is set."""

    def __init__(self, langs: list[str], members: list[np.ndarray], hashes: int = HASHES):
        self.langs, self.hashes = langs, hashes
        most = max(map(len, members), default=0)
        self.bits = max(10, int(most * BITS_PER_NGRAM).bit_length())
        words = max(1, -(-len(langs) // 64))
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if words > 1 or len(langs) <= np.iinfo(t).bits)
        self.slices = np.zeros((words, 1 << self.bits), dtype=np.uint64 if words > 1 else kind)
        for i, grams in enumerate(members):
            row, bit = divmod(i, 64)
            for at in self._places(grams):
                self.slices[row][at] |= self.slices.dtype.type(1 << bit)
        # A filter with a share f of its bits set takes a foreign n-gram for its own with chance f^hashes.
        self.chance = np.array([self._fill(i) ** hashes for i in range(len(langs))])

    def _fill(self, i: int) -> float:
        row, bit = divmod(i, 64)
        return float(((self.slices[row] >> self.slices.dtype.type(bit)) & 1).mean())

    def _places(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        step = _mixed(grams) | np.uint64(1)
        for k in range(self.hashes):
            yield (grams + np.uint64(k) * step) >> np.uint64(64 - self.bits)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that may contain it, one bit per language."""
        found = None
        for at in self._places(grams):
            found = self.slices[:, at] if found is None else found & self.slices[:, at]
        return found

    def shares(self, grams: np.ndarray) -> np.ndarray:
        """Share of the n-grams that each language contains, without the expected false positives."""
        masks = self.masks(grams)
        hits = np.array(
            [
                np.count_nonzero(masks[i // 64] & masks.dtype.type(1 << i % 64))
                for i in range(len(self.langs))
            ]
        )
        return np.clip((hits / len(grams) - self.chance) / (1 - self.chance + 1e-12), 0, 1)


def train(
    docs: DataFrame,
    *,
    taught: Column | None = None,
    lang_column: str = "lang",
    text_column: str = "text",
    ngram: int = NGRAM,
    min_rate: float = MIN_RATE,
) -> LanguageFilters:
    """Filters from all texts with a language whose rows fulfil ``taught``; others teach nothing.

    Languages come in falling order of their n-grams, so that ties go to the more frequent one.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.where(F.lit(True) if taught is None else taught).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    )
    counted = scratch.write(
        rows.where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(_counted(ngram), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    order = [r["lang"] for r in totals.orderBy(F.desc("total"), "lang").collect()]
    kept = (
        counted.join(F.broadcast(totals), "lang")  # one row per language
        .where(F.col("n") >= F.col("total") * min_rate)
        .select("lang", "gram")
        .toArrow()
    )
    scratch.drop(counted)
    langs, grams = kept.column("lang").to_numpy(), kept.column("gram").to_numpy().astype(np.uint64)
    return LanguageFilters(order, [grams[langs == lang] for lang in order])


def identify(
    docs: DataFrame,
    filters: LanguageFilters,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    ngram: int = NGRAM,
) -> DataFrame:
    """doc_id, lang_pred, score (corrected share of n-grams in that language) and n_ngrams of each row.

    A null text or one without letters is ``und`` with score 0; a text none of whose n-grams is known gets the
    most frequent language with score 0. Ids may be null or repeat; other columns are ignored, whatever
    their names. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _Letters()
        for batch in batches:
            found = []
            for text in batch.column("text"):
                points = letters(text.as_py())
                if not filters.langs or not points.any():
                    found.append((UNKNOWN, 0.0, 0))
                    continue
                grams = _ngrams(points, ngram)
                shares = filters.shares(grams)
                best = int(shares.argmax())
                found.append((filters.langs[best], float(shares[best]), len(grams)))
            columns = list(zip(*found, strict=True)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.int64()),
                ],
                names=["doc_id", "lang_pred", "score", "n_ngrams"],
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_ngrams bigint")
