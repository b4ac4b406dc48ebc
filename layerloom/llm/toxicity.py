"""Toxicity of texts after noisy-channel decoding of disguised words.

A character model is counted over the whole corpus. Words with look-alike signs, separated or repeated
letters are decoded by it (``character_model``), and the restored text is scored: each word or word
beginning that labelled toxic texts share is evidence, and a text is toxic unless all its evidence is
chance.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_pairs import PieceTable
from layerloom.llm.character_model import Decoder, count_characters
from layerloom.llm.scratch import Scratch, free_name

#: Of the texts that have a feature, drawn to the overall share as by ``PRIOR_TEXTS`` texts more, at least this share must be
#: toxic for it to be evidence, whatever the size of the corpus.
MIN_CHANCE = 0.6

#: Features up to which they are sent to all tasks; beyond, texts and features meet in a join.
SENT_FEATURES = 200_000

#: Chance of a text without evidence.
REST = 0.01

#: Texts of the overall share of toxic ones that each piece of evidence starts from.
PRIOR_TEXTS = 5

#: Word beginnings that count beside whole words.
BEGINNINGS = (4, 5, 6)

#: Parts of the rows with the same feature in that join: common words are in nearly all texts.
SALTS = 32

#: Different features that a task holds before it passes their counts on.
HELD_FEATURES = 500_000


class _Reader:
    """Features of restored texts."""

    def __init__(self, counts: np.ndarray):
        self.decoder = Decoder(counts)
        self.words = PieceTable(self.decoder.word)

    def restored(self, text: str) -> list[str]:
        tokens = text.lower().split()
        words = list(map(self.words.__getitem__, tokens))
        # Letters that stand alone in a row may be one word.
        alone = [i for i, t in enumerate(tokens) if len(t) == 1]
        at = 0
        while at + 2 < len(alone):
            end = at
            while end + 1 < len(alone) and alone[end + 1] == alone[end] + 1:
                end += 1
            if end - at >= 2:
                row = tokens[alone[at] : alone[end] + 1]
                words.append(self.decoder.decode(" ".join(row)))
            at = end + 1
        return " ".join(words).split()

    def features(self, text: str) -> set[str]:
        """Whole words as they are, beginnings with a mark behind."""
        words = set(self.restored(text))
        found = set(words)
        for n in BEGINNINGS:
            found |= {f"{w[:n]}-" for w in words if len(w) >= n}
        return found


def _counted(counts: np.ndarray, kept: frozenset[str] | None):
    """Number of texts with each feature, per task; only of ``kept`` ones if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, found = _Reader(counts), Counter()

        def batch_of(found: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["feature", "n"],
            )

        for batch in batches:
            for text in batch.column("text"):
                features = reader.features(text.as_py())
                found.update(features if kept is None else features & kept)
                if len(found) >= HELD_FEATURES:
                    yield batch_of(found)
                    found.clear()
        yield batch_of(found)

    return run


def _surrounded(counts: np.ndarray, kept: frozenset[str] | None):
    """Each feature, of ``kept`` ones if given, with a hash of the two words around it, once per task at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, found = _Reader(counts), set()

        def batch_of(found: set) -> pa.RecordBatch:
            features, around = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(features, pa.string()), pa.array(around, pa.int64())],
                names=["feature", "around"],
            )

        for batch in batches:
            for text in batch.column("text"):
                words = ["", *reader.restored(text.as_py()), ""]
                for before, word, after in zip(words, words[1:], words[2:], strict=False):
                    own = {word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) >= n)} - {""}
                    own = own if kept is None else own & kept
                    if own:
                        around = zlib.crc32(f"{before} {after}".encode())
                        found.update((f, around) for f in own)
                if len(found) >= HELD_FEATURES:
                    yield batch_of(found)
                    found.clear()
        yield batch_of(found)

    return run


def _unexplained(found: DataFrame) -> DataFrame:
    """Without the beginnings of which a longer beginning or word is in nearly all toxic texts and fewer clean ones."""
    stem = F.regexp_replace("feature", "-$", "")
    shorter = F.filter(F.array(*map(F.lit, BEGINNINGS)), lambda n: n < F.length(stem))
    longer = found.select(
        F.explode(F.transform(shorter, lambda n: F.concat(F.substring(stem, 1, n), F.lit("-")))).alias("feature"),
        F.col("n").alias("longer_n"),
        F.col("n_clean").alias("longer_clean"),
    )
    explained = (
        found.join(longer, "feature").where("longer_n >= 0.9 * n AND longer_clean < n_clean").select("feature")
    )
    return found.join(explained, "feature", "left_anti")


class ToxicityModel:
    """Character counts, the chance behind each piece of evidence, and the chance without any.

    ``table`` is (feature, chance); ``evidence`` holds its rows if they are few, else None.
    """

    def __init__(
        self, counts: np.ndarray, evidence: dict[str, float] | None, rest: float, table: DataFrame | None = None
    ):
        self.counts, self.evidence, self.rest, self.table = counts, evidence, rest, table

    def scores(self, texts: Iterable[str], reader: _Reader) -> list[float]:
        """Noisy-or over the evidence of each text."""
        whole = {f for f in self.evidence if not f.endswith("-")}
        by_length = {
            n: {f[:-1] for f in self.evidence if f.endswith("-") and len(f) == n + 1}
            for n in BEGINNINGS
        }
        found = []
        for text in texts:
            words = set(reader.restored(text))
            seen = words & whole
            for n, kept in by_length.items():
                if kept:
                    seen |= {f"{b}-" for b in {w[:n] for w in words} & kept}
            clean = 1 - self.rest
            for f in sorted(seen):
                clean *= 1 - self.evidence[f]
            found.append(1 - clean)
        return found


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    taught: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    sent_features: int = SENT_FEATURES,
) -> ToxicityModel:
    """Characters from all texts; evidence from labelled texts whose rows fulfil ``taught``.

    Evidence are the features that so many toxic and so few clean texts have that their chance is ``MIN_CHANCE`` or more. How
    many there are grows with the corpus; up to ``sent_features`` are sent to all tasks, which changes no result.

    Labels are (id, toxic); rows with a null in either teach nothing, and of several labels of an id the
    larger counts. Without a toxic label there is no evidence and every score is 0.
    """
    scratch = Scratch(docs.sparkSession)
    counts = count_characters(docs, text_column)
    # Labels grow with the documents, so they are never sent to all tasks.
    known = (
        labels.where("toxic IS NOT NULL")
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
        .hint("merge")
    )
    texts = docs.where(F.lit(True) if taught is None else taught).select(
        F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    labelled = scratch.write(texts.join(known, "_id").select("text", F.col("_toxic").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n_toxic = sum(n for t, n in sizes.items() if t)
    n_clean = sum(n for t, n in sizes.items() if not t)
    if not n_toxic:
        return ToxicityModel(counts, {}, 0.0)

    def feature_counts(rows: DataFrame, kept: frozenset[str] | None) -> DataFrame:
        found = rows.select("text").mapInArrow(_counted(counts, kept), "feature string, n bigint")
        return found.groupBy("feature").agg(F.sum("n").alias("n"))

    share = n_toxic / (n_toxic + n_clean)

    def chance(n: Column, clean: Column) -> Column:
        """Chance that a text with the feature is toxic, drawn to the overall share as by a few texts."""
        return (n + share * PRIOR_TEXTS) / (n + clean + PRIOR_TEXTS)

    def sent(features: DataFrame) -> frozenset[str] | None:
        """The features, or None if they are too many to be sent."""
        if features.count() > sent_features:
            return None
        return frozenset(r["feature"] for r in features.select("feature").collect())

    n, clean = F.col("n"), F.coalesce("n_clean", F.lit(0))
    # What is too rare even if no clean text had it never counts.
    often = scratch.write(
        feature_counts(labelled.where("toxic != 0"), None).where(chance(n, F.lit(0)) >= MIN_CHANCE)
    )
    of_clean = feature_counts(labelled.where("toxic = 0"), sent(often)).withColumnRenamed("n", "n_clean")
    likely = scratch.write(
        often.join(of_clean, "feature", "left")
        .select("feature", "n", clean.alias("n_clean"))
        .where(chance(n, clean) >= MIN_CHANCE)
    )
    # Words of a text that was copied often meet toxic texts only, yet always between the same words.
    # So toxic texts count by their different surroundings.
    around = labelled.where("toxic != 0").select("text").mapInArrow(
        _surrounded(counts, sent(likely)), "feature string, around bigint"
    )
    places = around.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("places"))
    found = scratch.write(
        likely.join(places, "feature")
        .withColumn("chance", F.least(chance(F.least("n", "places"), clean), F.lit(0.999)))
        .where(F.col("chance") >= MIN_CHANCE)
    )
    table = scratch.write(_unexplained(found).select("feature", "chance"))
    scratch.drop(labelled, often, likely, found)
    few = table.count() <= sent_features
    evidence = {r["feature"]: r["chance"] for r in table.orderBy("feature").collect()} if few else None
    return ToxicityModel(counts, evidence, REST, table)


def _joined_scores(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """(row_id, score) of the rows (row_id, text) that have evidence, by a join with the table of evidence."""
    counts = model.counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(counts)
        for batch in batches:
            for row, text in zip(batch.column("row_id"), batch.column("text"), strict=True):
                found = pa.array(reader.features(text.as_py()), pa.string())
                own = pa.array([row.as_py()] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays([own, found], names=["row_id", "feature"])

    salted = rows.mapInArrow(run, "row_id bigint, feature string").withColumn("salt", F.pmod("row_id", F.lit(SALTS)))
    table = model.table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    met = salted.join(table, ["feature", "salt"])
    clean = (1 - model.rest) * F.exp(F.sum(F.log(1 - F.col("chance"))))
    return met.groupBy("row_id").agg((1 - clean).alias("score"))


def score(
    docs: DataFrame, model: ToxicityModel, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of each input row.

    A null text counts as empty and, like any text without evidence, gets the chance without any. Ids may be
    null or repeat; other columns are ignored, whatever their names. An empty table gives no rows.
    """
    if model.evidence is None:
        taken = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
        rows = Scratch(docs.sparkSession).numbered(taken, "row_id", None)
        scored = rows.join(_joined_scores(rows.select("row_id", "text"), model), "row_id", "left")
        found = F.coalesce("score", F.lit(model.rest))
        return scored.select("doc_id", found.alias("score"), (found >= 0.5).cast("int").alias("predicted"))

    counts, rest, evidence = model.counts, model.rest, model.evidence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, model = _Reader(counts), ToxicityModel(counts, evidence, rest)
        for batch in batches:
            found = model.scores((t.as_py() for t in batch.column("text")), reader)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(found, pa.float64()),
                    pa.array([int(s >= 0.5) for s in found], pa.int32()),
                ],
                names=["doc_id", "score", "predicted"],
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Rows are judged as by ``score``: null and empty texts stay, and repeated rows stay or go together. An empty table gives
    no rows.
    """
    counts, rest, evidence = model.counts, model.rest, model.evidence
    if evidence is None:
        row = free_name(docs)
        rows = Scratch(docs.sparkSession).numbered(docs, row, None)
        texts = rows.select(F.col(row).alias("row_id"), F.coalesce(text_column, F.lit("")).alias("text"))
        gone = _joined_scores(texts, model).where("score >= 0.5").select(F.col("row_id").alias(row))
        return rows.join(gone, row, "left_anti").drop(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, model = _Reader(counts), ToxicityModel(counts, evidence, rest)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(place))
            clean = [s < 0.5 for s in model.scores(texts, reader)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    place = docs.columns.index(text_column)
    return docs.mapInArrow(run, docs.schema)
