"""Benchmark items inside documents, by containment search with MinHash sketches.

Items are partitioned by their number of word shingles. An item's sketch are its smallest shingle hashes, as
many as its size class may miss at the threshold and a few more. A document with enough of the item must
have those few: at most the missing shingles can be outside. So the sketches of the short items are looked
up among all shingles of the long documents, and the bound loses no pair, however long the document is.
Pairs that reach the bound are verified by looking for every shingle of the item in the document's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.scratch import Scratch

WORDS, THRESHOLD = 5, 0.8

#: Sketch entries beyond those an item of its size class may miss.
SURE_MATCHES = 4

#: Sketch rows (two integers each) up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def words_of(text: str) -> Column:
    """Runs of letters and digits in lower case."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _starts(words: str, width: Column) -> Column:
    """Places at which a shingle of ``width`` words begins."""
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))


def _hashes(word_hashes: str, width: Column) -> Column:
    return F.transform(
        _starts(word_hashes, width), lambda i: F.xxhash64(F.slice(word_hashes, i, width))
    )


def _needed(n: Column, threshold: float) -> Column:
    """The smallest count of shingles that is the threshold's share of n."""
    return F.ceil(n * threshold - 1e-9).cast("int")


def item_sketches(
    items: DataFrame, *, item_id: str, text_column: str, words: int, threshold: float
) -> DataFrame:
    """item, width, needed, shingles (texts), sketch (hashes) and sure (of them in any match)."""
    split = items.select(F.col(item_id).alias("item_id"), words_of(text_column).alias("w"))
    width = F.least(F.size("w"), F.lit(words))
    shingled = (
        split.where(F.size("w") > 0)
        .withColumn("width", width)
        .withColumn(
            "shingles",
            F.array_distinct(
                F.transform(
                    _starts("w", F.col("width")),
                    lambda i: F.array_join(F.slice("w", i, F.col("width")), " "),
                )
            ),
        )
        .withColumn("n", F.size("shingles"))
        .withColumn("missing", F.col("n") - _needed(F.col("n"), threshold))
    )
    # Size class: item counts from one power of two to the next; its largest count bounds what may miss.
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("int") - 1
    may_miss = largest - _needed(largest, threshold)
    size = F.least(F.col("n"), may_miss + SURE_MATCHES)
    hashes = F.array_sort(
        F.transform("shingles", lambda s: F.xxhash64(F.transform(F.split(s, " "), lambda w: F.xxhash64(w))))
    )
    return shingled.select(
        "item_id",
        "width",
        "n",
        _needed(F.col("n"), threshold).alias("needed"),
        "shingles",
        F.slice(hashes, F.lit(1), size).alias("sketch"),
        (size - F.col("missing")).alias("sure"),
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_found, containment) of at least ``threshold``.

    Words are runs of letters and digits in lower case. Containment is the share of an item's distinct
    shingles of ``words`` words that occur in the document; an item of fewer words is one shingle. Items without
    words, null and empty texts match nothing. Rows that repeat a doc_id or an item_id count as one with
    the most shingles found; null ids are ids. Other columns are ignored, whatever their names. Empty
    tables give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    sketches = scratch.write(
        item_sketches(
            items, item_id=item_id, text_column=item_text, words=words, threshold=threshold
        )
    )
    # At most ``words`` different widths.
    widths = [r["width"] for r in sketches.select("width").distinct().collect()]
    entries = sketches.select("item_id", "width", "n", "sure", F.explode("sketch").alias("shingle"))
    if entries.count() <= BROADCAST_ROWS:
        entries = F.broadcast(entries)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    hashed = texts.select("doc_id", F.transform(words_of("text"), lambda w: F.xxhash64(w)).alias("h"))
    found = None
    for width in sorted(widths):
        part = hashed.select(
            "doc_id",
            F.lit(width).alias("width"),
            F.explode(F.array_distinct(_hashes("h", F.lit(width)))).alias("shingle"),
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [],
            f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, "
            f"item_id {sketches.schema['item_id'].dataType.simpleString()}, "
            "n_shingles int, n_found int, containment double",
        )
    candidates = scratch.write(
        found.join(entries, ["width", "shingle"])
        .groupBy("doc_id", "item_id", "n")
        .agg(F.countDistinct("shingle").alias("matches"), F.min("sure").alias("sure"))
        .where("matches >= sure")
        .select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item"))
        .distinct()
    )
    of_doc = texts.join(candidates, F.col("doc_id").eqNullSafe(F.col("c_doc"))).select(
        "doc_id", "c_item", F.concat(F.lit(" "), F.array_join(words_of("text"), " "), F.lit(" ")).alias("joined")
    )
    shingles = sketches.select("item_id", "n", "needed", "shingles")
    n_found = F.size(
        F.filter("shingles", lambda s: F.contains("joined", F.concat(F.lit(" "), s, F.lit(" "))))
    )
    return (
        of_doc.join(shingles, F.col("c_item").eqNullSafe(F.col("item_id")))
        .select("doc_id", "item_id", "n", "needed", n_found.alias("n_found"))
        .where("n_found >= needed")
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct((F.col("n_found") / F.col("n")).alias("containment"), "n_found", "n")).alias("m"))
        .select(
            "doc_id",
            "item_id",
            F.col("m.n").alias("n_shingles"),
            F.col("m.n_found").alias("n_found"),
            F.col("m.containment").alias("containment"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, *, row_column: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.

    Rows are judged one by one: a clean row stays whatever other rows share its id, null or not, and repeated rows
    stay or go together. Null and empty texts contain nothing and stay; texts count whole, however long. Without
    items, or items without words, all rows stay; an empty table stays empty. Columns of ``docs`` may have any
    names. ``row_column`` numbers the rows (see ``Scratch.numbered``).
    """
    scratch, number = Scratch(docs.sparkSession), "_row_of_contamination"
    numbered = scratch.numbered(docs, number, row_column)
    found = contained_items(numbered, items, id_column=number, **options)
    hit = scratch.write(found.select(F.col("doc_id").alias(number)).distinct())
    return numbered.join(hit, number, "left_anti").select(*docs.columns)
