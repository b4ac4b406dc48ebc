"""Token counts of documents and of their prefixes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_pairs import PrefixCounter

LIMIT = 1024


def _fits(counter: PrefixCounter, text: str, limit: int) -> tuple[int, int]:
    """Tokens of a text, and characters of its longest prefix of at most ``limit`` tokens."""
    if len(counter.splitter.segments(text)) > 1:
        counts = counter.prefix_counts(text)
        return counts[-1], max(i for i, n in enumerate(counts) if n <= limit)
    pieces = counter.splitter.pieces(text)
    done = list(accumulate(map(counter.totals.__getitem__, pieces)))
    if not done or done[-1] <= limit:
        return done[-1] if done else 0, len(text)
    # Two pieces ahead of the first that goes beyond and one behind it decide; a cut changes no others.
    over = bisect_right(done, limit)
    first = max(0, over - 2)
    near = counter.prefix_counts("".join(pieces[first : over + 2]))
    base = done[first - 1] if first else 0
    cut = max(i for i, n in enumerate(near) if base + n <= limit)
    return done[-1], sum(map(len, pieces[:first])) + cut


def count_tokens(
    docs: DataFrame,
    vocab_path: str,
    *,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit and fits_chars.

    Counts are those of the ``tokenizers`` file at ``vocab_path`` (byte-level pairs with the splitting
    pattern of ``byte_bpe_50k.json``) without added special tokens; special strings inside a text count
    as the library takes them. ``fits_chars`` is the number of characters of the longest prefix of at most
    ``limit`` tokens. A null text counts as empty. Ids may be null or repeat; other columns are ignored,
    whatever their names. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(vocab_path)
        for batch in batches:
            found = [_fits(counter, t.as_py(), limit) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([n > limit for n, _ in found], pa.bool_()),
                    pa.array([c for _, c in found], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"],
            )

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, fits_chars bigint",
    )


def prefix_table(
    docs: DataFrame, vocab_path: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and ``prefix_tokens``: the token count at each character prefix, the empty one first.

    Nulls, repeated rows and other columns as in ``count_tokens``; a null text has the one entry 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(vocab_path)
        for batch in batches:
            counts = [counter.prefix_counts(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "prefix_tokens"],
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, prefix_tokens array<int>")


def tokens_of_prefix(prefix_tokens: str, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` characters, or of the whole text if it is shorter."""
    n_chars = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    return F.element_at(prefix_tokens, F.least(n_chars + 1, F.size(prefix_tokens)).cast("int"))


def longest_prefix(prefix_tokens: str, budget: Column | int) -> Column:
    """Characters of the longest prefix within a budget of tokens."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    fitting = F.transform(
        prefix_tokens, lambda n, i: F.when(n <= budget, i.cast("long")).otherwise(-1)
    )
    return F.array_max(fitting)
