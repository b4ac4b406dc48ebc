"""A character n-gram model of a corpus, and decoding of disguised words with it."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a sign may stand for.
STANDS_FOR = {
    "0": "o",
    "1": "il",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
}

#: Signs that may stand between the letters of one word, and those for a letter left out.
BETWEEN, HIDDEN = " .-_~·'`:/\\,;", "*#"

LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
_DIGIT, _OTHER, _CODE_BITS = 61, 60, 6

#: Counts of four characters are kept in this many buckets; shorter ones have a place each.
BUCKETS = 1 << 20
_PLACES = [1 << _CODE_BITS, 1 << 2 * _CODE_BITS, 1 << 3 * _CODE_BITS, BUCKETS]
_STARTS = np.concatenate([[0], np.cumsum(_PLACES)])

#: Log chances of the channel: a sign read as a letter, kept as it is, a separator or a repeated letter left
#: out, a hidden letter guessed.
READ, KEPT, LEFT_OUT, REPEATED, GUESSED = -1.0, -2.0, -0.5, -1.0, -4.0


def _codes() -> np.ndarray:
    """The class of each code point: 0 for what is no letter or digit."""
    table = np.zeros(0x10000, dtype=np.uint32)
    for i in range(0x10000):
        if chr(i).isalpha():
            table[i] = _OTHER
    for i, c in enumerate(LETTERS):
        table[ord(c)] = i + 1
    for c in "0123456789":
        table[ord(c)] = _DIGIT
    return table


def _bucket(four):
    """The bucket of four characters' codes; the same for numbers and arrays."""
    return (four * 0x9E3779B1 & 0xFFFFFFFF) >> 12


def count_characters(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts of one to four neighbouring characters over all whole texts, in lower case.

    The table has a fixed size, so it can be sent to every task; its counts grow with the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = _codes(), np.zeros(int(_STARTS[-1]), dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                points = np.frombuffer(f" {text.as_py().lower()} ".encode("utf-32-le"), dtype="<u4")
                one = table[np.minimum(points, 0xFFFF)]
                two = one[:-1] << _CODE_BITS | one[1:]
                three = two[:-1] << _CODE_BITS | one[2:]
                four = (three[:-1] << _CODE_BITS | one[3:]).astype(np.uint64)
                for start, size, found in zip(
                    _STARTS, _PLACES, (one, two, three, _bucket(four)), strict=False
                ):
                    if len(found) * 8 > size:
                        counts[start : start + size] += np.bincount(found, minlength=size)
                    else:
                        np.add.at(counts, start + found.astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(counts[at])], names=["place", "n"]
        )

    rows = docs.where(F.col(text_column).isNotNull()).select(F.col(text_column).alias("text"))
    found = (
        rows.mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(int(_STARTS[-1]), dtype=np.int64)
    counts[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return counts


_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1\1")

#: What stands around a word rather than in it. A sign that may be a letter can begin a word.
_EDGES = " .,;:!?\"'()[]{}<>«»¿¡…-_*#~/\\"
_BEFORE = _EDGES.replace("!", "")

_SIGN = "".join(map(re.escape, STANDS_FOR))
_LETTER_INSIDE = re.compile(r"[^\W\d_]")
_MARK_INSIDE = re.compile(rf"[{_SIGN}]|(?<=[^\W\d_])[^\w\s](?=[^\W\d_])|(?<=[^\W\d_])_(?=[^\W\d_])")


class Decoder:
    """Reads words behind look-alike signs, separated and repeated letters.

    A word with such marks is a lattice: each character can be what it is or what it may stand for, and a
    separator or repeated letter can fall away. The likeliest way through under the model of the corpus is
    the word. Words without marks have one way and stay.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.total = max(1, int(counts[: _PLACES[0]].sum()))
        self.code = {c: i + 1 for i, c in enumerate(LETTERS)} | {c: _DIGIT for c in "0123456789"}
        self.known: dict[tuple[int, int], float] = {}

    def _chance(self, before: int, c: int) -> float:
        """Log chance of a character after three others, backed by shorter ones."""
        found = self.known.get((before, c))
        if found is None:
            bits, counts = _CODE_BITS, self.counts
            chance = (counts[c] + 1) / (self.total + _PLACES[0])
            for k in (1, 2, 3):
                context = before & ((1 << k * bits) - 1)
                whole = context << bits | c
                place = _bucket(whole) if k == 3 else whole
                n, of = counts[_STARTS[k] + place], counts[_STARTS[k - 1] + context]
                chance = (min(n, of) + 4 * chance) / (of + 4)
            found = self.known[before, c] = math.log(chance)
        return found

    def _ways(self, text: str, i: int) -> list[tuple[str, float]]:
        c = text[i]
        if c.isalpha():
            # A letter repeated beyond a double one may fall away.
            if text[max(0, i - 2) : i + 3].find(c * 3) >= 0 and text[i - 1 : i] == c:
                return [(c, 0.0), ("", REPEATED)]
            return [(c, 0.0)]
        ways = [(c if c.isdigit() else " ", KEPT)]
        ways += [(letter, READ) for letter in STANDS_FOR.get(c, "")]
        if c in BETWEEN or (i and text[i - 1] == c):
            ways.append(("", LEFT_OUT))
        if c in HIDDEN and text[i - 1 : i].isalpha() and text[i + 1 : i + 2].isalpha():
            ways += [("", LEFT_OUT), *[(letter, GUESSED) for letter in LETTERS[:26]]]
        return ways

    def decode(self, text: str) -> str:
        """The likeliest reading of a marked word in lower case."""
        mask = (1 << 3 * _CODE_BITS) - 1
        best: dict[int, tuple[float, str]] = {0: (0.0, "")}
        for i in range(len(text)):
            ways, following = self._ways(text, i), {}
            for state, (score, out) in best.items():
                for c, cost in ways:
                    if c:
                        code = self.code.get(c, 0 if c == " " else _OTHER)
                        way = score + cost + self._chance(state, code), out + c
                        to = (state << _CODE_BITS | code) & mask
                    else:
                        way, to = (score + cost, out), state
                    if to not in following or way[0] > following[to][0]:
                        following[to] = way
            best = following
        ends = [(s + self._chance(state, 0), out) for state, (s, out) in best.items()]
        return max(ends)[1]

    def word(self, token: str) -> str:
        """The word or words behind a token of a lower-case text, without marks around them."""
        core = token.lstrip(_BEFORE).rstrip(_EDGES)
        if _PLAIN.fullmatch(core):
            return self.decode(core) if _RUN.search(core) else core
        if _LETTER_INSIDE.search(core) and (_MARK_INSIDE.search(core) or _RUN.search(core)):
            return self.decode(core)
        return core.strip(_EDGES)
