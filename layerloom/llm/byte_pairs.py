"""Token counts of byte-level pair encoding by a dynamic program over prefixes.

The encoding of a prefix ends in exactly one token, and two neighbouring tokens are right exactly when
they are the encoding of their own bytes. So the last token of a prefix is the one token ending there
that fits the last token of the prefix before it, and its count is one more than that prefix has. One
pass over a text gives the count at every prefix; the text is never encoded again for another cut.

The splitting pattern of the vocabulary keeps the program inside short pieces. Most pieces repeat, so
their results are kept in a table of bounded size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from struct import pack

from tokenizers import Tokenizer

#: Pieces kept in memory by a Python worker; the table starts anew beyond that.
KEPT_PIECES = 300_000

# Letters, digits and marks of ASCII and Latin-1 in the classes of the pattern.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARK = r"!-/:-@\[-`{-~¡-§«»¿"
_SPACE = r"\t-\r\x20"

_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[{_MARK}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_FOREIGN = re.compile(rf"[^{_LETTER}0-9{_MARK}{_SPACE}]")


class _Stand(dict):
    """Stands a character of the pattern's classes in for any other, as the library classes it."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if not _FOREIGN.match(c):
            stand = c
        else:
            stand = next((s for s in "a1!" if len(self.cut(f"{s}{c}{s}")) == 1), "\n")
        self[code] = stand
        return stand


class Splitter:
    """Cuts a text into the pieces within which tokens are merged."""

    def __init__(self, tokenizer: Tokenizer):
        self.stand = _Stand(tokenizer)
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        found = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.find_special = re.compile(f"({found})") if found else None

    def segments(self, text: str) -> list[str]:
        """Ordinary text at even places, special strings at odd ones."""
        return self.find_special.split(text) if self.find_special else [text]

    def pieces(self, text: str) -> list[str]:
        if not _FOREIGN.search(text):
            return _PIECES.findall(text)
        stands = text.translate(self.stand)
        return [text[m.start() : m.end()] for m in _PIECES.finditer(stands)]


class PieceTable(dict):
    """What ``make`` gives for each piece, kept for pieces that come again."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        if len(self) >= KEPT_PIECES:
            self.clear()
        found = self[piece] = self.make(piece)
        return found


def _byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class TextEncoder:
    """Token ids of whole texts: each piece that a table does not hold goes to the library's model."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.splitter = Splitter(self.tokenizer)
        self.special = {s: pack("<I", i) for s, i in self.splitter.special.items()}
        self.signs = {b: c for c, b in _byte_values().items()}
        self.model = self.tokenizer.model
        self.table = PieceTable(self._ids)

    def _ids(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            signs = piece.replace(" ", self.signs[32])
        else:
            signs = "".join([self.signs[b] for b in piece.encode()])
        tokens = self.model.tokenize(signs)
        return pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def encode(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit integers, without added special tokens."""
        get = self.table.__getitem__
        return b"".join(
            self.special[s] if i % 2 else b"".join(map(get, self.splitter.pieces(s)))
            for i, s in enumerate(self.splitter.segments(text))
        )


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder for all tasks of a Python worker, so that they share its pieces."""
    return TextEncoder(path)


class PrefixCounter:
    """Exact token counts at the prefixes of a text, under the vocabulary of ``path``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.splitter = Splitter(self.tokenizer)
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        value = _byte_values()
        as_bytes = lambda s: bytes(value[c] for c in s)
        self.token = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.made: dict[tuple[int, int], int] = {}
        for merge in merges:
            left, right = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            pair = self.token[left], self.token[right]
            number = len(self.parts)
            self.token[left + right] = self.made[pair] = number
            self.parts.append(pair)
        # Each ending of a token, with the token that it is itself or -1.
        self.tails = {t[i:]: -1 for t in self.token for i in range(len(t))}
        self.tails |= {t: n for t, n in self.token.items() if n < 256 or self._is_whole(n)}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.totals = PieceTable(lambda piece: self.piece_counts(piece.encode())[-1])

    def _fits(self, a: int, b: int) -> bool:
        """Whether the encoding of the bytes of ``a`` and ``b`` is these two tokens.

        Walks the merges back from the border: a merge across it that would come before the merges
        that built its sides breaks the pair.
        """
        before = len(self.parts)
        while True:
            across = self.made.get((a, b))
            if across is not None and across < before:
                return False
            # Undo the later one of the two merges next to the border. Of equal merges the left one
            # comes first, so one across the border beats an equal one in b, but not one in a.
            if a > b and a >= 256:
                before, a = a, self.parts[a][1]
            elif b >= 256:
                before, b = b + 1, self.parts[b][0]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        found = self.fitting.get((a, b))
        if found is None:
            if len(self.fitting) >= 4 * KEPT_PIECES:
                self.fitting.clear()
            found = self.fitting[a, b] = self._fits(a, b)
        return found

    def _is_whole(self, t: int) -> bool:
        """Whether the encoding of a merged token's bytes is the token itself."""
        pair = self.parts[t]
        del self.made[pair]
        good = self._fits(*pair)
        self.made[pair] = t
        return good

    def piece_counts(self, data: bytes) -> list[int]:
        """Token count of each byte prefix of a piece, from the empty one to the whole."""
        counts, last = [0], [-1]
        look, fitting = self.tails.get, self.fitting
        for end in range(1, len(data) + 1):
            start, found = end - 1, []
            while start >= 0 and (t := look(data[start:end])) is not None:
                if t >= 0:
                    found.append((start, t))
                start -= 1
            # The longest token that fits is the only one.
            while found:
                start, t = found.pop()
                if not start or not found:
                    break
                fits = fitting.get((last[start], t))
                if fits is None:
                    fits = self.fits(last[start], t)
                if fits:
                    break
            counts.append(counts[start] + 1)
            last.append(t)
        return counts

    def total(self, text: str) -> int:
        n, get = 0, self.totals.__getitem__
        for i, part in enumerate(self.splitter.segments(text)):
            n += 1 if i % 2 else sum(map(get, self.splitter.pieces(part)))
        return n

    def at_characters(self, piece: str) -> list[int]:
        """Token count of each character prefix of a piece."""
        counts = self.piece_counts(piece.encode())
        if len(counts) == len(piece) + 1:
            return counts
        found, at = [0], 0
        for c in piece:
            at += len(c.encode())
            found.append(counts[at])
        return found

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of each character prefix of a text, from the empty one to the whole.

        Each count is what the text cut there has by itself. Where a cut changes the pieces before it
        (white space ahead of a word, a shortened word like ``'re``, a special string) the prefix's own
        pieces count.
        """
        counts, done = [0], 0
        for i, part in enumerate(self.splitter.segments(text)):
            if i % 2:
                before = len(counts) - 1 - len(previous)  # noqa: F821
                head = counts[before] if before >= 0 else 0
                for cut in range(1, len(part)):
                    counts.append(head + self.total(previous + part[:cut]))  # noqa: F821
                done += 1
                counts.append(done)
                continue
            previous, white = part, ""
            for piece in self.splitter.pieces(part):
                own = self.at_characters(piece)
                local = [done + n for n in own[1:]]
                if white and self.splitter.stand[ord(piece[0])] in " \n\t\r\x0b\x0c":
                    # Cut right after it, this space still belongs to the run before.
                    local[0] = done - self.totals[white] + self.totals[white + piece[0]]
                if piece[0] == "'" and len(piece) == 3 and piece[1].isalpha():
                    local[1] = done + self.totals["'"] + self.totals[piece[1]]
                counts += local
                done += own[-1]
                white = piece if piece.isspace() else ""
        return counts
