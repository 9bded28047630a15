"""Splits texts into the pre-tokens of a byte-level BPE vocabulary, in numpy.

The split is that of the vocabularies' published pattern: contractions; runs of letters, of numbers
and of other characters, each with one space in front; white space, of which the last character
before a word stands apart.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

from playline.llm.spans import char_values, span_hashes

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3
#: The characters of white space, and the contractions.
BLANKS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F]
BLANKS += [0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Characters split at a time, unless a text has no place to cut it.
PIECE = 1 << 19


@cache
def kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.zeros(0x110000, np.uint8)
    letters = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        kind = letters.get(unicodedata.category(chr(point))[0])
        if kind:
            out[point] = kind
    out[BLANKS] = BLANK
    return out


def split(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts that lie one after the other, none of them empty."""
    size = len(points)
    kind = kinds()[points]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    run_end = np.ones(size, bool)
    run_end[:-1] = start[1:]
    text_end = edge[1:]
    # The last white space before a word begins a pre-token; a plain space takes the word in.
    last = run_end & (kind == BLANK) & ~text_end
    glue = np.flatnonzero(last & (points == 0x20)) + 1
    start[glue] = False
    start |= last
    # A quote that begins a pre-token, and the letters behind it.
    quotes = np.flatnonzero((points == 0x27) & start & ~text_end)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        inner = np.concatenate([edge, np.ones(3, bool)])
        for letters in CONTRACTIONS:
            at = quotes
            for k, letter in enumerate(letters):
                at = at[(padded[at + k + 1] == ord(letter)) & ~inner[at + k + 1]]
            start[at + 1] = False
            behind = at + len(letters) + 1
            start[behind[behind < size]] = True
    return np.flatnonzero(start)


def cuts(text: str) -> Iterator[str]:
    """Pieces of a long text, cut in front of single spaces between words."""
    first = 0
    while len(text) - first > PIECE:
        at = text.find(" ", first + PIECE)
        while at > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].strip() == ""):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[first:at]
        first = at
    yield text[first:]


class Pieces:
    """Pre-tokens of a run of texts: the distinct ones, and which of them stand where."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(t) for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        begin = split(points, offsets) if len(points) else np.empty(0, np.int64)
        end = np.append(begin[1:], len(points)) if len(begin) else begin
        hashes = span_hashes(points, begin, end, char_values)
        self.hashes, first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.joined, self.begin, self.end = "".join(texts), begin[first], end[first]
        #: Pre-tokens of text i: places[i] to places[i + 1].
        self.places = np.searchsorted(begin, offsets)

    def strings(self, of: np.ndarray) -> list[str]:
        """The distinct pre-tokens of these numbers."""
        ends = self.end[of].tolist()
        return [self.joined[a:b] for a, b in zip(self.begin[of].tolist(), ends)]


class Known:
    """Ids of the pre-tokens that a task has met, found by their 64-bit hashes.

    Beyond ``limit`` pre-tokens it begins anew, so its size is bounded. ``flat`` holds all ids, the
    fixed ones given at the start in front.
    """

    def __init__(self, limit: int, fixed: np.ndarray | None = None):
        self.limit = limit
        self.fixed = np.empty(0, np.uint32) if fixed is None else fixed
        self.clear()

    def clear(self) -> None:
        self.flat, self.used = self.fixed.copy(), len(self.fixed)
        self.hashes = np.empty(0, np.uint64)
        self.begin, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, pieces: Pieces, of: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``flat`` and number of the ids of the distinct pre-tokens ``of`` a run;
        ``encode`` gives the ids of strings that are not known yet."""
        hashes = pieces.hashes[of]
        if len(self.hashes) + len(hashes) > self.limit:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        there = at < len(self.hashes)
        new[there] = self.hashes[at[there]] != hashes[there]
        if new.any():
            ids = encode(pieces.strings(of[new]))
            length = np.array([len(x) for x in ids], np.int64)
            size = int(length.sum())
            if self.used + size > len(self.flat):
                grown = np.empty(2 * (self.used + size), np.uint32)
                grown[: self.used] = self.flat[: self.used]
                self.flat = grown
            self.flat[self.used : self.used + size] = [y for x in ids for y in x]
            begin = self.used + np.cumsum(length) - length
            self.used += size
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.begin = np.insert(self.begin, at[new], begin)
            self.length = np.insert(self.length, at[new], length)
            at = np.searchsorted(self.hashes, hashes)
        return self.begin[at], self.length[at]


def spell(texts: list[str], known: Known, find) -> list[list[np.ndarray]]:
    """The ids of each text, in parts; ``find`` gives the places of a run's distinct pre-tokens."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, pieces in runs(texts):
        begin, length = find(pieces)
        long = length[pieces.which]
        sequence = gather(known.flat, begin[pieces.which], long)
        places = np.concatenate([[0], np.cumsum(long)])[pieces.places]
        for k, row in enumerate(rows):
            parts[row].append(sequence[places[k] : places[k + 1]])
    return parts


def runs(texts: list[str]) -> Iterator[tuple[list[int], Pieces]]:
    """Consecutive texts (long ones in pieces) as ``Pieces``, with the index of each one's text."""
    rows, held, size = [], [], 0
    for index, text in enumerate(texts):
        for piece in cuts(text):
            rows.append(index)
            held.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield rows, Pieces(held)
                rows, held, size = [], [], 0
    if rows:
        yield rows, Pieces(held)


def gather(flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``flat``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(begin - ends + lengths, lengths)]
