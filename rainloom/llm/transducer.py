"""Byte-pair encoding as a lazily determinised finite-state transducer.

A state is the last token of the encoding of the bytes read so far. A token may follow another only if the two stand side by
side in the encoding of their joint bytes; this relation is worked out the first time a pair is met and kept (lazy
determinisation), as are the outputs of whole pieces. No token is longer than the longest entry of the vocabulary, so the
state after a byte depends on a bounded number of states before it, and a token is emitted once all states within that
reach go back to it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids of a rank file (base64 and number per line)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Encoder of single pieces of text by the merges of a rank table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.follows: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """The merges applied by rank; used on tokens and pairs of tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        if (a, b) not in self.follows:
            self.follows[a, b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return self.follows[a, b]

    def stands_alone(self, a: int) -> bool:
        if a not in self.whole:
            self.whole[a] = self.merged(self.token[a]) == [a]
        return self.whole[a]

    def emitted(self, piece: Iterable[int]) -> Iterator[int]:
        """The ids of the bytes of one piece, each given as soon as no later byte can change it.

        Any later token begins within the last `longest` positions, so what all states there have in common is settled. Only
        the positions since then are held, however long the piece is.
        """
        base, end, tail = 0, 0, bytearray()  # `tail` are the bytes from `base` on
        state, start = {0: -1}, {}
        for byte in piece:
            tail.append(byte)
            end += 1
            for begin in range(max(0, end - self.longest), end):
                before = state.get(begin)
                if before is None:
                    continue
                t = self.ranks.get(bytes(tail[begin - base : end - base]))
                if t is not None and self.stands_alone(t) and (begin == 0 or self.may_follow(before, t)):
                    state[end], start[end] = t, begin
                    break
            if end - base >= 4 * self.longest and end % self.longest == 0:
                live = [p for p in range(end + 1 - self.longest, end + 1) if p in state]
                while len(live) > 1:  # walk the later states back until one is left
                    last = max(live)
                    live = list({start[last] if p == last else p for p in live})
                    if min(live) == base:
                        break
                if len(live) == 1 and live[0] > base:
                    yield from self._between(state, start, base, live[0])
                    del tail[: live[0] - base]
                    base = live[0]
                    state = {p: t for p, t in state.items() if p >= base}
                    start = {p: b for p, b in start.items() if p > base}
        yield from self._between(state, start, base, end)

    @staticmethod
    def _between(state: dict[int, int], start: dict[int, int], base: int, end: int) -> list[int]:
        ids = []
        while end > base:
            ids.append(state[end])
            end = start[end]
        return ids[::-1]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece; those of pieces up to 64 bytes are kept."""
        if (out := self.known.get(piece)) is not None:
            return out
        out = tuple(self.emitted(piece))
        if len(piece) <= 64 and len(self.known) < 1 << 20:
            self.known[piece] = out
        return out


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of each code point: letter, digit (number), white space or other."""
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    at = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            table[at[m.start() : m.end()]] = kind
    return table


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which characters start a piece; `first` tells which start a text.

    The pieces are those of the public byte-level pattern: contractions, runs of letters, numbers or other signs with a blank
    in front, and white space, whose last character stays apart from a word behind it.
    """
    n = len(points)
    kind = _classes()[points]
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    change[0] = True
    space = kind == SPACE
    start = change.copy()
    ends = np.empty(n, bool)  # last of its run
    ends[:-1], ends[-1] = change[1:], True
    text_end = np.empty(n, bool)
    text_end[:-1], text_end[-1] = first[1:], True
    tail = space & ends & ~text_end  # the white space right before a word
    start |= tail
    blank = tail & (points == 32)
    start[1:][blank[:-1]] = False  # a word takes the blank in front of it
    quote = np.flatnonzero((points == 39) & start & ends & ~text_end)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        limit = np.concatenate([first, [True, True, True]])
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ~limit[quote + 2] & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for hit, size in ((quote[one], 2), (quote[two], 3)):
            start[hit + 1] = False
            if size == 3:
                start[hit + 2] = False
            after = hit[hit + size < n] + size
            start[after] = True
            # a run that begins right behind keeps its own start; a blank in front of it too
    return start


class Utf8Stream:
    """Incremental decoding of bytes that may break off inside a character; broken bytes become U+FFFD."""

    # Lead byte ranges with the number of bytes that follow, and the bounds of the first of them.
    _LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))

    def __init__(self) -> None:
        self.need, self.lo, self.hi, self.point = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need:
                if self.lo <= b <= self.hi:
                    self.point, self.need, self.lo, self.hi = self.point << 6 | b & 0x3F, self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.point))
                    continue
                out.append("\ufffd")
                self.need, self.lo, self.hi = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
                continue
            for first, last, need, lo, hi in self._LEADS:
                if first <= b <= last:
                    self.need, self.lo, self.hi, self.point = need, lo, hi, b & (0x3F >> need)
                    break
            else:
                out.append("\ufffd")
        return "".join(out)

    def close(self) -> str:
        left, self.need, self.lo, self.hi = self.need, 0, 0x80, 0xBF
        return "\ufffd" if left else ""
