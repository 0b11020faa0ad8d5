"""Evaluation texts leaking into training text (problem 8).

Texts become streams of folded letters and digits, so that case, punctuation, spacing and line breaks don't count. A
broadcast set of hashes of all windows (at most GRAM letters) of the test passages is held against every window of every document;
what is hit is verified word by word: a leak needs a stretch of 25 passage words of which at most two are lost or altered.
Page headers and paragraph numbers show as insertions in the document and are skipped.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

STRETCH, SPARED = 25, 2
#: Headers and numbers reckoned with inside a stretch; they and the spared words part its intact letters into at most PARTS runs.
INSERTIONS = 3
PARTS = SPARED + INSERTIONS + 1
#: Longest and shortest windows in letters. The length taken is the longest that every stretch is sure to hold; where even LEAST_GRAM isn't sure, one hit is enough to verify a passage.
GRAM, LEAST_GRAM = 16, 8
#: Longest insertion (header, number) between two words, in letters and digits.
INSERTION = 160
#: Letters of successive words that may go on behind an insertion; fewer are found by chance.
LEAST_LETTERS = 4
#: Characters of the passages that a task holds at once (about 30 bytes each with their windows); more are taken in blocks.
BLOCK_CHARACTERS = 4_000_000
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)
_BITS = 24
SEPARATOR = "\ue000"
_BROKEN = re.compile("[\u00c2-\u00f4][\u0080-\u00bf\u0152\u0153\u0160\u0161\u0178\u017d\u017e\u0192\u02c6\u02dc\u2013-\u203a\u20ac\u2122]{1,3}")


def _mend(m: re.Match) -> str:
    try:
        raw = b"".join(c.encode("cp1252") if ord(c) > 0xFF or c.encode("cp1252", "ignore") else c.encode("latin-1") for c in m.group())
        return raw.decode("utf-8")
    except UnicodeError:
        return m.group()


@lru_cache(1)
def _kept() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for i in range(0x30000):
        if not 0xD800 <= i < 0xE000 and chr(i).isalnum():
            table[i] = True
    table[ord(SEPARATOR)] = True
    return table


def stream(text: str) -> np.ndarray:
    """Code points of the letters and digits of `text`, folded, without accents; wrongly decoded UTF-8 is mended first."""
    if not text.isascii():
        if _BROKEN.search(text):
            text = _BROKEN.sub(_mend, text)
        text = unicodedata.normalize("NFKD", text)
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return points[_kept()[points]]


def places(text: str) -> list[int]:
    """The offset in `text` of each letter of `stream(text)`, and its length at the end; letters of mended characters have that of the first of them."""
    out: list[int] = []
    at, kept = 0, _kept()

    def take(part: str, offset: int, wide: bool) -> None:
        for i, c in enumerate(part):
            for x in unicodedata.normalize("NFKD", c).lower() if not c.isascii() else c.lower():
                if kept[ord(x)]:
                    out.append(offset if wide else offset + i)

    for m in _BROKEN.finditer(text):
        take(text[at : m.start()], at, False)
        take(_mend(m), m.start(), True)
        at = m.end()
    take(text[at:], at, False)
    return [*out, len(text)]


def spans_in_text(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the stream as spans of `text`, in order and joined where they meet."""
    at, out = places(text), []
    for a, b in sorted(spans):
        begin, end = at[a], at[b - 1] + 1 if b > a else at[a]
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((begin, end))
    return out


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each window of `gram` characters."""
    if len(points) < gram:
        return np.empty(0, np.uint64)
    h, width, power = points.astype(np.uint64), 1, _BASE
    out, size = None, 0  # windows of the low bits of `gram`
    while True:
        if gram & width:
            out, size = (h, width) if out is None else (h[: len(h) - size] * out_power + out[width:], size + width)
            out_power = power if size == width else out_power * power
        if width * 2 > gram:
            break
        h = h[:-width] * power + h[width:]
        power, width = power * power, width * 2
    out = out ^ (out >> np.uint64(29))
    return out * np.uint64(0xBF58476D1CE4E5B9)


def least_letters(words: list[str]) -> int:
    """The fewest letters that a stretch of the passage keeps when its longest SPARED words are lost; 0 for a passage without a stretch."""
    sizes = [len(w) for w in words]
    return min((sum(sorted(sizes[i : i + STRETCH])[:-SPARED]) for i in range(len(sizes) - STRETCH + 1)), default=0)


class Chain:
    """The words of a passage, matched in their order to a text from a given place on."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.starts = [0]
        for w in words:
            self.starts.append(self.starts[-1] + len(w))
        #: The fewest words from each one on that have LEAST_LETTERS.
        self.seeds = ["".join(words[i : next((e for e in range(i + 1, len(words)) if self.starts[e] - self.starts[i] >= LEAST_LETTERS), len(words))]) for i in range(len(words))]

    def reach(self, text: str, first: int, position: int) -> Callable[[int], tuple[int, tuple[tuple[int, int, int, int], ...]]]:
        """A function of the words that may be lost, giving the most words from `first` on that stand in `text` from `position` on, and their ranges (first word, last, first letter, last).

        Words follow each other letter by letter; where they don't, up to the given number is lost and the next are looked for
        at all places within 2 * INSERTION. Words beyond a break count up to STRETCH from the first one.
        """
        words, starts, n = self.words, self.starts, len(self.words)
        known: dict[tuple[int, int, int], tuple[int, tuple[tuple[int, int, int, int], ...]]] = {}

        def onwards(i: int, q: int, spared: int) -> tuple[int, tuple[tuple[int, int, int, int], ...]]:
            if (i, q, spared) in known:
                return known[i, q, spared]
            b, at = i, q
            while b < n and text.startswith(words[b], at):
                at += len(words[b])
                b += 1
            best, ranges = 0, ()
            for lost in range(spared + 1):
                c = b + lost
                if c >= n or c - first >= STRETCH:
                    break
                gap = starts[c] - starts[b]
                for place in self._places(text, c, at + (lost == 0), at + gap + 2 * INSERTION, at, gap):
                    m, r = onwards(c, place, spared - lost)
                    if m > best:
                        best, ranges = m, r
            known[i, q, spared] = out = (b - i + best, ((i, b, q, at), *ranges) if b > i else ranges)
            return out

        return lambda spared: onwards(first, position, spared)

    def _places(self, text: str, c: int, left: int, right: int, at: int, gap: int) -> list[int]:
        """Where words from `c` on go on in text[left:right]: at least LEAST_LETTERS of them, or a short one in its place after an altered or lost word."""
        out, seed = [], self.seeds[c]
        if len(seed) >= LEAST_LETTERS:
            hit = text.find(seed, left, right + len(seed))
            while hit >= 0:
                out.append(hit)
                hit = text.find(seed, hit + 1, right + len(seed))
        if gap and len(self.words[c]) < LEAST_LETTERS:
            out += [x for x in sorted({at, at + gap - 1, at + gap, at + gap + 1}) if x not in out and text.startswith(self.words[c], x)]
        return out


class Passages:
    """The windows of the passages: a bit table, sorted hashes, and for each the passages and places that have it."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in items]
        self._chains: dict[int, tuple[Chain, Chain]] = {}
        self.words: list[list[str]] = []
        self.starts: list[np.ndarray] = []
        hashes, owners, places = [], [], []
        for k, (_, passage) in enumerate(items):
            words = [w for w in ("".join(map(chr, stream(p))) for p in passage.split()) if w]
            self.words.append(words)
            self.starts.append(np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64))
        intact = np.array([least_letters(w) for w in self.words], np.int64)
        self.gram = min(GRAM, max(LEAST_GRAM, -(-int(intact[intact > 0].min(initial=GRAM * PARTS)) // PARTS)))
        #: Different windows that any stretch holds at least, whatever words are lost and wherever insertions lie.
        self.need = np.maximum(1, intact - (self.gram - 1) * PARTS)
        for k, words in enumerate(self.words):
            # a passage without a stretch can't leak
            h = gram_hashes(np.array([ord(c) for w in words for c in w] if intact[k] else [], np.uint32), self.gram)
            hashes.append(h)
            owners.append(np.full(len(h), k, np.int64))
            places.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes, first = np.unique(h[order], return_index=True)
        self.bounds = np.append(first, len(h))
        self.owner = (np.concatenate(owners) if owners else np.empty(0, np.int64))[order]
        self.place = (np.concatenate(places) if places else np.empty(0, np.int64))[order]
        self.table = np.zeros(1 << _BITS, bool)
        self.table[self.hashes >> np.uint64(64 - _BITS)] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, passage, place) of each window that a passage holds."""
        at = np.flatnonzero(self.table[h >> np.uint64(64 - _BITS)])
        if not len(self.hashes) or not len(at):
            return (np.empty(0, np.int64),) * 3
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[k] == h[at]
        at, k = at[same], k[same]
        size = self.bounds[k + 1] - self.bounds[k]
        ends = np.cumsum(size)
        index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.bounds[k] - (ends - size), size)
        return np.repeat(at, size), self.owner[index], self.place[index]

    def matched(self, k: int, text: str, mirrored: str, anchors: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Which words of passage `k` belong to a stretch of STRETCH with at most SPARED lost that stands in `text` around an anchor, and from where to where the stretches run.

        An anchor is a (word, position) where a hit lies; from each, words are matched onwards and, in `mirrored` (`text` read from its end), backwards.
        """
        ok, spans = np.zeros(len(self.words[k]), bool), []
        n, size = len(ok), len(text)
        ahead, behind = self.chains(k)
        for a, q in anchors:
            right, left = ahead.reach(text, a, q), behind.reach(mirrored, n - a, size - q)
            if right(SPARED)[0] + left(SPARED)[0] < STRETCH - SPARED:
                continue
            for spared in range(SPARED + 1):
                (m, x), (l, y) = right(spared), left(SPARED - spared)
                if m + l >= STRETCH - SPARED:
                    for i, j, _, _ in x:
                        ok[i:j] = True
                    for i, j, _, _ in y:
                        ok[n - j : n - i] = True
                    spans.append((size - y[-1][3] if y else q, x[-1][3] if x else q))
        return ok, spans

    def chains(self, k: int) -> tuple[Chain, Chain]:
        """Passage `k` read onwards and from its end."""
        if k not in self._chains:
            self._chains[k] = Chain(self.words[k]), Chain([w[::-1] for w in reversed(self.words[k])])
        return self._chains[k]

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(number of the text, item id, matched words) of each leak."""
        return ((d, item, n) for d, item, n, _ in self.find_spans(texts))

    def find_spans(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
        """(number of the text, item id, matched words, spans in its stream) of each leak."""
        joined = stream(SEPARATOR.join((t or "").replace(SEPARATOR, " ") for t in texts))
        breaks = np.flatnonzero(joined == ord(SEPARATOR))
        position, passage, place = self.hits(gram_hashes(joined, self.gram))
        if not len(position):
            return
        doc = np.searchsorted(breaks, position)
        begin = np.concatenate([[0], breaks + 1])
        # maximal runs of hits along one diagonal of a pair
        group, diagonal = doc * len(self.ids) + passage, position - place
        order = np.lexsort((position, diagonal, group))
        group, diagonal, position, place = group[order], diagonal[order], position[order], place[order]
        starts_run = np.append(True, (np.diff(group) != 0) | (np.diff(diagonal) != 0) | (np.diff(position) != 1))
        first = np.flatnonzero(starts_run)
        length = np.diff(np.append(first, len(group))) + self.gram - 1
        edges = np.flatnonzero(np.append(True, np.diff(group) != 0))
        ends = np.append(edges[1:], len(group))
        enough = ends - edges >= self.need[group[edges] % len(self.ids)]
        text, mirrored, shown = "", "", -1
        for lo, hi in zip(edges[enough], ends[enough]):
            d, k = divmod(int(group[lo]), len(self.ids))
            if len(np.unique(place[lo:hi])) < self.need[k]:
                continue
            start = int(begin[d])
            if d != shown:
                text = joined[start : int(breaks[d]) if d < len(breaks) else len(joined)].tobytes().decode("utf-32-le")
                mirrored, shown = text[::-1], d
            runs = slice(*np.searchsorted(first, [lo, hi]))
            p, q, starts = place[first[runs]], position[first[runs]] - start, self.starts[k]
            a, b = np.searchsorted(starts, p), np.searchsorted(starts, p + length[runs], side="right") - 1
            whole = a < b  # runs without a whole word lie beside no intact stretch
            ok, spans = self.matched(k, text, mirrored, list(zip(a[whole].tolist(), (q + starts[a] - p)[whole].tolist())))
            if ok.any():
                yield d, self.ids[k], int(ok.sum()), spans


def _blocks(items: DataFrame) -> list:
    """Broadcast passages, in blocks of about BLOCK_CHARACTERS by a hash of their ids."""
    spark = items.sparkSession
    clean = items.filter("passage is not null and item_id is not null").select("item_id", "passage")
    blocks = max(1, -(-(clean.agg(F.sum(F.length("passage"))).first()[0] or 0) // BLOCK_CHARACTERS))
    parts = (clean.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) for b in range(blocks))
    return [spark.sparkContext.broadcast(Passages([(r[0], r[1]) for r in part.collect()])) for part in parts]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, 500):
        yield batch.slice(i, 500)


def leaked_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, words, spans): the documents that hold a passage, with the number of its words found and the stretches of `text` that hold them, as (begin, end).

    Null, empty and very short texts hold none; passages of fewer than 25 words can't leak. One row per pair, rows of repeated documents each their own.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("words", pa.int32()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))])
    out = None
    for shared in _blocks(items):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                for part in _parts(batch):
                    ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                    rows = [{"doc_id": ids[d], "item_id": item, "words": n, "spans": [{"begin": a, "end": b} for a, b in spans_in_text(texts[d], spans)]} for d, item, n, spans in shared.value.find_spans(texts)]
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

        found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, words int, spans array<struct<begin:int,end:int>>")
        out = found if out is None else out.unionByName(found)
    return out


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, words) of `leaked_spans`."""
    return leaked_spans(docs, items).select("doc_id", "item_id", "words")


def _each_block(docs: DataFrame, items: DataFrame, change: Callable[[pa.RecordBatch, list[tuple[int, int, int, list[tuple[int, int]]]]], pa.RecordBatch]) -> DataFrame:
    """`docs` after `change` has been applied with the leaks of each block in turn; the texts pass once and aren't shuffled."""
    out = docs
    for shared in _blocks(items):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                for part in _parts(batch):
                    yield change(part, list(shared.value.find_spans(part.column("text").to_pylist())))

        out = out.mapInArrow(run, docs.schema)
    return out


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no passage."""

    def change(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        keep = np.ones(part.num_rows, bool)
        keep[[d for d, *_ in found]] = False
        return part.filter(pa.array(keep))

    return _each_block(docs, items, change)


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All documents, without the stretches of their text that hold passages; a blank stands in the place of each. Other texts stay as they are."""

    def change(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        if not found:
            return part
        texts, spans = part.column("text").to_pylist(), {}
        for d, _, _, s in found:
            spans.setdefault(d, []).extend(s)
        for d, s in spans.items():
            for a, b in reversed(spans_in_text(texts[d], s)):
                texts[d] = texts[d][:a] + " " + texts[d][b:]
        at = part.schema.get_field_index("text")
        return part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return _each_block(docs, items, change)
