"""Subject area of each document (problem 9).

Terms are weighted by inverse document frequency and by how unevenly labelled documents of the subjects have them; the
weighted paragraph-by-term matrix is reduced by a truncated singular value decomposition. Paragraphs are embedded there and
given to the subject whose centroid has the highest cosine. Centroids start from the labelled documents and the
descriptions of the subjects and are refined over the paragraphs of all documents. A document gets the subjects to which
at least two of its paragraphs are devoted.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainloom.sources.tables import staged

#: The classifier learns from at most so many labelled documents, the first by a hash of their ids.
MAX_LABELLED = 20_000
#: A term tells of a subject that has more than this share of it, each subject counted alike.
LEAST_SHARE = 0.5
DIMENSIONS, REFINEMENTS = 96, 2
#: Dimensions beyond those kept, and passes before the last one, of the subspace iteration.
SPARE_DIMENSIONS, PASSES = 16, 2
#: Documents whose paragraphs are embedded at once.
SLICE = 500
LEAST_COSINE, MENTIONS, PARAGRAPHS = 0.1, 2, 2
#: A term has so many letters and stands in so many documents at least.
LEAST_LETTERS, LEAST_DOCUMENTS = 3, 3
_MARK = re.compile(r"\s*(?:\[\d{1,4}\]|\d{1,3}[.)](?=\s|$)|§\s*\d+)")
_HEADER = re.compile(r"\bCRT-\d|\b[A-Z]-\d{6,}/\d{4}|\*\*\*|\bp(?:age|\.) ?\d|^\W*\d+\W*$|^\W*â\W*\d+\W*â", re.I)
_ENDS = tuple(".:;!?”»\"')")
#: Letters in lower case, all else blank; END for the end of a line.
END = b"0"
_LETTERS = bytes(ord(chr(i).lower()) if chr(i).isalpha() and i < 128 else END[0] if i == 10 else 32 for i in range(256))


def words(text: str) -> list[bytes]:
    """The runs of letters of a text without accents, of any length, and END at the end of each line."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.replace("’", "'"))
    return text.replace("\n", " \n ").encode("ascii", "ignore").translate(_LETTERS).split()


def paragraphs(text: str | None) -> list[str]:
    """The paragraphs of a decision without page headers: from mark to mark where paragraphs are numbered, else parted by blank lines, else by lines."""
    return _parted(text)[1]


def _parted(text: str | None) -> tuple[list[str], list[str]]:
    """The page headers and the paragraphs of a decision."""
    heads: list[str] = []
    lines: list[str] = []
    for x in (text or "").splitlines():
        (heads if len(x) < 80 and _HEADER.search(x) else lines).append(x)
    marks = [_MARK.match(x) is not None for x in lines]
    marked = sum(marks)
    bares = [x.strip() for x in lines]
    blocks = sum(1 for a, b in zip(bares, bares[1:]) if a and not b)
    out: list[str] = []
    fresh = True
    for mark, bare in zip(marks, bares):
        if not bare:
            fresh = True
            continue
        if marked >= 3:
            starts = mark or not out
        elif blocks >= 3:
            starts = fresh and not (out and not out[-1].endswith(_ENDS) and bare[:1].islower())
        else:
            starts = not out or out[-1].endswith(_ENDS)
        if starts or not out:
            out.append(bare)
        else:
            out[-1] += " " + bare
        fresh = False
    return heads, out


def term_counts(labelled: DataFrame, subjects: int) -> DataFrame:
    """(term, by): how many of the labelled documents (text, s) of each subject have each term; counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: list[Counter[bytes]] = [Counter() for _ in range(subjects)]

        def flush() -> pa.RecordBatch:
            terms = sorted(set().union(*by))
            out = pa.RecordBatch.from_arrays([pa.array([t.decode() for t in terms], pa.string()), pa.array([[c[t] for c in by] for t in terms], pa.list_(pa.int64()))], ["term", "by"])
            for c in by:
                c.clear()
            return out

        for batch in batches:
            for text, of in zip(batch.column("text").to_pylist(), batch.column("s").to_pylist()):
                terms = {w for w in words(" ".join((text or "").splitlines())) if len(w) >= LEAST_LETTERS}
                for s in of:
                    by[s].update(terms)
            if sum(map(len, by)) > 500_000:
                yield flush()
        yield flush()

    parts = labelled.select("text", "s").mapInArrow(run, "term string, by array<long>")
    return parts.groupBy("term").agg(F.array(*[F.sum(F.col("by")[i]) for i in range(subjects)]).alias("by"))


def telling_terms(counts: DataFrame, class_sizes: list[int]) -> list[tuple[str, float]]:
    """The terms that tell of a subject, with their largest share; each stands in a labelled document, so MAX_LABELLED bounds their number."""
    n = len(class_sizes)
    rates = [F.col("by")[i] / max(1, c) for i, c in enumerate(class_sizes)]
    total = sum(rates[1:], rates[0])
    seen = sum((F.col("by")[i] for i in range(1, n)), F.col("by")[0])
    share = F.greatest(*rates) / total if n > 1 else F.lit(1.0)
    kept = counts.withColumns({"seen": seen, "total": total}).filter("seen >= 2 and total > 0").withColumn("share", share).filter(F.col("share") > LEAST_SHARE).select("term", "share").collect()
    return sorted((r[0], r[1]) for r in kept)


def encode_paragraphs(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, ids): the numbers of the known terms of each text in their order, -1 at the end of each paragraph; those of page headers come first, as -2 less the number."""
    known = {t.encode(): i for i, t in enumerate(terms)} | {END: -1}
    shared = docs.sparkSession.sparkContext.broadcast(known)  # terms of the labelled documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                heads, parts = _parted(text)
                row = [-2 - known[w] for w in words(" ".join(heads)) if w in known]
                row += [known[w] for w in words("\n".join([*parts, ""])) if w in known]
                rows.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def document_counts(encoded: DataFrame, terms: int) -> np.ndarray:
    """How many documents have each term, page headers included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            row, ids = _listed(batch)
            row, ids = row[ids != -1], ids[ids != -1]
            total += np.bincount(np.unique(row * terms + np.where(ids < 0, -2 - ids, ids)) % terms, minlength=terms)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

    out = np.zeros(terms, np.int64)
    for r in encoded.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():  # one row per term
        out[r[0]] = r[1]
    return out


def _listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, id) of all ids of a batch."""
    column = batch.column("ids")
    return np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy())), column.flatten().to_numpy(zero_copy_only=False)


def _flat(batch: pa.RecordBatch, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, paragraph, term) of each term that has a number; paragraphs are numbered through the batch."""
    row, ids = _listed(batch)
    paragraph = np.cumsum(ids < 0) - (ids < 0)
    term = np.where(ids < 0, -1, number[np.maximum(ids, 0)])
    real = term >= 0
    return row[real], paragraph[real], term[real]


def _slices(batches: Iterator[pa.RecordBatch], number: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """`_flat` of SLICE documents at a time, with their rows; slices without a known term are left out."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            row, paragraph, term = _flat(part, number)
            if len(term):
                yield part, row, paragraph, term


def run_sums(values: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows values[index] from each place of `first` up to the next; all runs of one length at once, which takes a fraction of the time of `np.add.reduceat`."""
    length = np.diff(np.append(first, len(index)))
    out = np.empty((len(first), values.shape[1]))
    order = np.argsort(length, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        out[at] = values[index[first[at][:, None] + np.arange(length[at[0]])]].sum(axis=1)
    return out


def _by_term(term: np.ndarray, index: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """Adds the rows values[index] to the rows `term` of `out`."""
    order = np.argsort(term, kind="stable")
    first = np.flatnonzero(np.diff(term[order], prepend=-1))
    out[term[order][first]] += run_sums(values, index[order], first)


def _vectors(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))


def multiplied(encoded: DataFrame, number: np.ndarray, weight: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'A q of the weighted paragraph-by-term matrix A over all documents, whatever their number; one row per term leaves each task."""
    shared = encoded.sparkSession.sparkContext.broadcast((number, weight, q * weight[:, None]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, weights, scaled = shared.value
        total = np.zeros(scaled.shape)
        for _, _, paragraph, term in _slices(batches, numbers):
            pair = np.unique(paragraph.astype(np.int64) * len(weights) + term)
            paragraph, term = pair // len(weights), pair % len(weights)
            new = np.diff(paragraph, prepend=-1) != 0
            sums = run_sums(scaled, term, np.flatnonzero(new))
            _by_term(term, np.cumsum(new) - 1, sums, total)
        total *= weights[:, None]
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        for i in range(0, len(used), 1000):
            at = used[i : i + 1000]
            yield pa.RecordBatch.from_arrays([pa.array(at), _vectors(total[at])], ["term", "v"])

    sums = encoded.mapInArrow(run, "term long, v array<double>").groupBy("term").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(q.shape[1])]).alias("v"))
    out = np.zeros(q.shape)
    for r in sums.collect():  # one row per term
        out[r[0]] = r[1]
    return out


def truncated_basis(encoded: DataFrame, number: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The first right singular vectors of the weighted paragraph-by-term matrix, by subspace iteration over all documents."""
    size = len(weight)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((size, min(size, DIMENSIONS + SPARE_DIMENSIONS))))[0]
    for _ in range(PASSES):
        q = np.linalg.qr(multiplied(encoded, number, weight, q))[0]
    small = q.T @ multiplied(encoded, number, weight, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return q @ vectors[:, np.argsort(-values)[: min(DIMENSIONS, size)]]


class Space:
    """Weighted terms with their numbers, their embedding and the centroids of the subjects."""

    def __init__(self, number: np.ndarray, weight: np.ndarray, basis: np.ndarray, centroids: np.ndarray) -> None:
        self.number = number
        self.basis = basis * weight[:, None]
        self.least_cosine, self.mentions = LEAST_COSINE, MENTIONS
        self.use(centroids)

    def use(self, centroids: np.ndarray) -> None:
        norm = np.linalg.norm(centroids, axis=1, keepdims=True)
        self.centroids = np.divide(centroids, norm, out=np.zeros_like(centroids), where=norm > 0)
        self.nearest = (self.basis @ self.centroids.T).argmax(axis=1)

    def embed(self, group: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Sums of the vectors of the terms of each group; the groups are 0, 1, ... in this order."""
        return run_sums(self.basis, term, np.flatnonzero(np.diff(group, prepend=-1)))

    def devoted(self, paragraph: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(subject, unit vector) of each of n paragraphs, each with terms; -1 where no subject is near enough or mentioned often enough."""
        x = self.embed(paragraph, term)
        norm = np.linalg.norm(x, axis=1)
        x = np.divide(x, norm[:, None], out=np.zeros_like(x), where=norm[:, None] > 0)
        cosine = x @ self.centroids.T
        best = cosine.argmax(axis=1)
        mentions = np.bincount(paragraph, weights=self.nearest[term] == best[paragraph], minlength=n)
        return np.where((cosine[np.arange(n), best] >= self.least_cosine) & (mentions >= self.mentions), best, -1), x


def _sums(encoded: DataFrame, space: Space, k: int) -> np.ndarray:
    """Sum of the unit vectors of the paragraphs devoted to each subject, over all documents."""
    shared = encoded.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, space.basis.shape[1]))
        for _, _, paragraph, term in _slices(batches, shared.value.number):
            used, paragraph = np.unique(paragraph, return_inverse=True)
            subject, x = shared.value.devoted(paragraph, term, len(used))
            if len(at := np.flatnonzero(subject >= 0)):
                _by_term(subject[at], at, x, total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), _vectors(total)], ["subject", "v"])

    dims = range(space.basis.shape[1])
    rows = encoded.mapInArrow(run, "subject long, v array<double>").groupBy("subject").agg(F.array(*[F.sum(F.col("v")[i]) for i in dims]).alias("v")).collect()
    out = np.zeros((k, len(dims)))
    for r in rows:
        out[r[0]] = r[1]
    return out


def subjects_of(docs: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, subject): the subjects to which at least two paragraphs of the document are devoted.

    Null, empty and blank texts have none, and without labels or documents there are none at all. Repeated documents count each; wrong labels are outweighed.
    """
    spark = docs.sparkSession
    named = [(r[0], r[1] or "") for r in subjects.filter("subject is not null").select("subject", "description").orderBy("subject").collect()]
    names = [s for s, _ in named]
    number = {s: i for i, s in enumerate(names)}
    kept = labels.filter(F.col("subject").isin(names)).groupBy("doc_id").agg(F.collect_set("subject").alias("s")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).collect()
    known = {r[0]: [number[s] for s in r[1]] for r in kept}
    if not known or not names:
        return spark.createDataFrame([], "doc_id long, subject string")
    sizes = [sum(i in v for v in known.values()) for i in range(len(names))]
    lookup = spark.createDataFrame(list(known.items()), "doc_id long, s array<int>")
    told = telling_terms(term_counts(docs.join(F.broadcast(lookup), "doc_id"), len(names)), sizes)
    if not told:
        return spark.createDataFrame([], "doc_id long, subject string")
    encoded = staged(encode_paragraphs(docs, [t for t, _ in told]))
    counts, documents = document_counts(encoded, len(told)), docs.count()
    number = np.where(counts >= LEAST_DOCUMENTS, np.cumsum(counts >= LEAST_DOCUMENTS) - 1, -1)
    terms = [(t, math.log((documents + 1) / (n + 1)) * share**2) for (t, share), n in zip(told, counts.tolist()) if n >= LEAST_DOCUMENTS]
    if not terms:
        return spark.createDataFrame([], "doc_id long, subject string")
    weight = np.array([w for _, w in terms])
    basis = truncated_basis(encoded, number, weight)
    space = Space(number, weight, basis, np.zeros((len(names), basis.shape[1])))
    place = {t.encode(): i for i, (t, _) in enumerate(terms)}
    seeds = np.zeros((len(names), basis.shape[1]))
    for i, (_, text) in enumerate(named):
        for w in words(text):
            if w in place:
                seeds[i] += space.basis[place[w]]
    for r in encoded.join(F.broadcast(lookup), "doc_id").select("s", "ids").toLocalIterator():  # at most MAX_LABELLED rows
        ids = number[[i for i in r[1] if i >= 0]]
        ids = ids[ids >= 0]
        if len(ids):
            v = space.basis[ids].sum(axis=0)
            for s in r[0]:
                seeds[s] += v / (np.linalg.norm(v) or 1.0) / len(r[0])
    space.use(seeds)
    for _ in range(REFINEMENTS):
        moved = _sums(encoded, space, len(names))
        space.use(np.where(np.abs(moved).sum(axis=1, keepdims=True) > 0, moved, space.centroids))
    shared = spark.sparkContext.broadcast((space, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, called = shared.value
        for part, row, paragraph, term in _slices(batches, model.number):
            ids = part.column("doc_id").to_pylist()
            used, first, paragraph = np.unique(paragraph, return_index=True, return_inverse=True)
            subject, _ = model.devoted(paragraph, term, len(used))
            pair, n = np.unique(np.stack([row[first], subject])[:, subject >= 0], axis=1, return_counts=True)
            out = [(ids[d], called[s]) for (d, s), c in zip(pair.T.tolist(), n) if c >= PARAGRAPHS]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["doc_id", "subject"])

    return encoded.mapInArrow(run, "doc_id long, subject string")
