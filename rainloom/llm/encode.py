"""Encoding of a corpus with a public tokenizer, and decoding (problem 7)."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rainloom.llm.transducer import Transducer, Utf8Stream, parse_ranks, piece_starts

FOLDER = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
_ready: dict[int, Transducer] = {}


def _transducer(key: int, data: bytes) -> Transducer:
    """One transducer per worker process; what it has learned serves all later batches."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = Transducer(parse_ranks(data))
    return _ready[key]


def encode_texts(texts: pa.Array, machine: Transducer) -> pa.ListArray:
    """The ids of each text; an empty list for an empty and for a null text.

    The texts are cut into pieces all at once on their joint bytes; each different piece passes the transducer once.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if not len(whole):
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.int32()))
    points = np.frombuffer(whole.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((whole & 0xC0) != 0x80)
    first = np.zeros(len(points), bool)
    opens = np.searchsorted(lead, at[:-1][at[1:] > at[:-1]])
    first[opens] = True
    begins = lead[piece_starts(points, first)]
    pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(whole)).astype(np.int64)), pa.py_buffer(whole))
    coded = pieces.dictionary_encode()
    outputs = [machine.encode(p.encode()) for p in coded.dictionary.to_pylist()]
    size = np.fromiter(map(len, outputs), np.int64, len(outputs))
    flat = np.fromiter((i for o in outputs for i in o), np.int32, int(size.sum()))
    from_ = np.cumsum(size) - size
    which = coded.indices.to_numpy()
    counts = size[which]
    ends = np.cumsum(counts)
    index = np.arange(int(ends[-1])) + np.repeat(from_[which] - (ends - counts), counts)
    totals = np.concatenate([[0], ends])[np.searchsorted(begins, at)]
    return pa.ListArray.from_arrays(pa.array(totals.astype(np.int32)), pa.array(flat[index]))


def encode_corpus(docs: DataFrame, vocabulary: str = f"{FOLDER}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids): the ids of each text, one row per row of `docs`; strings of special tokens are ordinary text."""
    data = open(vocabulary, "rb").read()
    shared = docs.sparkSession.sparkContext.broadcast(data)  # a vocabulary file, under 2 MB
    key = hash((vocabulary, len(data)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _transducer(key, shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), encode_texts(part.column("text"), machine)], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_corpus(encoded: DataFrame, vocabulary: str = f"{FOLDER}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, text): the texts of lists of ids, by an incremental UTF-8 machine; unknown ids give U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in parse_ranks(shared.value).items()}
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                stream = Utf8Stream()
                texts.append("".join(stream.feed(token.get(i, b"\xff")) for i in ids or []) + stream.close())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
