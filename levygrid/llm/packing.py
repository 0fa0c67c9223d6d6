"""Packing documents into sequences of tokens by best-fit decreasing."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from levygrid.llm.bytebpe import Encoder
from levygrid.llm.common import slices

CAPACITY = 1024
END_OF_DOCUMENT = 0
#: Rests of documents that are packed together; bounds a task's memory.
BLOCK = 1 << 16
#: Ids held at a time, some thousand windows' worth.
HELD_IDS = 1 << 22
_TEXT_BYTES = 1 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_length long"
)


class Windows:
    """Open windows in a segment tree over remaining capacities.

    A leaf holds the open windows with that many free places, an inner node the greatest
    capacity with any window below it. The tightest window for a piece is the first
    non-empty leaf at or right of its length, found in one way up and down the tree.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.capacity = capacity
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = [False] * (2 * self.size)
        self.count = 0

    def _mark(self, room: int) -> None:
        node, value = self.size + room, bool(self.open[room])
        while node and self.filled[node] != value:
            self.filled[node] = value
            node //= 2
            value = node > 0 and (self.filled[2 * node] or self.filled[2 * node + 1])

    def _tightest(self, length: int) -> int | None:
        node = self.size + length
        if self.filled[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece; a new window only if no open one has room."""
        room = self._tightest(length)
        if room is None:
            room, window = self.capacity, self.count
            self.count += 1
        else:
            window = self.open[room].pop()
            self._mark(room)
        if room > length:
            self.open[room - length].append(window)
            self._mark(room - length)
        return window, self.capacity - room


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; longest first, ties in input order."""
    windows = Windows(capacity)
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        window[i], offset[i] = windows.place(int(lengths[i]))
    return window, offset


def _padded(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequences are padded to the capacity, except at a power of two."""
    return np.where(lengths & (lengths - 1) == 0, lengths, capacity)


def _pack(ids: list, documents: list[np.ndarray], first: int, capacity: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a block of documents; sequences are numbered from ``first``."""
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    full, rest = sizes // capacity, sizes % capacity
    pieces = full + (rest > 0)
    owner = np.repeat(np.arange(len(documents)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = number * capacity
    length = np.minimum(capacity, sizes[owner] - start)
    whole = length == capacity
    window, offset = np.empty(len(owner), np.int64), np.zeros(len(owner), np.int64)
    window[whole] = np.arange(whole.sum())
    window[~whole], offset[~whole] = best_fit_decreasing(length[~whole], capacity)
    window[~whole] += whole.sum()
    used = int(window.max()) + 1 if len(window) else 0
    filled = np.bincount(window, length, used).astype(np.int64)
    crc = [zlib.crc32(documents[o][s : s + n]) for o, s, n in zip(owner.tolist(), start.tolist(), length.tolist())]
    columns = [
        pa.array([ids[o] for o in owner.tolist()], pa.int64()), pa.array(start), pa.array(length),
        pa.array(crc, pa.int64()), pa.array(sizes[owner]), pa.array(window + first), pa.array(offset),
        pa.array(_padded(filled, capacity)[window]),
    ]
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names), used


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, block: int = BLOCK,
) -> DataFrame:
    """A row for each piece of a document; see ``SCHEMA``.

    ``vocabulary`` is the file of a byte-level BPE tokenizer, which every executor must be
    able to open. A document's ids end with id 0; a null or empty text is that id alone. Overlong
    documents are cut into full windows; what remains is packed best-fit decreasing
    among the documents read together, ``block`` or ``HELD_IDS`` ids of them. Nothing is
    shuffled: a task packs what it reads and numbers its sequences after its partition, so a
    repeated task gives the same rows and a hot key means nothing.
    A null id stays null; repeated rows are packed each. Other columns of ``df`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(vocabulary)
        first = TaskContext.get().partitionId() << 40
        ids: list = []
        documents: list[np.ndarray] = []
        held = 0
        for batch in slices(batches, 1, _TEXT_BYTES):
            ids += batch.column(0).to_pylist()
            for tokens in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                document = np.append(tokens, np.uint32(END_OF_DOCUMENT)).astype("<u4")
                documents.append(document)
                held += len(document)
            if len(documents) >= block or held >= HELD_IDS:
                out, used = _pack(ids, documents, first, capacity)
                yield out
                first, ids, documents, held = first + used, [], [], 0
        if documents:
            yield _pack(ids, documents, first, capacity)[0]

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, SCHEMA)
