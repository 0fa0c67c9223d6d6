"""Ranked lexical search by scanning documents with an automaton of all item terms.

A text is read once, as bytes: separators become blanks and A-Z small, with a blank at both
ends, and an Aho-Corasick automaton counts the terms in it. Every term stands between two blanks
in the automaton, so it never matches inside another term. There is no index of the documents;
what is kept of one are its number of terms and the counts of the item terms it holds.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from levygrid.llm.common import Scratch, slices

TOP = 10
#: Bytes of terms in one automaton (about 100 times that in memory); more make more scans.
TERM_BYTES = 1 << 19
_TEXT_BYTES = 1 << 20
_CELLS = 1 << 21
_NULL = (1 << 63) - 1
#: ASCII characters that separate terms, as the inside of a class.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_FOLD = bytes(
    32 if re.match(f"[{SEPARATORS}]", chr(b)) else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def folded(text: Column) -> Column:
    """The text with A-Z small; other characters stay, whatever their case."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def terms_of(text: Column) -> Column:
    """The terms of a text in order; null has none."""
    parts = F.split(folded(F.coalesce(text, F.lit(""))), f"[{SEPARATORS}]++")
    return F.array_remove(parts, "")


def guarded(text: bytes) -> bytes:
    """The text with blanks for separators and around it, and A-Z small."""
    return b" " + text.translate(_FOLD) + b" "


def term_number(text: bytes) -> int:
    """How many terms a guarded text has: the places where one starts."""
    blank = np.frombuffer(text, np.uint8) == 32
    return int(np.count_nonzero(blank[:-1] & ~blank[1:]))


def automaton(terms: list[str]):
    """Aho-Corasick automaton of guarded terms; its outputs are their positions in ``terms``."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        out.add_word(guarded(term.encode()).decode("latin-1"), number)
    out.make_automaton()
    return out


_BUILT: dict = {}


def _built(key: str, terms: list[str]):
    """The worker's automaton for a broadcast; one is held at a time."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = automaton(terms)
    return _BUILT[key]


def blocks(queries: DataFrame, size: int = TERM_BYTES) -> Iterator[list[tuple[int, Counter]]]:
    """(number, terms with repeats) of items, in blocks of ``size`` bytes of terms.

    The driver holds one block at a time. An item is not divided.
    """
    block: list[tuple[int, Counter]] = []
    held = 0
    for row in queries.where(F.size("terms") > 0).orderBy("number").toLocalIterator():
        terms = Counter(row["terms"])
        length = sum(len(t.encode()) + 2 for t in terms)
        if block and held + length > size:
            yield block
            block, held = [], 0
        block.append((row["number"], terms))
        held += length
    if block:
        yield block


def scanned(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs): a text's number of terms, and which of ``terms`` it holds
    (by position), how often."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, terms))

    @F.arrow_udf("n long, terms array<int>, tfs array<int>")
    def scan(texts: pa.Array) -> pa.Array:
        machine = _built(*shared.value)
        numbers, ends, found, tfs = [], [0], [], []
        for part in slices([pa.RecordBatch.from_arrays([texts], ["t"])], 0, _TEXT_BYTES):
            for text in part.column(0).cast(pa.binary()).to_pylist():
                text = guarded(text or b"")
                numbers.append(term_number(text))
                matches = machine.iter(text.decode("latin-1")) if len(machine) else ()
                counts = Counter(map(itemgetter(1), matches))
                found += counts.keys()
                tfs += counts.values()
                ends.append(len(found))
        bounds = pa.array(ends, pa.int32())
        return pa.StructArray.from_arrays([
            pa.array(numbers, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(found, pa.int32())),
            pa.ListArray.from_arrays(bounds, pa.array(tfs, pa.int32())),
        ], ["n", "terms", "tfs"])

    return docs.select("doc_id", scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The highest scores of each item so far, equal ones by ascending id, nulls last."""

    def __init__(self, items: int, top: int):
        self.heaps: list[list] = [[] for _ in range(items)]
        # What can't enter a full heap: a lower score, or an equal one with a greater id.
        self.least, self.greatest = np.ones(items, np.int64), np.full(items, _NULL)
        self.top = top

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        """``scores`` has a row for each document and a column for each item."""
        order = ids.fill_null(_NULL).to_numpy(False)
        ids = ids.to_pylist()
        equal = (scores == self.least) & (order[:, None] <= self.greatest)
        for row, item in zip(*map(np.ndarray.tolist, np.nonzero((scores > self.least) | equal))):
            score, doc_id, heap = int(scores[row, item]), ids[row], self.heaps[item]
            entry = (score, doc_id is not None, 0 if doc_id is None else -doc_id)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                last = heap[0]
                self.least[item], self.greatest[item] = last[0], -last[2] if last[1] else _NULL

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, known, doc_id in heap:
                yield item, -doc_id if known else None, score


def term_scores(batch: pa.RecordBatch, corpus: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and ``1e9 tf div (1000 tf + 8 m)`` of the terms in scanned documents."""
    documents, total = corpus
    # Python's integers, as the product may need more than 64 bits before it is divided.
    m = [25 + 75 * n * documents // max(1, total) for n in batch.column("n").to_pylist()]
    owner = np.repeat(np.arange(len(m)), batch.column("terms").value_lengths().to_numpy(False))
    term = batch.column("terms").flatten().to_numpy(False)
    tf = batch.column("tfs").flatten().to_numpy(False).astype(np.int64)
    return owner, term, 1_000_000_000 * tf // (1000 * tf + 8 * np.array(m, np.int64)[owner])


def scores(rows: int, parts: tuple, weights: tuple, items: int) -> np.ndarray:
    """Scores, documents by items, in 64-bit integers.

    ``weights`` is a matrix by rows of terms: bounds, items, weights times repeats. Entries
    are expanded in steps, so that they stay bounded.
    """
    owner, term, value = parts
    bounds, item, factor = weights
    fan = bounds[term + 1] - bounds[term]
    after = np.concatenate(([0], np.cumsum(fan)))
    out = np.zeros(rows * items, np.int64)
    start = 0
    while start < len(term):
        stop = max(start + 1, int(np.searchsorted(after, after[start] + _CELLS, "right")) - 1)
        f, own = fan[start:stop], slice(start, stop)
        at = np.arange(int(f.sum())) + np.repeat(bounds[term[own]] - (np.cumsum(f) - f), f)
        cell = np.repeat(owner[own], f) * items + item[at]
        np.add.at(out, cell, np.repeat(value[own], f) * factor[at])
        start = stop
    return out.reshape(rows, items)


def ranked(
    hits: DataFrame, block: list[tuple[int, Counter]], terms: list[str], weights: list[int],
    corpus: tuple[int, int], top: int = TOP,
) -> DataFrame:
    """(number, doc_id, score): each task's ``top`` documents for each item of a block."""
    at = {t: i for i, t in enumerate(terms)}
    entries = sorted((at[t], i, weights[at[t]] * k) for i, (_, own) in enumerate(block) for t, k in own.items())
    term, item, factor = np.array(entries, np.int64).T
    matrix = (np.searchsorted(term, np.arange(len(terms) + 1)), item, factor)
    shared = hits.sparkSession.sparkContext.broadcast(([n for n, _ in block], matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, matrix = shared.value
        best = Best(len(numbers), top)
        step = max(1, _CELLS // len(numbers))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = scores(part.num_rows, term_scores(part, corpus), matrix, len(numbers))
                best.add(found, part.column("doc_id"))
        rows = list(best.rows())
        yield pa.RecordBatch.from_arrays([
            pa.array([numbers[i] for i, _, _ in rows], pa.int64()),
            pa.array([d for _, d, _ in rows], pa.int64()), pa.array([s for _, _, s in rows], pa.int64()),
        ], ["number", "doc_id", "score"])

    return hits.mapInArrow(run, "number long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, size: int = TERM_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``items``.

    Items are taken in blocks whose terms have ``size`` bytes together, and each block scans
    all documents, so any number of items will do; only a single item's own terms must
    fit an automaton. Of a block, the driver gets the number of documents and of their terms, and
    how many documents hold each term. Each task keeps ``top`` documents an item; nothing
    else of the documents is shuffled.

    Null texts have no terms; items without a term, and documents that hold none of an item's
    terms, give no rows, and so do empty tables. Equal scores go by ascending id, null ids last.
    Repeated rows are documents (or items) each. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    queries = scratch.write(items.select(
        F.monotonically_increasing_id().alias("number"), F.col(item_col).alias("item_id"),
        terms_of(F.col(item_text_col)).alias("terms"),
    ))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], "number long, doc_id long, score long")
    for block in blocks(queries, size):
        terms = sorted({t for _, own in block for t in own})
        hits = scratch.write(scanned(narrow, terms))
        total = hits.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = dict(
            hits.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator()
        )
        weights = [weight(total[0], holding.get(i, 0)) for i in range(len(terms))]
        found = found.unionByName(ranked(hits, block, terms, weights, tuple(total), top))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(queries.select("number", "item_id"), "number").select(
        "item_id", "rank", "doc_id", "score"
    )
