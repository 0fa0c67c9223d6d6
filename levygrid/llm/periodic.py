"""Runs of periodically repeated words, found by joining suffixes in order of their LCP.

Neighbours in the suffix array are united by descending length of their common prefix (LCP), as
Kruskal's algorithm unites nodes by weight: at value L a class holds positions whose suffixes
share L words at least. Classes are ordered sets of positions, and the smaller is merged into
the larger. Two positions that become neighbours there at a distance d within L start a
stretch of L + d words with period d; it is a run if the word before doesn't fit too. The first two
periods' starts of any run with two periods or more become neighbours just so, and a pair at a
multiple of the smallest period never does, as the position one smallest period on is in between.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import let, slices, words_of

#: A run has so many words at least, and so many periods.
MIN_LENGTH = 24
MIN_PERIODS = 3
_TEXT_BYTES = 1 << 20
_CHUNK = 1 << 20
#: ASCII white space.
_WHITE = [*range(9, 14), 32]
_IS_WHITE = np.isin(np.arange(256), _WHITE)
_MIX = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start: long, length: long, period: long>>"


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text in UTF-8 start and end."""
    white = np.ones(len(text) + 2, bool)
    white[1:-1] = _IS_WHITE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(white[1:] != white[:-1])
    return edge[::2], edge[1::2]


def word_numbers(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words; few words are held as objects at a time."""
    seen: dict[bytes, int] = {}
    out = np.empty(len(starts), np.int64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK, "right")))
        words = text[starts[at] : ends[stop - 1]].split()
        out[at:stop] = [seen.setdefault(w, len(seen)) for w in words]
        at = stop
    return out


def shortest_overlap(min_length: int, min_periods: int) -> int:
    """Words that the first two periods' suffixes of any run share at least.

    A run of length n has a period of n / min_periods at most, so they share the rest.
    """
    return min_length - min_length // min_periods


def may_repeat(words: np.ndarray, size: int) -> bool:
    """Whether any two windows of ``size`` words may be equal; False is certain."""
    if len(words) <= size:
        return False
    hashes, held = words.astype(np.uint64) + np.uint64(1), 1
    while held < size:
        step = min(held, size - held)
        hashes = hashes[:-step] * _MIX + (hashes[step:] ^ (hashes[step:] >> np.uint64(29)))
        held += step
    hashes = np.sort(hashes)
    return bool((hashes[1:] == hashes[:-1]).any())


def suffix_array(words: np.ndarray) -> np.ndarray:
    """Suffixes in order, by ranks of windows that double until all differ."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            return order


def common_prefixes(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix lengths of each suffix with the one before it in ``order``."""
    n = len(words)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    text, held = words.tolist(), 0
    out = np.zeros(n, np.int64)
    for i, j in enumerate(before.tolist()):
        if j < 0:
            held = 0
            continue
        top = n - max(i, j)
        while held < top and text[i + held] == text[j + held]:
            held += 1
        out[i] = held
        held = max(0, held - 1)
    return out[order]


def _merged(large: list[int], small: list[int]) -> Iterator[tuple[int, int]]:
    """Merge ``small`` into ``large``, both sorted; pairs that become neighbours."""
    last = len(small) - 1
    pairs = []
    for k, x in enumerate(small):
        at = bisect_left(large, x)
        if at and (k == 0 or small[k - 1] < large[at - 1]):
            pairs.append((large[at - 1], x))
        if at < len(large) and (k == last or small[k + 1] > large[at]):
            pairs.append((x, large[at]))
    if 16 * len(small) > len(large):
        large += small
        large.sort()
    else:
        for x in small:
            insort(large, x)
    return iter(pairs)


def runs(
    words: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, by start, then period.

    A run is a stretch with smallest period q, of ``min_length`` and ``min_periods`` q (two
    periods at least) or more words, that can't be extended with period q.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    floor = max(1, shortest_overlap(min_length, min_periods))
    if len(words) < min_length or not may_repeat(words, floor):
        return []
    order = suffix_array(words)
    shared = common_prefixes(words, order)
    places = np.flatnonzero(shared >= floor)
    places = places[np.argsort(-shared[places], kind="stable")]
    after, before = order[places].tolist(), order[places - 1].tolist()
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        if x not in root:
            root[x], members[x] = x, [x]
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y, lcp in zip(before, after, shared[places].tolist()):
        x, y = find(x), find(y)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        root[y] = x
        for i, j in _merged(members[x], members.pop(y)):
            d = j - i
            if d <= lcp and lcp + d >= max(min_length, min_periods * d):
                if i == 0 or words[i - 1] != words[j - 1]:
                    out.append((i, lcp + d, d))
    return sorted(out, key=lambda run: (run[0], run[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that a run contains after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def collapsed(text: bytes, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> bytes:
    """The kept words joined by one blank."""
    if not keep.any():
        return b""
    data = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(text) + 1, np.int8)
    inside[starts[keep]] = 1
    inside[ends[keep]] -= 1
    # The character behind each kept word is taken too, as its blank.
    take = np.cumsum(inside[:-1], dtype=np.int8) > 0
    blank = ends[keep]
    blank = blank[blank < len(text)]
    take[blank] = True
    data = data.copy()
    data[blank] = 32
    return data[take].tobytes().rstrip(b" ")


def detect(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """(doc_id, runs, collapsed), a row for each row of ``df``.

    ``runs`` are (start, length, period) in words, by start, then period; ``collapsed`` is the
    text without the words that a run contains after its first period, joined by one blank. Null,
    empty and wordless texts have no runs and collapse to "". Null ids stay null, repeated rows
    stay, an empty table gives no rows, and other columns of ``df`` are not read. Nothing is
    shuffled. A text is worked on in whole; beside it a task holds a few numbers for each of
    its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, _TEXT_BYTES):
            found, rest = [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                text = text or b""
                starts, ends = word_spans(text)
                own = runs(word_numbers(text, starts, ends), min_length, min_periods)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                rest.append(collapsed(text, starts, ends, kept_words(len(starts), own)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, kind), pa.array(rest, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema[0].dataType.simpleString()}, runs {RUNS}, collapsed string")


def with_loops(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text column, with the tail of every tenth document (by a checksum of its id) repeated.

    With h the checksum, g its tenth and n words, the words from g mod n on repeat their first
    1 + (n - a) div (3 + g mod 8). Documents with a null id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def looped(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (g % 8 + 3)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i))), " ")

    text = F.col(text_col)
    words = words_of(text)
    chosen = (h % 10 == 0) & (F.size(words) > 0)
    return F.when(chosen, let(words, looped)).otherwise(text)
