"""Token counts of texts by a two-tier look-up of pre-token lengths.

A pre-token is a run of blanks with the characters after it, or a line break with the
characters after it. No piece of the vocabulary reaches over its bounds, so a text has as many
tokens as its pre-tokens. The first tier is a compact table of frequent pre-tokens, which is
broadcast; the second is a cache in each worker, filled by the library itself. Nothing but the
rows of a bounded sample is shuffled, and the sample only decides what is looked up and what
is encoded: every text is counted in whole.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import slices

#: Token limit of the query's ``over_limit``.
LIMIT = 4096
#: Expected rows of the sample that finds frequent pre-tokens, and the tasks that count it.
SAMPLE_ROWS = 4096
SAMPLE_TASKS = 8
#: The broadcast table has at most so many pre-tokens of at most so many characters: 10 MiB.
ENTRIES = 1 << 15
ENTRY_CHARS = 64
#: A worker forgets what it has met beyond the table when it holds so many more entries.
CACHED = 1 << 19
_TEXT_BYTES = 1 << 20
_CHUNK = 1 << 20
#: A longer pre-token is cut between characters that stand together in no piece.
_LONG = 1 << 14
_BLANK = "▁"


class PieceCounter:
    """Counts tokens as a ``sentencepiece`` model's library does; see ``splits``."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(len(self.model))]
        inside = {c for p in self.pieces if len(p) > 1 and not self._special(p) for c in p}
        self.splits = self._splits()
        breaks = "".join(c for c in "\n\r\t" if self.splits and c not in inside)
        self.guard = breaks[:1]
        self.pattern = re.compile(f" +[^ {breaks}]*|[{breaks}][^ {breaks}]*" if breaks else " +[^ ]*")
        self.start = re.compile("(?<=[^ ]) ")

    def _special(self, piece: str) -> bool:
        at = self.model.piece_to_id(piece)
        return self.model.is_control(at) or self.model.is_unknown(at) or self.model.is_byte(at)

    def _splits(self) -> bool:
        """Whether counts of pre-tokens add up: characters are taken as they are, a blank
        is put before a text, and blanks stand in pieces at the front only."""
        every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)])).replace(_BLANK, "")
        plain = self.model.normalize(f" {every}  ") == f"  {every}  ".replace(" ", _BLANK)
        return plain and not any(_BLANK in p.lstrip(_BLANK) for p in self.pieces)

    @functools.cached_property
    def pairs(self) -> set[str]:
        return {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}

    def encoded(self, text: str) -> int:
        return len(self.model.encode(text))

    def length(self, pre_token: str) -> int:
        """Tokens of one pre-token with its leading blank or line break."""
        if len(pre_token) > _LONG and self.guard:
            return self._long(pre_token)
        if pre_token == " ":
            return 1
        if pre_token[0] == " ":
            return self.encoded(pre_token[1:])
        return self.encoded(pre_token) - 1  # without the blank that is put before a text

    def _long(self, pre_token: str) -> int:
        shown = pre_token.replace(" ", _BLANK)
        total, start = 0, 0
        while start < len(shown):
            end = min(start + _LONG, len(shown))
            while end < len(shown) and shown[end - 1 : end + 1] in self.pairs:
                end += 1
            # Behind a character that merges with nothing, a part is encoded as it stands.
            total += self.encoded(self.guard + shown[start:end]) - 2
            start = end
        return total

    def chunks(self, text: str) -> Iterator[str]:
        """Parts of a text with its leading blank, cut where a run of blanks starts."""
        text = " " + text.replace(_BLANK, " ")
        start = 0
        while start < len(text):
            found = self.start.search(text, start + _CHUNK)
            end = found.start() if found else len(text)
            yield text[start:end]
            start = end

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        return (self.pattern.findall(chunk) for chunk in self.chunks(text))


class Lengths(dict):
    """Tokens by pre-token: the frequent ones, and those a worker has met."""

    def __init__(self, counter: PieceCounter, frequent: dict[str, int], cached: int = CACHED):
        super().__init__(frequent)
        self.counter, self.frequent, self.room = counter, frequent, cached + len(frequent)

    def __missing__(self, pre_token: str) -> int:
        n = self.counter.length(pre_token)
        if len(pre_token) <= ENTRY_CHARS:
            if len(self) >= self.room:
                self.clear()
                self.update(self.frequent)
            self[pre_token] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.counter.splits:
            return self.counter.encoded(text)
        return sum(sum(map(self.__getitem__, part)) for part in self.counter.pre_tokens(text))


def packed(lengths: dict[str, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The table as it is broadcast: keys end to end, their bounds, their token counts."""
    keys = [key.encode() for key in lengths]
    ends = np.cumsum(np.fromiter(map(len, keys), np.int64, len(keys))).astype(np.uint32)
    return b"".join(keys), ends, np.fromiter(lengths.values(), np.uint16, len(keys))


def unpacked(table: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    keys, ends, counts = table
    bounds = [0, *ends.tolist()]
    names = (keys[a:b].decode() for a, b in zip(bounds, bounds[1:]))
    return dict(zip(names, counts.tolist()))


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


_OPEN: dict = {}


def _lengths(path: str, key: str, table: tuple) -> Lengths:
    """The worker's look-up for a broadcast table; one is held at a time."""
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Lengths(_counter(path), unpacked(table))
    return _OPEN[key]


def _texts(column: pa.Array) -> list[str]:
    raw = column.cast(pa.binary()).to_pylist()
    return [(b or b"").decode("utf-8", "replace") for b in raw]


def frequent(
    df: DataFrame, model: str, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, entries: int = ENTRIES
) -> dict[str, int]:
    """Token counts of frequent pre-tokens of about ``sample_rows`` rows.

    The sampled rows are dealt to ``SAMPLE_TASKS`` tasks; each sends its ``entries`` most
    frequent pre-tokens to the driver, so that this is bounded whatever the table's size.
    An empty table gives an empty dictionary.
    """
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text") != "")
    n = texts.count()
    if not n:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = _counter(model), Counter()
        for part in slices(batches, 0, _TEXT_BYTES):
            for text in _texts(part.column(0)):
                for tokens in counter.pre_tokens(text):
                    seen.update(tokens)
            if len(seen) > 8 * entries:
                seen = Counter(dict(seen.most_common(4 * entries)))
        top = [(k, m) for k, m in seen.most_common(entries) if len(k) <= ENTRY_CHARS and m > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in top], pa.string()), pa.array([m for _, m in top], pa.int64()),
             pa.array([counter.length(k) for k, _ in top], pa.int64())], ["key", "n", "tokens"])

    sample = texts.sample(min(1.0, sample_rows / n), seed=11).repartition(SAMPLE_TASKS)
    total, tokens = Counter(), {}
    for row in sample.mapInArrow(count, "key string, n long, tokens long").toLocalIterator():
        total[row["key"]] += row["n"]
        tokens[row["key"]] = row["tokens"]
    return {key: tokens[key] for key, _ in total.most_common(entries)}


def token_count(df: DataFrame, model: str, table: dict[str, int], text_col: str = "text") -> Column:
    """Tokens of the text column as a long; null and empty texts have none.

    ``table`` (see ``frequent``) is broadcast; it has a proven bound of ``ENTRIES`` keys. It
    may be empty: then workers encode all they meet themselves.
    """
    shared = df.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, packed(table)))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        lengths = _lengths(model, *shared.value)
        batch = pa.RecordBatch.from_arrays([texts], ["t"])
        parts = slices([batch], 0, _TEXT_BYTES)
        return pa.array([lengths.count(t) for p in parts for t in _texts(p.column(0))], pa.int64())

    return count(F.col(text_col))


def token_counts(
    df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each row of ``df``.

    Tokens are those the library gives for ``model``, a ``sentencepiece`` file that every
    executor must be able to open, without begin or end tokens; strings of special tokens
    inside texts are ordinary text. Null and empty texts have 0 bytes and tokens; bytes that
    are no UTF-8 count as the replacement character. Null ids stay null, repeated rows stay,
    an empty table gives no rows, and other columns of ``df`` are not read, whatever
    their names. A very long text is cut into chunks at blanks, a very long pre-token at
    characters that no piece joins; only a run that no such place divides, like
    one letter repeated, goes to the library whole. Models whose pre-tokens don't add up
    (they change characters, or have pieces over blanks) encode whole texts.
    """
    if _counter(model).splits:
        table = frequent(df, model, text_col, sample_rows)
    else:
        table = {}
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(df, model, table, text_col).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
