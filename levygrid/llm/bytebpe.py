"""Fast encoding with a byte-level BPE vocabulary: pieces are encoded once and looked up.

The tokenizer splits a text into pieces (a word with the blank before it, a number, a run
of signs or of white space) and merges bytes inside a piece only. Pieces repeat,
so a task finds their bounds for a whole batch at once, hashes them to 64 bits, and looks
the ids up in a table; only pieces not met before are merged. The table keeps the pieces, and every
piece found is compared with its entry, so no result rests on a hash. Texts with anything whose
character class could differ between Unicode versions, with a special token's string, with a piece
that hashes like another one, or with more different pieces than the table holds, go through the
tokenizer itself, so the ids are always the tokenizer's.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

#: Code points from here on, and those of ``_SCRIPTS``, take the slow way.
_LIMIT = 0x2100
_SCRIPTS = range(0x0590, 0x1E00)
_SPACE, _LETTER, _NUMBER, _SIGN, _UNSURE = range(5)
#: White space of the tokenizer's splitting pattern.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]
#: Endings that the splitting pattern detaches with their apostrophe.
_ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

_CHUNK = 1 << 18
_SLOTS = 1 << 21
_ENTRIES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _classes() -> np.ndarray:
    out = np.full(_LIMIT + 1, _UNSURE, np.uint8)
    for point in range(_LIMIT):
        kind = unicodedata.category(chr(point))
        if point in _WHITE:
            out[point] = _SPACE
        elif point not in _SCRIPTS and kind != "Cn":
            out[point] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _SIGN)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def piece_starts(points: np.ndarray, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a piece starts; ``first`` marks the first character of each text."""
    n = len(points)
    start = first.copy()
    start[1:] |= classes[1:] != classes[:-1]
    if n < 2:
        return start
    space = classes == _SPACE
    # The last white space before something else is no part of the run before it; a blank
    # belongs to what follows.
    before = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
    start[before] = True
    start[before[points[before] == 32] + 1] = False
    quotes = np.flatnonzero((points == 39) & start)
    for ending in _ENDINGS:
        at = quotes[quotes + len(ending) < n]
        for k, letter in enumerate(ending, 1):
            at = at[(points[at + k] == ord(letter)) & ~first[at + k]]
        start[at + 1] = False
        rest = at + len(ending) + 1
        rest = rest[rest < n]
        start[rest[classes[rest] == _LETTER]] = True
    return start


class Encoder:
    """Encodes texts as the tokenizer of a ``tokenizers`` file does, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.classes = _classes()
        self.merge = self._merger(spec)
        self.values = _mixed(np.arange(1, _LIMIT + 2, dtype=np.uint64) * np.uint64(_BASE))
        self.powers = self.inverses = np.ones(1, np.uint64)
        self._clear()

    def _merger(self, spec: dict):
        """A function from a piece to ids; None if the file isn't plain byte-level BPE."""
        import tiktoken

        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model.get("type", "BPE") == "BPE" and not spec.get("normalizer")
            and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
            and split.get("use_regex", True) and not model.get("ignore_merges")
        )
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        vocab = model.get("vocab", {})
        ranks = [vocab.get(a + b, -1) for a, b in merges] if plain else []
        if not plain or any(y <= x for x, y in zip(ranks, ranks[1:])):
            return None
        # Bytes that can't be shown stand at 256 and up, in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = set(self.special)
        table = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding(
            "pieces", pat_str=r"(?s:.+)", mergeable_ranks=table, special_tokens={}
        ).encode_ordinary

    def _clear(self) -> None:
        self.keys = np.zeros(_SLOTS, np.uint64)
        self.entry = np.zeros(_SLOTS, np.int32)
        self.offsets = np.zeros(_ENTRIES * 2, np.int64)
        self.counts = np.zeros(_ENTRIES * 2, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.places = np.zeros(_ENTRIES * 2, np.int64)
        self.lengths = np.zeros(_ENTRIES * 2, np.int64)
        self.pieces = np.zeros(1 << 16, np.uint16)
        self.entries = self.used = self.written = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        group: list[str] = []
        held = 0
        for text in texts:
            if held and held + len(text) > _CHUNK:
                out += self._encode(group)
                group, held = [], 0
            group.append(text)
            held += len(text)
        return out + self._encode(group) if group else out

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.merge is None:
            return [self._slow(t) for t in texts]
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, np.uint32)] * len(texts)
        points = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), _LIMIT)
        classes = self.classes[points]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = np.concatenate(([0], ends[:-1]))
        unsure = np.concatenate(([0], np.cumsum(classes == _UNSURE)))
        slow = unsure[ends] > unsure[starts]
        slow |= np.array([any(s in t for s in self.special) for t in texts])
        if slow.any():
            fast = iter(self._encode([t for t, s in zip(texts, slow) if not s]))
            return [self._slow(t) if s else next(fast) for t, s in zip(texts, slow)]
        first = np.zeros(len(points), bool)
        first[starts[starts < len(points)]] = True
        begin = np.flatnonzero(piece_starts(points, classes, first))
        end = np.append(begin[1:], len(points))
        hashes = self._hashes(points, begin, end)
        found = self._lookup(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, where = np.unique(hashes[missing], return_index=True)
            where = missing[where]
            if self.entries + len(new) > len(self.keys) // 2:
                return self._crowded(texts)
            spans = list(zip(begin[where].tolist(), end[where].tolist()))
            self._keep(points, begin[where], end[where])
            self._insert(new, [self.merge(joined[a:b]) for a, b in spans])
            found[missing] = self._lookup(hashes[missing])
        unlike = self._unlike(found, points, begin, end)
        counts = self.counts[found].astype(np.int64)
        after = np.cumsum(counts)
        total = int(after[-1])
        at = np.arange(total) + np.repeat(self.offsets[found] - (after - counts), counts)
        tokens = self.ids[at]
        bounds = np.concatenate(([0], after))
        left = bounds[np.searchsorted(begin, starts)]
        right = bounds[np.searchsorted(begin, ends)]
        out = [tokens[a:b] for a, b in zip(left.tolist(), right.tolist())]
        for i in np.unique(np.searchsorted(ends, begin[unlike], side="right")).tolist():
            out[i] = self._slow(texts[i])
        if self.entries > _ENTRIES:
            self._clear()
        return out

    def _crowded(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts with more new pieces than the table has room for."""
        if self.entries:
            self._clear()
            return self._encode(texts)
        if len(texts) > 1:
            return [ids for t in texts for ids in self._encode([t])]
        return [self._slow(texts[0])]

    def _hashes(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of pieces, as differences of running sums of characters times powers."""
        n = len(points)
        if len(self.powers) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            self.powers, self.inverses = np.full((2, n + 1), [[_BASE], [inverse]], np.uint64)
            self.powers[0] = self.inverses[0] = 1
            self.powers, self.inverses = np.cumprod(self.powers), np.cumprod(self.inverses)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[points] * self.powers[:n], out=sums[1:])
        hashes = (sums[end] - sums[begin]) * self.inverses[begin]
        hashes = _mixed(hashes + (end - begin).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        return np.maximum(hashes, np.uint64(1))  # 0 marks a free slot.

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        mask = np.uint64(_SLOTS - 1)
        pending, slot = np.arange(len(hashes)), hashes & mask
        while len(pending):
            key = self.keys[slot]
            hit = key == hashes[pending]
            out[pending[hit]] = self.entry[slot[hit]]
            further = ~hit & (key != 0)
            pending, slot = pending[further], (slot[further] + np.uint64(1)) & mask
        return out

    def _keep(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Keep the characters of the pieces that the next entries stand for."""
        lengths = end - begin
        after = np.cumsum(lengths)
        size, count = int(after[-1]), len(lengths)
        while self.written + size > len(self.pieces):
            self.pieces = np.concatenate([self.pieces, np.zeros_like(self.pieces)])
        while self.entries + count > len(self.places):
            self.places = np.concatenate([self.places, np.zeros_like(self.places)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        at = np.arange(size) + np.repeat(begin - (after - lengths), lengths)
        self.pieces[self.written : self.written + size] = points[at]
        new = slice(self.entries, self.entries + count)
        self.lengths[new] = lengths
        self.places[new] = self.written + after - lengths
        self.written += size

    def _unlike(self, found: np.ndarray, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that differ from the entry found for their hash."""
        lengths = end - begin
        wrong = self.lengths[found] != lengths
        at = np.arange(len(points)) + np.repeat(self.places[found] - begin, lengths)
        same = self.pieces.take(at, mode="clip") == points
        if not same.all():
            wrong |= np.logical_or.reduceat(~same, begin)
        return np.flatnonzero(wrong)

    def _insert(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        size = sum(map(len, ids))
        while self.used + size > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.entries + len(ids) > len(self.counts):
            self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        new = slice(self.entries, self.entries + len(ids))
        self.counts[new] = lengths
        self.offsets[new] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + size] = [i for piece in ids for i in piece]
        mask = np.uint64(_SLOTS - 1)
        pending, slot = np.arange(len(hashes)), hashes & mask
        while len(pending):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[pending[free]]
            placed = self.keys[slot] == hashes[pending]
            self.entry[slot[placed]] = self.entries + pending[placed]
            pending, slot = pending[~placed], (slot[~placed] + np.uint64(1)) & mask
        self.entries += len(ids)
        self.used += size
