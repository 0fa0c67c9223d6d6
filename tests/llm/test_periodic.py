import hashlib
import random
import zlib

import numpy as np
import pytest

from levygrid.llm import periodic, queries
from tests.llm.frames import LONG, ROWS, documents, rows_of


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute(words, min_length, min_periods):
    """Every stretch, by the definition."""
    out, n = set(), len(words)
    for q in range(1, n // min_periods + 1):
        same = [i + q < n and words[i] == words[i + q] for i in range(n)]
        i = 0
        while i < n:
            j = i
            while j < n and same[j]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_periods * q):
                if smallest_period(words[i : i + length]) == q:
                    out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def draws(seed, count, longest):
    draw = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < longest:
            part = [draw.randrange(draw.choice([2, 3, 40])) for _ in range(draw.randint(1, 9))]
            words += part * draw.choice([1, 1, 2, 5, 12])
            if words and draw.random() < 0.3:
                words += words[draw.randrange(len(words)) :]
        yield words[: draw.randint(0, longest)]


@pytest.mark.parametrize("min_length, min_periods", [(24, 3), (6, 2), (2, 2), (9, 4)])
def test_against_the_definition(min_length, min_periods):
    found = 0
    for words in draws(min_length, 150, 120):
        got = periodic.runs(np.array(words, np.int64), min_length, min_periods)
        assert got == brute(words, min_length, min_periods)
        found += len(got)
    assert found > 50


def test_long_sequences():
    period = list(range(7))
    words = list(range(100, 30_000)) + period * 5_000 + list(range(50_000, 60_000))
    assert periodic.runs(np.array(words)) == [(29_900, 35_000, 7)]
    assert periodic.runs(np.zeros(40_000, np.int64)) == [(0, 40_000, 1)]
    phrase = list(range(20))
    spread = [x for i in range(400) for x in [*phrase, 1000 + i]]
    assert periodic.runs(np.array(spread)) == []
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(40, np.int64), 24, 1)


@pytest.mark.parametrize("text", ["", " ", "a", " a\t b\n", "ä b \x1c c", LONG])
def test_words(text):
    raw = text.encode()
    starts, ends = periodic.word_spans(raw)
    words = raw.split()
    assert [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())] == words
    numbers = periodic.word_numbers(raw, starts, ends)
    assert [numbers.tolist().index(n) for n in numbers[:50]] == [words.index(w) for w in words[:50]]
    keep = np.arange(len(words)) % 3 > 0
    assert periodic.collapsed(raw, starts, ends, keep) == b" ".join(w for w, k in zip(words, keep) if k)


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "_CHUNK", 3)
    raw = b"aa bb aa c aaaaaa bb"
    assert periodic.word_numbers(raw, *periodic.word_spans(raw)).tolist() == [0, 1, 0, 2, 3, 1]


def looped(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = looped(doc_id, text)
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = brute([index[w] for w in words], 24, 3)
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    lines = b"".join(b"%d,%d,%d\n" % run for run in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return doc_id, len(found), *four, digest(lines), digest(kept)


def test_query(spark, tmp_path):
    prose = " ".join(f"w{i % 61}x{i % 7}" for i in range(400))
    rows = [(i, prose if i % 3 else " \t" + prose[: 40 * i] + "\n", None, None) for i in range(120)]
    rows += [(1000 + i, "ha " * i, None, None) for i in (7, 23, 24, 25, 200)]
    rows += [r for r in ROWS if r[1] != LONG]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == names
    want = sorted((expected(i, t) for i, t, _, _ in rows), key=repr)
    assert rows_of(got, *names) == want
    assert sum(r[1] for r in want) > 10


def test_operator_on_odd_rows(spark):
    got = rows_of(periodic.detect(documents(spark)), "doc_id", "runs", "collapsed")
    assert len(got) == len(ROWS)
    by_id = {i: (r, c) for i, r, c in got}
    assert by_id[4] == by_id[5] == by_id[6] == ([], "")
    assert [tuple(r) for r in by_id[7][0]] == [(0, 30_000, 997)]
    assert by_id[7][1] == " ".join(LONG.split()[:997])
    assert periodic.detect(documents(spark, [])).count() == 0
