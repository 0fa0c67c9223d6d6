import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from levygrid.llm import fingerprints as fp
from tests.llm.frames import LONG, PROSE, ROWS, documents


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate_is_generalised_jaccard():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    pairs = []
    for k in range(400):
        a = [draw.choice(vocabulary[: draw.choice([50, 3000])]) for _ in range(200)]
        b = [w if draw.random() < k / 400 else draw.choice(vocabulary) for w in a]
        pairs.append((" ".join(a), " ".join(b)))
    left, right = (fp.signatures([p[i].encode() for p in pairs]) for i in (0, 1))
    error = (left == right).mean(axis=1) - [jaccard(*p) for p in pairs]
    assert abs(error.mean()) < 0.015 and np.sqrt((error**2).mean()) < 0.07


def test_signature_depends_on_the_text_alone(monkeypatch):
    texts = [t.encode() for t in (PROSE, "", "a", LONG, "x " * 50, "  b\tb\n", "é" * 40)]
    together = fp.signatures(texts)
    assert all((fp.signatures([t])[0] == s).all() for t, s in zip(texts, together))
    assert not together[1].any() and (fp.signatures([b"A  b"]) == fp.signatures([b"a B"])).all()
    monkeypatch.setattr(fp, "_TERMS", 7)
    assert (fp.signatures(texts) == together).all()


def plain_signature(text):
    """The formula of the module's head, term by term and sample by sample."""
    table, best = fp._tables(), {}
    for word, weight in Counter(text.lower().split()).items():
        ((_,), (h,), _) = fp.weighted_terms([word.encode()])
        low, mid, high = int(h) & 4095, int(h) >> 12 & 4095, int(h) >> 24
        for k in range(fp.SAMPLES):
            r = table["r1"][low, k] + table["r2"][mid, k]
            b = table["b1"][low, k] + table["b2"][mid, k]
            b -= np.floor(b)
            t = np.floor(np.float32(np.log(np.float64(weight))) / r + b)
            least = table["c"][high, k] - r * (t - b + 1)
            best[k] = min(best.get(k, (np.inf, "", 0)), (float(least), word, int(t)))
    return [best.get(k, (0, "", 0))[1:] for k in range(fp.SAMPLES)]


def test_signatures_follow_the_formula():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(draw.choice(words[: draw.choice([4, 60])]) for _ in range(draw.choice([1, 30, 300]))) for _ in range(12)]
    got, plain = fp.signatures([t.encode() for t in texts]), [plain_signature(t) for t in texts]
    agree = [
        (got[i] == got[j]).tolist() == [a == b for a, b in zip(plain[i], plain[j])]
        for i in range(12) for j in range(i)
    ]
    # Rounding of float32 may tip a sample whose two least values are next to each other.
    assert sum(agree) >= len(agree) - 2


def test_terms_do_not_depend_on_blocks(monkeypatch):
    texts = [t.encode() for t in (PROSE, "", "a", "x " * 50, "é" * 40, "y" * 700 + " a", " " * 90, PROSE + "z" * 300)]
    whole = fp.weighted_terms(texts)
    monkeypatch.setattr(fp, "_LONG", 1 << 12)
    assert all((a == b).all() for a, b in zip(whole, fp.weighted_terms(texts)))
    monkeypatch.setattr(fp, "_LONG", 64)
    long = fp.weighted_terms(texts)
    for block in (64, 100, 333):
        monkeypatch.setattr(fp, "_BLOCK", block)
        fp._powers.cache_clear()
        assert all((a == b).all() for a, b in zip(long, fp.weighted_terms(texts)))
    fp._powers.cache_clear()


@pytest.mark.parametrize("n", [1024, 2048, 4096, 1 << 19])
def test_doubling_patterns_differ(n):
    a, b = ("".join(y if bin(i).count("1") % 2 else x for i in range(n)) for x, y in ("ab", "ba"))
    one, other, both = fp.signatures([a.encode(), b.encode(), f"{a} {b}".encode()])
    assert (one != other).any() and (one == other).mean() < 0.1
    assert ((both == one) | (both == other)).all()


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_odd_rows(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fp.fingerprints(documents(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(((i, t or "") for i, t, _, _ in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = Counter()
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        changed = t[: len(t) - half] + n[:half]
        own, other, following = fp.signatures([x.encode() for x in (t, changed, n)])
        expected[
            i, len(t), hashlib.sha256(changed.encode()).hexdigest(), fp._text(own), fp._text(other),
            (own == other).mean(), (own == following).mean(),
        ] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_few_rows(spark):
    assert fp.fingerprints(documents(spark, [])).count() == 0
    (one,) = fp.fingerprints(documents(spark, [(5, PROSE, None, None)])).collect()
    assert one["near_next"] == 1.0
