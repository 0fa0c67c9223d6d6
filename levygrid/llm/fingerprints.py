"""Document fingerprints by consistent weighted sampling.

Terms are words, weighted by their number in the text. For each sample and term, gamma-
distributed variables r and c and a uniform b follow from the term alone; a term of weight S
has t = floor(ln S / r + b) and ln a = ln c - r (t - b + 1), and the sample is
the (term, t) of least a. Two texts agree in a sample with a probability equal to their generalised
Jaccard similarity: the sum of the lesser weights over the sum of the greater.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from levygrid.llm.common import slices

SAMPLES = 64
SEED = 42
_BASE = 0x9E3779B97F4A7C15
_PRIME = (1 << 31) - 1
_BASES = [1_203_459_911, 764_082_217]
#: Words are hashed in blocks of this size; words from ``_LONG`` bytes on by a digest.
_BLOCK = 1 << 18
_LONG = 1 << 12
_WHITE = [bytes([c]) for c in (*range(9, 14), 32)]
_WHITE_SPACE = re.compile(rb"[ \t-\r]")
_GROUP = 1 << 20
_TERMS = 1024
_LEAST = -(1 << 63)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


@functools.cache
def _tables() -> dict[str, np.ndarray]:
    """Random variables by parts of a term's hash.

    r is gamma(2, 1) as the sum of two exponentials and b the fractional part of a
    sum of two uniforms, each looked up by 12 bits; ln c is looked up by 16 bits. No
    function is evaluated at run time, so that all machines round alike.
    """
    draw = np.random.Generator(np.random.PCG64(SEED))
    part, whole = (1 << 12, SAMPLES), (1 << 16, SAMPLES)
    return {
        "r1": draw.standard_exponential(part).astype(np.float32),
        "r2": draw.standard_exponential(part).astype(np.float32),
        "b1": draw.random(part).astype(np.float32),
        "b2": draw.random(part).astype(np.float32),
        "c": np.log(draw.standard_gamma(2.0, whole)).astype(np.float32),
        "byte": draw.integers(1, _PRIME, 256, np.uint64),
    }


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the two bases and of their inverses, modulo ``_PRIME``, by doubling."""
    out = np.ones((2, len(_BASES), n), np.uint64)
    for i, bases in enumerate((_BASES, [pow(b, -1, _PRIME) for b in _BASES])):
        for j, base in enumerate(bases):
            done = 1
            while done < n:
                more = min(done, n - done)
                out[i, j, done : done + more] = out[i, j, :more] * np.uint64(pow(base, done, _PRIME)) % np.uint64(_PRIME)
                done += more
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _digest(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word: two polynomials modulo a prime; digests of long words."""
    raw = np.frombuffer(data, np.uint8)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    if len(raw) > _BLOCK:  # a single word
        return start, np.array([_digest(data[start[0] : end[0]])], np.uint64)
    powers, inverses = _powers(_BLOCK)
    prime, values = np.uint64(_PRIME), _tables()["byte"][raw]
    hashes = np.zeros(len(start), np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    for power, inverse in zip(powers, inverses):
        # Below 2**32 after one fold, so the sums of a block can't overflow.
        product = values * power[: len(raw)]
        np.cumsum((product & prime) + (product >> np.uint64(31)), out=sums[1:])
        part = (sums[end] - sums[start]) % prime * inverse[start] % prime
        hashes = (hashes << np.uint64(31)) | part
    hashes = _mixed(_mixed(hashes) + (end - start).astype(np.uint64) * np.uint64(_BASE))
    for i in np.flatnonzero(end - start >= _LONG).tolist():
        hashes[i] = _digest(data[start[i] : end[i]])
    return start, hashes


def _blocks(data: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of blocks that end at white space; a word longer than a block is one of its own."""
    at = 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            cut = max(data.rfind(space, at + 1, end) for space in _WHITE)
            if cut < 0:
                found = _WHITE_SPACE.search(data, end)
                cut = found.start() if found else len(data)
                if data[at] in b"".join(_WHITE):
                    cut = at + 1
            end = cut
        yield at, min(end, len(data))
        at = end


def weighted_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, 40-bit hash and weight of each term, by document and hash.

    Works on blocks, of which only the different terms are held, so the memory a text takes beyond its own
    bytes grows with its vocabulary.
    """
    data = b" ".join([t.lower() for t in texts])
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    keys, weights = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, end in _blocks(data):
        start, hashes = _word_hashes(data[at:end])
        owner = np.searchsorted(ends, start + at, side="right").astype(np.uint64)
        key, weight = np.unique((owner << np.uint64(40)) | (hashes >> np.uint64(24)), return_counts=True)
        keys.append(key)
        weights.append(weight)
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.zeros(len(key), np.int64)
    np.add.at(weight, which, np.concatenate(weights))
    return (key >> np.uint64(40)).astype(np.int64), key & np.uint64((1 << 40) - 1), weight


def signatures(texts: list[bytes]) -> np.ndarray:
    """16-bit codes of the samples, a row for each text; zeros if it has no word."""
    table = _tables()
    owner, term, weight = weighted_terms(texts)
    best = np.full((len(texts), SAMPLES), np.inf, np.float32)
    codes = np.zeros((len(texts), SAMPLES), np.uint16)
    sample = np.arange(SAMPLES)
    salt = sample.astype(np.uint64) * np.uint64(_BASE)
    log_weight = np.log(weight.astype(np.float64)).astype(np.float32)
    for at in range(0, len(term), _TERMS):
        h = term[at : at + _TERMS]
        low, mid, high = h & np.uint64(4095), (h >> np.uint64(12)) & np.uint64(4095), h >> np.uint64(24)
        r = table["r1"].take(low, axis=0)
        r += table["r2"].take(mid, axis=0)
        b = table["b1"].take(low, axis=0)
        b += table["b2"].take(mid, axis=0)
        b -= np.floor(b)
        # A term that occurs once has t = 0.
        several = np.flatnonzero(log_weight[at : at + _TERMS])
        t = np.floor(log_weight[at + several, None] / r[several] + b[several])
        np.subtract(1, b, out=b)
        b[several] += t
        b *= r
        value = np.subtract(table["c"].take(high, axis=0), b, out=b)
        times = np.zeros((len(h), SAMPLES), np.int16)
        times[several] = t
        mine = owner[at : at + _TERMS]
        cut = np.append(np.flatnonzero(np.diff(mine, prepend=-1)), len(mine))
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
            d = int(mine[s])
            i = value[s:e].argmin(axis=0) + s
            least = value[i, sample]
            better = least < best[d]
            code = _mixed(h[i] + times[i, sample].astype(np.int64).astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + salt)
            codes[d] = np.where(better, code >> np.uint64(48), codes[d])
            best[d] = np.where(better, least, best[d])
    return codes


def _text(code: np.ndarray) -> str:
    return code.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
    texts = [t for _, t in rows]
    changed = [edited(a, b) for a, b in zip(texts, [*texts[1:], following])]
    raw = [t.encode("utf-8", "surrogatepass") for t in changed]
    own = signatures([t.encode("utf-8", "surrogatepass") for t in [*texts, following]])
    other = signatures(raw)
    columns = [
        pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in raw]),
        pa.array(map(_text, own[:-1]), pa.string()), pa.array(map(_text, other), pa.string()),
        pa.array((own[:-1] == other).mean(axis=1)), pa.array((own[:-1] == own[1:]).mean(axis=1)),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, and after them the row that follows the last of this partition."""
    group: list[tuple[int | None, str]] = []
    held = 0
    for batch in slices(batches, 1, _GROUP):
        for doc_id, text, ahead in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if group and (ahead or held > _GROUP):
                yield _compared(group, text)
                group, held = [], 0
            if ahead:
                return
            group.append((doc_id, text))
            held += len(text)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and likenesses; see ``SCHEMA``.

    Rows are ordered by id (null first, equal ids by text); after the last comes the first. Null
    is an empty text, and a text without words has a fingerprint of zeros. Repeated rows stay.
    The texts are shuffled once, to ranges of ids whose bounds are quantiles of the
    ids; the first row of each range is also sent to the range before. Ids should be distinct, as
    rows of one id are neighbours and so in one range. Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        key.alias("key"),
    )
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.approxQuantile("key", shares, 0.25 / ranges) if shares else []
    bounds = np.unique(np.array(bounds, np.float64))

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        at = np.searchsorted(bounds, keys.to_numpy(False).astype(np.float64), side="right")
        return pa.array(at.astype(np.int32))

    placed = rows.withColumn("part", place("key"))
    found = placed.groupBy("part").agg(F.min("key").alias("first")).orderBy("part").collect()
    parts = np.array([r["part"] for r in found], np.int32)
    firsts, before = np.array([r["first"] for r in found], np.int64), np.roll(parts, 1)

    @F.arrow_udf("int")
    def earlier(keys: pa.Array) -> pa.Array:
        keys = keys.to_numpy(False)
        at = np.minimum(np.searchsorted(firsts, keys), max(0, len(firsts) - 1))
        hit = firsts[at] == keys if len(firsts) else np.zeros(len(keys), bool)
        return pa.array(before[at] if len(firsts) else np.zeros(len(keys), np.int32), pa.int32(), mask=~hit)

    targets = F.array_compact(F.array(
        F.struct(F.col("part").alias("to"), F.lit(False).alias("ahead")),
        F.when(F.col("back").isNotNull(), F.struct(F.col("back").alias("to"), F.lit(True).alias("ahead"))),
    ))
    return (
        placed.withColumn("back", earlier("key"))
        .withColumn("target", F.explode(targets))
        .select("doc_id", "text", "target.ahead", "key", F.col("target.to").alias("to"))
        .repartitionById(max(1, ranges), F.col("to"))
        .sortWithinPartitions("ahead", "key", "text")
        .select("doc_id", "text", "ahead")
        .mapInArrow(_run, SCHEMA)
    )
