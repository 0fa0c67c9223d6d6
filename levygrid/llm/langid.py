"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import fresh, slices

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Expected number of labelled rows the model is fitted on; all rows if there are fewer.
SAMPLE_ROWS = 10_000
#: The matrix of log probabilities never takes more bytes than this.
MODEL_BYTES = 64 << 20
#: Characters scored at once.
_STEP = 1 << 17


@functools.cache
def _folds() -> np.ndarray:
    """Code point to lower-case letter, or to a blank if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            out[point] = ord(lower) if len(lower) == 1 else point
    return out


def _grams(texts: list[str], buckets: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order the n-grams' buckets and documents; the documents' letter counts.

    Runs of anything but letters count as one blank; every text starts with a blank.
    """
    points = np.frombuffer("".join([f" {t}" for t in texts]).encode("utf-32-le", "replace"), np.uint32)
    codes = _folds()[points]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    blank = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[np.cumsum(lengths) - lengths] = True
    codes, owner, blank = codes[keep].astype(np.uint64), owner[keep], blank[keep]
    letters = np.bincount(owner[~blank], minlength=len(texts))
    out, mixed = [], np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(codes) - order + 1
        if n <= 0:
            break
        mixed = (mixed[:n] + codes[order - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if order in ORDERS:
            valid = owner[:n] == owner[order - 1 :] if order > 1 else ~blank
            hashed = ((mixed + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)
            out.append(((hashed[valid] % np.uint64(buckets)).astype(np.int32), owner[:n][valid]))
    return out, letters


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts of about ``_STEP`` characters; longer texts in overlapping pieces."""
    rows, group, held = [], [], 0
    for row, text in enumerate(texts):
        step = _STEP - max(ORDERS) + 1
        for at in range(0, max(1, len(text)), step):
            piece = text[at : at + _STEP] if len(text) > _STEP else text
            if held and held + len(piece) > _STEP:
                yield rows, group
                rows, group, held = [], [], 0
            rows.append(row)
            group.append(piece)
            held += len(piece)
            if len(text) <= _STEP:
                break
    if group:
        yield rows, group


@dataclass(frozen=True)
class Model:
    """Languages in order, log priors, and log probabilities by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Most probable language of each text and its posterior probability."""
        n, k = len(texts), len(self.languages)
        if not k:
            return [UNDETERMINED] * n, np.zeros(n)
        total, letters = np.tile(self.prior, (n, 1)), np.zeros(n, np.int64)
        for rows, group in _pieces([t or "" for t in texts]):
            grams, found = _grams(group, len(self.weights))
            np.add.at(letters, rows, found)
            for bucket, owner in grams:
                if len(owner):
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    sums = np.add.reduceat(self.weights[bucket], first, axis=0, dtype=np.float64)
                    np.add.at(total, np.asarray(rows)[owner[first]], sums)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        score[letters == 0] = 0.0
        return [
            self.languages[b] if seen else UNDETERMINED for b, seen in zip(best, letters)
        ], score


def held_out(doc_id: Column) -> Column:
    """Every fourth document by a checksum of its id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS, smoothing: float = 0.5,
) -> Model:
    """Fit on whole texts of a sample of ``labelled`` rows of ``sample_rows`` expected rows.

    A row is taken by a hash of its id and text; rows without text or label don't count.
    Executors count n-grams; the driver receives one count for each language and bucket,
    and halves the number of buckets until the matrix fits ``MODEL_BYTES``. Without
    any labelled row the model knows no language.
    """
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")
    ).dropna(subset=["text", "lang"])
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((buckets, 0), np.float32))
    while buckets > 256 and buckets * len(languages) * 4 > MODEL_BYTES:
        buckets //= 2
    share = min(1.0, sample_rows / sum(sizes.values()))
    at = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)
    index = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for part in slices(batches, 0, _STEP):
            texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
            for rows, group in _pieces(texts):
                label = np.fromiter((index[langs[r]] for r in rows), np.int64, len(rows))
                for bucket, owner in _grams(group, buckets)[0]:
                    for i in np.unique(label):
                        mine = np.bincount(bucket[label[owner] == i], minlength=buckets)
                        seen[languages[i]] = seen.get(languages[i], 0) + mine
        for lang, counts in seen.items():
            hit = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit)), pa.array(hit), pa.array(counts[hit])],
                ["lang", "bucket", "n"],
            )

    tasks = labelled.sparkSession.sparkContext.defaultParallelism
    sample = rows.where(at < share).select("text", "lang").repartition(tasks)
    found = (
        sample.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros((buckets, len(languages)))
    where = np.fromiter((index[x] for x in found["lang"].to_pylist()), np.int64, found.num_rows)
    counts[found["bucket"].to_numpy(), where] = found["n"].to_numpy()
    weights = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * buckets)
    prior = np.log(np.array([sizes[x] for x in languages], float) / sum(sizes.values()))
    return Model(languages, prior, weights.astype(np.float32))


def predicted(df: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Struct (lang, score) of the text column; null or letterless: ``und`` and 0.

    The model (64 MiB at most) is broadcast once.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def score(texts: pa.Array) -> pa.Array:
        langs, scores = [], [np.zeros(0)]
        for part in slices([pa.RecordBatch.from_arrays([texts], ["t"])], 0, 4 * _STEP):
            lang, points = shared.value.score(part.column(0).to_pylist())
            langs += lang
            scores.append(points)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], ["lang", "score"]
        )

    return score(F.col(text_col))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), a row for each row of ``df``; repeated rows stay."""
    return df.select(
        F.col(id_col).alias("doc_id"), predicted(df, model, text_col).alias("p")
    ).select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def confident(
    df: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.5
) -> DataFrame:
    """Rows of ``df`` whose language is determined with a posterior of ``min_score``."""
    [found] = fresh(df, "__language")
    sure = (F.col(found)["lang"] != UNDETERMINED) & (F.col(found)["score"] >= min_score)
    return df.withColumn(found, predicted(df, model, text_col)).where(sure).drop(found)
