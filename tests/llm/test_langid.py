import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from levygrid.llm import langid, queries
from tests.llm.frames import LONG, ROWS, documents, rows_of

FOLDER = "/root/testdata/sf0.001"


def test_odd_rows(spark):
    frame = documents(spark)
    model = langid.fit(frame.where("doc_id <> 7"))  # Its one word would be most of the English.
    assert model.languages == ["de", "en", "es"]
    got = rows_of(langid.identify(frame, model), "doc_id", "lang_pred", "score")
    assert len(got) == len(ROWS)
    found = {i: (p, s) for i, p, s in got}
    assert found[4] == found[5] == found[6] == ("und", 0.0)
    assert (found[1][0], found[9][0], found[10][0]) == ("en", "de", "es")
    assert all(0 <= s <= 1 for _, _, s in got)
    kept = langid.confident(frame, model)
    assert kept.columns == frame.columns and kept.count() == len(ROWS) - 3


def test_nothing_to_learn(spark):
    for rows in ([], [(1, "text", None, "a"), (2, None, "en", "a")]):
        frame = documents(spark, rows)
        got = langid.identify(frame, langid.fit(frame)).collect()
        assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * len(rows)


def brute(model, text):
    total = model.prior.copy()
    letters = "".join(c.lower() if c.isalpha() else " " for c in f" {text}")
    while "  " in letters:
        letters = letters.replace("  ", " ")
    grams, _ = langid._grams([letters[1:]], len(model.weights))
    for bucket, _ in grams:
        for b in bucket:
            total += model.weights[b]
    return total - total.max()


def test_scores_are_sums_over_ngrams():
    draw = np.random.default_rng(1)
    model = langid.Model(["x", "y"], np.log([0.3, 0.7]), draw.normal(size=(512, 2)).astype(np.float32))
    texts = ["a", "A b!c", "ÀÉ  ##  ñ 12 x", "ab\n\ncd"]
    langs, scores = model.score(texts)
    for text, lang, score in zip(texts, langs, scores):
        odds = brute(model, text)
        assert lang == model.languages[odds.argmax()]
        assert score == pytest.approx(1 / np.exp(odds).sum(), rel=1e-4)


def test_long_texts_are_scored_whole(monkeypatch):
    draw = np.random.default_rng(1)
    model = langid.Model(["x", "y"], np.zeros(2), (draw.normal(size=(512, 2)) / 1e5).astype(np.float32))
    _, whole = model.score([LONG, "ab"])
    monkeypatch.setattr(langid, "_STEP", 1000)
    _, pieces = model.score([LONG, "ab"])
    assert pieces == pytest.approx(whole, abs=1e-3)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    got = queries.op5_language_id(spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 30 and sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert got.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 4 == 2)).count() == 0
