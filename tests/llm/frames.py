"""Small frames with everything that may go wrong in a table of documents."""

from __future__ import annotations

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while the band plays on and on until dawn breaks"

#: doc_id, text, lang, source
ROWS = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, PROSE + " again", "en", None),
    (4, None, None, "b"),
    (5, "", "en", "b"),
    (6, " \t\n ", None, None),
    (7, LONG, "en", "c"),
    (None, "no id here but enough words to count as a text of ten words", "en", "c"),
    (9, "eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf", "de", "d"),
    (10, "uno dos tres cuatro cinco seis siete ocho nueve diez once doce", "es", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=ROWS):
    """The rows, with extra columns whose names operators also use."""
    extra = "n_words string, fingerprint int, score string, size int, kept string, host string, row long, key int, " \
        "part int, n_chars long, fp int, h int, base int, taken int"
    full = [(*r, *["x" if "string" in c else 7 for c in extra.split(", ")]) for r in rows]
    return spark.createDataFrame(full, f"{SCHEMA}, {extra}")


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
