"""Awkward rows that every operator has to take."""

from __future__ import annotations

LONG = " ".join(f"word{i % 7919}" for i in range(60_000))
BASE = " ".join(f"token{i}" for i in range(120))

TEXTS = [
    (1, "one two three four five six seven eight"),
    (2, "one  two three\tfour five six seven eight"),
    (3, None),
    (4, ""),
    (5, " \t\n\r "),
    (6, LONG),
    (7, LONG + " end"),
    (8, "short"),
    (9, BASE),
    (10, BASE.replace("token60 ", "changed ")),
    (10, BASE.replace("token60 ", "changed ")),  # a repeated row
    (None, "a row without an id that is long enough for shingles"),
    (11, "Ünïcödé – naïve café 東京 💡 text\x0bwith\x0cbreaks"),
    (12, BASE + " tail"),
]


def odd_documents(spark):
    """Nulls, blanks, long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(d, t, "en", f"src{(d or 0) % 3}", 0, "x", 1, "y", True) for d, t in TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, norm string, "
        "size long, node string, kept boolean",
    )


def no_documents(spark):
    return odd_documents(spark).where("doc_id < 0")
