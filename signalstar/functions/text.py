"""Title tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about what a study is about.
STOPWORDS = [
    "the", "and", "for", "with", "from", "into", "after", "before", "study",
    "studies", "review", "case", "effect", "effects", "using", "based",
    "analysis", "clinical", "patient", "patients", "human", "humans", "trial",
    "results", "role", "novel", "new", "use", "used", "associated", "among",
    "between", "following", "report", "reports", "systematic", "meta",
    "literature", "current", "potential", "future", "randomized", "controlled",
    "double", "blind", "placebo", "group", "groups", "data", "model", "models",
]
MIN_LETTERS = 4


def letter_runs(text: Column) -> Column:
    """Lower-cased runs of ASCII letters; the ends may hold empty strings."""
    return F.split(F.lower(text), "[^A-Za-z]+")


def is_significant(token: Column, stopwords: list[str] | None = None) -> Column:
    """Long enough and not a stopword."""
    words = STOPWORDS if stopwords is None else stopwords
    return (F.length(token) >= MIN_LETTERS) & ~token.isin(*words)


def names_entity(token: Column, name: Column) -> Column:
    """Whether the token is part of the entity's own name."""
    return F.array_contains(letter_runs(name), token)
