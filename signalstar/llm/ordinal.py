"""Ordinal cumulative-link regression on hashed text, for graded quality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body, chunks, fresh, stored, text_key

BITS = 16  # hashed weights: 2 ** BITS
TRAIN_ROWS = 20_000  # most rated texts that the model is fitted on
SHARDS = 8  # parts of that sample, each fitted in its own task and averaged
ROUNDS, EPOCHS, BATCH, RATE, DECAY = 3, 6, 32, 0.5, 1e-6
KINDS = 4  # features of one word
LONG, PIECE = 24, 3  # a word of more than LONG code points is also read in pieces of PIECE


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade > k) = logistic(score - thresholds[k]), with thresholds in rising order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))


def _word_features(words: list[str]) -> np.ndarray:
    """Hashed features by word: itself, its shape, its ending, and its ending's shape."""
    table = np.empty((len(words), KINDS), np.uint16)
    for row, word in enumerate(words):
        shape = "".join(
            "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word
        )
        for kind, feature in enumerate((f"w{word}", f"s{shape}", f"e{word[-3:]}", f"t{shape[-3:]}")):
            table[row, kind] = xxhash.xxh64_intdigest(feature) & ((1 << BITS) - 1)
    return table


def _with_pieces(words: pa.Array, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts (``offsets`` tells where each begins), long ones followed by their pieces.

    So a text without white space is judged by all of its parts, not by one word that hardly
    ever recurs.
    """
    long = np.flatnonzero(pc.greater(pc.utf8_length(words), LONG).to_numpy(zero_copy_only=False))
    if not len(long):
        return words, offsets
    cut = pc.replace_substring_regex(words.take(pa.array(long)), f"(?s)(.{{{PIECE}}})", "\\1 ")
    pieces = pc.split_pattern(pc.utf8_trim_whitespace(cut), " ")
    number = np.diff(pieces.offsets.to_numpy())
    # Words keep their order; the pieces of a word come right after it.
    after = np.ones(len(words) + 1, np.int64)
    after[long] += number
    starts = np.cumsum(after) - after
    order = np.full(starts[-1], -1, np.int64)
    order[starts[:-1]] = np.arange(len(words))
    order[order < 0] = len(words) + np.arange(number.sum())
    flat = pa.concat_arrays([words, pieces.flatten().cast(words.type)])
    return flat.take(pa.array(order)), starts[offsets]


def _featured(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some texts: word codes in order, where each text begins, features by code.

    Each distinct word is hashed once. The last code stands for a word that repeats the one
    before it; it is put in its place.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts.cast(pa.large_string())))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    words, offsets = _with_pieces(words, offsets - offsets[0])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    again = [xxhash.xxh64_intdigest(f"again{k}") & ((1 << BITS) - 1) for k in range(KINDS)]
    table = np.concatenate([
        _word_features(coded.dictionary.to_pylist()), np.array([again], np.uint16)
    ])
    repeats = np.zeros(len(codes), bool)
    repeats[1:] = codes[1:] == codes[:-1]
    repeats[offsets[:-1][np.diff(offsets) > 0]] = False
    codes[repeats] = len(table) - 1
    return codes, offsets, table


def _means(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean of each text's slice; 0 for a text without words."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def _scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    out = [np.zeros(0)]
    for some in chunks(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        codes, offsets, table = _featured(some.column("text"))
        out.append(_means(weights[table].sum(axis=1)[codes], offsets))
    return np.concatenate(out)


def _fit_shard(frame: pd.DataFrame, start: OrdinalModel, grades: int) -> OrdinalModel:
    """Adagrad over the ordinal likelihood on the rows of one shard, by their weights."""
    frame = frame.sort_values(["draw", "grade", "text"], kind="stable")
    texts = pa.RecordBatch.from_arrays([pa.array(frame["text"], pa.large_string())], names=["text"])
    hashed = []
    for some in chunks(texts, "text"):
        codes, offsets, table = _featured(some.column("text"))
        hashed += [table[codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    grade = frame["grade"].to_numpy(np.int64)
    heavy = frame["weight"].to_numpy(np.float64)
    heavy = heavy / heavy.mean()
    weights, theta = start.weights.copy(), start.thresholds.copy()
    step_w, step_t = np.full(len(weights), 1e-8), np.full(len(theta), 1e-8)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for some in np.array_split(order.permutation(len(grade)), -(-len(grade) // BATCH)):
            lengths = np.array([len(hashed[i]) for i in some])
            words = np.concatenate([hashed[i] for i in some])
            scores = _means(weights[words].sum(axis=1), np.concatenate([[0], np.cumsum(lengths)]))
            tail = 1 / (1 + np.exp(-(scores[:, None] - theta[None, :])))
            # Gradient of the log likelihood of P(y = k) = tail[k-1] - tail[k].
            full = np.concatenate([np.ones((len(some), 1)), tail, np.zeros((len(some), 1))], axis=1)
            slope = full * (1 - full)
            rows, g = np.arange(len(some)), grade[some]
            chance = np.maximum(full[rows, g] - full[rows, g + 1], 1e-9)
            pull = heavy[some] / chance
            d_score = (slope[rows, g] - slope[rows, g + 1]) * pull
            d_theta = np.zeros_like(full)
            d_theta[rows, g] -= slope[rows, g] * pull
            d_theta[rows, g + 1] += slope[rows, g + 1] * pull
            share = np.repeat(d_score / np.maximum(lengths, 1), lengths)
            grad = np.bincount(
                words.ravel(), np.repeat(share, KINDS), minlength=len(weights)
            ) / len(some) - DECAY * weights
            grad_t = d_theta[:, 1:-1].sum(axis=0) / len(some)
            step_w += grad**2
            step_t += grad_t**2
            weights += RATE * grad / np.sqrt(step_w)
            theta = np.sort(theta + 0.1 * grad_t / np.sqrt(step_t))
    return OrdinalModel(weights, theta)


def fit(
    rated: DataFrame, text: str = "text", grade: str = "grade", grades: int = 3,
    train_rows: int = TRAIN_ROWS, seed: int = 0, key: str | None = None,
) -> OrdinalModel:
    """Weights and thresholds from rated texts.

    Equal texts of one grade are one row, however often they occur; n of them weigh
    1 + ln(n). Of these rows about ``train_rows`` and never more are drawn by a seeded hash (a
    documented bound; all where there are fewer) and dealt to SHARDS tasks. Each round every
    shard continues from the shared model and the results are averaged by weight; a model is
    half a megabyte. Rows with a null grade, or one out of range, are left out; null texts are
    empty. Without any rating, all documents get the top grade. ``key`` may name the texts'
    ``text_key``.
    """
    rows = rated.select(
        (F.col(key) if key else text_key(text)).alias("text_key"), body(text).alias("text"),
        F.col(grade).cast("int").alias("grade"),
    ).where(F.col("grade").between(0, grades - 1))
    model = OrdinalModel(np.zeros(1 << BITS), np.linspace(-1, 1, grades - 1) - 2)
    draw = F.xxhash64("text_key", F.lit(seed))
    counted = stored(rows.groupBy("text_key", "grade").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("text_key").alias("key"), F.col("grade").alias("of"),
        (1 + F.log("n")).alias("weight"), draw.alias("draw"),
    ), "rated-texts")
    share = min(1.0, train_rows / max(1, counted.count()))

    def low(value: Column) -> Column:
        return F.pmod(value, F.lit(1 << 40)) < int(share * (1 << 40))

    drawn = counted.where(low(F.col("draw"))).orderBy("draw", "key", "of").limit(train_rows)
    # Texts outside the draw go before they meet their ratings. At most train_rows digests are
    # broadcast; then one text is kept for each of them.
    kept = rows.where(low(draw)).join(
        F.broadcast(drawn), (F.col("text_key") == F.col("key")) & (F.col("grade") == F.col("of"))
    ).select("text", "grade", "weight", "draw").distinct()
    shard = F.pmod(F.shiftright("draw", 24), F.lit(SHARDS)).cast("int")
    kept = kept.withColumn("shard", shard).repartition(SHARDS, "shard").cache()
    context = rated.sparkSession.sparkContext
    try:
        for _ in range(ROUNDS):
            shared = context.broadcast((model.weights, model.thresholds))

            def one(frame: pd.DataFrame) -> pd.DataFrame:
                got = _fit_shard(frame, OrdinalModel(*shared.value), grades)
                return pd.DataFrame(
                    {"share": [frame["weight"].sum()], "weights": [got.weights], "thresholds": [got.thresholds]}
                )

            parts = kept.groupBy("shard").applyInPandas(
                one, "share double, weights array<double>, thresholds array<double>"
            ).collect()
            if not parts:
                return model
            parts.sort(key=lambda p: (p["share"], p["thresholds"]))
            share = np.array([p["share"] for p in parts], float)
            model = OrdinalModel(
                np.average([p["weights"] for p in parts], axis=0, weights=share),
                np.sort(np.average([p["thresholds"] for p in parts], axis=0, weights=share)),
            )
    finally:
        kept.unpersist()
    return model


def graded(
    docs: DataFrame, model: OrdinalModel, text: str = "text", name: str = "judged",
) -> DataFrame:
    """``docs`` with a struct ``name``: score, expected_grade and tails (P(grade >= k), k from 1).

    Null and empty texts score 0; equal texts score alike; a column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    @F.pandas_udf("struct<score:double,expected_grade:double,tails:array<double>>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        model = OrdinalModel(*shared.value)
        scores = _scores(pa.array(texts, pa.large_string()), model.weights)
        tails = model.tails(scores)
        return pd.DataFrame(
            {"score": scores, "expected_grade": tails.sum(axis=1), "tails": list(tails)}
        )

    return docs.withColumn(name, judge(body(text)))


def quality_grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0: poor; 1: well formed but toxic; 2: well formed and clean. Null without a rating."""
    return F.when(F.col(quality) == 0, 0).when(
        F.col(quality) == 1, F.when(F.coalesce(F.col(toxic), F.lit(0)) == 1, 1).otherwise(2)
    )


def rated_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts, their keys and grades; ratings of a document that disagree count as the lowest."""
    ratings = labels.select(F.col(id).alias("rated_id"), quality_grade().alias("grade")).where(
        "grade is not null"
    ).groupBy("rated_id").agg(F.min("grade").alias("grade"))
    texts = docs.select(
        F.col(id).alias("text_id"), F.col(text).alias("text"), text_key(text).alias("text_key")
    )
    return texts.join(ratings, F.col("text_id") == F.col("rated_id")).select("text", "text_key", "grade")


def quality_grades(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    tail: int = 1, cut: float = 0.5, seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, score, expected_grade, p_1, p_2, kept.

    A document is kept if the probability of a grade of at least ``tail`` reaches ``cut``.
    Null and empty texts have no features, score 0, and are judged by the thresholds alone.
    Equal texts get equal grades; labels of unknown documents are ignored.
    """
    model = fit(rated_documents(docs, labels, id, text), seed=seed, key="text_key")
    judged = graded(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), model)
    return judged.select(
        "doc_id", "judged.score", "judged.expected_grade",
        F.col("judged.tails")[0].alias("p_1"), F.col("judged.tails")[1].alias("p_2"),
        (F.col("judged.tails")[tail - 1] >= cut).alias("kept"),
    )


def kept_documents(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    tail: int = 1, cut: float = 0.5, seed: int = 0,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Null and empty texts are judged by the thresholds alone; equal texts and repeated rows
    stay or go together; an empty table stays empty; columns of any name are carried along.
    """
    model = fit(rated_documents(docs, labels, id, text), seed=seed, key="text_key")
    name = fresh(docs, "judged")
    judged = graded(docs, model, text, name)
    return judged.where(F.col(name)["tails"][tail - 1] >= cut).drop(name)
