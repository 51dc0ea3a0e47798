"""Product codes of vectors, computed in whole numbers by matrix products of limbs."""

from __future__ import annotations

import hashlib
import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import stored
from signalstar.operators.sizing import join_measured

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
FLOAT_BITS = 53  # whole numbers up to two to this power are exact in a double
SUM_BITS = 40  # sums leave a task in limbs of so many bits

Books = list[list[list[int]]]  # part, entry, position


def limb_bits(width: int) -> int:
    """Bits of a limb such that a product of two rows of ``width`` limbs is exact in a double."""
    return (FLOAT_BITS - max(1, math.ceil(math.log2(width)))) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` as sum of limb_i * 2**(i * bits): the last limb carries the sign."""
    found = []
    while True:
        if np.abs(x).max(initial=0) < 1 << bits:
            return [*found, x.astype(np.float64)]
        found.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits


def exact_dots(x: np.ndarray, y: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``x @ y.T`` of whole numbers, exact as long as the results fit 64 bits.

    Every product of two limbs is a product of float64 matrices whose sums stay below 2**53;
    the products are put together in 64-bit integers.
    """
    bits = bits or limb_bits(x.shape[1])
    out = np.zeros((len(x), len(y)), np.int64)
    right = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += (a @ b.T).astype(np.int64) << ((i + j) * bits)
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each row and the squared distance to it."""
    if x.dtype == object or book.dtype == object:
        x, book = x.astype(object), book.astype(object)
        far = np.array([[sum((a - b) ** 2) for b in book] for a in x], object).reshape(len(x), -1)
        code = np.array([min(range(len(book)), key=row.__getitem__) for row in far], np.int64)
    else:
        far = (x * x).sum(axis=1)[:, None] - 2 * exact_dots(x, book) + (book * book).sum(axis=1)
        code = far.argmin(axis=1)
    return code, far[np.arange(len(x)), code]


def _whole(x: float) -> int:
    return math.floor(x) * SCALE if abs(x) >= 2.0**FLOAT_BITS else math.floor(x * SCALE)


def _safe(width: int) -> int:
    """Components up to this size have distances that fit 64 bits with room to spare."""
    return 1 << ((61 - math.ceil(math.log2(max(width, 2)))) // 2 - 1)


def _split_rows(batch: pa.RecordBatch, length: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their components as whole numbers, in parts: first the rows whose
    distances fit 64 bits, then, as Python's integers, the others. Rows of another length are
    left out; a length that the parts do not divide is filled up with zeros."""
    vectors = batch.column("vector")
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    if not len(rows):
        return
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    values = np.zeros((len(rows), PARTS * width))
    values[:, :length] = flat.reshape(-1, length)
    small = np.abs(values).max(axis=1) * SCALE < _safe(width)
    if small.any():
        whole = np.floor(values[small] * SCALE).astype(np.int64)
        yield rows[small], whole.reshape(-1, PARTS, width)
    if not small.all():
        whole = np.array([[_whole(v) for v in row] for row in values[~small].tolist()], object)
        yield rows[~small], whole.reshape(-1, PARTS, width)


def _as_array(book: list[list[int]], width: int) -> np.ndarray:
    small = all(abs(v) < _safe(width) for entry in book for v in entry)
    return np.array(book, np.int64 if small else object).reshape(len(book), width)


def _sums(rows: DataFrame, books: Books, length: int, width: int) -> dict[tuple[int, int], list[int]]:
    """Of each used (part, entry): the componentwise sums of its parts and, last, their count.

    Each task sums its own rows; what it sends is bounded by the size of the codebooks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [_as_array(book, width) for book in books]
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, whole in _split_rows(batch, length, width):
                for part, book in enumerate(arrays):
                    code, _ = nearest(whole[:, part], book)
                    for entry in np.unique(code).tolist():
                        own = whole[code == entry, part]
                        found = np.append(own.sum(axis=0), len(own)).astype(object)
                        total[part, entry] = total.get((part, entry), 0) + found
        out = []
        for (part, entry), sums in total.items():
            for at, value in enumerate(sums):
                limb = 0
                while value not in (0, -1) or limb == 0:
                    out.append((part, entry, at, limb, value & ((1 << SUM_BITS) - 1)))
                    value, limb = value >> SUM_BITS, limb + 1
                if value:  # a negative number goes on with ones
                    out.append((part, entry, at, limb, -1))
        columns = list(zip(*out)) or [[]] * 5
        names = ["part", "entry", "at", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    sent = rows.select("vector").mapInArrow(
        work, "part long, entry long, at long, limb long, value long"
    )
    totals: dict[tuple[int, int], list[int]] = {}
    # One row for each component of the codebooks and limb.
    for r in sent.groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value")).collect():
        totals.setdefault((r.part, r.entry), [0] * (width + 1))[r.at] += r.value << (r.limb * SUM_BITS)
    return totals


def _first_books(rows: DataFrame) -> tuple[Books, int, int]:
    """Codebooks from the vectors with the smallest ids, their length, and that of a part."""
    order = [F.col("vec_id").isNull(), F.col("vec_id"), F.col("vector")]
    first = rows.where(F.size("vector") > 0).orderBy(*order).select(F.size("vector")).first()
    if first is None:
        return [], 0, 0
    length = first[0]
    width = -(-length // PARTS)
    found = rows.where(F.size("vector") == length).orderBy(*order).limit(ENTRIES).select("vector")
    whole = [[_whole(v) for v in r.vector] + [0] * (PARTS * width - length) for r in found.collect()]
    return [[v[p * width : (p + 1) * width] for v in whole] for p in range(PARTS)], length, width


CODED = "vec_id {id}, label {label}, code string, error long"


def vector_codes(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector without null or non-finite components: vec_id, code, error,
    label_error, codebooks_sha256.

    Components become floor(4096 x). Each of eight equal parts has a codebook, at first those
    parts of the 16 vectors with the smallest ids (of equal ids, of the smaller vector; a null
    id comes last), then of each round the floored means; nearest is by squared distance, the
    lower index on ties. Everything is exact: distances come from limb products, sums are
    unbounded. Repeated rows count each; fewer than 16 vectors make smaller codebooks; no
    vectors give no rows. A length that eight does not divide is filled up with zeros. The
    length is that of the first vector that is not empty; a vector of another length has a
    null code and error. An error beyond 64 bits is null and adds nothing to ``label_error``.
    Only the three columns are read. A round is one scan, and what it sends is as large as
    the codebooks; a lost task is computed again with the same result.
    """
    kept = vectors.select(
        F.col(id).alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.col("vector").isNotNull() & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))))
    books, length, width = _first_books(kept)
    for _ in range(rounds if books else 0):
        for (part, entry), (*sums, count) in _sums(kept, books, length, width).items():
            books[part][entry] = [s // count for s in sums]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [_as_array(book, width) for book in books]
        digits = np.array([f"{i:02x}" for i in range(ENTRIES)], object)
        for batch in batches:
            code = np.full(batch.num_rows, None, object)
            error = np.full(batch.num_rows, None, object)
            for at, whole in _split_rows(batch, length, width) if books else ():
                found = [nearest(whole[:, part], book) for part, book in enumerate(arrays)]
                code[at] = reduce(operator.add, [digits[c] for c, _ in found])
                error[at] = sum(far.astype(object) for _, far in found)
            error = [e if e is not None and e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()),
                 pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    types = {c: kept.schema[n].dataType.simpleString() for c, n in (("id", "vec_id"), ("label", "label"))}
    coded = stored(kept.mapInArrow(work, CODED.format(**types)), "vector-codes")
    totals = coded.groupBy(F.col("label").alias("label_of")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")
    )
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    joined = join_measured(coded, totals, F.col("label").eqNullSafe(F.col("label_of")))
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
