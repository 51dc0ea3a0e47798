"""Near-duplicate vectors by hashing random projections to points of the E8 lattice."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.llm.blocks import across, block_pairs, groups, local_roots
from signalstar.llm.common import stored
from signalstar.llm.components import components

COSINE = 0.93
# At the threshold itself a table meets a pair in 91 of 100 cases, three tables in 99.9.
TABLES, PROBES, SCALE = 3, 4, 1.5
BLOCK_ROWS = 1024
PAIRS_AT_ONCE = 1 << 14


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, by their rule."""
    whole = np.zeros((112, 8))
    places = [(i, j, a, b) for i, j in itertools.combinations(range(8), 2)
              for a, b in itertools.product((1, -1), repeat=2)]
    for row, (i, j, a, b) in enumerate(places):
        whole[row, [i, j]] = a, b
    signs = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.concatenate([whole, signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    gap = x[odd] - point[odd]
    worst = np.abs(gap).argmax(axis=1)
    point[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: the better of its two cosets of D8."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cells(unit: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """Cell numbers of each row: per table its own cell and the nearest neighbouring ones."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    around = minimal_vectors()
    out = []
    for _ in range(tables):
        matrix, shift = rng.normal(size=(unit.shape[1], 8)), rng.random(8) * 2
        mixer = rng.integers(1, 2**62, 8, dtype=np.int64).astype(np.uint64) * 2 + 1
        # One row at a time of the same product, so that a row's cells never depend on
        # which rows it came with.
        x = np.einsum("nd,dk->nk", unit, matrix) / scale + shift
        home = nearest_e8(x)
        toward = np.einsum("nd,kd->nk", x - home, around)
        nearest = np.argsort(-toward, axis=1, kind="stable")[:, :probes]
        points = np.concatenate([home[:, None, :], home[:, None, :] + around[nearest]], axis=1)
        doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        key = (doubled * mixer).sum(axis=2, dtype=np.uint64)
        key ^= key >> np.uint64(31)
        out.append((key * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64))
    return np.concatenate(out, axis=1)


def _unit(raw: np.ndarray, kind: str) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / largest
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _celled(kind: str, tables: int, probes: int, scale: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.cumsum(sizes)
            raw = [flat[e - n : e].tobytes() for e, n in zip(ends, sizes)]
            keys = np.zeros((len(sizes), tables * (probes + 1)), np.int64)
            for d in np.unique(sizes):
                of = np.flatnonzero(sizes == d)
                unit = _unit(np.array([raw[i] for i in of], object), kind)
                keys[of] = cells(unit, tables, probes, scale, seed)
            per_table = probes + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"), batch.column("size"), batch.column("label"),
                    pa.array(sizes.astype(np.int32)), pa.array(raw, pa.binary()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([
                        [{"table": i // per_table, "cell": int(c)} for i, c in enumerate(k)]
                        for k in keys
                    ], pa.list_(pa.struct([("table", pa.int32()), ("cell", pa.int64())]))),
                ],
                names=["node", "size", "label", "dims", "vector", "cells", "entries"],
            )

    return run


KEY = ["label", "dims", "table", "cell"]
GROUP = [*KEY, "block_a", "block_b"]


def _compared(kind: str, cosine: float, per_table: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, GROUP):
            nodes, sizes = g["node"].astype(np.int64), g["size"].astype(np.int64)
            unit = _unit(g["vector"], kind)
            todo = across(g["block"], g["block_a"][0], g["block_b"][0])
            linked = todo & (unit @ unit.T >= cosine)
            if not linked.any():
                continue
            roots = local_roots(linked, nodes)
            # A pair counts in the first cell that both rows enter, in the order of tables
            # and then of cell numbers.
            own = np.frombuffer(b"".join(g["cells"]), np.int64).reshape(len(nodes), -1, per_table)
            i, j = np.nonzero(np.triu(linked))
            for at in range(0, len(i), PAIRS_AT_ONCE):
                some, other = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
                here = _first_shared(own[some], own[other], int(g["table"][0]), int(g["cell"][0]))
                linked[some[~here], other[~here]] = linked[other[~here], some[~here]] = False
            links = linked @ sizes
            some = (links > 0) | (roots != nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[some]), pa.array(links[some]), pa.array(roots[some])],
                names=["node", "links", "root"],
            )

    return run


def _first_shared(a: np.ndarray, b: np.ndarray, table: int, cell: int) -> np.ndarray:
    """For pairs of rows (pairs, tables, cells), whether this cell is the first they share."""
    shared = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
    first_table = shared.any(axis=2).argmax(axis=1)
    row = np.arange(len(a))
    lowest = np.where(shared, a, np.iinfo(np.int64).max)[row, first_table].min(axis=1)
    return (first_table == table) & (lowest == cell)


def near_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
    block_rows: int = BLOCK_ROWS, seed: int = 0,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label and length are linked from a cosine of ``cosine`` on, in double
    precision; what the tables do not bring together is not found, what they do is checked
    exactly. Null labels, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing. Equal vectors are compared once and counted as often as
    they occur, so copies cost nothing; repeated ids are rows of their own. A null id sorts
    first. Other columns are not read.

    A vector enters, per table, the cell of its projection and the nearest neighbouring
    cells. Cells are compared in blocks; each pair is counted in the first cell it shares,
    and only counts and one edge per row leave a task.
    """
    element = vectors.schema[vector].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = vectors.select(
        F.col(id).alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>").alias("vector"),
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("vector", lambda x: x == 0)
    usable = F.coalesce(F.col("label").isNotNull() & ~bad & ~zero, F.lit(False))
    classes = stored(
        rows.where(usable).groupBy("label", "vector").agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size")
        ).withColumn("node", F.xxhash64("label", "vector")),
        "lattice-classes",
    )
    label_type = rows.schema["label"].dataType.simpleString()
    entered = stored(
        classes.select("node", "size", "label", "vector").mapInArrow(
            _celled(kind, tables, probes, scale, seed),
            f"node long, size long, label {label_type}, dims int, vector binary, cells binary, "
            "entries array<struct<table:int,cell:bigint>>",
        ),
        "lattice-cells",
    )
    entries = entered.select(
        "node", "size", "label", "dims", "vector", "cells", F.inline("entries")
    )
    found = stored(
        block_pairs(entries, KEY, "node", block_rows).mapInArrow(
            _compared(kind, cosine, probes + 1), "node long, links long, root long"
        ),
        "lattice-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    classes = (
        classes.join(links, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(named, "root").select(
        F.col("label").alias("__label"), F.col("vector").alias("__vector"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id",
    )
    joined = rows.withColumn("usable", usable).join(
        classes,
        F.col("usable") & (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")),
        "left",
    )
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
