"""Near-duplicate texts: a chosen-path join on word shingles, checked exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstar.llm.blocks import across, block_pairs, groups, local_roots
from signalstar.llm.common import body, chunks, first_rows, same_keys, stored, text_key
from signalstar.llm.components import components
from signalstar.llm.shingles import SKETCH, mix, shingle_sets, sketch

SIMILARITY = 0.8
RECALL = 0.98  # of pairs at the threshold itself, by the runs' own odds
LOOSE = 0.6  # estimate from sketches that makes two sets a candidate
SMALL_BUCKET = 2048  # larger buckets are split further first
MORE_LEVELS = 2
SKETCH_BLOCK, SET_BLOCK = 512, 256


def survival(depth: int) -> float:
    """Odds that one run keeps a pair at the threshold together for ``depth`` splits.

    Such a pair shares one sampled token a split on average, as a critical branching
    process with Poisson offspring.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return alive


def plan(sets: int, recall: float = RECALL) -> tuple[int, int]:
    """Splits before buckets are looked at, and runs needed for the target recall."""
    depth = max(2, round(math.log10(max(sets, 1)) / 2))
    runs = math.ceil(math.log(1 - recall) / math.log(1 - survival(depth + MORE_LEVELS)))
    return depth, runs


def split(tokens: np.ndarray, keys: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """One split: for each row's node, the tokens it samples there and the nodes they lead to.

    All sets at a node sample by the same hash, so sets that share a token and sample it go
    on together. Returns the row of each new node and its key.
    """
    odds = np.uint64(int(2**64 / (similarity * tokens.shape[1])))
    at = mix(tokens ^ keys[:, None])
    row, token = np.nonzero(at < odds)
    return row, mix(at[row, token] + np.uint64(1))


def _tokens(sketches: np.ndarray) -> np.ndarray:
    place = np.arange(sketches.shape[1], dtype=np.uint64) << np.uint64(32)
    return mix(place + sketches.astype(np.uint64))


def _node(items: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(items.tobytes()) - 2**63


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in chunks(whole, "text")):
        sets = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            names=["doc_id", "text_key", "node", "sketch"],
        )


def _pathed(depth: int, runs: int, similarity: float):
    """Per set, the buckets it is in after ``depth`` splits in each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            full = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(n, -1)
            tokens = _tokens(full)
            rows, keys = [], []
            for r in range(runs):
                row = np.arange(n)
                key = mix(np.full(n, r + 1, np.uint64))
                for _ in range(depth):
                    of, key = split(tokens[row], key, similarity)
                    row = row[of]
                rows.append(row)
                keys.append(key)
            row, key = np.concatenate(rows), np.concatenate(keys).view(np.int64)
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([s.astype(np.uint8).tobytes() for s in full], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[order])),
                ],
                names=["node", "sketch", "buckets"],
            )

    return run


def _split_again(similarity: float):
    """Rows of large buckets, one split further, by the short sketches they carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            raw = b"".join(batch.column("sketch").to_pylist())
            tokens = _tokens(np.frombuffer(raw, np.uint8).reshape(n, -1))
            keys = batch.column("bucket").to_numpy().view(np.uint64)
            row, key = split(tokens, keys, similarity)
            some = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), some.column("node"), some.column("sketch")],
                names=["bucket", "node", "sketch"],
            )

    return run


def _matched(loose: float):
    """Edges to the smallest of each group of rows with alike sketches in a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["bucket", "block_a", "block_b"]):
            nodes = g["node"].astype(np.int64)
            rows = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(len(nodes), -1)
            same = np.zeros((len(nodes), len(nodes)), np.uint8)
            for column in rows.T:
                same += column[:, None] == column[None, :]
            alike = (same >= loose * SKETCH) & across(g["block"], g["block_a"][0], g["block_b"][0])
            roots = local_roots(alike, nodes)
            some = roots != nodes
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[some]), pa.array(roots[some])], names=["u", "v"]
            )

    return run


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (some for whole in batches for some in chunks(whole, "text")):
        sets = shingle_sets(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("cluster"), batch.column("node"), batch.column("size"),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["cluster", "node", "size", "items"],
        )


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slices of the incidence matrix."""
    n = len(sets)
    items = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, code, count = np.unique(items, return_inverse=True, return_counts=True)
    code, row = (x[count[code] > 1] for x in (code, row))
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    shared = np.zeros((n, n), np.float64)
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, [at, at + columns])
        incidence = np.zeros((n, columns), np.float32)
        incidence[row[a:b], code[a:b] - at] = 1
        shared += incidence @ incidence.T
    return shared


def _verified(similarity: float):
    """Exact links between the sets of a cluster: a weight and an edge for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["cluster", "block_a", "block_b"]):
            nodes, first = np.unique(g["node"].astype(np.int64), return_index=True)
            sizes, block = g["size"][first].astype(np.int64), g["block"][first]
            sets = [np.frombuffer(g["items"][i], np.uint64) for i in first]
            shared = shared_counts(sets)
            n = np.array([len(s) for s in sets], float)
            union = n[:, None] + n[None, :] - shared
            linked = (shared >= similarity * union - 1e-9) & across(
                block, g["block_a"][0], g["block_b"][0]
            )
            roots = local_roots(linked, nodes)
            links = linked @ sizes
            some = (links > 0) | (roots != nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[some]), pa.array(links[some]), pa.array(roots[some])],
                names=["node", "links", "root"],
            )

    return run


def candidate_clusters(classes: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(node, cluster) for sets that some run brought together with an alike one."""
    depth, runs = plan(classes.count(), recall)
    entries = stored(
        classes.select("node", "sketch").mapInArrow(
            _pathed(depth, runs, similarity), "node long, sketch binary, buckets array<long>"
        ),
        "path-entries",
    )
    # Most sets are alone in most buckets: those go before any sketch is moved.
    keyed = entries.select(F.explode("buckets").alias("bucket"), "node")
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    rows = stored(
        keyed.join(shared, "bucket").join(entries.select("node", "sketch"), "node")
        .select("bucket", "node", "sketch"),
        "path-buckets",
    )
    for _ in range(MORE_LEVELS):
        large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > SMALL_BUCKET
        ).select("bucket")
        if large.isEmpty():
            break
        large = stored(large, "path-large")
        further = rows.join(large, "bucket").select("bucket", "node", "sketch").mapInArrow(
            _split_again(similarity), "bucket long, node long, sketch binary"
        )
        rows = stored(rows.join(large, "bucket", "left_anti").unionByName(further), "path-buckets")
    edges = stored(
        block_pairs(rows, ["bucket"], "node", SKETCH_BLOCK).mapInArrow(
            _matched(LOOSE), "u long, v long"
        ).distinct(),
        "path-edges",
    )
    roots = components(edges)
    return roots.select("node", F.col("root").alias("cluster")).unionByName(
        roots.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct()
    )


def _classed(
    docs: DataFrame, id: str, text: str, similarity: float, recall: float
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, node) of each row, and (node, n_links, keeper) of each set.

    A class's keeper is its row with the smallest id, nulls last, then the smallest text key.
    """
    rows = docs.select(
        F.col(id).alias("doc_id"), body(text).alias("text"), text_key(text).alias("text_key")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    features = stored(
        rows.select("doc_id", "text_key", "text").mapInArrow(
            _featured, f"doc_id {id_type}, text_key binary, node long, sketch binary"
        ),
        "path-features",
    )
    known = features.where("node is not null")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    sizes = known.groupBy("node").agg(
        F.min(row).alias("least"), F.count(F.lit(1)).alias("size")
    )
    classes = stored(
        known.join(sizes, "node").where(row == F.col("least"))
        .select("node", "least", "size", "sketch"),
        "path-classes",
    )
    clusters = stored(candidate_clusters(classes, similarity, recall), "path-clusters")
    members = clusters.join(classes.drop("sketch"), "node").select(
        "cluster", "node", "size",
        F.col("least.doc_id").alias("__least"), F.col("least.text_key").alias("__key"),
    )
    sets = (
        rows.join(members, same_keys(["doc_id", "text_key"], ["__least", "__key"]))
        .select("cluster", "node", "size", "text")
        .mapInArrow(_shingled, "cluster long, node long, size long, items binary")
    )
    found = stored(
        block_pairs(stored(sets, "path-sets"), ["cluster"], "node", SET_BLOCK).mapInArrow(
            _verified(similarity), "node long, links long, root long"
        ),
        "path-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    grouped = (
        sizes.join(links, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = grouped.groupBy("root").agg(F.min("least").alias("keeper"))
    grouped = grouped.join(names, "root").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "keeper"
    )
    return features.drop("sketch"), grouped


def _is_keeper() -> Column:
    return same_keys(["doc_id", "text_key"], ["keeper.doc_id", "keeper.text_key"])


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, kept.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles
    is at least ``similarity``; a class is what links connect and is named by its smallest
    doc_id, nulls last; ``kept`` is true for the row with that id, of several under one id for
    the text with the smallest SHA-256. Documents with equal sets are compared once and counted as often as they occur.
    Texts without words (null, empty, white space) link with nothing and are kept. Rows that
    repeat an id and text count as copies of each other. Other columns are not read.

    Sets are embedded by min-hash values and split recursively on sampled values they share
    (see ``split``), first inside each set's own row, then again in buckets that are still
    large; repeated runs bring the odds of a pair at the threshold to ``recall``. Buckets are
    compared by sketches in bounded blocks and alike sets grouped into clusters; inside a
    cluster all pairs are compared on their whole sets, so every link is exact and counted
    once. No pairs leave a task.
    """
    features, grouped = _classed(docs, id, text, similarity, recall)
    alone = F.col("n_links").isNull()
    return features.join(grouped, "node", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | _is_keeper()).alias("kept"),
    )


def kept_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row, with all its columns.

    Rows are told apart by id and text, so a null or repeated id takes no other row along;
    of rows that repeat an id and text one stays. Texts without words all stay.
    """
    features, grouped = _classed(docs, id, text, SIMILARITY, RECALL)
    keys = features.where("node is not null").groupBy("doc_id", "text_key", "node").agg(
        F.count(F.lit(1)).alias("rows")
    )
    touched = stored(
        keys.join(grouped, "node").withColumn("keeper", _is_keeper())
        .where(~F.col("keeper") | (F.col("rows") > 1))
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "keeper"),
        "path-touched",
    )
    keyed = docs.withColumn("__text_key", text_key(text))
    own, other = [id, "__text_key"], ["__id", "__key"]
    kept = keyed.join(touched.drop("keeper"), same_keys(own, other), "left_anti")
    repeated = touched.where("keeper").select(*other, F.lit(1).alias("__quota"))
    if not repeated.isEmpty():
        kept = kept.unionByName(first_rows(keyed, own, repeated, other))
    return kept.drop("__text_key")
