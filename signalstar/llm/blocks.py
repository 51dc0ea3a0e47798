"""Comparing the rows of a bucket with each other, however large the bucket is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, key: Sequence[str], node: str, block_rows: int) -> DataFrame:
    """Rows of buckets with two or more of them, dealt to tasks of at most two blocks.

    A bucket of n rows is split into n / block_rows blocks by the hash of ``node``; every
    pair of blocks, and every block by itself, is one group (key, block_a, block_b), in
    which ``block`` tells the side. So each pair of rows meets once per bucket, and no task
    holds a whole large bucket. Groups come sorted, many to a partition.
    """
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("bucket_rows")).where("bucket_rows > 1")
    blocks = F.ceil(F.col("bucket_rows") / block_rows).cast("int")
    own = F.col("block")
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least(own, other).alias("block_a"), F.greatest(own, other).alias("block_b")
        ),
    )
    group = [*key, "block_a", "block_b"]
    return (
        rows.join(sizes, list(key))
        .withColumn("block", F.pmod(F.xxhash64(node), blocks.cast("long")).cast("int"))
        .select("*", F.inline(pairs))
        .drop("bucket_rows")
        .repartition(*group)
        .sortWithinPartitions(*group, node)
    )


def groups(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each run of equal keys in sorted batches, one run at a time."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = {
            name: column.to_numpy(zero_copy_only=False)
            for name, column in zip(batch.schema.names, batch.columns)
        }
        if rest is not None:
            columns = {n: np.concatenate([rest[n], c]) for n, c in columns.items()}
        changes = np.zeros(len(columns[key[0]]) - 1, bool)
        for name in key:
            changes |= columns[name][1:] != columns[name][:-1]
        starts = [0, *(np.flatnonzero(changes) + 1)]
        for a, b in zip(starts[:-1], starts[1:]):
            yield {n: c[a:b] for n, c in columns.items()}
        rest = {n: c[starts[-1] :] for n, c in columns.items()}
    if rest is not None:
        yield rest


def local_roots(linked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest node of each row's component in a symmetric matrix of links."""
    roots = nodes.copy()
    top = np.iinfo(np.int64).max
    near = linked | np.eye(len(nodes), dtype=bool)
    while True:
        new = np.where(near, roots[None, :], top).min(axis=1)
        if (new == roots).all():
            return roots
        roots = new


def across(block: np.ndarray, a: int, b: int) -> np.ndarray:
    """Pairs of rows that this group is to compare: two sides, or one block with itself."""
    if a == b:
        return ~np.eye(len(block), dtype=bool)
    return block[:, None] != block[None, :]
