"""Exact duplicates by sorting content: range partitions, sorted runs, neighbours compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalstar.llm.common import SPACE, body, same_keys, stored

HEAD = 32  # leading characters in a splitter; a splitter stays small however long a text is

RUN_ROWS = (
    "doc_id {id}, n_points long, text_sha256 string, part int, run long, opens boolean, "
    "edge int, norm string"
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours in a sorted partition.

    Each row is compared in full with the one before it. Two more rows give the texts at
    both ends of the partition, where runs may go on.
    """
    part, run, last = TaskContext.get().partitionId(), -1, None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        norm = batch.column("norm")
        same = np.zeros(n, bool)
        same[0] = last is not None and norm[0].as_py() == last
        if n > 1:
            same[1:] = pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
        runs = run + np.cumsum(~same)
        if last is None:
            yield _edge(batch, part, 0, 1, norm[0])
        run, last = int(runs[-1]), norm[n - 1].as_py()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_points"), batch.column("text_sha256"),
                pa.array(np.full(n, part, np.int32)), pa.array(runs), pa.array(~same),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()),
            ],
            names=["doc_id", "n_points", "text_sha256", "part", "run", "opens", "edge", "norm"],
        )
    if last is not None:
        yield _edge(batch, part, run, 2, last)


def _edge(batch: pa.RecordBatch, part: int, run: int, edge: int, norm) -> pa.RecordBatch:
    text = norm.as_py() if isinstance(norm, pa.Scalar) else norm
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(1, batch.column("doc_id").type), pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.string()), pa.array([part], pa.int32()), pa.array([run], pa.int64()),
            pa.nulls(1, pa.bool_()), pa.array([edge], pa.int32()), pa.array([text], pa.string()),
        ],
        names=["doc_id", "n_points", "text_sha256", "part", "run", "opens", "edge", "norm"],
    )


def duplicate_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without white space. The longest original of a group
    stays, then the one with the smallest id; among fully equal rows exactly one is kept.
    Null texts count as empty, a null id sorts before all others. Other columns are not
    read, so their names do not matter. An empty table gives an empty result.

    Rows are range-partitioned by sampled splitters over the first characters of the
    normalised text, its SHA-256 and the order inside a group, so that a large group
    spreads over partitions and texts that only start alike do not meet. Each partition is
    sorted by Spark's external sort, neighbours are compared in full, and runs that cross a
    partition border are joined by comparing the texts on both sides of it.
    """
    return _groups(docs, id, text).drop("n_points")


def _groups(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The groups, and of each row the code points of its original text."""
    rows = docs.select(F.col(id).alias("doc_id"), body(text).alias("body")).select(
        "doc_id",
        F.char_length("body").cast("long").alias("n_points"),
        F.regexp_replace("body", f"{SPACE}+", "").alias("norm"),
    )
    order = ["head", "text_sha256", F.desc("n_points"), "doc_id"]
    ranged = (
        rows.withColumn("head", F.substring("norm", 1, HEAD))
        .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "n_points", "text_sha256", "norm")
    )
    id_type = ranged.schema["doc_id"].dataType.simpleString()
    runs = stored(ranged.mapInArrow(_runs, RUN_ROWS.format(id=id_type)), "content-runs")
    members = runs.where(F.col("edge").isNull()).drop("edge", "norm")
    roots = _roots(runs.where(F.col("edge").isNotNull()))
    # One row per partition: as small as the list of tasks.
    members = members.join(F.broadcast(roots), "part", "left").select(
        "doc_id", "n_points", "text_sha256", "part", "opens",
        F.when(F.col("run") == 0, F.col("root_part")).otherwise(F.col("part")).alias("group_part"),
        F.when(F.col("run") == 0, F.col("root_run")).otherwise(F.col("run")).alias("group_run"),
    )
    groups = members.groupBy("group_part", "group_run").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_points")).alias("n"), "doc_id", "part")).alias("best"),
    )
    return members.join(groups, ["group_part", "group_run"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("opens") & (F.col("part") == F.col("best.part"))).alias("kept"),
        "text_sha256",
        "n_points",
    )


def _roots(edges: DataFrame) -> DataFrame:
    """For the first run of each partition, the run in which its group begins."""
    by_part = Window.orderBy("part")
    ends = edges.groupBy("part").agg(F.max("run").alias("last_run"))
    ranks = ends.withColumn("rank", F.row_number().over(by_part))
    firsts = edges.where("edge = 1").join(ranks, "part").select("rank", "norm", "part")
    lasts = edges.where("edge = 2").join(ranks, "part").select(
        (F.col("rank") + 1).alias("rank"), "norm"
    )
    going_on = firsts.join(lasts, ["rank", "norm"]).select("part", F.lit(True).alias("goes_on"))
    before = F.struct(
        F.lag("part").over(by_part).alias("part"), F.lag("last_run").over(by_part).alias("run")
    )
    begins = (
        F.when(F.col("goes_on").isNull(), F.struct("part", F.lit(0).cast("long").alias("run")))
        .when(F.lag("last_run").over(by_part) > 0, before)
    )
    chained = (
        ends.join(going_on, "part", "left")
        .withColumn("begins", begins)
        .withColumn("root", F.last("begins", ignorenulls=True).over(by_part))
    )
    return chained.select(
        "part",
        F.col("root").getField("part").alias("root_part"),
        F.col("root").getField("run").alias("root_run"),
    )


def kept_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows once.

    Rows are told apart by id, normalised text and length: of rows with one id and equal texts
    the longest original stays, also where ids repeat or are null. Of rows equal in all three
    one stays. A null text is empty; of all empty and blank texts one stays.
    """
    kept = _groups(docs, id, text).where("kept").select(
        F.col("keep_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("n_points").alias("__points")
    )
    keyed = docs.withColumns({
        "__text_sha": F.sha2(F.regexp_replace(body(text), f"{SPACE}+", "").cast("binary"), 256),
        "__text_points": F.char_length(body(text)).cast("long"),
    })
    same = same_keys([id, "__text_sha", "__text_points"], ["__id", "__sha", "__points"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(
        [id, "__text_sha", "__text_points"]).drop("__text_sha", "__text_points")
