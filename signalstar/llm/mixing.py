"""Mixing by hierarchical budgets over domain, language and source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.llm.common import WORD, body, first_rows, same_keys, stored, text_key

SLICE_ROWS = 5_000  # rows of one ordered slice of a leaf
HASHES = 1 << 32


def token_count(text: str) -> Column:
    return F.regexp_count(body(text), F.lit(WORD)).cast("long")


def weight_of(column: str, weights: Mapping[str, int]) -> Column:
    """The integer weight of a value; one that is not named weighs 1."""
    if not weights:
        return F.lit(1).cast("long")
    named = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in weights.items()))
    return F.coalesce(named[F.col(column)], F.lit(1)).cast("long")


def fill_level(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Share each parent's ``budget`` among its children in proportion to their ``weight``.

    A child gets no more than its ``capacity``; what it cannot use goes to its siblings, in
    proportion to their weights, until the budget or the family's capacity is used up. All
    in integers: taking children by capacity per weight, a child whose capacity is below
    its share of what is left takes its capacity; from the first that is not on, all share
    the rest. A child whose weight is zero or less gets nothing unless its siblings are full;
    what they leave is shared by all such children alike. Adds the budget of the child in
    place of the parent's.
    """
    nodes = nodes.withColumn("last", F.col("weight") <= 0).withColumn(
        "weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1))
    family = list(parent) or [F.lit(0)]
    order = [F.col("capacity") / F.col("weight"), F.col(name)]
    ahead = Window.partitionBy(*family, "last").orderBy(*order)
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    all_before = Window.partitionBy(*family).orderBy("last", *order).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.greatest(F.col("budget") - F.coalesce(F.sum("capacity").over(all_before), F.lit(0)), F.lit(0))
    open_weight = F.sum("weight").over(Window.partitionBy(*family, "last")) - F.coalesce(
        F.sum("weight").over(before), F.lit(0))
    full = F.col("capacity").cast("decimal(38,0)") * F.col("open_weight") <= F.col("rest").cast(
        "decimal(38,0)"
    ) * F.col("weight")
    # The first child that is not filled, in the same order, fixes the level for the rest.
    level = F.first(
        F.when(~F.col("full"), F.struct("rest", "open_weight")), ignorenulls=True
    ).over(ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shared = F.floor(
        F.col("level.rest").cast("decimal(38,0)") * F.col("weight") / F.col("level.open_weight")
    ).cast("long")
    return (
        nodes.withColumn("rest", rest)
        .withColumn("open_weight", open_weight)
        .withColumn("full", full)
        .withColumn("level", level)
        .withColumn("budget", F.when(F.col("level").isNull(), F.col("capacity")).otherwise(
            F.least(shared, F.col("capacity"))))
        .drop("rest", "open_weight", "full", "level", "last")
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]],
    budget_percent: int, max_epochs: int,
) -> DataFrame:
    """Tokens to take from each leaf.

    ``leaves``: the level columns and ``leaf_tokens``. The root's budget is
    ``budget_percent`` of all tokens. Capacity is what a node can give in ``max_epochs``
    passes. Budgets go down the tree level by level, so a shortage below a node is met by
    siblings first; only what the whole family cannot give goes to the node's own siblings.
    """
    nodes = leaves.withColumn("capacity_", F.col("leaf_tokens") * max_epochs)
    everything = Window.partitionBy(F.lit(0))
    nodes = nodes.withColumn(
        "budget",
        F.floor(F.sum("leaf_tokens").over(everything) * budget_percent / F.lit(100)).cast("long"),
    )
    for depth, name in enumerate(levels):
        path = list(levels[: depth + 1])
        children = (
            nodes.groupBy(*path)
            .agg(F.sum("capacity_").cast("long").alias("capacity"), F.first("budget").alias("budget"))
            .withColumn("weight", weight_of(name, weights.get(name, {})))
        )
        given = fill_level(children, path[:-1], name).select(
            *[F.col(c).alias(f"__{c}") for c in path], F.col("budget").alias("__budget")
        )
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in path]
        nodes = nodes.drop("budget").join(given, same).withColumn("budget", F.col("__budget")).select(
            *levels, "leaf_tokens", "capacity_", "budget"
        )
    return nodes.drop("capacity_")


def mixed(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
    budget_percent: int = 50, max_epochs: int = 3, seed: int = 0, id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and epoch in which it is taken.

    ``levels`` names the tree's levels from the root and how to compute them. Returns
    doc_id, the levels, epoch (from 1), tokens, take_tokens, leaf_budget. A leaf's budget is
    met by whole epochs and a prefix of the next, each epoch in its own order by the MD5 of
    seed, epoch and id; the document at the end of the prefix is taken in part
    (``take_tokens`` < ``tokens``). Documents without tokens (null or empty text) are not
    taken, nor is a leaf whose budget is 0. Null levels are a value like any other, null ids
    hash as the empty string; rows with equal ids follow each other, longest last. Other
    columns are not read.

    Only the narrow table of ids and counts is ordered. A leaf is cut into slices of the
    uniform hash, as many as the table's size asks for; token sums of slices are
    accumulated, then rows inside each slice, so a hot leaf spreads over many tasks.
    """
    rows = _taken(docs, levels, weights, budget_percent, max_epochs, seed, id, text, {})
    return rows.select(
        "doc_id", *levels, "tokens", "leaf_budget", F.inline("taken")
    ).select("doc_id", *levels, "epoch", "tokens", "take_tokens", "leaf_budget")


def _taken(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
    budget_percent: int, max_epochs: int, seed: int, id: str, text: str, ties: Mapping[str, Column],
) -> DataFrame:
    """Documents of leaves with a budget, and ``taken``: the epochs that take each, with tokens.

    ``ties`` are further columns to carry; they order rows with equal ids and lengths.
    """
    names = list(levels)
    counted = stored(
        docs.select(F.col(id).alias("doc_id"), *[c.alias(n) for n, c in levels.items()],
                    token_count(text).alias("tokens"), *[c.alias(n) for n, c in ties.items()])
        .where("tokens > 0"),
        "mixing-counts",
    )
    leaves = counted.groupBy(*names).agg(F.sum("tokens").cast("long").alias("leaf_tokens"))
    plans = stored(leaf_budgets(leaves, names, weights, budget_percent, max_epochs), "mixing-leaves")
    plans = plans.where("budget > 0").select(
        *[F.col(n).alias(f"__{n}") for n in names],
        F.floor(F.col("budget") / F.col("leaf_tokens")).cast("long").alias("whole"),
        F.col("budget").alias("leaf_budget"),
        (F.col("budget") % F.col("leaf_tokens")).alias("part_budget"),
    )
    same = [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names]
    rows = counted.join(plans, same).drop(*[f"__{n}" for n in names])
    slices = max(1, -(-counted.count() // SLICE_ROWS))
    place = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole") + 1, F.col("doc_id")).cast("binary"))
    rows = rows.withColumn("place", place).withColumn(
        "slice",
        F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * slices / HASHES).cast("int"),
    )
    earlier = (
        Window.partitionBy(*names).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = rows.groupBy(*names, "slice").agg(F.sum("tokens").alias("n")).select(
        *[F.col(c).alias(f"__{c}") for c in (*names, "slice")],
        F.sum("n").over(earlier).alias("slice_start"),
    )
    in_slice = (
        Window.partitionBy(*names, "slice").orderBy("place", "tokens", *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*names, "slice")]
    rows = rows.withColumn("row_start", F.sum("tokens").over(in_slice)).join(starts, same)
    left = F.col("part_budget") - F.coalesce("slice_start", F.lit(0)) - F.coalesce("row_start", F.lit(0))
    taken = F.concat(
        F.when(F.col("whole") > 0, F.transform(
            F.sequence(F.lit(1).cast("long"), F.col("whole")),
            lambda e: F.struct(e.alias("epoch"), F.col("tokens").alias("take_tokens")),
        )).otherwise(F.array().cast("array<struct<epoch:bigint,take_tokens:bigint>>")),
        F.when(left > 0, F.array(F.struct(
            (F.col("whole") + 1).alias("epoch"),
            F.least(F.col("tokens"), left).alias("take_tokens"),
        ))).otherwise(F.array().cast("array<struct<epoch:bigint,take_tokens:bigint>>")),
    )
    return rows.select("doc_id", *names, "tokens", "leaf_budget", *ties, taken.alias("taken"))


def kept_documents(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
    budget_percent: int = 50, seed: int = 0, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that one epoch takes, whole, with all their columns.

    Rows are told apart by id, levels and text; of rows equal in these, as many pass as the
    epoch takes.
    """
    rows = _taken(docs, levels, weights, budget_percent, 1, seed, id, text, {"text_key": text_key(text)})
    names = ["doc_id", *levels, "text_key"]
    wanted, own = [f"__want_{n}" for n in names], [f"__own_{n}" for n in names]
    quotas = stored(
        rows.groupBy(*[F.col(n).alias(w) for n, w in zip(names, wanted)]).agg(
            F.count(F.lit(1)).alias("__rows"), F.count(F.when(F.size("taken") > 0, 1)).alias("__quota")
        ).where("__quota > 0"),
        "mixing-quotas",
    )
    of_row = [F.col(id), *levels.values(), text_key(text)]
    keyed = docs.withColumns(dict(zip(own, of_row)))
    kept = keyed.join(quotas.where("__quota = __rows").select(*wanted), same_keys(own, wanted), "left_semi")
    cut = quotas.where("__quota < __rows").drop("__rows")
    if not cut.isEmpty():
        kept = kept.unionByName(first_rows(keyed, own, cut, wanted))
    return kept.drop(*own)
