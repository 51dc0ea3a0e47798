"""The words that stand out in an entity's titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalstar.functions.text import is_significant, letter_runs, names_entity

# A first appearance is the text's order times this, plus the token's place in its text. As
# a decimal it holds any order and any place, and still is a fixed-width number.
PLACES = 1 << 31
POSITION = "decimal(38,0)"


def top_words(
    titles: DataFrame, entity: str, text: str, order: str, top: int = 15,
    stopwords: list[str] | None = None,
) -> DataFrame:
    """The ``top`` most frequent significant words per entity, ties by first appearance
    in the order of the integer column ``order``.

    Words are counted before they are shuffled, and the rank filter keeps only ``top``
    rows per entity and task ahead of the final sort, so a hot entity stays cheap. The
    first appearance is one number, which keeps the count in a hash aggregate.
    """
    exploded = titles.select(
        entity,
        F.col(order).cast("bigint").alias("_order"),
        # Outer: an inner explode would tokenise each text a second time, to filter
        # empty arrays. The test below drops the missing word of a missing text.
        F.posexplode_outer(letter_runs(F.col(text))).alias("_i", "word"),
    ).where(is_significant(F.col("word"), stopwords))
    first_seen = F.col("_order").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("_i")
    counted = exploded.groupBy(entity, "word").agg(
        F.count(F.lit(1)).alias("n"), F.min(first_seen.cast(POSITION)).alias("_first")
    )
    # The entity's own name goes after counting, where it costs one test per word; the
    # mention of the count keeps Catalyst from moving the test down to every token.
    counted = counted.where(
        ~((F.col("n") > 0) & names_entity(F.col("word"), F.col(entity)))
    )
    best = Window.partitionBy(entity).orderBy(F.desc("n"), F.asc("_first"))
    return (
        counted.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .drop("_first")
    )
