"""Fingerprints of documents: invertible Bloom lookup tables of their paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.llm.common import body

HASHES, SLOTS = 3, 8  # a paragraph is in one of so many cells of each of so many rows
CELLS = HASHES * SLOTS
RETRIES = 10  # each has four times as many tables as the one before
SPLITTERS_PER_PARTITION, SAMPLES_PER_SPLITTER = 4, 16

# Odd multipliers of the two halves of a digest; a retry adds to them.
LOW, HIGH = 0x2545F491, 0x1B873593
LOW_BITS, HIGH_BITS = 31, 29

FOUND = "array<struct<x:bigint,n:int>>"

# The expressions are put together as SQL text: as nested calls they would take the driver
# seconds to build. Each name of a lambda variable is used once.


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digests(text: str) -> str:
    return (
        f"array_distinct(transform(filter(split({text}, '[\\\\n\\\\x0B\\\\f\\\\r]+'), p -> p <> ''), "
        "p -> CAST(conv(substring(md5(CAST(p AS BINARY)), 1, 15), 16, 10) AS BIGINT)))"
    )


def paragraph_digests(text: str) -> Column:
    """The distinct 60-bit digests of the paragraphs, which are what line breaks separate."""
    return F.expr(_digests(text))


def _second(x: str, level: int) -> str:
    """A second hash of a digest. Its products are not linear in the digest's bits, so digests
    joined by exclusive or do not pass for one; other levels deal otherwise."""
    return (
        f"(({x} & {(1 << LOW_BITS) - 1}L) * {LOW + 2 * 7919 * level}L)"
        f" ^ (shiftright({x}, {LOW_BITS}) * {HIGH + 2 * 104729 * level}L)"
    )


def _items(digests: str, level: int) -> str:
    """(x, y, p): digest, second hash, and the cells it is in, one of each row of cells."""
    places = ", ".join(
        f"CAST(shiftright(y, {24 + 5 * row}) & {SLOTS - 1} AS INT) + {row * SLOTS}" for row in range(HASHES)
    )
    item = _let("y", _second("x", level), f"named_struct('x', x, 'y', y, 'p', array({places}))")
    return f"transform({digests}, x -> {item})"


ZERO = "named_struct('n', 0, 'x', 0L, 'y', 0L)"


def _cell(n: str, x: str, y: str) -> str:
    return f"named_struct('n', {n}, 'x', {x}, 'y', {y})"


def _table(items: str) -> str:
    """The cells: how many digests are in each, and the digests and hashes joined by xor."""
    return (
        f"transform(sequence(0, {CELLS - 1}), cell -> aggregate("
        f"filter({items}, e -> array_contains(e.p, cell)), {ZERO}, "
        f"(s, e) -> {_cell('s.n + 1', 's.x ^ e.x', 's.y ^ e.y')}))"
    )


def _subtracted(one: str, other: str) -> str:
    return f"zip_with({one}, {other}, (a, b) -> {_cell('a.n - b.n', 'a.x ^ b.x', 'a.y ^ b.y')})"


def _peeled(cells: str, level: int) -> str:
    """The digests that two versions do not share, from the difference of their tables:
    (x, n) with n = 1 for those of the first, -1 for those of the second; null if cells are
    left from which no digest can be told.

    A cell with a single digest gives it away; it is taken out of all its cells, which lays
    open others. Every step empties a cell, so there are no more steps than cells.
    """
    pure = f"IF(abs(c.n) = 1, {_second('c.x', level)} = c.y, false)"
    rows = " OR ".join(
        f"i = CAST(shiftright(one.y, {24 + 5 * row}) & {SLOTS - 1} AS INT) + {row * SLOTS}"
        for row in range(HASHES)
    )
    without = f"transform(s.cells, (c, i) -> IF({rows}, {_cell('c.n - one.n', 'c.x ^ one.x', 'c.y ^ one.y')}, c))"
    step = _let("one", f"get(filter(s.cells, c -> {pure}), 0)", (
        "IF(one IS NULL, named_struct('cells', s.cells, 'found', s.found, 'stuck', true), "
        f"named_struct('cells', {without}, 'found', "
        "concat(s.found, array(named_struct('x', one.x, 'n', one.n))), 'stuck', false))"
    ))
    start = f"named_struct('cells', {cells}, 'found', CAST(array() AS {FOUND}), 'stuck', false)"
    left = "exists(s.cells, c -> c.n <> 0 OR c.x <> 0 OR c.y <> 0)"
    return (
        f"aggregate(sequence(0, {CELLS}), {start}, (s, k) -> IF(s.stuck, s, {step}), "
        f"s -> IF({left}, NULL, s.found))"
    )


def sketch(digests: str) -> Column:
    """The table that serves as a fingerprint: of one size, whatever the text."""
    return F.expr(_let("items", _items(digests, 0), _table("items")))


def _retried(one: str, other: str, level: int) -> str:
    """The same from 4**level tables. Bits of the second hash, dealt anew on each level, say
    which of them a digest is in, by two numbers so that no digest is looked at for each."""
    sides = 1 << level
    near, far = 44, 44 - level - 5  # above the bits of the places, and a piece apart in the low ones
    of = lambda items, shift, n: f"filter({items}, e -> shiftright(e.y, {shift}) & {sides - 1} = {n})"
    numbers = f"sequence(0, {sides - 1})"
    table = _peeled(_subtracted(_table("own_a"), _table("own_b")), level)
    # Tables without digests have nothing to give away.
    table = f"IF(size(own_a) + size(own_b) = 0, CAST(array() AS {FOUND}), {table})"
    inner = _let("own_a", of("some_a", near, "v"), _let("own_b", of("some_b", near, "v"), table))
    some = _let("some_a", of("all_a", far, "u"), _let(
        "some_b", of("all_b", far, "u"), f"transform({numbers}, v -> {inner})"))
    # Null if any of the tables is.
    tables = f"flatten(flatten(transform({numbers}, u -> {some})))"
    return _let("all_a", _items(one, level), _let("all_b", _items(other, level), tables))


def _differences(one: str, other: str, one_sketch: str, other_sketch: str) -> str:
    tries = [_peeled(_subtracted(one_sketch, other_sketch), 0)]
    tries += [_retried(one, other, level) for level in range(1, RETRIES + 1)]
    return f"coalesce({', '.join(tries)})"


def differences(one: str, other: str, one_sketch: str, other_sketch: str) -> Column:
    """The digests that only one of two documents has, as (x, n): n is 1 or -1.

    Their sketches are subtracted and peeled; where that leaves cells over, larger and larger
    tables are made from the digests. A difference that even four to the tenth tables do not
    give away would be null.
    """
    return F.expr(_differences(one, other, one_sketch, other_sketch))


def likeness(one: str, other: str, one_sketch: str, other_sketch: str) -> Column:
    """Shared paragraphs among all of two documents, from what is found to differ; two
    documents without any paragraph are alike."""
    total = f"(size({one}) + size({other}))"
    share = f"IF({total} + d > 0, CAST({total} - d AS DOUBLE) / CAST({total} + d AS DOUBLE), 1.0D)"
    differ = _differences(one, other, one_sketch, other_sketch)
    return F.expr(_let("d", f"size({differ})", share))


def fingerprint(cells: Column) -> Column:
    """The cells of a sketch as text."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(
        ":", c["n"].cast("string"), F.lower(F.hex(c["x"])), F.lower(F.hex(c["y"])))), ",")


def with_next(rows: DataFrame, id: str, columns: list[str]) -> DataFrame:
    """Adds ``next``: the named columns of the next row by descending ``id``, after the last
    one those of the first. Wants a column ``text``; rows of one id go by its hash, then by
    itself, also descending, null ids come last.

    Sampled splitters deal the rows into buckets. A splitter is the first row of its bucket
    and is also sent to the bucket before, as its end, so every row meets its successor and
    no row is sent elsewhere again.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("key", F.struct(F.col(id).alias("id"), F.xxhash64("text").alias("hash")))
    n = rows.count()
    if n == 0:
        return rows.withColumn("next", F.struct(*columns))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * SPLITTERS_PER_PARTITION
    share = min(1.0, buckets * SAMPLES_PER_SPLITTER / n)
    top = rows.agg(F.max(id).alias("top")).first().top
    first = keyed.where(F.col(id).eqNullSafe(F.lit(top))).agg(F.max("key").alias("key"))
    sample = keyed.select("key").sample(share, seed=7).unionByName(first).distinct()
    # A bounded number of ids and hashes for each partition.
    keys = [tuple(r.key) for r in sample.orderBy(F.desc("key")).collect()]
    keys = [keys[len(keys) * i // buckets] for i in range(min(buckets, len(keys)))]
    keys = list(dict.fromkeys(keys))
    kind = rows.schema[id].dataType
    width = max(1, int(len(keys) ** 0.5))
    every = F.arrays_zip(
        F.array(*[F.lit(k).cast(kind) for k, _ in keys]).alias("id"),
        F.array(*[F.lit(h).cast("bigint") for _, h in keys]).alias("hash"),
    )
    coarse = F.filter(every, lambda _, i: i % width == 0)

    def up_to(list_: Column) -> Column:
        return F.size(F.filter(list_, lambda s: s >= F.col("key")))

    placed = keyed.withColumn("block", up_to(coarse) - 1).withColumn(
        "some", F.slice(every, F.col("block") * width + 1, F.lit(width))
    ).withColumn("bucket", F.col("block") * width + up_to(F.col("some")) - 1)
    opens = F.get("some", F.col("bucket") % width) == F.col("key")
    before = F.pmod(F.col("bucket") - 1, F.lit(len(keys)))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("sent"))
    to = F.when(opens, F.array(own, F.struct(before.alias("bucket"), F.lit(True).alias("sent"))))
    dealt = placed.withColumn("to", F.explode(F.coalesce(to, F.array(own)))).drop("block", "some")
    order = [F.col("to.sent"), F.desc("key"), F.desc("text")]
    window = Window.partitionBy("to.bucket").orderBy(*order)
    found = dealt.withColumn("next", F.lead(F.struct(*columns)).over(window))
    return found.where(~F.col("to.sent")).select(*rows.columns, "next")


def edited_text(text: str, n: str, next_text: Column) -> Column:
    """The last half of a text's code points replaced by the first ones of the next text."""
    half = F.floor(F.col(n) / 2).cast("int")
    return F.concat(
        F.substring(F.col(text), F.lit(1), (F.col(n) - half).cast("int")),
        F.substring(next_text, F.lit(1), half),
    )


def paragraph_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    A fingerprint is an invertible Bloom lookup table of the set of a text's paragraphs; texts
    with the same set have the same one. Two are compared by subtracting cells and peeling
    what is left, with larger tables where that fails, so the likeness is exact: shared
    paragraphs among all. The edited text has its last half replaced by the beginning of the
    next document, by descending id and after the last one the first. A null text is empty;
    two empty ones are alike. Null ids come last; rows of one id go by the hash of their
    texts; equal rows follow one another and meet in one task, where they are read one by one.
    Only the two columns are read. One shuffle carries the texts; all else is done in place.
    """
    rows = docs.select(F.col(id).alias("doc_id"), body(text).alias("text"))
    rows = rows.withColumn("parts", paragraph_digests("text"))
    rows = with_next(rows, "doc_id", ["text", "parts"])
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", edited_text("text", "n_chars", F.col("next.text")))
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "parts", paragraph_digests("edited").alias("edited_parts"),
        F.col("next.parts").alias("next_parts"),
    )
    sketches = {f"{c}sketch": sketch(f"{c}parts") for c in ("", "edited_", "next_")}
    rows = rows.withColumns(sketches)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness("parts", "edited_parts", "sketch", "edited_sketch").alias("near_edited"),
        likeness("parts", "next_parts", "sketch", "next_sketch").alias("near_next"),
    )
