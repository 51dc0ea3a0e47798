"""Phrases whose words keep company, counted by double-array tries of candidates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstar.llm.common import body, chunks, stored

SUPPORT = 10  # occurrences that make a phrase a candidate
SCALE = 1_000_000
TOP = 2000
COVERED = 50  # percent of a phrase's occurrences inside a longer one that make it redundant
BLOCK = 2 << 20  # bytes of text whose positions are advanced at once
FIRST_KEY, SECOND_KEY = "first of the two", "second as a test"  # of hashes of words
HELD_WORDS, HELD_HASHES = 1 << 18, 1 << 20  # what a task adds up before it sends it
SENT = 1 << 16  # rows that are sent at once
FILTER_BITS = 1 << 26  # of a filter of hashes, 8 MB whatever the corpus
SHARD_PHRASES, SHARD_BYTES = 1 << 16, 8 << 20  # what one trie may hold
HELD_WINDOWS = 1 << 19  # beginnings of phrases that a task adds up before it sends them
WALKED = 1 << 17  # windows that go through a trie at once

SPACES = b"\x20\x09"
BREAKS = b".,;:!?\n\x0b\f\r"

# What each byte is: 0 part of a word, 1 between words, 2 between pieces; letters A-Z in lower case.
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """The words of some texts of one language, in order."""

    lang: str
    spelled: pa.Array  # the distinct words
    codes: np.ndarray  # of each position, the word's index in ``spelled``
    linked: np.ndarray  # of each position, whether the next word is in the same piece

    def pairs(self) -> np.ndarray:
        """Positions at which a phrase of two words begins."""
        return np.flatnonzero(self.linked)

    def triples(self) -> np.ndarray:
        return np.flatnonzero(self.linked[:-1] & self.linked[1:]) if len(self.linked) > 1 else self.pairs()[:0]

    def hashes(self, key: str = FIRST_KEY) -> np.ndarray:
        """64 bits of the language and each distinct word."""
        words = self.spelled.to_numpy(zero_copy_only=False)
        seed = np.uint64(xxhash.xxh64_intdigest(self.lang))
        return (hash_array(words, hash_key=key, categorize=False) ^ seed) * np.uint64(0x9E3779B97F4A7C15)

    def both_hashes(self) -> list[np.ndarray]:
        """Two hashes of the language and word at each position."""
        return [self.hashes(key)[self.codes] for key in (FIRST_KEY, SECOND_KEY)]

    def phrases(self, *codes: np.ndarray) -> pa.Array:
        """The words with these indices, joined by a space."""
        parts = [self.spelled.take(pa.array(c)) for c in codes]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return joined.cast(pa.string())


def _blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes in blocks that end where a piece does; a longer piece is a block of its own."""
    at = 0
    while len(data) - at > BLOCK:
        end = at + BLOCK
        while end < len(data):
            some = np.flatnonzero(_KIND[data[end : end + BLOCK]] == 2)
            if len(some):
                end += int(some[0])
                break
            end += BLOCK
        yield data[at:end]
        at = min(end, len(data))
    yield data[at:]


def _words(lang: str, data: np.ndarray) -> Words | None:
    kind = _KIND[data]
    inside = kind == 0
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return None
    letters = _LOWER[data[inside]]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    spelled = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    breaks = np.flatnonzero(kind == 2)
    piece = np.searchsorted(breaks, starts)
    return Words(
        lang, spelled.dictionary, spelled.indices.to_numpy(zero_copy_only=False),
        np.append(piece[1:] == piece[:-1], False),
    )


def words_of(batch: pa.RecordBatch) -> Iterator[Words]:
    """The words of a batch of (lang, text), by language and block. A text's end ends a piece."""
    for chunk in chunks(batch, "text", BLOCK):
        langs = chunk.column("lang").dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = chunk.column("text").filter(pc.equal(langs.indices, code))
            joined = b"\n".join(t.as_buffer() for t in own)
            for block in _blocks(np.frombuffer(joined, np.uint8)):
                words = _words(lang, block)
                if words:
                    yield words


WORD_ROWS = "lang string, phrase string, hash long, n long"
HASH_ROWS = "hash long, test int, n long, mark int"
PHRASE_ROWS = "lang string, phrase string, length int, hash long, test int"


def _slots(hashes: np.ndarray) -> np.ndarray:
    return hashes % np.uint64(FILTER_BITS)


def _joined(hashes: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Hashes of the phrases of ``count`` words that begin at these positions."""
    out = hashes[at]
    for k in range(1, count):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k]
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first level: every word with its hash and occurrences, those of some blocks added up."""
    held: list[pa.RecordBatch] = []

    def added() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).group_by(["lang", "phrase", "hash"], use_threads=False)
        sums = rows.aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "hash", "n"])
        held.clear()
        yield from sums.to_batches(SENT)

    for batch in batches:
        for words in words_of(batch):
            counts = np.bincount(words.codes, minlength=len(words.spelled))
            held.append(pa.RecordBatch.from_arrays(
                [pa.repeat(words.lang, len(counts)), words.spelled.cast(pa.string()),
                 pa.array(words.hashes().view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "phrase", "hash", "n"],
            ))
            if sum(b.num_rows for b in held) >= HELD_WORDS:
                yield from added()
    if held:
        yield from added()


def _marks(words: Words, hashes: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """31 bits of the words around the phrases of ``count`` words at these positions, as far as
    their pieces go: the same wherever a piece is read."""
    # The position after the last is the one before the first, and neither is linked to a word.
    around = np.append(hashes, np.uint64(0))
    linked = np.append(words.linked, False)
    before = np.where(linked[at - 1], around[at - 1], np.uint64(0))
    end = at + count - 1
    after = np.where(linked[end], around[end + 1], np.uint64(0))
    mixed = (before ^ (before >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + after
    return (mixed >> np.uint64(33)).astype(np.int32)


def _tests(second: np.ndarray) -> np.ndarray:
    """32 bits of a second hash."""
    return (second >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hashed(words: Words, hashes: list[np.ndarray], at: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
    """The hashes, tests and marks of the phrases of ``count`` words at these positions."""
    first, second = (_joined(h, at, count) for h in hashes)
    return first, _tests(second), _marks(words, hashes[0], at, count)


def _hash_counts(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Hashes with their tests, occurrences and smallest marks, those of some blocks added up.
    Tests that meet in one hash may leave more than one row of each."""
    held: list[tuple[np.ndarray, ...]] = []

    def added() -> Iterator[pa.RecordBatch]:
        hashes, tests, marks = (np.concatenate(column) for column in zip(*held))
        held.clear()
        if not len(hashes):
            return
        order = np.argsort(hashes)
        hashes, tests, marks = hashes[order], tests[order], marks[order]
        other = (hashes[1:] != hashes[:-1]) | (tests[1:] != tests[:-1])
        starts = np.flatnonzero(np.append(True, other))
        counts = np.diff(np.append(starts, len(hashes)))
        rows = pa.table({"hash": hashes[starts].view(np.int64), "test": tests[starts],
                         "n": counts.astype(np.int64), "mark": np.minimum.reduceat(marks, starts)})
        yield from rows.to_batches(SENT)

    for part in parts:
        held.append(part)
        if sum(len(p[0]) for p in held) >= HELD_HASHES:
            yield from added()
    if held:
        yield from added()


class _Seen:
    """The phrases that a task has sent, by 128 bits of hash. Two that share the first 64 are
    told apart by the others, and one that has no place of its own is sent again."""

    def __init__(self) -> None:
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        if not len(self.first):
            return np.zeros(len(first), bool)
        place = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return (self.first[place] == first) & (self.second[place] == second)

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        first, at = np.unique(first, return_index=True)
        place = np.searchsorted(self.first, first)
        self.first = np.insert(self.first, place, first)
        self.second = np.insert(self.second, place, second[at])


def _new_phrases(words: Words, at: np.ndarray, length: int, hashes: list[np.ndarray], seen: _Seen):
    """The distinct phrases at these positions that the task has not sent yet."""
    first, second = (_joined(h, at, length) for h in hashes)
    new = ~seen(first, second)
    at, first, second = at[new], first[new], second[new]
    if not len(at):
        return
    key = words.codes[at].astype(np.int64)
    size = len(words.spelled)
    for k in range(1, length):
        if length == 3 and k == 2:
            # Pairs are numbered anew, so that three indices cannot pass 64 bits.
            _, key = np.unique(key, return_inverse=True)
        key = key * size + words.codes[at + k]
    _, one = np.unique(key, return_index=True)
    at, first, second = at[one], first[one], second[one]
    seen.add(first, second)
    phrases = words.phrases(*[words.codes[at + k] for k in range(length)])
    rows = pa.table({
        "lang": pa.repeat(words.lang, len(at)), "phrase": phrases,
        "length": pa.repeat(pa.scalar(length, pa.int32()), len(at)), "hash": first.view(np.int64),
        "test": _tests(second),
    })
    yield from rows.to_batches(SENT)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = _slots(hashes)
    return (bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _filter_bits(counted: DataFrame) -> np.ndarray:
    """The places of all frequent phrases in a filter of fixed size.

    A phrase that is not frequent may pass by chance, one that is always does.
    """
    slots = counted.select(F.col("hash").bitwiseAND(FILTER_BITS - 1).alias("slot"))
    masks = slots.selectExpr("slot div 32 AS word", "shiftleft(1L, CAST(slot % 32 AS INT)) AS bit")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1).astype("<u4")
            yield pa.RecordBatch.from_arrays([pa.array([pairs.tobytes()], pa.binary())], names=["pairs"])

    packed = masks.groupBy("word").agg(F.bit_or("bit").alias("bits")).mapInArrow(pack, "pairs binary")
    bits = np.zeros(FILTER_BITS // 32, "<u4")
    # As much as the filter is large, however many phrases there are.
    for row in packed.toLocalIterator():
        pairs = np.frombuffer(row.pairs, "<u4").reshape(-1, 2)
        bits[pairs[:, 0]] = pairs[:, 1]
    return bits.view(np.uint8)


def _candidates(texts: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, length of all phrases of two and three words that may be frequent.

    Level by level: a phrase can only be frequent if its parts are. Pairs are counted where both
    words are frequent, three words where both pairs are, each in the text itself, so there is
    never more than the text holds. Levels are counted by hashes of 96 bits; phrases that share
    one are counted together, and what is not frequent leaves by the exact counts later. Only phrases with a frequent hash are then spelled, and only where they
    stand among the words with the smallest mark, which few tasks hold.
    """
    spark = texts.sparkSession
    word_bits = spark.sparkContext.broadcast(_filter_bits(words.where(F.col("n") >= SUPPORT)))

    def frequent(count, name: str) -> DataFrame:
        counted = texts.mapInArrow(lambda batches: _hash_counts(count(batches)), HASH_ROWS)
        summed = counted.groupBy("hash", "test").agg(F.sum("n").alias("n"), F.min("mark").alias("mark"))
        return stored(summed.where(F.col("n") >= SUPPORT).drop("n"), name)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for w in words_of(batch):
                hashes, at = w.both_hashes(), w.pairs()
                known = _has(word_bits.value, hashes[0])
                yield _hashed(w, hashes, at[known[at] & known[at + 1]], 2)

    two = frequent(pairs, "pair-hashes")
    pair_bits = spark.sparkContext.broadcast(_filter_bits(two))

    def known_pairs(w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of pairs that may be frequent, and of three words whose pairs are."""
        at, known = w.pairs(), np.zeros(len(hashes), bool)
        known[at] = _has(pair_bits.value, _joined(hashes, at, 2))
        triples = w.triples()
        return np.flatnonzero(known), triples[known[triples] & known[triples + 1]]

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for w in words_of(batch):
                hashes = w.both_hashes()
                yield _hashed(w, hashes, known_pairs(w, hashes[0])[1], 3)

    three = frequent(triples, "triple-hashes")
    often = two.withColumn("length", F.lit(2)).unionByName(three.withColumn("length", F.lit(3)))
    marked = often.select(F.col("hash").bitwiseXOR(F.col("mark").cast("long")).alias("hash"))
    marked_bits = spark.sparkContext.broadcast(_filter_bits(marked))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {2: _Seen(), 3: _Seen()}
        for batch in batches:
            for w in words_of(batch):
                hashes = w.both_hashes()
                for length, at in zip((2, 3), known_pairs(w, hashes[0])):
                    marks = _marks(w, hashes[0], at, length).astype(np.uint64)
                    at = at[_has(marked_bits.value, _joined(hashes[0], at, length) ^ marks)]
                    yield from _new_phrases(w, at, length, hashes, seen[length])

    # Tasks send a phrase once, so adding up before the shuffle would find nothing to add.
    found = texts.mapInArrow(spelled, PHRASE_ROWS).repartition("hash").distinct()
    both = stored(found.join(often, ["hash", "test", "length"], "left_semi").drop("hash", "test"), "phrases-spelled")
    for bits in (word_bits, pair_bits, marked_bits):
        bits.unpersist()
    return both


class Trie:
    """A double array over word numbers, for phrases of two and three words.

    A word's number is read as three digits, so that no state has more children than the cube
    root of the words, and the array is filled well. From state s the digit d leads to base[s] + d, if check there
    is s. The first word of a phrase leads from the root to the state of its number. ``phrase``
    names the phrase that a state accepts, or is -1.
    """

    ALONE = 16  # a state with more children gets a window of its own

    def __init__(self, phrases: np.ndarray, words: int):
        """``phrases``: three word numbers in each row, the third -1 in a phrase of two."""
        self.digits = max(2, int(np.ceil(np.cbrt(words))))
        self.base = np.zeros(words, np.int64)
        self.check = np.full(words, -2, np.int64)
        self.free = np.zeros(words, bool)
        pairs, of_pair = np.unique(phrases[:, :2], axis=0, return_inverse=True)
        of_pair = of_pair.reshape(-1)
        three = np.flatnonzero(phrases[:, 2] >= 0)
        two = np.flatnonzero(phrases[:, 2] < 0)
        pair_states = self._child(pairs[:, 0], pairs[:, 1])
        triple_states = self._child(pair_states[of_pair[three]], phrases[three, 2])
        self.base, self.check = self.base.astype(np.int32), self.check.astype(np.int32)
        self.phrase = np.full(len(self.check), -1, np.int32)
        self.phrase[pair_states[of_pair[two]]] = two
        self.phrase[triple_states] = three
        del self.free

    def _split(self, numbers: np.ndarray) -> list[np.ndarray]:
        return [numbers // self.digits**k % self.digits for k in (2, 1, 0)]

    def _child(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The states that these words lead to: one step for each digit."""
        for digits in self._split(numbers):
            steps, which = np.unique(np.stack([states, digits], axis=1), axis=0, return_inverse=True)
            states = self._place(steps[:, 0], steps[:, 1])[which.reshape(-1)]
        return states

    def _grow(self, more: int) -> None:
        self.base = np.append(self.base, np.zeros(more, np.int64))
        self.check = np.append(self.check, np.full(more, -1, np.int64))
        self.free = np.append(self.free, np.ones(more, bool))

    def _place(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """States for distinct children, given by parent and digit; sets the parents' bases.

        Large families come first, each in a window of its own. The others try random places,
        a class of sizes at a time: a family stays if all of its places are free and no other
        one claims them. Single children fill the gaps.
        """
        if not len(parents):
            return parents
        order = np.lexsort((digits, parents))
        parents, digits = parents[order], digits[order]
        starts = np.flatnonzero(np.diff(parents, prepend=-1))
        sizes = np.diff(np.append(starts, len(parents)))
        states = np.empty(len(parents), np.int64)

        def children(families: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rows of all children of these families, and where each family begins in them."""
            n = sizes[families]
            heads = np.cumsum(n) - n
            return np.repeat(starts[families] - heads, n) + np.arange(n.sum()), heads

        def settle(families: np.ndarray, bases: np.ndarray) -> None:
            rows, _ = children(families)
            self.base[parents[starts[families]]] = bases
            states[rows] = np.repeat(bases, sizes[families]) + digits[rows]
            self.check[states[rows]] = parents[rows]
            self.free[states[rows]] = False

        large = np.flatnonzero(sizes > self.ALONE)
        window = len(self.check)
        self._grow(len(large) * self.digits)
        settle(large, window + np.arange(len(large)) * self.digits)
        short = self.digits + int(1.3 * sizes[sizes <= self.ALONE].sum()) - int(self.free.sum())
        self._grow(max(0, short))
        random = np.random.default_rng(13)
        most = self.ALONE
        claim = np.zeros(len(self.check), np.int32)
        while most > 1:
            waiting, tried = np.flatnonzero((sizes <= most) & (sizes > most // 2)), 0
            while len(waiting):
                bases = random.integers(0, len(self.check) - self.digits + 1, len(waiting))
                rows, heads = children(waiting)
                places = np.repeat(bases, sizes[waiting]) + digits[rows]
                family = np.repeat(np.arange(len(waiting)), sizes[waiting])
                claim[places] = family
                good = np.logical_and.reduceat(self.free[places] & (claim[places] == family), heads)
                settle(waiting[good], bases[good])
                tried = 0 if good.mean() > 0.03 else tried + 1
                if tried == 32:
                    self._grow(len(self.check) // 4)
                    tried = 0
                    claim = np.zeros(len(self.check), np.int32)
                waiting = waiting[~good]
            most //= 2
        single = np.flatnonzero(sizes == 1)
        places = np.flatnonzero(self.free)[: len(single)]
        settle(single, places - digits[starts[single]])
        out = np.empty(len(parents), np.int64)
        out[order] = states
        return out

    def counts(
        self, numbers: np.ndarray, linked: np.ndarray, phrases: int, times: np.ndarray | None = None
    ) -> np.ndarray:
        """How often each phrase is accepted. ``numbers``: word numbers by position, -1 for
        words that no phrase has; all positions go from level to level together. ``times``: how
        often what begins at each position counts, once if it is not given."""
        size = len(self.check)
        total = np.zeros(phrases, np.int64)
        split = [digits.astype(np.int32) for digits in self._split(np.maximum(numbers, 0))]
        at = np.flatnonzero(linked & (numbers >= 0) & (True if times is None else times > 0))
        states = numbers[at]
        for k in (1, 2):
            on = numbers[at + k] >= 0
            at, states = at[on], states[on]
            for digits in split:
                to = self.base[states] + digits[at + k]
                on = (to >= 0) & (to < size)
                on[on] = self.check[to[on]] == states[on]
                at, states = at[on], to[on]
            accepted = self.phrase[states]
            on = accepted >= 0
            # Sums in doubles are exact below 2^53.
            often = None if times is None else times[at[on]]
            total += np.bincount(accepted[on], often, minlength=phrases).astype(np.int64)
            on = linked[at + k]
            at, states = at[on], states[on]
        return total


def _named(lang: str, spelled: pa.Array) -> pa.Array:
    """The words with their language; as no word has a space, no two are the same."""
    some = [pa.scalar(x, pa.large_binary()) for x in (lang.encode(), b" ")]
    return pc.binary_join_element_wise(some[0], spelled, some[1])


def _by_lang(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[pa.Array, Words, np.ndarray]]:
    """By language: phrases, their words, each phrase a piece, and where it begins in them."""
    langs = rows["lang"]
    for lang in pc.unique(langs).to_pylist():
        phrases = rows["phrase"].filter(pc.equal(langs, lang))
        if isinstance(phrases, pa.ChunkedArray):
            phrases = phrases.combine_chunks()
        split = pc.split_pattern(phrases.cast(pa.large_string()), " ")
        spelled = split.values.cast(pa.large_binary()).dictionary_encode()
        begins = split.offsets.to_numpy()
        linked = np.ones(len(spelled), bool)
        linked[begins[1:] - 1] = False
        codes = spelled.indices.to_numpy(zero_copy_only=False)
        yield phrases, Words(lang, spelled.dictionary, codes, linked), begins[:-1]


KEYED_ROWS = "lang string, phrase string, hash long, pair long"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases with their hashes and those of their first two words."""
    for batch in batches:
        for phrases, words, at in _by_lang(batch):
            hashes = words.hashes()[words.codes]
            pair = _joined(hashes, at, 2)
            own, longer = pair.copy(), words.linked[at + 1]
            own[longer] = _joined(hashes, at[longer], 3)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(words.lang, len(at)), phrases.cast(pa.string()), pa.array(own.view(np.int64)),
                 pa.array(pair.view(np.int64))], names=["lang", "phrase", "hash", "pair"],
            )


# Candidates, and parcels of windows: how many words and windows a parcel has, and its bytes.
SHARD_ROWS = "shard int, lang string, phrase string, words int, windows int, bytes int, parcel binary"


def _planes(numbers: np.ndarray) -> bytes:
    """All first bytes of the numbers, all second ones and so on, which pack better."""
    return np.ascontiguousarray(numbers, np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(4, -1).T).view(np.int32).ravel()


def _windows(words: Words, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where candidates may begin: hashes of the first two words, and the indices of three
    words, the third -1 where there may only be a phrase of two."""
    hashes, at = words.hashes()[words.codes], words.pairs()
    pair = np.zeros(len(hashes), np.uint64)
    pair[at] = _joined(hashes, at, 2)
    begins, wide = np.zeros((2, len(hashes)), bool)
    begins[at] = _has(bits, pair[at])
    three = words.triples()
    wide[three] = _has(bits, _joined(hashes, three, 3))
    at = np.flatnonzero(begins | wide)
    out = np.full((len(at), 3), -1, np.int32)
    out[:, 0], out[:, 1] = words.codes[at], words.codes[at + 1]
    on = wide[at]
    out[on, 2] = words.codes[at[on] + 2]
    return pair[at], out


def _parcels(held: list[tuple[pa.Array, np.ndarray, np.ndarray]], shards: int) -> pa.RecordBatch:
    """For each shard the distinct windows of some blocks, each with its occurrences."""
    every = pa.concat_arrays([spelled for spelled, _, _ in held]).dictionary_encode()
    number, spelled = every.indices.to_numpy(zero_copy_only=False), every.dictionary
    windows, first = [], 0
    for own, _, some in held:
        # The last stands for -1.
        windows.append(np.append(number[first : first + len(own)], np.int32(-1))[some])
        first += len(own)
    windows = np.concatenate(windows)
    pair = np.concatenate([pair for _, pair, _ in held])
    held.clear()
    # The upper half deals to shards, the lower one brings equal windows together; others that
    # share both only keep equal ones apart, which then are two rows.
    key = (windows[:, 2].astype(np.int64).view(np.uint64) + np.uint64(2)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key = ((key ^ pair) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    key |= pair >> np.uint64(32) << np.uint64(32)
    order = np.argsort(key)
    windows = windows[order]
    other = (windows[1:] != windows[:-1]).any(axis=1)
    starts = np.flatnonzero(np.append(True, other))
    times = np.diff(np.append(starts, len(windows))).astype(np.int32)
    windows = windows[starts]
    shard = ((key[order[starts]] >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
    index = np.full(len(spelled) + 1, -1, np.int32)
    codec, parts = pa.Codec("zstd", 1), []
    for a, b in zip(cuts[:-1], cuts[1:]):
        some = windows[a:b]
        used = np.zeros(len(spelled) + 1, bool)
        used[some] = True
        used[-1] = False
        used = np.flatnonzero(used)
        index[used] = np.arange(len(used), dtype=np.int32)
        words = spelled.take(pa.array(used))
        lengths = pc.binary_length(words).to_numpy()
        data = words.buffers()[2][: int(lengths.sum(dtype=np.int64))].to_pybytes()
        raw = b"".join([_planes(lengths), _planes(index[some].T), _planes(times[a:b]), data])
        parts.append((int(shard[a]), len(used), b - a, len(raw), codec.compress(raw, asbytes=True)))
    columns = list(zip(*parts))
    nothing = pa.nulls(len(parts), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), nothing, nothing, *[pa.array(c, pa.int32()) for c in columns[1:4]],
         pa.array(columns[4], pa.binary())],
        names=["shard", "lang", "phrase", "words", "windows", "bytes", "parcel"],
    )


class _Shard:
    """The candidates of a shard, their trie, and how often it has accepted each."""

    def __init__(self, candidates: pa.Table):
        langs, phrases, spelled, numbers, first = [], [], [], [], 0
        for own, words, at in _by_lang(candidates):
            rows = np.full((len(at), 3), -1, np.int64)
            rows[:, 0], rows[:, 1] = words.codes[at], words.codes[at + 1]
            longer = words.linked[at + 1]
            rows[longer, 2] = words.codes[at[longer] + 2]
            rows[rows >= 0] += first
            first += len(words.spelled)
            langs.append(pa.repeat(words.lang, len(at)))
            phrases.append(own.cast(pa.string()))
            spelled.append(_named(words.lang, words.spelled))
            numbers.append(rows)
        numbers = np.concatenate(numbers)
        self.langs, self.phrases, self.spelled = (pa.concat_arrays(x) for x in (langs, phrases, spelled))
        self.lengths = 2 + (numbers[:, 2] >= 0).astype(np.int32)
        self.trie = Trie(numbers, len(self.spelled))
        self.total = np.zeros(len(numbers), np.int64)
        self.held, self.words, self.windows = [], 0, 0

    def add(self, parcels: pa.RecordBatch) -> None:
        codec = pa.Codec("zstd")
        counts = (parcels[c].to_pylist() for c in ("words", "windows", "bytes"))
        for words, windows, size, parcel in zip(*counts, parcels["parcel"]):
            raw = np.frombuffer(codec.decompress(parcel.as_buffer(), size), np.uint8)
            ends = np.cumsum([4 * words, 12 * windows, 4 * windows])
            lengths, some, times = (_from_planes(x) for x in np.split(raw, ends)[:3])
            some = some.reshape(3, -1)
            some[some >= 0] += self.words
            self.held.append((lengths, raw[ends[2] :], some, times))
            self.words += words
            self.windows += windows
            if self.windows >= WALKED:
                self.walk()

    def walk(self) -> None:
        """What the parcels hold goes through the trie, each window as a piece of its own."""
        if not self.held:
            return
        lengths, data, windows, times = zip(*self.held)
        self.held, self.words, self.windows = [], 0, 0
        offsets = np.append(0, np.cumsum(np.concatenate(lengths), dtype=np.int64))
        spelled = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(data))])
        number = pc.fill_null(pc.index_in(spelled, self.spelled), -1).to_numpy(zero_copy_only=False)
        windows = np.concatenate(windows, axis=1).T
        numbers = np.append(number, np.int32(-1)).astype(np.int64)[windows]
        linked = np.zeros(windows.shape, bool)
        linked[:, :2] = windows[:, 1:] >= 0
        begun = np.zeros(windows.shape, np.int64)
        begun[:, 0] = np.concatenate(times)
        self.total += self.trie.counts(numbers.ravel(), linked.ravel(), len(self.total), begun.ravel())

    def found(self) -> Iterator[pa.RecordBatch]:
        self.walk()
        rows = pa.table({"lang": self.langs, "phrase": self.phrases, "length": self.lengths, "n": self.total})
        yield from rows.filter(pa.array(self.total > 0)).to_batches(SENT)


def _count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, its candidates first."""
    now, waiting, shard = None, [], None
    for batch in batches:
        numbers = batch["shard"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if numbers[a] != now:
                if shard:
                    yield from shard.found()
                now, waiting, shard = numbers[a], [], None
            part = batch.slice(a, b - a)
            candidates = part.num_rows - part["phrase"].null_count
            if candidates:
                waiting.append(part.slice(0, candidates).select(["lang", "phrase"]))
            if candidates == part.num_rows or not waiting and not shard:
                continue  # a shard may have windows and no candidates
            if not shard:
                shard, waiting = _Shard(pa.Table.from_batches(waiting)), []
            shard.add(part.slice(candidates))
    if shard:
        yield from shard.found()


def phrase_counts(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """lang, phrase, length, n of the candidates. They are dealt into shards of bounded size by
    their first two words, and so is, in one pass over the texts, what may begin with them; each
    shard has a trie of its own, so that work grows with the texts, not with the shards too."""
    spark = texts.sparkSession
    keyed = stored(candidates.select("lang", "phrase").mapInArrow(_keyed, KEYED_ROWS), "phrases")
    size = keyed.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("phrase")).alias("bytes")
    ).first()
    need = max(size.rows / SHARD_PHRASES, (size.bytes or 0) / SHARD_BYTES)
    shards = int(need * 5 / 4) + 1  # room for what a hash deals unevenly
    bits = spark.sparkContext.broadcast(_filter_bits(keyed))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for words in words_of(batch):
                pair, windows = _windows(words, bits.value)
                if len(pair):
                    held.append((_named(words.lang, words.spelled), pair, windows))
                if sum(len(pair) for _, pair, _ in held) >= HELD_WINDOWS:
                    yield _parcels(held, shards)
        if held:
            yield _parcels(held, shards)

    shard = F.shiftrightunsigned(F.shiftrightunsigned("pair", 32) * shards, 32).cast("int")
    own = keyed.select(
        shard.alias("shard"), "lang", "phrase",
        *[F.lit(None).cast("int").alias(c) for c in ("words", "windows", "bytes")],
        F.lit(None).cast("binary").alias("parcel"))
    dealt = own.unionByName(texts.mapInArrow(deal, SHARD_ROWS)).repartition("shard")
    sorted_ = dealt.sortWithinPartitions("shard", F.col("phrase").isNull())
    counted = stored(
        sorted_.mapInArrow(_count_shards, "lang string, phrase string, length int, n long"), "phrases-counted")
    bits.unpersist()
    return counted


def _first(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first rows of each language with their rank: first those of each task, then of all."""
    own = rows.withColumn("task", F.spark_partition_id())
    few = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "task").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).where(F.col("rank") <= top).drop("task")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces into
    words at spaces and tabs; ``n`` counts a language's words, ``a`` a phrase's occurrences
    within pieces, overlaps included. A phrase of two or three words with ``a`` of at least ten
    is cut where floor(1000000 a a / (l r)) is lowest, ``l`` and ``r`` being the counts of its
    two parts; ties take the first cut. One of two words that has half of its occurrences or
    more inside a candidate of three is left out.

    A null text is empty, a null language ``und``; other columns are not read; every row counts,
    also repeated ones; a table without frequent phrases gives no rows. Texts are worked on in
    blocks of bounded size that end with a piece, counts are sums, and a phrase, word or language
    that holds most of the rows is summed in each task before anything is sent.
    """
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), body(text).alias("text")
    )
    counted = texts.mapInArrow(_count_words, WORD_ROWS)
    words = stored(counted.groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("n")), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = _candidates(texts, words)
    found = phrase_counts(texts, candidates).where(F.col("n") >= SUPPORT)
    parts = found.select("lang", "phrase", "n").unionByName(
        words.where(F.col("n") >= SUPPORT).select("lang", "phrase", "n"))

    word = F.split("phrase", " ")
    cuts = found.select(
        "lang", "phrase", "length", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"),
    ).withColumns({
        "left": F.array_join(F.slice(word, F.lit(1), F.col("k")), " "),
        "right": F.array_join(F.slice(word, F.col("k") + 1, F.col("length") - F.col("k")), " "),
    })
    named = lambda part, n: parts.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    cuts = cuts.join(named("left", "l"), ["lang", "left"]).join(named("right", "r"), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    square = (exact("a") * exact("a") * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    product = (exact("l") * exact("r")).cast("decimal(38,0)")
    scored = cuts.withColumns({"square": square, "product": product}).withColumn("score", F.expr("square div product"))
    least = scored.groupBy("lang", "phrase", "length", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # The two pairs in each phrase of three, with the count of the longer one.
    inner = found.where("length = 3").select(
        "lang", F.col("n").alias("longer"),
        F.explode(F.array(*[F.array_join(F.slice(word, k, 2), " ") for k in (1, 2)])).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = inner.withColumn("length", F.lit(2))
    left = least.join(covered, ["lang", "phrase", "length"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * COVERED))
    order = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    # One row for each language.
    return _first(left, order, top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )
