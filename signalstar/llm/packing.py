"""Vector bin packing of token sequences under limits on tokens, segments and loss tokens."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body

CAPACITY = 1024
MAX_SEGMENTS = 64
ITEMS_AT_ONCE = 2048  # items weighed against each other; whole partitions pass through

# Latin text, on which both encoders of the vocabulary split alike.
_LATIN = regex.compile(r"[\x09\x0A\x0D\x20-\x7E¡-ɏ‐-‧€]*")

PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Encoder:
    """Ids of a byte-level vocabulary.

    The reference is the ``tokenizers`` library. Latin text without the names of special
    tokens goes through a faster encoder of the same vocabulary, whose ids are the same.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import public_tokenizers as public
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary or public.path("byte_bpe_50k.json"))
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        with open(ranks or public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public.PATTERN, special_tokens={},
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
        )

    def ids(self, text: str) -> np.ndarray:
        if _LATIN.fullmatch(text) and not any(name in text for name in self.special):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def next_bin(demand: np.ndarray, alive: np.ndarray, limit: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Fill one bin: again and again the item whose demand best fits what is left.

    ``demand``: items by resources. Fit is the dot product of the item's demand and the
    bin's rest, both as shares of the limits, each resource weighted by its mean demand.
    Chosen items are struck from ``alive``.
    """
    shares = demand / limit
    weight = shares[alive].mean(axis=0)
    rest, chosen = limit.astype(np.int64).copy(), []
    while True:
        fits = alive & (demand <= rest).all(axis=1)
        if not fits.any():
            return chosen, rest
        score = np.where(fits, shares @ (weight * rest / limit), -1.0)
        best = int(score.argmax())
        alive[best] = False
        rest -= demand[best]
        chosen.append(best)


class Packer:
    """Packs the pieces of one task; holds at most ITEMS_AT_ONCE rests of documents.

    A piece is (doc, start, ids, document length). Pieces of full capacity are sequences of
    their own. The others wait until enough have come, then fill bins; a bin that no whole
    piece fits any more is filled up by cutting one. What cannot fill a bin at the very end
    is cut at powers of two, where sequences need no padding.
    """

    def __init__(self, part: int, capacity: int, max_segments: int):
        self.limit = np.array([capacity, max_segments, capacity], np.int64)
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []
        self.sequence = part << 33

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append(
                (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                 self.sequence, offset)
            )
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> None:
        capacity, total = int(self.limit[0]), len(ids)
        whole = total - total % capacity
        for start in range(0, whole, capacity):
            self._emit([(doc, start, ids[start : start + capacity], total)])
        if whole < total:
            self.waiting.append((doc, whole, ids[whole:], total))
        if len(self.waiting) >= ITEMS_AT_ONCE:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        pieces = self.waiting
        demand = np.array([(len(p[2]), 1, len(p[2])) for p in pieces], np.int64).reshape(-1, 3)
        alive = np.ones(len(pieces), bool)
        while alive.any():
            chosen, rest = next_bin(demand, alive, self.limit)
            bin_ = [pieces[i] for i in chosen]
            if rest[0] and rest[1] and alive.any():
                cut = int(np.where(alive, demand[:, 0], -1).argmax())
                doc, start, ids, total = pieces[cut]
                n = int(rest[0])
                bin_.append((doc, start, ids[:n], total))
                pieces[cut] = (doc, start + n, ids[n:], total)
                demand[cut, [0, 2]] -= n
                rest[0] = 0
            if rest[0] == 0:
                self._emit(bin_)
            elif not last and not alive.any():
                self.waiting = bin_
                return
            else:
                self._powers(bin_)
        self.waiting = []

    def _powers(self, pieces: list[tuple]) -> None:
        """Sequences whose lengths are the powers of two in the pieces' total."""
        total = sum(len(p[2]) for p in pieces)
        pieces = pieces[::-1]
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            taken = []
            while size:
                doc, start, ids, length = pieces.pop()
                taken.append((doc, start, ids[:size], length))
                if len(ids) > size:
                    pieces.append((doc, start + size, ids[size:], length))
                size -= len(taken[-1][2])
            self._emit(taken)

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * 7
        self.rows = []
        types = [id_type] + [pa.int64()] * 6
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )


def pack_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS, vocabulary: str | None = None, ranks: str | None = None,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    Every document ends with id 0, so a null or empty text is that one token; all ids bear
    loss. Each scan task packs its own rows, so nothing is shuffled, memory is bounded by
    the largest text and ITEMS_AT_ONCE rests, and a lost task packs the same rows again.
    Rows with equal ids or texts are separate documents; only ``id`` and ``text`` are read.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        packer = Packer(TaskContext.get().partitionId(), capacity, max_segments)
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, np.append(encoder.ids(whole.as_py()), np.uint32(0)))
            yield packer.batch(id_type)
        if id_type is not None:
            packer.pack(last=True)
            yield packer.batch(id_type)

    rows = docs.select(F.col(id).alias("doc_id"), body(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(pack, PIECES.format(id=id_type))


EXAMPLES = "example_id {id}, tokens long, loss_tokens long, sequence_id long, segment long"


def pack_examples(
    examples: DataFrame, id: str, tokens: str, loss_tokens: str, capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS, max_loss: int = CAPACITY,
) -> DataFrame:
    """Whole instruction examples in sequences that keep all three limits.

    Examples are never cut. One that breaks a limit alone, or has a null size, gets a null
    sequence, for the caller to split. Each task packs its own rows.
    """
    limit = np.array([capacity, max_segments, max_loss], np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, ITEMS_AT_ONCE):
                some = batch.slice(at, ITEMS_AT_ONCE)
                sizes = np.stack(
                    [some.column(i).fill_null(-1).to_numpy() for i in (1, 2)], axis=1
                ).astype(np.int64)
                demand = np.stack([sizes[:, 0], np.ones(len(sizes), np.int64), sizes[:, 1]], axis=1)
                alive = (demand <= limit).all(axis=1) & (sizes >= 0).all(axis=1)
                into, place = np.full(len(sizes), -1), np.full(len(sizes), -1)
                while alive.any():
                    chosen, _ = next_bin(demand, alive, limit)
                    into[chosen], place[chosen] = sequence, np.arange(len(chosen))
                    sequence += 1
                out = [pa.array(x, mask=into < 0) for x in (into, place)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), *out],
                    names=["example_id", "tokens", "loss_tokens", "sequence_id", "segment"],
                )

    rows = examples.select(
        F.col(id).alias("example_id"), F.col(tokens).cast("long").alias("tokens"),
        F.col(loss_tokens).cast("long").alias("loss_tokens"),
    )
    id_type = rows.schema["example_id"].dataType.simpleString()
    return rows.mapInArrow(pack, EXAMPLES.format(id=id_type))
