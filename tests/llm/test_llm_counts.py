"""Vector codes, paragraph sketches and collocations: brute force and awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_data import TEXTS, no_documents, odd_documents
from pyspark.sql import functions as F

from signalstar.llm import collocations, limb_codes, paragraph_sketch


# --- vector codes ----------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 28])
@pytest.mark.parametrize("bits", [None, 3, 11])
def test_limbs_give_exact_dots(size, bits):
    random_ = np.random.default_rng(size)
    x, y = (random_.integers(-size, size + 1, (n, 7)) for n in (40, 5))
    assert (limb_codes.exact_dots(x, y, bits) == x @ y.T).all()


def test_limb_products_stay_exact_in_doubles():
    for width in (1, 2, 8, 96, 1000):
        assert width * (1 << 2 * limb_codes.limb_bits(width)) <= 1 << 53


def plain_codes(rows, rounds):
    """(id, label, vector) by Python's integers."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    full = [r for r in kept if r[2]]
    if not full:
        return [(r[0], None, None) for r in kept]
    length = len(full[0][2])
    width = -(-length // 8)

    def cut(v):
        whole = [limb_codes._whole(x) for x in v] + [0] * (8 * width - length)
        return [whole[p * width : (p + 1) * width] for p in range(8)]

    vectors = [cut(r[2]) for r in full if len(r[2]) == length]
    books = [[v[p] for v in vectors[:16]] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            members = {}
            for v in vectors:
                members.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for entry, own in members.items():
                books[p][entry] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for r in kept:
        if len(r[2]) != length:
            out.append((r[0], None, None))
            continue
        found = [near(x, books[p]) for p, x in enumerate(cut(r[2]))]
        error = sum(d for d, _ in found)
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), error if error < 1 << 63 else None))
    return out


def vector_rows():
    random_ = random.Random(4)
    rows = [(i, i % 3 if i % 5 else None, [random_.uniform(-1, 1) for _ in range(20)]) for i in range(60)]
    rows += [(7, 1, rows[7][2]), (None, 2, rows[9][2]), (100, 1, None), (101, 1, []), (102, 1, [1.0] * 8),
             (103, 1, [float("nan")] * 20), (104, 1, [float("inf")] * 20), (105, 1, [None] * 20),
             (106, 4, [9e4] * 20), (107, 4, [-3.5e12] * 19 + [0.0]), (108, 4, [1e300] * 20), (109, 4, [0.0] * 20)]
    return rows


def vector_table(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return table.withColumns({c: F.lit("x") for c in ("vector", "code", "error", "label_of", "part")})


@pytest.mark.parametrize("count", [None, 5, 60])
def test_vector_codes_match_brute_force(spark, count):
    rows = vector_rows()[:count]
    got = limb_codes.vector_codes(vector_table(spark, rows).repartition(3), rounds=2)
    key = lambda r: tuple((v is None, v or 0 if not isinstance(v, str) else v) for v in r)
    assert sorted([(r.vec_id, r.code, r.error) for r in got.collect()], key=key) == sorted(plain_codes(rows, 2), key=key)


def test_vector_errors_are_summed_by_label(spark):
    got = limb_codes.vector_codes(vector_table(spark, vector_rows()[:60]), rounds=1).collect()
    total = Counter()
    for r in got:
        total[r.vec_id % 3 if r.vec_id % 5 else None] += r.error
    assert all(r.label_error == total[r.vec_id % 3 if r.vec_id % 5 else None] for r in got)


def test_no_vectors_no_codes(spark):
    table = vector_table(spark, vector_rows())
    assert limb_codes.vector_codes(table.where("vec_id < 0")).count() == 0
    assert [r.code for r in limb_codes.vector_codes(table.where("vec_id = 101")).collect()] == [None]


# --- paragraph sketches ------------------------------------------------------------------


def parts(text):
    return {p for p in re.split(r"[\n\x0B\f\r]+", text) if p}


def plain_fingerprints(rows):
    rows = [(i, t or "") for i, t in rows]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]

        def near(other, own=parts(text)):
            return len(own & parts(other)) / len(own | parts(other)) if own | parts(other) else 1.0

        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), near(edited), near(following)))
    return out


def results(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()]


@pytest.mark.parametrize("partitions", [1, 7])
def test_fingerprints_match_brute_force(spark, partitions):
    random_ = random.Random(partitions)
    lines = [f"line {i} é💡" for i in range(40)]
    rows = [(i * 3, "\n".join(random_.choices(lines, k=random_.choice([0, 1, 3, 30])))) for i in range(50)]
    rows += [(None, "a row\nwithout an id"), (500, None), (501, ""), (502, "\n\n"), (503, "one\rtwo\fthree"),
             (504, "\n".join(f"paragraph {i}" for i in range(3000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("key", "next", "to", "bucket", "parts", "sketch")})
    got = paragraph_sketch.paragraph_fingerprints(docs.repartition(partitions))
    assert sorted(results(got), key=str) == sorted(plain_fingerprints(rows), key=str)


def test_fingerprints_of_odd_documents(spark):
    got = paragraph_sketch.paragraph_fingerprints(odd_documents(spark)).collect()
    assert len(got) == len(TEXTS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    # Of two equal rows the first is followed by the second.
    assert 1.0 in [r.near_next for r in got if r.doc_id == 10]
    assert paragraph_sketch.paragraph_fingerprints(no_documents(spark)).count() == 0
    one = odd_documents(spark).where("doc_id = 8")
    assert results(paragraph_sketch.paragraph_fingerprints(one)) == plain_fingerprints([(8, "short")])


def test_equal_texts_equal_fingerprints(spark):
    rows = [(i, f"same\ntext {i % 4}") for i in range(40)]
    got = paragraph_sketch.paragraph_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.groupBy(F.col("doc_id") % 4).agg(F.count_distinct("fingerprint").alias("n")).where("n > 1").count() == 0
    assert got.select("fingerprint").distinct().count() == 4


@pytest.mark.parametrize("size", [0, 1, 12, 40, 700])
def test_differences_are_recovered(spark, size):
    """However many digests differ: the sketch or one of the larger tables gives them away."""
    random_ = random.Random(size)
    shared = [random_.getrandbits(60) for _ in range(50)]
    one = [random_.getrandbits(60) for _ in range(size)]
    other = [random_.getrandbits(60) for _ in range(size // 3)]
    rows = spark.createDataFrame([(shared + one, other + shared)], "a array<long>, b array<long>")
    rows = rows.withColumns({"sa": paragraph_sketch.sketch("a"), "sb": paragraph_sketch.sketch("b")})
    found = rows.select(paragraph_sketch.differences("a", "b", "sa", "sb").alias("d")).first().d
    assert sorted((r.x, r.n) for r in found) == sorted([(x, 1) for x in one] + [(x, -1) for x in other])


def test_fingerprint_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "c")], "doc_id long, text string")
    plan = paragraph_sketch.paragraph_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "CartesianProduct", "NestedLoop") if x in plan]


# --- collocations ------------------------------------------------------------------------


def plain_phrases(rows, support, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    longer = Counter()
    for (lang, p), n in counts.items():
        if len(p) == 3 and n >= support:
            for part in (p[:2], p[1:]):
                longer[lang, part] = max(longer[lang, part], n)
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= support and 100 * longer[lang, p] < 50 * a:
            cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.setdefault(lang, []).append(
                (-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, totals[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(own)[:top], 1)
    )


def phrase_rows():
    random_ = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)] + ["Straße", "naïve", "x" * 300, "東京", "TOKEN", "É"]
    marks = [" ", "  ", "\t", ". ", "\n", ", ", " ; "]
    rows = [
        (random_.choice(["en", "de", None, ""]),
         "".join(random_.choice(vocabulary) + random_.choice(marks) for _ in range(random_.choice([0, 3, 200]))))
        for _ in range(80)
    ]
    return rows + [("en", None), ("xx", " \t. ,"), ("en", "go go go go go go go go go go go go go go")] + [rows[1]] * 5


@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_phrases_match_brute_force(spark, monkeypatch, shard):
    """Also with many tries."""
    monkeypatch.setattr(collocations, "SHARD_PHRASES", shard)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {c: F.lit("x") for c in ("phrase", "n", "slot", "cid", "rank")})
    got = collocations.collocations(docs.repartition(3), top=25)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 10, 25)


def test_blocks_end_with_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 10)
    data = b"aaa bbb. cccccccccccccccccccccc ddd\neee"
    blocks = [bytes(b) for b in collocations._blocks(np.frombuffer(data, np.uint8))]
    assert b"".join(blocks) == data
    assert all(b[:1] in b".\n" for b in blocks[1:])


def test_trie_counts_every_phrase():
    random_ = random.Random(2)
    text = [random_.randrange(-1, 30) for _ in range(5000)]
    linked = np.array([random_.random() < 0.8 for _ in text[:-1]] + [False])
    phrases = {tuple(random_.randrange(30) for _ in range(random_.choice([2, 3]))) for _ in range(400)}
    phrases = sorted(phrases)
    wide = np.array([[*p, -1][:3] for p in phrases])
    trie = collocations.Trie(wide, 30)
    counts = trie.counts(np.array(text), linked, len(phrases))
    want = Counter()
    for i in range(len(text)):
        for size in (2, 3):
            if i + size <= len(text) and linked[i : i + size - 1].all():
                want[tuple(text[i : i + size])] += 1
    assert counts.tolist() == [want[p] for p in phrases]


def test_tasks_send_a_phrase_once_and_lose_none():
    """Blocks of a task are added up before they are sent, and no phrase is spelled twice; one
    that shares half of its hash with another is not lost."""
    text = "a b a c. b c a b c\nÉ a b " * 3
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 8, "text": [text] * 16})
    sent = pa.Table.from_batches(collocations._count_words(iter([batch.slice(i, 2) for i in range(0, 16, 2)])))
    assert sent.num_rows == 8 and pc.sum(sent["n"]).as_py() == 16 * 36
    parts = [tuple(np.array(c, k) for c, k in zip(p, (np.uint64, np.int32, np.int32))) for p in (
        ([5, 5, 9], [0, 0, 0], [4, 3, 8]), ([9, 1, 2, 2], [0, 0, 1, 7], [2, 6, 3, 3]))]
    hashes = pa.Table.from_batches(collocations._hash_counts(iter(parts)))
    hashes = hashes.sort_by([("hash", "ascending"), ("test", "ascending")])
    assert hashes.to_pydict() == {
        "hash": [1, 2, 2, 5, 9], "test": [0, 1, 7, 0, 0], "n": [1, 1, 1, 2, 2], "mark": [6, 3, 3, 3, 2]}

    def spelled(second):
        seen, found = collocations._Seen(), []
        for words in [w for _ in range(3) for w in collocations.words_of(batch.slice(0, 1))]:
            own = [words.hashes()[words.codes], second(words)]
            for rows in collocations._new_phrases(words, words.pairs(), 2, own, seen):
                found += rows["phrase"].to_pylist()
        return found

    pairs = {"a b", "b a", "a c", "b c", "c a", "é a", "É a"} & set(spelled(lambda w: w.hashes("k" * 16)[w.codes]))
    assert pairs == {"a b", "b a", "a c", "b c", "c a", "É a"}
    assert len(spelled(lambda w: w.hashes("k" * 16)[w.codes])) == len(pairs)

    seen = collocations._Seen()
    one, two = np.array([7, 7], np.uint64), np.array([1, 2], np.uint64)
    seen.add(one, two)
    assert sorted(seen(one, two).tolist()) == [False, True]


def phrase_candidates(spark, rows):
    found = set()
    for lang, text in rows:
        for piece in text.split("."):
            words = piece.split()
            found |= {(lang, " ".join(words[i : i + k]), k) for k in (2, 3) for i in range(len(words) - k + 1)}
    return spark.createDataFrame(sorted(found), "lang string, phrase string, length int")


def test_texts_are_read_once_however_many_tries(spark, monkeypatch):
    """The pass over the texts is one, so that time does not grow with texts times tries."""
    monkeypatch.setattr(collocations, "SHARD_PHRASES", 5)
    random_ = random.Random(4)
    rows = [(lang, " ".join(random_.choice(["a", "b", "cé", "d."]) for _ in range(30))) for lang in ("en", "a b") * 6]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2).cache()
    docs.count()
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    candidates = phrase_candidates(spark, rows)
    assert candidates.count() > 50
    got = collocations.phrase_counts(docs.mapInArrow(seen, "lang string, text string"), candidates).collect()
    assert read.value == len(rows)
    want = Counter()
    for lang, text in rows:
        for piece in text.split("."):
            words = piece.split()
            want.update((lang, " ".join(words[i : i + k]), k) for k in (2, 3) for i in range(len(words) - k + 1))
    assert {(r.lang, r.phrase, r.length): r.n for r in got} == dict(want)
    assert len(got) == len(want)
    docs.unpersist()


def test_parcels_count_windows_exactly(monkeypatch):
    """Also where hashes of different pairs are equal, and when a trie takes little at once."""
    monkeypatch.setattr(collocations, "WALKED", 3)
    spelled = pa.array([b"en x", b"en y", b"de x"], pa.large_binary())
    windows = np.array([[0, 1, -1], [0, 1, 0], [1, 0, -1], [0, 1, -1], [0, 1, 0], [2, 2, -1], [0, 1, 1]], np.int32)
    pair = np.full(len(windows), 1 << 40, np.uint64)
    candidates = pa.table({"lang": ["en", "en", "de", "en"], "phrase": ["x y", "x y x", "x x", "y y"]})
    shard = collocations._Shard(candidates)
    for _ in range(2):
        held = [(spelled, pair, windows), (spelled.take(pa.array([1, 0, 2])), pair, windows)]
        shard.add(collocations._parcels(held, 1))
    got = pa.Table.from_batches(shard.found()).to_pylist()
    assert {(r["lang"], r["phrase"], r["length"]): r["n"] for r in got} == {
        ("en", "x y", 2): 12, ("en", "x y x", 3): 4, ("de", "x x", 2): 4}


def test_no_phrases(spark):
    empty = no_documents(spark)
    assert collocations.collocations(empty).count() == 0
    got = collocations.collocations(odd_documents(spark))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
