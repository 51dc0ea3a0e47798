"""Exact and near duplicates of texts and vectors against brute force."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from conftest import SMALL
from llm_data import TEXTS, no_documents, odd_documents
from oracle_compare import differences, duck
from pyspark.sql import functions as F

from signalstar.llm import chosen_path, content_sort, lattice
from signalstar.llm.components import components
from signalstar.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name]) == []


def brute_exact(texts):
    groups = {}
    for i, (doc, text) in enumerate(texts):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), doc is not None, doc or 0, i))
    want = []
    for norm, rows in groups.items():
        rows.sort()
        keep = texts[rows[0][3]][0]
        for k, (_, _, _, i) in enumerate(rows):
            sha = hashlib.sha256(norm.encode()).hexdigest()
            want.append((texts[i][0], keep, len(rows), k == 0, sha))
    return sorted(want, key=str)


@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_copies(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # A large group runs over several partitions.
        texts = TEXTS + [(100 + i, "many" + " " * (i % 5) + " copies") for i in range(400)]
        docs = odd_documents(spark).select("doc_id", "text").union(
            spark.createDataFrame(texts[len(TEXTS):], "doc_id long, text string")
        )
        got = content_sort.duplicate_groups(docs).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute_exact(texts)
        kept = content_sort.kept_documents(docs).collect()
        assert len(kept) == sum(1 for r in brute_exact(texts) if r[3])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_the_longest_of_one_id_stays(spark):
    rows = [(7, "a b c"), (7, "a  b    c"), (7, "a  b    c"), (None, "a\tb c"), (3, "x"), (None, "x "), (4, None), (4, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(1)).repartition(3)
    got = [(r.doc_id, r.text) for r in content_sort.kept_documents(docs).collect()]
    assert sorted(got, key=str) == sorted([(7, "a  b    c"), (None, "x "), (4, " ")], key=str)


def test_nothing_to_compare(spark):
    none = no_documents(spark)
    assert content_sort.duplicate_groups(none).count() == 0
    assert chosen_path.near_duplicates(none).count() == 0
    assert chosen_path.kept_documents(none).columns == none.columns
    assert content_sort.kept_documents(none).columns == none.columns
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert lattice.near_vectors(vectors).count() == 0


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_near(texts, similarity=0.8):
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(texts)
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= similarity * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = {}
    for i in range(len(texts)):
        members.setdefault(find(i), []).append(texts[i][0])
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(
        [(texts[i][0], least[find(i)], links[i], texts[i][0] == least[find(i)]) for i in range(len(texts))],
        key=str,
    )


def test_near_copies_of_odd_rows(spark):
    got = chosen_path.near_duplicates(odd_documents(spark))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_near(TEXTS)


def test_near_copies_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted([tuple(r) for r in chosen_path.near_duplicates(docs).collect()], key=str)
    assert got == brute_near(texts)


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL_BUCKET", 40)
    monkeypatch.setattr(chosen_path, "SKETCH_BLOCK", 30)
    monkeypatch.setattr(chosen_path, "SET_BLOCK", 20)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for d in range(150):
        words = list(base)
        for at in rng.integers(0, 200, 1 + d % 6):
            words[at] = f"x{d}"
        texts.append((d, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted([tuple(r) for r in chosen_path.near_duplicates(docs).collect()], key=str)
    assert got == brute_near(texts)


def test_near_copies_go_by_row(spark):
    """Null and repeated ids take no other row along; of each class one row stays."""
    base = [f"w{i}" for i in range(60)]
    copy, other = " ".join([*base[:-1], "x"]), " ".join([*base[:-1], "y"])
    rows = [
        (1, " ".join(base)), (None, copy), (None, "a clean text without any id at all"),
        (5, other), (5, "quite another text under the same id five"),
        (7, "two near copies under one id seven"), (7, "Two near copies under one id  seven"),
        (8, "the same row twice over here"), (8, "the same row twice over here"),
        (None, "equal rows that have no id"), (None, "equal rows that have no id"), (None, None), (9, " "),
    ]
    kept = chosen_path.kept_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted([(r.doc_id, " ".join((r.text or "").lower().split())) for r in kept], key=str)
    assert got == sorted([
        (1, " ".join(base)), (None, rows[2][1]), (5, rows[4][1]), (7, rows[5][1]), (8, rows[7][1]),
        (None, rows[9][1]), (None, ""), (9, ""),
    ], key=str)
    flags = chosen_path.near_duplicates(spark.createDataFrame(rows[:7], "doc_id long, text string"))
    assert flags.where("kept").count() == 4


def test_survival_and_plan():
    assert chosen_path.survival(1) == pytest.approx(0.632, abs=1e-3)
    depth, runs = chosen_path.plan(1000, 0.9)
    assert (1 - chosen_path.survival(depth + chosen_path.MORE_LEVELS)) ** runs <= 0.1


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 199)]
    got = {tuple(r) for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    want = {(i, 0) for i in range(1, 41)} | {(101, 100), (199, 150), (200, 150)}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- vectors -------------------------------------------------------------------------


def brute_vectors(rows, cosine=0.93):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float32).astype(float)
        return a / np.sqrt((a**2).sum())

    units = [unit(v) for _, v, _ in rows]
    n, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            if len(a) == len(b) and a @ b >= cosine:
                n[i] += 1
                n[j] += 1
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, (d, _, _) in zip(root, rows):
        least[r] = min(least.get(r, d), d)
    return sorted((d, n[i], least[root[i]], d == least[root[i]]) for i, (d, _, _) in enumerate(rows))


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for group in range(12):
        centre = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), (centre + 0.2 * rng.normal(size=32)).astype(np.float32).tolist(), group % 2))
    rows += [(1000 + i, rows[0][1], 0) for i in range(50)]  # copies
    rows += [(2000, [0.0] * 32, 0), (2001, None, 0), (2002, [], 0), (2003, [None] + [1.0] * 31, 0),
             (2004, [float("nan")] + [1.0] * 31, 0), (2005, [float("inf")] + [1.0] * 31, 1),
             (2006, rows[0][1], None), (2007, rows[0][1][:16], 0), (2008, rows[0][1][:16], 0)]
    return rows


@pytest.mark.parametrize("block_rows", [4, 1024])
def test_vectors(spark, block_rows):
    rows = vector_rows()
    vectors = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, size int"
    )
    got = lattice.near_vectors(vectors, block_rows=block_rows).collect()
    assert sorted(tuple(r) for r in got) == brute_vectors(rows)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = lattice.COSINE * a + np.sqrt(1 - lattice.COSINE**2) * b
    settings = (lattice.TABLES, lattice.PROBES, lattice.SCALE, 0)
    one, two = lattice.cells(a, *settings), lattice.cells(b, *settings)
    per = lattice.PROBES + 1
    met = np.zeros(len(a), bool)
    for t in range(0, one.shape[1], per):
        met |= (one[:, t : t + per, None] == two[:, None, t : t + per]).any(axis=(1, 2))
    assert met.mean() > 0.99


def test_lattice_points():
    assert len(lattice.minimal_vectors()) == 240
    assert np.allclose((lattice.minimal_vectors() ** 2).sum(axis=1), 2)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8)) * 3
    point = lattice.nearest_e8(x)
    gap = ((x - point) ** 2).sum(axis=1)
    for v in lattice.minimal_vectors():
        assert (gap <= ((x - point - v) ** 2).sum(axis=1) + 1e-9).all()
