"""Hard negatives and whitening, against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import hard_negatives, whitening
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"
RELABEL = "CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def sound(rows):
    return [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None
            and all(x is not None and math.isfinite(x) for x in r[1])]


def brute_negatives(rows):
    part = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in sound(rows)]
    out = []
    for a, label, v in part:
        if a % 50:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w)), i, other == label) for i, other, w in part if i != a))
        for down, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and -50 * down <= -100 * s[0] <= -95 * down][:3]
            out += [(a, positive, k + 1, i, -down, -d) for k, (d, i, _) in enumerate(fits)]
    return sorted(out)


def odd_vectors():
    r = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in np.float32(r.normal(size=6))], int(r.integers(0, 3))) for i in range(260)]
    rows += [(50, None, 1), (100, [1.0, None, 0.5], 1), (150, [float("nan")] * 6, 2), (200, [float("inf")] * 6, 0),
             (None, [0.5] * 6, 1), (300, [0.5] * 6, None), (7, rows[7][1], 1), (7, rows[7][1], 1), (350, [], 1),
             (400, [0.25, 1.0], 2), (-50, [1.0] * 6, 0), (450, [0.0] * 6, 1), (451, [0.0] * 6, 2), (452, [0.0] * 6, 1)]
    rows += [(1000 + k, [1.0, 0.5, 0.25, 0.0, 1.0, 1.0], k % 2) for k in range(150)]  # one very common vector
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    from pyspark.sql import functions as F

    extra = {c: F.lit(f"own {c}") for c in ("id", "vector", "block", "at", "score", "kind", "part", "slice", "n")}
    return spark.createDataFrame(odd_vectors(), SCHEMA).repartition(4).withColumns(extra)


def test_negatives_equal_brute_force(vectors):
    got = hard_negatives.mined(vectors, relabel=RELABEL)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(odd_vectors())


def test_negatives_across_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_BLOCK", 2)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert sorted(tuple(r) for r in hard_negatives.mined(df, relabel=RELABEL).collect()) == brute_negatives(rows)


def test_stream_holds_windows_alone():
    """The iterator never reads ahead: a million negatives of one anchor pass one by one."""
    def pairs():
        yield hard_negatives.sort_key(0, 0, 1000, 0, 5), None
        for k in range(1_000_000):
            yield hard_negatives.sort_key(0, 0, 900, 1, k), None

    stream = hard_negatives.windows(pairs())
    assert [next(stream)[4] for _ in range(3)] == [0, 1, 2]


def test_keys_sort_as_named():
    keys = [(0, 0, 5, 0, 9), (0, 0, 5, 1, -3), (0, 0, 5, 1, 2), (0, 0, -5, 0, 0), (0, 1, 9, 0, 0), (1 << 32, 0, 9, 0, 0)]
    packed = [hard_negatives.sort_key(*k) for k in keys]
    assert packed == sorted(packed)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mined(empty).collect() == []
    assert whitening.whitened(empty).collect() == []
    alike = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    assert whitening.whitened(alike).collect() == []


def check_whitened(rows, got, most=8):
    part = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(len(r[1]) for r in part)
    x = [[math.floor(1024 * c) + 100_000 for c in [*r[1], *[0.0] * (width - len(r[1]))]] for r in part]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    c = np.array(x) - np.array(sums) / n
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_row = defaultdict(list)
    for r in got:
        by_row[r["vec_id"], r["deviation"]].append(r)
    assert len(got) == n * min(most, width)
    for number, row in enumerate(part):
        deviation = sum((n * v - s) ** 2 for v, s in zip(x[number], sums))
        found = by_row[row[0], deviation]
        assert {r["component"] for r in found} == set(range(1, min(most, width) + 1))
        for r in found:
            k = r["component"] - 1
            want = abs(c[number] @ vectors[:, k]) / math.sqrt(values[k])
            assert abs(abs(r["whitened"]) - want) < 1e-6 * max(1, want)
            assert abs(r["explained"] / (values[k] / np.trace(cov)) - 1) < 1e-9
            assert r["n"] == n and r["identity_error"] < 1e-9


def test_whitening_equals_brute_force(spark, vectors):
    check_whitened(odd_vectors(), whitening.whitened(vectors).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(rows, QUERIES["op12_whitening"](spark, SF).collect())


def test_whitening_of_large_numbers_is_exact(spark):
    rows = [(k, [float(v), float(-2 * v), 1.0 * (k % 3)], 1) for k, v in enumerate([1, 3, 8_000_000, 2, 900_000, 5])]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in r[1]] for r in rows]
    sums = [sum(col) for col in zip(*x)]
    want = {k: sum((6 * v - s) ** 2 for v, s in zip(x[k], sums)) for k in range(6)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


@pytest.mark.parametrize("kind", ["random", "equal", "diagonal", "clustered", "rank one", "wilkinson"])
def test_eigenpairs(kind):
    r = np.random.default_rng(5)
    q = np.linalg.qr(r.normal(size=(40, 40)))[0]
    values = {"random": r.uniform(0, 10, 40), "equal": np.r_[np.full(12, 3.0), np.full(28, 1.0)],
              "diagonal": None, "clustered": 5 + 1e-9 * np.arange(40), "rank one": np.r_[7.0, np.zeros(39)],
              "wilkinson": None}[kind]
    if kind == "diagonal":
        matrix = np.diag(np.arange(40.0))
    elif kind == "wilkinson":
        matrix = np.diag(np.abs(np.arange(41) - 20.0)) + np.diag(np.ones(40), 1) + np.diag(np.ones(40), -1)
    else:
        matrix = q @ np.diag(values) @ q.T
        matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_eigenpairs(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:len(found)]
    assert len(found) == (1 if kind == "rank one" else 8)
    norm = np.abs(matrix).max()
    assert np.abs(np.array(found) - want).max() < 1e-12 * norm * 40
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * np.array(found)).max() < 1e-12 * norm * 40
