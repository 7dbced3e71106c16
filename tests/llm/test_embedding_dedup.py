import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    n = len(rows)
    links, low = [0] * n, list(range(n))
    clean = []
    for i, v, label in rows:
        bad = i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
        clean.append(None if bad else np.array(np.array(v, np.float32), float))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = clean[i], clean[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if (a == b).all() or (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())) >= 0.98:
                links[i] += 1
                links[j] += 1
                low[root(i)] = root(j)
    first = {}
    for i, r in enumerate(rows):
        if clean[i] is not None:
            first[root(i)] = min(first.get(root(i), r[0]), r[0])
    return sorted(((r[0], links[i], first[root(i)] if clean[i] is not None else r[0], clean[i] is None or r[0] == first[root(i)]) for i, r in enumerate(rows)), key=repr)


def cloud(seed, groups=12, size=14, d=64):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.normal(0, 1, d)
        for _ in range(size):
            v = base + rng.normal(0, rng.choice([0.0, 0.08, 0.14, 0.2]), d)
            rows.append((5000 - len(rows), (v * rng.choice([1, 3])).astype(np.float32).tolist(), int(g % 3)))
    return rows


@pytest.mark.parametrize("block", [512, 5])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = cloud(3)
    rows += [(1, None, 1), (2, [], 1), (3, [0.0] * 64, 1), (4, [float("nan")] * 64, 1), (5, [float("inf")] + [1.0] * 63, 1), (6, [None] + [1.0] * 63, 1), (7, rows[0][1], None), (None, rows[0][1], 0), (rows[0][0], rows[0][1], 0), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0], 2)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit(1)).withColumn("id", F.lit(1)).repartition(3)
    got = sorted((tuple(r) for r in ed.near_vectors(table).collect()), key=repr)
    assert got == brute(rows)


def test_empty_table(spark):
    assert ed.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("hashes", [2, 3])
def test_recall_at_the_threshold(hashes):
    """Of pairs with a cosine of exactly 0.98 nearly all share a bucket."""
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, (2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(0, 1, (2000, 64))
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    met = ed._owners(ed.bucket_codes(a, hashes), ed.bucket_codes(b, hashes)) < ed._BIG
    print(hashes, met.mean())
    assert met.mean() > 0.999


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(0, 1, (5, 64))
    assert np.allclose((ed.hadamard(x) ** 2).sum(axis=1), (x**2).sum(axis=1))
    assert np.allclose(ed.hadamard(ed.hadamard(x)), x)
