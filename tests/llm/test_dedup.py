import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.llm import exact_dedup, near_dedup
from geokernel.llm.shared import WordHashes
from geokernel.operators.graph import linked_roots

DOCS = "doc_id long, text string"


def test_minimal_perfect_hash_is_a_bijection():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 5000):
        words = rng.integers(0, 2**63, (n, 4), dtype=np.uint64)
        sizes, bits = exact_dedup.build_hash(words)
        assert sorted(exact_dedup.slots_of(words, sizes, bits).tolist()) == list(range(n))


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), keep is None or i == keep, hashlib.sha256(t.encode()).digest()) for i in ids]
    return out


def order(rows):
    return sorted((tuple((x is not None, x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("keys", [1, 20_000])
def test_exact_dedup_matches_brute_force(spark, keys):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a b", "a  b", " a\tb", "a\n\nb", None, "", " ", "é" * 9000, f"own {i}"])) for i in range(120)]
    rows += [(7, "a b"), (None, "a b"), (None, "nobody"), (None, "nobody"), (500, " "), (501, "a\x1cb"), (502, "a b")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("digest", F.lit(1)).withColumn("n", F.lit(1)).repartition(3)
    digests = exact_dedup.with_digest(docs)
    got = exact_dedup.exact_dedup(digests, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, keys)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in got.collect()]
    assert order(got) == order(brute_exact(rows))


@pytest.mark.parametrize("history", [True, False])
def test_all_history_or_none(spark, history):
    rows = [(3, "x"), (1, "x"), (2, "y")]
    got = exact_dedup.exact_dedup(exact_dedup.with_digest(spark.createDataFrame(rows, DOCS)), F.lit(history))
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got.collect()) == [(1, 1, True), (2, 2, True), (3, 1, False)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (3, 10), (8, 11), (4, 5), (None, 3)] + [(100 + i, 101 + i) for i in range(60)]
    got = dict(linked_roots(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 5: 4, 8: 8, 9: 8, 11: 8} | {100 + i: 100 for i in range(61)}


def brute_near(rows):
    hashes = WordHashes()
    sets = [set(near_dedup.shingles(t, hashes).tolist()) for _, t in rows]
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                low[root(i)] = root(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            best[root(i)] = min(best.get(root(i), doc_id), doc_id)
    return [(d, len(sets[i]), best.get(root(i)), best.get(root(i)) is None or d == best[root(i)]) for i, (d, _) in enumerate(rows)]


def near_rows(seed):
    rng = random.Random(seed)
    rows, bases = [], [[f"w{rng.randrange(900)}" for _ in range(rng.choice([4, 5, 30, 120]))] for _ in range(12)]
    for i in range(140):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 1 + len(words) // 18)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - i, rng.choice([" ", "\n", " \t"]).join(words).replace("w1", "W1")))
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows(8) + [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE"), (10, "one two"), (2000, "a b c d e"), (2001, "a b c d e f"), (None, "lost words of no id at all"), (None, "lost words of no id at all")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("bands", F.lit(1)).withColumn("num", F.lit(2)).repartition(3)
    got = [tuple(r) for r in near_dedup.near_duplicates(docs).collect()]
    want = brute_near(rows)
    want = [(d, n, c if n or d is None else d, k if n or d is None else True) for d, n, c, k in want]
    assert order(got) == order(want)


def test_hot_group_of_near_copies_is_not_multiplied_out(spark):
    """A base and copies of it with growing numbers of edits; whole group against brute force."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(150), rng.randrange(1, 12)):
            words[k] = f"e{i}_{k}"
        rows.append((i, " ".join(words)))
    got = [tuple(r) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()]
    assert order(got) == order(brute_near(rows))


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(200):
        common, own = rng.integers(0, 2**63, 300, dtype=np.uint64), rng.integers(0, 2**63, 100, dtype=np.uint64)
        a, b = np.concatenate([common, own[:50]]), np.concatenate([common, own[50:]])
        missed += not (near_dedup.band_keys(a) == near_dedup.band_keys(b)).any()
    assert missed == 0


@pytest.mark.parametrize("operator", [near_dedup.near_duplicates, exact_dedup.dedup_documents])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).collect() == []
