import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geokernel.llm import spelling as sp


def brute_counts(docs, every=31):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts):
    near = defaultdict(set)
    words = sorted(counts, key=len)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if len(b) > len(a) + 1:
                break
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 10 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def variants_of(word, rng, letters):
    at = rng.randrange(len(word))
    kind = rng.randrange(4)
    if kind == 0:
        return word[:at] + word[at + 1 :]
    if kind == 1:
        return word[:at] + rng.choice(letters) + word[at:]
    if kind == 2:
        return word[:at] + rng.choice(letters) + word[at + 1 :]
    return "".join(rng.sample(word, len(word)))


def test_counts_whole_texts(spark):
    long_text = "Versehen " * 30_000 + "x" * 70_000 + " " + "x" * 70_000 + " ZUSAMMEN zusammen"
    docs = [(1, "Straße STRAßE straÀen, Müllers-müllers Ünlüüü ünlüüü"), (2, None), (3, ""), (None, "letters1letters2LETTERS"), (None, "letters1letters2LETTERS"), (5, long_text), (5, "\U0001f600versehen一Versehen")]
    got = {r["word"]: r["n"] for r in sp.count_words(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_counts(docs)
    assert len(max(got, key=len)) == 70_000


@pytest.mark.parametrize("box_words", [12, 100_000])
def test_equals_brute_force(spark, monkeypatch, box_words):
    monkeypatch.setattr(sp, "BOX_WORDS", box_words)
    monkeypatch.setattr(sp, "LEAF_WORDS", 3)
    rng = random.Random(8)
    letters = "abcdefgé÷"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(60)}
    for _ in range(500):
        words.add(variants_of(rng.choice(sorted(words)), rng, letters))
    counts = {w: rng.choice([2, 3, 20, 30, 30, 250, 4000]) for w in words if len(w) >= 7}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert rows_of(sp.spelling_variants(table)) == brute_variants(counts)


def test_chains_end_at_their_last_form(spark):
    counts = {"aaaaaaa" + "b" * k: 2 * 10**k for k in range(8)}
    got = rows_of(sp.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts)
    assert {root for _, _, root, *_ in got} == {"aaaaaaabbbbbbb"}


def test_anagrams_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(sp, "BOX_WORDS", 20)
    monkeypatch.setattr(sp, "VISITORS", 1)
    rng = random.Random(9)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(150)} | {"".join(rng.sample("abcdefgg", 8)) for _ in range(400)}
    words |= {w[:3] + "z" + w[4:] for w in sorted(words)[:60]} | {w[:-1] for w in sorted(words)[:60]}
    counts = {w: rng.choice([2, 50]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(sp.spelling_variants(table)) == brute_variants(counts)


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word int, n int")
    assert sp.group_spellings(empty).count() == 0
    docs = [(i, "wonderful wonderfull wonderful", 1, 2) for i in range(40)] + [(3, "wonderful", 1, 2)] * 300
    table = spark.createDataFrame(docs, "doc_id long, text string, word int, n int")
    assert rows_of(sp.group_spellings(table)) == brute_variants(brute_counts([d[:2] for d in docs]))


def test_trees_reach_every_box_within_reach():
    rng = np.random.default_rng(10)
    points = rng.integers(0, 4, (400, 6)).astype(np.int32)
    tree = sp.BoxTree(points, 5)
    homes = tree.homes(points)
    assert all((homes[rows] == leaf).all() for leaf, rows in enumerate(tree.members))
    queries = rng.integers(0, 4, (50, 6)).astype(np.int32)
    reached = {(leaf, q) for leaf, at in tree.reached(queries, 1, 1) for q in at.tolist()}
    for q in range(50):
        delta = points - queries[q]
        close = (np.maximum(delta, 0).sum(axis=1) <= 1) & (np.maximum(-delta, 0).sum(axis=1) <= 1)
        assert {(leaf, q) for leaf in homes[close].tolist()} <= reached
