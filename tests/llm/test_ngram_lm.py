import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geokernel.llm import ngram_lm
from geokernel.llm.shared import ascii_words

def held():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1



def brute(rows, weights):
    fold = {i: zlib.crc32(str(i).encode()) for i, _ in rows if i is not None}
    uni, pair, starts = Counter(), Counter(), 0
    sequences = [(i, [*ascii_words(t), None]) for i, t in rows]
    for i, words in sequences:
        if i is not None and fold[i] % 5 != 1:
            uni.update(words)
            starts += 1
            pair.update(zip(["<begin>", *words], words, strict=False))
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, words in sequences:
        base = score = 0.0
        for u, w in zip(["<begin>", *words], words, strict=False):
            c = starts if u == "<begin>" else uni[u]
            lam = weights[min(ngram_lm.BUCKETS - 1, int(math.log2(c)) + 1) if c else 0]
            p = lam[0] * (pair[u, w] / c if c else 0) + lam[1] * (uni[w] / n if n else 0) + lam[2] / (v + 1)
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
            score += math.log10(p)
        out.append((i, i is not None and fold[i] % 5 == 1, len(words), sum(uni[w] > 0 for w in words), n, base, score))
    return out


@pytest.mark.parametrize("chunk, keys", [(2_000_000, 1_500_000), (60, 40)])
def test_scores_match_brute_force(spark, monkeypatch, chunk, keys):
    monkeypatch.setattr(ngram_lm, "KEYS_PER_BUCKET", keys)
    rng = np.random.default_rng(1)
    vocabulary = [f"w{k}" for k in range(30)] + ["The", "the", "É"]
    rows = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(1, 40)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, " \n\t"), (None, "w1 w2 unseen"), (83, "w1 " * 3000), (84, "w1 " * 3000)]
    seen = {}
    learn = ngram_lm.learn_weights
    monkeypatch.setattr(ngram_lm, "learn_weights", lambda cells, floor: seen.setdefault("w", learn(cells, floor)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(3)
    got = sorted(map(tuple, ngram_lm.score_documents(docs, held(), chunk_tokens=chunk).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    want = sorted(brute(rows, seen["w"]), key=lambda r: (r[0] is None, r[0] or 0))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    assert np.allclose(seen["w"].sum(axis=1), 1)


def test_model_beats_the_base_on_unseen_texts(spark):
    rows = [(i, " ".join(f"a{(i + k) % 7} b{(i + k) % 7}" for k in range(30))) for i in range(300)]
    got = ngram_lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), held()).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.6 * got[1] and got[0] > got[1]


def test_empty_table(spark):
    assert ngram_lm.score_documents(spark.createDataFrame([], "doc_id long, text string"), held()).collect() == []


def test_learned_weights_prefer_what_predicts():
    b = 5
    cells = np.array([[b, ngram_lm.GRID * -1, ngram_lm.GRID * -8, 100], [b, ngram_lm.NEVER, ngram_lm.GRID * -8, 10]])
    w = ngram_lm.learn_weights(cells, 1e-6)[b]
    assert w[0] > 0.8 and abs(w.sum() - 1) < 1e-9
