import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geokernel.llm import sharding as sh

SCHEMA = "doc_id long, text string"


def corpus(rng, n, copies=()):
    texts = [" ".join(rng.choice(["kapo", "riuné", "zu"]) + str(rng.randrange(999)) for _ in range(int(rng.paretovariate(1.2) * 4) % 300)) for _ in range(n)]
    for text, times in copies:
        texts += [text] * times
    rng.shuffle(texts)
    return list(enumerate(texts))


def check(rows, found, shards):
    """Facts of every row, gapless slots, loads by shard."""
    assert Counter((r["doc_id"], r["size"], r["tokens"], r["text_crc32"]) for r in found) == Counter((i, len((t or "").encode()) + 16, len((t or "").split()), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, loads = defaultdict(list), np.zeros((shards, 3))
    for r in found:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += (r["size"], r["tokens"], 1)
    assert all(0 <= s < shards and sorted(at) == list(range(len(at))) for s, at in slots.items())
    return loads / np.maximum(1, loads.sum(axis=0)) * shards


def shards_of_texts(rows, found):
    text, out = dict(rows), defaultdict(set)
    for r in found:
        out[text[r["doc_id"]] or ""].add(r["shard"])
    return out


def test_balance_and_whole_groups(spark):
    rows = corpus(random.Random(11), 4000, [("a few copies " * 9, 30), ("one long text " * 800, 1), ("", 12)]) + [(9000, None), (9001, None)]
    found = sh.shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(6), shards=8).collect()
    loads = check(rows, found, 8)
    assert np.abs(loads[:, 0] - 1).max() < 0.01 and np.abs(loads - 1).max() < 0.1
    assert all(len(s) == 1 for s in shards_of_texts(rows, found).values())


def test_same_shards_again_and_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sh, "GROUPS_PER_CHUNK", 400)
    monkeypatch.setattr(sh, "ROWS_PER_PART", 50)
    monkeypatch.setattr(sh, "LARGE_PART", 8)
    rows = corpus(random.Random(12), 5000)
    table = spark.createDataFrame(rows, SCHEMA)
    found = sh.shard_documents(table.repartition(5), shards=4).collect()
    assert np.abs(check(rows, found, 4) - 1).max() < 0.02
    other = sh.shard_documents(table.repartition(3), shards=4).collect()
    assert {r["doc_id"]: r["shard"] for r in found} == {r["doc_id"]: r["shard"] for r in other}
    assert all(len(s) == 1 for s in shards_of_texts(rows, found).values())


def test_a_third_of_all_rows_is_one_text(spark):
    rows = corpus(random.Random(13), 2000, [("the same words again", 1000)])
    found = sh.shard_documents(spark.createDataFrame(rows, SCHEMA).repartition(6), shards=8).collect()
    assert np.abs(check(rows, found, 8) - 1).max() < 0.05
    spread = shards_of_texts(rows, found)
    assert {t for t, s in spread.items() if len(s) > 1} == {"the same words again"}


def test_more_shards_than_rows_repeats_and_names(spark):
    assert sh.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, None), (2, "x" * 50_000)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'s' AS shard", "1 AS slot", "2 AS bytes", "3 AS row", "4 AS digest")
    found = sh.shard_documents(table).collect()
    check(rows, found, 40)
    assert len({r["shard"] for r in found}) >= 3


def test_given_tokens(spark):
    rows = [(i, f"text {i}", i % 7) for i in range(100)]
    found = sh.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, t int"), shards=5, tokens_col="t").collect()
    assert sorted((r["doc_id"], r["tokens"]) for r in found) == [(i, i % 7) for i in range(100)]


def test_written_shards_are_the_rows_in_order_of_slots(spark, tmp_path):
    rows = [(i % 90, f"text {i % 80}", f"extra{i}") for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, other string")
    sh.write_shards(table, f"{tmp_path}/out", shards=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r["doc_id"], r["text"], r["other"]) for r in back.collect()) == sorted(rows)
    assert back.select("shard").distinct().count() == 3 and back.columns == ["doc_id", "text", "other", "slot", "shard"]
    with pytest.raises(ValueError, match="slot"):
        sh.write_shards(back.drop("shard"), f"{tmp_path}/again")


def test_place_prefers_the_largest_dot_product():
    residual = np.array([[1.0, 0.0], [0.0, 1.0]])
    assert sh.place(np.array([[0.9, 0.1], [0.1, 0.8]]), residual, (1.0, 1.0)).tolist() == [0, 1]
    assert sh.place(np.array([[0.1, 0.1]]), np.ones((4, 2)), (1.0, 1.0), first=2).tolist() == [2]
