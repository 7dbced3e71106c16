import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geokernel.llm import byte_bpe, packing, registry, token_counts
from geokernel.llm.shared import shared_path
from geokernel.llm.tokenized import ChunkTokenizer

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(WORD_JSON)
CHUNKS = ChunkTokenizer(open(WORD_JSON, encoding="utf-8").read(), held=50)
TEXTS = st.text(st.one_of(st.sampled_from(" \t\n\r\x1c\x85　'stdllveABZé́ß١😀가"), st.characters(exclude_categories=["Cs"])), max_size=60)

SPECIAL = st.lists(st.one_of(TEXTS, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", " "])), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bpe_encodes_as_tiktoken_and_decodes_back(text):
    ids = ENCODER.encode(text)
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.one_of(TEXTS, SPECIAL))
def test_chunks_encode_as_the_whole_text(text):
    got = np.frombuffer(next(CHUNKS.encode_all([text])), "<u4").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_characters_of_other_unicode_versions():
    """The regex module and tiktoken need not know the same letters."""
    for text in ("\U0003f3dbi", "a\U0003f3db 1\U0003f3db\u0558", "\u0558's\U00011de01", " \u209d\u208f-"):
        assert ENCODER.encode(text) == TIKTOKEN.encode_ordinary(text)
    unlike, table = byte_bpe._stand_ins()
    text = " ".join(f"x{chr(c)}y 1{chr(c)}2 -{chr(c)}!" for c in list(table)[::37])
    assert ENCODER.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_special_tokens_are_the_librarys():
    library = Tokenizer.from_file(WORD_JSON)
    for text in ("a <|endoftext|> b", "A<|endoftext|>B. C", "a <|ENDOFTEXT|> b", "<|startoftext|>The end.<|endoftext|>", "x <| Y", "<|End<|endoftext|>., z"):
        got = np.frombuffer(next(CHUNKS.encode_all([text])), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids


def test_long_pieces():
    rng = random.Random(1)
    for text in ("a" * 3000, "".join(rng.choice("etaoins") for _ in range(4000)), "!" * 700 + " " * 500 + "x", "the" * 300):
        assert ENCODER.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_a_piece_of_more_than_a_mebibyte():
    n = (1 << 20) + 5
    merges = byte_bpe.Merges({bytes([i]): i for i in range(256)} | {b"ab": 256})
    assert byte_bpe.encode_long(b"ab" + b"x" * n + b"ab", merges) == [256, *[ord("x")] * n, 256]


def test_both_trees_agree():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abcdeth ") for _ in range(rng.randrange(1, 17))) for _ in range(300)]
    lockstep = byte_bpe.encode_lockstep(pieces, 16, ENCODER.merges)
    assert [x.tolist() for x in lockstep] == [byte_bpe.encode_long(p, ENCODER.merges) for p in pieces]


EDGES = [(1, "Some words, 12 of them."), (1, "Some words, 12 of them."), (2, None), (3, ""), (4, " \n"), (None, "no id"), (2**62 + 1, "big id " * 3000)]


def test_bpe_documents(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("ids", F.lit(1)).repartition(2)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = sorted(map(tuple, byte_bpe.encode_digests(docs, path, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for i, t in EDGES:
        ids = TIKTOKEN.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    full = {r.doc_id: r.ids for r in byte_bpe.encode_documents(docs, path, public_tokenizers.PATTERN).collect()}
    assert full[4] == TIKTOKEN.encode_ordinary(" \n") and full[2] == []
    assert byte_bpe.encode_digests(docs.limit(0), path, public_tokenizers.PATTERN).collect() == []


def test_first_fit_decreasing_by_hand():
    assert packing.first_fit_decreasing([4, 7, 3, 6, 2, 8], 10) == [(2, 6), (1, 0), (1, 7), (2, 0), (0, 8), (0, 0)]


def brute_first_fit(lengths, capacity):
    room, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if k == len(room):
            room.append(capacity)
        out[i] = (k, capacity - room[k])
        room[k] -= lengths[i]
    return [out[i] for i in range(len(lengths))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing_matches_brute_force(lengths):
    assert packing.first_fit_decreasing(lengths, 50) == brute_first_fit(lengths, 50)


def test_packing_keeps_every_token_once(spark):
    rng = random.Random(3)
    rows = EDGES + [(100 + i, " ".join(rng.choice("red green blue".split()) for _ in range(rng.randrange(0, 300)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("g", F.lit(1)).repartition(3)
    got = packing.pack(docs, WORD_JSON, 2, capacity=256, pieces_per_group=40).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for i, t in rows:
        ids = np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        pieces = [r for r in by_doc[i] if r.doc_tokens == len(ids) // 4]
        assert {(r.start, r.length, r.ids_crc32) for r in pieces} == {(s, min(256, len(ids) // 4 - s), zlib.crc32(ids[4 * s : 4 * s + 1024])) for s in range(0, len(ids) // 4, 256)}
    tokens = sum(r.length for r in got)
    assert tokens == sum(len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert tokens > 0.85 * 256 * len(by_sequence)


def test_packing_fills_sequences_of_the_tables(spark):
    """Of the tables' documents hardly more sequences are made than their tokens fill."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tokens, sequences = packing.pack(docs, WORD_JSON, 2).agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert sequences <= 1.005 * tokens / packing.SEQUENCE_TOKENS + 1


def test_packing_spreads_copies_over_groups(spark):
    docs = spark.createDataFrame([(None, "red green blue")] * 400 + [(1, "red " * 3000)], "doc_id long, text string")
    got = packing.pack(docs, WORD_JSON, 2, capacity=64, pieces_per_group=40).collect()
    groups = {r.sequence_id // packing.GROUP_STRIDE for r in got if r.doc_id is None}
    assert len(groups) >= 8 and sum(r.length for r in got) == 400 * 4 + 3001
    assert len({r.sequence_id for r in got if r.length == 64}) == sum(r.length == 64 for r in got)


def test_packing_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs.limit(0), WORD_JSON, 2).collect() == []


def changes(spark, rows):
    return spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long")


def test_rollup_counts_each_batch_once(spark):
    path = shared_path(spark, "rollup-test")
    rollup = token_counts.TokenRollup(spark, path)
    assert rollup.totals().collect() == []
    first = changes(spark, [("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, None, "v1", 3, None), ("insert", "b", "en", "v1", None, None)])
    assert rollup.commit("1", first) and not rollup.commit("1", first)
    rollup = token_counts.TokenRollup(spark, path)  # a restarted driver
    assert not rollup.commit("1", first)
    assert rollup.commit("2", changes(spark, [("revise", "a", "en", "v1", 12, 10), ("delete", "b", "en", "v1", None, None), ("delete", None, None, "v1", 3, None), ("insert", "a", "en", "v2", 7, None)]))
    assert sorted(map(tuple, rollup.totals().collect())) == [("a", "en", "v1", 2, 17), ("a", "en", "v2", 1, 7)]
    assert rollup.commit("3", changes(spark, []))
    assert rollup.totals().count() == 2


def test_rollup_ignores_uncommitted_attempts_and_later_ones(spark):
    path = shared_path(spark, "rollup-test")
    rollup = token_counts.TokenRollup(spark, path)
    batch = changes(spark, [("insert", "a", "en", "v1", 10, None)])
    token_counts.signed(batch).write.parquet(f"{path}/deltas/attempt=crashed")
    assert rollup.totals().collect() == []
    rollup.commit("1", batch)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 1, 10)]

    class Late(token_counts.TokenRollup):
        """Looks for its batch before the other driver's entry is there, but not afterwards."""

        blind = True

        def committed(self, batch_id):
            return not self.blind and super().committed(batch_id)

    assert not Late(spark, path).commit("1", batch)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 1, 10)]


def test_rollup_passes_over_entries_of_drivers_that_died(spark):
    """An entry that was created and never filled: later commits go on; filled too late, after a
    fold, it counts no more, and its driver commits again."""
    path = shared_path(spark, "rollup-test")
    rollup = token_counts.TokenRollup(spark, path)
    one = changes(spark, [("insert", "a", "en", "v1", 1, None)])
    assert rollup.commit("0", one)
    place, fs = rollup._at(f"{rollup.commits}/{2:012d}.json")
    fs.create(place, False).close()
    assert rollup.commit("1", one) and not rollup.commit("1", one)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 2, 2)]
    rollup.fold()
    assert rollup.commit("2", one)
    rollup.fold()
    assert [tuple(r) for r in token_counts.TokenRollup(spark, path).totals().collect()] == [("a", "en", "v1", 3, 3)]
    assert [int(x.split(".")[0]) for x in rollup._names(rollup.commits) if x.endswith(".json")] == [4]

    class Slow(token_counts.TokenRollup):
        """Other drivers commit and fold between this one's creating its entry and filling it."""

        slow = True

        def _created(self, file, content):
            if not self.slow:
                return super()._created(file, content)
            self.slow = False
            place, fs = self._at(file)
            out = fs.create(place, False)
            other = token_counts.TokenRollup(self.spark, path)
            other.commit("other", one)
            other.fold()
            out.write(bytearray(content.encode()))
            out.close()
            return True

    assert Slow(spark, path).commit("slow", one) and not rollup.commit("slow", one) and not rollup.commit("other", one)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 5, 5)]


def test_rollup_folds(spark):
    path = shared_path(spark, "rollup-test")
    rollup = token_counts.TokenRollup(spark, path)
    rollup.fold()
    total = 0
    for i in range(5):
        assert rollup.commit(f"b{i}", changes(spark, [("insert", "a", "en", "v1", 10**i, None), ("insert", f"s{i}", None, "v1", 1, None)]))
        total += 10**i
        if i in (1, 3):
            rollup.fold()
        rollup = token_counts.TokenRollup(spark, path)
        assert not any(rollup.commit(f"b{j}", changes(spark, [("insert", "a", "en", "v1", 1, None)])) for j in range(i + 1))
        got = {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().collect()}
        assert got == {("a", "en"): (i + 1, total)} | {(f"s{j}", None): (1, 1) for j in range(i + 1)}


def test_registered_totals_against_a_recount(spark):
    """op10's three batches leave each key with the documents that hold a word, and the tokens
    of all documents."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    want = {}
    for r in rows:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        for name, tokens in (("words@1", words), ("byte_bpe_50k@1", len(encoding.encode_ordinary(r.text or "")) if words else 0)):
            docs, n = want.get((r.source, r.lang, name), (0, 0))
            want[r.source, r.lang, name] = (docs + (words > 0), n + tokens)
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in registry.op10_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: v for k, v in want.items() if v != (0, 0)}


def test_unknown_change_is_an_error(spark):
    import pytest

    with pytest.raises(Exception, match="unknown change"):
        token_counts.signed(changes(spark, [("upsert", "a", "en", "v1", 1, None)])).collect()


def test_counts_of_documents(spark):
    docs = spark.createDataFrame([(1, "s", "en", 9, "two words"), (2, None, None, None, None), (3, "s", "en", 0, "")], "doc_id long, source string, lang string, n_chars long, text string")
    got = sorted(map(tuple, token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect()))
    assert got == [(1, "s", "en", 9, 2, len(TIKTOKEN.encode_ordinary("two words"))), (2, None, None, None, 0, 0), (3, "s", "en", 0, 0, 0)]
