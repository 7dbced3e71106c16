"""Bigram language-model scoring by deleted interpolation.

P(v | u) = L2[b] c(u v) / c(u) + L1[b] c(v) / N + L0[b] / (V + 1), where b is the bucket of the
context's frequency c(u) and the weights of each bucket are learned by expectation-maximisation
on held-out counts (Jelinek and Mercer, 1980): a tenth of the training documents is deleted from
the counts while the weights are learned, and put back for scoring.

No count table ever meets the documents in one place. Documents are gathered into chunks of a
bounded number of tokens, a long document into several, each part with the word before it; and each chunk asks once for every distinct word and every distinct
bigram it holds: requests are shuffled by hashed key to buckets, each bucket adds up what all
chunks have counted and answers every chunk in the order of its request. The volume is that of
the distinct bigrams of the chunks, and a frequent word or bigram is one key in each chunk.
Words and bigrams are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WordHashes, ascii_words, as_table, mix64

CHUNK_TOKENS = 1_500_000
#: Keys that a bucket is asked for on average.
KEYS_PER_BUCKET = 1_500_000
#: The end of a text is a token; its begin is a context only. Neither can be a word.
END, BEGIN = xxhash.xxh3_64_intdigest(b" end"), xxhash.xxh3_64_intdigest(b" begin")
#: A context seen 2**(b-1) to 2**b - 1 times is in bucket b, an unseen one in bucket 0.
BUCKETS = 48
#: Held-out probabilities are gathered on a grid of this many steps an octave.
GRID = 4
NEVER = -(1 << 20)
EM_ROUNDS = 200
#: Roles of a document: counted, deleted while weights are learned, or scored only.
MAIN, DELETED, SCORED = 0, 1, 2

_U = np.uint64(0x9E3779B97F4A7C15)
CHUNK_SCHEMA = "chunk long, rows array<long>, doc_ids array<long>, held_out array<boolean>, roles binary, firsts binary, lengths binary, words binary, tokens binary, n_main long, n_deleted long, n_pairs long"
REQUEST_SCHEMA = "bucket long, chunk long, kind int, keys binary, main binary, deleted binary"
ANSWER_SCHEMA = "bucket long, chunk long, kind int, main binary, deleted binary, distinct_main long, distinct_all long"
SCORE_SCHEMA = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
WORD, PAIR = 0, 1


def _small(x: np.ndarray) -> bytes:
    """Packed unsigned integers: the width in bytes, the number, and the values byte plane by
    byte plane, compressed."""
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 256**w)
    planes = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(x).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(x) else b"")


def _wide(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(blob[9:], width * n, "zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, byte plane by byte plane: the upper planes are zeros."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return len(keys).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpack_keys(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _pair_keys(words: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(mix64(words[left] + _U) + words[right])


@dataclass
class _Stream:
    """The tokens of a chunk: for each the local numbers of its word and its context."""

    word: np.ndarray
    context: np.ndarray
    role: np.ndarray

    @staticmethod
    def of(tokens: np.ndarray, lengths: np.ndarray, roles: np.ndarray, firsts: np.ndarray) -> _Stream:
        """firsts: what stands before each part, the begin of a text or the word before."""
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[np.cumsum(lengths) - lengths] = firsts
        return _Stream(tokens, context, np.repeat(roles, lengths))

    def pairs(self, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (context, word) codes in order, and the code's place for each token."""
        return np.unique(self.context * n_words + self.word, return_inverse=True)


def _chunk_rows(parts: list, number: int) -> pa.RecordBatch:
    rows, ids, held, roles, firsts, hashes = zip(*parts, strict=True)
    lengths = np.array([len(h) for h in hashes], np.int64)
    before = np.array([*firsts, BEGIN], np.uint64)
    words, local = np.unique(np.concatenate([*hashes, before]), return_inverse=True)
    local = local.astype(np.int64)
    tokens, firsts, roles = local[: -len(before)], local[-len(before) : -1], np.array(roles, np.int64)
    stream = _Stream.of(tokens, lengths, roles, firsts)
    n_pairs = len(stream.pairs(len(words))[0])
    row = {
        "chunk": number, "rows": list(rows), "doc_ids": list(ids), "held_out": list(held), "roles": _small(roles), "firsts": _small(firsts), "lengths": _small(lengths),
        "words": _pack_keys(words), "tokens": _small(tokens),
        "n_main": int((stream.role == MAIN).sum()), "n_deleted": int((stream.role == DELETED).sum()), "n_pairs": n_pairs,
    }
    whole, bits = pa.int64(), pa.binary()
    schema = pa.schema([("chunk", whole), ("rows", pa.list_(whole)), ("doc_ids", pa.list_(whole)), ("held_out", pa.list_(pa.bool_())), *((c, bits) for c in ("roles", "firsts", "lengths", "words", "tokens")), *((c, whole) for c in ("n_main", "n_deleted", "n_pairs"))])
    return pa.RecordBatch.from_pylist([row], schema)


def _chunks(most: int):
    """Cuts texts into chunks of about `most` tokens. Deleted documents have chunks of their
    own, whose numbers are odd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        numbers, held, sizes, hashes, row = [first, first + 1], ([], []), [0, 0], WordHashes(), first
        for batch in batches:
            for doc_id, is_held, role, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "held_out", "role", "text")), strict=True):
                words = ascii_words(text)
                h = np.empty(len(words) + 1, np.uint64)
                h[:-1] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                h[-1] = END
                k = int(role == DELETED)
                for at in range(0, len(h), most):
                    part = h[at : at + most]
                    held[k].append((row, doc_id, is_held, role, h[at - 1] if at else BEGIN, part))
                    sizes[k] += len(part)
                    if sizes[k] >= most:
                        yield _chunk_rows(held[k], numbers[k])
                        numbers[k], sizes[k] = numbers[k] + 2, 0
                        held[k].clear()
                row += 1
        for k in (0, 1):
            if held[k]:
                yield _chunk_rows(held[k], numbers[k])

    return run


def _opened(row: dict) -> tuple[np.ndarray, _Stream]:
    return _unpack_keys(row["words"]), _Stream.of(_wide(row["tokens"]), _wide(row["lengths"]), _wide(row["roles"]), _wide(row["firsts"]))


def _requests(row: dict, kind: int, bits: int) -> Iterator[dict]:
    """What a chunk has counted, cut by bucket; keys in ascending order."""
    words, stream = _opened(row)
    if kind == WORD:
        keys, place, order = words, stream.word, np.arange(len(words))
    else:
        codes, place = stream.pairs(len(words))
        keys = _pair_keys(words, codes // len(words), codes % len(words))
        order = np.argsort(keys, kind="stable")
    main = np.bincount(place[stream.role == MAIN], minlength=len(keys))
    deleted = np.bincount(place[stream.role == DELETED], minlength=len(keys))
    if kind == WORD:  # how often a text begins
        begin = int(np.searchsorted(words, np.uint64(BEGIN)))
        roles = _wide(row["roles"])[_wide(row["firsts"]) == begin]
        main[begin], deleted[begin] = (roles == MAIN).sum(), (roles == DELETED).sum()
    keys, main, deleted = keys[order], main[order], deleted[order]
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
        yield {"bucket": int(bucket[lo]) * 2 + kind, "chunk": row["chunk"], "kind": kind, "keys": _pack_keys(keys[lo:hi]), "main": _small(main[lo:hi]), "deleted": _small(deleted[lo:hi])}


_REQUEST = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("main", pa.binary()), ("deleted", pa.binary())])
_ANSWER = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("main", pa.binary()), ("deleted", pa.binary()), ("distinct_main", pa.int64()), ("distinct_all", pa.int64())])


def _ask(kind: int, bits: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(list(_requests(row, kind, bits)), _REQUEST)

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    """Adds up a bucket's counts over all chunks and answers each chunk in its order."""
    keys = [_unpack_keys(k) for k in rows["keys"].to_pylist()]
    names, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = []
    for column in ("main", "deleted"):
        counts = np.concatenate([_wide(x) for x in rows[column].to_pylist()])
        total = np.zeros(len(names), np.int64)
        np.add.at(total, place, counts)
        totals.append(total)
    words = names != np.uint64(BEGIN)
    seen = int((totals[0][words] > 0).sum()), int(((totals[0] + totals[1])[words] > 0).sum())
    out, at = [], 0
    for i, (chunk, kind, bucket) in enumerate(zip(rows["chunk"].to_pylist(), rows["kind"].to_pylist(), rows["bucket"].to_pylist(), strict=True)):
        mine = place[at : at + len(keys[i])]
        at += len(keys[i])
        first = seen if i == 0 else (0, 0)
        out.append({"bucket": bucket, "chunk": chunk, "kind": kind, "main": _small(totals[0][mine]), "deleted": _small(totals[1][mine]), "distinct_main": first[0], "distinct_all": first[1]})
    return pa.Table.from_pylist(out, _ANSWER)


@dataclass
class _Counted:
    """A chunk beside the corpus counts of its words and pairs, in the chunk's own order."""

    stream: _Stream
    lengths: np.ndarray
    place: np.ndarray
    word_main: np.ndarray
    word_deleted: np.ndarray
    pair_main: np.ndarray
    pair_deleted: np.ndarray

    @staticmethod
    def of(row: dict, answers: pa.Table) -> _Counted:
        words, stream = _opened(row)
        codes, place = stream.pairs(len(words))
        order = np.argsort(_pair_keys(words, codes // len(words), codes % len(words)), kind="stable")
        counts = []
        for kind in (WORD, PAIR):
            mine = answers.filter(pc.field("kind") == kind).sort_by("bucket")
            for column in ("main", "deleted"):
                values = np.concatenate([_wide(x) for x in mine[column].to_pylist()])
                if kind == PAIR:
                    back = np.empty(len(codes), np.int64)
                    back[order] = values
                    values = back
                counts.append(values)
        return _Counted(stream, _wide(row["lengths"]), place, *counts)


def context_bucket(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, np.minimum(BUCKETS - 1, np.log2(np.maximum(c, 1)).astype(np.int64) + 1), 0)


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def _grid(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.rint(GRID * np.log2(np.where(p > 0, p, 1))), NEVER).astype(np.int64)


def _held_out_counts(n_main: int):
    """How often each (bucket, bigram estimate, word estimate) meets a token of a deleted chunk."""

    def gather(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        x = _Counted.of(chunk.to_pylist()[0], answers)
        c = x.word_main[x.stream.context]
        cells = np.column_stack([context_bucket(c), _grid(_ratio(x.pair_main[x.place], c)), _grid(_ratio(x.word_main[x.stream.word], n_main))])
        cells, n = np.unique(cells, axis=0, return_counts=True)
        return pa.Table.from_arrays([pa.array(v, pa.int64()) for v in (*cells.T, n)], ["b", "q2", "q1", "n"])

    return gather


def learn_weights(cells: np.ndarray, floor: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """EM over rows (bucket, grid of bigram estimate, grid of word estimate, count): weights
    (L2, L1, L0) for each bucket. Buckets without held-out tokens take the weights of all."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not len(cells):
        return weights * 0 + np.array([0.0, 0.0, 1.0]) if floor >= 1 else weights
    b, n = cells[:, 0].astype(int), cells[:, 3].astype(float)
    p = np.column_stack([np.where(cells[:, i] == NEVER, 0.0, 2.0 ** (np.maximum(cells[:, i], -400) / GRID)) for i in (1, 2)] + [np.full(len(cells), floor)])

    def em(group: np.ndarray, groups: int) -> np.ndarray:
        w, total = np.full((groups, 3), 1 / 3), np.bincount(group, n, groups)
        for _ in range(rounds):
            r = w[group] * p
            r *= (n / r.sum(axis=1))[:, None]
            w = np.column_stack([np.bincount(group, r[:, j], groups) for j in range(3)]) / np.maximum(total, 1e-300)[:, None]
        return w

    everywhere = em(np.zeros(len(b), int), 1)[0]
    found = em(b, BUCKETS)
    found[np.bincount(b, n, BUCKETS) == 0] = everywhere
    # The uniform part never vanishes, so any text has a probability.
    found = 0.999999 * found + 0.000001 * np.array([0, 0, 1.0])
    return found


def _scores(weights: np.ndarray, n_all: int, v_all: int):
    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        x = _Counted.of(row, answers)
        word, pair = x.word_main + x.word_deleted, x.pair_main + x.pair_deleted
        c, v = word[x.stream.context], word[x.stream.word]
        w = weights[context_bucket(c)]
        p = w[:, 0] * _ratio(pair[x.place], c) + w[:, 1] * _ratio(v, n_all) + w[:, 2] / (v_all + 1)
        base = np.log10((v + 0.5) / (n_all + 0.5 * (v_all + 1)))
        lengths = x.lengths
        starts = np.cumsum(lengths) - lengths
        columns = [
            pa.array(row["rows"], pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(lengths, pa.int64()),
            pa.array(np.add.reduceat((v > 0).astype(np.int64), starts)), pa.array(np.full(len(lengths), n_all, np.int64)),
            pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts)),
        ]
        return pa.Table.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Scores every row of docs by the model of the rows that are not held out.

    held_out: boolean column; where it is null (no doc_id) the row is scored but not learned
    from, and reported as not held out. A null or blank text is its end token alone. An empty
    table gives an empty result; without training rows every token has the uniform
    probability. Other columns are not read."""
    spark = docs.sparkSession
    fold = F.crc32(F.col(id_col).cast("string"))
    role = F.when(held_out.isNull() | held_out, SCORED).when(F.pmod((fold / 5).cast("long"), F.lit(10)) == 0, DELETED).otherwise(MAIN)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), role.alias("role"), F.col(text_col).alias("text"))
    chunks = as_table(rows.mapInArrow(_chunks(chunk_tokens), CHUNK_SCHEMA), "chunks")
    n_main, n_deleted, n_pairs = (x or 0 for x in chunks.agg(F.sum("n_main"), F.sum("n_deleted"), F.sum("n_pairs")).first())
    bits = max(0, (-(-n_pairs // KEYS_PER_BUCKET) - 1).bit_length())

    def answered(kind: int) -> DataFrame:
        return chunks.mapInArrow(_ask(kind, bits), REQUEST_SCHEMA).groupBy("bucket").applyInArrow(_answer, ANSWER_SCHEMA)

    words = as_table(answered(WORD), "word-counts")
    v_main, v_all = (x or 0 for x in words.agg(F.sum("distinct_main"), F.sum("distinct_all")).first())
    answers = words.union(as_table(answered(PAIR), "pair-counts"))
    deleted = F.col("chunk") % 2 == 1
    cells = chunks.filter(deleted).groupBy("chunk").cogroup(answers.filter(deleted).groupBy("chunk")).applyInArrow(_held_out_counts(n_main), "b long, q2 long, q1 long, n long")
    cells = cells.groupBy("b", "q2", "q1").agg(F.sum("n").alias("n")).orderBy("b", "q2", "q1")
    cells = np.array([tuple(r) for r in cells.collect()], np.int64).reshape(-1, 4)
    weights = learn_weights(cells, 1 / (v_main + 1))
    parts = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scores(weights, n_main + n_deleted, v_all), SCORE_SCHEMA)
    same = [F.first(c).alias(c) for c in ("doc_id", "held_out", "train_tokens")]
    scored = parts.groupBy("row").agg(*same, *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
