"""Token ids of whole texts by a tokenizers file, with a bounded memory of chunks."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from .shared import ascii_words

#: Chunks that a Python worker remembers.
CHUNKS_HELD = 400_000
#: Characters of text that are worked on at a time.
SLICE_CHARS = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes, in order, the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(other)}


def _chunks(text: str | None) -> list[bytes]:
    """ascii_words, but for the case of chunks that may hold a special token."""
    if not text or "<|" not in text:
        return ascii_words(text)
    return [c if b"<|" in c else c.lower() for c in text.encode("utf-8", "surrogatepass").split()]


@lru_cache(1)
def shared_tokenizer(model_json: str) -> ChunkTokenizer:
    """One for all tasks of a Python worker, so what it remembers serves the next task too."""
    return ChunkTokenizer(model_json)


class ChunkTokenizer:
    """Encodes texts with a tokenizers model that lower-cases and drops white space.

    No token of such a model crosses white space, so a text's ids are those of its chunks one
    after the other; each chunk, with A-Z lower-cased, is given to the tokenizer once and
    remembered until the memory is full. A chunk of lower-case Latin letters alone is one word
    to the tokenizer and goes to its model directly. A full stop or comma behind a letter is a token by
    itself, so a chunk that ends so is put together from the two. New chunks go in together,
    joined by a space; the offsets tell which ids belong to which chunk. Special tokens such as
    <|endoftext|> get their own ids, as by the library's default; they are matched in their own case,
    so a chunk that contains <| keeps its own."""

    def __init__(self, model_json: str, held: int = CHUNKS_HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model_json)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.held, self.known = held, {}

    def _word(self, chunk: bytes) -> bytes | None:
        """The ids of a chunk that is one word as it stands, else None."""
        try:
            word = chunk.decode()
        except UnicodeDecodeError:
            return None
        if not (word.isalpha() and max(word) < "\u0180" and word == word.lower()):
            return None
        ids = [t.id for t in self.model.tokenize(chunk.decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, chunks: set[bytes]) -> None:
        known = self.known
        ended = {c for c in chunks if c[-1:] in b".," and c[-2:-1].isalpha()}
        plain = (chunks - ended) | {c[:-1] for c in ended if c[:-1] not in known} | {c for c in (b".", b",") if c not in known}
        words = {c: ids for c in plain if (ids := self._word(c)) is not None}
        known.update(words)
        plain = [c for c in plain if c not in words]
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            words = [c.decode("utf-8", "surrogatepass") for c in some]
            found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
            ends = np.cumsum([len(w) + 1 for w in words])
            cuts = (4 * np.searchsorted(starts, ends)).tolist()
            known.update((c, ids[a:b]) for c, a, b in zip(some, [0, *cuts], cuts, strict=False))
        known.update((c, known[c[:-1]] + known[c[-1:]]) for c in ended)

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and chars < SLICE_CHARS:
                chars += len(texts[end] or "")
                end += 1
            yield from self._encode(texts[start:end])
            start = end

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        split = [_chunks(t) for t in texts]
        if len(self.known) > self.held:
            self.known.clear()
        if new := set(chain.from_iterable(split)).difference(self.known):
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]
