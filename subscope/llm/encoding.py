"""Token ids of whole columns of text, exactly as the tokenizers library gives them.

A text is cut into chunks at places where the tokenizer starts anew in any case (safe boundaries),
the distinct chunks are encoded by the library, and every text is put together from them. A worker
remembers chunks between batches, up to a bound, so that a frequent word is encoded once. Cutting is
a matter of bytes, so one very long text is many chunks like any other.

A special token's string is a chunk, and what stands before and after it are texts of their own, as for the
library. A text with white space that could meet the cuts is one chunk.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from subscope.llm.spans import Pieces, Texts, texts_of

MAX_CHUNKS = 1_000_000  # chunks a worker remembers; beyond it, it forgets them all and starts again
MAX_IDS = 16_000_000

# Kinds of byte. Letters, digits and signs of ASCII start a token of their own after one another;
# an apostrophe (contractions) and what isn't ASCII (letters or not) stay with their neighbours.
_SPACE, _LETTER, _SIGN, _DIGIT, _OPEN = range(5)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[np.r_[ord("A") : ord("Z") + 1, ord("a") : ord("z") + 1]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("'")] = _OPEN
_KIND[128:] = _OPEN


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; the accented letters of Latin-1, two bytes from C3 on, are letters too."""
    kind = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    tail = data[lead + 1]
    lead = lead[(tail != 0x97) & (tail != 0xB7)]  # the signs for times and divided by
    kind[lead] = kind[lead + 1] = _LETTER
    return kind

_PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

# A byte-level model writes a byte that prints as its Latin-1 character, any other as the next free one from 256.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = dict(zip(sorted(set(range(256)) - set(_PRINTS)), range(256, 512), strict=False))

# White space outside ASCII.
_RARE_SPACE = "[\u0085   -     　]"


def _turns(kind: np.ndarray) -> np.ndarray:
    """Where one certain kind of byte follows another, neither of them white space."""
    before, after = kind[:-1], kind[1:]
    sure = (before != _SPACE) & (after != _SPACE) & (before != _OPEN) & (after != _OPEN)
    return np.flatnonzero(sure & (before != after)) + 1


def _heads(texts: Texts) -> np.ndarray:
    return np.unique(texts.offsets[:-1][np.diff(texts.offsets) > 0])


def dropped_space_chunks(texts: Texts, whole: np.ndarray) -> Pieces:
    """Chunks for a tokenizer that drops white space and lower-cases."""
    kind = _kinds(texts.data)
    n = len(kind)
    inside = kind != _SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[_turns(kind)] = True
    heads = _heads(texts)
    first[heads] = inside[heads]
    for i in np.flatnonzero(whole):  # one chunk, white space included
        a, b = texts.offsets[i], texts.offsets[i + 1]
        inside[a:b], first[a:b] = True, False
        first[a : min(a + 1, b)] = True
    last = inside.copy()
    last[: n - 1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    return Pieces(texts.data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets))


def kept_space_chunks(texts: Texts, whole: np.ndarray) -> Pieces:
    """Chunks for a byte-level tokenizer, where a word takes one space before it along."""
    kind = _kinds(texts.data)
    n = len(kind)
    space = kind == _SPACE
    heads = _heads(texts)
    first = np.zeros(n, bool)
    first[_turns(kind)] = True
    opens = np.zeros(n + 1, bool)  # where a text starts
    opens[texts.offsets] = True
    run = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    first[run] = True  # a run of white space
    closing = np.flatnonzero(space[:-1] & ~space[1:])  # its last byte, unless the text ends there
    closing = closing[~opens[closing + 1]]
    first[closing] = True
    alone = closing[texts.data[closing] != 0x20]  # only a space goes with the word
    first[alone + 1] = True
    first[heads] = True
    for i in np.flatnonzero(whole):
        a, b = texts.offsets[i], texts.offsets[i + 1]
        first[a + 1 : b] = False
    starts = np.flatnonzero(first)
    return Pieces(texts.data, starts, np.append(starts[1:], n) if n else starts, np.searchsorted(starts, texts.offsets))


class Encoder:
    """A tokenizer file of the tokenizers library, applied to columns."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t[how] for t in spec["added_tokens"] for how in ("normalized", "single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has special tokens that are not plain strings")
        longest = sorted(self.specials, key=len, reverse=True)
        self.find_special = re.compile(b"|".join(re.escape(t.encode()) for t in longest) or b"(?!)")
        self.lowers = "Lowercase" in json.dumps(spec["normalizer"])
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.index = pd.Index(self.keys)

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each chunk, one after another, and how many each has.

        Plain letters need no further cutting and go to the tokenizer's model at once.
        """
        plain, merge = _PLAIN.fullmatch, self.tokenizer.model.tokenize
        found: list = [[t.id for t in merge(self._written(c))] if plain(c) else None for c in chunks]
        rest = [i for i, ids in enumerate(found) if ids is None]
        done = self.tokenizer.encode_batch_fast([chunks[i].decode() for i in rest], add_special_tokens=False)
        for i, e in zip(rest, done, strict=True):
            found[i] = e.ids
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum())), counts

    def _written(self, chunk: bytes) -> str:
        """Plain letters as a byte-level model writes them."""
        if chunk.isascii() and chunk[0] != 0x20:
            return chunk.decode()
        if self.lowers:
            chunk = chunk.decode().lower().encode()
        return chunk.decode("latin-1").translate(_WRITTEN)

    def chunks(self, column: pa.Array | pa.ChunkedArray) -> Pieces:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        texts = texts_of(column)
        begin, end = self._specials(column, texts)
        # the texts between special strings, and those strings, each as a text
        parts = Texts(texts.data, np.sort(np.concatenate([texts.offsets, begin, end])))
        whole = np.zeros(len(parts), bool)
        whole[np.searchsorted(parts.offsets, begin, "right") - 1] = True
        if not self.lowers:
            if len(texts.data) and texts.data.max() >= 128:
                rare = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(column, _RARE_SPACE), False)))
                for i in rare.tolist():
                    a, b = np.searchsorted(parts.offsets, texts.offsets[i : i + 2])
                    whole[a:b] = True
            found = kept_space_chunks(parts, whole)
        else:
            lowered = parts.lower()
            for a, b in zip(begin.tolist(), end.tolist()):
                lowered.data[a:b] = texts.data[a:b]
            found = dropped_space_chunks(lowered, whole)
        return Pieces(found.data, found.starts, found.ends, np.searchsorted(found.starts, texts.offsets))

    def _specials(self, column: pa.Array, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Where special tokens' strings begin and end, as the library finds them: from the left, the longest first."""
        some = np.zeros(len(column), bool)
        for special in self.specials:
            some |= np.asarray(pc.fill_null(pc.match_substring(column, special), False))
        places = [
            (m.start() + a, m.end() + a)
            for i in np.flatnonzero(some).tolist()
            for a in [int(texts.offsets[i])]
            for m in self.find_special.finditer(texts.data[a : int(texts.offsets[i + 1])].tobytes())
        ]
        held = np.array(places, np.int64).reshape(-1, 2)
        return held[:, 0], held[:, 1]

    def _known(self, pieces: Pieces) -> np.ndarray:
        """The place of each chunk among those remembered, after learning the new ones."""
        keys = pieces.keys()
        at = self.index.get_indexer(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.keys) > MAX_CHUNKS or len(self.ids) > MAX_IDS:
                self._forget()
                new = np.arange(len(keys))
            fresh, where = np.unique(keys[new], return_index=True)
            ids, counts = self.encode_chunks(pieces.bytes_of(new[where]))
            self.keys = np.concatenate([self.keys, fresh])
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            self.index = pd.Index(self.keys)
            at = self.index.get_indexer(keys)
        return at

    def counts(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Tokens of each text."""
        pieces = self.chunks(column)
        at = self._known(pieces)
        total = np.zeros(len(at) + 1, np.int64)
        np.cumsum(np.diff(self.starts)[at], out=total[1:])
        return np.diff(total[pieces.bounds])

    def encode(self, column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the bounds of each text's."""
        pieces = self.chunks(column)
        at = self._known(pieces)
        return ragged(self.ids, self.starts, at, pieces.bounds)


def ragged(
    values: np.ndarray, starts: np.ndarray, at: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[starts[i]:starts[i + 1]]`` for every i in ``at``, one after another.

    ``bounds`` cuts ``at`` into groups; the bounds of the groups in the result come with it.
    """
    lengths = np.diff(starts)[at]
    total = np.zeros(len(at) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    place = np.repeat(starts[at] - total[:-1], lengths) + np.arange(total[-1])
    return values[place], total[bounds]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)
