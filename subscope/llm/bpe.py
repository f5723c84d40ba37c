"""Byte-level BPE by speculation: longest matches first, exact merging only where they fail a check.

A split of a word into tokens is what merging gives if and only if every two neighbours are what merging
gives for the two of them. So longest matches are proposed for all distinct words together, all
neighbours are checked together, and the few words with a failing pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.encoding import _PRINTS, _WRITTEN, Encoder, ragged
from subscope.llm.spans import by_bytes

# How a byte-level tokenizer of this kind cuts a text into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_BYTE_OF = {**{chr(b): b for b in _PRINTS}, **{chr(c): b for b, c in _WRITTEN.items()}}
_SURE = 0x250  # code points below are letters, digits or signs in every version of Unicode in use
_NONE = -1
LONG_WORD = 64  # bytes, beyond which a word is walked through and merged by itself
POSITIONS = 1 << 19  # of a long word, matched together


class _Trie:
    """Tokens by their bytes, as a hash table of (node, byte) that is asked for many words at once."""

    def __init__(self, tokens: dict[bytes, int]):
        nodes: dict[tuple[int, int], int] = {}
        self.token = [_NONE]
        for token, i in tokens.items():
            node = 0
            for byte in token:
                following = nodes.get((node, byte))
                if following is None:
                    following = nodes[node, byte] = len(self.token)
                    self.token.append(_NONE)
                node = following
            self.token[node] = i
        self.token = np.array(self.token, np.int64)
        edges = np.array([(n << 8) | b for n, b in nodes], np.int64)
        self.edges = pd.Index(edges)
        self.target = np.fromiter(nodes.values(), np.int64, len(nodes))

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each start, and where it ends."""
        best, stop = np.full(len(starts), _NONE), starts.copy()
        left, node, at = np.arange(len(starts)), np.zeros(len(starts), np.int64), starts.copy()
        while len(left):
            more = at < ends[left]
            left, node, at = left[more], node[more], at[more]
            edge = self.edges.get_indexer((node << 8) | data[at])
            more = edge >= 0
            left, node, at = left[more], self.target[edge[more]], at[more] + 1
            token = self.token[node]
            hit = token != _NONE
            best[left[hit]], stop[left[hit]] = token[hit], at[hit]
        return best, stop


class Speculator(Encoder):
    """A byte-level BPE file of the tokenizers library; its ids are found here, without the library's model."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError(f"{path} is not a plain byte-level BPE")
        written = {bytes(_BYTE_OF[c] for c in word): i for word, i in model["vocab"].items()}
        size = max([*written.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of_id = [b""] * size
        for word, i in written.items():
            self.bytes_of_id[i] = word
        self.special_ids = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        for word, i in self.special_ids.items():
            self.bytes_of_id[i] = word
        longest = sorted(self.special_ids, key=len, reverse=True)
        self.special = regex.compile(b"(" + b"|".join(map(regex.escape, longest)) + b")") if longest else None
        self.marks = {s[:2].encode() for s in self.specials}

        # how each token comes about: the rank of its merge and its two halves; bytes are their own halves
        self.rank = np.full(size, _NONE)
        self.left, self.right = np.arange(size), np.arange(size)
        vocab = model["vocab"]
        merges: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            merges[pair] = rank
            if self.rank[made] == _NONE:
                self.rank[made], self.left[made], self.right[made] = rank, *pair
        self.made_by = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)  # the token of each merge
        self.pair_index = pd.Index(np.array([a * size + b for a, b in merges], np.int64))
        self.pair_rank = np.fromiter(merges.values(), np.int64, len(merges))
        self.rank_of_pair = dict(zip(self.pair_index.tolist(), self.pair_rank.tolist()))
        self.byte_ids = np.array([written.get(bytes([b]), 0) for b in range(256)], np.int64)
        self.size = size
        # a token that merging its own bytes doesn't give can't be proposed
        made = np.flatnonzero(self.rank >= 0)
        whole = self._kept_apart(self.left[made], self.right[made], self.rank[made])
        never = set(made[~whole].tolist())
        self.trie = _Trie({word: i for word, i in written.items() if i not in never})
        lengths = np.array([len(t) for t in self.bytes_of_id], np.int64)
        self.token_bytes = np.frombuffer(b"".join(self.bytes_of_id), np.uint8)
        self.token_starts = np.concatenate([[0], np.cumsum(lengths)])

    def _kept_apart(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens: would merging their bytes keep them apart, up to merges of rank ``below``?

        Undoes the later of the two tokens' merges, one at a time, and asks whether the parts that then
        touch would have merged before it. Of merges of one rank the one on the left comes first, so a
        merge across loses to an equal one in the left token and wins over one in the right.
        """
        n = len(a)
        apart = np.ones(n, bool)
        limit = np.full(n, len(self.pair_rank) + 1) if below is None else below.copy()
        left = np.arange(n)
        a, b = a.copy(), b.copy()
        while len(left):
            at = self.pair_index.get_indexer(a * self.size + b)
            crossing = (at >= 0) & (self.pair_rank[at] < limit[left])
            apart[left[crossing]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossing & ((ra >= 0) | (rb >= 0))
            left, a, b, ra, rb = left[go], a[go], b[go], ra[go], rb[go]
            undo_a = ra > rb
            limit[left] = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return apart

    def _merged(self, cut: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words: lowest rank first, the leftmost of equals."""
        size = np.fromiter(map(len, cut), np.int64, len(cut))
        short, long = np.flatnonzero(size <= LONG_WORD), np.flatnonzero(size > LONG_WORD)
        who, ids = self._merged_together([cut[i] for i in short])
        parts = [(short[who], ids)]
        for i in long.tolist():
            found = self._merged_alone(cut[i])
            parts.append((np.full(len(found), i), found))
        who, ids = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(who, kind="stable")
        return who[order], ids[order]

    def _merged_alone(self, word: bytes) -> np.ndarray:
        """One long word, its pairs in a heap: the work grows with the word's length, but for a logarithm."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        found = self.pair_index.get_indexer(ids[:-1] * self.size + ids[1:])
        at = np.flatnonzero(found >= 0)
        heap = list(zip(self.pair_rank[found[at]].tolist(), at.tolist()))
        heapq.heapify(heap)
        n, token, made_by, rank_of, size = len(ids), ids.tolist(), self.made_by, self.rank_of_pair, self.size
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j < 0 or rank_of.get(token[i] * size + token[j]) != rank:
                continue  # one of the two has merged since
            token[i], token[j] = int(made_by[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                new = rank_of.get(token[i] * size + token[after[i]])
                if new is not None:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0:
                new = rank_of.get(token[before[i]] * size + token[i])
                if new is not None:
                    heapq.heappush(heap, (new, before[i]))
        ids = np.array(token)
        return ids[ids >= 0]

    def _merged_together(self, cut: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Many short words, a merge of each at a time."""
        ids = self.byte_ids[np.frombuffer(b"".join(cut), np.uint8)]
        who = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            touch = np.flatnonzero(who[1:] == who[:-1])
            found = self.pair_index.get_indexer(ids[touch] * self.size + ids[touch + 1])
            touch, rank = touch[found >= 0], self.pair_rank[found[found >= 0]]
            order = np.lexsort((touch, rank, who[touch]))
            at = touch[order]
            first = np.ones(len(at), bool)
            first[1:] = who[at[1:]] != who[at[:-1]]
            at, rank = at[first], rank[order][first]
            still = np.zeros(len(cut), bool)
            still[who[at]] = True
            ids[at] = self.made_by[rank]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            ended = ~still[who]
            done.append((who[ended], ids[ended]))
            stays &= ~ended
            who, ids = who[stays], ids[stays]
        who, ids = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 2
        order = np.argsort(who, kind="stable")
        return who[order], ids[order]

    def encode_words(self, cut: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are merged by themselves, and how many each has."""
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(cut), np.uint8)
        at, left = ends - lengths, np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        failed = np.zeros(len(cut), bool)
        before = np.full(len(cut), _NONE)
        tried: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(left):
            token, stop = self.trie.longest(data, at[left], ends[left])
            follows = before[left] != _NONE
            tried.append((left[follows], before[left][follows], token[follows]))
            steps.append((left, token))
            before[left], at[left] = token, stop
            left = left[stop < ends[left]]
        for i in np.flatnonzero(lengths > LONG_WORD).tolist():
            token = self._walk(data, int(at[i]), int(ends[i]))
            steps.append((np.full(len(token), i), token))
            tried.append((np.full(len(token) - 1, i), token[:-1], token[1:]))
        if tried:
            who, a, b = (np.concatenate(x) for x in zip(*tried))
            pair, which = np.unique(a * self.size + b, return_inverse=True)
            failed[who[~self._kept_apart(pair // self.size, pair % self.size)[which]]] = True
        who = np.concatenate([w for w, _ in steps]) if steps else np.zeros(0, np.int64)
        ids = np.concatenate([t for _, t in steps]) if steps else np.zeros(0, np.int64)
        order = np.argsort(who, kind="stable")
        who, ids = who[order], ids[order]
        wrong = np.flatnonzero(failed)
        mended, again = self._merged([cut[i] for i in wrong])
        sure = ~failed[who]
        who, ids = np.concatenate([who[sure], wrong[mended]]), np.concatenate([ids[sure], again])
        order = np.argsort(who, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(who, minlength=len(cut))

    def _walk(self, data: np.ndarray, start: int, end: int) -> np.ndarray:
        """Longest matches of one long word from its start on: found at all its places together, then followed."""
        found, at = [], start
        while at < end:
            first, last = at, min(at + POSITIONS, end)
            places = np.arange(first, last)
            token, stop = self.trie.longest(data, places, np.full(len(places), end))
            token, stop = token.tolist(), stop.tolist()
            while at < last:
                found.append(token[at - first])
                at = stop[at - first]
        return np.array(found, np.int64)

    def _words(self, chunk: bytes) -> list[str]:
        text = chunk.decode()
        if all(ord(c) < _SURE for c in text):
            return WORDS.findall(text)
        cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in cuts]

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of all chunks are encoded together; a special token's string is its id."""
        cut: list[bytes] = []
        owner: list[int] = []
        special: list[tuple[int, int]] = []  # place among the words, id
        for i, chunk in enumerate(chunks):
            parts = self.special.split(chunk) if self.special else [chunk]
            if len(parts) == 1 and chunk.isascii() and 0x27 not in chunk and not any(m in chunk for m in self.marks):
                cut.append(chunk)  # one word: chunks end where kinds of characters change, but for texts held whole
                owner.append(i)
                continue
            for part in parts:
                if part in self.special_ids:
                    special.append((len(cut), self.special_ids[part]))
                    found = [b""]
                else:
                    found = [w.encode() for w in self._words(part)]
                cut += found
                owner += [i] * len(found)
        ids, counts = self.encode_words(cut)
        if special:
            place = np.array([p for p, _ in special])
            ids = np.insert(ids, np.cumsum(counts)[place], [i for _, i in special])
            counts[place] = 1
        return ids, np.bincount(owner, weights=counts, minlength=len(chunks)).astype(np.int64)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and the bounds of each text's; special tokens are written out."""
        return ragged(self.token_bytes, self.token_starts, ids.astype(np.int64), bounds)


@lru_cache(maxsize=2)
def speculator(path: str) -> Speculator:
    """One per worker and file."""
    return Speculator(path)


def encode_decode(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and decode the ids: ``key, n_tokens, ids, decoded``.

    tokenizer: a plain byte-level BPE file of the tokenizers library. ids are little-endian unsigned
    32-bit numbers, as the library gives them without added special tokens; decoded is the text that
    they stand for, special tokens included. Null and empty texts have no ids. Repeated rows and null keys come
    through one by one, an empty table gives no rows, other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = speculator(tokenizer)
        for batch in by_bytes(batches):
            ids, bounds = bpe.encode(batch.column("text"))
            data, ends = bpe.decode(ids, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(bounds)),
                 _slices(pa.binary(), ids.astype("<u4"), bounds * 4), _slices(pa.string(), data, ends)],
                names=["key", "n_tokens", "ids", "decoded"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(both, f"key {kind}, n_tokens long, ids binary, decoded string").withColumnRenamed("key", key)


def _slices(kind: pa.DataType, data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive runs of bytes as strings or binaries, without copying them."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(bounds) - 1, buffers)


def round_trip(batch_of: DataFrame, key: str = "doc_id") -> DataFrame:
    """Checksums of what ``encode_decode`` returns."""
    return batch_of.select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
