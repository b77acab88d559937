"""Texts as ids of a public byte-level BPE tokenizer.

Distinct words go, sorted, through a depth-first walk of their prefix trie. The state at a trie node is the last token
of the node's byte string: byte-pair encodings have the property that the encoding of a prefix is that of a shorter
prefix plus its last token, and that a sequence is an encoding exactly if every two neighbours encode as themselves.
So a node tries the vocabulary's tokens that end there, longest first, against the last token of what precedes them.
Words that share a prefix share the nodes, and each is computed once. Sorted order makes the walk a stack: the next
word keeps the states of what it shares with the one before.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.session import widened

#: Where the public vocabularies are; every executor needs them at the same place. A parameter of each function here.
TOKENIZERS = "/opt/tokenizers"
#: How this family of tokenizers cuts texts into words; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of distinct words, and pairs of tokens, that a task remembers at most.
WORD_BYTES, PAIRS = 16_000_000, 500_000


class PrefixEncoder:
    """Encodes words of one vocabulary; remembers words and token pairs within bounds."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.text = {rank: token for token, rank in self.ranks.items()}
        own = {t: r for t, r in self.ranks.items() if self._merge(t) == [r]}
        #: every end of a token: its rank, or -1 if it is only an end
        self.ends = {t[i:]: -1 for t in own for i in range(len(t))} | own
        self.fits: dict[int, bool] = {}
        self.known: dict[bytes, list[int]] = {}
        self.known_bytes = 0

    def _merge(self, word: bytes) -> list[int]:
        """The encoding by definition: merge the neighbours of lowest rank until none can be merged."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 30))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _fit(self, left: int, right: int) -> bool:
        key = left << 20 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            found = self.fits[key] = self._merge(self.text[left] + self.text[right]) == [left, right]
        return found

    def learn(self, words: set[bytes]) -> None:
        """Encodes the words not known yet, each shared prefix once."""
        if self.known_bytes > WORD_BYTES:
            self.known.clear()
            self.known_bytes = 0
        ends, fit, known = self.ends, self._fit, self.known
        before, last, start = b"", [-1], [0]  # for each prefix length: last token, where it starts
        for word in sorted(w for w in words if w not in known):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], start[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                fitting = []
                for begin in range(end - 1, -1, -1):
                    rank = ends.get(word[begin:end])
                    if rank is None:
                        break
                    if rank >= 0:
                        fitting.append((begin, rank))
                for begin, rank in reversed(fitting):
                    if begin == 0 or fit(last[begin], rank):
                        last.append(rank)
                        start.append(begin)
                        break
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at = start[at]
            ids.reverse()
            known[word] = ids
            self.known_bytes += len(word)
            before = word

    def encode(self, texts: list[str | None], cut: regex.Pattern) -> Iterator[list[int]]:
        """The ids of each text; null and empty texts have none."""
        split = [[w.encode() for w in cut.findall(t)] if t else [] for t in texts]
        self.learn({w for words in split for w in words})
        known = self.known
        for words in split:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            yield ids


@lru_cache(2)
def encoder(path: str) -> PrefixEncoder:
    """One encoder per Python worker and vocabulary."""
    return PrefixEncoder(path)


def _chunks(texts: list[str | None], chars: int = 2_000_000) -> Iterator[list[str | None]]:
    """Texts in groups of about ``chars``; a longer text is a group of its own, never cut."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t or "") > chars:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t or "")
    if group:
        yield group


def _encoding(path: str, only_sizes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, cut = encoder(path), regex.compile(PATTERN)
        for batch in batches:
            done = 0
            for group in _chunks(batch.column(1).to_pylist()):
                keys = batch.column(0).slice(done, len(group))
                done += len(group)
                encoded = tokens.encode(group, cut)
                if only_sizes:
                    yield pa.RecordBatch.from_arrays([keys, pa.array([len(ids) for ids in encoded], pa.int64())], names=["key", "n_tokens"])
                    continue
                ids = list(encoded)
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.fromiter((x for one in ids for x in one), np.int32, offsets[-1])
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "ids"])

    return run


def token_ids(documents: DataFrame, key: str, text: str, *, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``key, ids``: the ids of each text without special tokens, their strings being ordinary text.

    One row per input row; null and empty texts have an empty list; blank ones have the ids of their white space.
    ``key`` may be any bigint column, nulls included. Other columns are not read. No shuffle.
    """
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return widened(rows).mapInArrow(_encoding(f"{folder}/{tokenizer}.tiktoken", False), "key bigint, ids array<int>").withColumnRenamed("key", key)


def token_counts(documents: DataFrame, key: str, text: str, *, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``key, n_tokens``: how many ids ``token_ids`` gives."""
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return widened(rows).mapInArrow(_encoding(f"{folder}/{tokenizer}.tiktoken", True), "key bigint, n_tokens bigint").withColumnRenamed("key", key)
