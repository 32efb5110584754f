"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes the documents of a block (tens of MB of text), cuts them into words (matches of the
tokenizer's pattern) and replays the merges over all distinct words of the block at once. An
inverted index maps each mergeable token pair, known by the rank of the token that it makes, to
its positions in the words. Ranks are taken in order from a heap; a rank's positions are merged
together, and only the pairs with the touched neighbours are looked up and indexed anew. The
result is a table word -> ids, through which the documents are written out.

This gives what a merge loop over each word alone gives: words do not touch each other, and within
a word merges happen by rank, from the left. If a merge makes a pair of lower rank than its own,
order within the word matters; such words are done again one merge at a time (`merge_one`).

The block, not the whole table, is the corpus of a replay: a vocabulary of the whole table would
grow with it and could neither be broadcast nor joined to each word without moving many times the
text. Blocks need no shuffle; a lost executor's blocks are simply encoded again.

Defined cases: a null text is empty and has no tokens. Very long texts and words are encoded whole.
Other columns are carried along where asked for, and never read. Empty tables give empty results.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import release, slices

_MOST_WORDS = 150_000  # remembered by a task between blocks
_MOST_PAIRS = 200_000
_SHIFT = 1 << 20  # more than the ids of any vocabulary read here


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One tokenizer per worker process; a vocabulary file has a fixed size."""
    return Tokenizer(path, pattern)


class Tokenizer:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if self.pattern.groups:
            raise ValueError("the pattern has groups; words are its whole matches")
        self.pair_ranks: dict[int, int] = {}
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def pair_rank(self, left: int, right: int) -> int:
        """Rank of the token that two tokens make; -1 if they make none."""
        key = left * _SHIFT + right
        found = self.pair_ranks.get(key)
        if found is None:
            if len(self.pair_ranks) >= _MOST_PAIRS:
                self.pair_ranks.clear()
            found = self.pair_ranks[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return found

    def merge_one(self, word: bytes) -> list[int]:
        """Merges of one word: the lowest rank first, the leftmost of equal ranks first."""
        ids = [self.ranks[bytes([b])] for b in word]
        while len(ids) > 1:
            options = [(r, i) for i in range(len(ids) - 1) if (r := self.pair_rank(ids[i], ids[i + 1])) >= 0]
            if not options:
                break
            rank, i = min(options)
            ids[i : i + 2] = [rank]
        return ids

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        found: list[bytes | None] = [None] * len(words)
        open_ = []
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is None:
                open_.append(i)
            else:
                found[i] = rank.to_bytes(4, "little")
        ids, ends, odd = replay(self, [words[i] for i in open_])
        flat, start = ids.astype("<u4").tobytes(), 0
        for k, i in enumerate(open_):
            found[i] = flat[4 * start : 4 * ends[k]]
            start = ends[k]
        for k in odd:
            i = open_[k]
            found[i] = np.array(self.merge_one(words[i]), "<u4").tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as `encode_words`."""
        same: dict[str, str] = {}  # one object per distinct word of the block
        cut = [list(map(same.setdefault, words, words)) for words in map(self.words, texts)]
        new = [w for w in same if w not in self.known]  # words of earlier blocks need no replay
        made = self.encode_words([w.encode() for w in new])
        table = self.known | dict(zip(new, made, strict=True))
        room = _MOST_WORDS - len(self.known)
        self.known.update(zip(new[:room], made[:room], strict=True))
        return [b"".join(map(table.__getitem__, words)) for words in cut]

    def forget(self) -> None:
        """Drop what was remembered between blocks."""
        self.known.clear()
        self.pair_ranks.clear()
        release()

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids given as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _ranks_of(t: Tokenizer, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair; -1 where the pair makes no token. Distinct pairs are looked up once."""
    if len(left) <= 8:
        return np.array([t.pair_rank(a, b) for a, b in zip(left.tolist(), right.tolist(), strict=True)], np.int32)
    keys, inverse = np.unique(left.astype(np.int64) * _SHIFT + right, return_inverse=True)
    found = [t.pair_rank(k // _SHIFT, k % _SHIFT) for k in keys.tolist()]
    return np.array(found, np.int32)[inverse]


def replay(t: Tokenizer, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """All merges over the words: ids in word order, end of each word's ids, words to do again."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = int(sizes.sum())
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64), []
    token = t.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    place = np.int32 if n < 1 << 31 else np.int64
    last = np.cumsum(sizes)[sizes > 0] - 1
    after = np.arange(1, n + 1, dtype=place)  # place n is the end of any word: it has token -1
    after[last] = n
    before = np.arange(-1, n - 1, dtype=place)
    before[np.concatenate([[0], last[:-1] + 1])] = -1
    live = np.ones(n, bool)
    rank = np.full(n + 1, -1, np.int32)  # of the pair that starts at a place
    odd: set[int] = set()
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(places: np.ndarray, found: np.ndarray) -> None:
        rank[places] = found
        places, found = places[found >= 0], found[found >= 0]
        order = np.argsort(found, kind="stable")
        places, found = places[order], found[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for r, part in zip(found[np.concatenate([[0], cuts])] if len(found) else [], np.split(places, cuts), strict=False):
            r = int(r)
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(part)

    inner = np.flatnonzero(after < n)
    add(inner, _ranks_of(t, token[inner], token[after[inner]]))
    while heap:
        r = heapq.heappop(heap)
        parts = index.pop(r)
        places = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
        places = places[live[places] & (rank[places] == r)]
        if not len(places):
            continue
        if len(places) > 1 and (overlap := after[places[:-1]] == places[1:]).any():
            # pairs that share a token: from the left, every other one of a chain merges
            start = np.concatenate([[True], ~overlap])
            first = np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - first) % 2 == 0]
        gone = after[places]
        beyond = after[gone]
        token[places] = r
        live[gone] = False
        rank[gone] = -1
        after[places] = beyond
        inside = beyond < n
        before[beyond[inside]] = places[inside]
        rank[places] = -1
        # only pairs with a touched neighbour are new
        left = before[places]
        new = np.unique(np.concatenate([places[inside], left[left >= 0]]))
        if len(new):
            found = _ranks_of(t, token[new], token[after[new]])
            if (lower := (found >= 0) & (found <= r)).any():
                odd.update(word[new[lower]].tolist())
            add(new, found)
    ends = np.cumsum(np.bincount(word[live], minlength=len(words)))
    return token[live], ends, sorted(odd)


OUTPUT = {
    "n_tokens": "long",
    "ids": "binary",
    "decoded": "binary",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    carry: list[str],
    output: tuple[str, ...] = ("n_tokens", "ids"),
    text: str = "text",
    block_bytes: int = 12 << 20,
) -> DataFrame:
    """The ``carry`` columns and the ``output`` columns asked for.

    n_tokens; ids (little-endian unsigned 32-bit integers); decoded (the bytes that the ids stand for);
    ids_sha256 and decoded_sha256 (lowercase hex). These win over a carried column of their name.
    """
    carry = [c for c in carry if c not in output]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        decodes = any(c.startswith("decoded") for c in output)
        for batch in slices(batches, text, block_bytes):
            ids = t.encode([x or "" for x in batch.column(text).to_pylist()])
            made = {c: [] for c in output}
            for x in ids:
                decoded = t.decode(x) if decodes else b""
                for c, values in made.items():
                    if c == "n_tokens":
                        values.append(len(x) // 4)
                    else:
                        data = x if c.startswith("ids") else decoded
                        values.append(sha256(data).hexdigest() if c.endswith("sha256") else data)
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(values, _ARROW[OUTPUT[c]]) for c, values in made.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *output])
        t.forget()

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), *(f"{c} {OUTPUT[c]}" for c in output)])
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def decode(encoded: DataFrame, path: str, pattern: str, carry: list[str], ids: str = "ids") -> DataFrame:
    """The ``carry`` columns and ``decoded``: the bytes of ids as `encode` gives them; null ids are empty."""
    carry = [c for c in carry if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for batch in batches:
            found = [t.decode(x or b"") for x in batch.column(ids).to_pylist()]
            columns = [*(batch.column(c) for c in carry), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "decoded"])

    types = dict(encoded.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "decoded binary"])
    return encoded.select(*dict.fromkeys([*carry, ids])).mapInArrow(run, schema)
