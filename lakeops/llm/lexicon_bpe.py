"""BPE encoding and decoding with a lexicon: a minimal acyclic transducer of the frequent words.

1. All words (matches of the pre-tokenizer's pattern) of all whole texts are counted. A histogram of
   the counts, in eighths of a power of two, gives the smallest bound that at most ``most_words``
   words reach; the words that reach it are the lexicon. Its size does not grow with the table.
2. One task compiles the lexicon into a minimal acyclic automaton: words are added in byte order, and
   states with equal futures (finality, arcs, targets) are merged as soon as a prefix is closed, so
   that words share their suffixes as well as their prefixes. An arc's number says how many words of
   its source state come before it; the numbers along a word's path add up to the word's place, and
   the place leads to its token ids. So the automaton maps a word to its ids and knows no others.
3. The automaton is a flat file. Spark hands it to every executor, also to those that start late, and
   tasks map it into memory. The distinct words of a block walk through it together, one byte a step.
4. Words that it does not hold are merged exactly: the pair of lowest rank first, the leftmost of
   equal ranks first. The ids do not depend on what the lexicon holds.

Tokenizer files are those of the tokenizers library: byte-level BPE without normaliser, byte prefix
or truncation in use. Strings of added tokens (such as ``<|endoftext|>``) are cut out of the text
first and take their own id, as the library does.

The pattern runs in the `regex` module. Its Unicode tables are newer than the library's; a text with
a code point outside ``SAME_CLASSES``, the ranges in which both agree, is cut by the library itself.

Defined cases: a null text is empty and has no tokens; bytes that are not UTF-8 are read as U+FFFD.
Very long texts and words are encoded whole; words over ``LONGEST`` bytes are never in the lexicon.
Repeated rows are encoded each. Carried columns are passed on and never read; the output wins over a
carried column of its name. An empty table gives an empty lexicon and an empty result.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, release, slices, texts, written

MOST_WORDS = 1 << 16  # of the lexicon
LONGEST = 64  # bytes of a word of the lexicon
HELD_WORDS = 400_000  # counted by a task before it hands them on
KNOWN_WORDS = 150_000  # remembered by a task between blocks
BLOCK_BYTES = 12 << 20
IN_STEP = 40  # bytes of words that are merged together; longer ones are merged by a heap each
NO_RANK = np.int32((1 << 31) - 1)

#: Fixed by the byte-level pre-tokenizer: its pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points that the `regex` module and the library's pre-tokenizer put in the same class.
SAME_CLASSES = (
    "\\u0000-\\u0557\\u0590-\\u088E\\u0900-\\u0C5B\\u0D00-\\u208E\\u20A0-\\uA7CD"
    "\\uA800-\\uAB6B\\uAC00-\\uFFFF\\U0001F000-\\U0001FAFF\\U00020000-\\U0002B739"
)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable Latin-1 as itself, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process; a tokenizer file has a fixed size."""
    return Vocabulary(path)


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (
            model.get("type", "BPE") != "BPE"
            or spec.get("normalizer")
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or not before.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
            or any(a.get(k) for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.path = path
        of = byte_characters()
        ids = model["vocab"]
        self.tokens = {i: bytes(map(of.__getitem__, token)) for token, i in ids.items()}
        self.of_byte = [ids[c] for c in sorted(of, key=of.__getitem__)]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.made.append(ids[left + right])
        pairs = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(pairs)
        self.sorted_pairs = np.append(pairs[order], 1 << 62)
        self.sorted_ranks = np.append(np.fromiter(self.ranks.values(), np.int32, len(pairs))[order], NO_RANK)
        self.made_ids, self.byte_ids = np.array(self.made, np.int32), np.array(self.of_byte, np.int32)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.byte_ranks = self.pair_ranks(self.byte_ids[first], self.byte_ids[second]).reshape(256, 256)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: content.encode() for content, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.pattern = regex.compile(BYTE_LEVEL)
        self.unsure = regex.compile(f"[^{SAME_CLASSES}]")
        self._library = None

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return self._library

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if self.unsure.search(text):
            return [text[a:b] for _, (a, b) in self.library().pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def pieces(self, text: str) -> list[str]:
        """Words and added tokens of a text; every second run of words is followed by one added token."""
        if self.apart is None or not self.apart.search(text):
            return self.words(text)
        parts = self.apart.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.words(part))]

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word by exact merges: a heap of (rank, place), neighbours linked both ways."""
        ids = [self.of_byte[b] for b in word]
        n, ranks, made = len(ids), self.ranks, self.made
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(ids[i] << 32 | ids[i + 1])) is not None]
        if not heap:
            return ids
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ranks.get(ids[i] << 32 | ids[j]) != rank:
                continue  # a neighbour has changed since
            ids[i], ids[j] = made[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := ranks.get(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [x for x in ids if x >= 0]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """`merge` of each word, as little-endian unsigned 32-bit integers; short words of equal length go in step."""
        found: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            if size > IN_STEP or len(at) < 8:
                for i in at.tolist():
                    found[i] = np.array(self.merge(words[i]), "<u4").tobytes()
                continue
            data = np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8).reshape(len(at), size)
            for rows, ids in self._in_step(data):
                width, data_ = 4 * ids.shape[1], ids.astype("<u4").tobytes()
                for k, i in enumerate(at[rows].tolist()):
                    found[i] = data_[k * width : (k + 1) * width]
        return found

    def _in_step(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, their ids) of words of equal length, given as rows of bytes. Each step merges one pair of every
        row that still has one: the first of the lowest rank. So all open rows stay equally long."""
        ids, rows = self.byte_ids[data], np.arange(len(data))
        ranks = self.byte_ranks[data[:, :-1], data[:, 1:]]
        while len(rows):
            if ids.shape[1] == 1:
                yield rows, ids
                return
            at = ranks.argmin(1)
            each = np.arange(len(rows))
            done = ranks[each, at] == NO_RANK
            if done.any():
                yield rows[done], ids[done]
                rows, ids, ranks, at = rows[~done], ids[~done], ranks[~done], at[~done]
                if not len(rows):
                    return
                each = np.arange(len(rows))
            ids[each, at] = self.made_ids[ranks[each, at]]
            stays = np.ones(ids.shape, bool)
            stays[each, at + 1] = False
            ids = ids[stays].reshape(len(rows), -1)
            ranks = ranks[stays[:, 1:]].reshape(len(rows), -1)  # the merged pair's rank goes
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self.pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NO_RANK if it does not merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.sorted_pairs, keys), len(self.sorted_pairs) - 1)
        return np.where(self.sorted_pairs[at] == keys, self.sorted_ranks[at], NO_RANK)

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of ids; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(map(self.tokens.__getitem__, ids.tolist()))
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()
        return data


def compile_words(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """The minimal automaton of sorted distinct words: arcs (byte -> state) and finality of each state; 0 starts.

    The path of the last word stays open; where the next word leaves it, the states below are closed:
    a closed state equal to an earlier one is replaced by it.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte) of the open path
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth:
            state, byte = path.pop()
            below = arcs[state][byte]
            future = (final[below], tuple(arcs[below].items()))
            same = known.setdefault(future, below)
            if same != below:
                arcs[state][byte] = same
                free.append(below)

    free: list[int] = []
    for word in words:
        depth, most = 0, min(len(last), len(word))
        while depth < most and last[depth] == word[depth]:
            depth += 1
        close(depth)
        at = arcs[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[depth:]:
            if free:
                new = free.pop()
                arcs[new], final[new] = {}, False
            else:
                new = len(arcs)
                arcs.append({})
                final.append(False)
            arcs[at][byte] = new
            path.append((at, byte))
            at = new
        final[at] = True
        last = word
    close(0)
    return arcs, final


def flat(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The automaton of sorted distinct words and their ids as one block of memory (`Lexicon` reads it)."""
    arcs, final = compile_words(words)
    order = [0]  # reachable states, numbered anew as they are met
    number = {0: 0}
    for state in order:
        for below in arcs[state].values():
            if below not in number:
                number[below] = len(order)
                order.append(below)
    held: dict[int, int] = {}  # words below each state
    todo = [0]
    while todo:
        state = todo[-1]
        open_ = [b for b in arcs[state].values() if b not in held]
        if open_:
            todo += open_
        else:
            todo.pop()
            held[state] = final[state] + sum(held[b] for b in arcs[state].values())
    keys, targets, numbers = [], [], []
    for place, state in enumerate(order):
        ahead = int(final[state])
        for byte, below in sorted(arcs[state].items()):
            keys.append(place << 8 | byte)
            targets.append(number[below])
            numbers.append(ahead)
            ahead += held[below]
    ends = np.cumsum([0, *map(len, ids)])
    parts = [
        np.array([len(keys), len(order), len(words), ends[-1]], "<i8"),
        np.array(keys, "<i8"),
        np.array(ends, "<i8"),
        np.array(targets, "<i4"),
        np.array(numbers, "<i4"),
        np.array([x for one in ids for x in one], "<u4"),
        np.array([final[s] for s in order], "u1"),
    ]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """The automaton in a block of memory; words are looked up together."""

    def __init__(self, data: np.ndarray):
        n_arcs, n_states, n_words, n_ids = data[:32].view("<i8").tolist()
        at = 32

        def part(n: int, kind: str) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            at += size
            return data[at - size : at].view(kind)

        self.keys, self.ends = part(n_arcs, "<i8"), part(n_words + 1, "<i8")
        self.targets, self.numbers = part(n_arcs, "<i4"), part(n_arcs, "<i4")
        self.ids, self.final = part(n_ids, "<u4"), part(n_states, "u1")

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the lexicon's words in byte order; -1 where it is not one of them."""
        found = np.full(len(words), -1, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        walking = np.flatnonzero(sizes <= LONGEST)
        if not len(self.keys) or not len(walking):
            return found
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        starts = np.cumsum(sizes) - sizes
        state = np.zeros(len(walking), np.int64)
        place = np.zeros(len(walking), np.int64)
        step = 0
        while len(walking):
            ended = sizes[walking] == step
            here = ended & (self.final[state] == 1)
            found[walking[here]] = place[here]
            walking, state, place = walking[~ended], state[~ended], place[~ended]
            key = state << 8 | data[starts[walking] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            walking, arc, place = walking[there], arc[there], place[there]
            state, place = self.targets[arc].astype(np.int64), place + self.numbers[arc]
            step += 1
        return found

    def outputs(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian unsigned 32-bit integers; None for words it does not hold."""
        data, place = self.ids.tobytes(), self.places(words)
        start, end = self.ends[place], self.ends[place + 1]  # those of place -1 are not used
        rows = zip(place.tolist(), start.tolist(), end.tolist(), strict=True)
        return [None if p < 0 else data[4 * a : 4 * b] for p, a, b in rows]


@lru_cache(maxsize=2)
def _mapped(name: str | None) -> Lexicon:
    if name is None:
        return Lexicon(np.frombuffer(flat([], []), np.uint8))
    return Lexicon(np.memmap(SparkFiles.get(name), np.uint8, "r"))


def count_words(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word binary, n long): how often each word stands in all texts. Tasks count before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            words = pa.array(list(held), pa.string()).cast(pa.binary())
            counts = pa.array(held.values(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, counts], names=["word", "n"])

        for batch in slices(batches, text, BLOCK_BYTES):
            for x in texts(batch.column(text)):
                held.update(v.pieces(x))
                if len(held) > HELD_WORDS:
                    yield handed()
        yield handed()
        release()

    partial = docs.select(text).mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """The words of ``counted`` of the highest counts, ``most_words`` at most: all above a bound of the counts.

    The bound lies between eighths of a power of two, so at most 512 rows decide on it.
    """
    graded = counted.where(F.length("word") <= LONGEST).withColumn("grade", F.floor(F.log2("n") * 8))
    grades = graded.groupBy("grade").agg(F.count(F.lit(1)).alias("held"))
    above = Window.orderBy(F.col("grade").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = grades.withColumn("held", F.sum("held").over(above)).where(F.col("held") <= most_words).select("grade")
    return graded.join(F.broadcast(taken), "grade").select("word", "n")


def build_lexicon(docs: DataFrame, path: str, text: str = "text", most_words: int = MOST_WORDS) -> str | None:
    """Count, choose and compile the lexicon of ``docs``; its name among Spark's files. One bounded task compiles.

    None where no word is in the lexicon.
    """
    spark = docs.sparkSession
    uri = f"{new_folder(spark, 'lexicon')}/lexicon-{uuid.uuid4().hex}.bin"
    counted = written(count_words(docs, path, text), "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        words = sorted(w for batch in batches for w in batch.column(0).to_pylist() if w.decode() not in v.added)
        data = flat(words, [v.merge(w) for w in words])
        system, place = fs.FileSystem.from_uri(uri)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        # a repeated attempt writes the same bytes
        with system.open_output_stream(place) as out:
            out.write(data)
        release()
        yield pa.RecordBatch.from_arrays([pa.array([len(words)], pa.int64())], names=["words"])

    if not frequent(counted, most_words).select("word").repartition(1).mapInArrow(run, "words long").collect():
        return None
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


class Encoder:
    """Encodes blocks of texts: the lexicon first, exact merges for the rest."""

    def __init__(self, v: Vocabulary, lexicon: Lexicon):
        self.v, self.lexicon = v, lexicon
        self.known: dict[str, bytes] = {}
        self.fixed = {content: i.to_bytes(4, "little") for content, i in v.added.items()}

    def encode(self, block: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        same: dict[str, str] = {}  # one object per distinct word of the block
        cut = [list(map(same.setdefault, words, words)) for words in map(self.v.pieces, block)]
        new = [w for w in same if w not in self.known and w not in self.fixed]
        data = [w.encode() for w in new]
        made = dict(zip(new, self.lexicon.outputs(data), strict=True))
        unseen = [w for w, ids in made.items() if ids is None]
        made |= zip(unseen, self.v.merge_all([w.encode() for w in unseen]), strict=True)
        table = self.known | made | self.fixed
        if len(self.known) + len(made) > KNOWN_WORDS:
            self.known.clear()
        if len(made) <= KNOWN_WORDS:
            self.known.update(made)
        return [b"".join(map(table.__getitem__, words)) for words in cut]


OUTPUT = {
    "n_tokens": "long",
    "ids": "binary",
    "decoded": "string",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def encode(
    docs: DataFrame,
    path: str,
    carry: list[str],
    output: tuple[str, ...] = ("n_tokens", "ids"),
    text: str = "text",
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """The ``carry`` columns and the ``output`` columns asked for.

    n_tokens; ids (little-endian unsigned 32-bit integers); decoded (the text of the ids); ids_sha256 and
    decoded_sha256 (lowercase hex).
    """
    carry = [c for c in carry if c not in output]
    name = build_lexicon(docs, path, text, most_words)
    decodes = any(c.startswith("decoded") for c in output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        encoder = Encoder(v, _mapped(name))
        for batch in slices(batches, text, BLOCK_BYTES):
            made: dict[str, list] = {c: [] for c in output}
            for ids in encoder.encode(texts(batch.column(text))):
                decoded = v.decode(np.frombuffer(ids, "<u4")) if decodes else b""
                for c, values in made.items():
                    if c == "n_tokens":
                        values.append(len(ids) // 4)
                    elif c == "decoded":
                        values.append(decoded.decode())
                    else:
                        data = ids if c.startswith("ids") else decoded
                        values.append(sha256(data).hexdigest() if c.endswith("sha256") else data)
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(values, _ARROW[OUTPUT[c]]) for c, values in made.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *output])
        del encoder
        release()

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), *(f"{c} {OUTPUT[c]}" for c in output)])
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, carry: list[str], ids: str = "ids") -> DataFrame:
    """The ``carry`` columns and ``decoded``: the text of ids as `encode` gives them; null ids are empty."""
    carry = [c for c in carry if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            found = [v.decode(np.frombuffer(x or b"", "<u4")).decode() for x in batch.column(ids).to_pylist()]
            columns = [*(batch.column(c) for c in carry), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "decoded"])

    types = dict(encoded.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "decoded string"])
    return encoded.select(*dict.fromkeys([*carry, ids])).mapInArrow(run, schema)
