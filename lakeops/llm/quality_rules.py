"""Quality rules: an isolation forest over rule statistics.

Every document gets rule statistics (word, symbol, line and repetition counts). A hard rule
rejects very short and very repetitive texts. Of the others, isolation forests decide, one for
each statistic and one over all of them: trees of random splits isolate unusual rows early, so a
short mean path marks an anomaly. The trees are grown on rows with label 1, and their cuts reach
beyond the rows of a node, so that a value far outside is isolated sooner than the outermost row.
The path score beyond which a forest rejects comes from rows of both labels: at most
``max_good_loss`` of those with label 1 lie above it, and it stands halfway to the lowest score of
label 0 that can be parted from them (at the highest score kept if there is none).

Bounds: the forest and its threshold are fitted on at most ``max_labelled`` labelled documents;
every statistic of every document is taken from its whole text in one pass without a shuffle.

Defined cases: a null text has no words (all counts zero, base_failed true). Repeated rows are
judged one by one, alike. Without labelled rows there are no forests and the hard rule alone
decides. Empty tables give empty results. Other columns are carried along unread, under any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, slices
from .labelled import labelled_sample

SYMBOLS = "#*$%&|<>"
WINDOW = 5
CONSTANT_RANGE = 0.01
_CAPITALS = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_upper", "n_marks")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more (overlaps count)."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    key = ids
    for k in range(1, window):  # key[i] numbers the distinct runs of k + 1 words from word i on
        _, key = np.unique(key[: n - k] * len(seen) + ids[k:], return_inverse=True)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def _held(data: bytes, these: bytes) -> int:
    return len(data) - len(data.translate(None, these))


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS and the extra counts (lines with a word, capitals A-Z, ! and ?) of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - _held(data, SPACES.encode()),
        _held(data, SYMBOLS.encode()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        _held(data, _CAPITALS),
        _held(data, b"!?"),
    )


def features(counts: np.ndarray) -> np.ndarray:
    """Length-free ratios of the counts, one row per document."""
    n_words, chars, symbols, dup, repeat, lines, upper, marks = counts.T.astype(float)
    words, chars, lines = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack(
        [chars / words, symbols / chars, dup / lines, repeat / words, upper / chars, marks / words], axis=1
    )


def _mean_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


class IsolationForest:
    """Trees as flat arrays; ``score`` is in (0, 1), higher for rows that are isolated sooner.

    Cuts reach ``reach`` times the range of a node's rows beyond them on both sides; a column that is
    constant in a tree's sample then counts as CONSTANT_RANGE wide.
    """

    def __init__(self, rows: np.ndarray, n_trees: int = 60, sample: int = 256, seed: int = 7, reach: float = 0.0):
        rng = np.random.default_rng(seed)
        self.reach = reach
        self.size = min(sample, len(rows))
        self.trees = [self._tree(rows[rng.permutation(len(rows))[: self.size]], rng) for _ in range(n_trees)]

    def _tree(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        most = math.ceil(math.log2(max(2, self.size)) * (1 + 2 * self.reach))
        constant = rows.max(axis=0) == rows.min(axis=0) if self.reach else np.zeros(rows.shape[1], bool)
        feature, cut, child, path = [-1], [0.0], [0], [0.0]
        todo = [(0, rows, 0)]
        while todo:
            node, part, depth = todo.pop()
            spread = np.flatnonzero((part.max(axis=0) > part.min(axis=0)) | constant) if len(part) > 1 else []
            if depth >= most or not len(spread):
                path[node] = depth + _mean_path(len(part))
                continue
            f = int(rng.choice(spread))
            low, high = float(part[:, f].min()), float(part[:, f].max())
            beyond = self.reach * (CONSTANT_RANGE if constant[f] else high - low)
            at = float(rng.uniform(low - beyond, high + beyond))
            left = part[:, f] <= at
            feature[node], cut[node], child[node] = f, at, len(feature)
            for side in (part[left], part[~left]):
                todo.append((len(feature), side, depth + 1))
                for column, empty in ((feature, -1), (cut, 0.0), (child, 0), (path, 0.0)):
                    column.append(empty)
        return np.array(feature), np.array(cut), np.array(child), np.array(path)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total, row = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, child, path in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (inner := feature[node] >= 0).any():
                step = child[node] + (rows[row, feature[node]] > cut[node])
                node = np.where(inner, step, node)
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / max(_mean_path(self.size), 1e-9))


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


class Rules:
    """A forest per statistic and one over all, each with the path score beyond which it rejects."""

    def __init__(self, counts: np.ndarray, label: np.ndarray, max_good_loss: float):
        usable = ~base_failed(counts)
        rows, good = features(counts[usable]), label[usable] == 1
        self.forests: list[tuple[list[int], IsolationForest, float]] = []
        if good.sum() < 2:
            return
        groups = [[f] for f in range(rows.shape[1])] + [list(range(rows.shape[1]))]
        for columns in groups:
            forest = IsolationForest(rows[good][:, columns], reach=0.5)
            scores = np.sort(forest.score(rows[good][:, columns]))
            highest = scores[min(len(scores), math.ceil((1 - max_good_loss) * len(scores))) - 1]
            junk = forest.score(rows[~good][:, columns])
            above = junk[junk > highest]
            threshold = (highest + above.min()) / 2 if len(above) else highest
            self.forests.append((columns, forest, float(threshold)))

    def kept(self, counts: np.ndarray) -> np.ndarray:
        keep = ~base_failed(counts)
        rows = features(counts)
        for columns, forest, threshold in self.forests:
            if keep.any():
                keep[keep] = forest.score(rows[keep][:, columns]) <= threshold
        return keep


def _counts(texts: pa.Array) -> np.ndarray:
    found = [statistics(t) for t in texts.to_pylist()]
    return np.array(found, np.int64).reshape(len(found), len(COUNTS) + len(_EXTRA))


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, max_good_loss: float = 0.0005) -> Rules:
    """Fit on the rule statistics of at most ``max_labelled`` labelled documents."""
    names = [*COUNTS, *_EXTRA]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pd.DataFrame(_counts(batch.column("text")), columns=names)
            table.insert(0, "label", batch.column("label").to_numpy())
            table.insert(0, "doc_id", batch.column("doc_id").to_numpy())
            yield pa.RecordBatch.from_pandas(table, preserve_index=False)

    schema = "doc_id long, label int, " + ", ".join(f"{n} long" for n in names)
    sample = labelled_sample(docs, labels, "quality", max_labelled).mapInArrow(measure, schema)
    packed = sample.selectExpr("doc_id", f"struct(label, {', '.join(names)}) AS row")
    once = packed.groupBy("doc_id").agg(F.min("row").alias("row"))
    found = once.orderBy("doc_id").select("row.*").toPandas()
    return Rules(found[names].to_numpy(np.int64), found["label"].to_numpy(), max_good_loss)


def apply_rules(docs: DataFrame, rules: Rules, carry: list[str], text: str = "text") -> DataFrame:
    """The ``carry`` columns with COUNTS, base_failed and kept; these win over a carried column of their name."""
    added = [f"{n} long" for n in COUNTS] + ["base_failed boolean", "kept boolean"]
    carry = [c for c in carry if c not in {a.split()[0] for a in added}]
    shared = docs.sparkSession.sparkContext.broadcast(rules)  # 420 trees of bounded depth on 256 rows each

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            counts = _counts(batch.column(text))
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(counts[:, i]) for i in range(len(COUNTS))]
            columns += [pa.array(base_failed(counts)), pa.array(shared.value.kept(counts))]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *COUNTS, "base_failed", "kept"])

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), *added])
    return docs.select(*dict.fromkeys([*carry, text])).mapInArrow(judge, schema)


def keep_by_rules(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all of their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 8 << 20):
            yield batch.filter(pa.array(shared.value.kept(_counts(batch.column(text)))))

    return docs.mapInArrow(judge, docs.schema)
