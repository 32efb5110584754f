"""Conversation structure repair by weighted CYK interval parsing.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``: nothing, or pairs of user and
assistant after at most one system row. A row may be kept (0), given the role user or assistant (3)
or deleted (4; blank rows and duplicates have to be); rows without text may be inserted anywhere (3);
a truncated row that stays costs 3 more. Of the cheapest edits the ASCII-least string of initials
(the audit: D, I, K, R) is taken.

* The repair grammar is in Chomsky normal form. Its nonterminals are pairs ``p>q`` of states of the
  legal sequence (0 start, 1 after system, 2 after user, 3 after assistant): ``p>q`` derives the spans
  that lead from p to q. Binary rules are ``p>q -> p>r r>q``; unary rules derive one row. The start
  symbols are 0>0 and 0>3.
* A cell of a span holds the least (cost, audit) of each nonterminal. Insertions derive empty spans;
  their closure (`INSERTED`) is folded into the cells of single rows on both sides.
* Cells are combined bottom-up by span length: rows, spans of 2, 4, 8 rows and so on. The least
  (cost, audit) is the same for every split of a span, so one split per span is enough: costs add,
  and audits of equal cost over the same rows are never prefixes of each other (what a longer one has
  beyond the shorter could only be insertions, which cost), so the least concatenation is the
  concatenation of the least. A conversation of n rows needs n - 1 combinations.

On Spark: rows become narrow facts (a digest for the text) and equal rows of a turn are counted before
they are shuffled; duplicates are found by the first turn per (conversation, role, digest). The facts
are sorted over all tasks by range, so that a conversation of any size is dealt over tasks as stretches; each
task gives one span cell per stretch, and these few cells are combined by conversation. Texts are
shuffled once, to apply the edits: a conversation's texts stream through one task in order, since
their digest is a chain, and no more than a batch of them is held.

Defined cases: null roles and texts are one space, so such rows are blank or have no legal role. Null turns
come first; rows of a turn are taken by role, then by the SHA-256 of the text. A null conv_id is a conversation
of its own. Equal rows are duplicates after the first. Empty and very long texts are like others. A conversation whose
rows are all dropped is returned with zeros. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, release, texts, written

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")  # neighbours
#: Steps of the legal sequence: (state, initial) -> state; it may end in states 0 and 3.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEEDED = ("user", "user", "assistant", "user")  # what an inserted or relabelled row becomes in a state
STATES = range(4)
LEAF = 8  # rows of the spans that are remembered

Cell = tuple  # of 16 (cost, audit) or None, nonterminal p>q at 4 * p + q
_RULES = [[(4 * p + r, 4 * r + q) for r in STATES] for p in STATES for q in STATES]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: for each p>q the least of p>r r>q."""
    out = []
    for rules in _RULES:
        best = None
        for i, j in rules:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                cost = a[0] + b[0]
                if best is None or cost <= best[0]:
                    made = (cost, a[1] + b[1])
                    if best is None or made < best:
                        best = made
        out.append(best)
    return tuple(out)


def _cell(found: dict[tuple[int, int], list[tuple[int, str]]]) -> Cell:
    return tuple(min(found.get((p, q), []), default=None) for p in STATES for q in STATES)


def _closure() -> Cell:
    """Least insertions from state to state: single ones, combined until nothing changes."""
    found = {(p, p): [(0, "")] for p in STATES}
    for (p, initial), q in STEPS.items():
        if initial in "ua":
            found.setdefault((p, q), []).append((INSERT, "I"))
    cell = _cell(found)
    while (more := combine(cell, cell)) != cell:
        cell = more
    return cell


INSERTED = _closure()


@lru_cache(maxsize=64)
def row_cell(kind: str) -> Cell:
    """The cell of one row: x has to be deleted; s, u, a or o (no legal role), in capitals if truncated."""
    found = {(p, p): [(DELETE, "D")] for p in STATES}
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        for (p, initial), q in STEPS.items():
            if initial == kind.lower():
                found.setdefault((p, q), []).append((more, "K"))
            if initial in "ua":
                found.setdefault((p, q), []).append((RELABEL + more, "R"))
    return combine(combine(INSERTED, _cell(found)), INSERTED)


def _levels(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        pairs = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


@lru_cache(maxsize=1 << 16)
def _leaf(kinds: str) -> Cell:
    return _levels([row_cell(k) for k in kinds])


def span_cell(kinds: str) -> Cell:
    """The cell of a span of rows, bottom-up; short spans recur often and are remembered."""
    if not kinds:
        return INSERTED
    return _levels([_leaf(kinds[i : i + LEAF]) for i in range(0, len(kinds), LEAF)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) of the start symbols."""
    return min(x for x in (cell[0], cell[3]) if x is not None)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage that the query's contract fixes, by crc32(conv_id:turn) % 20, nulls as one space.

    0 drops the row (``times`` 0), 1 empties the text, 2 takes ``.!?`` out of it, 3 repeats the row (``times`` 2), 4 makes its
    role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    code = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("times"),
    )


def _prepared(rows: DataFrame) -> DataFrame:
    times = F.col("times").cast("long") if "times" in rows.columns else F.lit(1).cast("long")
    filled = rows.select(
        "conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), times.alias("times")
    )
    return filled.withColumn("digest", F.unhex(F.sha2("text", 256)))


def facts(rows: DataFrame) -> DataFrame:
    """One row per (conv_id, turn, role, digest): n copies, blank, truncated, and whether the first copy is no duplicate."""
    ended = F.rtrim("text", F.lit(SPACES))
    key = ["conv_id", "role", "digest"]
    flagged = _prepared(rows).select(
        *key, "turn", "times", (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("open")
    )
    counted = flagged.groupBy(*key, "turn").agg(
        F.sum("times").alias("n"), F.first("blank").alias("blank"), F.first("open").alias("open")
    )
    counted = written(counted, "rows")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # nulls first
    first = counted.where("n > 0").groupBy(*(F.col(c).alias(f"f_{c}") for c in key)).agg(F.min(turn).alias("first"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in key]
    joined = counted.join(first, same, "left")
    return joined.select("conv_id", "turn", "role", "digest", "n", "blank", "open", F.col("first.turn").eqNullSafe(F.col("turn")).alias("new"))


class _Stretch:
    """What a task adds up over the rows of one conversation, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.kinds = conv_id, []
        self.first = self.last = self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, n: int, blank: bool, open_: bool, new: bool) -> None:
        if not n:
            return
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1  # no role may follow itself
        self.last = initial
        if blank or not new:
            self.kinds.append("x" * n)
        else:
            kind = initial if initial in ("s", "u", "a") else "o"
            self.kinds.append((kind.upper() if open_ else kind) + "x" * (n - 1))
            self.truncated += open_
        if blank:
            self.blank += n
        else:
            self.duplicate += n - new

    def row(self) -> dict:
        cell = span_cell("".join(self.kinds))
        out = {c: getattr(self, c) for c in _STRETCH.names if hasattr(self, c)}
        return out | {"cost": [x and x[0] for x in cell], "audit": [x and x[1] for x in cell]}


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_STRETCH = pa.schema(
    [("first", pa.string()), ("last", pa.string())]
    + [(c, pa.int64()) for c in ("low", "high", "turns", *_COUNTS)]
    + [("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string()))]
)
_STRETCH_DDL = (
    "first string, last string, low long, high long, turns long, blank long, duplicate long, truncated long, "
    "illegal long, cost array<long>, audit array<string>"
)
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SUMMARY = [c.split()[0] for c in SUMMARY.split(", ")]
_ROWS_A_BATCH = 2000


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= _ROWS_A_BATCH:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _keyed(batches: Iterator[pa.RecordBatch], fields: list) -> tuple[Iterator[pa.RecordBatch], pa.Schema]:
    """The batches and a schema of conv_id, as they have it, and ``fields``; no batches have a conv_id of nulls."""
    first = next(batches, None)
    if first is None:
        return iter(()), pa.schema([("conv_id", pa.null()), *fields])
    return chain([first], batches), pa.schema([first.schema.field("conv_id"), *fields])


def _arrow(ddl: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return [(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))]


def stretches(rows: DataFrame) -> DataFrame:
    """One row per conversation and task: counts, borders and the span cell of the conversation's rows there."""
    order = ["conv_id", "turn", "role", "digest"]
    found = written(facts(rows), "facts")  # the range sort samples it first
    sorted_ = found.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def ended(stretch: _Stretch) -> dict:
            return {"conv_id": stretch.conv_id, "part": part} | stretch.row()

        def all_rows() -> Iterator[dict]:
            now = None
            for batch in batches:
                for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if now is None or conv_id != now.conv_id:
                        if now is not None:
                            yield ended(now)
                        now = _Stretch(conv_id)
                    now.add(*row)
            if now is not None:
                yield ended(now)

        batches, schema = _keyed(batches, [("part", pa.int64()), *_STRETCH])
        yield from _batches(all_rows(), schema)
        release()

    narrow = sorted_.select("conv_id", "turn", "role", "n", "blank", "open", "new")
    return narrow.mapInArrow(run, f"conv_id {dict(rows.dtypes)['conv_id']}, part long, {_STRETCH_DDL}")


def summaries(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text and, if need be, times): gaps in its turns, blank, duplicate and
    truncated rows, illegal neighbours, the cost of the cheapest repair and its audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(conv_id, spans: list[dict]) -> dict:
            out = {c: sum(s[c] for s in spans) for c in _COUNTS}
            real = [s for s in spans if s["last"] is not None]
            out["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(real, real[1:]))
            timed = [s for s in real if s["low"] is not None]
            turns = sum(s["turns"] for s in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
            out["gaps"] = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
            cells = [tuple(None if c is None else (c, a) for c, a in zip(s["cost"], s["audit"], strict=True)) for s in spans]
            out["cost"], out["audit"] = cheapest(_levels(cells))
            return {"conv_id": conv_id} | out

        def all_rows() -> Iterator[dict]:
            spans: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if spans and row["conv_id"] != spans[0]["conv_id"]:
                        yield ended(spans[0]["conv_id"], spans)
                        spans = []
                    spans.append(row)
            if spans:
                yield ended(spans[0]["conv_id"], spans)

        batches, schema = _keyed(batches, _arrow(SUMMARY))
        yield from _batches(all_rows(), schema)
        release()

    by_task = stretches(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return by_task.mapInArrow(run, f"conv_id {dict(rows.dtypes)['conv_id']}, {SUMMARY}")


class _Edits:
    """Applies an audit to the rows of a conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.place = audit, 0, 0, 0

    def _put(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.state = STEPS[self.state, role[0]]
        self.place += 1
        return self.place - 1, edit, role, text

    def inserted(self) -> Iterator[tuple[int, str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put("I", NEEDED[self.state], "")

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield self._put(edit, role if edit == "K" else NEEDED[self.state], text)


def _edited(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation its summary (head 0), then its rows in order, all in one partition."""
    heads = found.withColumn("head", F.lit(0))
    body = _prepared(rows).where("times > 0").withColumn("head", F.lit(1))
    both = heads.unionByName(body, allowMissingColumns=True)
    order = ["conv_id", "head", "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "head", *_SUMMARY, "role", "text", "times")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, tuple[int, str, str, str] | None]]:
    """(summary, repaired row) in order; after the last row of a conversation (summary, None)."""
    now: dict | None = None
    edits = _Edits("")
    for batch in batches:
        names = ["conv_id", "head", *_SUMMARY, "role"]
        columns = [batch.column(c).to_pylist() for c in names]
        for (conv_id, head, *summary, role), text, times in zip(
            zip(*columns, strict=True), texts(batch.column("text")), batch.column("times").to_pylist(), strict=True
        ):
            if head == 0:
                if now is not None:
                    for row in edits.inserted():
                        yield now, row
                    yield now, None
                now = {"conv_id": conv_id} | dict(zip(_SUMMARY, summary, strict=True))
                edits = _Edits(now["audit"])
            else:
                for _ in range(times):
                    for row in edits.row(role, text):
                        yield now, row
    if now is not None:
        for row in edits.inserted():
            yield now, row
        yield now, None


def repaired(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (K, R or I), role, text; deleted rows are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches, schema = _keyed(batches, _arrow("place long, edit string, role string, text string"))
        made = (
            {"conv_id": summary["conv_id"]} | dict(zip(("place", "edit", "role", "text"), row, strict=True))
            for summary, row in _walk(batches)
            if row is not None
        )
        yield from _batches(made, schema)
        release()

    found = written(summaries(rows), "summaries") if found is None else found
    kind = dict(rows.dtypes)["conv_id"]
    return _edited(rows, found).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def repair_digests(rows: DataFrame) -> DataFrame:
    """`summaries` and repaired_sha256: lowercase hex over the repaired rows as ``role:text``, joined by newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_rows() -> Iterator[dict]:
            digest = sha256()
            for summary, row in _walk(batches):
                if row is None:
                    yield summary | {"repaired_sha256": digest.hexdigest()}
                    digest = sha256()
                else:
                    place, _, role, text = row
                    digest.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())

        batches, schema = _keyed(batches, [*_arrow(SUMMARY), ("repaired_sha256", pa.string())])
        yield from _batches(all_rows(), schema)
        release()

    found = written(summaries(rows), "summaries")
    kind = dict(rows.dtypes)["conv_id"]
    return _edited(rows, found).mapInArrow(run, f"conv_id {kind}, {SUMMARY}, repaired_sha256 string")
