import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.llm import conversation_repair as cr
from lakeops.llm.queries import QUERIES

from .conftest import SF

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def by_enumeration(kinds):
    """Least (cost, audit) over all edits with at most len + 2 insertions, by trying every one."""
    best = None
    options = []
    for k in kinds:
        mine = [(4, "D", "")]
        if k != "x":
            more = 3 * k.isupper()
            mine += [(more, "K", k.lower())] + [(3 + more, "R", r) for r in "ua"]
        options.append(mine)
    gaps = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*options):
        for put in itertools.product(gaps, repeat=len(kinds) + 1):
            cost = sum(c for c, _, _ in chosen) + 3 * sum(map(len, put))
            if best is not None and cost > best[0]:
                continue
            roles, audit = "".join(put[0]), "I" * len(put[0])
            for (_, letter, role), more in zip(chosen, put[1:], strict=True):
                roles, audit = roles + role + "".join(more), audit + letter + "I" * len(more)
            if LEGAL.match(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def from_left(kinds):
    """Least (cost, audit) by a left-to-right search over (state, edits), row by row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {"": (0, "")}

    def insertions(cells):
        for _ in range(4):
            for state, (cost, audit) in list(cells.items()):
                for role in "ua":
                    to = step.get((state, role))
                    if to is not None:
                        cells[to] = min(cells.get(to, (1 << 60, "")), (cost + 3, audit + "I"))
        return cells

    insertions(now)
    for k in kinds:
        new = {}

        def put(state, made):
            new[state] = min(new.get(state, (1 << 60, "")), made)

        for state, (cost, audit) in now.items():
            put(state, (cost + 4, audit + "D"))
            if k != "x":
                more = 3 * k.isupper()
                if (to := step.get((state, k.lower()))) is not None:
                    put(to, (cost + more, audit + "K"))
                for role in "ua":
                    if (to := step.get((state, role))) is not None:
                        put(to, (cost + 3 + more, audit + "R"))
        now = insertions(new)
    return min(now[s] for s in ("", "a") if s in now)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_cells_equal_enumeration(n):
    for kinds in map("".join, itertools.product("suaoxSUAO", repeat=n)):
        assert cr.cheapest(cr.span_cell(kinds)) == by_enumeration(kinds) == from_left(kinds)


def test_some_of_three_rows_equal_enumeration():
    for kinds in ("uua", "aau", "sUx", "ssu", "xau", "oAs", "usa"):
        assert cr.cheapest(cr.span_cell(kinds)) == by_enumeration(kinds)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="suaoxSUAO", max_size=60))
def test_cells_equal_search_from_the_left(kinds):
    assert cr.cheapest(cr.span_cell(kinds)) == from_left(kinds)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="suaxUA", max_size=20), st.integers(0, 20))
def test_every_split_of_a_span_gives_the_same_cell(kinds, cut):
    assert cr.combine(cr.span_cell(kinds[:cut]), cr.span_cell(kinds[cut:])) == cr.span_cell(kinds)


def damage(rows):
    """{conv_id: damaged rows in order} of (conv_id, turn, role, text) rows."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out[conv_id] += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute(rows):
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r[2])))
    seen, kinds, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not words:
            counts["blank"] += 1
            kind = "x"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            kind = "x"
        elif words[-1] not in ".!?":
            counts["truncated"] += 1
            kind = kind.upper()
        seen.add((role, text))
        kinds += kind
    cost, audit = from_left(kinds)
    left, out, made = iter(rows), [], ""
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if made[-1:] == "u" else "user"
        made += role[0]
        out.append((letter, role, text))
    assert LEGAL.match(made)
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    return counts | {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in out).encode()).hexdigest(),
    }, out


def compare(df, tables):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = damage(rows)
    got = {r["conv_id"]: r.asDict() for r in tables.collect()}
    assert set(got) == {r[0] for r in rows} and tables.count() == len(got)
    for conv_id, row in got.items():
        assert {c: v for c, v in row.items() if c != "conv_id"} == brute(want[conv_id])[0]
    return want


def odd_rows(seed=5):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "cut off", "", " \t", None, "What?  ", "a\nb.", "x." * 3000]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = [
        (rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), rng.choice(roles[:3] * 3 + roles), rng.choice(said))
        for _ in range(700)
    ]
    rows += [(1000, t, "ua"[t % 2] and ["user", "assistant"][t % 2], f"turn {t}.") for t in range(900)]  # a long one
    rows += [(1001, None, "user", "same.")] * 40 + [(1002, 5, "user", "same.")] * 40
    return rows


def test_query(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    out = QUERIES["op11_conversation_repair"](spark, SF)
    compare(df, out)
    assert out.select(F.sum("cost")).first()[0] > 0


@pytest.mark.parametrize("parts", ["1", "37"])
def test_odd_rows(spark, parts):
    """Nulls everywhere, ties, repeated rows, long conversations cut over tasks, clashing names."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string")
        for name in ("n", "digest", "head", "times", "part", "audit", "cost"):
            df = df.withColumn(name, F.lit(name))
        rows = cr.damaged(df)
        want = compare(df, cr.repair_digests(rows))
        got = defaultdict(list)
        for r in cr.repaired(rows).orderBy("place").collect():
            got[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
        for conv_id, one in want.items():
            assert got[conv_id] == brute(one)[1]
        if parts == "37":
            assert cr.stretches(rows).groupBy("conv_id").count().agg(F.max("count")).first()[0] > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_undamaged_rows_need_no_times(spark):
    df = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "assistant", "Ho.")], "conv_id string, turn int, role string, text string")
    (row,) = cr.repair_digests(df).collect()
    assert (row["cost"], row["audit"], row["gaps"], row["illegal"]) == (0, "KK", 0, 0)
    assert row["repaired_sha256"] == hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_digests(cr.damaged(df)).count() == 0 and cr.repaired(cr.damaged(df)).count() == 0
