import html
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import bitsliced, html_text, licences, queries
from lakeops.llm.html_pages import PAGES

SF = "/root/testdata/sf0.001"


def brute_top(rows, k=10):
    """Every row is a candidate of all others; rows of one id are rows of their own."""
    held = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, p) in enumerate(held):
        if i % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(p, q)), j) for m, (j, q) in enumerate(held) if m != n]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.op3_exact_topk(spark, SF).collect())
    assert got == brute_top([(r["vec_id"], r["embedding"]) for r in v.collect()])


def test_top_k_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.choice([-2.5, 0.0, 0.5, 3.0], 5)]) for i in range(300)]
    rows += [(i, [1.0] * 5) for i in range(300, 360)]  # ties
    rows += [(100, [9.0]), (200, rows[200][1]), (400, []), (401, None), (402, [None, 1.0]), (403, [float("nan")]),
             (None, [1.0]), (404, [float("inf")]), (500, [1e5, -1e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS q")
    got = sorted(tuple(r) for r in bitsliced.top_k(df).collect())
    assert got == brute_top(rows)
    assert bitsliced.top_k(df.limit(0)).count() == 0


def test_rows_of_one_id_are_candidates_and_queries(spark):
    import duckdb

    rows = [(100, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [0.7, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 2.0])]
    rows += [(1, [9.0, 0.0])] * 12 + [(200, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in bitsliced.top_k(df).collect())
    assert got == brute_top(rows) and (100, 1, 1, 9216 * 1024) in got
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    sql = con.sql(queries.ORACLE_SQL["op3_exact_topk"])
    assert got == sorted(tuple(r) for r in sql.select("query_id, rank, vec_id, score").fetchall())


def test_scores_are_exact_or_refused(spark):
    ddl = "vec_id long, embedding array<double>"
    big = 2.0**40  # components of 2^50: products of 2^100 that cancel
    rows = [(100, [big, big, 1.0]), (1, [big, -big, 3.0]), (2, [-big, big, 5.0]), (3, [0.0, 0.0, 4.0])]
    got = sorted(tuple(r) for r in bitsliced.top_k(spark.createDataFrame(rows, ddl)).collect())
    assert got == [(100, r + 1, i, x << 20) for r, (i, x) in enumerate([(2, 5), (3, 4), (1, 3)])]
    for bad in ([(100, [3e9]), (1, [3e9])], [(100, [1.0]), (1, [1e300])]):
        with pytest.raises(Exception, match="beyond 64 bits"):
            bitsliced.top_k(spark.createDataFrame(bad, ddl)).collect()


def test_sums_are_weighted_sums():
    rng = np.random.default_rng(5)
    values = rng.integers(-1000, 1000, (130, 6))
    index = bitsliced.Slices.build(np.arange(130), values)
    assert (index.values(np.arange(130)) == values).all()
    for n in (-1000, -7, 0, 5, 1023):
        assert sum(d << p for p, d in bitsliced.signed_digits(n)) == n


def test_model_fits_its_labelled_pages():
    model = html_text.trained()
    wrong = total = 0
    for page in PAGES:
        nodes, _ = html_text.parse(page)
        marginal, _ = model.marginals(nodes)
        for node, p in zip(nodes, marginal):
            total += node.chars > 0
            wrong += node.chars > 0 and (p > 0.5) != node.main
    assert wrong <= 0.03 * total


def test_marginals_equal_enumeration():
    model = html_text.trained()
    nodes, _ = html_text.parse("<body><div class=menu><p>A b</p></div><article><p>Some text, here.</p></article></body>")
    marginal, _ = model.marginals(nodes)
    total, ones = 0.0, np.zeros(len(nodes))
    for bits in range(1 << len(nodes)):
        y = [bits >> i & 1 for i in range(len(nodes))]
        w = sum(model.unary.get(f, 0.0) for i, n in enumerate(nodes) if y[i] for f in html_text.features(n))
        w += sum(model.bonds[html_text._bond(n, model.words)][y[n.parent]][y[i]] for i, n in enumerate(nodes) if i)
        total += np.exp(w)
        ones += np.exp(w) * np.array(y)
    assert np.allclose(ones / total, marginal, atol=1e-9)


def article(page):
    page = re.sub(r"<script.*?</script>", "", page, flags=re.S)
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_pages_give_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op5_html_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>Deep down, a sentence that is long enough to read.</p>"
    rows = [(1, None), (2, ""), (3, "<p"), (4, "a < b"), (5, deep), (6, "</p></div><p class='x>"), (1, None), (7, "<script>x")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'u' AS url", "'t' AS text", "1 AS n_chars")
    got = html_text.extract(df, df.columns).collect()
    assert len(got) == len(rows)
    assert {r["text"] for r in got if r["page_id"] in (1, 2, 7)} == {""}
    assert html_text.extract(df.limit(0), ["page_id"]).count() == 0


def brute_cosines(templates, piece):
    """{name: best cosine} of a lower-case piece of text, over plain dictionaries."""
    bags = [(name, Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", t.lower()))) for name, t in templates]
    bag = Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", piece))
    held = Counter(w for _, b in bags for w in b)
    idf = {w: math.log((1 + len(bags)) / (1 + held[w])) + 1 for w in set(held) | set(bag)}
    length = lambda b: math.sqrt(sum((n * idf[w]) ** 2 for w, n in b.items()))
    out = {}
    for name, b in bags:
        dot = sum(n * idf[w] * b[w] * idf[w] for w, n in bag.items() if w in b)
        out[name] = max(out.get(name, 0), dot / (length(bag) * length(b)) if bag else 0)
    return out


def brute_licence(text, threshold=0.8):
    """Every line, sentence and block and the whole text against every template."""

    def best(templates, pieces):
        top = None
        for piece in dict.fromkeys(pieces):
            found = brute_cosines(templates, piece)
            cosine = max(found.values())
            if cosine >= threshold and (top is None or cosine > top[0] + 1e-9):
                top = cosine, min(n for n, c in found.items() if c >= cosine - 1e-9)
        return top

    low = text.lower()
    if whole := best(licences.licence_texts(), [low]):
        return whole[1]
    lines, blocks = low.split("\n"), [[]]
    for x in lines:
        if re.fullmatch(r"[ \t\r]*(?:[#*;%!\-]+|//+|/\*+|\*+/|<!--|-->)?[ \t\r]*", x):
            blocks.append([])
        else:
            blocks[-1].append(x)
    line = best(licences.TEMPLATES, [p for x in lines for p in (x, *re.split(r"(?<=[a-z)][.;:])[ \t]+", x))])
    block = best(licences.BLOCKS, ["\n".join(b) for b in blocks])
    found = block if block and (not line or block[0] > line[0] or line[1] == "Proprietary") else line
    return found and found[1]


def brute_headers(text, threshold=0.8):
    return brute_licence(text or "", threshold)


def test_skipping_lines_is_exact_and_headers_are_found(spark):
    lines = [t for _, t in licences.TEMPLATES] + ["mit dem Hund", "a licensed thing", "version 3", "the MIT License"]
    texts = [f"some text\n{x}\nmore" for x in lines] + ["", None, "plain\n\n"]
    df = spark.createDataFrame([(f"d/{i}.txt", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r["path"]: r["own_licence"] for r in licences.headers(df, ["path"]).collect()}
    assert got == {f"d/{i}.txt": brute_headers(t) for i, t in enumerate(texts)}
    for i, (name, _) in enumerate(licences.TEMPLATES):
        assert got[f"d/{i}.txt"] == name


def test_scan_equals_brute_force_on_planted_and_odd_rows(spark, odd):
    rng = random.Random(8)
    words = "the code is free to use and may not be sold under terms of any other license copyright 2020 foo inc version 2".split()
    notices = [t for _, t in licences.TEMPLATES + licences.BLOCKS]
    whole = [t for _, t in licences.licence_texts() if len(t) < 2000]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            notice = rng.choice(notices).split()
            for _ in range(rng.randrange(3)):
                notice.insert(rng.randrange(len(notice) + 1), rng.choice(words))
            parts.append(rng.choice([" ".join(notice), " ".join(rng.choices(words, k=9)), "\n", "# ", "//", "* x", ""]))
        texts.append("\n".join(parts))
    texts += [w + "\n\n" + "code = 1\n" * rng.randrange(60) for w in whole] + ["license " * 5000, "İ MIT License", "\n\n#\nMIT License"]
    plain = spark.createDataFrame([(t,) for t in texts], "text string")
    for df in (plain, odd.where("coalesce(length(text), 0) < 5000").select("text")):
        for r in licences.headers(df, ["text"]).collect():
            assert r["own_licence"] == brute_licence(r["text"] or "")


def test_notices_of_many_licences():
    scan = licences.Scan(licences.TEMPLATES, 0.8, licences.BLOCKS, licences.licence_texts())
    for line, name in (
        ("Licensed under the MIT license", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT OR Apache-2.0"), ("SPDX-License-Identifier: ISC", "ISC"),
        ("Copyright (c) 2020 Foo Inc. All rights reserved.", "Proprietary"),
        ("Use of this source code is governed by a BSD-style license", "BSD-3-Clause"),
        ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("Eclipse Public License - v 2.0", "EPL-2.0"),
    ):
        assert scan.licence(f"x = 1\n\n{line}\n\ny = 2")[1] == name
    assert scan.licence("Copyright (c) 2020 Foo Inc.") is None and scan.licence("the license may be the source of the work") is None


def test_long_texts_and_bad_bytes_have_licences(spark):
    long = "SELECT 1 AS i, concat(repeat('a line of words\n', 100000), 'Released under the MIT License.\n') AS text"
    bad = "SELECT 2, concat('Released under the MIT License.\n', CAST(X'FF' AS STRING))"
    got = licences.headers(spark.sql(f"{long} UNION ALL {bad}"), ["i"]).collect()
    assert [r["own_licence"] for r in got] == ["MIT", "MIT"]


def test_nearest_ancestor_decides(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [
        ("LICENSE", mit), ("a/x.py", "code"), ("a/b/LICENSE.txt", apache), ("a/b/c/y.py", "code"), ("a/bc/z.py", None),
        ("a/b/COPYING", mit), ("top.py", ""), (None, "code"), ("a/own.py", f"x\n{apache}"), ("a/x.py", "code"),
    ]
    df = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "1 AS g", "2 AS directory", "3 AS licence")
    found = licences.headers(df, df.columns)
    got = {r["path"]: (r["licence"], r["licence_from"]) for r in licences.inherit(found).collect()}
    assert got["a/x.py"] == got["top.py"] == got["a/bc/z.py"] == ("MIT", "LICENSE")
    assert got["a/b/c/y.py"] == ("MIT", "a/b/COPYING")
    assert got["a/own.py"] == ("Apache-2.0", None) and got[None] == (None, None)
    assert licences.inherit(licences.headers(df.limit(0), ["path"])).count() == 0


def test_planted_licence_lines_are_found(spark):
    rows = queries.op10_license_scan(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    line = re.compile("^(Licensed under|Released under|This work is licensed|All rights reserved)", re.M)
    assert all((r["own_licence"] is not None) == bool(line.search(texts[r["doc_id"]])) for r in rows)
