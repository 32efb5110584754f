
from collections import Counter

import numpy as np

from lakeops.llm import html_text, licences, mixing, quality_classifier, quality_rules, simhash


def test_null_ids_of_many_sizes_get_all_their_copies(spark, monkeypatch):
    rows = [(None, "w " * n + tail, "a") for n in range(1, 21) for tail in ("x", "y", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    plan = [(None, "a", n + 1, n, times) for n in range(1, 21) for times in (1, 0, n % 2)]
    planned = spark.createDataFrame(plan, "doc_id long, source string, size long, n long, times long").coalesce(1)
    monkeypatch.setattr(mixing, "mix", lambda *_: planned)
    want = Counter()
    for _, _, size, _, times in plan:
        want[size] += times
    for bucket in (mixing.BUCKET_ROWS, 1):  # whole groups, and groups dealt into buckets
        monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
        assert Counter(len(r["text"].split()) for r in mixing.mixed(docs).collect()) == want


def test_long_documents_fill_the_budget():
    for length, n, budget, best in (
        (120_000, 6, 600_000, 600_000), (250_000, 4, 760_000, 750_000), (95_000, 2, 100_000, 95_000)
    ):
        taken = mixing.fit_lengths(np.array([length]), np.array([n]), budget)
        assert int(taken[0]) * length == best
    lengths, counts = np.array([70_000, 100_000]), np.array([3, 2])
    assert int((mixing.fit_lengths(lengths, counts, 200_000) * lengths).sum()) == 200_000
    many = np.arange(300_000, 320_000)  # too many lengths for dynamic programming over all of the budget
    taken = mixing.fit_lengths(many, np.ones(len(many), np.int64), 1_000_000)
    assert (taken <= 1).all() and 900_000 < int((taken * many).sum()) <= 1_000_000


def test_licence_texts_and_header_blocks_are_found():
    scan = licences.Scan(licences.TEMPLATES, 0.8, licences.BLOCKS, licences.licence_texts())
    whole = dict(licences.licence_texts())
    for name, text in whole.items():
        changed = text.replace("<year>", "2020").replace("<copyright holders>", "Foo Inc.").replace("<owner>", "Foo Inc.")
        assert scan.licence(changed)[1] == name and scan.licence(" ".join(changed.split()))[1] == name
    code = "\n\nimport os\n\n" + "\n".join(f"value{i} = other{i} + 1" for i in range(2000))
    for name in ("MIT", "GPL-3.0", "LGPL-2.1", "MPL-2.0"):  # a licence above code: its blocks tell
        for mark in ("", "# ", " * ", "// "):
            header = "\n".join((mark + x).rstrip() for x in whole[name].split("\n"))
            assert scan.licence(header + code)[1] == name
    for line, name in (
        ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("Apache License", "Apache-2.0"),
        ("This file is licensed under the MIT License.", "MIT"),
        ("    GNU GENERAL PUBLIC LICENSE\n       Version 2, June 1991", "GPL-2.0"),
    ):
        assert scan.licence(line + code)[1] == name
    assert scan.licence("Copyright (c) 2020 Foo" + code) is None


def test_classifier_sees_word_order_and_whole_long_words(monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"w{i}".encode() for i in range(12)]
    ordered = [b" ".join(words[i % 12] for i in range(k, k + 24)) for k in range(12)]
    shuffled = [b" ".join(rng.permutation(x.split()).tolist()) for x in ordered]
    model = quality_classifier.Model()
    bags = [quality_classifier.bag(x) for x in ordered + shuffled]
    model.train(bags, np.array([1] * 12 + [0] * 12), epochs=60)
    weights, bias = model.margins()
    scorer = quality_classifier.Scorer(weights.astype(float), bias)
    assert np.mean([scorer.score(x) for x in ordered]) > np.mean([scorer.score(x) for x in shuffled]) + 0.05
    want = [1 / (1 + np.exp(-(c / c.sum() @ weights[i] + bias))) for i, c in bags]
    assert np.allclose([scorer.score(x) for x in ordered + shuffled], want, atol=1e-5)
    monkeypatch.setattr(quality_classifier, "_PIECE", 5)
    again = quality_classifier.Scorer(weights.astype(float), bias)
    assert np.allclose([again.score(x) for x in ordered + shuffled], want, atol=1e-5)
    long = b"x" * 80 + b"abcdef" + b"y" * 80
    found = [b for part in quality_classifier.buckets(long) for b in part]
    assert len(found) == 1 + sum(len(long) + 2 - n + 1 for n in (3, 4, 5))


def test_open_heads_and_elements_do_not_swallow_the_page():
    def seen(page):
        return " ".join(text for _, text in html_text.parse(page)[1])

    assert seen("<html><head><title>T</title><meta charset=x><body><p>One.</p><p>Two.</p>") == "One. Two."
    assert seen("<head><title>T</title><article><p>One.</p></article>") == "One."
    assert seen("<head><script>a</script>Plain <b>text</b> only.") == "Plain text only."
    assert seen("<head><title>T</title><style>p</style></head><body><p>One.</p></body>") == "One."
    assert seen("<head>a" * 20_000) == "a" * 20_000
    for tag in ("noscript", "svg", "template"):
        assert seen(f"<body><div>A<{tag}><i>no</i></div><p>One.</p></body>") == "A One."
        assert seen(f"<body><{tag}><i>no</i><p>One.</p><p>Two.</p></body>") == "One. Two."
        assert seen(f"<body><p>A <{tag}>no</{tag}>B</p><{tag}>no<p>One.</p><{tag}>no</{tag}></body>") == "A B One."
    assert seen("<p>Let <math><mi>x</mi></math> be <object data=a>a thing</object> <svg/>here.") == "Let x be a thing here."


def test_each_forest_rejects_an_outlier_of_its_statistic():
    rng = np.random.default_rng(4)
    n = 1200
    words = rng.integers(100, 900, n)
    chars = (words * rng.uniform(4.5, 5.5, n)).astype(int)
    lines = words // 10
    some = [(x * rng.beta(1, 60, n)).astype(int) for x in (chars, lines, words, chars, words)]
    good = np.stack([words, chars, some[0], some[1], some[2] // 2, lines, some[3], some[4]], axis=1)
    junk = np.tile([500, 2500, 5, 0, 2, 50, 30, 3], (6, 1))
    for i, (column, value) in enumerate(((1, 15_000), (2, 1500), (3, 49), (4, 95), (6, 2400), (7, 450))):
        junk[i, column] = value
    counts = np.concatenate([good, junk // 2 * 2])
    for label in (np.r_[np.ones(n), np.zeros(6)], np.ones(n)):  # with labelled junk, and without any
        rules = quality_rules.Rules(counts[: len(label)], label.astype(int), 0.0005)
        rows = quality_rules.features(junk)
        for i, (columns, forest, threshold) in enumerate(rules.forests[:6]):
            assert columns == [i] and forest.score(rows[i : i + 1, columns])[0] > threshold
        assert rules.kept(good).mean() >= 0.99 and not rules.kept(junk).any()


def test_texts_of_a_repeated_id_are_judged_by_their_own_components(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (2, c), (5, c), (9, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [tuple(r) for r in simhash.without_near_duplicates(docs).collect()]
    assert Counter(got) == Counter([(5, a), (5, b), (2, c), (None, a)])
