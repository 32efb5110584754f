from collections import Counter
from zlib import crc32

import numpy as np

from lakeops.llm import mixing, quality_classifier, quality_rules, queries
from . import brute

SF = "/root/testdata/sf0.01"


def test_rule_counts_equal_brute_force(spark, documents, labels, odd):
    rules = quality_rules.fit_rules(documents, labels)
    for docs in (documents, odd):
        for r in quality_rules.apply_rules(docs, rules, docs.columns).collect():
            want = brute.rule_counts(r["text"])
            assert tuple(r[c] for c in quality_rules.COUNTS) == want
            assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r["base_failed"] and r["kept"])
    assert quality_rules.keep_by_rules(odd, rules).columns == odd.columns
    assert quality_rules.apply_rules(odd.limit(0), rules, ["doc_id"]).count() == 0


def test_rules_without_labels_leave_the_hard_rule(spark, documents, labels):
    rules = quality_rules.fit_rules(documents, labels.limit(0))
    rows = quality_rules.apply_rules(documents, rules, ["doc_id"]).collect()
    assert all(r["kept"] != r["base_failed"] for r in rows)


def test_forest_rejects_labelled_junk_and_keeps_good_rows(spark):
    rows = {r["doc_id"]: r for r in queries.op8_quality_rules(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [rows[x["doc_id"]] for x in labels if x["quality"] == 1]
    bad = [rows[x["doc_id"]] for x in labels if x["quality"] == 0]
    assert np.mean([r["kept"] or r["base_failed"] for r in good]) >= 0.99
    assert np.mean([r["kept"] for r in bad]) <= 0.1


def test_isolation_paths_are_shorter_for_outliers():
    rows = np.concatenate([np.random.default_rng(1).normal(0, 1, (500, 2)), [[9.0, 9.0]]])
    scores = quality_rules.IsolationForest(rows).score(rows)
    assert scores.argmax() == 500


def test_classifier_on_held_out_rows(spark):
    rows = queries.op2_quality_classifier(spark, SF).collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    labels = {x["doc_id"]: x["quality"] for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(tested) > 40 and np.mean([a == b for a, b in tested]) >= 0.95


def test_classifier_on_odd_rows(spark, odd, labels):
    model = quality_classifier.fit(odd, labels.limit(0))
    rows = quality_classifier.score(odd, model, odd.columns).collect()
    assert [r["score"] for r in rows] == [0.5] * len(rows)
    marked = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (6, 1), (2, None), (None, 1), (6, 1)], "doc_id long, quality int")
    model = quality_classifier.fit(odd, marked)
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(odd, model, ["doc_id"]).collect()}
    assert scores[3] == scores[4] and all(0 <= s <= 1 for s in scores.values())
    assert quality_classifier.score(odd.limit(0), model, ["doc_id"]).count() == 0


def best_sum(lengths, counts, budget):
    reach = {0}
    for length, n in zip(lengths, counts):
        reach = {s + k * length for s in reach for k in range(n + 1)}
    return max(s for s in reach if s <= budget)


def test_knapsack_is_the_best_subset():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 40, 5))
        counts = rng.integers(0, 5, len(lengths))
        budget = int(rng.integers(0, 200))
        taken = mixing.bounded_subset(lengths, counts, budget)
        assert (taken <= counts).all()
        assert int((taken * lengths).sum()) == best_sum(lengths.tolist(), counts.tolist(), budget)


def water_filling(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_mix_meets_its_targets(spark, documents, odd):
    more = spark.read.parquet(f"{SF}/documents.parquet")  # enough documents a source to meet any budget
    small = more.where("source <> 'src3' OR doc_id % 7 = 0")
    for docs in (documents, small, odd):
        rows = mixing.mix(docs).collect()
        assert len(rows) == docs.count()
        sizes, taken = {}, {}
        for r in rows:
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
            taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
            assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        want = water_filling(sizes)
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        if docs is small:
            assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(small)
    assert again.exceptAll(mixing.mix(small.repartition(7))).count() == 0
    assert mixing.mix(odd.limit(0)).count() == 0


def test_mixed_rows_are_the_copies(spark, odd):
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r["times"] for r in mixing.mix(odd).collect())


def test_mixed_deals_ties_over_equal_and_repeated_rows(spark, monkeypatch):
    """Equal rows, null ids and one text under ids and columns of its own; whole buckets and single rows."""
    rows = [(None, "w " * 5, "a", "x")] * 40 + [(7, "w " * 5, "a", str(i % 3)) for i in range(30)]
    rows += [(i, "v " * (i % 4), "b", "y") for i in range(200)] + [(None, "u " * 3, None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, draw string")
    for bucket in (mixing.BUCKET_ROWS, 3):
        monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
        want, taken = Counter(), Counter()
        planned = mixing.mix(docs).collect()
        assert len(planned) == len(rows)
        for r in planned:
            want[r["doc_id"], r["source"], r["size"]] += r["times"]
        got = mixing.mixed(docs)
        assert got.columns == docs.columns
        for r in got.collect():
            taken[r["doc_id"], r["source"], len(r["text"].split())] += 1
        assert taken == +want
        assert got.exceptAll(mixing.mixed(docs.repartition(5))).count() == 0
