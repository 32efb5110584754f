import numpy as np
import public_tokenizers

import corpus_pipeline
from lakeops.llm import bpe, mixing, quality_rules
from . import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_its_stages_by_brute_force(spark, documents, labels):
    rules = quality_rules.fit_rules(documents, labels)
    rows = {r["doc_id"]: r for r in documents.collect()}
    counts = np.array([quality_rules.statistics(r["text"]) for r in rows.values()])
    kept = [i for i, k in zip(rows, rules.kept(counts)) if k]
    found = brute.components([(i, rows[i]["text"]) for i in kept])
    firsts = [i for i, (_, c) in found.items() if c == i]
    rest = {r[0]: r for r in brute.without_repeats([(i, rows[i]["text"]) for i in firsts])}

    docs = documents
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents.columns
        sizes.append(sorted(r["doc_id"] for r in docs.select("doc_id").collect()))
    assert sizes == [sorted(kept), sorted(firsts), sorted(firsts)]
    removed = {r["doc_id"]: len(rows[r["doc_id"]]["text"].encode()) - len(r["text"].encode()) for r in docs.collect()}
    assert all(0 <= removed[i] - rest[i][2] <= 3 * 2 * rest[i][3] for i in removed)  # cut characters go too
    times = {r["doc_id"]: r["times"] for r in mixing.mix(docs).collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in times.items() if n}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    t = bpe.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for r in out:
        assert t.decode(bytes(r["ids"])).decode() == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) // 4


def test_stages_take_odd_and_empty_tables(spark, odd):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.count()
