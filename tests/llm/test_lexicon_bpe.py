import hashlib
import random

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import lexicon_bpe as lb
from lakeops.llm.queries import QUERIES

PATH = public.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def wanted(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def encoder(words):
    v = lb.vocabulary(PATH)
    words = sorted({w.encode() for w in words})
    return lb.Encoder(v, lb.Lexicon(np.frombuffer(lb.flat(words, [v.merge(w) for w in words]), np.uint8)))


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(alphabet="ab ä漢\n!1'ts😀<|endoftext|>", max_size=60), max_size=6),
    st.lists(st.text(alphabet="ab ä1's", min_size=1, max_size=5), max_size=8),
)
def test_any_lexicon_gives_the_ids_of_the_library(texts, words):
    texts += ["a<|endoftext|>b <|endoftext|><|endoftext|>", "  <|endoftext|>  x"]
    got = encoder(words).encode(texts)
    assert [ids(x) for x in got] == [wanted(x) for x in texts]
    for x, data in zip(texts, got, strict=True):
        assert lb.vocabulary(PATH).decode(np.frombuffer(data, "<u4")).decode() == x
        assert LIBRARY.decode(ids(data), skip_special_tokens=False) == x


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6) | st.text("ab", min_size=1, max_size=7).map(str.encode), max_size=40))
def test_automaton_knows_its_words_and_is_minimal(words):
    words = sorted(words)
    arcs, final = lb.compile_words(words)
    lexicon = lb.Lexicon(np.frombuffer(lb.flat(words, [[i, i + 1] for i in range(len(words))]), np.uint8))
    assert lexicon.places(words).tolist() == list(range(len(words)))
    assert [ids(x) for x in lexicon.outputs(words)] == [[i, i + 1] for i in range(len(words))]
    others = {w + b"a" for w in words} | {w[:-1] for w in words} | {b"", b"\0", b"zz" * 50}
    others = sorted(others - set(words))
    assert lexicon.places(others).tolist() == [-1] * len(others)

    def futures(state):
        """The set of words that lead from a state to an end."""
        return frozenset(
            ({b""} if final[state] else set()) | {bytes([b]) + w for b, t in arcs[state].items() for w in futures(t)}
        )

    reached, todo = set(), [0]
    while todo:
        if (s := todo.pop()) not in reached:
            reached.add(s)
            todo += arcs[s].values()
    assert len({futures(s) for s in reached}) == len(reached) == max(1, len(lexicon.final))


def test_all_code_points_are_cut_as_the_library_does():
    v = lb.vocabulary(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    sure = [c for c in points if not v.unsure.search(c)]
    assert len(sure) > 100_000
    for x in range(0, len(sure), 4096):
        text = "".join(f"a{c}1{c}!{c} {c}\n" for c in sure[x : x + 4096])
        assert v.words(text) == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
    rest = [c for c in points if v.unsure.search(c)][::997]
    for c in rest:
        text = f"a{c}1{c}!{c} {c}\n"
        assert [ids(x) for x in encoder(["a", " "]).encode([text])] == [wanted(text)]


def test_long_words():
    rng = random.Random(1)
    texts = ["a" * 4001, "ab" * 2000, "=" * 999, "abcabcab" * 300, "".join(rng.choices("aeiou", k=5000))]
    assert [ids(x) for x in encoder(["aeiou"]).encode(texts)] == [wanted(x) for x in texts]


def check(coded):
    for r in coded.collect():
        want = wanted(r["text"] or "")
        assert ids(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_documents(spark, documents, odd):
    made = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    for docs in (documents, odd):
        coded = lb.encode(docs, PATH, docs.columns, made, most_words=500)
        check(coded)
        for r in lb.decode(coded, PATH, ["text"]).collect():
            assert r["decoded"] == (r["text"] or "")
    assert lb.encode(odd.limit(0), PATH, ["doc_id"]).count() == 0


def test_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    (row,) = lb.encode(docs, PATH, ["doc_id"], ("ids", "decoded")).collect()
    assert ids(row["ids"]) == wanted("a�b") and row["decoded"] == "a�b"


@pytest.mark.parametrize("most", [1, 7, 100])
def test_frequent_words_are_bounded_and_above_all_others(spark, documents, most):
    counted = lb.count_words(documents, PATH)
    every = {bytes(r["word"]): r["n"] for r in counted.collect()}
    brute = {}
    for r in documents.select("text").collect():
        for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(r["text"] or ""):
            brute[w] = brute.get(w := r["text"][a:b].encode(), 0) + 1
    assert {w: n for w, n in every.items() if w != b"<|endoftext|>"} == brute
    got = {bytes(r["word"]): r["n"] for r in lb.frequent(counted, most).collect()}
    assert len(got) <= most
    rest = [n for w, n in every.items() if w not in got and len(w) <= lb.LONGEST]
    assert not got or min(got.values()) >= max(rest)


def test_query(spark):
    from .conftest import SF

    out = QUERIES["op13_lexicon_bpe"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    check_ids = {r["doc_id"]: r for r in out.collect()}
    assert len(check_ids) == docs.count()
    for r in docs.collect():
        want = wanted(r["text"] or "")
        got = check_ids[r["doc_id"]]
        assert got["n_tokens"] == len(want)
        assert got["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert out.where(F.col("n_tokens") > 0).count() > 100
