import base64
import hashlib
import random

import numpy as np
import public_tokenizers as public
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import bpe, token_counts
from lakeops.llm.queries import SEPARATOR, VOCABULARY

PATH = public.path(VOCABULARY)


def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


ENCODING = library()


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab ä漢\n!1'ts😀", max_size=60), max_size=8))
def test_replay_equals_the_library(texts):
    t = bpe.Tokenizer.__new__(bpe.Tokenizer)
    t.__dict__.update(bpe.tokenizer(PATH, public.PATTERN).__dict__)
    t.known = {}
    assert [ids(x) for x in t.encode(texts)] == [ENCODING.encode_ordinary(x) for x in texts]


def test_long_words_and_overlapping_pairs():
    rng = random.Random(1)
    texts = ["a" * 4001, "ab" * 2000, "=" * 999, "abcabcab" * 300, "".join(rng.choices("aeiou", k=5000))]
    t = bpe.tokenizer(PATH, public.PATTERN)
    assert [ids(x) for x in t.encode(texts)] == [ENCODING.encode_ordinary(x) for x in texts]


def test_documents_round_trip(spark, documents, odd):
    for docs in (documents, odd):
        made = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
        coded = bpe.encode(docs, PATH, public.PATTERN, docs.columns, made)
        for r in coded.collect():
            want = ENCODING.encode_ordinary(r["text"] or "")
            assert ids(r["ids"]) == want and r["n_tokens"] == len(want)
            assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        for r in bpe.decode(coded, PATH, public.PATTERN, ["text"]).collect():
            assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.encode(odd.limit(0), PATH, public.PATTERN, ["doc_id"]).count() == 0


def test_token_files_are_counted(spark, documents, odd):
    for docs, block in ((documents, 1 << 10), (odd, 1 << 22), (odd, 2)):
        docs = docs if block > 2 else docs.where("length(text) < 200 OR text IS NULL")
        manifest = token_counts.write_token_files(docs, PATH, public.PATTERN, SEPARATOR)
        got = [tuple(r) for r in token_counts.document_tokens(manifest, SEPARATOR, block_bytes=block).collect()]
        want = [(r["doc_id"], len(ENCODING.encode_ordinary(r["text"] or ""))) for r in docs.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    empty = token_counts.write_token_files(odd.limit(0), PATH, public.PATTERN, SEPARATOR)
    assert token_counts.document_tokens(empty, SEPARATOR).count() == 0


def test_open_end_and_empty_documents(spark, tmpdir_path):
    tokens = np.array([7, 8, 9, 9, 1, 9, 5, 5, 5], "<u2")
    for name, data in (("a", tokens), ("b", tokens[:0]), ("c", tokens[:2])):
        data.tofile(f"{tmpdir_path}/{name}.bin")
    files = spark.createDataFrame(
        [(f"{tmpdir_path}/{n}.bin", s) for n, s in (("a", 18), ("b", 0), ("c", 4))], "file string, bytes long"
    )
    for block in (2, 4, 6, 64):
        got = sorted((r["file"][-5], r["ordinal"], r["n_tokens"]) for r in token_counts.count_tokens(files, 9, 2, block).collect())
        assert got == [("a", 0, 2), ("a", 1, 0), ("a", 2, 1), ("a", 3, 3), ("c", 0, 2)]


def test_token_files_of_bytes_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT 2, 'a\ufffdb'")
    manifest = token_counts.write_token_files(docs, PATH, public.PATTERN, SEPARATOR)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.document_tokens(manifest, SEPARATOR).collect()}
    assert got[1] == got[2] > 2
