"""Brute-force versions of the operators, for small inputs."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "a long text of words " * 3000
PASSAGE = "this passage of well over fifty bytes stands in several of the documents, é included"
DOCS = [
    (1, f"first {PASSAGE} and more words here so that it passes", "en", "s1", 1),
    (2, f"second {PASSAGE} with an end of its own that differs from all", "en", "s1", 1),
    (2, f"second {PASSAGE} with an end of its own that differs from all", "en", "s1", 1),
    (3, None, "de", "s2", 1),
    (4, "", None, None, None),
    (5, "   \t\n", "en", None, 1),
    (6, LONG, "en", "s3", 1),
    (7, LONG + " end", "en", "s3", 1),
    (None, f"no id {PASSAGE}", "en", "s1", 1),
    (8, "one two", "en", "s2", 1),
    (9, "One TWO", "en", "s2", 1),
    (10, "漢字 😀 text with\x1cother\x85spaces aaaa aaaa aaaa", "ja", "s4", 1),
    (11, "\n".join(["same line here"] * 6 + ["other # line", ""]), "en", "s4", 1),
]


def fingerprint(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """{doc_id: (fingerprint, component)} of (doc_id, text) rows with ids."""
    fps = {i: fingerprint(t) for i, t in rows}
    distinct = list(set(fps.values()))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    first = {}
    for i, f in fps.items():
        first[find(f)] = min(first.get(find(f), i), i)
    return {i: (f"{f:016x}", first[find(f)]) for i, f in fps.items()}


def without_repeats(rows, least=50):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for p in range(len(data) - least + 1):
                w = data[p : p + least]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        if i is not None:
            for p in range(len(data) - least + 1):
                if first[data[p : p + least]] < i:
                    gone[p : p + least] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 5000 else None
    if often is None:
        from collections import Counter

        often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )
