"""Periodic runs against a plain search, words and digests against the rules as they are written."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.llm import periodic
from tidegate.llm.queries import op12_periodic_runs, table
from tests.conftest import SF


def plain_runs(words, least=12):
    """(start, end, period) of every run, by its definition."""
    best, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - start >= max(least, 2 * q):
                best.setdefault((start, k + q), q)
    return sorted((a, b, q) for (a, b), q in best.items())


def found(rows, least=12):
    """The library's runs of several texts at once, split by text."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    first = np.r_[0, np.cumsum([len(r) for r in rows])]
    codes = np.array([w for r in rows for w in r], np.int64)
    got = [[] for _ in rows]
    for a, b, q in zip(*periodic.runs(codes, row, least), strict=True):
        k = row[a]
        got[k].append((int(a - first[k]), int(b - first[k]), int(q)))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in got]


def check(rows, least=12):
    want = [sorted(plain_runs(r, least), key=lambda r: (r[0], r[2])) for r in rows]
    assert found(rows, least) == want


def repetitive(rng, n, kinds):
    words = []
    while len(words) < n:
        block = [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        words += block * rng.randint(1, 6)
        if rng.random() < 0.5:
            words += [rng.randrange(kinds) for _ in range(rng.randint(0, 4))]
    return words[:n]


@pytest.mark.parametrize("kinds", [1, 2, 3, 8, 200])
def test_random_texts(kinds):
    rng = random.Random(kinds)
    for _ in range(12):
        check([repetitive(rng, rng.randint(0, 220), kinds) for _ in range(rng.randint(1, 12))])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.integers(2, 14))
def test_any_texts_and_least_lengths(rows, least):
    check(rows, least)


def test_words_that_repeat_without_period():
    """Square-free words, Thue-Morse words and Fibonacci words, the hard cases of sums of hashes."""
    morse = [bin(k).count("1") % 2 for k in range(1024)]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    check([morse, fib[-1], [0] * 700, list(range(300)) * 2, [0, 1] * 100 + [0]])


def test_splitting_to_the_last_word():
    """Each round frees one more word; the scan finds the run that is left."""
    chain = [x for k in range(1, 200) for x in (k, k + 1)]
    check([chain + [500, 501] * 8 + chain[::-1]])


def test_hashes_that_lie_are_found_out(monkeypatch):
    rng = random.Random(5)
    rows = [repetitive(rng, 150, 3) for _ in range(4)]
    monkeypatch.setattr(periodic, "mix", lambda x: x % np.uint64(2))
    check(rows)


def plain(doc_id, text):
    """The contract, word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    if doc_id is not None and n:
        h = crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = sorted(plain_runs([numbers[w] for w in words]), key=lambda r: (r[0], r[2]))
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = [w for i, w in enumerate(words) if not any(a + q <= i < b for a, b, q in runs)]
    best = min(((a - b, a, q) for a, b, q in runs), default=None)
    row = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(kept))]
    return (doc_id, len(runs), *row, *sha)


def test_query_like_the_contract(spark, rows):
    documents = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows(op12_periodic_runs(spark, SF)) == sorted((plain(*d) for d in documents), key=repr)


def test_many_planted_and_awkward_texts(spark, documents, awkward, rows):
    rng = random.Random(8)
    texts = [(k, " \t".join(str(w) for w in repetitive(rng, rng.randint(0, 60), 4))) for k in range(300)]
    texts += [(k, r.text) for k, r in zip((300, 301, None), awkward.select("text").take(3), strict=True)]
    got = periodic.digests(periodic.periodic_runs(periodic.planted(documents(texts))))
    assert rows(got) == sorted((plain(*d) for d in texts), key=repr)
    short = awkward.where("doc_id IS NULL OR doc_id <> 4")
    got = periodic.digests(periodic.periodic_runs(periodic.planted(short)))
    assert rows(got) == sorted((plain(r.doc_id, r.text) for r in short.collect()), key=repr)
    long = periodic.periodic_runs(awkward.where("doc_id = 4")).first()
    assert [tuple(r) for r in long.runs] == [(0, 60_000, 977)]
    assert long.collapsed == " ".join(f"w{k}x" for k in range(977))


def test_empty_table(documents):
    assert periodic.digests(periodic.periodic_runs(periodic.planted(documents([])))).collect() == []
