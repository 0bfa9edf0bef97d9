"""Licences, exact duplicates, toxicity, quality and line templates."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest

from tidegate.llm import exactdedup, licenses, quality, templates, toxicity
from tidegate.llm.queries import table
from tests.conftest import SF


def test_licences_count_every_place(documents):
    got = {
        r.doc_id: r
        for r in licenses.scan(
            documents(
                [
                    "Released under the MIT License. The mit-license; MITx license, mit. License",
                    "General Public License general public GNU Lesser General Public License",
                    "Licensed under CC BY-NC 4.0.",
                    None,
                    "license mit",
                    "Licensed under the Apache License, Version 2.0.",
                ]
            )
        ).collect()
    }
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word) == (12, 3, 3, 10)
    assert (got[0].base_labels, got[0].labels, got[0].score) == ("mit", "mit", 1.0)
    assert (got[1].n_base, got[1].base_labels, got[1].labels) == (2, "gpl", "gpl,lgpl")
    assert (got[2].n_base, got[2].base_labels, got[2].labels) == (0, "", "cc-by-nc")
    assert got[2].first_word is None and got[2].score == 1.0
    assert (got[3].n_words, got[3].labels, got[3].score) == (0, "", 0.0)
    assert got[4].n_places == 0
    assert (got[5].first_word, got[5].labels, got[5].score) == (3, "apache", 1.0)


def test_exact_keeps_longest_then_smallest(documents):
    texts = ["a b", "ab", "a  b", "x", None, "", "a  b", "A b"]
    got = {r.doc_id: r for r in exactdedup.exact_duplicates(documents(texts, 5)).collect()}
    assert [got[k].keep_id for k in range(8)] == [2, 2, 2, 3, 4, 4, 2, 7]
    assert [got[k].group_size for k in range(8)] == [4, 4, 4, 1, 2, 2, 4, 1]
    assert [got[k].kept for k in range(8)] == [False, False, True, True, True, False, False, True]
    assert got[0].text_sha256 == hashlib.sha256(b"ab").hexdigest()


def test_exact_with_one_text_almost_everywhere(documents):
    texts = ["same text"] * 500 + [f"own {k % 40}" for k in range(100)]
    rows = exactdedup.exact_duplicates(documents(texts, 40)).collect()
    assert sum(r.kept for r in rows) == 41
    assert {r.group_size for r in rows if r.doc_id < 500} == {500}


def test_exact_keeps_one_of_repeated_rows(awkward):
    rows = exactdedup.exact_duplicates(awkward).collect()
    assert len(rows) == 13
    assert sum(r.kept for r in rows if r.doc_id == 5) == 1


def toxic_corpus():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("ra", "sto", "lin", "me")]
    rows = []
    for k in range(900):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = k % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(["zounds", "knaves", "villain"]))
        rows.append((k, " ".join(text), int(toxic)))
    return rows


def test_toxicity_finds_held_out_documents(documents, labels):
    rows = toxic_corpus()
    got = toxicity.score(
        documents([(k, t) for k, t, _ in rows]), labels([(k, 1, x) for k, _, x in rows])
    ).collect()
    label = {k: x for k, _, x in rows}
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)


def test_toxicity_does_not_read_held_out_labels(documents, labels):
    rows = toxic_corpus()
    docs = documents([(k, t) for k, t, _ in rows], 1)
    held = lambda k: crc32(str(k).encode()) % 5 == 0
    one = labels([(k, 1, x) for k, _, x in rows])
    two = labels([(k, 1, 1 - x if held(k) else x) for k, _, x in rows])
    scores = [{r.doc_id: r.score for r in toxicity.score(docs, y).collect()} for y in (one, two)]
    assert scores[0] == scores[1]


def test_toxicity_of_awkward_and_unlabelled(awkward, labels, documents):
    some = labels([(1, 1, 0), (8, 1, 1), (8, 1, 1), (None, 1, 1), (5, None, None)])
    assert toxicity.score(awkward, some).count() == 13
    assert {r.score for r in toxicity.score(awkward, labels([])).collect()} == {0.0}
    assert toxicity.score(documents([]), some).count() == 0


def test_quality_keeps_good_and_draws_k(spark, documents, labels):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "el", "ion", "us", "er")]
    texts = []
    for k in range(600):
        text = rng.choices(words, k=rng.randint(3, 60))
        texts.append(" ".join(w.upper() + "!!" if k % 5 == 0 else w for w in text))
    known = labels([(k, int(k % 5 != 0), 0) for k in range(0, 600, 2)])
    docs = documents(texts)
    rows = quality.draw(docs, known).collect()
    assert sum(r.kept for r in rows if r.doc_id % 5) >= 0.99 * 480
    assert sum(r.kept for r in rows if r.doc_id % 5 == 0) <= 3
    assert quality.resample(docs, known).columns == docs.columns
    drawn = quality.draw(docs, known, k=100).collect()
    best = sorted(drawn, key=lambda r: (-r.gumbel_key, r.doc_id))[:100]
    assert {r.doc_id for r in drawn if r.kept} == {r.doc_id for r in best}
    assert {r.doc_id for r in quality.draw(docs, known, k=100).collect() if r.kept} == {
        r.doc_id for r in best
    }


def test_quality_without_labels_keeps_everything(awkward, labels, documents):
    assert quality.resample(awkward, labels([])).count() == 13
    assert quality.draw(documents([]), labels([(1, 1, 0)])).count() == 0


def test_exact_top_k_over_many_rows(spark):
    from tidegate.llm.frames import top_k_cut

    rows = spark.range(60_000).selectExpr("id AS doc_id", "CAST((id * 7919) % 5003 AS DOUBLE) AS x")
    order = sorted(((-((k * 7919) % 5003), k) for k in range(60_000)))
    for k in (1, 17, 30_000, 59_999):
        assert top_k_cut(rows, "x", "doc_id", k) == (float(-order[k - 1][0]), order[k - 1][1])
    assert top_k_cut(rows, "x", "doc_id", 60_000) is None


def brute_templates(texts, least=3, share=0.6):
    """Lines that go, by the rules on lists of words."""
    found = []
    for doc, text in texts.items():
        for k, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            words = ["<*>" if re.search("[0-9]", w) else w for w in words]
            if words:
                rest = words[4:]
                m = len(rest)
                cut = [[] for _ in range(8)]
                for j, w in enumerate(rest):
                    cut[j * 8 // m if m > 8 else j].append(w)
                found.append((doc, k, (len(words), tuple(words[:4])), [tuple(c) for c in cut]))
    support, template = defaultdict(set), defaultdict(set)
    for doc, _, leaf, cut in found:
        for j, c in enumerate(cut):
            support[leaf, j, c].add(doc)
    named = []
    for doc, k, leaf, cut in found:
        fixed = [c if c and len(support[leaf, j, c]) >= least else None for j, c in enumerate(cut)]
        words = sum(len(c) for c in fixed if c) + min(leaf[0], 4)
        if words >= share * leaf[0]:
            name = (leaf, tuple(fixed))
            template[name].add(doc)
            named.append((doc, k, name))
    return {
        (doc, k)
        for doc, k, name in named
        if len(template[name]) >= least and doc != min(template[name])
    }


def test_templates_like_brute_force(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {tuple(r) for r in templates.recurring_lines(docs).collect()}
    assert got == brute_templates(texts)
    assert got


def test_templates_generalise_fields(documents):
    texts = [f"own text {k} here\nposted by user at the hour {k}:30 in the forum\nbye {k}" for k in range(9)]
    texts += [f"all hail the great king {name} of the land" for name in ("Bob", "Eve", "Ann", "Joe")]
    texts += ["once upon a time", None, "", "\n\n"]
    docs = documents(texts)
    assert {tuple(r) for r in templates.recurring_lines(docs).collect()} == brute_templates(
        dict(enumerate(texts))
    )
    left = {r.doc_id: r.text for r in templates.drop_recurring(docs).collect()}
    assert left[0] == texts[0]  # what recurs stays once
    assert 10 not in left  # used up by the drops
    assert "posted by" not in left.get(5, "")
    assert left[14] is None and left[15] == "" and left[16] == "\n\n"
    figures = {r.doc_id: r for r in templates.digests(docs).collect()}
    assert len(figures) == len(texts) and figures[5].n_dropped >= 1


def test_lines_of_two_documents_go(documents):
    long = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    texts = [
        f"own beginning of one\n{long}",
        f"{long}\nanother ending here",
        "a short line\nfirst of them",
        "second of them\na short line",
        f"alone\n{long} but said at 9",
        f"single\n{long} but said at 10",
    ]
    left = {r.doc_id: r.text for r in templates.drop_recurring(documents(texts)).collect()}
    assert left[0] == texts[0] and left[2] == texts[2] and left[4] == texts[4]
    assert left[1] == "another ending here" and left[3] == "second of them"
    assert left[5] == "single"  # a long line's template needs two documents


def test_lines_without_constant_words_stay(documents):
    texts = [f"https://example.org/page/{k}" for k in range(4)]
    texts += [f"这是一个没有空格的段落其中有数字{k}而且很长很长很长很长" for k in range(4)]
    texts += [f"{k},{k + 1},{k + 2}" for k in range(4)]
    texts += [f"{k} {k + 1} {k + 2} {k + 3} {k + 4} {k + 5} sum" for k in range(4)]
    texts += [f"2024-01-0{k}" for k in range(1, 5)] + [f"own {k}\n{k} {k * k}" for k in range(4)]
    texts += ["the same text again"] * 3
    docs = documents(texts)
    left = {r.doc_id: r.text for r in templates.drop_recurring(docs, keep_unique=True).collect()}
    assert left == dict(enumerate(texts[:-2]))


def test_only_documents_that_others_hold_go(documents):
    kings = [f"all hail the great king {x} of the land" for x in ("Bob", "Eve", "Ann", "Eve")]
    texts = [*kings, f"{kings[1]}\nand more", f"{kings[0]}\n{kings[2]}"]
    left = {
        r.doc_id: r.text
        for r in templates.drop_recurring(documents(texts), keep_unique=True).collect()
    }
    assert left == {0: kings[0], 1: kings[1], 2: kings[2], 4: "and more"}


def test_templates_of_awkward_rows(awkward, documents):
    out = templates.drop_recurring(awkward)
    assert out.columns == awkward.columns
    assert out.count() == 13
    assert templates.digests(awkward).count() == 13
    assert templates.drop_recurring(documents([])).count() == 0


@pytest.mark.parametrize("scan", [licenses.scan, exactdedup.exact_duplicates])
def test_native_operators_on_awkward_and_empty(scan, awkward, documents):
    assert scan(awkward).count() == 13
    assert scan(documents([])).count() == 0
