"""Toxicity and quality against plain versions of their models, and every operator on odd labels."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from tidegate.llm import mixing, quality, tokenfiles, toxicity, vectors
from tidegate.llm.queries import QUERIES, table
from tests.conftest import SF

MASK = (1 << 64) - 1


def fold(doc_id):
    return crc32(str(doc_id).encode()) % 5


# toxicity ------------------------------------------------------------------------------------


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w.encode() for w in re.findall("[0-9a-z\x80-\U0010ffff]+", low)]


def plain_gains(docs, label):
    """Per document: the gain of each word, and what the word before adds, by the module's rules."""
    words = {k: plain_words(t) for k, t in docs.items()}
    pairs = {k: list(zip([None, *w], w, strict=False)) for k, w in words.items()}
    ways = defaultdict(set)
    for k in docs:
        for v, w in pairs[k]:
            ways[w].add(v)
    train = {k: c for k, c in label.items() if fold(k) not in (0, 4)}
    n = {
        c: [
            Counter(x for k, y in train.items() if y == c for x in {f(z) for z in items[k]})
            for items, f in ((words, lambda w: w[:5]), (words, lambda w: w), (pairs, lambda p: p))
        ]
        for c in (0, 1)
    }
    often = {w for c in (0, 1) for w, x in n[c][1].items() if x > 1}
    begun = Counter()
    for w in often:
        begun[w[:5]] += len(ways[w])
    log = {}
    for c in (0, 1):
        heads, single, double = n[c]

        def head(h, c=c, heads=heads):
            total = heads.total()
            return max(heads[h] - 1, 0) / total + len(heads) / total * begun[h] / begun.total()

        def word(w, c=c, single=single, head=head):
            total = single.total()
            back = len(single) / total * head(w[:5]) * len(ways[w]) / begun[w[:5]]
            return max(single[w] - 1, 0) / total + back

        held, kinds = Counter(), Counter()
        for (v, _), x in double.items():
            held[v] += x
            kinds[v] += 1

        def pair(v, w, word=word, double=double, held=held, kinds=kinds):
            if not held[v]:
                return word(w)
            return max(double[v, w] - 1, 0) / held[v] + kinds[v] / held[v] * word(w)

        def back(v, held=held, kinds=kinds):
            return kinds[v] / held[v] if held[v] else 1.0

        log[c] = (head, word, pair, back, len(single) / single.total())
    known = {p for c in (0, 1) for p, x in n[c][2].items() if x > 1}

    def gain(w):
        if w in often:
            return math.log(log[1][1](w) / log[0][1](w))
        if w[:5] not in begun:
            return 0.0
        return math.log(log[1][4] * log[1][0](w[:5]) / (log[0][4] * log[0][0](w[:5])))

    def added(v, w):
        if (v, w) in known:
            return math.log(log[1][2](v, w) / log[0][2](v, w)) - gain(w)
        return math.log(log[1][3](v) / log[0][3](v))

    return {k: ([gain(w) for w in words[k]], [added(*p) for p in pairs[k]]) for k in docs}


def stretch(gain, size):
    if not gain:
        return 0.0
    n = min(size, len(gain))
    return max(sum(gain[max(k - size, 0) : k]) / n for k in range(1, len(gain) + 1))


def toxic_texts(n=400):
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("a", "en", "o") for c in ("ra", "stolin", "mez")]
    docs, label = {}, {}
    for k in range(n):
        text = rng.choices(words, k=rng.randint(0, 30))
        if k % 4 == 0:
            text.insert(rng.randint(0, len(text)), rng.choice(["Zounds!", "zoundsmen", "Übel"]))
        docs[k], label[k] = " ".join(text), int(k % 4 == 0)
    docs[n], docs[n + 1] = None, ""
    return docs, label


def test_toxicity_like_the_plain_models(documents, labels):
    docs, label = toxic_texts()
    want = plain_gains(docs, label)
    known = labels([(k, 1, c) for k, c in label.items()])
    got = toxicity.score(documents(list(docs.items()), 5), known).collect()
    assert len(got) == len(docs)
    for r in got:
        single, added = want[r.doc_id]
        n = max(len(single), 1)
        shown = (sum(single) / n, stretch(single, 2), stretch(single, 8), sum(added) / n, stretch(added, 1))
        assert [r[name] for name in toxicity.NAMES] == pytest.approx(shown, abs=2e-5), r.doc_id


def test_toxicity_of_expressions_made_of_ordinary_words(documents, labels):
    """Both words are as frequent in ordinary documents; only their order tells."""
    rng = random.Random(2)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    docs, label = [], []
    for k in range(1200):
        text = rng.choices(words, k=rng.randint(10, 60))
        toxic = k % 4 == 0
        places = rng.sample(range(len(text) - 1), 2)
        if toxic:
            text[places[0] : places[0] + 2] = ["green", "ladder"]
        else:
            text[places[0]], text[places[1]] = "ladder", "green"
            text = [w for i, w in enumerate(text) if not (w == "ladder" and i and text[i - 1] == "green")]
        docs.append(" ".join(text))
        label.append((k, 1, int(toxic)))
    rows = toxicity.score(documents(docs), labels(label)).where("held_out").collect()
    toxic = [r for r in rows if r.doc_id % 4 == 0]
    other = [r for r in rows if r.doc_id % 4]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in other) <= 0.05 * len(other)


def test_continuations_count_distinct_pairs(documents, monkeypatch):
    monkeypatch.setattr(toxicity, "FLUSH", 40)  # a task passes pairs on several times
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30))) for _ in range(200)]
    ways = defaultdict(set)
    for t in texts:
        for v, w in zip([None, *t.split()], t.split(), strict=False):
            ways[w].add(v)
    data = np.frombuffer(b"ace", np.uint8)
    known = np.sort(toxicity.span_hashes(data, np.arange(3), np.arange(1, 4)))
    got = toxicity.continuations(documents(texts, 3), known).collect()
    assert sorted(r.n for r in got) == sorted(len(ways[w]) for w in "ace")


# quality -------------------------------------------------------------------------------------


def mixed(x):
    x &= MASK
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_features(text):
    """Places of words and marks, and of pairs of them."""
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D]+", (text or "").encode())
    multiplier = 0x9E3779B97F4A7C15 | 5
    hashes = [mixed(sum((b + 1) * pow(multiplier, k, 1 << 64) for k, b in enumerate(w))) for w in found]
    pairs = [
        mixed(a * 0x2545F4914F6CDD1D + b) for a, b in zip(hashes, hashes[1:], strict=False)
    ]
    return [h >> 48 for h in hashes + pairs]


def plain_weights(docs, good):
    """Log weights of documents {doc_id: text} by labels {doc_id: 1}."""
    places = {k: plain_features(t) for k, t in docs.items()}
    raw = np.zeros(1 << 16)
    counts = np.zeros((2, 1 << 16))
    for k, found in places.items():
        for x in found:
            raw[x] += 1
            if k in good:
                counts[int(fold(k) == 4), x] += 1
    raw = (raw + 0.5) / (raw + 0.5).sum()
    best = None
    for prior in (1e2, 1e3, 1e4, 1e5, 1e6):
        target = (counts[0] + prior * raw) / (counts[0].sum() + prior)
        likelihood = float(counts[1] @ np.log(target))
        if best is None or likelihood > best[0]:
            best = (likelihood, np.log(target / raw))
    return {k: sum(best[1][x] for x in found) for k, found in places.items()}


def test_quality_like_the_plain_models(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    label = {r.doc_id: r.quality for r in known.collect()}
    want = plain_weights(texts, {k for k, y in label.items() if y == 1})
    rows = {r.doc_id: r for r in quality.draw(docs, known).collect()}
    assert rows.keys() == texts.keys()
    for k, r in rows.items():
        assert r.log_weight == pytest.approx(want[k], rel=1e-6, abs=1e-6)
    judges = [k for k in label if k in texts and fold(k) == 4]
    cut = quality.best_cut(np.array([want[k] for k in judges]), np.array([label[k] for k in judges]))
    size = sum(w >= cut for w in want.values())
    best = sorted(rows.values(), key=lambda r: (-r.gumbel_key, r.doc_id))[:size]
    assert {r.doc_id for r in best} == {r.doc_id for r in rows.values() if r.kept}


BLANK = [(k, t) for k, t in enumerate([None, "", " ", "\n\t", None, "   "])]


def test_blank_slices(documents, labels, awkward):
    """A slice without any feature; repeated, missing and blank rows among labelled ones."""
    known = labels([(1, 1, 0), (2, 0, 1), (6, 1, 1), (8, 0, 0), (None, 1, 1), (5, None, None)])
    blank = {r.doc_id: r for r in quality.draw(documents(BLANK, 3), known).collect()}
    assert {r.log_weight for r in blank.values()} == {0.0}
    assert {r.n_features for r in blank.values()} == {0}
    rows = quality.draw(awkward, known).collect()
    assert len(rows) == 13
    assert all(r.log_weight == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert len({(r.log_weight, r.kept) for r in rows if r.doc_id == 5}) == 1
    assert toxicity.score(documents(BLANK, 3), known).count() == len(BLANK)


def written(spark, folder, docs, known):
    docs.write.parquet(f"{folder}/documents.parquet")
    known.write.parquet(f"{folder}/labels.parquet")
    vectors_ = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    vectors_.write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


QUERY_NAMES = [name for name in QUERIES if name.startswith("op")]


@pytest.mark.parametrize("kind", ["awkward", "blank", "empty"])
def test_every_query_and_the_pipeline(spark, tmp_path, awkward, documents, labels, kind):
    docs = {"awkward": awkward, "blank": documents(BLANK, 3), "empty": documents([])}[kind]
    known = labels([(1, 1, 0), (2, 0, 1), (5, 1, 0), (6, 1, 1), (8, 0, 0), (4, 1, 0), (None, 1, 1)])
    sf = written(spark, tmp_path, docs, known)
    n = docs.count()
    for name in QUERY_NAMES:
        rows = QUERIES[name](spark, sf).collect()
        if name not in ("op2_exact_dedup", "op7_near_vectors", "op10_soft_mixing", "op11_adaptive_scan"):
            assert len(rows) == n, name
    out = corpus_pipeline.run(spark, sf).collect()
    assert all(r.same for r in out)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    kept = {r.doc_id for r in out}
    assert kept <= set(texts)
    if kind == "blank":
        assert kept == set(texts)  # nothing says that a blank text is bad or that two are alike


# faults that were found ------------------------------------------------------------------------


@pytest.mark.parametrize("vocabulary", [65_536, 70_001, 300_000])
def test_shards_of_large_vocabularies(vocabulary):
    rng = random.Random(vocabulary)
    ids = [rng.choice([5, 464, 65_535, vocabulary - 1, vocabulary // 2]) for _ in range(3000)]
    lengths = np.array([1000, 0, 2000])
    shard = tokenfiles.Shard(tokenfiles.compress(np.array(ids), lengths, vocabulary))
    assert shard.ids().tolist() == ids
    assert shard.range(2, 17, 900).tolist() == ids[1017:1900]
    assert len(shard.symbols) < len(ids) or vocabulary == 65_536  # no symbol is left for a rule
    with pytest.raises(ValueError):
        tokenfiles.compress(np.array([vocabulary]), np.array([1]), vocabulary)


def test_links_of_repeated_vector_ids(spark):
    rows = [(1, [1, 0, 0, 0]), (1, [0, 1, 0, 0]), (2, [0.999, 0.01, 0, 0]), (3, [0, 0, 1, 0])]
    rows += [(9, [0, 1, 0.01, 0]), (3, [0, 0, 1, 0])]
    rows = [(k, list(map(float, v))) for k, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vectors.near_vectors(df).collect()))
    assert got == [
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False),
        (3, 1, 3, True), (3, 1, 3, True), (9, 1, 1, False),
    ]


def test_domains_without_labels_are_left_out(spark, labels, caplog):
    words = {"en": "the of and", "fr": "le la les", "de": "der die das", "es": "el los las"}
    rows = [
        (k, " ".join(random.Random(k).choices(words[d].split(), k=20)), d, "s", 0)
        for k, d in enumerate(["en", "fr", "de", "es"] * 100)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    known = labels([(k, 1, 0) for k, _, d, _, _ in rows if d != "es" and k % 2 == 0 or d == "fr"])
    targets = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
    got = mixing.rates(docs.where("lang <> 'es'"), known, targets).collect()
    assert "es" in caplog.text
    assert {r.p_es for r in got} == {0.0}
    total = sum(r.rate * r.n_words for r in got)
    shares = [sum(r.rate * r.n_words * r[f"p_{d}"] for r in got) / total for d in ("en", "fr", "de")]
    assert shares == pytest.approx([5 / 9, 2 / 9, 2 / 9], abs=0.01)


def test_posteriors_like_the_plain_classifier(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    names = sorted(mixing.TARGETS)

    def words(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    counts = {d: Counter() for d in names}
    for k in {r.doc_id for r in known.collect() if r.quality is not None}:
        if k in rows and rows[k].lang in counts:
            counts[rows[k].lang].update(words(rows[k].text))
    kinds = len(set().union(*counts.values()))
    total = {d: c.total() for d, c in counts.items()}
    for r in mixing.rates(docs, known).collect():
        found = [w for w in words(rows[r.doc_id].text) if any(w in c for c in counts.values())]
        score = []
        for d in names:
            logs = [math.log((counts[d][w] + 1) / (total[d] + kinds)) for w in found]
            mean = sum(logs) / len(logs) if logs else 0.0
            score.append(2 * mean + math.log(total[d] / sum(total.values())))
        raised = np.exp(np.array(score) - max(score))
        assert [r[f"p_{d}"] for d in names] == pytest.approx(raised / raised.sum(), abs=1e-9)
