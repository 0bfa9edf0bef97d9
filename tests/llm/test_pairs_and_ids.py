"""Near-duplicates, vectors, pieces, token files, mixing and the pipeline."""

from __future__ import annotations

import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidegate.llm import mixing, neardup, pieces, tokenfiles, vectors
from tidegate.llm.graph import components
from tidegate.llm.queries import QUERIES, table, tokenizer_file
from tidegate.llm.textbytes import text_slices
from tidegate.session import work_path
from tests.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1)))


def smallest(n, links):
    low = list(range(n))

    def top(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        low[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


def brute_components(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i]
        and sets[j]
        and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return smallest(len(texts), links), [len(s) for s in sets]


def chained(rng, n):
    """Copies of copies: neighbours in a chain are alike, its ends are not."""
    words = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(words)
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_like_brute_force(documents, width, percent):
    rng = random.Random(width)
    texts = chained(rng, 40) + chained(rng, 25)
    texts += ["a b", "A  B", "a", "a", None, "", "common line here " * 3] * 2
    texts += [f"{' '.join(rng.choices('abcdefgh', k=6))} shared passage of many words" for _ in range(60)]
    rng.shuffle(texts)
    want, sizes = brute_components(texts, width, percent)
    got = {r.doc_id: r for r in neardup.near_duplicates(documents(texts), width, percent).collect()}
    assert [got[k].component_id for k in range(len(texts))] == want
    assert [got[k].n_shingles for k in range(len(texts))] == sizes
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())


def test_near_duplicates_of_the_table(spark):
    docs = table(spark, SF, "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    assert [r.doc_id for r in rows] == list(range(len(rows)))
    want, _ = brute_components([r.text for r in rows], 3, 85)
    got = QUERIES["op6_bottom_k_near_dedup"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_near_duplicates_of_awkward_rows(awkward, documents):
    rows = neardup.near_duplicates(awkward, 3, 85).collect()
    assert len(rows) == 13
    out = neardup.deduplicate(awkward)
    assert out.columns == awkward.columns
    assert neardup.near_duplicates(documents([])).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 90), (101, 90), (5, 3)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[k] == 0 for k in range(61)) and got[101] == got[100] == 90


def test_vectors_like_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 64))
    near = base[:60] + rng.standard_normal((60, 64)) * np.linspace(0.05, 0.45, 60)[:, None]
    rows = np.r_[base, near, base[:5], base[7:8] * 3].astype(np.float32)
    data = [(k, [float(v) for v in x]) for k, x in enumerate(rows)]
    n = len(data)
    data += [(n, None), (n + 1, [0.0] * 64), (n + 2, [float("nan")] * 64), (n + 3, []), (n + 4, [None] * 64)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    x = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    alike = x @ x.T >= 0.95
    np.fill_diagonal(alike, False)
    got = {r.vec_id: r for r in vectors.near_vectors(frame).collect()}
    assert len(got) == n + 5
    found = sum(got[k].n_links for k in range(n))
    assert found >= 0.99 * alike.sum()
    assert all(got[k].n_links <= alike[k].sum() for k in range(n))
    want = smallest(n, zip(*np.nonzero(alike), strict=True))
    assert sum(got[k].component_id == want[k] for k in range(n)) >= 0.99 * n
    assert all(got[k].n_links == 0 and got[k].kept for k in range(n, n + 5))


def test_vectors_of_the_table(spark):
    folder = SF.replace("sf0.001", "sf0.1")
    rows = table(spark, folder, "embeddings").collect()
    x = np.stack([r.embedding for r in rows]).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    alike = (x @ x.T >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(table(spark, folder, "embeddings")).collect()}
    assert all(got[r.vec_id] <= n for r, n in zip(rows, alike, strict=True))
    assert sum(got.values()) >= 0.9 * alike.sum()
    empty = table(spark, folder, "embeddings").limit(0)
    assert vectors.near_vectors(empty).count() == 0


def test_collisions_are_calibrated():
    need = vectors.collisions(24)
    assert 14 < need < 24
    rng = np.random.default_rng(1)
    a = vectors.unit(rng.standard_normal((4000, 64)))
    side = rng.standard_normal((4000, 64))
    side = vectors.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
    found = sum(len(vectors.linked(a[k : k + 1], b[k : k + 1], 0.95)[0]) for k in range(4000))
    assert found >= 0.999 * 4000


MODEL = tokenizer_file("piece_bpe_32k.model")


def slow_pieces(p, text):
    """The best path of a whole text, one place after the other."""
    data = b" " + text.encode() if text else b""
    words = {
        p.text[a : a + n].tobytes(): k
        for k, (a, n) in enumerate(zip(p.text_start, p.text_length, strict=True))
        if n and p.score[k] > p.unknown and k not in set(p.byte_id.tolist())
    }
    best = [(0.0, [])] + [(-1e18, [])] * len(data)
    for i in range(len(data)):
        if data[i] & 0xC0 == 0x80:
            continue
        width = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
        edges = [
            (j, p.score[words[data[i:j]]], [words[data[i:j]]])
            for j in range(i + 1, min(i + 49, len(data) + 1))
            if data[i:j] in words
        ]
        if not any(j == i + width for j, _, _ in edges):
            edges.append((i + width, p.unknown, [int(p.byte_id[c]) for c in data[i : i + width]]))
        for j, score, ids in edges:
            if best[i][0] + score > best[j][0] + 1e-9:
                best[j] = (best[i][0] + score, best[i][1] + ids)
    return best[-1]


def test_pieces_are_best_paths():
    p = pieces.load(MODEL)
    rng = random.Random(4)
    letters = ["a", "the", " ", "  ", "é", "🎉", "日", "\n", "tion", "1", "▁", "Q", "z"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(60)]
    texts += ["x" * 150, "hello world " * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for _, data, offsets in text_slices(batch):
        ids, bounds = pieces.encode_slice(p, data, offsets)
    for k, text in enumerate(texts):
        mine = ids[bounds[k] : bounds[k + 1]].tolist()
        score, want = slow_pieces(p, text)
        total = sum(p.score[x] for x in mine if x not in set(p.byte_id.tolist()))
        whole = sum(p.score[x] for x in want if x not in set(p.byte_id.tolist()))
        assert total == pytest.approx(whole), text


def test_pieces_round_trip(awkward, documents):
    back = pieces.decode(pieces.encode(awkward, MODEL, "ids"), MODEL, "ids")
    assert back.count() == 13
    assert back.where("NOT (coalesce(text, '') <=> decoded)").count() == 0
    assert pieces.digests(awkward, MODEL).where("NOT same").count() == 0
    assert pieces.encode(awkward, MODEL).columns.count("pieces") == 1
    assert pieces.encode(documents([]), MODEL).count() == 0


TOKENIZER = tokenizer_file("byte_bpe_50k.json")


def plain_ids(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    whole.encode_special_tokens = True
    return [whole.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_stretches_never_change_ids():
    rng = random.Random(6)
    letters = [
        "a", "b", " ", "  ", "\n", "\n\n", "'", "'s", "n't", ".", ",", "%%", "1", "é", "ß", "×", " ",
        "　", "日", "🎉", "\t", "\x1c", "\x85", "_", "—", "Z9",
    ]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(8000)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    known = tokenfiles.Encoder(TOKENIZER)
    want = plain_ids(texts)
    for _, data, offsets in text_slices(batch):
        ids, bounds = known.encode(data, offsets)
    for k, row in enumerate(want):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == row[:-1], texts[k]


def test_token_files_read_back(spark, awkward, documents):
    for docs in (table(spark, SF, "documents"), awkward, documents([])):
        rows = docs.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        path = work_path(spark, "test-tokens")
        tokenfiles.write_token_files(docs, path, TOKENIZER)
        got = tokenfiles.digests(spark, path).orderBy("start").collect()
        want, start = [], 0
        for r, ids in zip(rows, plain_ids([r.text for r in rows]), strict=True):
            want.append((len(ids), crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
        assert [r.doc_id for r in got] == [r.doc_id for r in rows]
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])][: len(got)]
        assert tokenfiles.read_token_files(spark, path).count() == len(rows)


def test_added_tokens_in_texts_get_their_id(spark, awkward, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)  # as it is by default
    rng = random.Random(7)
    letters = ["a", " ", "\n", "<|endoftext|>", "<|", "endoftext", "|>", "é", ".", "'s", "word"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(4000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endofte", "xt|>", None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    known = tokenfiles.Encoder(TOKENIZER, added_tokens=True)
    for _ in range(2):  # the second time all is remembered
        for _, data, offsets in text_slices(batch):
            ids, bounds = known.encode(data, offsets)
        for k, text in enumerate(texts):
            want = whole.encode(text or "", add_special_tokens=False).ids
            assert ids[bounds[k] : bounds[k + 1]].tolist() == want, text
    # an added token of letters alone
    path = str(tmp_path / "tokenizer.json")
    whole.add_special_tokens(["stop"])
    whole.save(path)
    known = tokenfiles.Encoder(path, added_tokens=True)
    batch = pa.RecordBatch.from_arrays([pa.array(["stop", "nonstop", "go on", "on stop"])], ["text"])
    for _, data, offsets in text_slices(batch):
        ids, bounds = known.encode(data, offsets)
    for k, text in enumerate(batch.column(0).to_pylist()):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == whole.encode(text).ids
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op9_token_files"](spark, str(tmp_path)).collect()
    rows = awkward.select("text").collect()
    want = [whole.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows]
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (len(x), crc32(np.array(x, "<u4").tobytes())) for x in want
    )


def test_shards_decode_any_range():
    rng = random.Random(8)
    rows = [[rng.choice([5, 6, 7, 2]) for _ in range(rng.randint(0, 400))] + [2] for _ in range(40)]
    lengths = np.array([len(r) for r in rows])
    raw = tokenfiles.compress(np.concatenate(rows), lengths, 50_257, rounds=6)
    shard = tokenfiles.Shard(raw)
    assert shard.ids().tolist() == [x for r in rows for x in r]
    assert len(shard.symbols) < 0.3 * lengths.sum()
    for k, row in enumerate(rows):
        for _ in range(10):
            a, b = sorted((rng.randint(0, len(row)), rng.randint(0, len(row) + 2)))
            assert shard.range(k, a, b).tolist() == row[a:b]
    none = tokenfiles.Shard(tokenfiles.compress(np.zeros(0, np.int32), np.zeros(0, np.int64), 9))
    assert len(none.ids()) == 0


def test_rates_reach_the_targets(spark):
    docs, known = table(spark, SF, "documents"), table(spark, SF, "labels")
    targets = {"en": 0.4, "fr": 0.2, "de": 0.3, "es": 0.1}
    rows = mixing.rates(docs, known, targets).collect()
    assert all(r.rate >= 0 for r in rows)
    total = sum(r.rate * r.n_words for r in rows)
    for d, share in targets.items():
        got = sum(r.rate * r.n_words * r[f"p_{d}"] for r in rows)
        assert got / total == pytest.approx(share, abs=0.003)
    lang = {r.doc_id: r.lang for r in docs.collect()}
    right = sum(max(targets, key=lambda d: r[f"p_{d}"]) == lang[r.doc_id] for r in rows)
    assert right >= 0.9 * len(rows)
    copies = sum(r.copies * r.n_words for r in rows)
    assert copies == pytest.approx(total, rel=0.15)


def test_rare_domains_are_found(spark, labels):
    rng = random.Random(9)
    ends = {"en": "ing", "de": "ung", "es": "ado"}
    words = {
        d: [f"{a}{b}{c}{e}" for a in "bdfgklmnprstvw" for b in "aeiouy" for c in "bcdfghjklm"]
        for d, e in ends.items()
    }
    lang = ["es" if k % 100 == 0 else "de" if k % 10 == 1 else "en" for k in range(2000)]
    rows = [(k, " ".join(rng.choices(words[d], k=40)), d, "s", 0) for k, d in enumerate(lang)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    known = labels([(k, 1, 0) for k in range(2000) if k % 3])
    targets = {d: 1 / 3 for d in ends}
    for sent in (mixing.SENT, 0):  # as a small and as a large model
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(mixing, "SENT", sent)
            got = mixing.rates(docs, known, targets).collect()
        best = {r.doc_id: max(ends, key=lambda d: r[f"p_{d}"]) for r in got}
        assert sum(best[k] == "es" for k in range(0, 2000, 100)) >= 19
        expected = sum(r.n_words * r.p_es for r in got)
        assert expected == pytest.approx(20 * 40, rel=0.15)


def test_rates_solve_the_least_squares_problem(spark):
    """Against projected gradient steps on the documents themselves."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.6, 0.6, 0.6], 200)
    n = rng.integers(1, 500, 200)
    found = spark.createDataFrame(
        [(k, 1, int(n[k]), *map(float, p[k])) for k in range(200)],
        "doc_id long, rows long, n_words long, p0 double, p1 double, p2 double",
    )
    wanted = np.array([0.2, 0.3, 0.5])
    _, now = mixing.fit(found, wanted.tolist(), 0.0, 50_000.0)
    rate, mass = np.ones(200), (n[:, None] * p).sum(0)
    for _ in range(3000):
        left = (n[:, None] * p * rate[:, None]).sum(0) - wanted * 50_000
        rate = np.maximum(0, rate - p @ (left / mass))
    assert now == pytest.approx((n[:, None] * p * rate[:, None]).sum(0), rel=0.01)


def test_mixing_keeps_documents_and_columns(awkward, labels, documents):
    known = labels([(5, 1, 0), (8, 1, 0), (6, 0, 1)])
    out = mixing.mix(awkward, known)
    assert out.columns == awkward.columns
    assert out.count() >= 13
    assert mixing.mix(awkward, labels([])).count() == 13
    assert mixing.mix(documents([]), known).count() == 0


def test_pipeline_runs_and_each_stage_keeps_its_columns(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "pieces"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = work_path(spark, "test-stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = docs.count()
        assert 0.5 * before < after <= before
        before = after
    rows = sorted(docs.select("doc_id", "text").collect())
    want, _ = brute_components([r.text for r in rows], 5, 80)
    assert want == list(range(len(rows)))  # nothing alike is left
    out = corpus_pipeline.run(spark, SF)
    assert out.where("NOT same").count() == 0
    assert out.select("doc_id").distinct().count() == len(rows)
