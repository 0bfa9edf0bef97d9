"""Nearest neighbours against brute force: recall, scores, ties and rows that take no part."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidegate.llm import nearest
from tidegate.llm.queries import op11_adaptive_scan, table
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, every=100, k=10):
    """{(query_id, rank): (vec_id, score)} over rows with different ids."""
    out = {}
    usable = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    for q, x in usable:
        if q % every:
            continue
        far = sorted(
            (float(np.sqrt(((x - y) ** 2).sum())), i)
            for i, y in usable
            if i != q and len(y) == len(x)
        )
        out |= {(q, r + 1): (i, d) for r, (d, i) in enumerate(far[:k])}
    return out


def got(df):
    rows = df.collect()
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(found) == len(rows)
    return found


def recall(found, want):
    held = {(q, v) for (q, _), (v, _) in found.items()}
    right = {(q, v) for (q, _), (v, _) in want.items()}
    return len(held & right) / len(right)


def test_query_like_brute_force(spark):
    rows = [tuple(r)[:2] for r in table(spark, SF, "embeddings").collect()]
    assert got(op11_adaptive_scan(spark, SF)) == plain(rows)


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_many_lists(spark, monkeypatch, clustered):
    monkeypatch.setattr(nearest, "PER_LIST", 60)
    monkeypatch.setattr(nearest, "SAMPLE", 1500)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 48))
    if clustered:
        x = rng.standard_normal((40, 48))[rng.integers(0, 40, 6000)] + 0.2 * x
    rows = [(k, v) for k, v in enumerate(x.tolist())]
    want = plain(rows)
    found = got(nearest.nearest(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert set(found) == set(want)  # ten results for each query
    assert recall(found, want) >= 0.95
    known = dict(rows)
    for (q, _), (v, score) in found.items():
        exact = math.dist(known[q], known[v])
        assert score == pytest.approx(exact, rel=1e-14)


def test_large_and_close_numbers(spark):
    """Distances far below the vectors' length: what sums of products lose is allowed for."""
    rng = np.random.default_rng(6)
    rows = [(k, (1e6 + 1e-3 * v).tolist()) for k, v in enumerate(rng.standard_normal((400, 24)))]
    assert got(nearest.nearest(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_one_vector_almost_everywhere(spark):
    rng = np.random.default_rng(7)
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 else v) for k, v in enumerate(rng.random((3000, 3)).tolist())]
    found = got(nearest.nearest(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert found == plain(rows)
    assert [found[100, r][0] for r in range(1, 11)] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]


def test_rows_that_take_no_part(spark):
    bad = [None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(100 * k, v) for k, v in enumerate(bad)]
    rows += [(None, [1.0, 1.0]), (1000, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [1e200, 1.0]), (1100, [1.0])]
    schema = f"{SCHEMA}, class int, size string, ids int, score string, rank int"
    awkward = spark.createDataFrame([(*r, 1, "s", 2, "x", 3) for r in rows], schema)
    assert got(nearest.nearest(awkward)) == {(1000, 1): (7, math.sqrt(2)), (1000, 2): (8, math.inf)}


def test_repeated_rows_and_ids(spark):
    """Equal rows count once; an id with two vectors is two rows, each a candidate for the other."""
    rows = [(0, [1.0, 0.0])] * 3 + [(5, [0.0, 1.0])] * 2 + [(0, [0.0, 3.0])]
    found = nearest.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    far = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    assert far == [
        (0, 1, 5, math.sqrt(2)), (0, 1, 5, 2.0),
        (0, 2, 0, math.sqrt(10)), (0, 2, 0, math.sqrt(10)),
    ]


def test_empty_table(spark):
    assert nearest.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
