"""The manifest against a plain one, in trees of one, two and three levels."""

from __future__ import annotations

import hashlib
from itertools import groupby
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidegate.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests, fanout):
    """The root, and the siblings of each leaf, level by level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[k : k + fanout] for k in range(0, len(digests), fanout)]
        for leaf, k in enumerate(at):
            run, slot = runs[k // fanout], k % fanout
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[leaf] = k // fanout
        digests = [sha(*run) for run in runs]
    return digests[0], paths


def plain(rows, fanout=16):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows as in SCHEMA."""

    def leaf(r, text):
        return sha(*[field(v) for v in (r[0], r[3], r[2], r[4], text)])

    def changed(r):
        hit = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
        lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return leaf(r, r[1].translate(lower) if hit and r[1] is not None else r[1])

    def name(r):
        return (r[3] is not None, (r[3] or "").encode())

    keyed = sorted(rows, key=lambda r: (name(r), r[0] is not None, r[0] or 0, leaf(r, r[1])))
    groups = [list(g) for _, g in groupby(keyed, key=name)]
    trees = [plain_tree([leaf(r, r[1]) for r in g], fanout) for g in groups]
    if not trees:
        return []
    root, tops = plain_tree([t[0] for t in trees], fanout)
    out = []
    for g, (subroot, paths), top in zip(groups, trees, tops, strict=True):
        for r, path in zip(g, paths, strict=True):
            node = changed(r)
            for before, behind in [*path, *top]:
                node = sha(before, node, behind)
            proof = sha(*[x for pair in [*path, *top] for x in pair])
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def rows_of(n, sources):
    return [(k * 7, f"Text {k % 50} Ünï", "en" if k % 3 else None, sources(k), k) for k in range(n)]


@pytest.mark.parametrize(
    "n, sources",
    [
        (1, lambda k: "only"),
        (17, lambda k: "only"),
        (400, lambda k: None if k % 9 == 0 else "hot" if k % 3 else f"s{k % 40}"),
        (300, lambda k: f"s{k}"),  # lone leaves, two levels over the sources
    ],
)
def test_like_the_plain_manifest(spark, rows, n, sources):
    data = rows_of(n, sources)
    got = merkle.checked(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert rows(got) == plain(data)


def test_awkward_rows(awkward, rows):
    base = [tuple(r)[:5] for r in awkward.collect()]
    got = rows(merkle.checked(awkward))
    assert got == plain(base)
    assert len(got) == len(base)  # a row that stands twice is two leaves


def test_empty_table(spark):
    assert merkle.checked(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_columns_groups_and_widths(spark, rows):
    """Width three: four levels; paths fold to the root, a changed leaf does not."""
    data = spark.createDataFrame([(f"k{k:03}", k % 2, k / 3) for k in range(70)], "id string, part int, x double")
    found = merkle.manifest(data, ["id", "x"], key="id", group="part", fanout=3)
    folded = found.select(
        (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("good"),
        (merkle.fold(F.upper("leaf"), F.col("path")) == F.col("root")).alias("bad"),
        F.size("path").alias("levels"),
    )
    assert set(map(tuple, folded.collect())) == {(True, False, 5)}


def test_hot_source_over_many_parts(spark):
    """Places in a group that fills most parts are without gaps."""
    from tidegate.llm.frames import Kept

    data = spark.range(5000).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("g"),
        (F.col("id") * 13 % 5000).alias("key"),
    ).repartition(16)
    kept = Kept(spark)
    got = merkle.placed(data, ["key"], kept).collect()
    for g in (None, "hot"):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.key)
        assert [r.pos for r in mine] == list(range(len(mine)))
        assert {r.n for r in mine} == {len(mine)}
