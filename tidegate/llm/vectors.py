"""Near-duplicate vectors by counted collisions of one-dimensional projections.

Vectors of length one are projected on ``PROJECTIONS`` fixed directions that stand at right angles. On
every line the projections of a block are sorted, and a window around each query's own projection
is looked up; a vector in the window collides with the query. Pairs that collide on at least so many
lines as the calibration asks for are verified by their cosine in double precision.

The calibration is for pairs just at the threshold, the hardest to keep: their projections differ by
a known spread, the window reaches ``REACH`` times that far, and the number of collisions asked for is
the largest one that such a pair reaches with a chance of ``RECALL``.

Blocks are cut along the first line, into cells twice as wide as the window; a cell's vectors are
dealt to blocks of bounded size by a hash. Only blocks of the same or neighbouring cells are
compared, each pair of blocks by one task; it gives back counts of links and a spanning forest of
them, never the pairs of a group. Equal vectors are one before blocks are made.

Vectors that are missing, empty, zero or hold missing or non-finite numbers link with nothing, and
vectors of different lengths do not link. Rows that repeat a vec_id count as vectors of their own:
classes of equal vectors have numbers of their own, and ids are looked up in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import kept_table
from tidegate.llm.graph import components

PROJECTIONS = 24
REACH = 2.0
WITHIN = 0.9545  # share of a normal spread within twice its size
RECALL = 0.9999
BLOCK = 2048
SEED = 11


def directions(size: int) -> np.ndarray:
    """Fixed directions at right angles, as many as there are lines or, in few dimensions, axes."""
    drawn = np.random.default_rng(SEED).standard_normal((size, size))
    return np.linalg.qr(drawn)[0][:, : min(PROJECTIONS, size)].astype(np.float32)


def spread(size: int, least: float) -> float:
    """How far projections of unit vectors at the threshold lie apart, as a standard deviation."""
    return float(np.sqrt(max(2 - 2 * least, 1e-12) / size))


def collisions(lines: int) -> int:
    """The calibrated number of lines on which a pair has to collide."""
    chance, need = 0.0, lines
    while need > 0:
        chance += comb(lines, need) * WITHIN**need * (1 - WITHIN) ** (lines - need)
        if chance >= RECALL:
            return need
        need -= 1
    return 0


def prepared(vectors: DataFrame, least: float) -> DataFrame:
    """vec_id, size (0 if it cannot link), cell and the vector's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = column.flatten()
            values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            raw = flat.fill_null(0).cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths).astype(np.int64)
            size, cell, held = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32), []
            for k, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
                x = values[a:b]
                ok = b > a and np.isfinite(x).all() and x.any()
                held.append(raw[a:b].tobytes() if ok else None)
                size[k] = b - a if ok else 0
            for n in np.unique(size[size > 0]).tolist():
                at = np.flatnonzero(size == n)
                x = unit(np.stack([np.frombuffer(held[k]) for k in at.tolist()]))
                line = x @ directions(n)[:, 0].astype(np.float64)
                cell[at] = np.floor(line / (2 * REACH * spread(n, least)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(cell), pa.array(held, pa.binary())],
                ["vec_id", "size", "cell", "vec"],
            )

    return vectors.select("vec_id", "embedding").mapInArrow(
        run, "vec_id long, size int, cell int, vec binary"
    )


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def forest(a: np.ndarray, b: np.ndarray):
    """Links that join the same nodes as the links a-b do, one for each node but the smallest."""
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    child = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[low[child]], nodes[child]


def linked(x: np.ndarray, y: np.ndarray, least: float):
    """Places of the linked pairs of two blocks: counted collisions first, then the cosine."""
    size = x.shape[1]
    lines, reach = directions(size), np.float32(REACH * spread(size, least) + 1e-6)
    px, py = x.astype(np.float32) @ lines, y.astype(np.float32) @ lines
    need, n = collisions(lines.shape[1]), lines.shape[1]
    counts = np.zeros((len(x), len(y)), np.uint8)
    for k in range(n):
        order = np.argsort(py[:, k], kind="stable")
        ranked = py[order, k]
        rank = np.empty(len(y), np.uint16)
        rank[order] = np.arange(len(y), dtype=np.uint16)
        low = np.searchsorted(ranked, px[:, k] - reach, "left").astype(np.uint16)
        high = np.searchsorted(ranked, px[:, k] + reach, "right").astype(np.uint16)
        # ranks in the window, as one comparison of unsigned numbers
        counts += (rank[None, :] - low[:, None]) < (high - low)[:, None]
    i, j = np.nonzero(counts >= need)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 100_000):
        part = slice(at, at + 100_000)
        keep[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= least
    return i[keep], j[keep]


def near_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = kept_table(prepared(vectors, least), "vectors")
    able = rows.where("size > 0 AND vec_id IS NOT NULL")
    classes = kept_table(
        able.groupBy("vec", "size", "cell")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    # a number for each cell: cells are bounded by the projections' range, not by the rows
    sizes = classes.groupBy("size", "cell").agg(F.count("*").alias("n")).collect()
    cells = {(r.size, r.cell): r.n for r in sizes}
    parts = {k: -(-n // BLOCK) for k, n in cells.items()}
    dealt = vectors.sparkSession.createDataFrame(
        [(s, c, p) for (s, c), p in parts.items()], "size int, cell int, parts int"
    )
    blocks = kept_table(
        classes.join(F.broadcast(dealt), ["size", "cell"])
        .withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int"))
        .groupBy("size", "cell", "part")
        .agg(F.collect_list(F.struct("class", "n", "vec")).alias("held")),
        "vector-blocks",
    )
    neighbours = vectors.sparkSession.createDataFrame(
        [
            (s, c, p, near, parts.get((s, near), 0))
            for (s, c), p in parts.items()
            for near in (c, c + 1)
            if (s, near) in parts
        ],
        "size int, cell int, parts int, near int, near_parts int",
    )
    pairs = (
        neighbours.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("near_part", F.explode(F.sequence(F.lit(0), F.col("near_parts") - 1)))
        .where("near > cell OR near_part >= part")
        .select("size", "cell", "part", "near", "near_part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one, two = batch.column(1)[k].values, batch.column(2)[k].values
                same = batch.column(3)[k].as_py()
                size = batch.column(0)[k].as_py()
                ids, n, x = [], [], []
                for held in (one, two):
                    ids.append(held.field("class").to_numpy(zero_copy_only=False))
                    n.append(held.field("n").to_numpy(zero_copy_only=False))
                    raw = b"".join(v.as_buffer().to_pybytes() for v in held.field("vec"))
                    x.append(unit(np.frombuffer(raw).reshape(-1, size)))
                i, j = linked(x[0], x[1], least)
                if same:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                totals = [
                    np.bincount(i, weights=n[1][j], minlength=len(ids[0])),
                    np.bincount(j, weights=n[0][i], minlength=len(ids[1])),
                ]
                a, b = forest(ids[0][i], ids[1][j])
                some = [np.flatnonzero(t) for t in totals]
                out = [
                    np.r_[ids[0][some[0]], ids[1][some[1]], a],
                    np.r_[np.full(len(some[0]) + len(some[1]), -1), b],
                    np.r_[totals[0][some[0]], totals[1][some[1]], np.zeros(len(a))].astype(np.int64),
                    np.r_[np.zeros(len(some[0]) + len(some[1]), bool), np.ones(len(a), bool)],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in out], ["a", "b", "n", "link"]
                )

    left = blocks.withColumnRenamed("held", "one")
    right = blocks.select(
        "size",
        F.col("cell").alias("near"),
        F.col("part").alias("near_part"),
        F.col("held").alias("two"),
    )
    compared = (
        pairs.join(left, ["size", "cell", "part"])
        .join(right, ["size", "near", "near_part"])
        .select(
            "size", "one", "two",
            ((F.col("cell") == F.col("near")) & (F.col("part") == F.col("near_part"))).alias("same"),
        )
    )
    found = kept_table(compared.mapInArrow(run, "a long, b long, n long, link boolean"), "compared")
    counts = (
        found.where("NOT link").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("other"))
    )
    joined = components(found.where("link").select("a", "b")).toDF("class", "component")
    numbered = (
        classes.join(counts, "class", "left")
        .join(joined, "class", "left")
        .select(
            "vec", "size", "cell", "first",
            (F.coalesce("other", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("number"),
        )
    )
    # the smallest id of each component
    least_id = numbered.groupBy("number").agg(F.min("first").alias("component"))
    known = numbered.drop("first").join(least_id, "number").drop("number")
    linked_rows = (
        able.select("vec_id", "vec", "size", "cell")
        .join(known, ["vec", "size", "cell"])
        .select(
            "vec_id",
            "n_links",
            F.col("component").alias("component_id"),
            (F.col("component") == F.col("vec_id")).alias("kept"),
        )
    )
    others = rows.where("NOT (size > 0 AND vec_id IS NOT NULL)").select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return linked_rows.unionByName(others)
