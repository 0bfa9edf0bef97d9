"""Nearest neighbours by an adaptive dimension scan over the lists of an inverted file.

Every vector belongs to the list of its nearest centre. A query probes the lists whose centres are
nearest to it, as many as the calibration asks for. Within a probed list the vectors are turned by a random
rotation, which spreads what two vectors differ in evenly over the columns, and are read in blocks of
``WIDTH`` columns. After each block a hypothesis test on the distance so far, scaled to all columns,
gives up candidates that can hardly be nearer than the query's bound; what is left after the last
block is measured on the original vectors in double precision.

A query's bound is the (k+1)th smallest distance to the sampled vectors, which are rows too and among
what it finds, and within a list that of the candidates that look nearest after the first block,
whichever is less.

Centres, the number of probes and the bounds come from a sample of at most ``SAMPLE`` distinct vectors and
``SAMPLE_BYTES`` in all, the least by a hash; every row is indexed. The number of probes is the
least one with which the sample's own neighbours are found with a share of ``CALIBRATED``: where vectors
have no clusters, that is a large part of the lists. Lists are dealt to blocks of bounded size by a
hash, and the queries of a list to chunks, so a list that holds most vectors or is asked for by most
queries is worked on by many tasks.

Equal vectors are searched once. Of a vector that many rows share, the ``k + 1`` smallest ids can be
among the nearest of anything; a window that keeps so many before its shuffle finds them.

Vectors that are missing, empty, zero or hold missing or non-finite numbers take no part, nor do rows
without an id; vectors of different lengths are never compared. Rows that repeat count once; rows that
repeat an id with another vector are rows of their own. Ties go to the smaller id. Fewer than ``k`` other
rows give fewer results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.frames import Kept

WIDTH = 16
DOUBT = 2.1  # how far beyond the bound, in standard deviations, a candidate is given up
SAMPLE = 16_384
SAMPLE_BYTES = 16 << 20
PER_LIST = 1024
LISTS = 1024
ROUNDS = 8  # of the centres' fit
CALIBRATED = 0.99
TRIED = 256  # sampled vectors that calibrate the number of probes
BLOCK = 1024  # vectors of a list, or queries, in one piece of work
SEED = 29
FOUND = "asker long, class long, ids array<long>, score double"


def rotation(size: int) -> np.ndarray:
    """A random rotation, the same wherever it is made."""
    drawn = np.random.default_rng(SEED).standard_normal((size, size))
    return np.linalg.qr(drawn)[0]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and y; small ones may be off by rounding."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.maximum(d, 0)  # missing stays missing: numbers whose squares are too large


def first(x: np.ndarray, y: np.ndarray, seen: np.ndarray, k: int):
    """The k + 1 rows of y that ``seen`` ranks first for each row of x, and their squared distances."""
    look = np.argpartition(seen, k, 1)[:, : k + 1]
    return look, np.stack([((x - y[at]) ** 2).sum(1) for at in look.T], 1)


def reach(x: np.ndarray, y: np.ndarray, seen: np.ndarray, k: int) -> np.ndarray:
    """A squared distance within which each row of x has k + 1 rows of y; infinite where y has fewer."""
    if len(y) <= k:
        return np.full(len(x), np.inf)
    return first(x, y, seen, k)[1].max(1) * (1 + 1e-9)


def centres(x: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's rounds over the sample, from rows of it."""
    found = x[np.random.default_rng(SEED).permutation(len(x))[:lists]].copy()
    for _ in range(ROUNDS):
        near = squared(x, found).argmin(1)
        many = np.bincount(near, minlength=lists)
        sums = np.zeros_like(found)
        np.add.at(sums, near, x)
        found[many > 0] = sums[many > 0] / many[many > 0, None]
    return found


def probes(x: np.ndarray, middle: np.ndarray, k: int) -> int:
    """How many lists have to be probed to find the sample's own neighbours."""
    if len(middle) < 2 or len(x) < 2:
        return len(middle)
    near = squared(x, middle).argmin(1)
    tried = x[:TRIED]
    distance = squared(tried, x)
    distance[np.arange(len(tried)), np.arange(len(tried))] = np.inf
    best = np.argsort(distance, 1, kind="stable")[:, : min(k, len(x) - 1)]
    place = np.argsort(np.argsort(squared(tried, middle), 1, kind="stable"), 1)
    need = np.sort(np.take_along_axis(place, near[best], 1).ravel()) + 1
    return int(need[int(np.ceil(CALIBRATED * len(need))) - 1])


def fit(sample: np.ndarray, rows: int, k: int) -> dict:
    """Centres, number of probes and sampled vectors of one vector length."""
    lists = max(1, min(LISTS, rows // PER_LIST, len(sample))) if len(sample) > k else 1
    middle = centres(sample, lists)
    return {"centres": middle, "probes": probes(sample, middle, k), "sample": sample}


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def able(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (in double precision) of the rows that take part, equal rows once."""
    usable = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
        .where(F.col("vec_id").isNotNull() & (F.size("vec") > 0))
        .where(usable & F.exists("vec", lambda v: v != 0))
        .distinct()
    )


def classes(rows: DataFrame, k: int) -> DataFrame:
    """vec, size and ids: the k + 1 smallest ids of each different vector."""
    first = F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))
    return (
        rows.withColumn("_n", first)
        .where(F.col("_n") <= k + 1)
        .groupBy("vec")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select(
            F.monotonically_increasing_id().alias("class"), "vec", F.size("vec").alias("size"), "ids"
        )
    )


def models(found: DataFrame, k: int) -> dict[int, dict]:
    """What ``fit`` finds for each vector length the bounded sample has."""
    sizes = {r["size"]: r["count"] for r in found.groupBy("size").count().collect()}
    bound = min(SAMPLE, SAMPLE_BYTES // (8 * max(sizes, default=1)))
    drawn = found.orderBy(F.xxhash64("vec"), "class").limit(max(bound, 1))
    table = drawn.select("size", "vec", "class", "ids").toArrow().combine_chunks()
    out = {}
    for size in sizes:
        rows = table.filter(pc.equal(table.column("size"), size)).combine_chunks()
        if len(rows):
            vec, number, ids = (rows.column(c).combine_chunks() for c in ("vec", "class", "ids"))
            out[size] = fit(_matrix(vec, size), sizes[size], k) | {"class": number, "ids": ids}
    return out


def routed(found: DataFrame, known, k: int, ask: bool) -> DataFrame:
    """The rows with ``list``: a vector's own one, or each one a query probes, and a query's ``bound``.

    Vectors of a length the sample does not have are one list, which all their queries probe.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                x = _matrix(part.column(2), size)
                model = known.value.get(size)
                to, bound = np.zeros((len(x), 1), np.int32), np.full(len(x), np.inf)
                if model is not None:
                    many = model["probes"] if ask else 1
                    far = squared(x, model["centres"])
                    to = np.argsort(far, 1, kind="stable")[:, :many].astype(np.int32)
                    if ask:
                        sample = model["sample"]
                        bound = reach(x, sample, squared(x, sample), k)
                width = to.shape[1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, to.size + 1, width, np.int32)), pa.array(to.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(bound)], [*part.schema.names, "lists", "bound"]
                )

    kinds = "class long, size int, vec array<double>, ids array<long>, lists array<int>, bound double"
    given = found.select("class", "size", "vec", "ids").mapInArrow(run, kinds)
    return given.withColumn("list", F.explode("lists")).drop("lists")


def seeded(asking: DataFrame, known, k: int) -> DataFrame:
    """asker, class, ids and score of each query's nearest sampled vectors, which its bound is from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes).tolist():
                model = known.value.get(size)
                if model is None or len(model["sample"]) <= k:
                    continue  # such queries have no bound
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                x, sample = _matrix(part.column(2), size), model["sample"]
                look, far = first(x, sample, squared(x, sample), k)
                at = pa.array(look.ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k + 1))),
                        model["class"].take(at),
                        model["ids"].take(at),
                        pa.array(np.sqrt(far.ravel())),
                    ],
                    ["asker", "class", "ids", "score"],
                )

    return asking.select("class", "size", "vec").mapInArrow(run, FOUND)


def dealt(rows: DataFrame, held: list[str], piece: str, value: str) -> DataFrame:
    """The rows of each list in pieces of about ``BLOCK``, as one array each."""
    counted = rows.groupBy("size", "list").agg(F.ceil(F.count("*") / BLOCK).alias("_pieces"))
    return (
        rows.join(counted, ["size", "list"])
        .withColumn(piece, F.pmod(F.xxhash64("class"), "_pieces"))
        .groupBy("size", "list", piece)
        .agg(F.collect_list(F.struct(*held)).alias(value))
    )


def scan(asked: np.ndarray, bound: np.ndarray, held: np.ndarray, k: int):
    """Places in ``asked`` and ``held`` of pairs not given up, and their distances, at most k + 1 for
    each query but for ties; ``bound`` holds squared distances."""
    size = asked.shape[1]
    turn = rotation(size)
    x, y = asked @ turn, held @ turn
    seen = min(WIDTH, size)
    sofar = squared(x[:, :seen], y[:, :seen])
    bound = np.minimum(bound, reach(asked, held, sofar, k))
    # what sums of products may be off by
    slack = 1e-12 * ((x * x).sum(1) + (y * y).sum(1).max())

    def limit(columns: int) -> np.ndarray:
        doubt = (columns / size) * (1 + DOUBT / np.sqrt(columns)) ** 2 if columns < size else 1.0
        return bound * doubt + slack

    i, j = np.nonzero(~(sofar > limit(seen)[:, None]))
    sums = sofar[i, j]
    while seen < size:
        more = min(seen + WIDTH, size)
        for low in range(0, len(i), 1 << 17):
            part = slice(low, low + (1 << 17))
            gap = x[i[part], seen:more] - y[j[part], seen:more]
            sums[part] += np.einsum("ij,ij->i", gap, gap)
        seen = more
        stay = ~(sums > limit(seen)[i])
        i, j, sums = i[stay], j[stay], sums[stay]
    exact = np.zeros(len(i))
    for low in range(0, len(i), 1 << 17):
        part = slice(low, low + (1 << 17))
        exact[part] = ((asked[i[part]] - held[j[part]]) ** 2).sum(1)
    order = np.lexsort((exact, i))
    i, j, exact = i[order], j[order], exact[order]
    # what is farther than the query's (k+1)th here cannot be among its nearest
    begin = np.searchsorted(i, i)
    last = np.minimum(begin + k, np.searchsorted(i, i, "right") - 1)
    keep = exact <= exact[last]
    return i[keep], j[keep], np.sqrt(exact[keep])


def scanned(pairs: DataFrame, k: int) -> DataFrame:
    """asker, class, ids and distance of what each piece of queries finds in each piece of a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                size = batch.column(0)[row].as_py()
                ask, own = batch.column(1)[row].values, batch.column(2)[row].values
                x, y = (_matrix(s.field("vec"), size) for s in (ask, own))
                bound = ask.field("bound").to_numpy(zero_copy_only=False)
                i, j, far = scan(x, bound, y, k)
                if len(i):
                    j = pa.array(j)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ask.field("class").take(pa.array(i)),
                            own.field("class").take(j),
                            own.field("ids").take(j),
                            pa.array(far),
                        ],
                        ["asker", "class", "ids", "score"],
                    )

    return pairs.select("size", "asked", "held").mapInArrow(run, FOUND)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of each query: the rows whose vec_id is
    divisible by ``every``. score is the Euclidean distance."""
    spark = vectors.sparkSession
    kept = Kept(spark)
    rows = kept.table(able(vectors), "able")
    found = kept.table(classes(rows, k), "vector-classes")
    known = spark.sparkContext.broadcast(models(found, k))  # bounded by SAMPLE_BYTES and LISTS
    queries = kept.table(
        rows.where(F.col("vec_id") % every == 0)
        .join(found.select("vec", "class"), "vec")
        .select(F.col("vec_id").alias("query_id"), "class"),
        "queries",
    )
    asking = kept.table(
        found.join(queries.select("class").distinct(), "class", "left_semi"), "asking"
    )
    blocks = dealt(routed(found, known, k, False), ["class", "ids", "vec"], "block", "held")
    chunks = dealt(
        kept.table(routed(asking, known, k, True), "asked"),
        ["class", "bound", "vec"], "chunk", "asked",
    )
    hits = scanned(chunks.join(blocks, ["size", "list"]), k).unionByName(seeded(asking, known, k))
    hits = kept.table(hits.groupBy("asker", "class", "ids").agg(F.min("score").alias("score")), "hits")
    # the k + 1 nearest of each different query vector, its own rows among them
    order = W.partitionBy("asker").orderBy("score", "vec_id")
    top = (
        hits.select("asker", "class", F.explode("ids").alias("vec_id"), "score")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= k + 1)
        .drop("_n")
    )
    own = (F.col("query_id") == F.col("vec_id")) & (F.col("_class") == F.col("class"))
    rank = F.row_number().over(W.partitionBy("query_id", "_class").orderBy("score", "vec_id"))
    result = (
        queries.withColumnRenamed("class", "_class")
        .join(top, F.col("_class") == F.col("asker"))
        .where(~own)
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
    kept.drop_all_but("queries", "hits")
    return result
