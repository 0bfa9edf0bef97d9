"""Near-duplicate documents by bottom-k sketches of their word shingles.

Every shingle has one hash, and a document retains its ``SKETCH`` smallest ones. Two documents at the
threshold share most of what they retain. Inverted lists of the retained values generate the
candidates, rarest lists first: a document enters the lists of its ``RAREST`` rarest values only. Values
in no other document come first among these, so most documents enter no list. Two documents that
share more than ``SKETCH - RAREST`` retained values meet in a list, whatever the lists' sizes; at a
similarity of 0.8, fewer are shared with a chance below one in a million. Texts of at most
``RAREST`` shingles enter all their lists.

Pairs are made in three steps that never write all pairs of a list of alike documents. First each
document is paired with one of its lists' smallest documents, the heads: the one it shares most lists
with. The links found join documents to components, and only pairs of a list that lie in different
components are open. Second, documents are paired with the other heads as far as these pairs are open.
Then the open pairs of the lists that still hold several components are made.
Pairs whose sizes cannot reach the threshold are left out. Copies of one text that are each too far
from the others would still be tried pair by pair, so open lists longer than ``LONG`` make no pairs:
their documents, the crowd, put all their shingles in order, those rare in the crowd first, and two
of them are paired where a shingle among the first n - ceil(t n) + 1 of each is shared and enough
shingles can follow it. Every link has such a shingle, so this loses none. A pair is left to an
earlier shingle if one of the ``EARLIER`` before the shared one, in this order, is shared too: more can
follow that one, so the pair is made there or earlier still, and most pairs are made once.

The smallest hashes of the union of both sets estimate the similarity; pairs that fall ``MARGIN`` short
are given up, which a pair at the threshold does with a chance below one in a million. The others
are confirmed by the exact share on both full sets of 64-bit shingle hashes.

Documents with equal sets are one before lists are made. Missing and empty texts have no shingles and
link with nothing; texts shorter than a shingle are one shingle. Rows that repeat a doc_id are
linked as equal texts are; rows without doc_id are left out of links and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import Kept
from tidegate.llm.graph import components
from tidegate.llm.textbytes import LOWER, NOT_SPACE, mix, span_hashes, spans, text_slices

SKETCH = 32
RAREST = 20
MARGIN = 0.4
LONG = 24
EARLIER = 4
ROTATE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """The distinct shingle hashes of each row, ascending, and the rows' offsets among them."""
    low = LOWER[data]
    starts, ends, firsts = spans(low, offsets, NOT_SPACE)
    words = span_hashes(low, starts, ends)
    n = np.diff(firsts)
    sizes = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), sizes)
    at = np.arange(len(row)) + np.repeat(firsts[:-1] - (np.cumsum(sizes) - sizes), sizes)
    held = np.minimum(n, width)[row]
    hashes = np.zeros(len(row), np.uint64)
    for k in range(width):
        inside = held > k
        hashes[inside] = mix(hashes[inside] * ROTATE + words[at[inside] + k] + np.uint64(1))
    hashes = hashes.view(np.int64)
    order = np.lexsort((hashes, row)) if len(n) > 1 else np.argsort(hashes)
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(n) + 1)), row


def retained(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, and the retained values, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                hashes, bounds, row = shingle_sets(data, offsets, width)
                n = np.diff(bounds)
                raw = hashes.view(np.uint64)
                digests = []
                for salt in (1, 2):
                    total = np.zeros(len(raw) + 1, np.uint64)
                    np.cumsum(mix(raw + ROTATE * np.array(salt, np.uint64)), out=total[1:])
                    digests.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                kept = hashes[np.arange(len(raw)) - bounds[row] < SKETCH]
                ends = np.r_[0, np.cumsum(np.minimum(n, SKETCH))]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(n.astype(np.int64)),
                        pa.array(digests[0]),
                        pa.array(digests[1]),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(kept)),
                    ],
                    ["doc_id", "n_shingles", "d1", "d2", "kept"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, kept array<long>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """doc_id and full set (as bytes) of the wanted documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                hashes, bounds, _ = shingle_sets(data, offsets, width)
                raw, at = hashes.tobytes(), bounds.tolist()
                sets = [raw[8 * a : 8 * b] for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"]
                )

    return _texts_of(docs, wanted).mapInArrow(run, "doc_id long, shingles binary")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")


def crowd_pairs(
    docs: DataFrame, crowd: DataFrame, width: int, percent: int, keep: Kept
) -> DataFrame:
    """Pairs (a, b) of different components of the crowd (doc_id, n, component) that may be links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                hashes, _, row = shingle_sets(data, offsets, width)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(row)), pa.array(hashes)], ["doc_id", "v"]
                )

    texts = _texts_of(docs, crowd.select("doc_id"))
    held = keep.table(texts.mapInArrow(run, "doc_id long, v long").distinct(), "crowd")
    holders = held.groupBy("v").agg(F.count("*").alias("holders"))
    ordered = (
        held.join(holders, "v")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("holders", "v"))).alias("ordered"))
        .join(crowd, "doc_id")
    )
    first = f"CAST(n - ({percent} * n + 99) DIV 100 + 1 AS INT)"
    before = ", ".join(f"get(ordered, i - {back}).v" for back in range(1, EARLIER + 1))
    leading = F.expr(
        f"transform(slice(ordered, 1, {first}), (e, i) -> "
        f"named_struct('holders', e.holders, 'v', e.v, 'before', array({before})))"
    )
    entries = keep.table(
        ordered.select("doc_id", "n", "component", F.posexplode(leading).alias("k", "e"))
        .where("e.holders > 1")
        .select(
            "doc_id",
            "component",
            "n",
            (F.col("n") - F.col("k")).alias("rest"),
            F.col("e.v").alias("v"),
            F.col("e.before").alias("before"),
        ),
        "crowd-lists",
    )
    other = entries.select(
        "v",
        F.col("doc_id").alias("b"),
        F.col("component").alias("cb"),
        F.col("n").alias("nb"),
        F.col("rest").alias("rest_b"),
        F.col("before").alias("before_b"),
    )
    return (
        entries.join(other, "v")
        .where(
            "doc_id < b AND component <> cb AND "
            f"100 * least(rest, rest_b) >= {percent} * (n + nb - least(rest, rest_b)) AND "
            "NOT coalesce(arrays_overlap(before, before_b), false)"
        )
        .select(F.col("doc_id").alias("a"), "b")
        .distinct()
    )


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose union's sketch does not rule them out."""
    both = pairs.join(sketches.toDF("a", "x"), "a").join(sketches.toDF("b", "y"), "b")
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect("x", "y"), F.col("union")))
    return (
        both.withColumn("union", union)
        .where(common >= F.size("union") * (percent / 100 - MARGIN))
        .select("a", "b")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets share enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (left, right))
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one, two = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def lists(reps: DataFrame) -> DataFrame:
    """v, doc_id, n and the list's head (smallest doc_id, head and its n) of every entry."""
    postings = reps.select(
        "doc_id",
        F.col("n_shingles").alias("n"),
        F.size("kept").alias("held"),
        F.explode("kept").alias("v"),
    )
    sizes = postings.groupBy("v").agg(F.count("*").alias("size")).where("size > 1")
    shared = postings.join(sizes, "v")
    # values that no other document retains are the rarest and need no list
    entered = (
        shared.groupBy("doc_id", "n", "held")
        .agg(F.array_sort(F.collect_list(F.struct("size", "v"))).alias("entries"))
        .withColumn("room", F.lit(RAREST) - (F.col("held") - F.size("entries")))
        .where("room > 0")
        .select(
            "doc_id",
            "n",
            F.explode(F.slice("entries", F.lit(1), F.least(F.col("room"), F.size("entries")))).alias("e"),
        )
        .select("doc_id", "n", F.col("e.v").alias("v"))
    )
    heads = entered.groupBy("v").agg(
        F.min(F.struct("doc_id", "n")).alias("head"), F.count("*").alias("entries")
    )
    return entered.join(heads.where("entries > 1"), "v").select(
        "v", "doc_id", "n", F.col("head.doc_id").alias("head"), F.col("head.n").alias("head_n")
    )


def _labelled(entries: DataFrame, joined: DataFrame) -> DataFrame:
    """The entries of lists with their documents' components (doc_id, component)."""
    return entries.join(joined, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )


def _mixed(members: DataFrame) -> DataFrame:
    """v, number of entries and the head's component of the lists that hold several components."""
    return (
        members.groupBy("v")
        .agg(
            F.min(F.struct("doc_id", "component")).alias("head"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("entries"),
        )
        .where("low < high")
        .select("v", "entries", F.col("head.component").alias("head_component"))
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    keep = Kept(docs.sparkSession)
    found = keep.table(retained(docs, width), "retained")
    full = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["d1", "d2", "n_shingles"]
    equal = full.groupBy(*same).agg(F.min("doc_id").alias("class"))
    classes = keep.table(
        full.select("doc_id", *same).join(equal, same).select("doc_id", "class").distinct(), "classes"
    )
    alone = classes.where("doc_id = class").select("doc_id")
    reps = keep.table(
        full.join(alone, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(
            "doc_id", "n_shingles", "kept"
        ),
        "sketches",
    )
    sketches = reps.select("doc_id", "kept")
    listed = keep.table(lists(reps), "lists")
    fits = f"100 * least(n, {{0}}) >= {percent} * greatest(n, {{0}})"
    # a document has at most RAREST rows here
    best = keep.table(
        listed.where("doc_id <> head AND " + fits.format("head_n"))
        .repartition("doc_id")
        .groupBy("doc_id", "head")
        .agg((-F.count("*")).alias("shared"))
        .groupBy("doc_id")
        .agg(F.min(F.struct("shared", "head")).alias("best"))
        .select(F.col("best.head").alias("a"), F.col("doc_id").alias("b")),
        "best-heads",
    )
    links = keep.table(_linked(docs, best, sketches, width, percent, keep), "links")
    joined = components(links).toDF("doc_id", "component")
    members = keep.table(_labelled(listed, joined), "members")
    open_lists = keep.table(_mixed(members), "open-lists")
    others = (
        members.join(open_lists, "v")
        .where("component <> head_component AND " + fits.format("head_n"))
        .select(F.col("head").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
        .join(best, ["a", "b"], "left_anti")
    )
    headed = keep.table(_linked(docs, others, sketches, width, percent, keep), "links")
    if not headed.isEmpty():
        links = links.unionByName(headed)
        joined = components(links).toDF("doc_id", "component")
        still = members.drop("component").join(open_lists, "v", "left_semi")
        members = keep.table(_labelled(still, joined), "members")
        open_lists = keep.table(_mixed(members), "open-lists")
    crowd = keep.table(
        members.join(open_lists.where(F.col("entries") > LONG), "v", "left_semi")
        .select("doc_id", "n", "component")
        .distinct(),
        "crowd-members",
    )
    # pairs with the head have been tried; each of the others is tried from its smaller document
    short = members.join(open_lists.where(F.col("entries") <= LONG), "v", "left_semi")
    other = short.select(
        "v", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb")
    )
    second = (
        short.where("doc_id <> head")
        .join(other, "v")
        .where("doc_id < b AND component <> cb AND " + fits.format("nb"))
        .select(F.col("doc_id").alias("a"), "b")
        .unionByName(crowd_pairs(docs, crowd, width, percent, keep))
        .distinct()
    )
    more = keep.table(_linked(docs, second, sketches, width, percent, keep), "links")
    if not more.isEmpty():
        joined = components(links.unionByName(more)).toDF("doc_id", "component")
    keep.drop_all_but("retained", "classes")
    ids = classes.join(joined.toDF("class", "component"), "class", "left").select(
        "doc_id", F.coalesce("component", "class").alias("component")
    )
    return (
        found.select("doc_id", "n_shingles")
        .join(ids, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        )
    )


def _linked(
    docs: DataFrame, pairs: DataFrame, sketches: DataFrame, width: int, percent: int, keep: Kept
) -> DataFrame:
    """The pairs that are links: estimated first, then confirmed on the sets of what is left."""
    left = keep.table(likely(pairs, sketches, percent), "pairs")
    if left.isEmpty():
        return left
    wanted = left.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return confirmed(left, keep.table(full_sets(docs, wanted, width), "sets"), percent)


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stay, with all their columns: those whose doc_id is their component's smallest."""
    gone = near_duplicates(docs, width, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
