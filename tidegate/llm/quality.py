"""Quality by importance resampling: documents are drawn by how much likelier the target makes them.

Two generative models over hashed word and word-pair features: the target, from labelled documents
of quality 1, and the raw text, from all documents. A document's log weight is the sum over its
features of the log ratio of both models, its importance weight. Documents are drawn without
replacement by the Gumbel top-k rule: to each log weight a Gumbel number is added that depends on
doc_id and the seed, and the k greatest stay.

The target's counts are smoothed by the raw model, whose weight is the one of ``PRIORS`` that makes
labelled good documents likeliest that were not counted, those of one fold of the labels. k is the number
of documents whose log weight reaches the cut that parts good from bad documents of the same fold best,
where losing a good one counts ``KEEP`` times. With labels of one kind only, everything stays. ``k``
may be given instead.

Features are hashed into 2^16 places. The target comes from a sample of at most ``max_labelled``
labelled documents, raw counts and weights from every document. Missing and empty texts have log
weight 0. Rows that repeat with their doc_id share their fate. The input's columns are kept by
``resample``; those named like a new one are replaced in ``draw``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import kept_table, label_sample, top_k_cut, uniform, with_labels
from tidegate.llm.lm import buckets, pair_hashes, tokens
from tidegate.llm.textbytes import row_of, text_slices

BITS = 16
MAX_LABELLED = 60_000
KEEP = 20.0
SMOOTHING = 0.5
FOLDS, UNSEEN = 5, 4
PRIORS = (1e2, 1e3, 1e4, 1e5, 1e6)  # features that the raw model counts for


def _features(data: np.ndarray, offsets: np.ndarray):
    """Places of all words and pairs, and the row of each."""
    hashes, firsts = tokens(data, offsets)
    pairs, at = pair_hashes(hashes, firsts)
    row = row_of(firsts)
    return np.r_[buckets(hashes, BITS), buckets(pairs, BITS)], np.r_[row, row[at]]


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def log_ratios(docs: DataFrame, good: DataFrame) -> np.ndarray:
    """log(target / raw) of every place; ``good`` has doc_id and whether the model may count it, as
    label 1, or it is to judge the smoothing, as label 0."""
    size = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, size), np.int64)
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                places, row = _features(data, offsets)
                label = rows.column(2).fill_null(-1).to_numpy(zero_copy_only=False)[row]
                held[0] += np.bincount(places, minlength=size)
                for k in (0, 1):
                    held[1 + k] += np.bincount(places[label == 1 - k], minlength=size)
        at = np.flatnonzero(held[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), *[pa.array(x[at]) for x in held]],
            ["place", "raw", "target", "unseen"],
        )

    found = (
        with_labels(docs, good)
        .mapInArrow(run, "place int, raw long, target long, unseen long")
        .groupBy("place")
        .agg(*[F.sum(name).alias(name) for name in ("raw", "target", "unseen")])
        .toArrow()
    )
    counts = np.zeros((3, size))
    for k, name in enumerate(("raw", "target", "unseen")):
        counts[k, found.column("place").to_numpy()] = found.column(name).to_numpy()
    raw = (counts[0] + SMOOTHING) / (counts[0] + SMOOTHING).sum()
    targets = [(counts[1] + m * raw) / (counts[1].sum() + m) for m in PRIORS]
    likelihood = [float(counts[2] @ np.log(target)) for target in targets]
    return np.log(targets[int(np.argmax(likelihood))]) - np.log(raw)


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, n_features and log_weight."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                places, row = _features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.bincount(row, minlength=len(rows)).astype(np.int64)),
                        # without any feature numpy counts in integers
                        pa.array(
                            np.bincount(
                                row, weights=sent.value[places], minlength=len(rows)
                            ).astype(np.float64)
                        ),
                    ],
                    ["doc_id", "n_features", "log_weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_features long, log_weight double"
    )


def best_cut(weight: np.ndarray, label: np.ndarray) -> float:
    """The cut that loses least; minus infinity without both labels.

    Of the gap between the labelled weights that it may lie in, it is the place nearest to 0, where
    a document is as likely by the target as by the raw text.
    """
    good, bad = np.sort(weight[label == 1]), np.sort(weight[label == 0])
    if not len(good) or not len(bad):
        return float("-inf")
    cuts = np.unique(weight)
    lost = np.searchsorted(good, cuts) / len(good)
    kept = 1 - np.searchsorted(bad, cuts) / len(bad)
    k = int(np.argmin(KEEP * lost + kept))
    low, high = cuts[max(k - 1, 0)], cuts[k]
    if low < 0 < high:
        return 0.0
    return float(high if high <= 0 else (low + high) / 2)


def draw(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    seed: int = 17,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """doc_id, n_features, log_weight, gumbel_key and kept of every document."""
    sample = label_sample(labels, "quality", max_labelled)
    counted = (fold() != UNSEEN).cast("int").alias("label")
    ratios = log_ratios(docs, sample.where("label = 1").select("doc_id", counted))
    noise = -F.log(-F.log(uniform(seed, "doc_id")))
    scored = weigh(docs, ratios).withColumn("gumbel_key", F.col("log_weight") + noise)
    scored = kept_table(scored, "quality")
    if k is None:
        judges = sample.where(fold() == UNSEEN)
        known = scored.join(F.broadcast(judges), "doc_id").select("log_weight", "label").toArrow()
        cut = best_cut(*[known.column(c).to_numpy() for c in ("log_weight", "label")])
        k = scored.where(F.col("log_weight") >= cut).count()
    cut = top_k_cut(scored, "gumbel_key", "doc_id", k)
    kept = F.lit(True)
    if cut is not None:
        tie = F.col("doc_id").isNull() if cut[1] is None else (
            F.col("doc_id").isNull() | (F.col("doc_id") <= cut[1])
        )
        kept = (F.col("gumbel_key") > cut[0]) | ((F.col("gumbel_key") == cut[0]) & tie)
    return scored.withColumn("kept", kept)


def resample(docs: DataFrame, labels: DataFrame, **choices) -> DataFrame:
    """The documents that are drawn, with all their columns."""
    gone = draw(docs, labels, **choices).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
