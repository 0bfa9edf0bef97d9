"""Toxicity by class-conditional Kneser-Ney models.

From labelled documents a toxic and an ordinary model are estimated, with four orders: a word after
its predecessor, the word alone, the word's beginning, and continuation counts. In a class of N
counts, what was counted n times has the share (n - DISCOUNT) / N, and what the discount leaves
goes to the next lower order. A word or pair counts once for each document that holds it, so with a
discount of 1 what one document alone says is left to the backoff.

The lowest order is shared by the classes: in how many different ways a word is preceded anywhere in
the corpus, labelled or not. These are exact counts of distinct pairs, made in Spark from every
document, for the words that two labelled documents of a class hold; of other words the lowest
order is the same in both classes and cancels out. Words of unknown beginning say nothing.

A text's score comes from the difference of both log-likelihoods divided by length, of the whole
text and of its most toxic stretches, by a logistic curve fitted on labelled documents that the
counts have not seen: the gain of words, the greatest gain of 2 and of 8 words in a row, and what pairs add
to their words, on the whole and at the most toxic place.

Counts by class come from at most ``max_labelled`` labelled documents, half of them of each class at
most; continuation counts from all. Pairs are counted under hashes of 64 bits, continuation pairs
under 40, which confuse fewer than one in 20,000 of as many as 10^8 words before a word. Missing and empty texts score like a text
without evidence. Without labelled documents of both classes every score is 0. Rows may repeat;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import Kept, kept_table, label_sample, with_labels
from tidegate.llm.textbytes import LOWER, WORD_BYTES, mix, row_of, span_hashes, spans, text_slices

PREFIX = 5  # bytes
STRETCHES = (2, 8)  # words
MAX_LABELLED = 20_000
DISCOUNT = 1.0
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
START = np.uint64(1)  # stands before a text's first word
HEAD, WORD, PAIR = 0, 1, 2
PAIR_BITS = 40  # of the word before
FLUSH = 6_000_000  # pairs a task holds before it passes them on
NAMES = ("mean_gain", "top_gain", "long_gain", "mean_pair", "top_pair")


def _read(data: np.ndarray, offsets: np.ndarray):
    """Hashes of words, of their beginnings and of the words before them, and each row's first word."""
    low = LOWER[data]
    starts, ends, firsts = spans(low, offsets, WORD_BYTES)
    words = span_hashes(low, starts, ends)
    heads = span_hashes(low, starts, np.minimum(ends, starts + PREFIX))
    before = np.r_[START, words[:-1]]
    before[firsts[:-1][np.diff(firsts) > 0]] = START
    return words, heads, before, firsts


def pair_hash(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x2545F4914F6CDD1D) + words)


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def class_counts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """kind, before and of (hashes), ordinary and toxic: labelled documents that hold each beginning
    (of), each word (of) with its beginning (before), and each word (of) behind its predecessor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                words, heads, before, firsts = _read(data, offsets)
                if not len(words):
                    continue
                row = row_of(firsts)
                label = rows.column(2).to_numpy(zero_copy_only=False)
                nothing = np.zeros(len(words), np.uint64)
                for kind, (one, two, key) in enumerate(
                    ((nothing, heads, heads), (heads, words, words), (before, words, None))
                ):
                    key = pair_hash(before, words) if key is None else key
                    # each once for a row; then rows are added up by class
                    order = np.lexsort((row, key))
                    key, own = key[order], row[order]
                    once = np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])]
                    key, toxic, order = key[once], label[own[once]] == 1, order[once]
                    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    at = order[new]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), kind, np.int8)),
                            *[pa.array(x[at].view(np.int64)) for x in (one, two)],
                            *[
                                pa.array(np.add.reduceat(x.astype(np.int32), new).astype(np.int32))
                                for x in (~toxic, toxic)
                            ],
                        ],
                        ["kind", "before", "of", "ordinary", "toxic"],
                    )

    return (
        with_labels(docs, sample)
        .where("label IS NOT NULL")
        .mapInArrow(run, "kind byte, before long, of long, ordinary int, toxic int")
        .groupBy("kind", "before", "of")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    )


def continuations(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """at (the place in ``known``, sorted hashes) and n, the number of distinct words before it."""
    bits = min(PAIR_BITS, 64 - max(int(len(known) - 1).bit_length(), 1))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        own, rest = np.uint64(bits), np.uint64(64 - bits)
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                words, _, before, _ = _read(data, offsets)
                at, found = place(sent.value, words)
                pair = (at[found].astype(np.uint64) << own) | (mix(before[found]) >> rest)
                held.append(np.unique(pair))
                if sum(map(len, held)) > FLUSH:
                    held = [np.unique(np.concatenate(held))]
                    if len(held[0]) > FLUSH // 2:
                        yield from _in_parts(held.pop())
        if held:
            yield from _in_parts(np.unique(np.concatenate(held)))

    return (
        docs.select("text")
        .mapInArrow(run, "pair long")
        .distinct()
        .groupBy(F.shiftrightunsigned("pair", bits).alias("at"))
        .agg(F.count("*").alias("n"))
    )


def _in_parts(pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted pairs as batches; in this order they take half the room in a shuffle."""
    for low in range(0, len(pairs), 100_000):
        part = pairs[low : low + 100_000].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(part)], ["pair"])


def place(known: np.ndarray, hashes: np.ndarray):
    """Where the hashes stand in the sorted ``known`` ones, and whether they do."""
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    return at, (known[at] == hashes) if len(known) else np.zeros(len(hashes), bool)


def class_sample(labels: DataFrame, bound: int) -> DataFrame:
    """doc_id and label of labelled documents, at most half of ``bound`` of each class."""
    rows = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    classes = [label_sample(rows.where(F.col("toxic") == c), "toxic", bound // 2) for c in (0, 1)]
    return classes[0].unionByName(classes[1])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict | None:
    """Gains of beginnings, words, predecessors and pairs; None without both classes.

    What comes to the driver is bounded by the labelled sample: pairs, words and beginnings that two
    of its documents hold, and totals.
    """
    train = labels.where((fold() != HELD_OUT) & (fold() != CALIBRATION))
    kept = Kept(docs.sparkSession)
    found = kept.table(class_counts(docs, class_sample(train, max_labelled)), "class-counts")
    often = (F.col("ordinary") > 1) | (F.col("toxic") > 1)
    totals = found.groupBy("kind").agg(
        *[F.sum(c).alias(c) for c in ("ordinary", "toxic")],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in ("ordinary", "toxic")],
    )
    totals = {r.kind: r for r in totals.collect()}
    if WORD not in totals or not totals[WORD].ordinary or not totals[WORD].toxic:
        kept.drop_all_but()
        return None
    words = _columns(found.where((F.col("kind") == WORD) & often), "before", "of", "ordinary", "toxic")
    words = _sorted(words, "of")
    heads, of = np.unique(words["before"], return_inverse=True)
    seen = _columns(found.where(F.col("kind") == HEAD), "of", "ordinary", "toxic")
    at, known = place(heads, seen["of"])
    # predecessors of whose pairs one at least counts; of others the backoff is the same
    pairs = found.where(F.col("kind") == PAIR)
    context = pairs.groupBy("before").agg(
        *[F.sum(c).alias(c) for c in ("ordinary", "toxic")],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in ("ordinary", "toxic")],
        F.max(often).alias("often"),
    )
    context = _columns(
        context.where("often"), "before", "ordinary", "toxic", "ordinary_kinds", "toxic_kinds"
    )
    context = _sorted(context, "before")
    pairs = _columns(pairs.where(often), "before", "of", "ordinary", "toxic")
    pairs = _sorted(pairs | {"key": pair_hash(pairs["before"], pairs["of"])}, "key")
    behind, _ = place(words["of"], pairs["of"])
    after, _ = place(context["before"], pairs["before"])
    kept.drop_all_but()
    cont = np.ones(len(words["of"]))
    ways = _columns(continuations(docs, words["of"]), "at", "n")
    cont[ways["at"]] = ways["n"]
    begun = np.bincount(of, weights=cont, minlength=len(heads))
    log: dict[str, list[np.ndarray]] = {k: [] for k in ("head", "new", "word", "context", "pair")}
    for c in ("ordinary", "toxic"):
        n = np.zeros(len(heads))
        n[at[known]] = seen[c][known]
        size, kinds = float(totals[HEAD][c]), float(totals[HEAD][f"{c}_kinds"])
        head = np.maximum(n - DISCOUNT, 0) / size + DISCOUNT * kinds / size * begun / begun.sum()
        size, kinds = float(totals[WORD][c]), float(totals[WORD][f"{c}_kinds"])
        left = DISCOUNT * kinds / size
        word = np.maximum(words[c] - DISCOUNT, 0) / size + left * head[of] * cont / begun[of]
        with np.errstate(divide="ignore", invalid="ignore"):
            held = context[c].astype(float)
            back = np.where(held > 0, DISCOUNT * context[f"{c}_kinds"] / held, 1.0)
            share = np.where(held[after] > 0, np.maximum(pairs[c] - DISCOUNT, 0) / held[after], 0.0)
        log["head"].append(np.log(left * head))  # of a word not counted itself
        log["word"].append(np.log(word))
        log["context"].append(np.log(back))
        log["pair"].append(np.log(share + back[after] * word[behind]))
    gain = {k: (v[1] - v[0]).astype(np.float32) for k, v in log.items() if v}
    return {
        "head": (heads, gain["head"]),
        "word": (words["of"], gain["word"]),
        "context": (context["before"], gain["context"]),
        "pair": (pairs["key"], gain["pair"] - gain["word"][behind]),
    }


def _columns(df: DataFrame, *names: str) -> dict[str, np.ndarray]:
    """Columns of a bounded frame; hashes as unsigned numbers."""
    table = df.select(*names).toArrow()
    out = {k: table.column(k).to_numpy() for k in names}
    return {k: v.view(np.uint64) if k in ("before", "of") else v for k, v in out.items()}


def _sorted(columns: dict[str, np.ndarray], key: str) -> dict[str, np.ndarray]:
    order = np.argsort(columns[key])
    return {k: v[order] for k, v in columns.items()}


def gains(model: dict, words: np.ndarray, heads: np.ndarray, before: np.ndarray):
    """The gain of each word, and what its predecessor adds."""

    def look(name: str, hashes: np.ndarray):
        known, gain = model[name]
        at, found = place(known, hashes)
        return (np.where(found, gain[at], 0) if len(known) else np.zeros(len(hashes))), found

    single, counted = look("word", words)
    single = np.where(counted, single, look("head", heads)[0])
    added, paired = look("pair", pair_hash(before, words))
    return single, np.where(paired, added, look("context", before)[0])


def features(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_words and the log-likelihood differences of ``NAMES``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                words, heads, before, firsts = _read(data, offsets)
                n, row = np.diff(firsts), row_of(firsts)
                some = np.flatnonzero(n)
                out = []
                for gain, sizes in zip(
                    gains(sent.value, words, heads, before), (STRETCHES, (1,)), strict=True
                ):
                    total = np.r_[0.0, np.cumsum(gain.astype(np.float64))]
                    out.append((total[firsts[1:]] - total[firsts[:-1]]) / np.maximum(n, 1))
                    for size in sizes:
                        # stretches end at every word; in its first words a text has shorter ones
                        end = np.arange(1, len(words) + 1)
                        begin = np.maximum(end - size, firsts[row])
                        mean = (total[end] - total[begin]) / np.minimum(size, n[row])
                        top = np.zeros(len(rows))
                        if len(some):
                            top[some] = np.maximum.reduceat(mean, firsts[some])
                        out.append(top)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n), *map(pa.array, out)], ["doc_id", "n_words", *NAMES]
                )

    kinds = ", ".join(f"{name} double" for name in NAMES)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_words long, {kinds}")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve, the intercept last; the rarer class weighs somewhat more."""
    x = np.c_[x, np.ones(len(x))]
    each = np.sqrt(len(y) / np.where(y == 1, max(y.sum(), 1), max((1 - y).sum(), 1)))
    w, hold = np.zeros(x.shape[1]), ridge * np.r_[np.ones(x.shape[1] - 1), 1e-6]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (each * (p - y)) + hold * w
        step = np.linalg.solve((x.T * (each * p * (1 - p))) @ x + np.diag(hold), gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words and the gains of every document."""
    model = fit(docs, labels, max_labelled)
    held = (fold() == HELD_OUT).alias("held_out")
    if model is None:
        return docs.select(
            "doc_id",
            held,
            F.lit(0.0).alias("score"),
            F.lit(0).alias("predicted"),
            F.lit(0).cast("long").alias("n_words"),
            *[F.lit(0.0).alias(name) for name in NAMES],
        )
    found = kept_table(features(docs, model), "toxicity")
    found = found.withColumn("log_words", F.log1p("n_words"))  # longer texts have higher tops
    names = [*NAMES, "log_words"]
    sample = label_sample(labels.where(fold() == CALIBRATION), "toxic", max_labelled)
    rows = found.join(F.broadcast(sample), "doc_id").select(*names, "label").toArrow()
    x = np.stack([rows.column(k).to_numpy() for k in names], 1)
    y = rows.column("label").to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        middle, scale = x.mean(0), x.std(0) + 1e-9
        w = logistic((x - middle) / scale, y)
        weights, shift = w[:-1] / scale, w[-1] - float((w[:-1] / scale) @ middle)
    else:
        weights, shift = np.array([0.0, 4.0, 0.0, 0.0, 0.0, 0.0]), -4.0
    z = F.lit(float(shift))
    for name, weight in zip(names, weights, strict=True):
        z = z + F.col(name) * float(weight)
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
    found = found.withColumn("score", 1 / (1 + F.exp(-z)))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", held, "score", predicted, "n_words", *NAMES)
