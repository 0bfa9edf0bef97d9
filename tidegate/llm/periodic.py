"""Periodic runs of words: stretches that repeat a block, found by splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words and at least two
periods long, that no neighbouring word extends. Words are the stretches without ASCII white space.

Recursive frequency splitting comes first. Each word of a run has an equal word one period further
on or back, so a word that occurs only once in its segment is in no run: it splits the segment. What is
left is counted again, segment by segment, and segments too short for a run go. It recurs until a
round takes off less than a hundredth of the words still held; what a further round could take off
costs the scan a little time and changes no result.

The lag scan finds the runs of what survives. A run of period q matches itself at lag q over at
least max(q, ``least`` - q) words, and so over the whole of some block of half that length, if blocks
follow each other without gaps. For each lag only these blocks are compared, by sums of word hashes,
over segments of two lags and more. Of all lags of an octave there are hardly more blocks than words,
so a text of n words takes about n log n steps, however it repeats. A block that matches is extended to
both sides. Stretches found at several lags belong to the smallest one. All runs are compared word by
word in the end; if one is not what its hashes say, the slice is scanned again word by word.

A slice of 1 MB of texts is one array of word numbers, and a longer text is a slice of its own; there is
no loop over documents or words. Missing and empty texts have no word and no run, and rows that
repeat are texts of their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.textbytes import NOT_SPACE, gather, mix, row_of, spans, text_slices

LEAST = 12
SHED = 0.01  # share of the words a round of splitting has to take off for another one
PAIRS = 1 << 21  # blocks compared in one step
ODD = 0x9E3779B97F4A7C15 | 5
SPACE = r"[\x20\x09-\x0D]+"


def word_numbers(data: np.ndarray, offsets: np.ndarray):
    """A number for each word, the same for equal words, with the words' starts, ends and rows."""
    starts, ends, firsts = spans(data, offsets, NOT_SPACE)
    bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    letters = np.ascontiguousarray(data[NOT_SPACE[data]])
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
    )
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, starts, ends, firsts


def split(codes: np.ndarray, rows: np.ndarray, least: int = LEAST):
    """Places of the words that may be in a run, and the number of the segment each is in."""
    at, segment = np.arange(len(codes)), rows
    kinds = int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        length = np.bincount(segment)
        keep = length[segment] >= least
        _, number, often = np.unique(
            segment * kinds + codes[at], return_inverse=True, return_counts=True
        )
        keep &= often[number] > 1
        shed = len(at) - np.count_nonzero(keep)
        if not shed:
            break
        # a word that goes, and a gap that an earlier one left, end a segment
        at, segment = at[keep], segment[keep]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(segment) > 0)
        segment = np.cumsum(new) - 1
        if shed < SHED * (len(at) + shed):
            length = np.bincount(segment) if len(at) else np.zeros(0, int)
            keep = length[segment] >= least
            at, segment = at[keep], segment[keep]
            break
    return at, segment


class Stretch:
    """Segments one after the other, with sums that compare any two pieces of them."""

    def __init__(self, codes: np.ndarray, segment: np.ndarray):
        self.codes = codes
        new = np.r_[True, np.diff(segment) > 0]
        self.first = np.flatnonzero(new)
        self.segment = np.cumsum(new) - 1
        self.last = np.r_[self.first[1:], len(codes)]
        self.powers = np.full(len(codes) + 1, ODD, np.uint64)
        self.powers[0] = 1
        self.powers = np.multiply.accumulate(self.powers)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        values = mix(codes.astype(np.uint64) + np.uint64(1))
        np.cumsum(values * self.powers[:-1], out=self.sums[1:])

    def same(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the words from ``at`` on equal those a lag further, over ``size`` words."""
        one = (self.sums[at + size] - self.sums[at]) * self.powers[lag]
        return one == self.sums[at + lag + size] - self.sums[at + lag]

    def grown(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Over how many words, ``most`` at the utmost, the match goes on from ``at``."""
        size = np.zeros(len(at), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            more = size + step
            able = np.flatnonzero(more <= most)
            begin = at[able] - more[able] if back else at[able] + size[able]
            good = able[self.same(begin, lag[able], np.full(len(able), step))]
            size[good] += step
            step >>= 1
        return size


def lag_scan(stretch: Stretch, least: int = LEAST):
    """Starts, ends and periods of the runs, places counted in the stretch."""
    found = [[], [], []]
    low = 1
    while True:
        long_enough = stretch.last - stretch.first >= max(least, 2 * low)
        if not long_enough.any():
            break
        held = np.flatnonzero(long_enough[stretch.segment])
        part = stretch
        if len(held) < len(stretch.codes):
            part = Stretch(stretch.codes[held], stretch.segment[held])
        longest = int((part.last - part.first).max())
        lags = np.arange(low, min(2 * low, longest // 2 + 1))
        match = np.maximum(least - lags, lags)
        block = (match + 1) // 2
        many = np.maximum(len(part.codes) - lags - block, -1) // block + 1
        for a, b in _chunks(many):
            start, last, lag = _scan(part, lags[a:b], block[a:b], many[a:b], least)
            for out, x in zip(found, (held[start], held[last], lag), strict=True):
                out.append(x)
        low *= 2
    starts, lasts, periods = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    # of a stretch found at several lags the smallest one is the period
    order = np.lexsort((periods, lasts, starts))
    starts, lasts, periods = starts[order], lasts[order], periods[order]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) > 0) | (np.diff(lasts) > 0)
    return starts[new], lasts[new] + 1, periods[new]


def _chunks(many: np.ndarray):
    """Ranges of lags (or runs) that are compared in one step, by how many comparisons each takes."""
    ends = np.cumsum(many)
    a = 0
    while a < len(many):
        before = ends[a - 1] if a else 0
        b = max(int(np.searchsorted(ends, before + PAIRS, "right")), a + 1)
        yield a, b
        a = b


def _scan(part: Stretch, lags: np.ndarray, block: np.ndarray, many: np.ndarray, least: int):
    """First and last places and lags of all stretches that match themselves at these lags."""
    which = np.repeat(np.arange(len(lags)), many)
    number = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    at = number * block[which]
    lag, size = lags[which], block[which]
    inside = part.segment[at] == part.segment[at + lag + size - 1]
    good = np.flatnonzero(inside)
    good = good[part.same(at[good], lag[good], size[good])]
    # blocks of a lag that follow each other in a segment belong to one stretch
    new = np.ones(len(good), bool)
    new[1:] = (np.diff(good) > 1) | (np.diff(which[good]) > 0) | (np.diff(part.segment[at[good]]) > 0)
    good = good[new]
    at, lag, size = at[good], lag[good], size[good]
    own = part.segment[at]
    left = part.grown(at, lag, at - part.first[own], back=True)
    right = part.grown(at + size, lag, part.last[own] - (at + size + lag), back=False)
    start, end = at - left, at + size + right + lag
    keep = end - start >= np.maximum(least, 2 * lag)
    return start[keep], end[keep] - 1, lag[keep]


def holds(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> bool:
    """Whether all runs repeat word by word."""
    size = ends - starts - periods
    for a, b in _chunks(size):
        one = gather(codes, starts[a:b], size[a:b])
        if not np.array_equal(one, gather(codes, starts[a:b] + periods[a:b], size[a:b])):
            return False
    return True


def plain_scan(codes: np.ndarray, segment: np.ndarray, least: int = LEAST):
    """As ``lag_scan``, comparing all words at all lags."""
    best: dict[tuple[int, int], int] = {}
    for lag in range(1, int(np.bincount(segment).max(initial=0)) // 2 + 1):
        same = (codes[:-lag] == codes[lag:]) & (segment[:-lag] == segment[lag:])
        edge = np.diff(np.r_[False, same, False].astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            # a match does not go on into the next segment
            if b - a + lag >= max(least, 2 * lag) and segment[a] == segment[b + lag - 1]:
                best.setdefault((int(a), int(b + lag)), lag)
    found = sorted((a, b, q) for (a, b), q in best.items())
    return tuple(np.array([x[k] for x in found], np.int64) for k in range(3))


def runs(codes: np.ndarray, rows: np.ndarray, least: int = LEAST):
    """Starts, ends and periods of all runs, by start and period; no run crosses rows."""
    at, segment = split(codes, rows, least)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    own = codes[at]
    starts, ends, periods = lag_scan(Stretch(own, segment), least)
    if not holds(own, starts, ends, periods):
        starts, ends, periods = plain_scan(own, segment, least)
    starts, ends = at[starts], at[ends - 1] + 1
    order = np.lexsort((periods, starts))
    return starts[order], ends[order], periods[order]


def _kept_text(data, starts, ends, firsts, dropped) -> pa.Array:
    """The kept words of each row, joined by one space."""
    keep = ~dropped
    starts, ends, row = starts[keep], ends[keep], row_of(firsts)[keep]
    sizes = ends - starts + 1
    out = gather(np.r_[data, np.uint8(0x20)], starts, sizes)
    stops = np.cumsum(sizes)
    out[stops - 1] = 0x20
    # the space behind a row's last word goes
    words = np.bincount(row, minlength=len(firsts) - 1)
    last = stops[np.cumsum(words)[words > 0] - 1] - 1 if len(stops) else stops
    stay = np.ones(len(out), bool)
    stay[last] = False
    length = np.bincount(row, weights=sizes, minlength=len(firsts) - 1).astype(np.int64)
    length[words > 0] -= 1
    bounds = np.r_[0, np.cumsum(length)]
    return pa.Array.from_buffers(
        pa.large_string(), len(length), [None, pa.py_buffer(bounds), pa.py_buffer(out[stay])]
    ).cast(pa.string())


def _described(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, least: int):
    codes, starts, ends, firsts = word_numbers(data, offsets)
    row = row_of(firsts)
    begin, end, period = runs(codes, row, least)
    change = np.bincount(begin + period, minlength=len(codes) + 1) - np.bincount(
        end, minlength=len(codes) + 1
    )
    dropped = np.cumsum(change)[: len(codes)] > 0
    owner = row[begin]
    fields = [begin - firsts[owner], end - begin, period]
    described = pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int64)) for x in fields], ["start", "length", "period"]
    )
    bounds = np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            rows.column(0),
            pa.array(np.diff(firsts).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(bounds), described),
            _kept_text(data, starts, ends, firsts, dropped),
        ],
        ["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length and period, by start and period) and collapsed: the
    text without the words that a run has beyond its first period, joined by one space."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                yield _described(rows, data, offsets, least)

    return docs.select("doc_id", "text").mapInArrow(
        find,
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
        "collapsed string",
    )


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; one of ten texts, by the crc32 of doc_id, repeats a block from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = h % 10 == 0
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    cut = (
        docs.select("doc_id", "text", hit.alias("_hit"), F.floor(h / 10).alias("_g"))
        .withColumn("_words", F.when(F.col("_hit"), words))
        .withColumn("_n", F.size("_words"))
        .withColumn("_a", (F.col("_g") % F.greatest("_n", F.lit(1))).cast("int"))
        .withColumn(
            "_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")
        )
    )
    rest = F.col("_n") - F.col("_a")
    block = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    repeated = F.flatten(F.array_repeat(block, F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(
        F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(repeated, F.lit(1), rest)), " "
    )
    return cut.select(
        "doc_id", F.when(F.col("_hit") & (F.col("_n") > 0), text).otherwise(F.col("text")).alias("text")
    )


def digests(found: DataFrame) -> DataFrame:
    """The number of runs, the greatest one, and digests of all runs and of the collapsed text."""
    run = F.col("runs")
    # the greatest length, then the smallest start and period, is the least of these
    best = F.array_min(
        F.transform(
            run,
            lambda r: F.struct(
                (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")
            ),
        )
    )
    lines = F.transform(
        run,
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.shorter) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
