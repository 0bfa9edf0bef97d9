"""Words of Arrow text columns as numpy arrays: spans and hashes, without a Python object per word.

A text column is one UTF-8 buffer with offsets. The helpers below find the words of a whole slice of
rows at once and hash each span, so the cost of a word is a few vector steps. Missing texts count as
empty. Slices are bounded by bytes; a single longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15 | 5
MASK = (1 << 64) - 1
ASCII_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that holds for the bytes of the ranges, ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WORD_BYTES = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator:
    """(slice of the batch, bytes, offsets) for runs of rows of at most ``limit`` bytes of text.

    ``offsets`` has one entry more than the slice has rows and counts from the slice's first byte.
    """
    column = batch.column(batch.schema.get_field_index(text))
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = offsets[first], offsets[last]
        yield (
            batch.slice(first, last - first),
            data[low:high],
            offsets[first : last + 1] - low,
        )
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts and ends of the runs of bytes that ``inside`` accepts, and each row's first run.

    Runs end at the end of their row. The third array has one entry more than there are rows.
    """
    held = np.zeros(len(data) + 2, bool)
    held[1:-1] = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = held[:-1], held[1:]
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _powers_to(n: int):
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, min(2 * len(_powers), SLICE_BYTES + 1))
        base = np.full(size, MULTIPLIER, np.uint64)
        base[0] = 1
        _powers = np.multiply.accumulate(base)
        base[1:] = pow(MULTIPLIER, -1, 1 << 64)
        _inverses = np.multiply.accumulate(base)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them well."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal wherever the span stands."""
    powers, inverses = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def row_of(firsts: np.ndarray) -> np.ndarray:
    """The row of each span, from each row's first span."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values of many ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]


def with_columns(rows: pa.RecordBatch, keep: list[str], **more) -> pa.RecordBatch:
    """The kept columns of the rows and new ones."""
    names = [*keep, *more]
    held = [rows.column(rows.schema.get_field_index(k)) for k in keep]
    return pa.RecordBatch.from_arrays(
        [*held, *[x if isinstance(x, pa.Array) else pa.array(x) for x in more.values()]], names
    )
