"""Hashed word features of texts, shared by the two model-based operators."""

from __future__ import annotations

import numpy as np

from tidegate.llm.textbytes import LOWER, NOT_SPACE, WORD_BYTES, mix, span_hashes, spans


def lower_words(data: np.ndarray, offsets: np.ndarray):
    """Hashes of the lower-cased words, and each row's first word."""
    low = LOWER[data]
    starts, ends, firsts = spans(low, offsets, WORD_BYTES)
    return span_hashes(low, starts, ends), firsts


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Hashes of the runs of word characters and of the runs of other characters but space."""
    marks = NOT_SPACE & ~WORD_BYTES
    a = spans(data, offsets, WORD_BYTES)
    b = spans(data, offsets, marks)
    starts = np.concatenate([a[0], b[0]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.concatenate([a[1], b[1]])[order]
    return span_hashes(data, starts, ends), a[2] + b[2]


def pair_hashes(hashes: np.ndarray, firsts: np.ndarray):
    """Hashes of neighbouring words and the place of the first of each pair; rows are not crossed."""
    inside = np.ones(max(len(hashes) - 1, 0), bool)
    last = firsts[1:][(firsts[1:] > 0) & (firsts[1:] < len(hashes))] - 1
    inside[last] = False
    at = np.flatnonzero(inside)
    return mix(hashes[at] * np.uint64(0x2545F4914F6CDD1D) + hashes[at + 1]), at


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)
