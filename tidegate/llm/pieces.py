"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces come from a public model file, which is only read. It holds merge ranks instead of
probabilities; the log score of a piece is that of its rank under Zipf's law. A character that no
piece covers costs ``UNKNOWN_COST`` below the worst piece and becomes its bytes' own pieces.

The space is the whitespace marker: a text gets one in front, decoding takes it off again. A marker
character that stands in the text itself is encoded as bytes, so decoding gives every text back.

No piece holds a marker behind another character. The best path therefore falls apart before each
run of spaces, and one path for each distinct run-and-word of a slice of rows is enough.

Missing and empty texts have no pieces. All columns of the input are kept; a column of the input
that has the name of a new one is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.textbytes import gather, span_hashes, text_slices

MARKER = "▁"
UNKNOWN_COST = 10.0
SHORT = 64  # bytes; the paths of longer runs are found one by one
FEW = 16_000  # distinct runs handled at once


@dataclass
class Pieces:
    """The double array and what each piece stands for."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    unknown: float
    byte_id: np.ndarray
    text: np.ndarray
    text_start: np.ndarray
    text_length: np.ndarray


def double_array(words: dict[bytes, int]):
    """base, check and the word's number of each state; state 0 is the root.

    From state s, byte c leads to t = base[s] + c where check[t] = s.
    """
    children: list[dict[int, int]] = [{}]
    number = [-1]
    for word, k in words.items():
        node = 0
        for c in word:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                number.append(-1)
            node = children[node][c]
        number[node] = k
    size = 2 * len(children) + 1024
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    piece, free = np.full(size, -1, np.int32), np.ones(size, bool)
    free[0], state = False, {0: 0}
    # single children are tried from low on, several from wide on; every code fits behind 256
    low, wide, queue = 256, 256, [0]
    for node in queue:  # grows as it is read: breadth first
        codes = np.array(sorted(children[node]), np.int64)
        if not len(codes):
            continue
        while not free[low]:
            low += 1
        at = low if len(codes) == 1 else wide  # the first code's slot
        tries = 0
        while True:
            tries += 1
            slots = at - codes[0] + codes
            if slots[-1] >= size:
                more = size
                size += more
                base = np.concatenate([base, np.zeros(more, np.int32)])
                check = np.concatenate([check, np.full(more, -1, np.int32)])
                piece = np.concatenate([piece, np.full(more, -1, np.int32)])
                free = np.concatenate([free, np.ones(more, bool)])
            if free[slots].all():
                break
            ahead = free[at + 1 : at + 513]
            at += 1 + (int(np.argmax(ahead)) if ahead.any() else len(ahead))
        if tries > 20:
            wide = max(wide, at)
        base[state[node]] = at - codes[0]
        for c, slot in zip(codes.tolist(), slots.tolist(), strict=True):
            child = children[node][c]
            state[child], check[slot], piece[slot] = slot, state[node], number[child]
            free[slot] = False
            queue.append(child)
    room = np.zeros(256, np.int32)
    return (
        np.concatenate([base, room]),
        np.concatenate([check, room - 1]),
        np.concatenate([piece, room - 1]),
    )


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """The pieces of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    words, texts, byte_id = {}, [], np.zeros(256, np.int32)
    ranks = np.zeros(model.get_piece_size())
    for k in range(model.get_piece_size()):
        name, text = model.id_to_piece(k), b""
        if model.is_byte(k):
            byte_id[int(name[3:5], 16)] = k
            text = bytes([int(name[3:5], 16)])
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            if MARKER in name.lstrip(MARKER) or " " in name:
                raise ValueError(f"piece {name!r} holds a marker behind another character")
            text = name.replace(MARKER, " ").encode()
            words[text] = k
            ranks[k] = -model.get_score(k)
        texts.append(text)
    score = -np.log(ranks + 2.0)
    score -= np.log(np.exp(score[list(words.values())]).sum())
    lengths = np.array([len(x) for x in texts])
    base, check, piece = double_array(words)
    return Pieces(
        base,
        check,
        piece,
        score,
        float(score[list(words.values())].min()) - UNKNOWN_COST,
        byte_id,
        np.frombuffer(b"".join(texts), np.uint8),
        np.cumsum(lengths) - lengths,
        lengths,
    )


def _edges(p: Pieces, data, chars, limits):
    """(start, length, piece) of every piece found at a character; -1 where bytes must stand in."""
    found, at, state, limit, depth = [], chars, np.zeros(len(chars), np.int32), limits, 0
    lead = data[chars]
    width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    width = np.minimum(width, limits - chars)
    single = np.zeros(len(data) + 1, bool)
    widths = np.zeros(len(data) + 1, np.int64)
    widths[chars] = width
    while len(at):
        following = p.base[state] + data[at + depth]
        ok = p.check[following] == state
        at, state, limit = at[ok], following[ok], limit[ok]
        depth += 1
        piece = p.piece[state]
        hit = piece >= 0
        ends = at[hit]
        found.append((ends, np.full(len(ends), depth), piece[hit]))
        single[ends[widths[ends] == depth]] = True
        more = at + depth < limit
        at, state, limit = at[more], state[more], limit[more]
    bare = ~single[chars]
    found.append((chars[bare], width[bare], np.full(int(bare.sum()), -1, np.int32)))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def best_paths(p: Pieces, data: np.ndarray, offsets: np.ndarray):
    """The ids of the best path of each run of bytes, run after run, and the ids of each."""
    runs = len(offsets) - 1
    lengths = np.diff(offsets)
    run_of = np.repeat(np.arange(runs), lengths)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    start, length, piece = _edges(p, data, chars, offsets[1:][run_of[chars]])
    run = run_of[start]
    score = np.where(piece >= 0, p.score[piece], p.unknown)
    source = start + run  # runs keep one node more than they have bytes
    nodes = len(data) + runs
    best = np.full(nodes + 1, -np.inf)
    best[offsets[:-1] + np.arange(runs)] = 0.0
    back, via = np.zeros(nodes + 1, np.int64), np.full(nodes + 1, -1, np.int32)
    place = start - offsets[run]
    short = lengths[run] <= SHORT
    few = np.flatnonzero(short)
    key = (place[few] * (SHORT + 1) + length[few]).astype(np.int16)
    few = few[np.argsort(key, kind="stable")]
    cuts = np.flatnonzero(np.diff(np.sort(key, kind="stable"))) + 1
    for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(few)], strict=True):
        now = few[low:high]
        if not len(now):
            continue
        to = source[now] + length[now]
        value = best[source[now]] + score[now]
        better = value > best[to]
        to, now = to[better], now[better]
        best[to], back[to], via[to] = value[better], length[now], piece[now]
    rest = np.flatnonzero(~short)
    rest = rest[np.lexsort((length[rest], source[rest]))]
    for s, n, v, k in zip(
        source[rest].tolist(),
        length[rest].tolist(),
        score[rest].tolist(),
        piece[rest].tolist(),
        strict=True,
    ):
        if best[s] + v > best[s + n]:
            best[s + n], back[s + n], via[s + n] = best[s] + v, n, k
    node = offsets[1:] + np.arange(runs)
    first = offsets[:-1] + np.arange(runs)
    which, seen = np.flatnonzero(node > first), []
    node = node[which]
    while len(node):
        size = back[node]
        seen.append((node - size, which, via[node], size))
        node = node - size
        more = node > first[which]
        node, which = node[more], which[more]
    if not seen:
        return np.zeros(0, np.int32), np.zeros(runs, np.int64)
    source, which, piece, size = [np.concatenate(x) for x in zip(*seen, strict=True)]
    order = np.argsort(source)
    source, which, piece, size = source[order], which[order], piece[order], size[order]
    n = np.where(piece >= 0, 1, size)
    ids = np.repeat(piece, n)
    raw = np.repeat(piece < 0, n)
    bare = piece < 0
    ids[raw] = p.byte_id[gather(data, (source - which)[bare], size[bare])]
    return ids, np.bincount(which, weights=n, minlength=runs).astype(np.int64)


def encode_slice(p: Pieces, data: np.ndarray, offsets: np.ndarray):
    """All ids of the rows of a slice, row after row, and the offsets of the rows among them."""
    filled = np.flatnonzero(np.diff(offsets))
    marked = np.insert(data, offsets[filled], 0x20)
    starts = offsets[filled] + np.arange(len(filled))
    edge = np.zeros(len(marked), bool)
    edge[starts] = True
    space = marked == 0x20
    after = np.r_[False, space[:-1]]
    cuts = np.flatnonzero(space & (~after | edge))
    ends = np.r_[cuts[1:], len(marked)].astype(np.int64)
    ends = ends[: len(cuts)]
    _, where, which = np.unique(
        span_hashes(marked, cuts, ends), return_index=True, return_inverse=True
    )
    parts, counts = [], []
    for low in range(0, len(where), FEW):
        now = where[low : low + FEW]
        size = ends[now] - cuts[now]
        ids, n = best_paths(p, gather(marked, cuts[now], size), np.r_[0, np.cumsum(size)])
        parts.append(ids)
        counts.append(n)
    if not parts:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    ids, n = np.concatenate(parts), np.concatenate(counts)
    begins = np.cumsum(n) - n
    each = n[which]
    upto = np.r_[0, np.cumsum(each)]
    bounds = np.full(len(offsets), 0, np.int64)
    at = np.searchsorted(cuts, starts)
    bounds[filled + 1] = np.diff(np.r_[upto[at], upto[-1]])
    return gather(ids, begins[which], each), np.cumsum(bounds)


def decode_slice(p: Pieces, ids: np.ndarray, bounds: np.ndarray):
    """Bytes of the rows' texts and their offsets; each text loses its first marker."""
    length = p.text_length[ids]
    data = gather(p.text, p.text_start[ids], length)
    ends = np.r_[0, np.cumsum(length)][bounds]
    first = ends[:-1][np.diff(ends) > 0]
    first = first[data[first] == 0x20]
    gone = np.zeros(len(data), bool)
    gone[first] = True
    return data[~gone], ends - np.r_[0, np.cumsum(gone)][ends]


def _schema(df: DataFrame, *more: T.StructField) -> T.StructType:
    new = {f.name.lower() for f in more}
    return T.StructType([f for f in df.schema if f.name.lower() not in new] + list(more))


def encode(docs: DataFrame, model: str, ids: str = "pieces") -> DataFrame:
    """The documents with the ids of their texts as an array of integers."""
    schema = _schema(docs, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False))
    keep = [f.name for f in schema][:-1]
    source = docs.select(*[F.col(f"`{k}`") for k in keep])
    if "text" not in keep:
        raise ValueError("the documents need a column text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(model)
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                found, bounds = encode_slice(p, data, offsets)
                array = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(found, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(k) for k in range(len(keep))], array], [*keep, ids]
                )

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids: str = "pieces", text: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for; a missing list gives a missing text."""
    schema = _schema(encoded, T.StructField(text, T.StringType()))
    keep = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()])
            found = column.flatten().to_numpy(zero_copy_only=False)
            data, ends = decode_slice(p, found, np.r_[0, np.cumsum(sizes)].astype(np.int64))
            raw = data.tobytes()
            texts = [
                None if gone else raw[a:b].decode("utf-8", "replace")
                for a, b, gone in zip(
                    ends[:-1].tolist(), ends[1:].tolist(), column.is_null().to_pylist(), strict=True
                )
            ]
            held = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*held, pa.array(texts, pa.string())], [*keep, text])

    return encoded.mapInArrow(run, schema)


def _same(data, offsets, back, ends) -> np.ndarray:
    """Whether each row's decoded bytes are those it had."""
    if np.array_equal(ends, offsets) and np.array_equal(back, data):
        return np.ones(len(offsets) - 1, bool)
    text, want = back.tobytes(), data.tobytes()
    return np.array(
        [
            text[a:b] == want[c:d]
            for a, b, c, d in zip(ends[:-1], ends[1:], offsets[:-1], offsets[1:], strict=True)
        ]
    )


def encode_checked(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, pieces, and whether they decode to the text (same)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(model)
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                ids, bounds = encode_slice(p, data, offsets)
                back, ends = decode_slice(p, ids, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32())
                        ),
                        pa.array(_same(data, offsets, back, ends)),
                    ],
                    ["doc_id", "n_pieces", "pieces", "same"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_pieces long, pieces array<int>, same boolean"
    )


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Encodes and decodes every text in one pass and returns figures instead of the lists.

    doc_id, n_pieces, n_bytes (pieces that stand for single bytes), ids_crc32 (of the ids as
    little-endian 32-bit integers), text_crc32 (of the decoded text), same (it is the text).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = load(model)
        bare = np.zeros(len(p.text_length), bool)
        bare[p.byte_id] = True
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                ids, bounds = encode_slice(p, data, offsets)
                back, ends = decode_slice(p, ids, bounds)
                raw, text = memoryview(ids.astype("<i4").tobytes()), memoryview(back.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(np.diff(bounds)),
                        pa.array(np.diff(np.r_[0, np.cumsum(bare[ids])][bounds])),
                        pa.array(
                            [
                                zlib.crc32(raw[4 * a : 4 * b])
                                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                            ],
                            pa.int64(),
                        ),
                        pa.array(
                            [
                                zlib.crc32(text[a:b])
                                for a, b in zip(ends[:-1], ends[1:], strict=True)
                            ],
                            pa.int64(),
                        ),
                        pa.array(_same(data, offsets, back, ends)),
                    ],
                    ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "text_crc32", "same"],
                )

    schema = (
        "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, text_crc32 long, same boolean"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
