"""Token ids in files of Re-Pair grammars, and their random-access decoding.

Documents are dealt out by ranges of doc_id and sorted, so files and the shards in them follow
ascending doc_id. A shard holds the ids of a bounded run of texts. In each round the pairs of
neighbouring symbols that stand in the shard often are replaced by new symbols; no pair crosses a
document's end. The shard stores the pairs (its rules), the number of ids behind each rule, and the
symbols. Any range of ids of any document is decoded from the symbols that cover it alone.

Layout of a shard, little-endian: the mark ``IDRP``, then unsigned 32-bit version, vocabulary,
documents, rules and symbols; rules as pairs of unsigned symbols; ids per rule (32-bit);
symbols per document (32-bit); ids per document (32-bit); symbols. Symbols have 16 bits in version 1 and
32 in version 2, which vocabularies of more than 65,536 ids take. Symbols from ``vocabulary`` on are
rules. Shards are rows of Parquet files, so Spark's committers write them,
also when tasks are repeated.

Distinct stretches of a slice of texts are encoded once. They are cut only where the vocabulary's
pattern always starts a new token, so the ids are those of the whole texts. With ``added_tokens`` the
tokenizer finds its added tokens in texts, as it does by default, and texts that hold one are encoded
whole; without, their characters are encoded like any others. Missing and empty texts
hold the end id alone. Rows with a missing doc_id come first, repeated doc_ids stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.textbytes import byte_set, gather, span_hashes, text_slices

MARK = b"IDRP"
END_ID = 2
ROUNDS = 3
LEAST = 6  # times a pair must stand in a shard to become a rule
TABLE = 1 << 16
CACHED = 600_000  # stretches a worker remembers
CACHED_IDS = 1 << 23

LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
WHITE = byte_set((0x09, 0x0D), (0x20, 0x20))
HIGH = byte_set((0x80, 0xFF), (0x1C, 0x1F))  # may be white space or not
POINT = ~(LETTER | WHITE | HIGH | byte_set((0x30, 0x39), (0x27, 0x27)))


class Encoder:
    """Ids of texts by a tokenizer file, remembering the stretches it has met."""

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not added_tokens
        added = self.whole.get_added_tokens_decoder().values() if added_tokens else ()
        self.added = [x.content.encode() for x in added if x.content]
        self.vocabulary = self.whole.get_vocab_size(with_added_tokens=True)
        self.merges = Tokenizer(self.whole.model)
        # how the vocabulary writes bytes: printable ones as themselves, the others from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [x for x in range(256) if x not in plain]
        self.shown = {x: 256 + k for k, x in enumerate(other) if x != 0x0A}  # it parts words
        self._forget()

    def _forget(self):
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, hashes: list[int], found: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.slot)
        while len(self.ids) < self.used + len(found):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.start) < first + len(sizes):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.ids[self.used : self.used + len(found)] = found
        ends = self.used + np.cumsum(sizes)
        self.start[first : first + len(sizes)] = ends - sizes
        self.length[first : first + len(sizes)] = sizes
        self.used += len(found)
        self.slot.update(zip(hashes, range(first, first + len(sizes)), strict=True))

    def _learn_words(self, hashes: list[int], words: list[bytes]) -> None:
        """Single words, which the pattern leaves whole: only the merges are applied."""
        found = self.merges.encode(
            b"\n".join(words).decode("latin-1").translate(self.shown).split("\n"),
            is_pretokenized=True,
            add_special_tokens=False,
        )
        sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
        self._learn(hashes, np.array(found.ids, np.int32), sizes)

    def _learn_texts(self, hashes: list[int], texts: list[bytes]) -> None:
        part = self.whole.encode_batch_fast(
            [x.decode("utf-8", "replace") for x in texts], add_special_tokens=False
        )
        found = [x.ids for x in part]
        flat = np.array([k for x in found for k in x], np.int32)
        self._learn(hashes, flat, np.array([len(x) for x in found], np.int64))

    def _rows_with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that may hold the text of an added token."""
        raw, found = data.tobytes(), []
        for text in self.added:
            at = raw.find(text)
            while at >= 0:
                found.append(at)
                at = raw.find(text, at + 1)
        return np.unique(np.searchsorted(offsets, np.array(found, np.int64), "right") - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of all rows, without end ids, and the rows' offsets among them."""
        whole = self._rows_with_added(data, offsets)
        cuts = stretches(data, offsets)
        if len(whole):
            row = np.searchsorted(offsets, cuts, "right") - 1
            cuts = cuts[~np.isin(row, whole) | (cuts == offsets[row])]
        if not len(cuts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.r_[cuts[1:], len(data)]
        known, where, which = np.unique(
            span_hashes(data, cuts, ends), return_index=True, return_inverse=True
        )
        if len(self.slot) + len(known) > CACHED or self.used > CACHED_IDS:
            self._forget()
        hashes = known.tolist()
        new = [k for k, h in enumerate(hashes) if h not in self.slot]
        if new:
            raw = data.tobytes()
            at = where[new]
            begin, end = cuts[at], ends[at]
            odd = np.r_[0, np.cumsum(~word_bytes(data))]
            begin = begin + (data[begin] == 0x20)
            single = (odd[end] == odd[begin]) & (end > begin)
            single &= ~np.isin(cuts[at], offsets[whole])
            texts = [raw[a:b] for a, b in zip(cuts[at].tolist(), end.tolist(), strict=True)]
            for learn, mine in ((self._learn_words, single), (self._learn_texts, ~single)):
                picked = np.flatnonzero(mine).tolist()
                for low in range(0, len(picked), 20_000):
                    part = picked[low : low + 20_000]
                    learn([hashes[new[k]] for k in part], [texts[k] for k in part])
        slots = np.fromiter(map(self.slot.__getitem__, hashes), np.int64, len(hashes))[which]
        sizes = self.length[slots]
        upto = np.r_[0, np.cumsum(sizes)]
        return gather(self.ids, self.start[slots], sizes), upto[np.searchsorted(cuts, offsets)]


@lru_cache(maxsize=1)
def encoder(path: str, added_tokens: bool = False) -> Encoder:
    return Encoder(path, added_tokens)


def word_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters U+00C0 to U+00FF."""
    found = LETTER[data]
    lead = data[:-1] == 0xC3
    second = lead & (data[1:] != 0x97) & (data[1:] != 0xB7)  # the signs for times and divided by
    found[1:] |= second
    found[:-1] |= second
    return found


def stretches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where the pattern always begins a new token, whatever stands elsewhere.

    Row starts; white space behind a plain character, one that is sure not to be white space (a
    token holds white space only in front or alone); a single space between any character beyond
    ASCII and a plain one; what follows a single line break or tab; punctuation behind a letter,
    but for the apostrophe.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    white, letter = WHITE[data], word_bytes(data)
    high = HIGH[data] & ~letter
    plain = ~white & ~high
    cut = edge[:-1].copy()
    cut[1:] |= white[1:] & plain[:-1]
    between = high[:-2] & (data[1:-1] == 0x20) & plain[2:] & ~edge[2:-1]
    cut[1:-1] |= between
    lone = white[1:-1] & (data[1:-1] != 0x20) & (plain[:-2] | edge[1:-2]) & plain[2:]
    cut[2:] |= lone
    cut[1:] |= POINT[data[1:]] & letter[:-1]
    return np.flatnonzero(cut)


def compress(ids: np.ndarray, lengths: np.ndarray, vocabulary: int, rounds: int = ROUNDS) -> bytes:
    """A shard of the documents whose ids stand one after the other in ``ids``."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < vocabulary:
        raise ValueError(f"ids from {ids.min()} to {ids.max()} in a vocabulary of {vocabulary}")
    version, kind, bits = (1, "<u2", 16) if vocabulary <= 1 << 16 else (2, "<u4", 31)
    most = min((1 << bits) - vocabulary, 1 << 16)
    symbols, left = ids.astype(np.int64), lengths.astype(np.int64)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(left)[left > 0] - 1] = True
    rules, sizes = [], [np.ones(vocabulary, np.int64)]
    made = 0
    for turn in range(rounds):
        room = (most - made) // (rounds - turn)
        if len(symbols) < 2 or room < 1:
            break
        keys = (symbols[:-1] << bits) | symbols[1:]
        keys[last[:-1]] = -1
        ordered = np.sort(keys)
        ordered = ordered[np.searchsorted(ordered, 0) :]
        heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[heads, len(ordered)])
        often = np.flatnonzero(counts >= LEAST)
        if not len(often):
            break
        # the most frequent pairs; of equal ones, the smaller symbols
        often = often[np.argsort(-counts[often], kind="stable")][:room]
        pairs = ordered[heads[often]]
        table = np.zeros(TABLE, np.int64)
        place = _place(pairs)
        table[place[::-1]] = np.arange(len(pairs))[::-1]  # the more frequent one holds the place
        chosen = table[_place(keys)]
        at = np.flatnonzero(pairs[chosen] == keys)
        # of matches in a row, every other one
        heads = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        run = np.repeat(heads, np.diff(np.r_[heads, len(at)]))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        used, number = np.unique(chosen[at], return_inverse=True)
        pairs = pairs[used]
        first, second = pairs >> bits, pairs & ((1 << bits) - 1)
        known = np.concatenate(sizes)
        rules.append(np.stack([first, second], 1))
        sizes.append(known[first] + known[second])
        symbols[at] = vocabulary + made + number
        last[at] = last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last[stay]
        made += len(used)
    per_document = np.zeros(len(lengths), np.int64)
    per_document[left > 0] = np.diff(np.r_[-1, np.flatnonzero(last)])
    return b"".join(
        [
            MARK,
            np.array([version, vocabulary, len(lengths), made, len(symbols)], "<u4").tobytes(),
            np.concatenate(rules).astype(kind).tobytes() if rules else b"",
            np.concatenate(sizes)[vocabulary:].astype("<u4").tobytes(),
            per_document.astype("<u4").tobytes(),
            lengths.astype("<u4").tobytes(),
            symbols.astype(kind).tobytes(),
        ]
    )


def _place(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(
        np.int64
    )


class Shard:
    """Decodes a shard, whole or in part."""

    def __init__(self, raw: bytes):
        if raw[:4] != MARK:
            raise ValueError("not a shard of token ids")
        head = np.frombuffer(raw, "<u4", 5, 4)
        if head[0] not in (1, 2):
            raise ValueError(f"unknown version {head[0]}")
        symbol = "<u2" if head[0] == 1 else "<u4"
        self.vocabulary, documents, rules, symbols = (int(x) for x in head[1:])
        at = 24

        def take(kind, n):
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += found.nbytes
            return found

        pairs = take(symbol, 2 * rules).reshape(-1, 2).astype(np.int64)
        sizes = take("<u4", rules).astype(np.int64)
        self.bounds = np.r_[0, np.cumsum(take("<u4", documents).astype(np.int64))]
        self.lengths = take("<u4", documents).astype(np.int64)
        self.symbols = take(symbol, symbols).astype(np.int64)
        # each rule's ids, from rules that stand before it
        self.size = np.r_[np.ones(self.vocabulary, np.int64), sizes]
        self.start = np.r_[np.arange(self.vocabulary), np.zeros(rules, np.int64)]
        self.flat = np.arange(self.vocabulary)
        done = 0
        while done < rules:
            waits = pairs[done:].max(1) >= self.vocabulary + done
            ready = int(np.argmax(waits)) if waits.any() else rules - done
            now = pairs[done : done + ready].reshape(-1)
            body = gather(self.flat, self.start[now], self.size[now])
            own = slice(self.vocabulary + done, self.vocabulary + done + ready)
            ends = np.cumsum(self.size[own])
            self.start[own] = len(self.flat) + ends - self.size[own]
            self.flat = np.r_[self.flat, body]
            done += ready

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[symbols], self.size[symbols])

    def ids(self) -> np.ndarray:
        """The ids of all documents."""
        return self.expand(self.symbols)

    def range(self, document: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of a document, from the symbols that cover them."""
        own = self.symbols[self.bounds[document] : self.bounds[document + 1]]
        ends = np.cumsum(self.size[own])
        stop = min(stop, int(ends[-1]) if len(ends) else 0)
        if start >= stop:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(own[first:last])[start - skipped : stop - skipped]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, added_tokens: bool = False
) -> None:
    """Writes the documents' ids as shards below ``path``, in ascending doc_id order.

    A shard is a row: part and block (its place in the order), doc_ids, n_ids, shard.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, part, block = encoder(tokenizer, added_tokens), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                ids, bounds = known.encode(data, offsets)
                lengths = np.diff(bounds) + 1
                whole = np.insert(ids, bounds[1:], end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([block], pa.int32()),
                        pa.ListArray.from_arrays([0, len(rows)], rows.column(0)),
                        pa.array([len(whole)], pa.int64()),
                        pa.array([compress(whole, lengths, known.vocabulary)], pa.binary()),
                    ],
                    ["part", "block", "doc_ids", "n_ids", "shard"],
                )
                block += 1

    (
        docs.select("doc_id", "text")
        .repartitionByRange(max(parts, 1), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
        .mapInArrow(run, "part int, block int, doc_ids array<long>, n_ids long, shard binary")
        .write.mode("overwrite")
        .parquet(path)
    )


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, block and the number of ids in all shards before it.

    Parts are summed first, so what is put in one order is a row for each part; within a part, its
    own shards.
    """
    shards = spark.read.parquet(path).select("part", "block", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        shards.groupBy("part")
        .agg(F.sum("n_ids").alias("held"))
        .select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("part").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    held = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return shards.join(parts, "part").select("part", "block", (F.col("base") + held).alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids of every document, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, raw in zip(batch.column(0), batch.column(1), strict=True):
                shard = Shard(raw.as_py())
                bounds = np.r_[0, np.cumsum(shard.lengths)].astype(np.int32)
                ids = pa.array(shard.ids().astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.ListArray.from_arrays(pa.array(bounds), ids)],
                    ["doc_id", "ids"],
                )

    shards = spark.read.parquet(path).select("doc_ids", "shard")
    return shards.mapInArrow(run, "doc_id long, ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold of each document: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                shard = Shard(batch.column(3)[k].as_py())
                n = shard.lengths
                ends = np.cumsum(n)
                raw = memoryview(shard.ids().astype("<u4").tobytes())
                crc = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[k].as_py()] * len(n), pa.int32()),
                        pa.array([batch.column(1)[k].as_py()] * len(n), pa.int32()),
                        batch.column(2)[k].values,
                        pa.array(ends - n),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    held = (
        spark.read.parquet(path)
        .select("part", "block", "doc_ids", "shard")
        .mapInArrow(
            run, "part int, block int, doc_id long, offset long, n_tokens long, ids_crc32 long"
        )
    )
    return held.join(shard_starts(spark, path), ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
