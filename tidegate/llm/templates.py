"""Line deduplication by a tree of log templates of fixed depth.

A line's way down the tree is its number of words and its first ``LEADING`` words, where a word with
a digit counts as variable. What follows is cut into at most ``FIELDS`` fields of neighbouring words. In
a leaf, a field whose content at least ``least`` documents share is constant, any other content is
variable; a line's template is its leaf with the variable fields left open. A template of which at
least ``SHARE`` of the words are fixed and that recurs in ``least`` documents is dropped, wherever it
stands, but for the document with the smallest doc_id, so what recurs is there once.

``recurring_lines`` with ``strict`` also drops what recurs in two documents only: lines that are equal
word for word, digits too, and templates of lines of more than ``LONG`` words. There only words that
are not variable count as fixed, so a template without any never drops, and words of more than
``SHORT`` bytes are never variable. The operators that change or describe documents are strict.

A leaf is never gathered: fields and templates are counted by grouped sums, which are merged before
they are shuffled, and only lines of leaves that recur go beyond the first count.

Lines are parted by line feeds. Blank lines stay. A missing text has no lines and stays missing;
documents whose text is used up by the drops are left out of ``drop_recurring``. Rows that repeat a
doc_id are one document. Rows without doc_id keep their lines. With ``keep_unique`` a document that
the drops would use up loses only lines that stand word for word in a document with a smaller doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.frames import kept_table
from tidegate.llm.textbytes import NOT_SPACE, byte_set, mix, row_of, span_hashes, spans, text_slices

LEADING = 4
FIELDS = 8
LEAST = 3
PAIR = 2  # documents in which an equal or a long line recurs
LONG = 50  # words
SHORT = 20  # bytes of a variable word
SHARE = 0.6
DIGIT = byte_set((0x30, 0x39))
VARIABLE = np.uint64(0xD1B54A32D192ED03)
STEP = np.uint64(0x9E3779B97F4A7C15)


def lines_of(data: np.ndarray, offsets: np.ndarray, longest: int | None = None):
    """row, line, words, leaf, field hashes, exact hash and plain words of every line with a word.

    Words of at most ``longest`` bytes can be variable; plain words are counted among the leading
    ones and in each field.
    """
    starts, ends, firsts = spans(data, offsets, NOT_SPACE)
    words = span_hashes(data, starts, ends)
    raw = words.copy()
    digits = np.r_[0, np.cumsum(DIGIT[data])]
    variable = digits[ends] > digits[starts]
    if longest is not None:
        variable &= ends - starts <= longest
    words[variable] = VARIABLE
    row = row_of(firsts)
    feeds = np.r_[0, np.cumsum(data == 0x0A)]
    line = feeds[starts] - feeds[offsets[row]]
    new = np.ones(len(words), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(words)])
    if not len(first):
        none = np.zeros(0, np.int64)
        cells = np.zeros((0, FIELDS + 1), np.int64)
        return row, line, n, none, cells[:, 1:], none, cells
    of = np.repeat(np.arange(len(first)), n)
    place = np.arange(len(words)) - first[of]
    rest = n[of] - LEADING
    after = place - LEADING
    # the field of a word: one word each where there are few, else neighbouring words together
    field = np.where(rest > FIELDS, after * FIELDS // np.maximum(rest, 1), after)
    slot = np.where(after < 0, 0, field + 1)
    placed = mix(words + place.astype(np.uint64) * STEP)
    cells = of * (FIELDS + 1) + slot
    heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sums = np.zeros(len(first) * (FIELDS + 1), np.uint64)
    sums[cells[heads]] = np.add.reduceat(placed, heads)
    sums = sums.reshape(-1, FIELDS + 1)
    plain = np.bincount(cells[~variable], minlength=len(sums) * (FIELDS + 1))
    leaf = mix(sums[:, 0] + n.astype(np.uint64) * STEP)
    exact = np.add.reduceat(mix(raw + place.astype(np.uint64) * STEP), first)
    exact = mix(exact + n.astype(np.uint64) * STEP).view(np.int64)
    fields = sums[:, 1:].view(np.int64)
    plain = plain.reshape(-1, FIELDS + 1)
    return row[first], line[first], n, leaf.view(np.int64), fields, exact, plain


def parsed(docs: DataFrame, longest: int | None = None) -> DataFrame:
    """doc_id, line, lines (of its row, with words), n (its words), leaf, whole (hash of leaf and
    fields), exact (hash of the words as they are), fields and plain (words) of each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                row, line, n, leaf, fields, exact, plain = lines_of(data, offsets, longest)
                whole = leaf.view(np.uint64).copy()
                for k in range(FIELDS):
                    whole = mix(whole * STEP + fields[:, k].view(np.uint64))
                lines = np.bincount(row, minlength=len(rows))[row]
                bounds = np.arange(len(leaf) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(row)),
                        pa.array(line.astype(np.int32)),
                        pa.array(lines.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(leaf),
                        pa.array(whole.view(np.int64)),
                        pa.array(exact),
                        pa.ListArray.from_arrays(
                            pa.array(bounds * FIELDS), pa.array(fields.reshape(-1))
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(bounds * (FIELDS + 1)),
                            pa.array(plain.astype(np.int32).reshape(-1)),
                        ),
                    ],
                    ["doc_id", "line", "lines", "n", "leaf", "whole", "exact", "fields", "plain"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, line int, lines int, n int, leaf long, whole long, exact long, "
        "fields array<long>, plain array<int>",
    )


def documents_of(rows: DataFrame, *key: str) -> DataFrame:
    """key, its number of different documents and the smallest of them."""
    return (
        rows.groupBy(*key, "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy(*key)
        .agg(F.count("*").alias("documents"), F.min("doc_id").alias("first"))
    )


def words_in(field: F.Column) -> F.Column:
    """How many words field k of a line of n words holds."""
    rest = F.col("n") - LEADING
    many = F.ceil((field + 1) * rest / FIELDS) - F.ceil(field * rest / FIELDS)
    return F.when(rest > FIELDS, many).when(field < rest, 1).otherwise(0).cast("int")


def equal_lines(lines: DataFrame) -> DataFrame:
    """The lines that stand word for word in a document with a smaller doc_id."""
    held = (
        lines.groupBy("exact")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("exact", "first")
    )
    return lines.join(held, "exact").where(F.col("doc_id") != F.col("first"))


def dropped_lines(
    docs: DataFrame, least: int = LEAST, share: float = SHARE, strict: bool = True
) -> DataFrame:
    """doc_id, line, lines (of its row) and exact (word for word in a smaller doc_id) of every line
    that is dropped; a line may be there twice."""
    lines = kept_table(
        parsed(docs, SHORT if strict else None).where("doc_id IS NOT NULL"), "lines"
    )
    support = F.lit(least)
    if strict:
        support = F.when(F.col("n") > LONG, min(PAIR, least)).otherwise(least)
    leaves = documents_of(lines, "leaf", "n").where(F.col("documents") >= support).select("leaf")
    held = kept_table(lines.join(leaves, "leaf", "left_semi"), "leaves")
    # a line's content in a document counts once
    contents = held.select("leaf", "whole", "n", "fields", "plain", "doc_id")
    constant = (
        documents_of(
            contents.select(
                "leaf", "n", "doc_id", F.posexplode("fields").alias("k", "field")
            ).where("field <> 0"),
            "leaf",
            "n",
            "k",
            "field",
        )
        .where(F.col("documents") >= support)
        .select("leaf", "k", "field")
    )
    kinds = contents.groupBy("leaf", "whole").agg(
        F.first("n").alias("n"), F.first("fields").alias("fields"), F.first("plain").alias("plain")
    )
    in_field, leading = words_in(F.col("k")), F.least("n", F.lit(LEADING))
    if strict:
        in_field, leading = F.get("plain", F.col("k") + 1), F.get("plain", F.lit(0))
    fixed = (
        kinds.select("leaf", "whole", "n", "plain", F.posexplode("fields").alias("k", "field"))
        .where("field <> 0")
        .join(constant, ["leaf", "k", "field"])
        .groupBy("leaf", "whole")
        .agg(
            F.sum(in_field).alias("words"),
            F.bit_xor(F.xxhash64("k", "field")).alias("shape"),
        )
    )
    named = (
        kinds.select("leaf", "whole", "n", "plain")
        .join(fixed, ["leaf", "whole"], "left")
        .withColumn("words", F.coalesce("words", F.lit(0)) + leading)
        .where(F.col("words") >= F.col("n") * share)
        .select("whole", "n", F.xxhash64("leaf", F.coalesce("shape", F.lit(0))).alias("template"))
    )
    shaped = held.select("doc_id", "line", "lines", "whole").join(named, "whole")
    often = documents_of(shaped, "template", "n").where(F.col("documents") >= support)
    gone = (
        shaped.join(often.drop("n"), "template")
        .where(F.col("doc_id") != F.col("first"))
        .select("doc_id", "line", "lines", F.lit(False).alias("exact"))
    )
    if strict:
        gone = gone.union(
            equal_lines(lines).select("doc_id", "line", "lines", F.lit(True).alias("exact"))
        )
    return gone


def recurring_lines(
    docs: DataFrame, least: int = LEAST, share: float = SHARE, strict: bool = False
) -> DataFrame:
    """doc_id and line of every line that is dropped."""
    return dropped_lines(docs, least, share, strict).select("doc_id", "line").distinct()


def dropped_by_document(docs: DataFrame, keep_unique: bool = False, **choices) -> DataFrame:
    """doc_id and the numbers of its dropped lines; documents without any are not there."""
    found = dropped_lines(docs, **choices).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("line")).alias("gone"),
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("line")))).alias("equal"),
        F.max("lines").alias("lines"),
    )
    gone = F.col("gone")
    if keep_unique:
        gone = F.when(F.size("gone") >= F.col("lines"), F.col("equal")).otherwise(gone)
    return found.select("doc_id", gone.alias("gone")).where(F.size("gone") > 0)


def _with_gone(docs: DataFrame, columns: list[str], **choices) -> DataFrame:
    gone = dropped_by_document(docs, **choices).toDF("__id", "__gone").hint("shuffle_hash")
    rows = docs.select(*[F.col(f"`{c}`") for c in columns])
    return rows.join(gone, F.col("doc_id") == F.col("__id"), "left").drop("__id")


def _rest(text: str, gone: list[int]) -> str:
    out, lines = set(gone), text.split("\n")
    return "\n".join(x for k, x in enumerate(lines) if k not in out)


def drop_recurring(docs: DataFrame, **choices) -> DataFrame:
    """The documents without their recurring lines; all columns stay, n_chars is counted anew.

    Documents that held text and have none left are gone. With ``keep_unique`` others hold each of
    their lines word for word.
    """
    columns = docs.columns
    schema = T.StructType(list(docs.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, last = batch.schema.get_field_index("text"), batch.num_columns - 1
            gone = batch.column(last)
            touched = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
            if not len(touched):
                yield batch.select(columns)
                continue
            texts = batch.column(at).to_pylist()
            stay = np.ones(len(batch), bool)
            lists = gone.take(pa.array(touched)).to_pylist()
            for k, numbers in zip(touched.tolist(), lists, strict=True):
                texts[k] = _rest(texts[k], numbers)
                stay[k] = bool(texts[k].strip())
            held = [batch.column(k) for k in range(last)]
            held[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in columns:
                k = columns.index("n_chars")
                sizes = held[k].to_pylist()
                for j in touched.tolist():
                    sizes[j] = len(texts[j])
                held[k] = pa.array(sizes, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(held, columns).filter(pa.array(stay))

    return _with_gone(docs, columns, **choices).mapInArrow(run, schema)


def digests(docs: DataFrame, **choices) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_chars and kept_crc32 (of the text that is left)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            out = []
            for doc_id, text, gone in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                text = text or ""
                rest = _rest(text, gone) if gone else text
                out.append(
                    (
                        doc_id,
                        text.count("\n") + bool(text),
                        len(gone or ()),
                        len(rest),
                        zlib.crc32(rest.encode()),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                if out
                else [pa.array([], pa.int64())] * 5,
                ["doc_id", "n_lines", "n_dropped", "kept_chars", "kept_crc32"],
            )

    return _with_gone(docs, ["doc_id", "text"], **choices).mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_chars long, kept_crc32 long"
    )
