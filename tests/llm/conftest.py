from __future__ import annotations

import pytest

from tidegate.llm.code import share_code

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True, scope="session")
def shared(spark):
    share_code(spark)


@pytest.fixture
def documents(spark):
    """A frame of documents from texts, or from (doc_id, text)."""

    def make(texts, parts=2):
        rows = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts)]
        rows = [(k, t, "en", f"s{(k or 0) % 3}", len(t or "")) for k, t in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)

    return make


@pytest.fixture
def awkward(spark):
    """Missing values in every column, empty and very long texts, repeated rows, odd characters, and
    columns that bear the names operators use themselves."""
    long = " ".join(f"w{k % 977}x" for k in range(60_000))
    texts = [
        None,
        "",
        "   \n\t ",
        "x" * 300_000,
        long,
        "MIT License mit license",
        "one two three four five six\n\none two three four five six",
        "▁ naïve 🎉 \x00  　 <|endoftext|> <s>",
        "idiot",
    ]
    rows = [(k, t, None if k % 2 else "en", None if k % 3 else "s", None) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id", "en", "s", 5), (None, None, None, None, None)]
    extra = (1, "a", 2.0, 3, "b", 4, True, "c")
    names = (
        "label int, word string, rate double, copies int, gone string, n int, kept boolean, pieces string"
    )
    return spark.createDataFrame(
        [(*r, *extra) for r in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {names}",
    ).repartition(3)


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
