"""Licence scans: a positional index of rare template words, checked by key phrases.

Every template has a notice and a key phrase in it. The words of the key phrases are weighed by how
rare they are in the whole corpus. In a file, each place of a phrase's rarest word points, by the
word's position in the phrase, to a place where the template may stand; the posting of the phrase's
second rarest word must agree with it, and then the whole phrase is compared. Every place of a phrase
holds its rarest word, so none is missed, and files without rare licence words cost one pass.

The index is as small as the templates and travels inside the expressions; the only shuffle is that
of document counts for the templates' words. A missing text has no words. Repeated rows are
scanned as often as they stand; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label, notice, key phrase; words as the scan takes them.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        "general public license",
    ),
    ("lgpl", "the gnu lesser general public license version 3", "lesser general public license"),
    ("agpl", "the gnu affero general public license version 3", "affero general public license"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose",
        "permission to use copy modify and or distribute this software",
    ),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "the terms of the eclipse public license 2 0", "eclipse public license"),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
)
BASE = 3  # the first templates
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, ASCII letters in lower case."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN_WORDS), "")


def _at(phrase: list[str], notice: list[str]) -> int:
    return next(k for k in range(len(notice)) if notice[k : k + len(phrase)] == phrase)


def word_documents(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """In how many documents each word of the key phrases stands; as many rows as there are words."""
    wanted = sorted({w for _, _, phrase in templates for w in phrase.split()})
    found = F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(wanted)))
    rows = docs.select(F.explode(found).alias("word")).groupBy("word").count().collect()
    return {w: 0 for w in wanted} | {r[0]: r[1] for r in rows}


def scan(docs: DataFrame, templates=TEMPLATES, base: int = BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_places.

    Base templates are the first ones; n_base counts all places of their phrases, first_word and
    last_word are the smallest and largest of these. labels are those of all templates. score is
    the greatest share of a notice's words that stand where they should, around a verified phrase.
    """
    seen = word_documents(docs, templates)
    phrases = [phrase.split() for _, _, phrase in templates]
    notices = [notice.split() for _, notice, _ in templates]
    postings: dict[str, list[tuple[int, int]]] = {}
    second: list[tuple[str, int]] = []
    for t, phrase in enumerate(phrases):
        rarest = sorted(range(len(phrase)), key=lambda k: (seen[phrase[k]], phrase[k], k))
        postings.setdefault(phrase[rarest[0]], []).append((t, rarest[0]))
        k = rarest[min(1, len(rarest) - 1)]
        second.append((phrase[k], k))
    rare = sorted(postings)
    index = F.map_from_arrays(
        F.array(*[F.lit(w) for w in rare]),
        F.array(
            *[
                F.array(
                    *[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, k in postings[w]]
                )
                for w in rare
            ]
        ),
    )
    table = lambda rows: F.array(*rows)
    phrase_of = table([table([F.lit(w) for w in phrase]) for phrase in phrases])
    notice_of = table([table([F.lit(w) for w in notice]) for notice in notices])
    lead_of = table([F.lit(_at(p, n)) for p, n in zip(phrases, notices, strict=True)])
    label_of = table([F.lit(label) for label, _, _ in templates])
    second_word = table([F.lit(w) for w, _ in second])
    second_at = table([F.lit(k) for _, k in second])

    words = F.col("words")
    looked_up = F.filter(
        F.transform(
            words,
            lambda w, i: F.when(w.isin(rare), F.struct(i.alias("i"), w.alias("w"))),
        ),
        lambda h: h.isNotNull(),
    )
    candidates = F.flatten(
        F.transform(
            F.col("hits"),
            lambda h: F.transform(
                F.element_at(index, h["w"]),
                lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["k"]).alias("at")),
            ),
        )
    )
    agreeing = F.filter(
        candidates,
        lambda c: (c["at"] >= 0)
        & F.get(words, c["at"] + F.get(second_at, c["t"])).eqNullSafe(F.get(second_word, c["t"])),
    )
    verified = F.filter(
        F.array_distinct(agreeing),
        lambda c: F.slice(words, c["at"] + 1, F.size(F.get(phrase_of, c["t"])))
        == F.get(phrase_of, c["t"]),
    )

    def share(c: Column) -> Column:
        notice, begin = F.get(notice_of, c["t"]), c["at"] - F.get(lead_of, c["t"])
        held = F.filter(
            F.transform(notice, lambda w, j: F.get(words, begin + j).eqNullSafe(w)), lambda x: x
        )
        return F.size(held) / F.size(notice)

    basic = F.filter(F.col("places"), lambda c: c["t"] < base)
    names = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda c: F.get(label_of, c["t"])))), ","
    )
    places = lambda: F.transform(basic, lambda c: c["at"].cast("long"))
    return (
        docs.select("doc_id", words_of(F.col("text")).alias("words"))
        .withColumn("hits", looked_up)
        .withColumn("places", verified)
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.size(basic).cast("long").alias("n_base"),
            F.array_min(places()).alias("first_word"),
            F.array_max(places()).alias("last_word"),
            names(basic).alias("base_labels"),
            names(F.col("places")).alias("labels"),
            F.coalesce(F.array_max(F.transform("places", share)), F.lit(0.0)).alias("score"),
            F.size("places").cast("long").alias("n_places"),
        )
    )


def scan_sql(templates=TEMPLATES, base: int = BASE) -> str:
    """The same scan as SQL, every place compared with every phrase."""
    found = []
    for t, (label, notice, phrase) in enumerate(templates):
        p, n = phrase.split(), notice.split()
        lead = _at(p, n)
        here = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p))
        held = " + ".join(
            f"(CASE WHEN i + {k - lead} > 0 AND w[i + {k - lead}] = '{x}' THEN 1 ELSE 0 END)"
            for k, x in enumerate(n)
        )
        found.append(
            f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {here}), lambda i: "
            f"{{'t': {t}, 'label': '{label}', 'at': i - 1, 'share': ({held}) / {len(n)}}})"
        )
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, flatten([{", ".join(found)}]) AS p FROM words),
basic AS (SELECT *, list_filter(p, lambda c: c.t < {base}) AS b FROM places)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(b) AS BIGINT) AS n_base,
  list_min(list_transform(b, lambda c: c.at)) AS first_word,
  list_max(list_transform(b, lambda c: c.at)) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(b, lambda c: c.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda c: c.label))), ',') AS labels,
  coalesce(list_max(list_transform(p, lambda c: c.share)), 0.0) AS score,
  CAST(len(p) AS BIGINT) AS n_places
FROM basic"""
