"""Mixing by soft membership: rates for documents whose expected domain totals match targets.

A word classifier learns the domains from all words of documents of the labelled table. Of every
document it gives a posterior over the domains, from the mean log-likelihood of the document's known
words, so that membership is soft and does not depend on length. A document of n words and posterior p brings
n p[d] expected words to domain d.

Projected gradient descent then fits rates, none below ``least_rate``, that minimise the squared distance of
the domains' expected totals from their targets, starting from rate 1. A step moves a document by the
residuals of its domains, each divided by the domain's mass, which keeps steps of length 1 stable.
Documents whose posteriors are equal on a grid of ``GRID`` steps get the same rate; totals use
their exact sums, so the fit is for the documents themselves, and a step works on at most as many
rows as the grid has cells, in Spark.

All of it are DataFrame expressions. A missing or empty text has no words, the labelled
documents' shares as posterior, and moves no total. Rows that repeat a doc_id share its rate.
A target domain without a labelled document cannot be recognised: a warning names it, its posterior is 0,
and the others share the whole by their targets. Without labelled documents of any target domain every
rate is 1.
"""

from __future__ import annotations

import logging
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import kept_table, label_sample, uniform
from tidegate.llm.licenses import words_of

TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
MAX_LABELLED = 60_000
SENT = 200_000  # most frequent words that are sent to every task; the others are joined by a shuffle
SHARPNESS = 2.0  # weight of the mean log-likelihood against the shares
GRID = 32
STEPS = 60
SETTLED = 1e-6  # of the total, by which a step moves the domains at most when it ends


def classifier(
    docs: DataFrame, labels: DataFrame, domains: list[str], domain: str, max_labelled: int
):
    """The shares of the domains, and two frames of word (its hash) and log-likelihood by domain.

    Together they have every word of a bounded sample of labelled documents: the first one at most
    ``SENT`` of the most frequent words, the second one the others; None if there are none.
    """
    sample = label_sample(labels, "quality", max_labelled).select("doc_id")
    known = docs.select("doc_id", "text", F.col(domain).alias("domain")).where(
        F.col("domain").isin(domains)
    )
    words = kept_table(
        known.join(F.broadcast(sample), "doc_id", "left_semi")
        .select("domain", F.explode(words_of(F.col("text"))).alias("word"))
        .groupBy(F.xxhash64("word").alias("word"))
        .agg(*[F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)]),
        "vocabulary",
    )
    each = range(len(domains))
    n = sum((F.col(f"n{k}") for k in each[1:]), F.col("n0"))
    row = words.agg(
        F.count("*"),
        *[F.sum(f"n{k}") for k in each],
        *[F.count_if(n >= (1 << j)) for j in range(63)],
    ).first()
    size, totals, above = row[0], row[1 : 1 + len(domains)], row[1 + len(domains) :]
    if not size:
        return None, None, None
    least = next((1 << j for j in range(63) if above[j] <= SENT), 1 << 62)
    model = words.select(
        "word",
        (n >= least).alias("often"),
        *[
            (F.log((F.col(f"n{k}") + 1.0) / float(totals[k] + size)) if totals[k] else F.lit(-20.0))
            .alias(f"l{k}")
            for k in each
        ],
    )
    rare = None if least == 1 else model.where("NOT often").drop("often")
    return [t / sum(totals) for t in totals], model.where("often").drop("often"), rare


def recognised(
    docs: DataFrame, labels: DataFrame, domains: list[str], domain: str, max_labelled: int
) -> list[str]:
    """The domains of which the labelled sample has a document."""
    sample = label_sample(labels, "quality", max_labelled).select("doc_id")
    held = docs.select("doc_id", F.col(domain).alias("domain")).where(F.col("domain").isin(domains))
    held = held.join(F.broadcast(sample), "doc_id", "left_semi").select("domain").distinct()
    return sorted(r[0] for r in held.collect())


def posteriors(
    docs: DataFrame, labels: DataFrame, domains: list[str], domain: str, max_labelled: int
) -> DataFrame:
    """doc_id, rows (with this id), n_words of one row and p0, p1, ... of every doc_id."""
    shares, model, rare = classifier(docs, labels, domains, domain, max_labelled)
    each = range(len(domains))
    if model is None:
        return docs.groupBy("doc_id").agg(F.count("*").alias("rows")).select(
            "doc_id", "rows", F.lit(0).cast("long").alias("n_words"),
            *[F.lit(1.0 / len(domains)).alias(f"p{k}") for k in each],
        )
    words = docs.select(
        "doc_id", F.posexplode_outer(words_of(F.col("text"))).alias("place", "word")
    ).withColumn("word", F.when(F.col("word").isNotNull(), F.xxhash64("word")))
    logs = [F.sum(f"l{k}").alias(f"l{k}") for k in each]
    found = (
        words.join(F.broadcast(model), "word", "left")  # at most SENT rows
        .groupBy("doc_id")
        .agg(
            F.count_if(F.coalesce("place", F.lit(0)) == 0).alias("rows"),
            F.count("word").alias("n"),
            F.count("l0").alias("known"),
            *logs,
        )
    )
    if rare is not None:
        others = (
            words.where("word IS NOT NULL")
            .select("doc_id", "word")
            .join(F.broadcast(model.select("word")), "word", "left_anti")
            .join(rare.hint("merge"), "word")
            .groupBy("doc_id")
            .agg(F.count("*").alias("known"), *logs)
        )
        found = (
            found.unionByName(others, allowMissingColumns=True)
            .groupBy("doc_id")
            .agg(*[F.sum(c).alias(c) for c in ("rows", "n", "known")], *logs)
        )
    found = found.withColumns({f"l{k}": F.col(f"l{k}") / F.nullif("known", F.lit(0)) for k in each})
    score = [
        F.coalesce(F.col(f"l{k}") * SHARPNESS, F.lit(0.0)) + log(max(shares[k], 1e-9))
        for k in each
    ]
    found = found.select(
        "doc_id",
        "rows",
        (F.col("n") / F.col("rows")).cast("long").alias("n_words"),
        *[s.alias(f"s{k}") for k, s in enumerate(score)],
    )
    top = F.greatest(*[F.col(f"s{k}") for k in each]) if len(domains) > 1 else F.col("s0")
    raised = [F.exp(F.col(f"s{k}") - top) for k in each]
    total = sum(raised[1:], raised[0])
    shares = [(x / total).alias(f"p{k}") for k, x in enumerate(raised)]
    return found.select("doc_id", "rows", "n_words", *shares)


def _cell(n: int) -> list[Column]:
    return [F.round(F.col(f"p{k}") * GRID).cast("int").alias(f"c{k}") for k in range(n)]


def fit(found: DataFrame, targets: list[float], least_rate: float, total: float | None):
    """Cells of the grid with their rate, and the expected totals that the rates give."""
    each = range(len(targets))
    mass = [F.sum(F.col("n_words") * F.col("rows") * F.col(f"p{k}")).alias(f"m{k}") for k in each]
    cells = kept_table(found.groupBy(*_cell(len(targets))).agg(*mass), "cells")
    held = cells.agg(*[F.sum(f"m{k}") for k in each]).first()
    held = [x or 0.0 for x in held]
    rate = F.lit(1.0)
    whole = sum(held)
    if not whole or not all(held):
        return cells.withColumn("rate", rate), held
    weights = [w / sum(targets) for w in targets]
    total = total or max(h / w for h, w in zip(held, weights, strict=True) if w > 0)
    wanted = [w * total for w in weights]
    size = sum((F.col(f"m{k}") for k in each[1:]), F.col("m0"))
    now, steps = held, []
    for _ in range(STEPS):
        steps.append([(now[k] - wanted[k]) / held[k] for k in each])
        # the steps so far, one after the other, each projected on the allowed rates
        taken = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

        def moved(rate: Column, step: Column) -> Column:
            parts = [F.col(f"m{k}") * F.get(step, F.lit(k)) for k in each]
            return F.greatest(F.lit(float(least_rate)), rate - sum(parts[1:], parts[0]) / size)

        rate = F.when(size > 0, F.aggregate(taken, F.lit(1.0), moved)).otherwise(F.lit(1.0))
        before = now
        rated = cells.withColumn("rate", rate)
        now = list(rated.agg(*[F.sum(F.col(f"m{k}") * F.col("rate")) for k in each]).first())
        if max(abs(a - b) for a, b in zip(now, before, strict=True)) < SETTLED * total:
            break
    return cells.withColumn("rate", rate), now


def rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] | None = None,
    domain: str = "lang",
    least_rate: float = 0.0,
    total: float | None = None,
    max_labelled: int = MAX_LABELLED,
    seed: int = 23,
) -> DataFrame:
    """doc_id, n_words, p_<domain> ..., rate and copies of every doc_id.

    ``total`` is the wanted number of words; if not given, the smallest one for which no domain has to
    shrink. copies is the rate, rounded up or down at random by doc_id so that its mean is the rate.
    """
    targets = targets or TARGETS
    asked = sorted(targets)
    names = recognised(docs, labels, asked, domain, max_labelled)
    absent = [d for d in asked if d not in names]
    if absent:
        logging.getLogger(__name__).warning(
            "no labelled document of %s: left out of the mixture", ", ".join(absent)
        )
    names = names or asked
    found = kept_table(posteriors(docs, labels, names, domain, max_labelled), "posteriors")
    cells, _ = fit(found, [targets[d] for d in names], least_rate, total)
    keys = [f"c{k}" for k in range(len(names))]
    rate = F.col("rate")
    return (
        found.select("*", *_cell(len(names)))
        .join(kept_table(cells.select(*keys, "rate"), "rates"), keys)
        .select(
            "doc_id",
            "n_words",
            *[(F.col(f"p{names.index(d)}") if d in names else F.lit(0.0)).alias(f"p_{d}") for d in asked],
            "rate",
            (F.floor(rate) + (uniform(seed, "doc_id") < rate - F.floor(rate)).cast("int"))
            .cast("int")
            .alias("copies"),
        )
    )


def mix(docs: DataFrame, labels: DataFrame, least_rate: float = 1.0, **choices) -> DataFrame:
    """The documents as often as their copies say, with all columns; none is lost at rates from 1."""
    copies = rates(docs, labels, least_rate=least_rate, **choices).select(
        F.col("doc_id").alias("__id"), F.col("copies").alias("__copies")
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.join(copies.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__id")))
        .where("__copies > 0")
        .select(*columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy"))
        .select(*columns)
    )
