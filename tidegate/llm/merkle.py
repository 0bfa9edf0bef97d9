"""A Merkle manifest of a table: leaves, one tree for each group, one tree over the groups.

A leaf is the hash of a row's columns. Within a group the leaves stand in key order; every ``fanout``
consecutive nodes become one parent, the hash of their digests, until one node is left, the group's
root. The groups' roots, in group order, become the manifest's root in the same way.

A level is built by a slot pivot. A node's slot is its place among its parent's children; conditional
aggregates spread the children of each parent into ``fanout`` columns. All columns in a row,
concatenated, hash to the parent. The columns before and behind a child's own one are its siblings.
The way down joins each level's rows with the path of their parent and unfolds them again.

Places come from a range sort that is written: its row ids give the place within a written part, and
one count for each part and group gives what stands before it. So neither a group with most rows nor
the whole table ever goes through one task, and no window runs over a group's rows.

Missing values are part of the hash (``-``); a missing group is a group, the first one; a missing key
stands before the others. Rows that repeat a key stand in the order of their leaves; equal rows are
leaves of their own. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.frames import Kept

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 33  # fixed value: monotonically_increasing_id() numbers rows below this bit, parts above


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as a leaf takes it: its length in bytes, a colon and its text, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def placed(rows: DataFrame, order: Sequence[str], kept: Kept) -> DataFrame:
    """The rows with ``pos``, their place in their group ``g`` (from 0), and ``n``, the group's rows."""
    ranged = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    ranged = kept.table(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", PART_BITS))
    counted = ranged.groupBy("_part", "g").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # one row for each written part that holds a group
    group = W.partitionBy("g")
    before = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    marks = counted.select(
        F.col("_part").alias("_p"),
        F.col("g").alias("_g"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("n"),
    )
    on = (F.col("_part") == F.col("_p")) & F.col("g").eqNullSafe(F.col("_g"))
    return ranged.join(marks, on).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n"
    )


def _slots(fanout: int) -> list[str]:
    return [f"c{k}" for k in range(fanout)]


def _digests(fanout: int, low: int, high: int) -> Column:
    """The digests of the slots from ``low`` up to ``high``, concatenated."""
    return F.concat_ws("", *[F.col(f"c{k}")["digest"] for k in range(low, high)])


def pivot(nodes: DataFrame, held: Sequence[str], fanout: int) -> DataFrame:
    """The parents of the nodes of groups with more than one: their children in columns, their digest."""
    slot = F.pmod("pos", F.lit(fanout))
    child = F.struct("digest", *held)
    wide = (
        nodes.where("n > 1")
        .groupBy("g", F.floor(F.col("pos") / fanout).alias("pos"))
        .agg(
            F.ceil(F.max("n") / fanout).alias("n"),
            *[F.max(F.when(slot == k, child)).alias(f"c{k}") for k in range(fanout)],
        )
    )
    return wide.withColumn("digest", F.sha2(_digests(fanout, 0, fanout), 256))


def climb(nodes: DataFrame, held: Sequence[str], fanout: int, kept: Kept):
    """The levels of pivoted parents from the nodes up, and each group's root with its level."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots, level = [], [], 0
    while True:
        roots.append(
            nodes.where("n = 1").select("g", "digest", F.lit(level).alias("level"), *held)
        )
        if most <= 1:
            break
        levels.append(kept.table(pivot(nodes, held, fanout), f"level{level}"))
        nodes, held, level, most = levels[-1], [], level + 1, -(-most // fanout)
    return levels, roots


def unfold(wide: DataFrame, paths: DataFrame, held: Sequence[str], fanout: int) -> DataFrame:
    """The children of pivoted rows, each with its siblings put before its parent's path."""
    children = F.array(
        *[
            F.when(
                F.col(f"c{k}").isNotNull(),
                F.struct(
                    F.lit(k).alias("slot"),
                    F.col(f"c{k}").alias("child"),
                    F.struct(
                        _digests(fanout, 0, k).alias("before"),
                        _digests(fanout, k + 1, fanout).alias("behind"),
                    ).alias("siblings"),
                ),
            )
            for k in range(fanout)
        ]
    )
    above = paths.select(
        F.col("g").alias("_g"), F.col("pos").alias("_pos"), "group_root", F.col("path").alias("_path")
    )
    on = F.col("g").eqNullSafe(F.col("_g")) & (F.col("pos") == F.col("_pos"))
    return (
        wide.select("g", "pos", *_slots(fanout))
        .join(above, on)
        .select("g", "pos", "group_root", "_path", F.explode(children).alias("x"))
        .where("x IS NOT NULL")
        .select(
            "g",
            (F.col("pos") * fanout + F.col("x.slot")).alias("pos"),
            "group_root",
            F.col("x.child.digest").alias("digest"),
            F.concat(F.array("x.siblings"), "_path").alias("path"),
            *[F.col(f"x.child.{h}").alias(h) for h in held],
        )
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["behind"]), 256)
    )


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf's to those below the root."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["behind"])))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    group: str = "source",
    carry: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """key, group, leaf, group_root, root and path (siblings before and behind, level by level up).

    ``carry`` adds values worked out from the same row. Texts are hashed where they are read; only
    digests are shuffled.
    """
    carry = dict(carry or {})
    kept = Kept(docs.sparkSession)
    leaves = kept.table(
        docs.select(
            F.col(f"`{key}`").alias("key"),
            F.col(f"`{group}`").alias("g"),
            leaf_of([F.col(f"`{c}`") for c in columns]).alias("digest"),
            *[value.alias(f"_carry_{name}") for name, value in carry.items()],
        ),
        "leaves",
    )
    held = ["key", *[f"_carry_{name}" for name in carry]]
    nodes = placed(leaves, ["key", "digest"], kept)
    levels, roots = climb(nodes, held, fanout, kept)

    # the groups' roots are the leaves of the upper tree, whose only group has no name
    tops = reduce(
        DataFrame.unionByName, [x.select("g", "digest", F.col("level").alias("top")) for x in roots]
    )
    tops = tops.select(F.lit(0).alias("g"), F.col("g").alias("name"), "top", "digest")
    upper = placed(kept.table(tops, "group-roots"), ["name"], kept)
    named = ["name", "top"]
    over, above = climb(upper, named, fanout, kept)
    found = above[-1].select("digest").first()
    root = found[0] if found else None

    no_path = F.array().cast("array<struct<before:string,behind:string>>")
    start = above[-1].select(
        "g", F.lit(0).cast("long").alias("pos"), F.col("digest").alias("group_root"),
        "digest", no_path.alias("path"), *([] if over else named),
    )
    for k in range(len(over) - 1, -1, -1):
        start = unfold(over[k], start, [] if k else named, fanout)
    group_paths = kept.table(
        start.select(
            F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "top",
            F.col("digest").alias("group_root"), "path",
        ),
        "group-paths",
    )

    shown = ["g", "group_root", "path"]
    paths = group_paths.where(F.col("top") == len(levels)).select(*shown, "pos")
    for k in range(len(levels) - 1, 0, -1):
        paths = unfold(levels[k], paths, [], fanout).select(*shown, "pos")
        paths = paths.unionByName(group_paths.where(F.col("top") == k).select(*shown, "pos"))
        paths = kept.table(paths, f"paths{k}")
    single = (
        nodes.where("n = 1")
        .withColumnRenamed("g", "_own")
        .join(
            group_paths.where("top = 0").select(*shown), F.col("_own").eqNullSafe(F.col("g"))
        )
        .select(*shown, "digest", *held)
    )
    whole = single
    if levels:
        whole = unfold(levels[0], paths, held, fanout).select(*shown, "digest", *held)
        whole = whole.unionByName(single)
    kept.drop_all_but("ranged", "group-paths", "level0", "paths1")
    return whole.select(
        F.col("key").alias(key),
        F.col("g").alias(group),
        F.col("digest").alias("leaf"),
        "group_root",
        F.lit(root).cast("string").alias("root"),
        "path",
        *[F.col(f"_carry_{name}").alias(name) for name in carry],
    )


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose text was lower-cased, where 5 divides the crc32 of its doc_id."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(hit, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))
    return leaf_of([text if c == "text" else F.col(c) for c in COLUMNS])


def checked(docs: DataFrame) -> DataFrame:
    """Each document's leaf and proof, and whether its (maybe tampered) text still gives the root."""
    found = manifest(docs, carry={"now": tampered(docs)})
    folded = found.withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return folded.select(
        "doc_id",
        "leaf",
        F.col("group_root").alias("subroot"),
        "root",
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_HIT = """list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                 ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _sql_leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_sql_field(v) for v in values)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The same manifest level by level: nodes climb recursively, documents fold along their siblings.
SQL = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
    CASE WHEN xor({_HIT}, 4294967295) % 5 = 0 THEN {_sql_leaf(_LOWER)}
         ELSE {_sql_leaf("text")} END AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM documents),
tree AS (
  SELECT source, 0 AS level, pos, leaf AS digest, n FROM docs
  UNION ALL
  SELECT source, level + 1, pos // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)),
    (n + {FANOUT - 1}) // {FANOUT}
  FROM tree WHERE n > 1 GROUP BY source, level, pos // {FANOUT}, n),
subroots AS (SELECT source, digest AS subroot, level AS top,
    row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)),
    (n + {FANOUT - 1}) // {FANOUT}
  FROM upper_tree WHERE n > 1 GROUP BY level, pos // {FANOUT}, n),
every AS (
  SELECT 'g' || coalesce('=' || source, '') AS g, level, pos, digest FROM tree WHERE n > 1
  UNION ALL SELECT 'upper', level, pos, digest FROM upper_tree WHERE n > 1),
siblings AS (
  SELECT a.g, a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS behind
  FROM every a JOIN every b
    ON a.g = b.g AND a.level = b.level AND a.pos // {FANOUT} = b.pos // {FANOUT}
  GROUP BY 1, 2, 3),
folds AS (
  SELECT d.doc_id, d.leaf, s.subroot, 'g' || coalesce('=' || d.source, '') AS g, s.top, s.pos AS up,
    0 AS level, d.pos, d.changed AS digest, '' AS proof
  FROM docs d JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, CASE WHEN f.level = f.top THEN 'upper' ELSE f.g END,
    CASE WHEN f.level = f.top THEN -1 ELSE f.top END, f.up,
    CASE WHEN f.level = f.top THEN 0 ELSE f.level + 1 END,
    CASE WHEN f.level = f.top THEN f.up ELSE f.pos // {FANOUT} END,
    CASE WHEN f.level = f.top THEN f.digest ELSE sha256(s.before || f.digest || s.behind) END,
    CASE WHEN f.level = f.top THEN f.proof ELSE f.proof || s.before || s.behind END
  FROM folds f LEFT JOIN siblings s
    ON f.level <> f.top AND s.g = f.g AND s.level = f.level AND s.pos = f.pos
  WHERE f.level = f.top OR s.g IS NOT NULL),
top AS (SELECT max(level) AS height, max(digest) FILTER (n = 1) AS root FROM upper_tree)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root,
  digest = root AS verified
FROM folds, top WHERE g = 'upper' AND level = height"""
