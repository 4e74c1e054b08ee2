"""A Merkle manifest of a dataset: a hash tree per language, and one over their roots.

Nodes of a tree stand in rows by slot. At every level a row that begins a node sees the nodes
beside it by lag and lead at fixed offsets, masked by its place in the run and the run's
length; the first row of a run hashes the parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.llm.common import running, stored

ARITY = 2
LEVELS = 10
STEP = "struct<left:string,right:string>"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the encoded values in a row."""
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def _joined(*parts: Column) -> Column:
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def _climb(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Up to ``levels`` levels of every tree: (… , block, steps, node).

    ``nodes`` has tree, slot, total (nodes of the tree) and hash. Blocks of arity ** levels
    slots never share a run below their own top, so windows stay within a block and all
    levels use one shuffle. ``node`` of a block's first row is the hash of the block;
    ``steps`` are the siblings (left, right) on the way there, for every row.
    """
    size = arity**levels
    df = nodes.withColumn("block", F.expr(f"slot div {size}")).withColumn("node", F.col("hash"))
    for level in range(levels):
        width = arity**level
        here = F.expr(f"(total + {width - 1}) div {width}")
        place = F.expr(f"(slot div {width}) % {arity}")
        first = F.expr(f"slot % {width} = 0")
        row = Window.partitionBy("tree", "block", first).orderBy("slot")
        run = F.least(F.lit(arity), here - F.expr(f"slot div {width}") + place)
        left = _joined(*[F.when(place >= k, F.lag("node", k).over(row)) for k in range(arity - 1, 0, -1)])
        right = _joined(*[F.when(place + k < run, F.lead("node", k).over(row)) for k in range(1, arity)])
        df = df.withColumns({"_left": F.when(first, left), "_right": F.when(first, right), "_more": here > 1})
        df = df.withColumn(
            f"_step{level}",
            F.when(first & F.col("_more"), F.struct(F.col("_left").alias("left"), F.col("_right").alias("right"))),
        ).withColumn(
            "node",
            F.when(first & F.col("_more") & (place == 0), F.sha2(F.concat("node", "_right").cast("binary"), 256)).when(
                first & ~F.col("_more"), F.col("node")
            ),
        )
    so_far = Window.partitionBy("tree", "block").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    steps = F.array(*[F.last(f"_step{level}", ignorenulls=True).over(so_far) for level in range(levels)])
    return df.select(*nodes.columns, "block", F.filter(steps, lambda s: s.isNotNull()).alias("steps"), "node")


def climb(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (stored; tree, slot from 0, total, hash) with ``steps`` up to their tree's ``top``.

    Each pass folds ``levels`` levels, so a tree of n nodes takes log(n) / ``levels`` shuffles
    of ever fewer rows, and the steps above a block are joined to it once.
    """
    most = nodes.agg(F.max("total")).first()[0] or 0
    passes = []
    while True:
        passes.append(stored(_climb(nodes, arity, levels)))
        most = -(-most // arity**levels)
        if most <= 1:
            break
        size = arity**levels
        nodes = passes[-1].where(f"slot % {size} = 0").select(
            "tree", F.col("block").alias("slot"), F.expr(f"(total + {size - 1}) div {size}").alias("total"),
            F.col("node").alias("hash"),
        )
    above = None
    for level in reversed(passes):
        if above is None:
            tops = level.where("slot = 0").select("tree", F.lit(0).cast("long").alias("block"), F.col("node").alias("top"))
            above = tops.withColumn("_steps", F.array().cast(f"array<{STEP}>"))
        joined = lookup_join(level.drop("node"), above, ["tree", "block"])
        joined = joined.withColumn("steps", F.concat("steps", "_steps")).drop("_steps", "block")
        above = joined.select("tree", F.col("slot").alias("block"), F.col("steps").alias("_steps"), "top")
    return joined


def folded(start: Column, steps: Column) -> Column:
    """The hash that ``start`` and the siblings of its way lead to."""
    return F.aggregate(
        steps, start, lambda a, s: F.sha2(F.concat(s["left"], a, s["right"]).cast("binary"), 256)
    )


def manifest(df: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): one row per row of ``df``.

    A leaf hashes all five columns, nulls as ``-``. The leaves of a language (null is one of
    its own) stand by doc_id, null first, and equal ids by leaf; rows equal in all five columns
    have one leaf and stand side by side. Runs of ``arity`` nodes become a parent until one
    node is left, the subroot; a single leaf is a subroot. Subroots, by language with null
    first, lead to the root in the same way. ``proof_sha256`` hashes the siblings on a row's
    way to the root, of no siblings the empty text. ``folded_root`` starts from the tampered
    leaf (n_chars one higher) where 7 divides the CRC-32 of the id; a null id is never
    tampered, and a null n_chars stays null. Text is hashed where it is read, at any length,
    and not shuffled. Other columns are ignored; an empty table gives no row.
    """
    columns = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = columns | {"n_chars": F.col("n_chars") + 1}
    leaves = stored(
        df.select(
            "doc_id",
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
            leaf_hash(*columns.values()).alias("hash"),
            F.when(tampered, leaf_hash(*changed.values())).alias("tampered"),
            F.lit(1).cast("long").alias("one"),
        )
    )
    placed = running(leaves, ["tree"], ["doc_id", "hash"], {"slot": "one"}).drop("one")
    totals = stored(leaves.groupBy("tree").agg(F.sum("one").alias("total")))
    rows = climb(stored(lookup_join(placed, totals, ["tree"])), arity, levels)
    subroots = rows.where("slot = 0").select(F.lit(0).alias("all"), "tree", F.col("top").alias("hash"), F.lit(1).cast("long").alias("one"))
    subroots = stored(subroots)
    trees = running(subroots, ["all"], ["tree"], {"slot": "one"})
    heads = trees.select(
        F.col("all").alias("tree"), F.col("tree").alias("member"), "slot", F.lit(subroots.count()).cast("long").alias("total"), "hash"
    )
    above = climb(stored(heads), arity, levels).select(
        F.col("member").alias("tree"), F.col("steps").alias("_above"), F.col("hash").alias("subroot"), F.col("top").alias("root")
    )
    rows = lookup_join(rows, stored(above), ["tree"]).withColumn("way", F.concat("steps", "_above"))
    siblings = F.array_join(F.transform("way", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "hash"), F.col("way")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
