"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.llm.common import running, stored, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 13


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (key, source_size) with ``target``.

    The sources in order of their key weigh ``weights``, repeating, and share ``share`` of all
    sizes; no target exceeds ``most`` times its source's size, and the excess is shared anew by
    weight. Sources whose size is smallest for their weight reach that bound first, so in order
    of size by weight the bounded ones come first, and a source is bounded if its share of what
    those before it left exceeds its bound.
    """
    ones = sources.select(F.lit(0).alias("all"), "key", "source_size", F.lit(1).cast("long").alias("one"))
    ranked = running(stored(ones), ["all"], ["key"], {"rank": "one"})
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    ordered = stored(running(stored(weighed), ["all"], ["ratio", "key"], {"sizes": "source_size", "weights": "weight"}))
    size, heft = ordered.agg(F.sum("source_size"), F.sum("weight")).first()
    size, heft = size or 0, heft or 0
    left = F.lit(share * size) - most * F.col("sizes")
    bounded = left * F.col("weight") / (F.lit(heft) - F.col("weights")) > most * F.col("source_size")
    marked = ordered.withColumn("bounded", bounded)
    full, taken = marked.where("bounded").agg(F.sum("source_size"), F.sum("weight")).first()
    rest = (share * size - most * (full or 0)) / max(1, heft - (taken or 0))
    target = F.when(F.col("bounded"), F.col("source_size") * float(most)).otherwise(F.col("weight") * F.lit(rest))
    return marked.select("key", "source_size", target.cast("double").alias("target"))


def _expected(classes: DataFrame, most: int) -> DataFrame:
    """``classes`` (key, copies, words, target) with ``expected`` copies of each of its documents.

    Proportional to 1 / copies and at most ``most``, such that the expected words of a source
    are its target. Classes of few copies reach the bound first.
    """
    before = Window.partitionBy("key").orderBy("copies").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("key").orderBy("copies").rowsBetween(0, Window.unboundedFollowing)
    shared = F.col("words") / F.col("copies")
    rate = (F.col("target") - most * F.coalesce(F.sum("words").over(before), F.lit(0))) / F.sum(shared).over(onward)
    marked = classes.withColumn("rate", rate).withColumn("bounded", F.col("rate") >= most * F.col("copies"))
    first = Window.partitionBy("key")
    rest = F.min(F.when(~F.col("bounded"), F.struct("copies", "rate"))).over(first)["rate"]
    expected = F.when(F.col("bounded"), F.lit(float(most))).otherwise(F.greatest(F.lit(0.0), rest / F.col("copies")))
    return marked.withColumn("expected", expected).drop("rate", "bounded")


def uniform(name: Column) -> Column:
    """A number between 0 and 1, both excluded: the first 52 bits of the MD5 of ``name``."""
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << 52)


def pick(candidates: DataFrame, room: DataFrame) -> DataFrame:
    """(row, key): of each source the documents taken, in Pareto order, while they fit.

    ``candidates`` (row, key, size, odds) are taken in ascending ``odds`` as long as the sum of
    their sizes stays within ``room`` (key, words). Documents that are larger than what is then
    left cannot be taken any more; the others are tried again in the same order, until none
    fits. Every round takes at least the first that fits of each source.
    """
    taken = None
    waiting = candidates
    while True:
        waiting = stored(lookup_join(waiting, room, ["key"]).where("size <= words").drop("words"))
        if waiting.isEmpty():
            return taken if taken is not None else waiting.select("row", "key")
        summed = running(waiting, ["key"], ["odds", "row"], {"before": "size"})
        judged = stored(lookup_join(summed, room, ["key"]).withColumn("fits", F.col("before") + F.col("size") <= F.col("words")))
        fits = judged.where("fits")
        used = fits.groupBy("key").agg(F.sum("size").alias("used"))
        room = stored(
            room.join(used, "key", "left").select("key", (F.col("words") - F.coalesce("used", F.lit(0))).alias("words"))
        )
        taken = fits.select("row", "key") if taken is None else taken.union(fits.select("row", "key"))
        waiting = judged.where("NOT fits").select(*candidates.columns)


def mix(
    df: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, expected): one row per row of ``df``.

    ``size`` is the number of words, 0 for null. A document whose text stands m times in its
    source has 1 / m of the weight of a single one. Its expected copies, at most ``most``, are
    certain in their whole part; the rest is its inclusion probability p. Of the documents with
    0 < p < 1, those with the smallest u / (1 - u) * (1 - p) / p are taken while the words of the
    source stay within its target, u drawn from id and text. What a source misses is less than
    its smallest document not taken. Whole documents only; a document without words takes
    nothing. Null sources are one source, the last. Equal rows are separate documents with one
    u. Reruns agree, since no number depends on place. An empty table gives no row.
    """
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce(F.concat(F.lit("-"), "source"), F.lit("=")).alias("key"),
            F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("name"),
            word_count(F.col("text")).alias("size"),
        )
    )
    names = rows.groupBy("key", "name").agg(F.count("*").alias("copies"), F.sum("size").alias("words"))
    names = stored(names)
    sources = stored(names.groupBy("key").agg(F.sum("words").alias("source_size")))
    aims = stored(targets(sources, weights, share, most))
    classes = lookup_join(
        names.where("words > 0").groupBy("key", "copies").agg(F.sum("words").alias("words")), aims, ["key"]
    )
    classes = stored(
        _expected(classes, most)
        .withColumn("whole", F.floor(F.col("expected") + 1e-9))
        .withColumn("inclusion", F.greatest(F.lit(0.0), F.col("expected") - F.col("whole")))
    )
    certain = classes.groupBy("key").agg(F.sum(F.col("whole") * F.col("words")).alias("sure"))
    room = stored(
        aims.join(certain, "key").select("key", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("sure")).alias("words"))
    )
    named = names.where("copies > 1").select("key", "name", "copies")
    known = lookup_join(rows, stored(named), ["key", "name"], "left").fillna(1, ["copies"])
    known = lookup_join(known, classes.select("key", "copies", "whole", "inclusion"), ["key", "copies"], "left")
    known = stored(lookup_join(known, aims, ["key"]))
    named_row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "name", F.lit(str(seed)))
    p, u = F.col("inclusion"), uniform(named_row)
    odds = (u / (1 - u)) * ((1 - p) / p)
    candidates = known.where("size > 0 AND inclusion > 1e-9").select("row", "key", "size", odds.alias("odds"))
    chosen = pick(candidates, room).select("row", F.lit(1).alias("picked"))
    out = known.join(chosen, "row", "left")
    copies = F.coalesce("whole", F.lit(0)) + F.coalesce("picked", F.lit(0))
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
        copies.cast("int").alias("copies"), (F.coalesce("whole", F.lit(0)) + F.coalesce("inclusion", F.lit(0.0))).alias("expected"),
    )
